"""What an indicator feed looks like: its keys, event time, metrics, window and lateness.

Every operator takes an ``IndicatorSpec`` instead of hard-coded column names, so the same code
serves any feed of numeric indicators per location and day.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The health indicators of a daily report, in feature order.
METRICS = (
    "ANC_Registered",
    "Institutional_Delivery",
    "C_Section",
    "Child_Diarrhoea",
    "Child_TB",
    "Immunization_MR",
    "Low_Birth_Weight",
    "Infant_Death_Sepsis",
    "Maternal_Death_Bleeding",
    "Adult_Death_TB",
    "Adult_Suicide",
    "PW_Hypertension",
    "Child_Malaria",
    "Severe_Anaemia_Treated",
    "Condoms_Distributed",
    "Early_Breastfeeding",
)

# The indicators that count as a burden in the vulnerability score.
BURDEN_METRICS = (
    "Child_Diarrhoea",
    "Child_TB",
    "Infant_Death_Sepsis",
    "Maternal_Death_Bleeding",
    "Adult_Death_TB",
    "Adult_Suicide",
    "Child_Malaria",
    "Severe_Anaemia_Treated",
)

# The averages shown in a cluster profile (metric -> column name).
PROFILE_METRICS = {
    "Child_Diarrhoea": "Avg_Diarrhoea",
    "Adult_Death_TB": "Avg_TB_Deaths",
    "Infant_Death_Sepsis": "Avg_Infant_Deaths",
    "Institutional_Delivery": "Avg_Safe_Deliveries",
    "Immunization_MR": "Avg_Immunization",
}

# Labels of the coded columns. Severity is ordered by burden, 0 is the lightest.
REGION_LABELS = {0.0: "Rural", 1.0: "Urban"}
SEVERITY_LABELS = {0: "Low Risk", 1: "Moderate Risk", 2: "High Risk"}
HEALTH_LABELS = {0: "Safe", 1: "Average", 2: "Critical"}
SEVERITY_COLOURS = {"Low Risk": "green", "Moderate Risk": "orange", "High Risk": "red"}

# Calendar windows and the most days they may have.
CALENDAR_DAYS = {"month": 31, "quarter": 92, "year": 366}

# Numeric columns of a history that are no indicators.
CALENDAR = ("Year", "Quarter", "Month", "Week", "Day")


@dataclass(frozen=True)
class IndicatorSpec:
    """Columns and event-time rules of one indicator feed.

    A report dated before ``earliest``, or more than ``lead`` after it arrived, is set aside: one far date would
    move the watermark past every honest report. With ``calendar`` windows are months, quarters or years instead of
    ``window_days`` from the epoch on.
    """

    keys: tuple[tuple[str, str], ...] = (("State", "string"), ("Region_Index", "double"))
    metrics: tuple[str, ...] = METRICS
    burden: tuple[str, ...] = BURDEN_METRICS
    extra_features: tuple[str, ...] = ("Region_Index",)
    time_text: str = "Date"
    time_format: str = "dd-MM-yyyy"
    time: str = "timestamp"
    window_days: int = 30
    lateness: str = "2 days"
    earliest: str = "1900-01-01"
    lead: str = "2 days"
    calendar: str | None = None

    def __post_init__(self) -> None:
        if self.window_days < 1:
            raise ValueError("window_days must be at least 1")
        if self.calendar is not None and self.calendar not in CALENDAR_DAYS:
            raise ValueError(f"calendar must be one of {', '.join(CALENDAR_DAYS)}")
        missing = set(self.burden) - set(self.metrics)
        if missing:
            raise ValueError(f"burden names unknown metrics: {sorted(missing)}")

    @property
    def key_names(self) -> list[str]:
        return [name for name, _ in self.keys]

    @property
    def most_days(self) -> int:
        """Days of the longest window."""
        return CALENDAR_DAYS[self.calendar] if self.calendar else self.window_days

    @property
    def features(self) -> list[str]:
        return [*self.metrics, *self.extra_features]

    def record_schema(self) -> T.StructType:
        """Schema of one JSON record: time text, keys, metrics."""
        schema = T.StructType().add(self.time_text, "string")
        for name, kind in self.keys:
            schema = schema.add(name, kind)
        for name in self.metrics:
            schema = schema.add(name, "double")
        return schema


HEALTH = IndicatorSpec()
