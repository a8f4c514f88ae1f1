"""What a dashboard asks of the latest predictions, each as one DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from epigauge.functions.labels import display_class, severity_of
from epigauge.operators.latest import latest_rows
from epigauge.operators.ranking import rank_descending
from epigauge.sources.tables import require_columns

NEEDS = ("State", "Month_Ending", "Severity_Level", "Vulnerability_Score", "Location")
SHOWN = ("State", "Region_Index", "Month_Ending", "Severity_Level", "Vulnerability_Score", "Region", "Location")
HIGH = "High Risk"
#: Columns of a prediction log that tell later states of a window from earlier ones.
VERSION = ("run_id", "batch_id")


def latest_predictions(predictions: DataFrame) -> DataFrame:
    """The newest prediction per location; only the columns a dashboard shows are read and shuffled.

    A raw log may hold several states of a window: the last one written is taken.
    """
    versions = [v for v in VERSION if v in predictions.columns]
    newest = latest_rows(predictions.select(*SHOWN, *versions), ("State", "Region_Index"), ("Month_Ending", *versions))
    return newest.select(*SHOWN)


def with_severity(predictions: DataFrame) -> DataFrame:
    """Add the severity label, refusing a table that is not a prediction table."""
    return require_columns(predictions, NEEDS, "the prediction table").withColumn(
        "Severity", severity_of(F.col("Severity_Level"))
    )


def kpi_summary(predictions: DataFrame, exact: bool = True) -> DataFrame:
    """Key figures; with ``exact=False`` the states are counted by sketch, without a second shuffle."""
    states = F.countDistinct("State") if exact else F.approx_count_distinct("State")
    return with_severity(predictions).agg(
        states.alias("states_monitored"),
        F.count_if(F.col("Severity") == HIGH).alias("high_risk_regions"),
        F.round(F.max("Vulnerability_Score"), 2).alias("max_vulnerability_score"),
        F.max("Month_Ending").alias("last_updated"),
    )


def high_risk(predictions: DataFrame) -> DataFrame:
    return with_severity(predictions).where(F.col("Severity") == HIGH)


def alert(predictions: DataFrame) -> DataFrame:
    """Alert level and the high-risk locations by name; the list holds one name per location."""
    named = F.when(F.col("Severity") == HIGH, F.col("Location"))
    found = with_severity(predictions).agg(
        F.count_if(F.col("Severity") == HIGH).alias("high_risk_regions"),
        F.array_join(F.array_sort(F.collect_list(named)), ", ").alias("locations"),
    )
    level = F.when(F.col("high_risk_regions") > 0, F.lit("HIGH RISK ALERT")).otherwise(F.lit("STABLE"))
    return found.select(level.alias("level"), "high_risk_regions", "locations")


def feed(predictions: DataFrame) -> DataFrame:
    return with_severity(predictions).select("Location", "Severity", "Vulnerability_Score")


def display(predictions: DataFrame) -> DataFrame:
    return feed(predictions).withColumn("display_class", display_class(F.col("Severity")))


def vulnerability_ranking(predictions: DataFrame) -> DataFrame:
    """All locations by score, greatest first, with their rank."""
    scores = feed(predictions).select("Location", "Vulnerability_Score")
    return rank_descending(scores, "Vulnerability_Score").orderBy(F.desc("Vulnerability_Score"), "Location")


def severity_distribution(predictions: DataFrame) -> DataFrame:
    counts = with_severity(predictions).where(F.col("Severity").isNotNull()).groupBy("Severity")
    return counts.agg(F.count("*").alias("n")).orderBy(F.desc("n"), "Severity")


def top_vulnerable(predictions: DataFrame, n: int = 10) -> DataFrame:
    """The n locations with the greatest scores; equal scores by name."""
    return (
        feed(predictions)
        .where(F.col("Vulnerability_Score").isNotNull())
        .orderBy(F.desc("Vulnerability_Score"), "Location")
        .limit(n)
    )
