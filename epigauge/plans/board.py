"""The tables behind a dashboard, built from the latest predictions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from epigauge.plans import serving
from epigauge.session import materialise

TABLES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "kpi_summary": serving.kpi_summary,
    "alert": serving.alert,
    "ranking": serving.vulnerability_ranking,
    "feed": serving.display,
    "severity_distribution": serving.severity_distribution,
    "top_vulnerable": serving.top_vulnerable,
}


def build_board(latest: DataFrame) -> dict[str, DataFrame]:
    """All dashboard tables; the latest view is worked out once for all of them."""
    final = [c for c in ("is_final",) if c in latest.columns]
    newest = materialise(latest.select(*serving.SHOWN, *final), "latest")
    tables = {name: build(newest) for name, build in TABLES.items()}
    high = serving.high_risk(newest).select("Location", "Vulnerability_Score", "Month_Ending", *final)
    return {**tables, "high_risk": high}
