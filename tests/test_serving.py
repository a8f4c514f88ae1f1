"""Dashboard questions on literal predictions."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from epigauge.functions.labels import location_of, region_of
from epigauge.plans import serving

SCHEMA = "State string, Region_Index double, Month_Ending date, Severity_Level int, Vulnerability_Score double"
DAY = dt.date(2024, 1, 18)


def predictions(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    region = region_of(F.col("Region_Index"))
    return df.withColumn("Region", region).withColumn("Location", location_of(F.col("State"), region))


@pytest.fixture
def some(spark):
    return predictions(
        spark,
        [
            ("B", 0.0, DAY, 2, 90.126),
            ("A", 1.0, DAY, 2, 90.126),
            ("A", 0.0, DAY, 1, 40.0),
            ("C", 0.0, DAY, 0, 3.0),
            ("D", 2.0, DAY, None, None),
        ],
    )


def test_kpis(some):
    assert serving.kpi_summary(some).first() == (4, 2, 90.13, DAY)
    assert serving.kpi_summary(some, exact=False).first() == (4, 2, 90.13, DAY)


def test_alert_lists_locations_by_name(some):
    assert serving.alert(some).first() == ("HIGH RISK ALERT", 2, "A (Urban), B (Rural)")
    assert serving.alert(some.where("Severity_Level < 2")).first() == ("STABLE", 0, "")


def test_unknown_codes_have_no_label(some):
    row = serving.display(some).where("Location IS NULL").first()
    assert (row.Severity, row.display_class) == (None, "Unknown")


def test_ranking_shares_ranks_and_puts_ties_in_name_order(some):
    got = [(r.Location, r["rank"]) for r in serving.vulnerability_ranking(some).collect()]
    assert got == [("A (Urban)", 1), ("B (Rural)", 1), ("A (Rural)", 3), ("C (Rural)", 4), (None, None)]


def test_distribution_leaves_out_unknown(some):
    got = [tuple(r) for r in serving.severity_distribution(some).collect()]
    assert got == [("High Risk", 2), ("Low Risk", 1), ("Moderate Risk", 1)]


def test_top(some):
    assert [r.Location for r in serving.top_vulnerable(some, 2).collect()] == ["A (Urban)", "B (Rural)"]
    assert serving.high_risk(some).count() == 2


def test_a_table_without_severity_is_refused(some):
    with pytest.raises(ValueError, match="Severity_Level"):
        serving.kpi_summary(some.drop("Severity_Level"))
