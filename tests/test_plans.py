"""Physical plans: shuffles, scans and pushed filters of the main operators."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from epigauge.checks import fixtures
from epigauge.operators.distribution import density
from epigauge.operators.latest import latest_rows
from epigauge.sources.records import accepted, decode
from epigauge.sources.tables import preview
from epigauge.spec import HEALTH

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(plan: str) -> list[str]:
    return re.findall(r"Exchange (\w+)", plan)


@pytest.mark.parametrize(
    "name", ["daily_reports", "window_sum", "clean_nonzero", "skip_invalid", "json_quarantine"]
)
def test_one_shuffle_after_partial_aggregation(spark, name):
    plan = plan_of(contract.queries()[name](spark, SF_DIR))
    assert exchanges(plan) == ["hashpartitioning"]
    assert "partial_" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_the_scan_reads_needed_columns_only(spark):
    plan = contract.queries()["window_sum"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    scan = re.search(r"FileScan parquet \[(.*?)\]", plan).group(1)
    columns = {re.sub(r"#\d+L?", "", c) for c in scan.split(",")}
    assert columns == {"l_partkey", "l_suppkey", "l_quantity", "l_linestatus", "l_shipdate"}


def test_a_filter_reaches_the_scan(spark):
    recent = fixtures.report_lines(spark, SF_DIR).where(F.col("Region_Type") == "Rural").where("day > '2000-01-01'")
    assert "PushedFilters: [IsNotNull(l_" in plan_of(recent)


def test_a_record_is_parsed_once(spark):
    raw = spark.range(1).select(F.col("id").cast("string").alias("value"))
    plan = plan_of(accepted(decode(raw, HEALTH)))
    assert plan.count("from_json(") == 1
    assert plan.count("gettimestamp(") == 1


def test_latest_reduces_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    plan = plan_of(latest_rows(df, ["k"], ["id"]))
    assert plan.index("partial_max_by") > plan.index("Exchange hashpartitioning")  # below, so before
    assert "Window" not in plan


def test_preview_sorts_no_more_than_it_shows(spark):
    assert "TakeOrderedAndProject" in plan_of(preview(spark.range(10), ["id"], 3))


def test_density_shuffles_no_scores(spark):
    scores = spark.range(1000).select(F.rand(1).alias("x"))
    plan = plan_of(density(scores, "x", points=20))
    assert "hashpartitioning(bin#" in plan and "hashpartitioning(x#" not in plan  # counts per bin, then sums per point


@pytest.mark.parametrize(
    "name",
    ["kpi_summary", "high_risk_alert", "vulnerability_ranking", "score_histogram", "score_density", "kmeans_assign"],
)
def test_no_nested_loops(spark, name):
    plan = plan_of(contract.queries()[name](spark, SF_DIR))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
