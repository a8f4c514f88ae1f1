"""Windows, finality, newest rows and ranks."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from epigauge.operators.latest import latest_rows
from epigauge.operators import ranking
from epigauge.operators.windows import to_full_window, window_sums, with_finality
from epigauge.spec import IndicatorSpec

SPEC = IndicatorSpec(metrics=("x",), burden=("x",))
SCHEMA = "timestamp timestamp, State string, Region_Index double, x double"


def day(text):
    return dt.datetime.strptime(text, "%Y-%m-%d")


def test_windows_start_at_multiples_of_30_days_from_the_epoch(spark):
    df = spark.createDataFrame([(day("2024-01-01"), "A", 0.0, 1.0)], SCHEMA)
    row = window_sums(df, SPEC).first()
    assert (row.window_start, row.window_end) == (day("2023-12-19"), day("2024-01-18"))


def test_sums_skip_null_and_an_all_null_group_stays_null(spark):
    data = [
        (day("2024-01-01"), "A", 0.0, 1.0),
        (day("2024-01-01"), "A", 0.0, None),
        (day("2024-01-02"), "A", 0.0, 2.0),
        (day("2024-01-02"), "B", 0.0, None),
        (None, "A", 0.0, 100.0),
    ]
    sums = window_sums(spark.createDataFrame(data, SCHEMA), SPEC, missing_counts=True)
    got = {r.State: (r.x, r.days_seen, r.x_missing, r.last_report) for r in sums.collect()}
    assert got == {"A": (3.0, 2, 1, day("2024-01-02")), "B": (None, 1, 1, day("2024-01-02"))}


@pytest.mark.parametrize("days", [1, 7, 30, 63, 64, 90, 200])
def test_days_seen_equals_a_distinct_count(spark, days):
    rnd = random.Random(days)
    start = day("1969-06-01")
    data = [(start + dt.timedelta(hours=rnd.randrange(24 * 400)), "A", 0.0, 1.0) for _ in range(600)]
    spec = IndicatorSpec(metrics=("x",), burden=("x",), window_days=days)
    got = {r.window_start: r.days_seen for r in window_sums(spark.createDataFrame(data, SCHEMA), spec).collect()}
    want: dict = {}
    for when, *_ in data:
        number = (when - dt.datetime(1970, 1, 1)).days
        begin = dt.datetime(1970, 1, 1) + dt.timedelta(days=number - number % days)
        want.setdefault(begin, set()).add(when.date())
    assert got == {w: len(d) for w, d in want.items()}


def test_window_length_is_checked():
    with pytest.raises(ValueError):
        IndicatorSpec(window_days=0)
    with pytest.raises(ValueError):
        IndicatorSpec(metrics=("x",))


def test_a_location_with_a_third_of_all_rows(spark):
    ids = spark.range(30_000).select(
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 5 * 86400).alias("timestamp"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 500)).alias("State"),
        F.lit(0.0).alias("Region_Index"),
        F.lit(1.0).alias("x"),
    )
    got = window_sums(ids, SPEC).groupBy("State").agg(F.sum("x").alias("x"))
    assert got.where("State = 'hot'").first().x == 10_000
    assert got.agg(F.sum("x")).first()[0] == 30_000


def test_finality_and_scaling_to_a_full_window(spark):
    data = [(day("2024-01-17"), "A", 0.0, 3.0), (day("2024-01-20"), "A", 0.0, 5.0)]
    sums = with_finality(window_sums(spark.createDataFrame(data, SCHEMA), SPEC), SPEC)
    assert [(r.x, r.is_final) for r in sums.orderBy("window_start").collect()] == [(3.0, True), (5.0, False)]
    assert [r.x for r in to_full_window(sums, SPEC).orderBy("window_start").collect()] == [90.0, 150.0]


def test_latest_rows_by_version_without_null_keys(spark, rows):
    data = [("A", 1, 1, None), ("A", 1, 2, "new"), ("A", 0, 9, "old"), ("B", 1, 1, "b"), (None, 5, 5, "lost")]
    df = spark.createDataFrame(data, "k string, w int, v int, text string")
    assert rows(latest_rows(df, ["k"], ["w", "v"])) == [("A", 1, 2, "new"), ("B", 1, 1, "b")]


def test_rank_equals_brute_force_over_many_ranges(spark):
    rnd = random.Random(5)
    scores = [7.0] * 700 + [round(rnd.gauss(0, 5), 2) for _ in range(1300)] + [None] * 3
    df = spark.createDataFrame(list(enumerate(scores)), "id int, score double")
    apart = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in apart}
    try:
        for key, value in apart.items():
            spark.conf.set(key, value)
        got = {r.id: r["rank"] for r in ranking.rank_descending(df, "score").collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    known = [s for s in scores if s is not None]
    above = {s: 1 + sum(o > s for o in known) for s in set(known)}
    assert got == {i: above.get(s) for i, s in enumerate(scores)}
