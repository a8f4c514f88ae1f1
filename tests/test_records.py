"""JSON records: what is kept, what is set aside and why."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from epigauge.sources.records import accepted, decode, drop_redelivered, encode, event_time, rejected
from epigauge.spec import IndicatorSpec

SPEC = IndicatorSpec(metrics=("x", "y"), burden=("x",))
GOOD = '{"Date": "02-01-2024", "State": "A", "Region_Index": 0.0, "x": 1, "y": 2.5}'

CASES = {
    GOOD: (None, 1.0, 2.5),
    '{"Date": "02-01-2024", "State": "A", "Region_Index": 0.0, "x": NaN, "y": 2.5}': (None, None, 2.5),
    '{"Date": "02-01-2024", "State": "A", "Region_Index": 0.0, "x": "abc", "y": 2.5}': (None, None, 2.5),
    "{bad": ("bad_json", None, None),
    '{"Date": "02-01-2024", "State": "A", "Region_Index"': ("bad_json", None, None),
    "": ("bad_json", None, None),
    "{}": ("bad_json", None, None),
    "[]": ("bad_json", None, None),
    '{"Date": "2024-01-02", "State": "A", "Region_Index": 0.0, "x": 1}': ("bad_time", 1.0, None),
    '{"State": "A", "Region_Index": 0.0, "x": 1}': ("bad_time", 1.0, None),
    '{"Date": "02-01-2024", "Region_Index": 0.0, "x": 1}': ("missing_key", 1.0, None),
    '{"Date": "02-01-2024", "State": "A", "Region_Index": NaN, "x": 1}': ("missing_key", 1.0, None),
}


def test_every_record_is_kept_or_set_aside(spark):
    raw = spark.createDataFrame([(text,) for text in CASES], "value string")
    decoded = decode(raw, SPEC)
    got = {r.raw: (r.reject_reason, r.x, r.y) for r in decoded.collect()}
    assert got == CASES
    assert accepted(decoded).count() + rejected(decoded).count() == len(CASES)
    assert {r.raw for r in rejected(decoded).collect()} == {t for t, (reason, *_) in CASES.items() if reason}


def test_null_and_binary_values(spark):
    raw = spark.createDataFrame([(None,), (bytearray(GOOD.encode()),)], "value binary")
    assert sorted(r.reject_reason or "" for r in decode(raw, SPEC).collect()) == ["", "bad_json"]


def test_encode_then_decode_gives_the_same_rows(spark, rows):
    data = [("02-01-2024", "A", 0.0, 1.0, None), ("03-01-2024", "B ü\"", 1.0, -2.5, 1e300)]
    df = spark.createDataFrame(data, "Date string, State string, Region_Index double, x double, y double")
    back = accepted(decode(encode(df, SPEC), SPEC))
    assert rows(back, *df.columns) == rows(df)


@pytest.mark.parametrize(
    ("text", "day"),
    [("02-01-2024", dt.datetime(2024, 1, 2)), ("2024-01-02", None), ("31-02-2024", None), ("", None), (None, None)],
)
def test_event_time_never_raises(spark, text, day):
    df = spark.createDataFrame([(text,)], "t string").select(event_time(F.col("t"), "dd-MM-yyyy").alias("t"))
    assert df.first().t == day


def test_redelivered_reports_count_once_with_a_hot_report(spark):
    day = F.lit(dt.datetime(2024, 1, 2))
    cold = spark.range(2000).select(day.alias("timestamp"), F.col("id").cast("string").alias("State"))
    hot = spark.range(1000).select(day.alias("timestamp"), F.lit("hot").alias("State"))
    sent = cold.union(hot).union(cold).withColumn("Region_Index", F.lit(0.0)).withColumn("x", F.lit(1.0))
    once = drop_redelivered(sent.repartition(8), SPEC)
    assert once.agg(F.count("*"), F.countDistinct("State")).first() == (2001, 2001)
