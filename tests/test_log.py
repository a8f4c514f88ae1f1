"""The prediction log without streams: parts, schemas, compactions side by side, retention, sketches."""

from __future__ import annotations

import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from epigauge.operators.distribution import histogram
from epigauge.operators.sketches import GRID, KEY_ERROR, RANK_ERROR, histogram_of, keys_in, merged_sketches, quantiles, sketched
from epigauge.session import put_if_absent, read_text
from epigauge.spec import IndicatorSpec
from epigauge.streaming import log as log_module
from epigauge.streaming.log import PredictionLog

SPEC = IndicatorSpec(metrics=("x",), burden=("x",))
COLUMNS = "window_start timestamp, window_end timestamp, State string, Region_Index double, x double"
START, END = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 31)


@pytest.fixture
def log(tmp_path):
    return PredictionLog(f"{tmp_path}/log", SPEC)


def rows_of(spark, *rows, more=""):
    return spark.createDataFrame([(START, END, state, 0.0, *rest) for state, *rest in rows], COLUMNS + more)


def late_of(spark, *rows):
    columns = f"{COLUMNS}, x_missing long, day_words array<long>, last_report timestamp, reports long"
    return spark.createDataFrame([(START, END, s, 0.0, x, 0, [word], END, 1) for s, x, word in rows], columns)


def test_nothing_skipped_and_nothing_late(spark, log, rows):
    log.append(rows_of(spark, ("A", 1.0)), 1, 0)
    assert log.skipped(spark).collect() == [] and log.late(spark).collect() == []
    assert set(log.skipped(spark).columns) >= {"window_start", "window_end", "State", "Region_Index", "x", "run_id"}
    log.append(rows_of(spark, ("A", 2.0)), 1, 1)
    assert log.compact(spark) and log.skipped(spark).collect() == [] and log.sketches(spark).collect() == []


def test_a_log_that_is_not_there_is_an_error(spark, log):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        log.read(spark)


def test_columns_of_every_run_stay(spark, log, rows):
    """A run with fewer columns, and a restart of a run with other ones, hide nothing."""
    log.append(rows_of(spark, ("A", 1.0, 7), more=", x_missing long"), 1, 0)
    log.append(rows_of(spark, ("B", 2.0)), 2, 0)
    log.append(rows_of(spark, ("C", 3.0, 0.5), more=", score double"), 2, 1)
    want = [("A", 7, None), ("B", None, None), ("C", None, 0.5)]
    assert rows(log.read(spark), "State", "x_missing", "score") == want
    log.append(rows_of(spark, ("D", 2.0)), 1, 1)
    log.append(rows_of(spark, ("D", 3.0)), 1, 2)
    log.append(rows_of(spark, ("E", 2.0)), 2, 2)
    assert log.compact(spark)
    log.retain(spark, 0)
    assert rows(log.windows(spark), "State", "x_missing", "score") == [*want, ("D", None, None), ("E", None, None)]
    assert len(os.listdir(f"{log.root}/schemas")) == 2 * 3  # each schema once, with its checksum file


def test_a_column_of_two_types_is_named(spark, log):
    log.append(rows_of(spark, ("A", 1.0)), 1, 0)
    log.append(rows_of(spark, ("A", 1.0)).withColumn("x", F.col("x").cast("string")), 1, 1)
    with pytest.raises(ValueError, match="x was logged as double and as string"):
        log.read(spark)


def test_skipped_windows_survive_compaction_and_their_folders_go(spark, log, rows):
    log.append_skipped(rows_of(spark, ("A", None), ("B", None)), 1, 0)
    log.append(rows_of(spark, ("C", 1.0)), 1, 0)
    log.append(rows_of(spark, ("B", 2.0)), 1, 1)
    log.append_skipped(rows_of(spark, ("D", None)), 1, 2)
    assert rows(log.skipped(spark), "State") == [("A",), ("D",)]
    assert log.compact(spark) and rows(log.skipped(spark), "State") == [("A",), ("D",)]
    assert log.retain(spark, 0) == 3
    assert os.listdir(f"{log.root}/skipped/run_id=1") == ["batch_id=2"]
    assert rows(log.skipped(spark), "State") == [("A",), ("D",)]
    log.append(rows_of(spark, ("A", 2.0)), 1, 3)
    assert rows(log.skipped(spark), "State") == [("D",)]


def test_late_reports_are_counted_once_over_compactions(spark, log, rows):
    for batch in range(4):
        log.append(rows_of(spark, ("A", 1.0)), 1, batch)
        log.append_late(late_of(spark, ("A", 10.0, 1 << batch), ("B", None, 1)), 1, batch)
        want = [("A", 10.0 * (batch + 1), batch + 1, batch + 1), ("B", None, 1, batch + 1)]
        assert rows(log.late(spark), "State", "x", "days_seen", "reports") == want
        log.compact(spark)
        log.retain(spark, 0)
        assert rows(log.late(spark), "State", "x", "days_seen", "reports") == want


def test_two_compactions_side_by_side(spark, log, rows, monkeypatch):
    """The second to finish finds its version taken and goes on from the first one's snapshot; nothing is lost."""
    for batch in range(3):
        log.append(rows_of(spark, ("A", float(batch))), 1, batch)
        log.append(rows_of(spark, ("B", 10.0 * batch)), 2, batch)
    create, calls = log_module.put_if_absent, []

    def interleaved(spark, path, text):
        if "/manifest/" in path and not calls:
            calls.append(path)
            # Between this one's snapshot and its entry: the other run goes on, another compaction begins and ends.
            log.append(rows_of(spark, ("C", 5.0)), 2, 3)
            assert log.compact(spark)
            log.retain(spark, 0)
        return create(spark, path, text)

    monkeypatch.setattr(log_module, "put_if_absent", interleaved)
    before = rows(log.windows(spark), "State", "x")
    assert not log.compact(spark)  # the other one has folded all there was
    assert rows(log.windows(spark), "State", "x") == [*before, ("C", 5.0)]
    assert [e.version for e in log._manifest(spark)] == [0]
    assert log._newest_snapshot(spark).marks == {1: 1, 2: 2}
    assert len(os.listdir(f"{log.root}/snapshots")) == 1
    log.append(rows_of(spark, ("D", 7.0)), 1, 3)
    assert log.compact(spark) and log._newest_snapshot(spark).version == 1
    log.retain(spark, 0)
    assert rows(log.windows(spark), "State", "x") == [*before, ("C", 5.0), ("D", 7.0)]


def test_many_compactions_at_once(spark, log, rows):
    for batch in range(6):
        for run in range(3):
            log.append(rows_of(spark, (f"S{run}", float(batch))), run, batch)
    with ThreadPoolExecutor(4) as pool:
        done = list(pool.map(lambda _: log.compact(spark), range(4)))
    assert any(done)
    assert rows(log.windows(spark), "State", "x") == [("S0", 5.0), ("S1", 5.0), ("S2", 5.0)]
    log.retain(spark, 0)
    assert rows(log.windows(spark), "State", "x") == [("S0", 5.0), ("S1", 5.0), ("S2", 5.0)]


def test_a_file_is_created_once(spark, tmp_path):
    path = f"{tmp_path}/one/entry.json"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: put_if_absent(spark, path, f"text {i} ü"), range(8)))
    assert sum(won) >= 1
    assert read_text(spark, path) == f"text {won.index(True)} ü"
    assert not put_if_absent(spark, path, "later")
    assert [n for n in os.listdir(f"{tmp_path}/one") if not n.endswith(".crc")] == ["entry.json"]


def scored(spark, n, seed):
    return spark.range(n).select(
        F.concat(F.lit("L"), (F.col("id") % 700).cast("string")).alias("State"),
        (F.randn(seed) * 20 + 50).alias("score"),
    )


def test_sketches_merge_to_within_their_error(spark):
    parts = [scored(spark, n, seed) for n, seed in ((20_000, 1), (300, 2), (9_000, 3))]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2]).persist()
    merged = merged_sketches(
        sketched(parts[0], "State", "score")
        .unionByName(merged_sketches(sketched(parts[1], "State", "score").unionByName(sketched(parts[2], "State", "score"))))
    ).persist()
    row = merged.select("rows", "scored", "least", "most", keys_in().alias("keys")).first()
    exact = whole.agg(F.count("*"), F.min("score"), F.max("score"), F.countDistinct("State")).first()
    assert (row["rows"], row["scored"], row["least"], row["most"]) == (exact[0], exact[0], exact[1], exact[2])
    assert abs(row["keys"] - exact[3]) <= KEY_ERROR * exact[3]
    for share, score in quantiles(merged, (0.01, 0.25, 0.5, 0.9, 0.99)).collect():
        below = whole.where(F.col("score") <= score).count() / exact[0]
        assert abs(below - share) <= RANK_ERROR + 1 / exact[0]
    got, want = histogram_of(merged, 30).orderBy("bin").collect(), histogram(whole, "score").orderBy("bin").collect()
    assert [r["bin"] for r in got] == list(range(30))
    for g, w in zip(got, want, strict=True):
        assert abs(g["lower_bound"] - w["lower_bound"]) < 1e-9 and abs(g["n"] - w["n"]) <= 2 * (RANK_ERROR + 1 / GRID) * exact[0] + 1
    whole.unpersist()


def test_sketches_of_odd_tables(spark):
    nothing = spark.createDataFrame([], "State string, score double")
    empty = sketched(nothing, "State", "score")
    assert merged_sketches(empty).select("rows", "scored", keys_in()).collect() == [(0, 0, 0)]
    assert quantiles(empty, [0.5]).collect() == [] and histogram_of(empty).collect() == []
    odd = spark.createDataFrame([("A", None), (None, float("nan")), ("A", 3.0), ("B", float("inf"))], "State string, score double")
    assert sketched(odd, "State", "score").select("rows", "scored", "least", "most", keys_in()).collect() == [(4, 1, 3.0, 3.0, 2)]
    assert [r["n"] for r in histogram_of(sketched(odd, "State", "score"), 2).orderBy("bin").collect()] == [0, 1]


def test_sketches_in_the_log_count_a_retried_batch_once(spark, log):
    for batch, x in ((0, 1.0), (1, 2.0), (1, 3.0), (2, 4.0)):
        log.append(rows_of(spark, ("A", x), ("B", x)), 1, batch)
        log.append_sketches(spark, 1, batch, "State", "x")
    look = lambda: log.sketches(spark).select("rows", "least", "most", keys_in()).collect()
    assert look() == [(6, 1.0, 4.0, 2)]
    assert log.compact(spark) and look() == [(6, 1.0, 4.0, 2)]
    log.retain(spark, 0)
    assert look() == [(6, 1.0, 4.0, 2)]
