"""Streaming runs over small files: late rows, bad rows, restarts, retries, the log and its views."""

from __future__ import annotations

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from epigauge.operators.windows import watermarked, window_sums, with_finality
from epigauge.sources.records import accepted, decode, encode
from epigauge.sources.replay import records_per_date, replay
from epigauge.sources.streams import file_records, table_stream
from epigauge.spec import IndicatorSpec
from epigauge.streaming.jobs import (
    StreamOptions,
    finish,
    late_rows,
    run_id_of,
    start_log,
    start_quarantine,
    start_surveillance,
)
from epigauge.streaming.log import PredictionLog

SPEC = IndicatorSpec(metrics=("x",), burden=("x",))


class Feed:
    """A folder of JSON files and a surveillance job over it."""

    def __init__(self, spark, folder, **options):
        self.spark, self.folder, self.options = spark, str(folder), options
        self.log = PredictionLog(f"{self.folder}/log", SPEC)
        os.makedirs(f"{self.folder}/in")
        self.sent, self.arrived = 0, 1_750_000_000  # June 2025

    def send(self, *lines):
        path = f"{self.folder}/in/{self.sent:03d}.json"
        with open(path, "w") as out:
            out.write("\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines))
        os.utime(path, (self.arrived + self.sent,) * 2)
        self.sent += 1

    def run(self, files_per_batch=1, **options):
        source = file_records(self.spark, f"{self.folder}/in", files_per_batch)
        checkpoint = f"{self.folder}/checkpoint"
        options = {**self.options, **options}
        finish(start_surveillance(source, self.log, f"{self.folder}/quarantine", checkpoint, SPEC, **options))
        return self.log

    def states(self):
        got = self.log.windows(self.spark).collect()
        return {(r.State, r.window_end.strftime("%d-%m")): r.x for r in got}


def report(date, x, state="A", region=0.0):
    return {"Date": date, "State": state, "Region_Index": region, "x": x}


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_late_rows_are_merged_for_one_batch_then_dropped(feed):
    for date, x in [("01-01", 1), ("25-01", 5), ("03-01", 7), ("04-01", 100), ("05-01", 1000)]:
        feed.send(report(f"{date}-2024", x))
    feed.run()
    # a row is late by the watermark of the batch before its own, so the first late one still counts
    assert feed.states() == {("A", "18-01"): 8.0, ("A", "17-02"): 5.0}


def test_bad_records_do_not_stop_the_stream(spark, feed, rows):
    feed.send(report("01-01-2024", 1), "{bad", report("2024-01-02", 10))
    feed.send(report("02-01-2024", 2), report("03-01-2024", 4, state=None), '{"Date": "04-01-2024"')
    feed.run()
    feed.send(report("05-01-2024", 8))
    feed.run()
    assert feed.states() == {("A", "18-01"): 11.0}
    set_aside = spark.read.parquet(f"{feed.folder}/quarantine")
    assert [r[0] for r in rows(set_aside, "reject_reason")] == ["bad_json", "bad_json", "bad_time", "missing_key"]


def test_nan_counts_as_missing(feed):
    feed.send('{"Date": "01-01-2024", "State": "A", "Region_Index": 0.0, "x": NaN}', report("02-01-2024", 3))
    feed.run()
    assert feed.states() == {("A", "18-01"): 3.0}


def test_restart_goes_on_where_it_was(spark, feed):
    feed.send(report("01-01-2024", 1))
    feed.run()
    feed.send(report("02-01-2024", 2))
    feed.run()
    feed.run()
    versions = feed.log.read(spark).select("run_id", "batch_id", "x").orderBy("batch_id").collect()
    assert [r.x for r in versions] == [1.0, 3.0]
    assert len({r.run_id for r in versions}) == 1


def test_a_new_run_wins_over_an_old_one(spark, feed):
    feed.send(report("01-01-2024", 1))
    feed.run()
    feed.send(report("02-01-2024", 2))
    feed.run()
    time.sleep(0.01)
    source = file_records(spark, f"{feed.folder}/in")
    finish(start_surveillance(source, feed.log, f"{feed.folder}/q2", f"{feed.folder}/c2", SPEC))
    assert feed.log.read(spark).select("run_id").distinct().count() == 2
    assert feed.states() == {("A", "18-01"): 3.0}


def test_run_id_belongs_to_the_checkpoint(spark, tmp_path):
    first = run_id_of(spark, f"{tmp_path}/a")
    time.sleep(0.01)
    assert run_id_of(spark, f"{tmp_path}/b") > first
    assert run_id_of(spark, f"{tmp_path}/a") == first


@pytest.mark.parametrize("chosen", [None, 3])
def test_state_partitions_are_set_not_guessed(spark, feed, chosen):
    general = "11"  # more than this session has cores
    spark.conf.set("spark.sql.shuffle.partitions", general)
    try:
        feed.send(report("01-01-2024", 1))
        feed.run(state_partitions=chosen)
        assert spark.conf.get("spark.sql.shuffle.partitions") == general
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    stores = [n for n in os.listdir(f"{feed.folder}/checkpoint/log/state/0") if n.isdigit()]
    assert len(stores) == (chosen or int(general))
    feed.send(report("02-01-2024", 2))
    feed.run()
    assert feed.states() == {("A", "18-01"): 3.0}


def test_empty_batches_write_nothing(feed):
    feed.send(report("01-01-2024", 1))
    feed.run()
    run = os.listdir(f"{feed.folder}/log/batches")
    assert os.listdir(f"{feed.folder}/log/batches/{run[0]}") == ["batch_id=0"]
    assert len(os.listdir(f"{feed.folder}/checkpoint/log/commits")) > 2  # with checksums: more than one batch ran


def test_a_retried_batch_replaces_itself(spark, tmp_path):
    log = PredictionLog(str(tmp_path), SPEC)
    rows = spark.createDataFrame([("A", 0.0, 1.0)], "State string, Region_Index double, x double")
    log.append(rows, 1, 0)
    log.append(rows, 1, 0)
    assert log.read(spark).count() == 1


def test_a_silent_location_stays_in_the_latest_view(spark, feed, rows):
    feed.send(report("01-01-2024", 1, "A"), report("01-01-2024", 2, "B"))
    feed.send(report("02-01-2024", 4, "A"))
    log = feed.run()
    assert rows(log.latest(spark), "State", "x") == [("A", 5.0), ("B", 2.0)]
    last = log.read(spark).orderBy(F.desc("batch_id")).first()
    assert rows(log.changed_in(spark, last.run_id, last.batch_id), "State", "x") == [("A", 5.0)]


def test_compaction_changes_no_view(spark, feed, rows):
    for i in range(1, 5):
        feed.send(report(f"{i:02d}-01-2024", i, "A"), report(f"{i:02d}-02-2024", 10 * i, "B"))
    log = feed.run()
    views = lambda: (rows(log.windows(spark)), rows(log.latest(spark)))
    before = views()
    assert log.compact(spark)
    assert views() == before
    assert not log.compact(spark)
    assert views() == before
    assert len(os.listdir(f"{feed.folder}/log/snapshots")) == 1
    feed.send(report("06-02-2024", 1000, "B"))
    feed.run()
    after = views()
    assert after != before
    assert log.compact(spark)
    assert views() == after
    batches = log._listed(spark, "batches")
    assert log.retain(spark, 3600) == 0 and views() == after
    assert log.retain(spark, 0) > 0 and views() == after
    assert len(log._listed(spark, "batches")) < len(batches)
    assert len(os.listdir(f"{feed.folder}/log/snapshots")) == 1
    feed.send(report("07-02-2024", 1, "C"))
    feed.run()
    assert len(views()[0]) == len(after[0]) + 1


def test_no_batch_of_another_run_is_lost_by_a_compaction(spark, tmp_path, rows):
    """Two runs write side by side; the older one goes on after its batches were folded."""
    log = PredictionLog(str(tmp_path), SPEC)
    start, end = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 31)

    def wrote(run, batch, state, x):
        columns = "window_start timestamp, window_end timestamp, State string, Region_Index double, x double"
        log.append(spark.createDataFrame([(start, end, state, 0.0, x)], columns), run, batch)

    for batch in range(2):
        wrote(100, batch, "A", 1.0)
        wrote(200, batch, "B", 2.0)
    assert log.compact(spark)
    wrote(100, 2, "D", 50.0)
    wrote(100, 3, "C", 7.0)
    wrote(50, 0, "E", 9.0)
    want = [("A", 1.0), ("B", 2.0), ("C", 7.0), ("D", 50.0), ("E", 9.0)]
    assert rows(log.windows(spark), "State", "x") == want
    assert log.compact(spark) and rows(log.windows(spark), "State", "x") == want
    log.retain(spark, 0)
    assert rows(log.windows(spark), "State", "x") == want


def test_far_dates_are_set_aside_and_do_not_move_the_watermark(spark, feed, rows):
    feed.send(report("01-01-2024", 1))
    feed.send(report("01-01-2042", 5), report("01-01-9999", 5), report("31-12-1899", 5), report("01-01-0001", 5))
    feed.send(report("02-01-2024", 2), report("03-01-2024", 4), report("04-03-2024", 8))
    for options in ({}, {"once_per_report": True}):
        feed.log = PredictionLog(f"{feed.folder}/log{len(options)}", SPEC)
        source = file_records(spark, f"{feed.folder}/in", 1)
        bad, checkpoint = f"{feed.folder}/bad{len(options)}", f"{feed.folder}/c{len(options)}"
        finish(start_surveillance(source, feed.log, bad, checkpoint, SPEC, **options))
        assert feed.states() == {("A", "18-01"): 7.0, ("A", "18-03"): 8.0}
        reasons = [r[0] for r in rows(spark.read.parquet(bad), "reject_reason")]
        assert reasons == ["future_time", "future_time", "too_old", "too_old"]


def test_infinite_numbers_count_as_missing(spark, feed, rows):
    feed.send('{"Date": "01-01-2024", "State": "A", "Region_Index": 0.0, "x": Infinity}', report("02-01-2024", 3))
    feed.send('{"Date": "01-01-2024", "State": "A", "Region_Index": 0.0, "x": -Infinity}')
    log = feed.run(missing_counts=True)
    assert rows(log.windows(spark), "x", "x_missing", "days_seen") == [(3.0, 2, 2)]


def test_late_rows_are_counted(spark, feed):
    for date in ("01-01", "25-02", "26-02", "02-01", "03-01"):
        feed.send(report(f"{date}-2024", 1))
    source = file_records(spark, f"{feed.folder}/in", 1)
    queries = start_surveillance(source, feed.log, f"{feed.folder}/q", f"{feed.folder}/c", SPEC)
    finish(queries)
    assert late_rows(queries[0]) == 2


def test_windows_that_cannot_be_scored_are_noted(spark, feed, rows):
    feed.send(report("01-01-2024", None), report("01-01-2024", 2, "B"), report("01-01-2024", None, "C"))
    feed.send(report("02-01-2024", 5, "C"))
    log = feed.run(score=lambda sums: sums.where("x is not null"), full_windows=True)
    assert rows(log.windows(spark), "State", "x") == [("B", 60.0), ("C", 75.0)]
    assert rows(log.skipped(spark), "State") == [("A",)]


def test_a_failure_of_either_query_ends_both(spark, feed):
    feed.send(report("01-01-2024", 1), "{bad")
    for part in ("log", "quarantine"):
        source = file_records(spark, f"{feed.folder}/in")
        queries = start_surveillance(
            source, feed.log, f"{feed.folder}/q", f"{feed.folder}/c-{part}", SPEC, every="1 second",
            score=(lambda df: df.withColumn("x", F.raise_error(F.lit("no model")))) if part == "log" else None,
        )
        if part == "quarantine":
            queries[1].stop()
            broken = decode(source, SPEC).withColumn("reject_reason", F.raise_error(F.lit("no disk")).cast("string"))
            queries[1] = start_quarantine(broken, f"{feed.folder}/q2", StreamOptions(f"{feed.folder}/c3", None, "1 second"))
        with pytest.raises(Exception, match="no model|no disk"):
            finish(queries, look_every=0.2)
        assert not any(q.isActive for q in queries)


def test_nothing_runs_if_one_query_cannot_start(spark, feed, monkeypatch):
    feed.send(report("01-01-2024", 1))
    before = {q.id for q in spark.streams.active}

    def refuse(*args):
        raise RuntimeError("no quarantine")

    monkeypatch.setattr("epigauge.streaming.jobs.start_quarantine", refuse)
    with pytest.raises(RuntimeError, match="no quarantine"):
        feed.run(every="1 second")
    assert {q.id for q in spark.streams.active} == before


def test_nothing_to_compact(spark, feed):
    feed.send(report("01-01-2024", 1))
    assert not feed.run().compact(spark)


def test_append_mode_gives_closed_windows_once(spark, feed, rows):
    feed.send(report("01-01-2024", 1), report("02-01-2024", 2))
    feed.send(report("25-01-2024", 4))
    log = feed.run(output_mode="append")
    assert [(s, x) for s, x in rows(log.read(spark), "State", "x")] == [("A", 3.0)]


def test_redelivered_reports_count_once_over_batches(spark, tmp_path):
    feed = Feed(spark, tmp_path, once_per_report=True)
    feed.send(report("01-01-2024", 1), report("01-01-2024", 1), report("01-01-2024", 2, "B"))
    feed.send(report("01-01-2024", 1), report("02-01-2024", 4))
    feed.run()
    assert feed.states() == {("A", "18-01"): 5.0, ("B", "18-01"): 2.0}


def test_errors_in_scoring_are_not_swallowed(feed):
    feed.send(report("01-01-2024", 1))
    broken = lambda df: df.withColumn("x", F.raise_error(F.lit("no model")))
    with pytest.raises(Exception, match="no model"):
        feed.run(score=broken)
    feed.run()
    assert feed.states() == {("A", "18-01"): 1.0}


def daily(spark, days=120):
    start = dt.date(2024, 1, 1)
    states = F.explode(F.array(*[F.lit(s) for s in "ABC"])).alias("State")
    return spark.range(days).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("day"), states
    ).select(
        "day",
        F.date_format("day", "dd-MM-yyyy").alias("Date"),
        "State",
        F.lit(1.0).alias("Region_Index"),
        F.dayofyear("day").cast("double").alias("x"),
    )


def test_replayed_stream_equals_the_batch(spark, tmp_path, rows):
    reports = daily(spark)
    log = PredictionLog(f"{tmp_path}/log", SPEC)
    ticks = []
    for tick in replay(encode(reports, SPEC, keep=("day",)), F.month("day"), f"{tmp_path}/in"):
        ticks.append(tick)
        source = file_records(spark, f"{tmp_path}/in")
        finish(start_surveillance(source, log, f"{tmp_path}/q", f"{tmp_path}/c", SPEC))
    assert ticks == [1, 2, 3, 4]
    batch = with_finality(window_sums(accepted(decode(encode(reports, SPEC), SPEC)), SPEC), SPEC)
    stream = with_finality(log.windows(spark), SPEC)
    assert rows(stream, *batch.columns) == rows(batch)
    assert rows(batch, "is_final").count((False,)) < batch.count()


def test_records_per_date(spark):
    assert {r.records for r in records_per_date(daily(spark, 3), "Date").collect()} == {3}


@pytest.mark.parametrize("single_file", [True, False])
def test_a_table_as_stream_may_be_a_file_or_a_folder(spark, tmp_path, single_file):
    table = f"{tmp_path}/t.parquet"
    frame = daily(spark).withColumn("timestamp", F.col("day").cast("timestamp"))
    frame.coalesce(1).write.parquet(table)
    if single_file:
        part = next(n for n in os.listdir(table) if n.endswith(".parquet"))
        os.makedirs(f"{tmp_path}/one")
        os.link(f"{table}/{part}", f"{tmp_path}/one/t.parquet")
        os.link(f"{table}/{part}", f"{tmp_path}/one/other.parquet")
        table = f"{tmp_path}/one/t.parquet"
    sums = window_sums(watermarked(table_stream(spark, table, frame.schema), SPEC), SPEC)
    log = PredictionLog(f"{tmp_path}/log", SPEC)
    finish([start_log(sums, log, StreamOptions(f"{tmp_path}/c"), "append")])
    newest = frame.agg(F.max("timestamp")).first()[0] - dt.timedelta(days=2)
    want = window_sums(frame, SPEC).where(F.col("window_end") <= F.lit(newest))
    assert log.read(spark).count() == want.count() > 0
    assert log.read(spark).agg(F.sum("x")).first() == want.agg(F.sum("x")).first()
