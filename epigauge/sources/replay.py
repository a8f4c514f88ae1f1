"""Replay a dated table as the stream it would have been."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, functions as F

from epigauge.session import run_dir


def records_per_date(reports: DataFrame, date: str) -> DataFrame:
    return reports.groupBy(date).agg(F.count("*").alias("records"))


def replay(messages: DataFrame, tick: Column, path: str | None, send: Callable[[DataFrame], None] | None = None) -> Iterator:
    """Hand on ``messages`` one tick at a time, in tick order; yields each tick.

    They are appended to the folder ``path``, or given to ``send`` (a topic takes them the same way).

    The caller lets the stream catch up after each tick, so a tick is one micro-batch however many
    files it has. The messages are written once, split by tick, so each step reads only its own
    part; the loop length is the number of ticks, as with a producer that sends one date per step.
    The split is by range over (tick, input partition): few files per tick, and a tick that holds
    most rows spans many tasks.
    """
    spark = messages.sparkSession
    staged = run_dir(spark, "replay")
    (
        messages.select("value", tick.alias("tick"), F.spark_partition_id().alias("part"))
        .repartitionByRange("tick", "part")
        .drop("part")
        .write.partitionBy("tick")
        .parquet(staged)
    )
    parts = spark.read.parquet(staged)
    ticks = [row.tick for row in parts.select("tick").distinct().toLocalIterator()]
    for one in sorted(ticks, key=lambda t: (t is not None, t)):
        now = parts.where(F.col("tick").eqNullSafe(F.lit(one))).select("value")
        if send:
            send(now)
        else:
            now.write.mode("append").text(path)
        yield one
