"""Event-time windows of summed indicators, of a fixed number of days or by calendar."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from epigauge.functions.numeric import DAYS_PER_WORD, day_bits
from epigauge.spec import IndicatorSpec


def watermarked(reports: DataFrame, spec: IndicatorSpec) -> DataFrame:
    """Declare how late a report may come; to be called once, on a stream."""
    return reports.withWatermark(spec.time, spec.lateness)


def window_bounds(time: Column, spec: IndicatorSpec) -> tuple[Column, Column]:
    """Start and end of the window that an event time falls into.

    Windows start at multiples of their length from 1970-01-01 UTC, or with the calendar unit of the session's time zone.
    """
    if spec.calendar:
        start = F.date_trunc(spec.calendar, time)
        months = {"month": 1, "quarter": 3, "year": 12}[spec.calendar]
        return start, (start + F.make_interval(months=F.lit(months))).cast("timestamp")
    span = spec.window_days * 86_400
    start = F.floor(F.unix_seconds(time) / F.lit(span)) * F.lit(span)
    return F.timestamp_seconds(start), F.timestamp_seconds(start + F.lit(span))


def day_of_window(time: Column, spec: IndicatorSpec) -> Column:
    """Number of an event time's day in its window, from 0."""
    if spec.calendar:
        return F.datediff(time, F.date_trunc(spec.calendar, time))
    return F.pmod(F.floor(F.unix_seconds(time) / F.lit(86_400)), F.lit(spec.window_days)).cast("int")


def window_sums(reports: DataFrame, spec: IndicatorSpec, missing_counts: bool = False) -> DataFrame:
    """Sum every metric by window and key; a stream must be watermarked before.

    Besides the sums a row carries ``days_seen`` (distinct days that reported) and ``last_report``; with
    ``missing_counts`` also ``<metric>_missing``. All buffers have a fixed size, so this is one hash aggregate with
    partial sums before its only shuffle, and a location holding most rows costs no more than another. Calendar
    windows are for batches: on a stream this state would never be given up (see ``streaming.keeper``).
    """
    if spec.calendar and reports.isStreaming:
        raise ValueError("calendar windows of a stream are kept by streaming.keeper.kept_windows")
    time = F.col(spec.time)
    sums = [F.sum(m).alias(m) for m in spec.metrics]
    holes = [F.count_if(F.col(m).isNull()).alias(f"{m}_missing") for m in spec.metrics if missing_counts]
    words = day_bits(day_of_window(time, spec), spec.most_days)
    if spec.calendar:
        start, end = window_bounds(time, spec)
        window = F.struct(start.alias("start"), end.alias("end")).alias("window")
    else:
        window = F.window(time, f"{spec.window_days} days").alias("window")
    grouped = reports.groupBy(window, *spec.key_names).agg(
        *sums,
        *holes,
        *[F.bit_or(word).alias(f"day_bits_{i}") for i, word in enumerate(words)],
        F.max(time).alias("last_report"),
    )
    return grouped.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *spec.key_names,
        *spec.metrics,
        *[h for h in grouped.columns if h.endswith("_missing")],
        reduce(add, [F.bit_count(f"day_bits_{i}") for i in range(len(words))]).cast("long").alias("days_seen"),
        "last_report",
    )


def added_windows(parts: DataFrame, spec: IndicatorSpec) -> DataFrame:
    """Rows of ``streaming.keeper.as_windows`` added up by window and key: sums, missing counts, days and reports."""
    words = range(-(-spec.most_days // DAYS_PER_WORD))
    grouped = parts.groupBy("window_start", "window_end", *spec.key_names).agg(
        *[F.sum(m).alias(m) for m in spec.metrics],
        *[F.sum(f"{m}_missing").alias(f"{m}_missing") for m in spec.metrics],
        F.array(*[F.bit_or(F.col("day_words")[i]) for i in words]).alias("day_words"),
        F.max("last_report").alias("last_report"),
        *[F.sum(c).alias(c) for c in ("reports", "late_reports") if c in parts.columns],
    )
    return grouped.withColumn("days_seen", days_in("day_words", spec))


def days_in(words: str, spec: IndicatorSpec) -> Column:
    """Number of days in an array of day bits."""
    return reduce(add, [F.bit_count(F.col(words)[i]) for i in range(-(-spec.most_days // DAYS_PER_WORD))]).cast("long")


def closed_before(watermark_source: DataFrame, spec: IndicatorSpec) -> Column:
    """Scalar: the event time up to which windows are final, from the newest report seen."""
    newest = watermark_source.agg((F.max("last_report") - F.expr(f"INTERVAL {spec.lateness}")).alias("closed"))
    return newest.scalar()


def with_finality(windows: DataFrame, spec: IndicatorSpec) -> DataFrame:
    """Mark the windows that no report can change any more."""
    return windows.withColumn("is_final", F.col("window_end") <= closed_before(windows, spec))


def to_full_window(windows: DataFrame, spec: IndicatorSpec) -> DataFrame:
    """Scale partly reported windows to the full number of days, for models fitted on full ones."""
    days = F.datediff("window_end", "window_start").cast("double") if spec.calendar else F.lit(float(spec.window_days))
    factor = days / F.col("days_seen")
    return windows.withColumns({m: F.col(m) * factor for m in spec.metrics})
