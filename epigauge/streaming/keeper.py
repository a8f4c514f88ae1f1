"""Windows kept by a stateful operator of their own: calendar grains, late reports as rows, the newest window live.

The built-in windowed aggregation drops what comes behind the watermark, and gives up its state for windows of a fixed
length only. Here each window of a location has a state and a timer at its end. What comes after that is told as a row.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from operator import add

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from epigauge.functions.numeric import DAYS_PER_WORD, all_present
from epigauge.operators.windows import added_windows, day_of_window, days_in, watermarked, window_bounds
from epigauge.sources.records import accepted, decode
from epigauge.spec import IndicatorSpec
from epigauge.streaming.jobs import ROWS_PER_FILE, StreamOptions, run_id_of, start_quarantine
from epigauge.streaming.log import PredictionLog

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

#: What a row tells: the state of a window that is open, its last state, or reports that came after that.
OPEN, FINAL, LATE = "open", "final", "late"


def _types(spec: IndicatorSpec) -> T.StructType:
    """Columns of a kept window; times are milliseconds, so that no time zone matters on the way through Python."""
    schema = T.StructType()
    for name, kind in spec.keys:
        schema = schema.add(name, kind)
    schema = schema.add("start_ms", "long").add("end_ms", "long")
    return _values(schema, spec)


def _values(schema: T.StructType, spec: IndicatorSpec) -> T.StructType:
    for name in spec.metrics:
        schema = schema.add(name, "double")
    for name in spec.metrics:
        schema = schema.add(f"{name}_missing", "long")
    return schema.add("day_words", T.ArrayType(T.LongType())).add("last_ms", "long").add("reports", "long")


def partial_sums(reports: DataFrame, spec: IndicatorSpec) -> DataFrame:
    """Sums by window, key and day within each Arrow batch, so that little is shuffled however hot a location is.

    A stateless step: allowed on streams ahead of a stateful one, where a second aggregation is not.
    """
    time = F.col(spec.time)
    start, end = window_bounds(time, spec)
    by = [*spec.key_names, "start_ms", "end_ms", "day"]
    rows = reports.select(
        *spec.key_names,
        F.unix_millis(start).alias("start_ms"),
        F.unix_millis(end).alias("end_ms"),
        day_of_window(time, spec).alias("day"),
        *spec.metrics,
        F.unix_millis(time).alias("last_ms"),
    )
    schema = T.StructType(rows.schema.fields[: len(by)])
    for name in spec.metrics:
        schema = schema.add(name, "double")
    for name in spec.metrics:
        schema = schema.add(f"{name}_missing", "long")
    schema = schema.add("last_ms", "long").add("reports", "long")
    metrics = list(spec.metrics)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            wanted = [(m, "sum") for m in metrics]
            wanted += [(m, "count", pc.CountOptions(mode="only_null")) for m in metrics]
            wanted += [("last_ms", "max"), ([], "count_all")]
            found = table.group_by(by).aggregate(wanted)
            names = [*by, *(f"{m}_sum" for m in metrics), *(f"{m}_count" for m in metrics), "last_ms_max", "count_all"]
            yield from found.select(names).rename_columns(schema.fieldNames()).to_batches()

    return rows.mapInArrow(sums, schema)


class WindowKeeper(StatefulProcessor):
    """The sums of one window of one key: told when they change, when the watermark passes the end, and what comes later."""

    def __init__(self, spec: IndicatorSpec, changes: bool):
        self.metrics, self.changes = list(spec.metrics), changes
        self.words = -(-spec.most_days // DAYS_PER_WORD)
        self.told = Row("kind", *_types(spec).fieldNames())
        self.first = len(spec.keys) + 3  # of a partial sum's values the first metric, behind key, window and day

    def init(self, handle) -> None:
        self.handle = handle
        self.sums = handle.getValueState(
            "sums", "sums array<double>, missing array<long>, day_words array<long>, last_ms long, reports long"
        )

    def _added(self, rows: Iterator[Row]) -> tuple:
        sums, missing = [None] * len(self.metrics), [0] * len(self.metrics)
        words, last, reports = [0] * self.words, 0, 0
        for row in rows:
            values = tuple(row)
            told, holes = values[self.first : self.first + len(sums)], values[self.first + len(sums) : -2]
            sums = [y if x is None else x if y is None else x + y for x, y in zip(sums, told, strict=True)]
            missing = [x + y for x, y in zip(missing, holes, strict=True)]
            day = values[self.first - 1]
            words[day // DAYS_PER_WORD] |= 1 << day % DAYS_PER_WORD
            last, reports = max(last, values[-2]), reports + values[-1]
        return sums, missing, words, last, reports

    @staticmethod
    def _joined(a: tuple, b: tuple) -> tuple:
        sums = [y if x is None else x if y is None else x + y for x, y in zip(a[0], b[0], strict=True)]
        missing = [x + y for x, y in zip(a[1], b[1], strict=True)]
        words = [x | y for x, y in zip(a[2], b[2], strict=True)]
        return sums, missing, words, max(a[3], b[3]), a[4] + b[4]

    def _row(self, kind: str, key: tuple, state: tuple) -> Row:
        sums, missing, words, last, reports = state
        return self.told(kind, *key, *sums, *missing, list(words), last, reports)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        state, end = self._added(rows), key[-1]
        if end <= timerValues.getCurrentWatermarkInMs():
            yield self._row(LATE, key, state)
            return
        if self.sums.exists():
            state = self._joined(tuple(self.sums.get()), state)
        else:
            self.handle.registerTimer(end)
        self.sums.update(state)
        if self.changes:
            yield self._row(OPEN, key, state)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        state = tuple(self.sums.get())
        self.sums.clear()
        yield self._row(FINAL, key, state)


def kept_windows(reports: DataFrame, spec: IndicatorSpec, changes: bool = True) -> DataFrame:
    """``kind`` and the windows of a watermarked stream, for an append sink; needs the RocksDB state store.

    With ``changes`` the rows of open windows come whenever their sums change, else only closed ones come. A report is late if its
    window had ended by the watermark of its micro-batch: the newest event time of the batches before, less the lateness.
    Nothing is dropped: each report is in exactly one ``final`` (or still open) state or one ``late`` row. A state
    lives from a window's first report to the watermark's passing its end.
    """
    schema = T.StructType([T.StructField("kind", T.StringType()), *_types(spec).fields])
    grouped = partial_sums(reports, spec).groupBy(*spec.key_names, "start_ms", "end_ms")
    return grouped.transformWithState(WindowKeeper(spec, changes), schema, "Append", "EventTime")


def as_windows(kept: DataFrame, spec: IndicatorSpec) -> DataFrame:
    """The columns of ``window_sums`` with all its counts, ``day_words`` and ``reports``."""
    return kept.select(
        *[c for c in ("kind",) if c in kept.columns],
        F.timestamp_millis("start_ms").alias("window_start"),
        F.timestamp_millis("end_ms").alias("window_end"),
        *spec.key_names,
        *spec.metrics,
        *[f"{m}_missing" for m in spec.metrics],
        days_in("day_words", spec).alias("days_seen"),
        F.timestamp_millis("last_ms").alias("last_report"),
        "day_words",
        "reports",
    )


def corrected(states: DataFrame, late: DataFrame, spec: IndicatorSpec) -> DataFrame:
    """Windows with the reports that came after their end added; ``late_reports`` tells how many these were."""
    told = late.withColumn("late_reports", F.col("reports") if "reports" in late.columns else F.lit(0).cast("long"))
    both = states.withColumn("late_reports", F.lit(0).cast("long")).unionByName(told, allowMissingColumns=True)
    return added_windows(both, spec)


def start_kept(
    reports: DataFrame,
    log: PredictionLog,
    options: StreamOptions,
    changes: bool = True,
    score: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Write kept windows to the log: states (scored, if asked for) as its batches, late reports beside them.

    All parts of a micro-batch are written again in place if it is retried. ``log.late`` reads the late reports,
    ``log.windows`` the states, with their sums also where they are scored, ``log.skipped`` those that cannot be scored because a
    feature is missing; :func:`corrected` adds them up.
    """
    spec = log.spec
    run_id = run_id_of(reports.sparkSession, options.checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = as_windows(batch, spec).persist()
        try:
            holed = ~all_present(spec.features) if score else F.lit(False)
            told = F.col("kind") == LATE
            late, skipped, kept = rows.agg(F.count_if(told), F.count_if(~told & holed), F.count_if(~told & ~holed)).first()
            states = rows.where(~told).withColumn("is_closed", F.col("kind") == FINAL).drop("kind")
            if kept:
                files = 1 + kept // ROWS_PER_FILE
                log.append(with_sums(states, spec, score).repartition(files) if score else states.coalesce(files), run_id, batch_id)
            if skipped:
                log.append_skipped(states.where(holed).coalesce(1 + skipped // ROWS_PER_FILE), run_id, batch_id)
            if late:
                log.append_late(rows.where(told).drop("kind").coalesce(1 + late // ROWS_PER_FILE), run_id, batch_id)
        finally:
            rows.unpersist()

    return options.start(reports.sparkSession, kept_windows(reports, spec, changes).writeStream.outputMode("append").foreachBatch(write))


def with_sums(states: DataFrame, spec: IndicatorSpec, score: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Scored windows with their sums, which a score may leave out."""
    scored = score(states.withColumn("sums_", F.struct(*spec.metrics)))
    gone = [m for m in spec.metrics if m not in scored.columns]
    return scored.select("*", *[F.col(f"sums_.{m}") for m in gone]).drop("sums_")


def start_kept_surveillance(
    records: DataFrame,
    log: PredictionLog,
    quarantine_path: str,
    checkpoint: str,
    score: Callable[[DataFrame], DataFrame] | None = None,
    every: str | None = None,
    name: str | None = None,
    changes: bool = True,
    state_partitions: int | None = None,
) -> list[StreamingQuery]:
    """The whole stream with kept windows: decode, set bad records aside, keep windows and late reports, score, log.

    The windows are those of ``log.spec``, calendar ones included. If one query cannot start, none runs.
    """
    decoded = decode(records, log.spec)

    def options(part: str, rocksdb: bool) -> StreamOptions:
        return StreamOptions(f"{checkpoint}/{part}", f"{name}-{part}" if name else None, every, state_partitions, rocksdb)

    first = start_kept(watermarked(accepted(decoded), log.spec), log, options("log", True), changes, score)
    try:
        return [first, start_quarantine(decoded, quarantine_path, options("quarantine", False))]
    except BaseException:
        first.stop()
        raise


class NewestKeeper(StatefulProcessor):
    """The newest window of one key; told again whenever a later one, or a later state of it, comes."""

    def __init__(self, spec: IndicatorSpec):
        self.keys, self.schema = len(spec.keys), _types(spec)
        self.told = Row(*self.schema.fieldNames())

    def init(self, handle) -> None:
        self.newest = handle.getValueState("newest", T.StructType(self.schema.fields[self.keys :]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        best = max((tuple(row)[self.keys :] for row in rows), key=lambda values: values[1])
        if self.newest.exists() and self.newest.get()[1] > best[1]:
            return
        self.newest.update(best)
        yield self.told(*key, *best)


def newest_windows(kept: DataFrame, spec: IndicatorSpec) -> DataFrame:
    """The newest window per key as it changes: a second stateful operator behind :func:`kept_windows` with its changes.

    A state per key, nothing else: a location that stays silent keeps its last window.
    """
    states = kept.where(F.col("kind") == OPEN).drop("kind")
    return states.groupBy(*spec.key_names).transformWithState(NewestKeeper(spec), _types(spec), "Append", "None")


def _state(spark: SparkSession, checkpoint: str, variable: str, batch_id: int | None = None) -> DataFrame:
    """``key, value`` of a state variable as of the last committed (or a given) batch."""
    operators = spark.read.format("state-metadata").load(checkpoint).select("operatorId", "operatorProperties").distinct().collect()
    having = [r["operatorId"] for r in operators if f'"{variable}"' in (r["operatorProperties"] or "")]
    if len(having) != 1:
        raise ValueError(f"{checkpoint} has no state variable {variable}")
    reader = spark.read.format("statestore").option("operatorId", having[0]).option("stateVarName", variable)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint).select("key", "value")


def live_latest(spark: SparkSession, checkpoint: str, spec: IndicatorSpec, batch_id: int | None = None) -> DataFrame:
    """The newest window per key, read from the state of a stream of :func:`newest_windows`: no log is read."""
    return as_windows(_state(spark, checkpoint, "newest", batch_id).select("key.*", "value.*"), spec)


def open_kept_windows(spark: SparkSession, checkpoint: str, spec: IndicatorSpec, batch_id: int | None = None) -> DataFrame:
    """The windows that a stream of :func:`kept_windows` holds open, read from its state."""
    state = _state(spark, checkpoint, "sums", batch_id).select("key.*", "value.*")
    flat = state.select(
        *spec.key_names,
        "start_ms",
        "end_ms",
        *[F.col("sums")[i].alias(m) for i, m in enumerate(spec.metrics)],
        *[F.col("missing")[i].alias(f"{m}_missing") for i, m in enumerate(spec.metrics)],
        "day_words",
        "last_ms",
        "reports",
    )
    return as_windows(flat, spec)


def open_windows(spark: SparkSession, checkpoint: str, spec: IndicatorSpec, missing_counts: bool = False, batch_id: int | None = None) -> DataFrame:
    """The windows that the built-in aggregation of ``start_surveillance`` holds open, read from its state.

    ``checkpoint`` is that of the log's query; the columns are those of ``window_sums``. Windows that are closed have left the state.
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    words = -(-spec.most_days // DAYS_PER_WORD)
    holes = [f"{m}_missing" for m in spec.metrics if missing_counts]
    # The buffers stand in the order of the aggregates; their own names repeat.
    names = [*spec.metrics, *holes, *[f"word_{i}" for i in range(words)], "last_report"]
    rows = reader.load(checkpoint)
    fields = rows.schema["value"].dataType.fields
    if len(fields) != len(names):
        raise ValueError(f"{checkpoint} holds {len(fields)} sums a window, not {len(names)}")
    renamed = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, fields, strict=True)])
    key = rows.schema["key"].dataType.fieldNames()
    window = F.col("key")[key[0]]
    named = rows.select(
        window["start"].alias("window_start"),
        window["end"].alias("window_end"),
        *[F.col("key")[k].alias(k) for k in spec.key_names],
        F.col("value").cast(renamed).alias("v"),
    ).select("*", "v.*")
    days: Column = reduce(add, [F.bit_count(f"word_{i}") for i in range(words)]).cast("long")
    shown: Sequence[Column | str] = ["window_start", "window_end", *spec.key_names, *spec.metrics, *holes]
    return named.select(*shown, days.alias("days_seen"), "last_report")
