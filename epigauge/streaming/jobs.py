"""Streaming queries: windowed sums to the prediction log, rejected records to their own folder."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from epigauge.functions.numeric import all_present
from epigauge.operators.windows import to_full_window, watermarked, window_sums
from epigauge.session import ROCKSDB
from epigauge.sources.records import accepted, decode, drop_redelivered, rejected
from epigauge.spec import HEALTH, IndicatorSpec
from epigauge.streaming.log import PredictionLog

ROWS_PER_FILE = 500_000


@dataclass(frozen=True)
class StreamOptions:
    """``every`` is a processing interval; None works off what is there and stops.

    ``state_partitions`` counts at the first start on a checkpoint, which keeps it: choose it for the
    largest cluster the job will have. None takes ``spark.sql.shuffle.partitions``, whatever cores there are
    at that moment. ``rocksdb`` keeps this query's state off the heap; operators with states of their own need it.
    """

    checkpoint: str
    name: str | None = None
    every: str | None = None
    state_partitions: int | None = None
    rocksdb: bool = False

    def start(self, spark: SparkSession, writer: DataStreamWriter) -> StreamingQuery:
        wanted = {"spark.sql.shuffle.partitions": self.state_partitions} if self.state_partitions else {}
        if self.rocksdb:
            wanted |= ROCKSDB
        general = {key: spark.conf.get(key, None) for key in wanted}
        for key, value in wanted.items():
            spark.conf.set(key, value)
        try:
            return self._start(writer)
        finally:
            for key, value in general.items():
                spark.conf.unset(key) if value is None else spark.conf.set(key, value)

    def _start(self, writer: DataStreamWriter) -> StreamingQuery:
        writer = writer.option("checkpointLocation", self.checkpoint)
        if self.name:
            writer = writer.queryName(self.name)
        if self.every:
            return writer.trigger(processingTime=self.every).start()
        return writer.trigger(availableNow=True).start()


def run_id_of(spark: SparkSession, checkpoint: str) -> int:
    """Number of the run a checkpoint belongs to: set at its first start, kept over restarts.

    Batch numbers begin at 0 again with a new checkpoint; the run number keeps such batches apart
    in the log, and later runs have greater numbers.
    """
    marker = f"{checkpoint}/run"
    try:
        kept = spark.read.text(marker).first()
        if kept is not None:
            return int(kept.value)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    run_id = time.time_ns() // 1_000_000
    spark.createDataFrame([(str(run_id),)], "value string").write.mode("overwrite").text(marker)
    return run_id


def start_log(
    rows: DataFrame,
    log: PredictionLog,
    options: StreamOptions,
    output_mode: str = "update",
    score: Callable[[DataFrame], DataFrame] | None = None,
    needed: Sequence[str] = (),
    sketches: tuple[str, str] | None = None,
) -> StreamingQuery:
    """Write a stream's changed rows, scored, to the log, one folder per micro-batch.

    Scoring comes after the stateful step, so what is kept in the checkpoint does not depend on the
    model and a new one can be used from the next start. The changed rows are computed once and scored in as
    many tasks as they came in; rows that miss one of the ``needed`` columns are noted in the log as skipped, and
    ``sketches`` names a key and a score of which the log gets sketches. An empty batch (one follows each move of the watermark)
    writes nothing, others as few files as their rows need. Errors end the query; on restart the batch is
    written again in place.
    """
    run_id = run_id_of(rows.sparkSession, options.checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            holed = ~all_present(needed) if score and needed else F.lit(False)
            changed, left_out = batch.agg(F.count("*"), F.count_if(holed)).first()
            if changed:
                files = 1 + changed // ROWS_PER_FILE
                # A shuffle of the few scored columns: coalescing would score in as few tasks as there are files.
                log.append(score(batch).repartition(files) if score else batch.coalesce(files), run_id, batch_id)
                if left_out:
                    log.append_skipped(batch.where(holed).coalesce(files), run_id, batch_id)
                if sketches:
                    log.append_sketches(batch.sparkSession, run_id, batch_id, *sketches)
        finally:
            batch.unpersist()

    return options.start(rows.sparkSession, rows.writeStream.outputMode(output_mode).foreachBatch(write))


def start_quarantine(decoded: DataFrame, path: str, options: StreamOptions) -> StreamingQuery:
    """Append the records that cannot be used, with the reason, to a Parquet folder."""
    writer = rejected(decoded).writeStream.outputMode("append").format("parquet").option("path", path)
    return options.start(decoded.sparkSession, writer)


def start_surveillance(
    records: DataFrame,
    log: PredictionLog,
    quarantine_path: str,
    checkpoint: str,
    spec: IndicatorSpec = HEALTH,
    score: Callable[[DataFrame], DataFrame] | None = None,
    every: str | None = None,
    once_per_report: bool = False,
    output_mode: str = "update",
    name: str | None = None,
    missing_counts: bool = False,
    full_windows: bool = False,
    state_partitions: int | None = None,
    sketches: tuple[str, str] | None = None,
) -> list[StreamingQuery]:
    """The whole stream: decode, set bad records aside, sum by window, score, log.

    Two queries over one source, each with its own checkpoint. ``once_per_report`` drops reports
    that the source delivers again, ``missing_counts`` logs how many values each sum lacks, ``full_windows`` scales
    partly reported windows before they are scored. Windows that cannot be scored are noted in the log. The number
    of state partitions is fixed by the first start on a checkpoint. If one query cannot start, none runs.
    """
    decoded = decode(records, spec)
    reports = watermarked(accepted(decoded), spec)
    if once_per_report:
        reports = drop_redelivered(reports, spec)

    def options(part: str) -> StreamOptions:
        return StreamOptions(f"{checkpoint}/{part}", f"{name}-{part}" if name else None, every, state_partitions)

    def graded(sums: DataFrame) -> DataFrame:
        return score(to_full_window(sums, spec) if full_windows else sums)

    sums = window_sums(reports, spec, missing_counts)
    first = start_log(sums, log, options("log"), output_mode, graded if score else None, spec.features, sketches)
    try:
        return [first, start_quarantine(decoded, quarantine_path, options("quarantine"))]
    except BaseException:
        first.stop()
        raise


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped behind the watermark, over the micro-batches the session remembers."""
    states = [state for progress in query.recentProgress for state in progress["stateOperators"]]
    return sum(state["numRowsDroppedByWatermark"] for state in states)


def finish(queries: list[StreamingQuery], look_every: float = 1.0) -> None:
    """Wait until all queries have stopped; the first failure of any ends the others and is raised."""
    try:
        running = list(queries)
        while running:
            for query in list(running):
                if query.awaitTermination(look_every):  # raises what ended the query
                    running.remove(query)
    except BaseException:
        for query in queries:
            query.stop()
        raise
