"""JSON records: encode, decode, and set aside what cannot be used.

The same functions run on batch and streaming frames.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from epigauge.functions.numeric import finite_or_null
from epigauge.spec import IndicatorSpec


#: Tasks over which a stream deals the copies of one report.
COPY_TASKS = 16


def encode(df: DataFrame, spec: IndicatorSpec, keep: Sequence[str] = ()) -> DataFrame:
    """One JSON text per row, as a message source would carry it, beside the columns to keep."""
    return df.select(F.to_json(F.struct(*spec.record_schema().fieldNames())).alias("value"), *keep)


def event_time(text: Column, pattern: str) -> Column:
    """Parse a date text; what does not match the pattern gives null, also under ANSI mode."""
    return F.try_to_timestamp(text, F.lit(pattern))


def decode(raw: DataFrame, spec: IndicatorSpec, value: str = "value", fields: str | None = None) -> DataFrame:
    """Typed columns, event time and ``reject_reason`` (null for a usable record).

    With ``fields`` a VARIANT column of that name holds the whole record, what the schema does not know included; it is
    null for what is no strict JSON (see :func:`field`).

    NaN and infinite numbers are turned into null, since one of them would spoil a whole window's sum. A
    number that does not parse is null too, and the record is kept. Event times are held against the
    column ``arrived`` if the source gives one, else against the present.
    """
    schema = spec.record_schema()
    arrived = F.col("arrived") if "arrived" in raw.columns else F.current_timestamp()
    text = raw.select(F.col(value).cast("string").alias("raw"), arrived.alias("came"))
    known = _computed_once(text, F.from_json("raw", schema))
    time = event_time(F.col(spec.time_text), spec.time_format)
    timed = _computed_once(known, F.struct(time.alias(spec.time)))
    doubles = {f.name for f in schema if f.dataType.typeName() == "double"}
    typed = timed.select(
        "raw",
        "came",
        *[finite_or_null(n).alias(n) if n in doubles else F.col(n) for n in schema.fieldNames()],
        spec.time,
    )
    judged = typed.withColumn("reject_reason", _reject_reason(spec)).drop("came")
    return judged.withColumn(fields, F.try_parse_json("raw")) if fields else judged


def field(fields: str | Column, path: str, kind: str) -> Column:
    """One field of a record by its path (``$.a.b[0]``); null if it is not there or not of that kind."""
    return F.try_variant_get(F.col(fields) if isinstance(fields, str) else fields, path, kind)


def _computed_once(df: DataFrame, fields: Column) -> DataFrame:
    """Add the fields of a struct that is dear to compute.

    A filter on a plain column is moved below it and would compute it a second time; it is not
    moved below ``inline``.
    """
    return df.select("*", F.inline(F.array(fields)))


def _reject_reason(spec: IndicatorSpec) -> Column:
    keys_present = reduce(and_, [F.col(k).isNotNull() for k in spec.key_names])
    nothing_read = reduce(and_, [F.col(c).isNull() for c in spec.record_schema().fieldNames()])
    time = F.col(spec.time)
    return (
        F.when(nothing_read, F.lit("bad_json"))
        .when(time.isNull(), F.lit("bad_time"))
        .when(time < F.lit(spec.earliest).cast("timestamp"), F.lit("too_old"))
        .when(time > F.col("came") + F.expr(f"INTERVAL {spec.lead}"), F.lit("future_time"))
        .when(~keys_present, F.lit("missing_key"))
    )


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reject_reason").isNull()).drop("raw", "reject_reason")


def rejected(decoded: DataFrame) -> DataFrame:
    """The text of each record that cannot be used, why, and its fields if they were asked for."""
    fields = [f.name for f in decoded.schema if f.dataType.typeName() == "variant"]
    return decoded.where(F.col("reject_reason").isNotNull()).select("raw", "reject_reason", *fields)


def drop_redelivered(reports: DataFrame, spec: IndicatorSpec) -> DataFrame:
    """Keep one report per (event time, keys), for a source that may send a report twice.

    A batch drops copies before its shuffle. On a stream the copies of a report are first dealt out by the task
    they came in with, so that one that is sent a great many times does not send all its copies to
    one task. A stream must be watermarked: that bounds what has to be remembered.
    """
    identity = [spec.time, *spec.key_names]
    if not reports.isStreaming:
        return reports.dropDuplicates(identity)
    dealt = reports.withColumn("came_with", F.spark_partition_id() % COPY_TASKS)
    thinned = dealt.dropDuplicatesWithinWatermark([*identity, "came_with"]).drop("came_with")
    return thinned.dropDuplicatesWithinWatermark(identity)
