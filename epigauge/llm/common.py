"""Helpers shared by the text operators: input tables, normal forms, gapless numbering."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Blank characters of every contract here: space and U+0009 to U+000D.
BLANKS = r"[ \t-\r]+"
WORDS = r"[^ \t-\r]+"
#: Rows that one numbering task sorts, about.
ROWS_PER_BUCKET = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use yet (names differ by more than case)."""
    used = {c.lower() for c in df.columns}
    while base.lower() in used:
        base = f"_{base}"
    return base


def finite_rows(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The vectors of a column of lists of doubles that hold numbers only: per length, places in the column and a matrix.

    Null vectors and those with a null, NaN or infinite component are left out.
    """
    values = column.values.to_numpy(zero_copy_only=False)  # a null is NaN here
    starts, lengths = column.offsets.to_numpy()[:-1], np.diff(column.offsets.to_numpy())
    there = column.is_valid().to_numpy(zero_copy_only=False)
    for width in np.unique(lengths[there]).tolist():
        at = np.flatnonzero(there & (lengths == width))
        x = values[starts[at][:, None] + np.arange(width)].astype(np.float64)
        whole = np.isfinite(x).all(axis=1)
        if whole.any():
            yield at[whole], x[whole]


def number_within(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    out: str,
    rows: int,
    attach: DataFrame | None = None,
) -> DataFrame:
    """Give the rows of every group the numbers 0, 1, 2, ... without gaps, in column ``out``.

    A group may hold any share of the rows: rows go to hash buckets, are numbered per (group, bucket), and
    the buckets' counts give each one its first number. ``df`` is read twice, so it should be a written
    table. ``rows`` is its row count; ``group`` columns must not be null; ``attach`` (unique by ``group``)
    is joined on the way, on the counts. The same rows get the same numbers at every run; of rows that agree
    in ``order`` any may come first.
    """
    buckets = max(1, -(-rows // ROWS_PER_BUCKET))
    bucket = free_name(df, "bucket")
    dealt = df.withColumn(bucket, F.pmod(F.xxhash64(*order), F.lit(buckets)))
    keys = [*group, bucket]
    first = F.sum("rows_here").over(Window.partitionBy(*group).orderBy(bucket)) - F.col("rows_here")
    counts = dealt.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_here"))
    counts = counts.withColumn("first_here", first).drop("rows_here")
    if attach is not None:
        counts = counts.join(attach, list(group))
    here = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - F.lit(1)
    numbered = dealt.withColumn("number_here", here).join(counts, keys)
    return numbered.withColumn(out, F.col("number_here") + F.col("first_here")).drop("number_here", "first_here", bucket)
