"""Cleaning of an indicator table: numeric columns, all-zero rows, rows with holes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from epigauge.functions.numeric import all_present, any_nonzero
from epigauge.spec import CALENDAR, IndicatorSpec


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Names of all numeric columns but the excluded (key) ones."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def indicator_columns(df: DataFrame, spec: IndicatorSpec, exclude: Sequence[str] = ()) -> list[str]:
    """The metrics of a table: those of the feed if it has them all, else its numeric columns.

    Keys, calendar columns and the excluded ones are no metrics: a year is never zero.
    """
    if set(spec.metrics) <= set(df.columns):
        return [m for m in spec.metrics if m not in exclude]
    return numeric_columns(df, exclude=[*spec.key_names, *CALENDAR, *exclude])


def keep_nonzero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(any_nonzero(columns))


def cleaning_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows before, after and removed, from one pass."""
    counts = df.agg(
        F.count("*").alias("rows_before"),
        F.count_if(any_nonzero(columns)).alias("rows_after"),
    )
    return counts.withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def column_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per numeric column: how many values are nonzero and how many are missing, from one pass."""
    wide = df.agg(
        *[F.count_if(F.col(c) != 0).alias(f"nonzero_{i}") for i, c in enumerate(columns)],
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{i}") for i, c in enumerate(columns)],
    )
    per_column = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"nonzero_{i}").alias("nonzero_rows"),
                F.col(f"missing_{i}").alias("missing_rows"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return wide.select(F.inline(per_column))


def keep_complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows in which a column is null, NaN or infinite."""
    return df.where(all_present(columns))


def completeness_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counts = df.agg(
        F.count("*").alias("rows_seen"),
        F.count_if(all_present(columns)).alias("rows_kept"),
    )
    return counts.withColumn("rows_skipped", F.col("rows_seen") - F.col("rows_kept"))
