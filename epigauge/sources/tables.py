"""Batch tables: Parquet and CSV, with declared schemas and a column guard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T


def read_parquet(spark: SparkSession, path: str, needs: Sequence[str] = ()) -> DataFrame:
    return require_columns(spark.read.parquet(path), needs, path)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, needs: Sequence[str] = ()
) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, which reads the files twice."""
    reader = spark.read.option("header", True)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return require_columns(reader.csv(path), needs, path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def require_columns(df: DataFrame, needs: Sequence[str], origin: str = "the table") -> DataFrame:
    missing = [c for c in needs if c not in df.columns]
    if missing:
        raise ValueError(f"{origin} lacks the column(s) {', '.join(missing)}")
    return df


def preview(df: DataFrame, keys: Sequence[str], rows: int = 5) -> DataFrame:
    """The first rows in key order (a top-k, so no full sort)."""
    return df.orderBy(*keys).limit(rows)
