"""Train/test split and classifier quality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def split_bucket(keys: Sequence[Column]) -> Column:
    """0..99 from the row's key: the same row gets the same bucket whatever the partitioning."""
    text = F.concat_ws("|", *keys)
    return F.pmod(F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long"), F.lit(100))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def quality(matrix: DataFrame) -> DataFrame:
    """Accuracy, and precision, recall and F1 weighted by class size, from a confusion matrix."""
    none = F.lit(0).cast("long")
    hits = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(none)
    sides = F.array(
        F.struct(F.col("label").alias("c"), F.col("n").alias("actual"), none.alias("named"), hits.alias("hits")),
        F.struct(F.col("prediction").alias("c"), none.alias("actual"), F.col("n").alias("named"), none.alias("hits")),
    )
    classes = (
        matrix.select(F.inline(sides))
        .groupBy("c")
        .agg(F.sum("actual").alias("actual"), F.sum("named").alias("named"), F.sum("hits").alias("hits"))
    )
    precision = F.when(F.col("named") > 0, F.col("hits") / F.col("named")).otherwise(0.0)
    recall = F.when(F.col("actual") > 0, F.col("hits") / F.col("actual")).otherwise(0.0)
    f1 = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    rows = F.sum("actual")
    return classes.agg(
        rows.alias("rows"),
        (F.sum("hits") / rows).alias("accuracy"),
        (F.sum(precision * F.col("actual")) / rows).alias("weighted_precision"),
        (F.sum(recall * F.col("actual")) / rows).alias("weighted_recall"),
        (F.sum(f1 * F.col("actual")) / rows).alias("weighted_f1"),
    )
