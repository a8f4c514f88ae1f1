"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` columns per key; rows with a null key are left out.

    An aggregate, not a ranking window: each task reduces its rows to one per key before the
    shuffle, so a key with very many versions stays cheap.
    """
    others = [c for c in df.columns if c not in keys]
    newest = (
        df.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.max_by(F.struct(*others), F.struct(*order)).alias("newest"))
    )
    return newest.select(*keys, "newest.*").select(*df.columns)
