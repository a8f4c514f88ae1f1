"""Sketches of a table that can be merged: how many keys there are, and how the scores lie."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from epigauge.functions.numeric import is_finite

#: Size of a distinct-count sketch (2 to this power) and of a quantile sketch.
KEY_BITS, SCORE_SIZE = 12, 400
#: Quantiles from which ranks are read.
GRID = 1_000
#: With these sizes: the share of the keys by which the count may be wrong (three deviations), and the share of the
#: rows by which a rank may be wrong.
KEY_ERROR, RANK_ERROR = 3 * 1.04 / 2 ** (KEY_BITS / 2), 0.01


def sketched(rows: DataFrame, key: str, score: str) -> DataFrame:
    """One row: ``keys`` and ``scores`` as sketches, ``rows``, and the exact ends of the scores. Scores that are no number count as rows only."""
    value = F.when(is_finite(score), F.col(score).cast("double"))
    return rows.agg(
        F.hll_sketch_agg(F.col(key).cast("string"), F.lit(KEY_BITS)).alias("keys"),
        F.kll_sketch_agg_double(value, F.lit(SCORE_SIZE)).alias("scores"),
        F.count("*").alias("rows"),
        F.count(value).alias("scored"),
        F.min(value).alias("least"),
        F.max(value).alias("most"),
    )


def merged_sketches(parts: DataFrame) -> DataFrame:
    """The same row for all parts together, in any order and grouping; no row for no parts."""
    merged = parts.agg(
        F.hll_union_agg("keys").alias("keys"),
        F.kll_merge_agg_double("scores").alias("scores"),
        F.sum("rows").alias("rows"),
        F.sum("scored").alias("scored"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
    )
    return merged.where(F.col("rows").isNotNull())


def keys_in(sketches: str | Column = "keys") -> Column:
    """How many different keys there are, to within :data:`KEY_ERROR`; exact for few."""
    return F.hll_sketch_estimate(sketches)


def quantiles(merged: DataFrame, shares: Sequence[float]) -> DataFrame:
    """``share, score``: the score below which that share of the scores lies, to within :data:`RANK_ERROR` of them."""
    asked = F.array(*[F.lit(float(s)) for s in shares])
    both = F.arrays_zip(asked.alias("share"), F.kll_sketch_get_quantile_double("scores", asked).alias("score"))
    return merged.where("scored > 0").select(F.inline(both).alias("share", "score"))


def histogram_of(merged: DataFrame, bins: int = 30) -> DataFrame:
    """``bin, lower_bound, upper_bound, n`` as the exact histogram has them, with counts from the sketch.

    The edges are exact. A count is the difference of two ranks, each read off :data:`GRID` quantiles: it is wrong by
    2 x (:data:`RANK_ERROR` + 1 / :data:`GRID`) of the scores at most.
    """
    shares = F.array(*[F.lit((i + 0.5) / GRID) for i in range(GRID)])
    one = merged.where("scored > 0").select(
        "least", "most", "scored", F.kll_sketch_get_quantile_double("scores", shares).alias("grid")
    )
    same = F.col("least") == F.col("most")
    low = F.when(same, F.col("least") - 0.5).otherwise(F.col("least"))
    width = F.when(same, F.lit(1.0)).otherwise(F.col("most") - F.col("least")) / F.lit(float(bins))
    each = one.select("*", low.alias("low"), width.alias("width"), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    edges = each.withColumns(
        {"lower_bound": F.col("low") + F.col("bin") * F.col("width"), "upper_bound": F.col("low") + (F.col("bin") + 1) * F.col("width")}
    )

    def below(edge: str) -> Column:
        return F.size(F.filter("grid", lambda x: x < F.col(edge)))

    upto = F.when(F.col("bin") == bins - 1, F.lit(GRID)).otherwise(below("upper_bound"))
    share = (upto - F.when(F.col("bin") == 0, F.lit(0)).otherwise(below("lower_bound"))) / F.lit(float(GRID))
    n = F.round(share * F.col("scored")).cast("long")
    return edges.select(F.col("bin").cast("long").alias("bin"), "lower_bound", "upper_bound", n.alias("n"))
