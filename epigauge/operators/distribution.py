"""Shape of a score column: histogram and smoothed density, without collecting the scores."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from epigauge.functions.numeric import is_finite


#: Bins that scores are counted in, per bandwidth of the density.
BINS_PER_BANDWIDTH = 256
#: Error of the density times its bandwidth: an eighth of the bin's square times the largest curvature of the kernel.
DENSITY_ERROR = 0.4 / 8 / BINS_PER_BANDWIDTH**2
#: Bandwidths beyond which a kernel is nothing in double precision.
REACH = 9.0


def histogram(df: DataFrame, score: str, bins: int = 30) -> DataFrame:
    """Equal-width bins from minimum to maximum, empty ones included, the maximum in the last bin.

    If all scores are equal the range is half a unit to each side of the value.
    """
    scores = df.where(is_finite(score)).select(F.col(score).alias("x"))
    ends = scores.agg(F.struct(F.min("x").alias("low"), F.max("x").alias("high"))).scalar()
    low, high = ends["low"], ends["high"]
    left = F.when(low == high, low - F.lit(0.5)).otherwise(low)
    width = F.when(low == high, F.lit(1.0)).otherwise(high - low) / F.lit(float(bins))
    counts = (
        scores.select(F.least(F.floor((F.col("x") - left) / width), F.lit(bins - 1)).cast("long").alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("n"))
    )
    frame = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return frame.join(counts, "bin", "left").select(
        "bin",
        (left + F.col("bin") * width).alias("lower_bound"),
        (left + (F.col("bin") + 1) * width).alias("upper_bound"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def density(df: DataFrame, score: str, points: int = 200) -> DataFrame:
    """Gaussian kernel density on an even grid from minimum to maximum, bandwidth by Scott's rule.

    Scores are counted in bins of 1 / :data:`BINS_PER_BANDWIDTH` bandwidth, each split linearly between the two ends of its bin; only
    these counts are shuffled, and kernels are worked out for bins, not for scores. A density is wrong by less than
    :data:`DENSITY_ERROR` over the bandwidth. If all scores are equal (or there is one) the grid is half a unit to each side
    and the deviation counts as one. No scores give no points.
    """
    scores = df.where(is_finite(score)).select(F.col(score).cast("double").alias("x"))
    some = F.coalesce(F.stddev_samp("x"), F.lit(0.0))
    facts = scores.agg(F.min("x").alias("low"), F.max("x").alias("high"), F.count("x").alias("n"), some.alias("s"))
    flat = (F.col("low") == F.col("high")) | (F.col("s") == 0)
    shape = facts.where("n > 0").select(
        F.struct(
            F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
            F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
            (F.when(flat, F.lit(1.0)).otherwise(F.col("s")) * F.pow(F.col("n").cast("double"), F.lit(-0.2))).alias("h"),
            "n",
        )
    )
    f = shape.scalar()  # one row; worked out once
    at = (F.col("x") - F.col("f.low")) / (F.col("f.h") / BINS_PER_BANDWIDTH)
    placed = scores.withColumn("f", f).select((at - at % 1).alias("bin"), (at % 1).alias("part"))
    counts = placed.groupBy("bin").agg(F.count("*").alias("n"), F.sum("part").alias("parts"))
    ends = F.inline(
        F.array(
            F.struct(F.col("bin").alias("end"), (F.col("n") - F.col("parts")).alias("weight")),
            F.struct((F.col("bin") + 1).alias("end"), F.col("parts").alias("weight")),
        )
    )
    step = (F.col("f.high") - F.col("f.low")) / F.lit(float(points - 1))
    bins = counts.select(ends).withColumn("f", f)
    bins = bins.withColumns({"t": F.col("f.low") + F.col("end") * (F.col("f.h") / BINS_PER_BANDWIDTH), "step": step})
    reach = F.col("f.h") * REACH
    first = F.greatest(F.lit(0.0), (F.col("t") - reach - F.col("f.low")) / F.col("step"))
    last = F.least(F.lit(float(points - 1)), (F.col("t") + reach - F.col("f.low")) / F.col("step"))
    near = F.when(F.ceil(first) <= F.floor(last), F.sequence(F.ceil(first), F.floor(last)))
    each = bins.select("t", "weight", "f", "step", F.explode(near).alias("point"))
    away = (F.col("f.low") + F.col("point") * F.col("step") - F.col("t")) / F.col("f.h")
    whole = F.col("f.n") * F.col("f.h") * F.lit(math.sqrt(2 * math.pi))
    sums = each.groupBy("point").agg(F.sum(F.col("weight") * F.exp(F.lit(-0.5) * away * away) / whole).alias("density"))
    grid = df.sparkSession.range(points).withColumnRenamed("id", "point").withColumn("f", f).where("f is not null")
    return grid.join(sums, "point", "left").select(
        F.col("point").cast("int").alias("point"),
        (F.col("f.low") + F.col("point") * step).alias("at"),
        F.coalesce("density", F.lit(0.0)).alias("density"),
    )
