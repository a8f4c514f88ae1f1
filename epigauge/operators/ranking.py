"""Rank over a whole table without bringing it, or all rows of one score, into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from epigauge.session import materialise


def rank_descending(df: DataFrame, score: str, name: str = "rank") -> DataFrame:
    """Add the competition rank of ``score`` (1 = greatest, equal scores share a rank).

    Ranges of the rows in falling order go to tasks; rows of one score are dealt over several by a hash of the row. A row
    ranks behind all rows of the ranges before its own and the greater ones in it. Only scores at the ends of a range
    can stand in other ranges too: the first range that holds such a score tells how many rows are above it. There are as
    many ranges as shuffle partitions, and nothing else is sent to all tasks. Null scores get a null rank.
    """
    told = df.where(F.col(score).isNotNull())
    ranged = told.repartitionByRange(F.desc(score), F.xxhash64(*df.columns)).withColumn("range_", F.spark_partition_id())
    ranged = materialise(ranged, "rank")
    ends = ranged.groupBy("range_").agg(F.count("*").alias("rows"), F.max(score).alias("most"), F.min(score).alias("least"))
    ends = materialise(ends, "ranges")  # one row per range, here and below
    at_least = ranged.join(F.broadcast(ends), "range_").groupBy("range_").agg(F.count_if(F.col(score) == F.col("least")).alias("lowest"))
    upto = Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("rows").over(upto), F.lit(0).cast("long"))
    ranges = ends.join(at_least, "range_").withColumn("start", start)
    seen = ranges.select(F.col("least").alias("value"), (F.col("start") + F.col("rows") - F.col("lowest")).alias("above_it"))
    seen = seen.unionByName(ranges.select(F.col("most").alias("value"), F.col("start").alias("above_it")))
    seen = seen.groupBy("value").agg(F.min("above_it").alias("above_most"))
    ranges = ranges.join(seen, F.col("most") == F.col("value")).select("range_", "start", "most", "above_most")
    here = F.rank().over(Window.partitionBy("range_").orderBy(F.desc(score))) - F.lit(1)
    within = ranged.withColumn("here", here).join(F.broadcast(ranges), "range_")
    above = F.when(F.col(score) == F.col("most"), F.col("above_most")).otherwise(F.col("start") + F.col("here"))
    ranked = within.select(*df.columns, (above + 1).cast("long").alias(name))
    rest = df.where(F.col(score).isNull()).select("*", F.lit(None).cast("long").alias(name))
    return ranked.unionByName(rest)
