"""Exact dedup by skew-safe combining: local, then by salted digest groups, then over the salts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epigauge.llm.common import BLANKS, free_name, text_of
from epigauge.session import materialise

#: A digest is hot above so many rows, or above one in HOT_DIGESTS of all rows; so at most HOT_DIGESTS are hot.
HOT_ROWS = 1_000
HOT_DIGESTS = 1_000
SALTS = 64


def normal(text: Column) -> Column:
    """Blank runs as one space, null as the empty text."""
    return F.regexp_replace(text_of(text), BLANKS, " ")


def sha(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest_of: Callable[[Column], Column] = sha,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, digest`` for every row.

    Rows whose normal texts are equal form a group; the smallest id stays (null ids last). Texts are compared
    whole at every stage: a digest only deals the rows out. A group that holds a large share of the rows is
    dealt to SALTS tasks and its winners are combined afterwards. Empty and null texts are one group. Of
    repeated rows (same id, same text) one is kept; each counts in ``group_size``. Other columns are not
    looked at. An empty table gives an empty one.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), normal(F.col(text_col)).alias("content"))
    texts = texts.withColumn("digest", digest_of(F.col("content")))
    keys = materialise(texts.select("doc_id", "digest"), "digests")
    rows = keys.count()
    limit = max(hot_rows, rows // HOT_DIGESTS)
    hot = keys.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit)
    hot = materialise(hot.select("digest", F.lit(True).alias("hot")), "hot-digests")

    def salted(df: DataFrame) -> DataFrame:
        marked = df.join(F.broadcast(hot), "digest", "left")  # at most HOT_DIGESTS rows
        spread = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
        return marked.withColumn("salt", F.when(F.col("hot"), spread).otherwise(F.lit(0)).cast("int"))

    # The partial step of this aggregation is the local dedup: one row per content and task is shuffled.
    merged = salted(texts).groupBy("digest", "hot", "salt", "content").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    winners = merged.filter(F.col("hot")).groupBy("digest", "hot", "content").agg(
        F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )
    final = merged.filter(F.col("hot").isNull()).select(*winners.columns).unionByName(winners)
    by_digest = final.groupBy("digest", "hot").agg(
        F.count(F.lit(1)).alias("contents"), F.min("keep_id").alias("keep_id"), F.max("group_size").alias("group_size")
    )
    by_digest = materialise(by_digest, "digest-groups")
    one = by_digest.filter(F.col("contents") == 1)
    salts = F.sequence(F.lit(0), F.when(F.col("hot"), F.lit(SALTS - 1)).otherwise(F.lit(0)))
    one = one.select("digest", "keep_id", "group_size", F.explode(salts).alias("salt"))
    found = salted(keys).join(one, ["digest", "salt"]).select("doc_id", "digest", "keep_id", "group_size")
    clashing = by_digest.filter(F.col("contents") > 1).select("digest")
    if not clashing.isEmpty():  # different texts under one digest: the rows are matched by content
        left = texts.join(clashing, "digest", "left_semi")
        groups = left.groupBy("digest", "content").agg(
            F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
        )
        matched = left.join(groups, ["digest", "content"])
        found = found.unionByName(matched.select("doc_id", "digest", "keep_id", "group_size"))
    repeat = F.row_number().over(Window.partitionBy("doc_id", "digest", "keep_id").orderBy("group_size"))
    first = found.withColumn("repeat", repeat)
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("repeat") == 1)
    return first.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "digest")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    groups = exact_groups(docs, id_col, text_col).groupBy("doc_id", "digest").agg(F.bool_or("kept").alias("kept"), F.count(F.lit(1)).alias("rows"))
    groups = materialise(groups, "decided")
    # Ids of which nothing stays: all that is sent, or moved, beside the texts.
    gone = groups.groupBy(F.col("doc_id").alias("gone_id")).agg(F.bool_or("kept").alias("kept"))
    gone = materialise(gone.filter("not kept").select("gone_id"), "gone-exact")
    left = docs.join(gone, docs[id_col].eqNullSafe(gone["gone_id"]), "left_anti")
    shared = groups.groupBy("doc_id").agg(F.sum("rows").alias("rows")).filter("rows > 1")
    if shared.isEmpty():
        return left
    # Ids that several rows share are decided by text, and rows that stand there twice stay once.
    digest = free_name(docs, "digest")
    marked = left.withColumn(digest, sha(normal(F.col(text_col))))
    part = groups.filter("not kept").select(F.col("doc_id").alias("part_id"), F.col("digest").alias("part_digest"))
    same = marked[id_col].eqNullSafe(part["part_id"]) & (marked[digest] == part["part_digest"])
    return marked.join(part, same, "left_anti").dropDuplicates([id_col, digest]).drop(digest)
