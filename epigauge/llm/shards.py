"""Sharding by jump consistent hashing: a stable key and the shard count decide, no ring table."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from epigauge.llm.common import free_name, number_within, text_of
from epigauge.session import materialise

#: The multiplier of the published jump hash generator (fixed value).
STEP = np.uint64(2862933555777941757)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key; going from n to n + 1 shards moves 1 / (n + 1) of the keys, all to shard n."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = keys.astype(np.int64).view(np.uint64).copy()
    shard = np.zeros(len(state), np.int64)
    open_rows = np.arange(len(state))
    here = shard.copy()
    while len(open_rows):
        shard[open_rows] = here
        state[open_rows] = state[open_rows] * STEP + np.uint64(1)
        draw = (state[open_rows] >> np.uint64(33)).astype(np.float64) + 1.0
        nxt = np.floor((here + 1) * (2.0**31 / draw)).astype(np.int64)
        still = nxt < shards
        open_rows, here = open_rows[still], nxt[still]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a row with this key (any type; a null key is a key like any other)."""

    @pandas_udf("int")
    def of(hashed: pd.Series) -> pd.Series:
        return pd.Series(jump(hashed.to_numpy(), shards).astype(np.int32))

    return of(F.xxhash64(key))


def assign(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row.

    Size is the text's UTF-8 bytes plus 1 (null text: 1, checksum of nothing). Law ``key``: equal ids share a
    shard whatever their texts; a null id hashes like any key. Slots run 0, 1, 2, ... in each shard. Repeated
    rows each get a slot. Other columns are not looked at. An empty table gives an empty one.
    """
    text = text_of(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col(id_col), shards).alias("shard"),
        shard_of(F.col(id_col), shards + 1).alias("grown_shard"),
    )
    rows = materialise(rows, "shards")
    placed = number_within(rows, ["shard"], ["doc_id", "text_crc32"], "slot", rows.count())
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, shards: int, path: str, id_col: str = "doc_id", parts: int = 8) -> None:
    """Write whole rows as Parquet under ``path``, one folder per shard; appending a shard moves rows only into it.

    A shard is written by ``parts`` tasks, so that none of them holds a whole shard.
    """
    shard = free_name(docs, "shard")
    part = F.pmod(F.xxhash64(F.lit(1), F.col(id_col)), F.lit(parts))
    placed = docs.withColumn(shard, shard_of(F.col(id_col), shards))
    placed.repartition(shards * parts, F.col(shard), part).write.partitionBy(shard).parquet(path)
