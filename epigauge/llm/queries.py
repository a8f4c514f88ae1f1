"""The text operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epigauge.llm import (
    bytepairs,
    chat,
    exact,
    minhash,
    mixing,
    negatives,
    nndescent,
    packing,
    quality,
    shards,
    suffixes,
    toxicity,
    vectorcodes,
)
from epigauge.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact.exact_groups(table(spark, sf_dir, "documents"))
    return groups.withColumnRenamed("digest", "text_sha256")


@query
def op7_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign(table(spark, sf_dir, "documents"), shards=16)


@query
def op8_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken, "source", "copies")


def held_out(part: int, of: int) -> Column:
    """Whether crc32 of the id as text leaves ``part``; a null id is not held out."""
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % of
    return F.coalesce(rest == part, F.lit(False))


def scored(docs: DataFrame, score: Column, out: Column) -> DataFrame:
    rows = docs.select("doc_id", out.alias("held_out"), score.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op1_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = table(spark, sf_dir, "documents"), held_out(1, 3)
    model = quality.fit(docs, table(spark, sf_dir, "labels").filter(~out))
    return scored(docs, model.score(F.col("text")), out)


@query
def op4_ngram_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = table(spark, sf_dir, "documents"), held_out(0, 5)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(~out))
    return scored(docs, model.score(F.col("text")), out)


@query
def op3_chat_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return chat.read_back(chat.format_chats(rows.unionByName(planted)))


def public_vocabulary() -> packing.Vocabulary:
    """The vocabulary file of the contract, from the installed package of public tokenizers."""
    import public_tokenizers as public

    return packing.Vocabulary(public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)


@query
def op5_complement_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_vocabulary(), capacity=2048)


@query
def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(table(spark, sf_dir, "documents"), minhash.NearDup(words=5, percent=85))


@query
def op9_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nndescent.near_vectors(table(spark, sf_dir, "embeddings"), nndescent.Descent(cosine=0.93))


@query
def op2_cover_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"), suffixes.Repeats(width=100)).drop("kept")


@query
def op11_gnat_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, books = vectorcodes.compress(table(spark, sf_dir, "embeddings"), vectorcodes.Codes(parts=4, entries=256, rounds=4))
    return vectorcodes.with_label_error(found, books)


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", changed)
    return negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0, negatives.Mining(positives=5, negatives=5, least=80))


def public_ranks() -> bytepairs.Ranks:
    """The ranks and the pattern of the contract, from the installed package of public tokenizers."""
    import public_tokenizers as public

    return bytepairs.Ranks(public.path("byte_bpe_50k.tiktoken"), public.PATTERN)


@query
def op13_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytepairs.summary(table(spark, sf_dir, "documents"), public_ranks())
