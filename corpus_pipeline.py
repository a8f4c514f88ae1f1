"""From raw documents to packed training sequences, one operator after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epigauge.llm import exact, minhash, mixing, packing, quality
from epigauge.llm.common import table
from epigauge.llm.queries import public_vocabulary
from epigauge.session import inner_tables, run_dir


#: Rows that go to Python at once. Texts are long: batches of the usual size take hundreds of MB in each worker and beside it.
ROWS_PER_BATCH = "1000"


def small_batches(spark: SparkSession) -> None:
    """The pipeline's session hands rows to Python in small batches, from here on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that rank below the cut of the labelled ones go.

    Null and empty texts are scored as they are; texts are scored whole; repeated rows go or stay together; of an empty table
    nothing stays.
    """
    small_batches(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.filter(model.score(F.col("text")) >= 0.5)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays: the smallest id, null ids last, of repeated rows any.

    Null and empty texts are one group; texts are compared whole; an empty table stays empty.
    """
    small_batches(spark)
    return exact.dedup(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts stays; 24 bands of 5 miss a pair of similarity 0.8 once in 14,000.

    Null and empty texts resemble nothing and stay; very long texts are compared whole; rows that share an id, or have none, are
    decided by their text; an empty table stays empty.
    """
    small_batches(spark)
    return minhash.dedup(docs, minhash.NearDup(words=5, percent=80, bands=24, rows=5))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as its source's share of the words asks for.

    A null source is one of its own, last in order; rows without words weigh nothing; repeated rows, and rows that share an id or
    have none, are rows of their own; an empty table stays empty.
    """
    small_batches(spark)
    return mixing.resample(docs, weights=(3, 1, 2), share=1.5, cap=2)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in sequences of 2048 tokens.

    A null or empty text is its end token alone; long texts are cut; a repeated row has pieces of its own; an empty table gives none.
    """
    small_batches(spark)
    return packing.pack_documents(docs, public_vocabulary(), capacity=2048)


STAGES = [
    ("quality classifier", quality_filter),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("source mix", source_mix),
    ("sequence packing", sequence_packing),
]

#: A fitted classifier and the merge rules of a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again; a stage's inner tables go when it is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = run_dir(spark, name.replace(" ", "-"))
        with inner_tables(spark):
            done = stage(spark, docs, sf_dir)
            done.write.parquet(path)
        docs = spark.read.schema(done.schema).parquet(path)
    return docs
