"""The two classifiers on held-out labels, and the pipeline from end to end."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from epigauge.llm import quality, toxicity
from epigauge.llm.queries import QUERIES, held_out

SF = "/root/testdata/sf0.01"
ODD = [(1, "", None), (2, None, "x"), (3, "ok " * 80_000, "x"), (4, "漢字 \n\n", "x"), (None, "nobody", "x"), (1, "", None)]


@pytest.mark.parametrize(
    ("name", "label", "least"), [("op1_pairwise_quality", "quality", 0.95), ("op4_ngram_toxicity", "toxic", 0.9)]
)
def test_held_out_accuracy(spark, name, label, least):
    got = QUERIES[name](spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", label)
    known = got.filter("held_out").join(labels, "doc_id").select("score", "predicted", label).toPandas()
    assert (known["predicted"] == known[label]).mean() >= least
    assert got.filter("score is null or score < 0 or score > 1 or isnan(score)").count() == 0
    assert got.filter((F.col("score") >= 0.5) != (F.col("predicted") == 1)).count() == 0


@pytest.mark.parametrize(("module", "label"), [(quality, "quality"), (toxicity, "toxic")])
def test_odd_texts_and_labels(spark, module, label):
    docs = spark.createDataFrame([(*r, 1, "l") for r in ODD], "doc_id long, text string, source string, label int, labelled string")
    schema = "doc_id long, quality int, toxic int"
    # None at all, one label only, disagreeing and null ones: no model, every score is one half.
    for rows in ([], [(3, 1, 1)], [(3, 1, 1), (3, 0, 0), (None, 0, 0), (4, None, None), (4, 7, 7)]):
        model = module.fit(docs, spark.createDataFrame(rows, schema))
        scores = [r["s"] for r in docs.select(model.score(F.col("text")).alias("s")).collect()]
        assert scores == [0.5] * len(ODD)
    both = spark.createDataFrame([(3, 1, 1), (4, 0, 0), (1, 0, 0), (3, 1, 1)], schema)
    model = module.fit(docs, both)
    scores = [r["s"] for r in docs.select(model.score(F.col("text")).alias("s")).collect()]
    assert len(scores) == len(ODD) and all(0 <= s <= 1 for s in scores)
    assert docs.limit(0).select(model.score(F.col("text"))).count() == 0


def test_pairs_are_between_labels(spark):
    rows = spark.createDataFrame([(i, int(i % 5 > 0), [float(i % 5 > 0), float(i)]) for i in range(50)], "doc_id long, label int, features array<double>")
    pairs = quality.preference_pairs(rows, {0: 10, 1: 40}, opponents=3).collect()
    assert len(pairs) == 50 * 3 and all(p["won"][0] == 1.0 and p["lost"][0] == 0.0 for p in pairs)


def test_the_cut_is_a_quantile(spark):
    docs = spark.createDataFrame([(i, ("fine words here. " if i % 4 else "BAD!! ") * (5 + i % 7)) for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(200)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    scores = docs.withColumn("s", model.score(F.col("text"))).toPandas()
    assert ((scores["s"] >= 0.5) == (scores["doc_id"] % 4 > 0)).all()


def test_ngrams_ignore_case_and_cover_long_texts():
    assert (toxicity.bins("AbC dEf") == toxicity.bins("abc def")).all()
    assert len(toxicity.bins("")) == 0 and len(toxicity.bins("a")) == 1
    long = "x" * 100_000
    assert len(toxicity.bins(long)) == sum(len(long) + 2 - n + 1 for n in toxicity.LENGTHS)
    assert set(toxicity.bins("idiot")) <= set(toxicity.bins("so idiot so")) and np.all(toxicity.bins("idiot") < 1 << toxicity.BITS)


def test_folds_are_as_asked(spark):
    import zlib

    got = spark.range(100).withColumnRenamed("id", "doc_id").withColumn("out", held_out(1, 3)).collect()
    assert all(r["out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)


def test_pipeline(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    seen, columns = [docs.count()], docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        seen.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    assert seen[0] > seen[1] > seen[2] >= seen[3]
    by_run = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    key = ["doc_id", "piece", "length", "ids_crc32"]
    assert sorted(map(tuple, by_run.select(*key).collect())) == sorted(map(tuple, docs.select(*key).collect()))
    assert by_run.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0


def test_near_dedup_stage_links_from_four_fifths_on(spark):
    """Pairs of 200 sequences each that differ in 20 (0.82) or 40 (0.67)."""
    rows = []
    for p in range(30):
        base = [f"p{p}w{i}" for i in range(204)]
        edits = (10, 60, 110, 160) if p < 20 else (10, 35, 60, 85, 110, 135, 160, 185)
        rows.append((2 * p, " ".join(base), "en", "a", 1))
        rows.append((2 * p + 1, " ".join(w if i not in edits else "new" for i, w in enumerate(base)), "en", "a", 1))
    for p, shared in ((0, 180), (20, 160)):
        one, other = ({tuple(t.split()[i : i + 5]) for i in range(200)} for t in (rows[2 * p][1], rows[2 * p + 1][1]))
        assert (len(one & other), len(one | other)) == (shared, 400 - shared)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stay = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    assert stay == {2 * p for p in range(30)} | {2 * p + 1 for p in range(20, 30)}


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
    assert docs.count() == 0
