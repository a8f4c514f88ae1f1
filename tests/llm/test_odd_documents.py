"""Null and repeated ids, odd texts and columns with clashing names, through every stage and operator on documents."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from epigauge.llm import chat, exact, mixing, shards
from epigauge.session import children, inner_tables, materialise, tables_dir

SF = "/root/testdata/sf0.001"
CLASHING = "Node long, key string, bucket int, size long, copies int, time string, digest binary, keep_id int, kept int, root long, Text_code string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
VERY_LONG = 400_000


def odd(spark, n=60):
    rng = random.Random(8)
    words = [f"word{i}" for i in range(900)]
    texts = [" ".join(rng.choices(words, k=120)) + "." for _ in range(n)]
    rows = [(i if i % 3 else None, t, "en", "s", 1) for i, t in enumerate(texts)]
    rows += [(7, texts[0], "en", "s", 1), (7, texts[1], None, None, None), (None, texts[0], "en", None, 1)]
    rows += [(5, texts[5], "en", "s", 1)] * 2 + [(None, None, None, None, None)] * 3 + [(90, "", "en", "", 0), (91, " \n\t ", "en", "s", 1)]
    rows += [(92, "long " * (VERY_LONG // 5), "en", "s", 1), (None, "ü" * VERY_LONG, "en", "t", 1)]
    filler = (1, "k", 2, 3, 4, "t", b"d", 5, 6, 7, "c")
    return spark.createDataFrame([(*r, *filler) for r in rows], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def docs(spark):
    return odd(spark).persist()


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_a_stage_takes_odd_documents(spark, docs, name, stage):
    out = stage(spark, docs, SF)
    n = out.count()
    if name == "sequence packing":
        assert n >= docs.count()
        assert out.agg(F.sum("length")).first()[0] > VERY_LONG // 5
        assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
        return
    assert out.columns == docs.columns
    if name == "exact dedup":
        texts = {r["t"] for r in docs.select(exact.normal(F.col("text")).alias("t")).collect()}
        assert sorted(r["t"] for r in out.select(exact.normal(F.col("text")).alias("t")).collect()) == sorted(texts)
    elif name == "near dedup":
        texts = [r["text"] for r in out.collect() if (r["text"] or "").strip()]
        assert len(texts) == len(set(texts)) and n == len(texts) + 5  # texts without words all stay
    elif name == "source mix":
        per_row = out.groupBy("doc_id", "text", "source").count().agg(F.max("count")).first()[0]
        assert n > 0 and per_row <= 6  # one very long text is most of its source
    else:
        assert 0 < n <= docs.count()


def test_the_stages_one_after_the_other(spark, docs):
    now = docs
    for _, stage in corpus_pipeline.STAGES:
        now = materialise(stage(spark, now, SF), "test")
    assert now.count() > 60


def test_very_long_texts_in_operators_without_python(docs):
    groups = exact.exact_groups(docs).where(F.col("doc_id") == 92).collect()
    assert [(g["group_size"], g["kept"]) for g in groups] == [(1, True)]
    dealt = shards.assign(docs, shards=4)
    assert dealt.where(f"size = {VERY_LONG + 1}").count() == 1 and dealt.where(f"size = {2 * VERY_LONG + 1}").count() == 1
    mixed = mixing.mix(docs).where(F.col("doc_id") == 92).first()
    assert mixed["size"] == VERY_LONG // 5


def test_inner_tables_go_with_their_scope(spark, docs):
    before = set(children(spark, tables_dir(spark)))
    with inner_tables(spark):
        assert exact.dedup(docs).count() > 0
        assert set(children(spark, tables_dir(spark))) > before
    assert set(children(spark, tables_dir(spark))) == before
    with pytest.raises(RuntimeError, match="inside"), inner_tables(spark):
        materialise(docs.select("doc_id"), "lost")
        raise RuntimeError("inside")
    assert set(children(spark, tables_dir(spark))) == before


def test_stored_chats_are_read_in_order(spark, tmp_path):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} of {c} [INST] " * 5) for c in range(20) for t in range(600 if c == 3 else 4)]
    rows += [(None, 0, "user", "nobody"), (None, 1, "assistant", None)]
    made = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    want = sorted(map(tuple, chat.read_back(made).collect()), key=repr)
    made.repartition(7, F.rand(1)).write.parquet(f"{tmp_path}/chats")
    stored = spark.read.parquet(f"{tmp_path}/chats")
    assert stored.groupBy("conv_id").count().agg(F.max("count")).first()[0] > 1
    assert sorted(map(tuple, chat.read_back(chat.in_order(stored)).collect()), key=repr) == want and len(want) == 21
