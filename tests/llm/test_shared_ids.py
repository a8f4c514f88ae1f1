"""Rows that share an id, or have none: decided by what they hold, in time that grows with the rows."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from epigauge.llm import minhash, mixing

WORDS = [f"w{i}" for i in range(4_000)]


def text(rng, n=100):
    return " ".join(rng.choices(WORDS, k=n))


def changed(rng, text):
    words = text.split()
    words[rng.randrange(len(words))] = "changed"
    return " ".join(words)


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, Text_Code string").repartition(4)


@pytest.mark.parametrize("ids", [lambda i: None, lambda i: 7, lambda i: i if i % 2 else None])
def test_near_copies_go_whatever_their_ids(spark, ids):
    rng = random.Random(3)
    firsts = [text(rng) for _ in range(60)]
    rows = [(ids(i), t, "s", "x") for i, t in enumerate(firsts + [changed(rng, t) for t in firsts])]
    rows += [(ids(0), firsts[0], "s", "x"), (ids(0), "", "s", "x"), (ids(0), "", "s", "x"), (ids(0), None, "s", "x")]
    near = minhash.NearDup(percent=80, bands=24, rows=5)
    left = minhash.dedup(documents(spark, rows), near)
    assert left.columns == ["doc_id", "text", "source", "Text_Code"]
    got = left.collect()
    kept = [r["text"] for r in got if r["text"]]
    # One of each two near copies, the empty texts all.
    assert len(kept) == 60 and len(set(kept)) == 60
    assert len({t.replace("changed", "") for t in kept}) == 60
    assert len(got) - len(kept) == 3
    groups = minhash.near_groups(documents(spark, rows), near)
    assert groups.where("kept").count() == 63 and groups.count() == len(rows)


def test_null_ids_take_linear_time(spark):
    """Texts of rows without ids used to meet each other, N x N of them."""
    rng = random.Random(5)
    firsts = [text(rng, 60) for _ in range(4_000)]
    rows = [(None, t, "s", "x") for t in firsts] + [(None, changed(rng, t), "s", "x") for t in firsts]
    docs = documents(spark, rows).persist()
    docs.count()
    begin = time.time()
    assert minhash.dedup(docs, minhash.NearDup(percent=80, bands=24, rows=5)).count() == 4_000
    assert time.time() - begin < 120
    docs.unpersist()


@pytest.mark.parametrize("shared", [None, 3])
def test_a_mix_meets_its_targets_whatever_the_ids(spark, shared):
    rng = random.Random(1)
    rows = [(shared if i < 160 else i, text(rng, rng.randrange(1, 12)), "ab"[i % 2], "x") for i in range(200)]
    rows += [(shared, rows[0][1], "a", "x"), (shared, None, "a", "x"), (shared, "one two", None, "x")]
    docs = documents(spark, rows)
    plan = mixing.mix(docs)
    goal = {r["source"]: r["target"] for r in plan.select("source", "target").distinct().collect()}
    due = {r["source"]: r["w"] for r in plan.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("w")).collect()}
    out = mixing.resample(docs)
    assert out.columns == docs.columns
    words = F.size(F.filter(F.split("text", " "), lambda w: w != ""))
    got = {r["source"]: r["w"] for r in out.groupBy("source").agg(F.sum(words).alias("w")).collect()}
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in due.items() if v}
    for source, target in goal.items():
        assert abs((got.get(source) or 0) - target) <= 11
    times = out.groupBy("doc_id", "text", "source").count().collect()
    there = {(r["doc_id"], r["text"], r["source"]): r["count"] for r in docs.groupBy("doc_id", "text", "source").count().collect()}
    assert all(r["count"] <= 2 * there[r["doc_id"], r["text"], r["source"]] for r in times)


def test_rates_solve_the_dual(spark):
    """The multipliers against a bisection of their own over the same counts."""
    rng = np.random.default_rng(2)
    rows = [(s, int(n), int(c)) for s in ("a", "b", None) for n, c in zip(range(1, 400, 7), rng.integers(1, 50, 57), strict=True)]
    hist = spark.createDataFrame(rows, "source string, size long, n long")
    sums = {s: (sum(z * n for k, z, n in rows if k == s), sum(n for k, _, n in rows if k == s)) for s in ("a", "b", None)}
    goals = {"a": 0.3 * sums["a"][0], "b": 1.7 * sums["b"][0], None: 2.0 * sums[None][0]}
    found = {r["source"]: (r["tilt"], r["scale"]) for r in mixing.balance(hist, goals, sums, 2).collect()}
    assert found[None][0] is None  # every row twice
    for source in ("a", "b"):
        size = np.array([z for k, z, _ in rows if k == source], float)
        n = np.array([c for k, _, c in rows if k == source], float)
        tilt, scale = found[source]

        def words(t, size=size, n=n, scale=scale):
            return (n * size * 2 / (1 + np.exp(-t * size / scale))).sum()

        low, high = -100.0, 100.0
        for _ in range(200):
            middle = (low + high) / 2
            low, high = (middle, high) if words(middle) < goals[source] else (low, middle)
        assert abs(tilt - low) < 1e-5 * max(1, abs(low))


def test_no_documents(spark):
    docs = documents(spark, [])
    assert minhash.dedup(docs).collect() == [] and mixing.resample(docs).collect() == []
