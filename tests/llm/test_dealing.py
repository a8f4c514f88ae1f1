"""Exact dedup, shards and the source mix against plain Python."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from epigauge.llm import exact, mixing, shards
from epigauge.llm.common import number_within

DOCS = "doc_id long, text string, source string, digest int, salt string, kept boolean, size string, shard int"


def frame(spark, rows, parts=3):
    """Documents with extra columns whose names the operators use themselves."""
    full = [(i, t, s, 1, "x", None, "y", 9) for i, t, s in rows]
    return spark.createDataFrame(full, DOCS).repartition(parts)


ROWS = [
    (5, "a  b", "s1"),
    (3, "a\tb", "s2"),
    (9, "a b", None),
    (4, "", "s1"),
    (6, None, "s1"),
    (None, "a b", "s2"),
    (None, "only", None),
    (7, "x" * 200_000, "s3"),
    (8, "x" * 200_000, "s3"),
    (1, "one", "s1"),
    (1, "one", "s1"),
    (2, "a b", "s1"),
]


def groups_of(rows):
    members = defaultdict(list)
    for i, t, _ in rows:
        members[re.sub(r"[ \t-\r]+", " ", t or "")].append(i)
    return members


@pytest.mark.parametrize("salted", [False, True])
@pytest.mark.parametrize("clash", [False, True])
def test_exact_groups(spark, salted, clash):
    digest_of = (lambda c: F.length(c).cast("string")) if clash else exact.sha
    got = exact.exact_groups(frame(spark, ROWS), digest_of=digest_of, hot_rows=1 if salted else 1000).collect()
    members = groups_of(ROWS)
    want = Counter()
    for content, ids in members.items():
        keep = min((i for i in ids if i is not None), default=None)
        for i in ids:
            want[i, keep, len(ids)] += 1
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"]) for r in got) == want
    assert sum(r["kept"] for r in got) == len(members)


def test_exact_dedup_keeps_columns_and_one_row_of_each(spark):
    kept = exact.dedup(frame(spark, ROWS))
    assert kept.dtypes == frame(spark, ROWS).dtypes
    texts = [re.sub(r"[ \t-\r]+", " ", r["text"] or "") for r in kept.collect()]
    assert sorted(texts) == sorted(groups_of(ROWS))


def test_empty_tables(spark):
    none = frame(spark, [])
    assert exact.exact_groups(none).count() == 0 and exact.dedup(none).count() == 0
    assert shards.assign(none, 16).count() == 0
    assert mixing.mix(none).count() == 0 and mixing.resample(none).count() == 0


def jump_plainly(key, n):
    """The published loop with Python's integers."""
    b, j = -1, 0
    key %= 1 << 64
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_is_the_published_one():
    keys = np.random.default_rng(0).integers(-(2**63), 2**63 - 1, 2000)
    for n in (1, 2, 16, 17, 1000):
        assert shards.jump(keys, n).tolist() == [jump_plainly(int(k), n) for k in keys]


def test_shards(spark):
    rows = ROWS + [(i, f"t{i}", "s") for i in range(100, 900)]
    got = shards.assign(frame(spark, rows), 16).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _, _ in rows)
    for r in got:
        assert 0 <= r["shard"] < 16 and r["grown_shard"] in (r["shard"], 16) and r["law"] == "key"
    assert 20 < sum(r["grown_shard"] == 16 for r in got) < 90
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    texts = {i: t or "" for i, t, _ in rows}
    for r in got:
        if r["doc_id"] is not None:
            raw = texts[r["doc_id"]].encode()
            assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
    again = {(r["doc_id"], r["shard"]) for r in shards.assign(frame(spark, rows, 7), 16).collect()}
    assert again == {(r["doc_id"], r["shard"]) for r in got}


def test_written_shards_hold_whole_rows(spark, tmp_path):
    rows = [(i, f"t{i}", "s") for i in range(300)]
    shards.write_shards(frame(spark, rows), 4, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == 300 and back.select("_shard").distinct().count() == 4
    law = frame(spark, rows).withColumn("at", shards.shard_of(F.col("doc_id"), 4))
    assert back.join(law.select("doc_id", "at"), "doc_id").filter("at <> _shard").count() == 0


def test_numbers_have_no_gaps_in_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr("epigauge.llm.common.ROWS_PER_BUCKET", 7)
    rows = [("hot", i) for i in range(500)] + [("cold", i) for i in range(3)]
    df = spark.createDataFrame(rows, "g string, i long").repartition(5)
    got = number_within(df, ["g"], ["i"], "n", len(rows)).collect()
    assert sorted(r["n"] for r in got if r["g"] == "hot") == list(range(500))
    assert sorted(r["n"] for r in got if r["g"] == "cold") == list(range(3))


def test_targets_hand_on_the_excess():
    got = mixing.targets(np.array([10.0, 100.0, 100.0, 0.0]), np.array([3.0, 1.0, 2.0, 3.0]), 1.5, 2)
    assert got.tolist() == [20.0, pytest.approx(295 / 3), pytest.approx(590 / 3), 0.0]
    assert sum(got) == pytest.approx(315)


def test_mix(spark):
    rng = np.random.default_rng(3)
    rows = [(i, "w " * int(rng.integers(0, 40)), ["a", "b", "c", None][int(rng.integers(0, 4))]) for i in range(800)]
    rows += [(i, "same text here", "a") for i in range(800, 1100)] + [(2000, None, "b"), (2001, "v " * 3000, "c"), (None, "u", "z")]
    got = mixing.mix(frame(spark, rows)).collect()
    assert len(got) == len(rows) and all(0 <= r["copies"] <= 2 for r in got)
    size = {i: len((t or "").split()) for i, t, _ in rows}
    assert all(r["size"] == size[r["doc_id"]] for r in got)
    words, taken = Counter(), Counter()
    for r in got:
        words[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
    order = sorted(words, key=lambda s: (s is None, s or ""))
    weights = np.array([(3, 1, 2)[i % 3] for i in range(len(order))], float)
    want = mixing.targets(np.array([words[s] for s in order], float), weights, 1.5, 2)
    for s, t in zip(order, want, strict=True):
        assert abs(taken[s] - t) <= 2, (s, taken[s], t)
    again = mixing.mix(frame(spark, rows, 11)).collect()
    assert sorted(((r["doc_id"], r["copies"]) for r in got), key=str) == sorted(((r["doc_id"], r["copies"]) for r in again), key=str)
    copies = {r["doc_id"]: r["copies"] for r in got}
    back = Counter(r["doc_id"] for r in mixing.resample(frame(spark, rows)).collect())
    assert back == Counter({i: c for i, c in copies.items() if c})


def test_normal_text_is_hashed_as_utf8(spark):
    rows = [(1, "ü\t \nß x", "s")]
    got = exact.exact_groups(frame(spark, rows)).first()
    assert got["digest"] == hashlib.sha256("ü ß x".encode()).hexdigest()
