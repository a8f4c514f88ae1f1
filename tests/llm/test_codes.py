"""Vector codes, hard negatives and byte pairs against plain forms of the same contracts."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from epigauge.llm import bytepairs, negatives, vectorcodes
from epigauge.llm.queries import public_ranks

SCHEMA = "vec_id long, label int, embedding array<float>, Code string, row int, block int"


def vectors(n, width=16, seed=0, groups=9, spread=0.1):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((groups, width))
    x = centre[rng.integers(0, groups, n)] + spread * rng.standard_normal((n, width))
    return (0.3 * x).astype(np.float32)


def frame(spark, rows):
    return spark.createDataFrame([(i, label, v, "x", 1, 2) for i, label, v in rows], SCHEMA).repartition(3)


def odd_rows(x):
    """Repeated rows, shared and null ids, null labels, and vectors that can't be read."""
    nan, inf = float("nan"), float("inf")
    rows = [(i, int(i % 5), v.tolist()) for i, v in enumerate(x)]
    good = x[0].tolist()
    rows += [rows[3], rows[3], (7, 2, x[8].tolist()), (None, 1, good), (None, 1, good), (900, None, good), (901, 1, x[0].tolist())]
    rows += [(902, 1, None), (903, 1, [*good[:-1], None]), (904, 1, [*good[:-1], nan]), (905, 1, [*good[:-1], inf])]
    rows += [(906, 1, [0.0] * x.shape[1])]
    return rows


def readable(v):
    return v is not None and None not in v and np.isfinite(np.array(v, float)).all()


# Vector codes


def plain_codes(rows, parts=4, entries=256, rounds=4):
    kept = [(i, label, np.floor(1024 * np.float32(v).astype(float)).astype(int)) for i, label, v in rows if readable(v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2].astype("<i8").tobytes()))
    x = np.array([v for _, _, v in kept])
    cut = np.split(x, parts, axis=1)
    books = [c[:entries].copy() for c in cut]

    def nearest(p):
        d = ((cut[p][:, None, :] - books[p][None]) ** 2).sum(2)
        return d.argmin(1), d.min(1)

    for _ in range(rounds):
        for p in range(parts):
            at, _ = nearest(p)
            for e in set(at.tolist()):
                books[p][e] = cut[p][at == e].sum(0) // (at == e).sum()
    found = [nearest(p) for p in range(parts)]
    code = ["".join(f"{a[r]:02x}" for a, _ in found) for r in range(len(kept))]
    error = sum(d for _, d in found)
    by_label = {}
    for (_, label, _), e in zip(kept, error, strict=True):
        by_label[label] = by_label.get(label, 0) + int(e)
    text = ",".join(str(v) for b in books for v in b.ravel())
    digest = hashlib.sha256(text.encode()).hexdigest()
    return [(i, c, int(e), by_label[label], digest) for (i, label, _), c, e in zip(kept, code, error, strict=True)]


def test_codes_equal_full_comparison(spark):
    rows = odd_rows(vectors(700))
    found, books = vectorcodes.compress(frame(spark, rows))
    got = vectorcodes.with_label_error(found, books).drop("label").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(plain_codes(rows), key=repr)


def test_fewer_vectors_than_entries_and_none(spark):
    rows = [(5, None, [0.1] * 8), (5, None, [0.1] * 8), (2, 1, [-0.1] * 8)]
    found, books = vectorcodes.compress(frame(spark, rows))
    got = vectorcodes.with_label_error(found, books).drop("label").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(plain_codes(rows), key=repr)
    found, books = vectorcodes.compress(frame(spark, [(1, 1, None)]))
    assert books is None and vectorcodes.with_label_error(found, books).count() == 0
    found, books = vectorcodes.compress(frame(spark, []))
    assert books is None and vectorcodes.with_label_error(found, books).count() == 0


def test_vectors_that_share_no_codebook_are_named(spark):
    with pytest.raises(Exception, match="different lengths"):
        vectorcodes.compress(frame(spark, [(1, 1, [0.1] * 8), (2, 1, [0.1] * 12)]))[0].collect()
    with pytest.raises(Exception, match="too long"):
        vectorcodes.compress(frame(spark, [(1, 1, [1e9] * 8)]))[0].collect()


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 300), st.integers(1, 6), st.integers(1, 60), st.integers(0, 10_000))
def test_tree_finds_the_first_of_the_nearest(n, width, reach, seed):
    """Small whole numbers: many equal distances, equal entries and equal queries."""
    rng = np.random.default_rng(seed)
    entries, queries = rng.integers(-reach, reach + 1, (n, width)), rng.integers(-reach, reach + 1, (50, width))
    at, best = vectorcodes.Gnat(entries).nearest(queries)
    d = ((queries[:, None, :] - entries[None]) ** 2).sum(2)
    assert (at == d.argmin(1)).all() and (best == d.min(1)).all()


def test_tree_leaves_out_most_entries_of_grouped_points():
    points = np.floor(1024 * vectors(4_000, width=8, groups=32, spread=0.02))
    tree = vectorcodes.Gnat(points[:256])
    tree.nearest(points)
    assert tree.met < 0.4 * len(points) * 256


# Hard negatives


def plain_negatives(rows, anchor, positives=5, negatives_=5, least=80):
    kept = [
        (i, label, np.floor(256 * np.float32(v).astype(float)).astype(int))
        for i, label, v in rows
        if label is not None and readable(v)
    ]
    out = []
    for a, (i, label, v) in enumerate(kept):
        if i is None or not anchor(i):
            continue
        score = [(-int(v @ w), j is None, j or 0, j, b, other) for b, (j, other, w) in enumerate(kept) if b != a]
        own = sorted((s for s in score if s[5] == label), key=lambda s: s[:3])[:positives]
        rest = sorted((s for s in score if s[5] != label), key=lambda s: s[:3])
        for p in own:
            top = -p[0]
            fits = [s for s in rest if least * top <= -100 * s[0] <= 100 * top][:negatives_]
            out += [(i, p[3], rank, s[3], top, -s[0]) for rank, s in enumerate(fits, 1)]
    return out


@pytest.mark.parametrize("width", [5, 64, 70])
def test_negatives_equal_full_comparison(spark, width):
    rows = odd_rows(vectors(500, width=width, seed=3))
    mining = negatives.Mining(block=64, anchors=7)
    got = negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 9 == 0, mining).collect()
    want = plain_negatives(rows, lambda i: i % 9 == 0)
    assert len(want) > 300
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_negatives_with_one_hot_label(spark):
    x = vectors(400, seed=5)
    rows = [(i, 0 if i % 3 else i % 7, v.tolist()) for i, v in enumerate(x)] + [(1_000 + i, 8, x[9].tolist()) for i in range(100)]
    got = negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 20 == 0, negatives.Mining(block=100)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(plain_negatives(rows, lambda i: i % 20 == 0), key=repr)


def test_negatives_of_nothing(spark):
    for rows in ([], [(0, 1, None)], [(0, None, [1.0])], [(100, 1, [0.5] * 4)], [(0, 1, []), (1, 1, []), (2, 2, [])]):
        got = negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 100 == 0).collect()
        assert sorted(map(tuple, got)) == sorted(plain_negatives(rows, lambda i: i % 100 == 0))


def test_bounds_hold_and_exclude():
    x = np.floor(256 * vectors(600, width=64, groups=20, seed=2))
    codes, along, rest = negatives.encoded(x, 12)
    coded = negatives.Coded([v.astype("<i8").tobytes() for v in x], [c.tobytes() for c in codes], along, rest)
    low, high = negatives.Anchors(x[:50], negatives.Mining()).bounds(coded)
    exact = x[:50] @ x.T
    assert (low <= exact).all() and (exact <= high).all()
    assert (high < 0.8 * (x[:50] ** 2).sum(1)[:, None]).mean() > 0.5


# Byte pairs

TEXTS = [
    "",
    None,
    "plain words, don't we'll they're; 1234567 x",
    "a" * 3_000 + " " * 2_000 + "b " + "\n" * 500,
    " " * 900 + "x" + " " * 700,
    "the cat's  toy\r\n\t\tis 漢字 ñandú éé 🙂🙂 1²3 " * 60,
    "'" * 700 + "ll" * 900 + "'re" * 300,
    "<|endoftext|> and \x00 control",
    "newer letters ࢏՘ and digits \U00011de0 between " * 40,
]


def library():
    with open(public.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("plain", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def plain_summary(rows):
    reader, out = library(), []
    for i, text in rows:
        ids = np.array(reader.encode_ordinary(text or ""), "<u4").tobytes()
        out.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    return out


@pytest.mark.parametrize("chunks", [bytepairs.Chunks(), bytepairs.Chunks(64, 16, 2), bytepairs.Chunks(40, 20, 8), bytepairs.Chunks(500, 100, 4)])
def test_ids_equal_the_library_however_texts_are_cut(spark, chunks):
    rng = random.Random(4)
    rows = list(enumerate(TEXTS)) + [(None, TEXTS[5]), (None, TEXTS[5]), (5, TEXTS[5]), (5, TEXTS[3])]
    rows += [(100 + i, "".join(rng.choices(" \n'stré1a漢.", k=rng.randrange(400)))) for i in range(60)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, Digest string, part int").repartition(3)
    got = bytepairs.summary(docs, public_ranks(), chunks).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(plain_summary(rows), key=repr)


def test_encode_gives_ids_and_decode_the_bytes(spark):
    rows = list(enumerate(TEXTS))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    parts = bytepairs.encode(docs, public_ranks(), bytepairs.Chunks(100, 30, 4))
    read = bytepairs.decode(parts, public_ranks()).orderBy("doc_id", "part").collect()
    reader = library()
    for i, text in rows:
        mine = [r for r in read if r["doc_id"] == i]
        assert [r["part"] for r in mine] == list(range(len(mine)))
        assert b"".join(r["bytes"] for r in mine).decode() == (text or "")
        assert np.frombuffer(b"".join(r["ids"] for r in mine), "<u4").tolist() == reader.encode_ordinary(text or "")


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bytepairs.summary(docs, public_ranks()).collect() == []
    assert bytepairs.encode(docs, public_ranks()).collect() == []
