from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as public
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from epigauge.llm import packing
from epigauge.llm.queries import public_vocabulary


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=300))
def test_plan_places_every_piece_once(lengths):
    counts = np.bincount(lengths, minlength=65)
    plan = packing.plan(counts, 64)
    used = Counter()
    for pattern, n in plan:
        assert sum(pattern) <= 64 and n > 0
        for length in pattern:
            used[length] += n
    assert used == Counter(lengths)
    bins = sum(n for _, n in plan)
    # Best-fit never leaves two sequences that would go into one.
    assert bins <= 2 * -(-sum(lengths) // 64) + 1


@pytest.mark.parametrize("size", [2, 3, 4])
def test_exact_combinations_are_found(size):
    rng = np.random.default_rng(size)
    lengths = []
    for _ in range(200):
        cuts = np.sort(rng.choice(np.arange(1, 2048), size - 1, replace=False))
        lengths += np.diff([0, *cuts, 2048]).tolist()
    plan = packing.plan(np.bincount(lengths, minlength=2049), 2048)
    assert sum(n for _, n in plan) <= 200 * 1.03


def test_complement_of_two_equal_halves():
    counts = np.zeros(9, np.int64)
    counts[4] = 3
    assert packing.plan(counts, 8) == [((4, 4), 1), ((4,), 1)]


TEXTS = [
    (1, "plain words here"),
    (2, ""),
    (3, None),
    (4, "end <|endoftext|> of"),
    (5, " " * 70_000 + "x"),
    (6, "wörd ñ 漢字 \r\n\t  1234567 don't we'll"),
    (7, "a" * 30_000),
    (8, "the cat " * 9_000),
    (9, "plain words here"),
    (9, "plain words here"),
    (None, "nobody's"),
]


def test_pieces_and_places(spark):
    schema = "doc_id long, text string, length string, place int, bucket int"
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in TEXTS], schema).repartition(3)
    got = packing.pack_documents(docs, public_vocabulary()).collect()
    tokenizer = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    want = Counter()
    for i, t in TEXTS:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        first = (len(ids) - 1) % 2048 + 1
        edges = [0, *range(first, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            want[i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_ids_of_the_two_readers_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    fast = packing.pieces(docs, public_vocabulary())
    slow = packing.pieces(docs, packing.Vocabulary(public.path("byte_bpe_50k.json")))
    both = fast.join(slow.select("doc_id", "piece", F.col("ids").alias("other")), ["doc_id", "piece"], "full")
    assert both.filter("not ids <=> other").count() == 0


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(docs, public_vocabulary()).count() == 0
