"""Near-duplicate texts, near-duplicate vectors and repeated passages against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from epigauge.llm import graph, minhash, nndescent, suffixes
from epigauge.llm.graph import components


def roots(nodes, links):
    """The smallest node reachable from each."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("block", [500_000, 40])
def test_components(spark, monkeypatch, block):
    monkeypatch.setattr(graph, "BLOCK", block)
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 520)]
    links += [(1000, i) for i in range(1001, 1200)] + [(5, 5), (None, 3)]
    got = components(spark.createDataFrame(links, "a long, b long").repartition(4)).collect()
    real = [(a, b) for a, b in links if a is not None and a != b]
    want = roots({x for e in real for x in e}, real)
    assert {r["node"]: r["root"] for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def words_of(text):
    return (text or "").encode().lower().split()


def shingles(text, k=5):
    words = words_of(text)
    k = min(k, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aAbÜ \t\n\x0b\x1c .", max_size=60))
def test_shingle_counts(text):
    assert len(minhash.Shingler(5).shingles(text)) == len(shingles(text))


def test_shingles_do_not_depend_on_blocks(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(1000))
    whole = minhash.Shingler(5).shingles(text)
    monkeypatch.setattr(minhash, "BLOCK", 7)
    assert (minhash.Shingler(5).shingles(text) == whole).all()


@pytest.mark.parametrize("size", [6, 8, 12, 30, 100, 1000])
def test_similar_sets_share_a_band(size):
    """Small sets fill few bins; the densified ones must still agree."""
    rng, signer, missed = np.random.default_rng(size), minhash.Signer(minhash.NearDup()), 0
    out = max(1, int(size * 0.15 / 1.85))  # so many on either side leave 0.85 or more
    for _ in range(200):
        pool = rng.integers(0, 2**64 - 1, size + out, dtype=np.uint64)
        one, two = np.sort(pool[:size]), np.sort(pool[out:] if size > 12 else pool)
        missed += not (signer.keys(one) == signer.keys(two)).any()
    assert missed <= 1


def planted_texts(seed=5):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7)))
    rows, at = [], 100
    for size in (6, 7, 9, 20, 60, 200, 600):
        for copies in (1, 2, 5, 12):
            base = [word() for _ in range(size)]
            for _ in range(copies):
                text = list(base)
                for _ in range(rng.randrange(0, 1 + size // 40)):
                    text[rng.randrange(size)] = word()
                rows.append((at, " ".join(text)))
                at += 1
    return rows


EDGES = [
    (1, ""),
    (2, None),
    (3, " \t\n"),
    (4, "one two"),
    (5, "One\tTWO"),
    (6, "a b c d e"),
    (7, "a b c d e"),
    (7, "a b c d e"),
    (None, "a b c d e"),
    (None, "lonely words"),
    (8, "word " * 60_000),
    (9, "word " * 60_000 + "end"),
]


def test_near_groups(spark):
    rows = EDGES + planted_texts()
    schema = "doc_id long, text string, digest int, node string, keys int, n_shingles string, kept int, rep_id int"
    docs = spark.createDataFrame([(*r, 1, "n", 2, "s", 3, 4) for r in rows], schema).repartition(4)
    got = minhash.near_groups(docs).collect()
    sets = [shingles(t) for _, t in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])
    ]
    root = roots(range(len(rows)), links)
    least = {}
    for i, (doc, _) in enumerate(rows):
        known = [d for d in (least.get(root[i]), doc) if d is not None]
        least[root[i]] = min(known, default=None)
    want = Counter((doc, len(sets[i]), least[root[i]]) for i, (doc, _) in enumerate(rows))
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want
    linked = {i for i in range(len(rows)) if sets[i]}
    assert sum(r["kept"] for r in got) == len({root[i] for i in linked}) + len(rows) - len(linked)
    stay = minhash.dedup(docs)
    assert stay.dtypes == docs.dtypes and {r["doc_id"] for r in stay.collect()} == {r["doc_id"] for r in got if r["kept"]}


def test_other_centres_join_what_the_first_one_misses(spark):
    """A hub that resembles all its variants, which do not resemble each other enough."""
    rng = random.Random(2)
    base = [f"h{i}" for i in range(200)]
    rows = [(50, " ".join(base))]
    for v in range(12):
        text = list(base)
        for at in rng.sample(range(0, 200, 12), 2):
            text[at] = f"v{v}x{at}"
        rows.append((60 + v, " ".join(text)))
    got = minhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    sets = {i: shingles(t) for i, t in rows}
    links = [(i, j) for i in sets for j in sets if j < i and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    assert {r["doc_id"]: r["component_id"] for r in got} == roots(sets, links)


def variants_of_a_hub(n, seed=3):
    """The hub, and texts that resemble it, and hardly one of them another."""
    rng = random.Random(seed)
    base = [f"h{i}" for i in range(200)]
    rows = [(10, " ".join(base))]
    for v in range(n):
        text = list(base)
        for at in rng.sample(range(5, 195, 10), 2):
            text[at + rng.randrange(3)] = f"v{v}x{at}"
        text[rng.choice((60, 110, 160))] = f"v{v}y"
        rows.append((20 + v, " ".join(text)))
    return rows


@pytest.mark.parametrize("near", [minhash.NearDup(), minhash.NearDup(centres=(1,), block=32)])
def test_a_hub_keeps_all_its_variants(spark, near):
    rows = variants_of_a_hub(2000)
    sets = {i: shingles(t) for i, t in rows}
    hub = sets[10]
    near_hub = {i for i in sets if 100 * len(sets[i] & hub) >= 85 * len(sets[i] | hub)}
    assert len(near_hub) > 1900
    got = minhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), near).collect()
    assert [r["doc_id"] for r in got if r["doc_id"] in near_hub and r["component_id"] != 10] == []


def test_centres_are_drawn_from_components_of_any_size(spark):
    nodes = [(n, size, 3, 4) for n, size in enumerate((1 << 50, 1 << 23, 1 << 30))]
    frame = spark.createDataFrame(nodes, "node long, size long, code long, key long")
    assert frame.withColumn("order", minhash.drawn(1)).selectExpr("min_by(node, order)").first()[0] == 1


def test_no_texts(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_groups(none).count() == 0 and minhash.dedup(none).count() == 0
    assert suffixes.remove_repeats(none).count() == 0


VECTORS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
        T.StructField("node", T.StringType()),
        T.StructField("unit", T.IntegerType()),
        T.StructField("block", T.IntegerType()),
    ]
)


def test_near_vectors(spark):
    rng, rows = np.random.default_rng(4), []
    for label in (0, 1, 2):
        for size in (1, 1, 1, 2, 2, 3, 8, 40, 90):
            centre = rng.standard_normal(16)
            for _ in range(size):
                rows.append((centre + rng.standard_normal(16) * 0.12, label))
        rows += [(rng.standard_normal(16), label) for _ in range(150)]
    rows += [(rows[5][0], 0), (rows[5][0] * 2, 0), (rows[5][0], None)]
    rows += [(np.zeros(16), 1), (np.full(16, np.nan), 1), (np.full(16, np.inf), 1), (rng.standard_normal(8), 1)]
    data = [(i, [float(x) for x in np.float32(v)], label, "n", 1, 2) for i, (v, label) in enumerate(rows)]
    n = len(data)
    data += [(n, None, 1, "n", 1, 2), (n + 1, [], 1, "n", 1, 2), (n + 2, [None, 1.0], 1, "n", 1, 2)]
    got = nndescent.near_vectors(spark.createDataFrame(data, VECTORS).repartition(4)).collect()
    links = []
    for i, x, label, *_ in data[:n]:
        for j, y, other, *_ in data[:i]:
            if label == other and label is not None and len(x) == len(y):
                a, b = np.array(x, float), np.array(y, float)
                with np.errstate(all="ignore"):
                    cosine = a @ b / np.sqrt((a @ a) * (b @ b))
                if cosine >= 0.93:
                    links.append((i, j))
    degree = Counter(x for e in links for x in e)
    want = roots(range(n + 3), links)
    assert len(got) == n + 3
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == {i: (degree[i], want[i]) for i in range(n + 3)}
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def two_groups(n=30, width=24, seed=6):
    """Two tight groups, and further single vectors: n rows each; every list is filled from within a group."""
    rng = np.random.default_rng(seed)
    one, along = rng.standard_normal((2, width))
    one /= np.linalg.norm(one)
    along -= (along @ one) * one
    other = 0.955 * one + np.sqrt(1 - 0.955**2) * along / np.linalg.norm(along)
    vectors = [c + rng.standard_normal(width) * 0.13 / np.sqrt(width) for c in (one, other) for _ in range(n)]
    return np.float32([*vectors, *rng.standard_normal((n, width))]).astype(float)


@pytest.mark.parametrize("descent", [nndescent.Descent(), nndescent.Descent(block=8), nndescent.Descent(recall=2.0, rounds=1)])
def test_full_lists_do_not_hide_another_group(spark, descent):
    x = two_groups()
    x /= np.linalg.norm(x, axis=1)[:, None]
    sims = x @ x.T
    assert sims[:30, :30].min() > 0.96 and sims[30:60, 30:60].min() > 0.96 and (sims[:30, 30:60] >= 0.93).sum() > 300
    near = (sims >= 0.93) & ~np.eye(len(x), dtype=bool)
    data = [(i, [float(v) for v in row], 1, "n", 1, 2) for i, row in enumerate(two_groups())]
    got = nndescent.near_vectors(spark.createDataFrame(data, VECTORS).repartition(3), descent).collect()
    want = roots(range(len(x)), zip(*np.nonzero(near), strict=True))
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == {i: (near[i].sum(), want[i]) for i in want}


def test_lists_grow_until_the_other_group_stands_in_them(spark, monkeypatch):
    """Without the last guard, and without the full comparison behind it."""

    def refuse(*args):
        raise AssertionError("the lists should have found it")

    monkeypatch.setattr(nndescent, "bridges", lambda *args: None)
    monkeypatch.setattr(nndescent, "whole", refuse)
    x = two_groups()
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = (x @ x.T >= 0.93) & ~np.eye(len(x), dtype=bool)
    data = [(i, [float(v) for v in row], 1, "n", 1, 2) for i, row in enumerate(two_groups())]
    got = nndescent.near_vectors(spark.createDataFrame(data, VECTORS).repartition(3)).collect()
    want = roots(range(len(x)), zip(*np.nonzero(near), strict=True))
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == {i: (near[i].sum(), want[i]) for i in want}


def test_a_large_clump_does_not_hide_small_ones_from_the_audit(spark):
    """All links of the clump are known, and none of the pairs."""
    rng = np.random.default_rng(9)
    clump = rng.standard_normal(24) + rng.standard_normal((1500, 24)) * 0.02
    x = np.concatenate([clump, np.repeat(rng.standard_normal((100, 24)), 2, axis=0)])
    x[1500:] += rng.standard_normal((200, 24)) * 0.01
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = (x @ x.T >= 0.93) & ~np.eye(len(x), dtype=bool)
    nodes = spark.createDataFrame([(i, 1, v.tobytes(), 1) for i, v in enumerate(x)], "node long, block long, unit binary, weight long")
    counts = [(i, int(n)) for i, n in enumerate(near.sum(axis=1))]
    clumps = spark.createDataFrame([(i, 0) for i in range(1500)], "node long, root long")
    descent = nndescent.Descent()
    every = spark.createDataFrame(counts, "node long, links long")
    assert nndescent.audit(nodes, every, clumps, descent) == 1
    assert nndescent.audit(nodes, every.filter("node < 1500"), clumps, descent) < 0.9


def test_blocks_of_a_clump_count_like_one(spark):
    rng = np.random.default_rng(8)
    centre = rng.standard_normal(12)
    data = [(i, [float(x) for x in centre + rng.standard_normal(12) * 0.2], 1, "n", 1, 2) for i in range(150)]
    one = nndescent.near_vectors(spark.createDataFrame(data, VECTORS))
    cut = nndescent.near_vectors(spark.createDataFrame(data, VECTORS), nndescent.Descent(block=16))
    columns = ("vec_id", "n_links", "component_id")
    assert sorted(map(tuple, one.select(*columns).collect())) == sorted(map(tuple, cut.select(*columns).collect()))


def test_no_vectors_and_repeated_rows(spark):
    assert nndescent.near_vectors(spark.createDataFrame([], VECTORS)).count() == 0
    data = [(1, [1.0, 0.0], 1, "n", 1, 2)] * 2 + [(2, [1.0, 0.1], 1, "n", 1, 2), (None, [0.0, 1.0], 1, "n", 1, 2)]
    got = nndescent.near_vectors(spark.createDataFrame(data, VECTORS)).collect()
    assert Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == {(1, 2, 1): 2, (2, 2, 1): 1, (None, 0, None): 1}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"ab", b"abcabcabd", b"b" * 30, bytes(range(60))]), max_size=60), st.integers(16, 40))
def test_equal_windows(parts, width):
    raw = np.frombuffer(b"".join(parts), np.uint8)
    starts = np.arange(max(len(raw) - width + 1, 0))
    index, group = suffixes.equal_windows(raw, starts, width)
    want = {}
    for s in starts.tolist():
        want.setdefault(raw[s : s + width].tobytes(), []).append(s)
    got = {}
    for i, g in zip(index.tolist(), group.tolist(), strict=True):
        got.setdefault(g, []).append(i)
    assert sorted(sorted(g) for g in got.values()) == sorted(g for g in want.values() if len(g) > 1)


def test_steps_reach_the_cover():
    for a in range(suffixes.PERIOD):
        for b in range(suffixes.PERIOD):
            s = int(suffixes.STEP[a, b])
            assert {(a + s) % suffixes.PERIOD, (b + s) % suffixes.PERIOD} <= set(suffixes.COVER)


def test_equal_windows_have_equal_anchors(monkeypatch):
    rng = np.random.default_rng(0)
    raw = rng.integers(97, 99, 6000).astype(np.uint8)
    raw[3000:3400], raw[5000:5300] = raw[100:500], 97
    found = {}
    for segment in (suffixes.SEGMENT, 1 << 10):
        monkeypatch.setattr(suffixes, "SEGMENT", segment)
        names = {}
        for key, place, first, last in zip(*suffixes.Anchors(suffixes.Repeats()).of(raw.tobytes()), strict=True):
            for s in range(int(first), int(last) + 1):
                assert s <= place <= s + 68 and s not in names
                names[s] = (int(key), int(place) - s)
        assert len(names) == len(raw) - 99
        for s in range(len(raw) - 99):
            window = raw[s : s + 100].tobytes()
            assert found.setdefault((segment, window), names[s]) == names[s]


def removed_plainly(rows, width=100):
    """Rows in order of (id, digest); of repeated rows the first one counts as first."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, hashlib.sha256((rows[i][1] or "").encode()).hexdigest()))
    seen, out = set(), Counter()
    for i in order:
        raw = (rows[i][1] or "").encode()
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - width + 1):
            window = raw[s : s + width]
            if window in seen:
                gone[s : s + width] = True
            seen.add(window)
        spans = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(raw) else 0
        kept = hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest()
        out[rows[i][0], len(raw), int(gone.sum()), spans, kept] += 1
    return out


@pytest.mark.parametrize("repeats", [suffixes.Repeats(), suffixes.Repeats(hot=1), suffixes.Repeats(bucket_bytes=5000, block_bytes=100)])
def test_repeated_passages(spark, repeats):
    rng = random.Random(7)
    text = lambda n: "".join(rng.choice("abcdeé \n") for _ in range(n))
    passages = [text(n) for n in (99, 100, 101, 130, 400, 1000)]
    rows = [(i, text(rng.randrange(0, 300)) + rng.choice(passages) + text(rng.randrange(0, 200)) + rng.choice(passages)) for i in range(40)]
    rows += [(100, "z" * 99), (101, "z" * 100), (102, "z" * 101), (103, "xy" * 500), (104, None), (105, ""), (106, passages[5])]
    rows += [(107, passages[5]), (107, passages[5]), (None, passages[4]), (None, text(150)), (108, text(50_000)), (109, "q " * 20_000)]
    rows += [(110, passages[3] + "A" * 40), (110, passages[3] + "B" * 40)]
    schema = "doc_id long, text string, node int, places string, kept int, code string, sha int"
    docs = spark.createDataFrame([(*r, 1, "p", 2, "c", 3) for r in rows], schema).repartition(3)
    got = suffixes.remove_repeats(docs, repeats)
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert Counter(map(tuple, got.select(*columns).collect())) == removed_plainly(rows)


def test_hot_names_leave_the_others_together(spark):
    """The join that takes hot names out used to turn into a broadcast, and the other names' rows stayed where they were read."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.files.maxPartitionBytes": "20k",
        "spark.sql.files.openCostInBytes": "1",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    rng = random.Random(11)
    text = lambda n: "".join(rng.choice("abcde fghij\n") for _ in range(n))
    common, passages = text(150), [text(300) for _ in range(60)]
    rows = [(i, text(400) + common + text(400) + passages[i % 60] + text(400)) for i in range(240)]
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
        got = suffixes.remove_repeats(docs, suffixes.Repeats(hot=100))
        columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
        assert Counter(map(tuple, got.select(*columns).collect())) == removed_plainly(rows)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("hot", [1, 20_000])
def test_a_row_that_stands_twice_keeps_what_is_its_own(spark, hot):
    rng = random.Random(13)
    text = lambda n: "".join(rng.choice("abcdeé \n") for _ in range(n))
    # Repeated anchors, too short to make a repeated window: nothing of the first rows stands elsewhere.
    short, shared = text(60), text(300)
    rows = [(i, text(200) + short + text(200)) for i in range(6)]
    rows += [(7, text(200) + shared + text(100)), (8, text(200) + shared + text(100))]
    rows = [r for r in rows for _ in range(3)] + [(None, text(200) + shared)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = suffixes.remove_repeats(docs, suffixes.Repeats(hot=hot))
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert Counter(map(tuple, got.select(*columns).collect())) == removed_plainly(rows)
