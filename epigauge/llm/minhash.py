"""MinHash near-dedup: one permutation with optimal densification, banded buckets, star-shaped candidates."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from epigauge.llm.common import free_name, number_within, text_of
from epigauge.llm.graph import components
from epigauge.llm.nndescent import runs
from epigauge.session import materialise

#: Attempts of a densified bin before it takes the first filled one.
ATTEMPTS = 2_048
#: Words hashed at once.
BLOCK = 100_000


@dataclass(frozen=True)
class NearDup:
    """``percent`` of shared word sequences that links two texts, and the signature that finds them.

    24 bands of 6 miss a pair of similarity 0.85 once in 80,000. ``centres`` are the nodes of a bucket that
    meet its others in each turn; they differ over the about nine buckets that a linked pair shares. What
    they leave open in a bucket is compared ``block`` nodes with ``block`` nodes.
    """

    words: int = 5
    percent: int = 85
    bands: int = 24
    rows: int = 6
    centres: tuple[int, ...] = (1, 4)
    block: int = 256


def scrambled(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix of each number."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Hashes of all word sequences of a text, from prefix sums over its bytes."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, words: int):
        self.words = words
        self.letters = scrambled(np.arange(1, 257, dtype=np.uint64) * np.uint64(self.BASE))
        self._grow(1 << 16)

    def _grow(self, n: int) -> None:
        back = pow(self.BASE, -1, 1 << 64)
        for name, base in (("up", self.BASE), ("down", back)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            setattr(self, name, np.cumprod(steps))

    def shingles(self, text: str) -> np.ndarray:
        """Sorted distinct hashes; A-Z count as a-z; fewer words than asked for are one sequence; none, none."""
        words = text.encode().lower().split()
        k = min(self.words, len(words))
        if not words:
            return np.zeros(0, np.uint64)
        parts = []
        for at in range(0, len(words) - k + 1, BLOCK):
            parts.append(self._block(words[at : at + BLOCK + k - 1], k))
        return np.unique(np.concatenate(parts))

    def _block(self, words: list[bytes], k: int) -> np.ndarray:
        raw = np.frombuffer(b" ".join(words), np.uint8)
        if len(raw) > len(self.up):
            self._grow(2 * len(raw))
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.letters[raw] * self.up[: len(raw)], out=sums[1:])
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        a, b = starts[: len(words) - k + 1], ends[k - 1 :]
        spans = (sums[b] - sums[a]) * self.down[a]
        return scrambled(spans ^ (np.uint64(self.BASE) * (b - a).astype(np.uint64)))


class Signer:
    """Band keys of a set: one minimum per bin of a single permutation; empty bins borrow from filled ones."""

    def __init__(self, near: NearDup):
        self.near, self.bins = near, near.bands * near.rows
        edge = np.arange(self.bins, dtype=np.float64) / self.bins * 2.0**64
        self.edges = edge.astype(np.uint64)
        mixed = scrambled(np.arange(1, ATTEMPTS * self.bins + 1, dtype=np.uint64) * np.uint64(Shingler.BASE))
        # The same draws for every set: bin b asks bins draws[0, b], draws[1, b], ... until one is filled.
        self.draws = (mixed % np.uint64(self.bins)).astype(np.int64).reshape(ATTEMPTS, self.bins)
        self.odd = scrambled(np.arange(1, near.rows + 1, dtype=np.uint64)) | np.uint64(1)
        self.salt = scrambled(np.arange(1, near.bands + 1, dtype=np.uint64) * np.uint64(77))

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        first = np.searchsorted(hashes, self.edges)
        filled = np.diff(np.append(first, len(hashes))) > 0
        source = np.arange(self.bins)
        empty = np.flatnonzero(~filled)
        for asked in self.draws:
            if not len(empty):
                break
            got = filled[asked[empty]]
            source[empty[got]] = asked[empty[got]]
            empty = empty[~got]
        if len(empty):
            source[empty] = np.flatnonzero(filled)[0]
        values = hashes[first[source]]
        grouped = values.reshape(self.near.bands, self.near.rows)
        return scrambled((scrambled(grouped) * self.odd).sum(axis=1, dtype=np.uint64) ^ self.salt).view(np.int64)


def signatures(docs: DataFrame, near: NearDup, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text_code, n_shingles, digest, keys`` of every row; sets too small to resemble another one have no keys.

    ``text_code`` names the text, ``digest`` its set.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, signer = Shingler(near.words), Signer(near)
        # A set of n differs from its closest other set in one of n + 1 elements.
        least = near.percent / (100 - near.percent) if near.percent < 100 else float("inf")
        for rows in batches:
            sizes, digests, keys = [], [], []
            for text in rows.column("text"):
                s = shingler.shingles(text.as_py())
                sizes.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                keys.append(signer.keys(s) if len(s) >= least else [])
            named = [rows.column("doc_id"), rows.column("text_code")]
            made = [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*named, *made], ["doc_id", "text_code", "n_shingles", "digest", "keys"])

    texts = coded_texts(docs, id_col, text_col)
    return texts.mapInArrow(sign, "doc_id long, text_code string, n_shingles long, digest binary, keys array<long>")


def coded_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_of(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.md5(text.cast("binary")).alias("text_code"), text.alias("text"))


def full_sets(docs: DataFrame, nodes: DataFrame, near: NearDup, id_col: str, text_col: str) -> DataFrame:
    """``node, hashes`` (8 bytes each, sorted) of the wanted sets, made from the texts again.

    A set is made from one text: rows are matched by id and text, so rows that share an id meet their own node only.
    """
    ids = nodes.select("node", "rep_id", "rep_code").hint("shuffle_hash")
    texts = coded_texts(docs, id_col, text_col)
    chosen = texts.join(ids, F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("text_code") == F.col("rep_code")))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, made = Shingler(near.words), set()
        for rows in batches:
            kept, out = [], []
            for node, text in zip(rows.column("node").to_pylist(), rows.column("text"), strict=True):
                if node not in made:  # a row may stand there several times
                    made.add(node)
                    kept.append(node)
                    out.append(shingler.shingles(text.as_py()).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int64()), pa.array(out, pa.binary())], ["node", "hashes"])

    return chosen.select("node", "text").mapInArrow(make, "node long, hashes binary")


def shared(left: str, right: str) -> Column:
    """How many hashes two sorted sets share."""

    def count(a: bytes, b: bytes) -> int:
        x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
        if len(x) > len(y):
            x, y = y, x
        at = np.searchsorted(y, x)
        at[at == len(y)] = 0
        return int((y[at] == x).sum())

    @pandas_udf("long")
    def of(one: pd.Series, other: pd.Series) -> pd.Series:
        return pd.Series([count(a, b) for a, b in zip(one, other, strict=True)], dtype="int64")

    return of(left, right)


def confirmed(pairs: DataFrame, sets: DataFrame, near: NearDup) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("b"), F.col("hashes").alias("other"))
    right = sets.select(F.col("node").alias("a"), F.col("hashes").alias("one"))
    met = pairs.join(left, "b").join(right, "a").withColumn("both", shared("one", "other"))
    union = (F.length("one") + F.length("other")) / 8 - F.col("both")
    return met.filter(100 * F.col("both") >= near.percent * union).select("a", "b")


def near_groups(docs: DataFrame, near: NearDup | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row.

    Equal sets are one node. In each bucket one node is the centre and meets the others, so the pairs grow with
    the rows; pairs are confirmed on their full sets. Buckets whose nodes are not yet connected get more
    centres, and what these leave open is compared in full. Texts without words are linked with nothing, so all of them are
    kept. One row of a group is kept, also where ids are null or shared: a null id comes after all others, of the sets under one
    id the one with the smallest digest leads, of repeated rows one stays. Very long texts are read whole, some words at a
    time. Ids must be whole numbers; other columns are not looked at. An empty table gives an empty one.
    """
    found = grouped(docs, near or NearDup(), id_col, text_col)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def grouped(docs: DataFrame, near: NearDup, id_col: str, text_col: str) -> DataFrame:
    """The columns of :func:`near_groups` and ``text_code``: what tells rows with one id apart."""
    signed = materialise(signatures(docs, near, id_col, text_col), "signatures")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_code", "n_shingles", "keys")).alias("rep")
    reps = signed.filter("n_shingles > 0").groupBy("digest").agg(first)
    reps = reps.select(
        "digest",
        F.col("rep.doc_id").alias("rep_id"),
        F.col("rep.text_code").alias("rep_code"),
        F.col("rep.n_shingles").alias("n"),
        F.col("rep.keys").alias("keys"),
    )
    code = F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long").alias("code")
    reps = materialise(reps.select(F.monotonically_increasing_id().alias("node"), code, "*"), "nodes")
    roots = linked_nodes(docs, reps, near, id_col, text_col)
    named = reps.select("node", "digest", "rep_id").join(roots, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    # One set leads a group: ids alone would not tell one row where they are null or shared.
    lead = F.min(F.struct(F.col("rep_id").isNull().alias("none"), "rep_id", "digest")).alias("lead")
    named = named.join(named.groupBy("root").agg(lead), "root")
    named = named.select("digest", F.col("lead.rep_id").alias("component_id"), (F.col("digest") == F.col("lead.digest")).alias("leads"))
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    found = signed.drop("keys").join(named, "digest", "left").withColumn("component_id", own)
    # Dealt out by a value of its own: under the digest alone the copies of a text would stay in one task.
    found = found.withColumn("row", F.struct("doc_id", "digest"))
    again = F.row_number().over(Window.partitionBy("row").orderBy("text_code"))
    first_row = F.col("leads") & F.col("doc_id").eqNullSafe(F.col("component_id")) & (again == 1)
    kept = F.when(F.col("n_shingles") > 0, first_row).otherwise(F.lit(True))
    return found.withColumn("kept", kept).select("doc_id", "text_code", "n_shingles", "component_id", "kept")


def linked_nodes(docs: DataFrame, reps: DataFrame, near: NearDup, id_col: str, text_col: str) -> DataFrame:
    """``node, root`` of the nodes with confirmed links: the smallest node that can be reached.

    In every turn some centres of each bucket that holds several components still meet its other components,
    so the pairs grow with the rows however large a group is. Nodes that were never centre of a bucket and stay
    apart in it are compared in full after that.
    """
    spark = docs.sparkSession
    sizes = reps.select("node", "code", "n")
    dealt = reps.select("node", F.explode("keys").alias("key"))
    crowded = dealt.groupBy("key").agg(F.count(F.lit(1)).alias("nodes")).filter("nodes > 1").select("key")
    buckets = materialise(dealt.distinct().join(crowded, "key"), "buckets")
    wanted = buckets.select("node").distinct()
    wanted = reps.select("node", "rep_id", "rep_code").join(wanted, "node")
    sets = materialise(full_sets(docs, wanted, near, id_col, text_col).dropDuplicates(["node"]), "sets")
    tested = links = roots = done = None
    for turn, width in enumerate(near.centres):
        apart = unsettled(buckets, sizes, roots, links)
        if apart.isEmpty():
            return nothing(spark) if roots is None else roots
        # The first centre is the same node in all buckets that a group shares, so its pairs are few; later
        # ones differ from bucket to bucket, and stand in small components where there are some.
        slot = F.pmod(F.xxhash64("code", F.lit(turn)), F.lit(width)).alias("slot")
        ordered = apart.withColumn("order", drawn(turn) if turn else F.col("code"))

        def first(by: str) -> list[Column]:
            return [F.min_by(c, by).alias(a) for c, a in (("node", "a"), ("root", "a_root"), ("n", "a_n"))]  # noqa: B023

        centres = ordered.groupBy("key", slot).agg(*first("order")).drop("slot")
        if turn:
            # A node with many links resembles much of its bucket: the one with most is a centre, too.
            hubs = apart.filter("links > 0").withColumn("order", F.struct(-F.col("links"), "code"))
            centres = centres.unionByName(hubs.groupBy("key").agg(*first("order")))
        centres = materialise(centres, "centres")
        met = apart.join(centres, "key").filter("root <> a_root")
        fits = 100 * F.least("n", "a_n") >= near.percent * F.greatest("n", "a_n")
        pairs = met.filter(fits).select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialise(pairs, "pairs")
        found = materialise(confirmed(pairs, sets, near), "links")
        was = centres.select("key", F.col("a").alias("node"))
        tested, links, done = (new if old is None else old.unionByName(new) for old, new in ((tested, pairs), (links, found), (done, was)))
        if roots is None:
            roots = components(found)
        elif not found.isEmpty():
            roots = grown(roots, found)
    found = materialise(open_links(buckets, sizes, roots, done, sets, near), "links")
    return roots if found.isEmpty() else grown(roots, found)


def nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "node long, root long")


def unsettled(buckets: DataFrame, sizes: DataFrame, roots: DataFrame | None, links: DataFrame | None) -> DataFrame:
    """``key, node, code, n, root, links, size``: the members of buckets that hold several components, written once a turn.

    ``size`` counts a component's members in the bucket, ``links`` a node's confirmed ones.
    """
    if roots is None:  # every node is a component of its own, and every bucket holds several
        alone = buckets.join(sizes, "node").withColumns({"root": F.col("node"), "links": F.lit(0).cast("long"), "size": F.lit(1).cast("long")})
        return materialise(alone, "apart")
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("links"))
    state = sizes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).join(ends, "node", "left")
    members = buckets.join(state, "node")
    parts = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"))
    spread = parts.groupBy("key").agg(F.min("root").alias("one"), F.max("root").alias("other")).filter("one < other").select("key")
    return materialise(members.join(spread, "key").join(parts, ["key", "root"]), "apart")


def drawn(turn: int) -> Column:
    """Small components first, their nodes in an order of the bucket's own; for components of any size."""
    return F.struct("size", F.xxhash64("code", "key", F.lit(turn)))


def grown(roots: DataFrame, found: DataFrame) -> DataFrame:
    """Components with new links; what is connected already goes in as stars, so few steps are left."""
    return components(found.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))


def open_links(buckets: DataFrame, sizes: DataFrame, roots: DataFrame, done: DataFrame, sets: DataFrame, near: NearDup) -> DataFrame:
    """``a, b`` that connect all linked nodes which share a bucket, are not connected and were never centre there.

    The nodes of a bucket are dealt into blocks. Two blocks meet in one place and only links that connect something
    new leave it. A component that fills a block has blocks of its own, which do not meet each other.
    """
    state = sizes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    members = buckets.join(done, ["key", "node"], "left_anti").join(state, "node")
    parts = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"))
    spread = parts.groupBy("key").agg(F.count(F.lit(1)).alias("roots")).filter("roots > 1").select("key")
    pool = F.when(F.col("size") >= near.block, F.col("root")).otherwise(-1).alias("pool")
    left = members.join(spread, "key").join(parts, ["key", "root"]).select("key", "node", "root", pool)
    left = materialise(left, "open")
    placed = number_within(left, ["key", "pool"], ["node"], "place", left.count())
    placed = materialise(placed.withColumn("part", F.floor(F.col("place") / near.block)).drop("place"), "blocks")
    blocks = placed.select("key", "pool", "part").distinct()
    blocks = blocks.withColumn("own", F.row_number().over(Window.partitionBy("key").orderBy("pool", "part")))
    blocks = materialise(blocks, "blocks")
    ours = blocks.select("key", F.col("own").alias("i"), F.col("pool").alias("pool_i"))
    theirs = blocks.select("key", F.col("own").alias("j"), F.col("pool").alias("pool_j"))
    meet = ours.join(theirs, "key").filter("i <= j and (pool_i <> pool_j or pool_i = -1)").select("key", "i", "j")
    ends = meet.withColumn("own", F.explode(F.array_distinct(F.array("i", "j"))))
    rows = placed.join(blocks, ["key", "pool", "part"]).join(ends, ["key", "own"]).join(sets, "node")
    percent, block = near.percent, near.block

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, other = [], []
        for met in runs(batches, ("key", "i", "j"), 2 * block):
            ids, root, own = (met.column(c).to_numpy() for c in ("node", "root", "own"))
            hashes = [np.frombuffer(h, np.uint64) for h in met.column("hashes").to_pylist()]
            for x, y in connecting(hashes, root, own == own.min(), own == own.max(), percent):
                one.append(min(ids[x], ids[y]))
                other.append(max(ids[x], ids[y]))
        yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(other, pa.int64())], ["a", "b"])

    dealt = rows.select("key", "i", "j", "own", "node", "root", "hashes").repartition("key", "i", "j")
    return dealt.sortWithinPartitions("key", "i", "j", "own", "node").mapInArrow(compare, "a long, b long").distinct()


def connecting(sets: list[np.ndarray], roots: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """Similar pairs of a left and a right set that join two components, as positions."""
    sizes = np.array([len(s) for s in sets])
    group = np.unique(roots, return_inverse=True)[1]
    if group.max() == 0:
        return
    code = np.split(np.unique(np.concatenate(sets), return_inverse=True)[1], np.cumsum(sizes)[:-1])
    marked = np.zeros(max(int(c.max()) for c in code) + 1, bool)
    both_sides = left & right
    for x in np.flatnonzero(left):
        fits = 100 * np.minimum(sizes, sizes[x]) >= percent * np.maximum(sizes, sizes[x])
        meet = right & fits & (group != group[x])
        meet[: x + 1] &= ~both_sides[: x + 1]
        others = np.flatnonzero(meet)
        if not len(others):
            continue
        marked[code[x]] = True
        first = np.cumsum(sizes[others]) - sizes[others]
        both = np.add.reduceat(marked[np.concatenate([code[y] for y in others])], first, dtype=np.int64)
        marked[code[x]] = False
        for y in others[100 * both >= percent * (sizes[x] + sizes[others] - both)]:
            if group[x] != group[y]:
                group[group == group[y]] = group[x]
                yield int(x), int(y)


def dedup(docs: DataFrame, near: NearDup | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of the documents that stay, with all their columns: one of each group.

    Rows are decided by id and text, so rows that share an id, or have none, don't keep each other. Of rows that agree in
    both one stays, any; texts without words all stay. Nulls, long texts and empty tables as in :func:`near_groups`.
    """
    by_text = grouped(docs, near or NearDup(), id_col, text_col).groupBy("doc_id", "text_code")
    decided = by_text.agg(
        F.bool_or("kept").alias("kept"), F.count(F.lit(1)).alias("rows"), F.max("n_shingles").alias("n_shingles")
    )
    decided = materialise(decided, "decided")
    by_id = decided.groupBy("doc_id").agg(F.bool_or("kept").alias("kept"), F.sum("rows").alias("rows"))
    by_id = materialise(by_id.filter("not kept or rows > 1"), "gone-near")
    # The ids that go are the smaller side by far: few enough, Spark sends them instead of moving all texts.
    gone = by_id.filter("not kept").select(F.col("doc_id").alias("gone_id"))
    left = docs.join(gone, docs[id_col].cast("long").eqNullSafe(gone["gone_id"]), "left_anti")
    if by_id.filter("kept").isEmpty():
        return left
    code = free_name(docs, "text_code")
    marked = left.withColumn(code, F.md5(text_of(text_col).cast("binary")))

    def same(those: DataFrame) -> Column:
        return marked[id_col].cast("long").eqNullSafe(those["that_id"]) & (marked[code] == those["that_code"])

    named = decided.withColumnsRenamed({"doc_id": "that_id", "text_code": "that_code"})
    out = named.filter("not kept").select("that_id", "that_code")
    again = named.filter("kept and rows > 1 and n_shingles > 0").select("that_id", "that_code")
    stay = marked.join(out, same(out), "left_anti")
    if again.isEmpty():
        return stay.drop(code)
    single = stay.join(again, same(again), "left_anti")
    return single.unionByName(stay.join(again, same(again), "left_semi").dropDuplicates([id_col, code])).drop(code)
