"""Hard negatives by rotated one-bit codes: popcounts and a residual bound leave few pairs to be scored."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epigauge.llm.common import finite_rows
from epigauge.session import materialise

#: Squared length of an integer vector from which on inner products would not be exact any more.
TOO_LONG = 1 << 53
#: Rounding of the bounds, as a share of the vectors' lengths; doubles are a million times finer.
ROUNDING = 1e-9
#: Stands for a null id inside the search, behind all others.
NO_ID = (1 << 63) - 1


@dataclass(frozen=True)
class Mining:
    """``positives`` a row's own label gives, ``negatives`` for each, which score at least ``least`` percent of it.

    ``scale`` makes components integers; ``planes`` are the bits of an anchor's components that meet the codes,
    ``block`` rows that anchors meet at once, ``anchors`` as many of these at once.
    """

    positives: int = 5
    negatives: int = 5
    least: int = 80
    scale: int = 256
    planes: int = 8
    block: int = 8_192
    anchors: int = 128
    seed: int = 12


def rotation(width: int, seed: int) -> np.ndarray:
    """A random rotation, the same everywhere."""
    return np.linalg.qr(np.random.default_rng([seed, width]).standard_normal((width, width)))[0]


def words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words, zeros at the end."""
    packed = np.packbits(bits, axis=1)
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))).view(np.uint64)


class Coded:
    """Some rows: integers, and of the rotated vector the signs, its length along them and what is left of it."""

    def __init__(self, ints: list[bytes], codes: list[bytes], along: np.ndarray, rest: np.ndarray):
        n = len(ints)
        self.ints = np.frombuffer(b"".join(ints), "<i8").astype(np.float64).reshape(n, -1)
        self.codes = np.frombuffer(b"".join(codes), np.uint64).reshape(n, -1)
        self.along, self.rest = along, rest
        self.ones = np.bitwise_count(self.codes).sum(1).astype(np.float64)


def encoded(x: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signs of the rotated rows as words; the rows' lengths along their signs' direction and across it."""
    turned = x @ rotation(x.shape[1], seed).T
    along = np.abs(turned).sum(1) / np.sqrt(max(1, x.shape[1]))
    rest = np.sqrt(np.maximum(0, (turned * turned).sum(1) - along * along))
    return words(turned > 0), along, rest


class Anchors:
    """Some anchors, ready to meet codes: their rotated components as ``planes`` bits each."""

    def __init__(self, ints: np.ndarray, mining: Mining):
        self.ints, self.planes = ints, mining.planes
        turned = ints @ rotation(ints.shape[1], mining.seed).T
        self.length = np.sqrt((turned * turned).sum(1))
        self.width = max(1, ints.shape[1])
        levels = (1 << mining.planes) - 1
        self.low = turned.min(1, initial=0)
        self.step = np.maximum(turned.max(1, initial=0) - self.low, 1e-300) / levels
        level = np.rint((turned - self.low[:, None]) / self.step[:, None])
        told = self.low[:, None] + self.step[:, None] * level
        self.total = told.sum(1)
        self.untold = np.sqrt(((turned - told) ** 2).sum(1))
        level = level.astype(np.int64)
        self.bits = [words((level >> b) & 1 == 1) for b in range(mining.planes)]

    def bounds(self, rows: Coded) -> tuple[np.ndarray, np.ndarray]:
        """Between which two numbers each inner product surely is.

        A row is its part along its signs' unit direction u and a rest r across it. The product with an anchor z is
        along * (z.u) + (z across u).r: popcounts give z.u up to the anchor's untold part, and the second term is at most
        the product of the lengths (Cauchy-Schwarz).
        """
        counts = np.zeros((len(self.ints), len(rows.ones)), np.float64)
        for b, plane in enumerate(self.bits):
            for w in range(plane.shape[1]):
                counts += np.float64(1 << b) * np.bitwise_count(plane[:, w, None] & rows.codes[None, :, w])
        along = (2 * (self.low[:, None] * rows.ones + self.step[:, None] * counts) - self.total[:, None]) / np.sqrt(self.width)
        sure = np.maximum(0, np.abs(along) - self.untold[:, None])
        across = np.sqrt(np.maximum(0, self.length[:, None] ** 2 - sure * sure))
        slack = ROUNDING * self.length[:, None] * (rows.along + rows.rest) + ROUNDING
        half = rows.along * self.untold[:, None] + rows.rest * across + slack
        middle = along * rows.along
        return middle - half, middle + half


def bar(low: np.ndarray, sure: np.ndarray, most: int) -> np.ndarray:
    """A score that ``most`` of each line's ``sure`` entries reach, so that nothing below it is among the first ``most``."""
    if low.shape[1] < most:
        return np.full((len(low), 1), -np.inf)
    at = low.shape[1] - most
    return np.partition(np.where(sure, low, -np.inf), at, axis=1)[:, at, None]


def scores(anchors: np.ndarray, rows: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Exact inner products at the marked pairs, 0 elsewhere."""
    out = np.zeros(pairs.shape, np.int64)
    one, other = np.nonzero(pairs)
    for at in range(0, len(one), 65_536):
        a, r = one[at : at + 65_536], other[at : at + 65_536]
        out[a, r] = np.einsum("ij,ij->i", anchors[a], rows[r]).astype(np.int64)
    return out


def best(score: np.ndarray, wanted: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Line and column of the first ``most`` wanted entries of each line: high scores first, then small ids."""
    line, column = np.nonzero(wanted)
    order = np.lexsort((ids[column], -score[line, column], line))
    line, column = line[order], column[order]
    place = np.arange(len(line)) - np.searchsorted(line, line)
    return line[place < most], column[place < most]


def prepared(vectors: DataFrame, mining: Mining, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """``row, vec_id, label, ints, code, along, rest`` of the rows that take part."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["vec_id", "label", "ints", "code", "along", "rest"]
        for rows in batches:
            for at, x in finite_rows(rows.column("vector")):
                x = np.floor(x * mining.scale)
                if (x * x).sum(axis=1).max() >= TOO_LONG:
                    raise ValueError("a vector is too long for exact scores: scale the components down")
                signs, along, rest = encoded(x, mining.seed)
                taken = rows.take(pa.array(at))
                columns = [
                    taken.column("vec_id"),
                    taken.column("label"),
                    pa.array([v.tobytes() for v in x.astype("<i8")], pa.binary()),
                    pa.array([v.tobytes() for v in signs], pa.binary()),
                    pa.array(along, pa.float64()),
                    pa.array(rest, pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    chosen = vectors.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("vec_id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    ).dropna(subset=["label", "vector"])
    coded = chosen.mapInArrow(code, "vec_id long, label string, ints binary, code binary, along double, rest double")
    return coded.withColumn("row", F.monotonically_increasing_id())


FOUND = "anchor long, place int, row long, vec_id long, score long"


def met(rows: DataFrame, anchors: DataFrame, blocks: int, mining: Mining, bars: bool) -> DataFrame:
    """``anchor, place, row, vec_id, score``: for every anchor the first rows of each block of rows.

    Without ``bars`` these are its positives (``place`` is 0); with them, the negatives of each of its positives.
    Every block of rows is in one place, and all anchors pass by it, some at a time.
    """
    names = ["row", "vec_id", "label", "ints", "code", "along", "rest", "bars"]
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block")
    nothing = F.lit(None).cast("array<long>").alias("bars")
    ours = rows.select(block, F.lit(False).alias("is_anchor"), *names[:-1], nothing)
    meet = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block")
    theirs = anchors.select(meet, F.lit(True).alias("is_anchor"), *names[:-1], "bars" if bars else nothing)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, waiting, state = None, [], [], None
        for batch in batches:
            for values in zip(*(batch.column(c).to_pylist() for c in ("block", "is_anchor", *names)), strict=True):
                at, is_anchor, *row = values
                if at != now or (is_anchor and len(waiting) == mining.anchors):
                    yield from answer(state, waiting, mining)
                    waiting = []
                if at != now:
                    now, held, state = at, [], None
                if not is_anchor:
                    held.append(row)
                    continue
                if state is None:
                    state, held = Block(held), []
                waiting.append(row)
        yield from answer(state, waiting, mining)

    both = ours.unionByName(theirs)
    dealt = both.repartition(blocks, "block").sortWithinPartitions("block", "is_anchor", "row")
    return dealt.mapInArrow(search, FOUND)


class Block:
    """A block of rows, by length of their vectors (vectors of different lengths don't meet)."""

    def __init__(self, rows: list[list]):
        self.by_width = {}
        for row in rows:
            self.by_width.setdefault(len(row[3]), []).append(row)
        for width, found in self.by_width.items():
            row, ids, labels, ints, codes, along, rest, _ = zip(*found, strict=True)
            known = {label: n for n, label in enumerate(dict.fromkeys(labels))}
            coded = Coded(list(ints), list(codes), np.array(along), np.array(rest))
            label = np.array([known[v] for v in labels])
            self.by_width[width] = (np.array(row), np.array(ids), known, label, coded)


def answer(block: Block | None, waiting: list[list], mining: Mining) -> Iterator[pa.RecordBatch]:
    """What some anchors find in a block."""
    by_width: dict[int, list[list]] = {}
    for row in waiting:
        by_width.setdefault(len(row[3]), []).append(row)
    for width, found in by_width.items():
        if block is None or width not in block.by_width:
            continue
        rows, ids, known, label, coded = block.by_width[width]
        me, _, labels, ints, _, _, _, bars = zip(*found, strict=True)
        anchors = Anchors(np.frombuffer(b"".join(ints), "<i8").astype(np.float64).reshape(len(ints), -1), mining)
        low, high = anchors.bounds(coded)
        same = np.array([known.get(v, -1) for v in labels])[:, None] == label
        me = np.array(me)
        if bars[0] is None:
            wanted = same & (me[:, None] != rows)
            wanted &= high >= bar(low, wanted, mining.positives)
            score = scores(anchors.ints, coded.ints, wanted)
            parts = [(0, *best(score, wanted, ids, mining.positives))]
        else:
            lines = []
            some = np.zeros(low.shape, bool)
            for place in range(max(map(len, bars))):
                top = np.array([b[place] if place < len(b) else -1 for b in bars], np.int64)[:, None]
                may = ~same & (top >= 0) & (low <= top) & (100 * high >= mining.least * top)
                sure = may & (high <= top) & (100 * low >= mining.least * top)
                may &= high >= bar(low, sure, mining.negatives)
                some |= may
                lines.append((top, may))
            score = scores(anchors.ints, coded.ints, some)
            parts = []
            for place, (top, may) in enumerate(lines):
                fits = may & (score <= top) & (100 * score >= mining.least * top)
                parts.append((place, *best(score, fits, ids, mining.negatives)))
        for place, line, column in parts:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(me[line], pa.int64()),
                    pa.array(np.full(len(line), place), pa.int32()),
                    pa.array(rows[column], pa.int64()),
                    pa.array(ids[column], pa.int64()),
                    pa.array(score[line, column], pa.int64()),
                ],
                ["anchor", "place", "row", "vec_id", "score"],
            )


def first(found: DataFrame, most: int) -> DataFrame:
    """The first rows over all blocks, with their ``rank`` from 1."""
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    mining: Mining | None = None,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows where ``is_anchor`` holds.

    ``is_anchor`` is a condition on ``vec_id``. Rows with a null label, a null vector, or a null or non-finite component take no part. Scores are inner products
    of the integer vectors; equal scores go by the smaller id, null ids last. Repeated rows, of one id too, are rows of their own: each may be an anchor
    and the others its positives. Vectors of different lengths have no score. Positives with negative scores have no negatives. Ids must
    be whole numbers; components too large for exact scores stop the job with a message; other columns are not looked
    at. An empty table gives an empty one.

    Anchors meet all rows, block by block: nothing is left out that the bounds don't exclude. The first rows of each block
    are combined at the end, so what is shuffled is anchors x blocks x ``positives`` (then x ``negatives``).
    """
    mining = mining or Mining()
    rows = materialise(prepared(vectors, mining, id_col, label_col, vector_col), "coded")
    blocks = max(1, -(-rows.count() // mining.block))
    chosen = rows.filter(is_anchor & (F.col("vec_id") != NO_ID))
    positives = first(met(rows, chosen, blocks, mining, bars=False), mining.positives)
    positives = materialise(positives.select("anchor", "rank", "vec_id", "score"), "positives")
    ranked = F.array_sort(F.collect_list(F.struct("rank", "score")))
    bars = positives.groupBy("anchor").agg(F.transform(ranked, lambda p: p["score"]).alias("bars"))
    asked = chosen.join(bars.withColumnRenamed("anchor", "row"), "row")
    negatives = first(met(rows, asked, blocks, mining, bars=True), mining.negatives)
    negatives = negatives.select("anchor", "place", F.col("rank"), F.col("vec_id").alias("negative"), F.col("score").alias("negative_score"))
    own = positives.select("anchor", (F.col("rank") - 1).alias("place"), F.col("vec_id").alias("positive"), F.col("score").alias("positive_score"))
    ids = chosen.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    named = negatives.join(own, ["anchor", "place"]).join(ids, "anchor")
    return named.select(
        "anchor_id",
        F.nullif("positive", F.lit(NO_ID)).alias("positive_id"),
        "rank",
        F.nullif("negative", F.lit(NO_ID)).alias("negative_id"),
        "positive_score",
        "negative_score",
    )
