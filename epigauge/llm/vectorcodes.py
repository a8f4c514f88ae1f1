"""Vector code compression: integer codebooks by part, nearest entries found through a tree with distance ranges (GNAT)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epigauge.llm.common import finite_rows
from epigauge.llm.nndescent import matrix
from epigauge.session import materialise

#: Squared length of an integer vector from which on squared distances would not be exact any more.
TOO_LONG = 1 << 50
#: Vectors that meet the tree at once.
QUERIES = 8_192
#: Distances are square roots of whole numbers: rounded by less than this share, either way.
ROUNDING = 1e-12


@dataclass(frozen=True)
class Codes:
    """``parts`` of a vector, ``entries`` of each part's codebook, ``rounds`` of refinement, ``scale`` of the integers."""

    parts: int = 4
    entries: int = 256
    rounds: int = 4
    scale: int = 1024


def squared(queries: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of integer vectors held as doubles; exact, as all sums are whole numbers below 2^53."""
    return (queries * queries).sum(1)[:, None] + (entries * entries).sum(1)[None, :] - 2 * (queries @ entries.T)


@dataclass
class Node:
    """A leaf's ``points``, or split points with a child each; ``low`` and ``high`` [i, j] bound the distances
    between split point i and all that is in child j, split point j included."""

    points: np.ndarray
    children: list[Node | None]
    low: np.ndarray | None = None
    high: np.ndarray | None = None


class Gnat:
    """Nearest entries, ties to the lower index, without meeting all entries."""

    def __init__(self, entries: np.ndarray, degree: int = 16, leaf: int = 32):
        self.entries = entries.astype(np.float64)
        self.degree, self.leaf = degree, leaf
        self.root = self._build(np.arange(len(entries)))
        self.met = 0

    def _build(self, points: np.ndarray) -> Node:
        if len(points) <= self.leaf:
            return Node(points, [])
        here = self.entries[points]
        between = squared(here, here)
        # Split points far apart: each next one is the farthest from those before.
        chosen = [0]
        nearest = between[0].copy()
        while len(chosen) < self.degree:
            nearest[chosen] = -1
            chosen.append(int(np.argmax(nearest)))
            nearest = np.minimum(nearest, between[chosen[-1]])
        chosen = np.sort(chosen)
        rest = np.setdiff1d(np.arange(len(points)), chosen)
        owner = np.argmin(between[rest][:, chosen], axis=1)
        distance = np.sqrt(between[chosen])
        low, high = np.empty((2, self.degree, self.degree))
        children: list[Node | None] = []
        for j in range(self.degree):
            inside = rest[owner == j]
            covered = distance[:, np.append(inside, chosen[j])]
            low[:, j], high[:, j] = covered.min(1) * (1 - ROUNDING), covered.max(1) * (1 + ROUNDING)
            children.append(self._build(points[inside]) if len(inside) else None)
        return Node(points[chosen], children, low, high)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each query's nearest entry, as integers."""
        x = queries.astype(np.float64)
        best, at = np.full(len(x), np.inf), np.full(len(x), len(self.entries))
        if len(x):
            self._visit(self.root, x, np.arange(len(x)), best, at)
        return at, best.astype(np.int64)

    def _visit(self, node: Node, x: np.ndarray, rows: np.ndarray, best: np.ndarray, at: np.ndarray) -> None:
        d2 = squared(x[rows], self.entries[node.points])
        self.met += d2.size
        first = np.argmin(d2, axis=1)  # the lowest index of equals: points are in order
        value, index = d2[np.arange(len(rows)), first], node.points[first]
        better = (value < best[rows]) | ((value == best[rows]) & (index < at[rows]))
        best[rows[better]], at[rows[better]] = value[better], index[better]
        if not node.children:
            return
        distance = np.sqrt(d2)
        for j, child in enumerate(node.children):  # the own child first: the bounds of the others get tight
            if child is not None and (first == j).any():
                self._visit(child, x, rows[first == j], best, at)
        for j, child in enumerate(node.children):
            if child is None:
                continue
            # Whatever lies in child j is at least this far; a subtree goes only if that is farther than the best.
            least = np.maximum(distance * (1 - ROUNDING) - node.high[:, j], node.low[:, j] - distance * (1 + ROUNDING)).max(1)
            open_ = (first != j) & (least <= np.sqrt(best[rows]) * (1 + ROUNDING))
            if open_.any():
                self._visit(child, x, rows[open_], best, at)


def integers(vectors: DataFrame, scale: int, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """``vec_id, label, ints`` (little-endian 64-bit) of the vectors without null or non-finite components."""

    def floor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for at, x in finite_rows(rows.column("vector")):
                x = np.floor(x * scale)
                if (x * x).sum(axis=1).max() >= TOO_LONG:
                    raise ValueError("a vector is too long for exact distances: scale the components down")
                taken, ints = rows.take(pa.array(at)), [v.tobytes() for v in x.astype("<i8")]
                named = [taken.column("vec_id"), taken.column("label"), pa.array(ints, pa.binary())]
                yield pa.RecordBatch.from_arrays(named, ["vec_id", "label", "ints"])

    vector = F.col(vector_col).cast("array<double>").alias("vector")
    chosen = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), vector)
    return chosen.mapInArrow(floor, chosen.select("vec_id", "label", F.lit(b"").alias("ints")).schema)


class Codebooks:
    """The entries of every part: one matrix a part, as many rows as entries."""

    def __init__(self, entries: list[np.ndarray]):
        self.entries = entries

    @classmethod
    def first(cls, vectors: np.ndarray, parts: int) -> Codebooks:
        if vectors.shape[1] % parts:
            raise ValueError(f"vectors of {vectors.shape[1]} components don't divide into {parts} parts")
        return cls(np.split(vectors, parts, axis=1))

    def sha256(self) -> str:
        numbers = np.concatenate([e.ravel() for e in self.entries]).tolist()
        return hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()

    def trees(self) -> list[Gnat]:
        return [Gnat(e) for e in self.entries]

    def parts_of(self, column: pa.Array) -> Iterator[list[np.ndarray]]:
        """Some rows' vectors at a time, cut into parts."""
        width = sum(e.shape[1] for e in self.entries)
        for at in range(0, len(column), QUERIES):
            some = column.slice(at, QUERIES)
            if any(len(v) != 8 * width for v in some.to_pylist()):
                raise ValueError("vectors of different lengths have no common codebooks")
            rows = matrix(some, "<i8") if width else np.zeros((len(some), 0), np.int64)
            yield np.split(rows, len(self.entries), axis=1)


def sums_by_entry(ints: DataFrame, books: Codebooks) -> DataFrame:
    """``part, entry, n, at, total``: how many parts each entry is nearest to, and their sums by component."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = books.trees()
        total = [np.zeros_like(e) for e in books.entries]
        count = [np.zeros(len(e), np.int64) for e in books.entries]
        for rows in batches:
            for cut in books.parts_of(rows.column("ints")):
                for p, (tree, x) in enumerate(zip(trees, cut, strict=True)):
                    at, _ = tree.nearest(x)
                    count[p] += np.bincount(at, minlength=len(count[p]))
                    np.add.at(total[p], at, x)
        part, entry, n, sums = [], [], [], []
        for p in range(len(total)):
            used = np.flatnonzero(count[p])
            part += [p] * len(used)
            entry += used.tolist()
            n += count[p][used].tolist()
            sums += total[p][used].tolist()
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((part, entry, n, sums), kinds, strict=True)], ["part", "entry", "n", "sums"])

    found = ints.select("ints").mapInArrow(assign, "part int, entry int, n long, sums array<long>")
    each = found.select("part", "entry", "n", F.posexplode("sums").alias("at", "value"))
    return each.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("value").alias("total"))


def fit(ints: DataFrame, codes: Codes) -> Codebooks | None:
    """Codebooks after ``rounds`` of assigning all parts and moving each entry to the floor of its parts' mean.

    ``ints`` is read once a round, so it should be a written table. The start are the vectors with the smallest ids; null ids
    come last, of equal ids the smaller bytes first. What reaches the driver is bounded by the codebooks' size. None for
    an empty table.
    """
    order = (F.col("vec_id").asc_nulls_last(), F.col("ints"))
    start = [r["ints"] for r in ints.select("vec_id", "ints").orderBy(*order).limit(codes.entries).collect()]
    if not start:
        return None
    if len({len(v) for v in start}) > 1:
        raise ValueError("vectors of different lengths have no common codebooks")
    vectors = np.frombuffer(b"".join(start), "<i8").reshape(len(start), -1).astype(np.int64)
    books = Codebooks.first(vectors, codes.parts)
    for _ in range(codes.rounds):
        entries = [e.copy() for e in books.entries]
        for r in sums_by_entry(ints, books).collect():
            entries[r["part"]][r["entry"], r["at"]] = r["total"] // r["n"]
        books = Codebooks(entries)
    return books


def coded(ints: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id, label, code, error``: each part's nearest entry as two hex digits or more, and the squared distances' sum."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = books.trees()
        digits = [[f"{i:02x}" for i in range(len(e))] for e in books.entries]
        for rows in batches:
            code, error = [], []
            for cut in books.parts_of(rows.column("ints")):
                found = [tree.nearest(x) for tree, x in zip(trees, cut, strict=True)]
                names = [[d[i] for i in at.tolist()] for d, (at, _) in zip(digits, found, strict=True)]
                code += map("".join, zip(*names, strict=True))
                error += sum(e for _, e in found).tolist()
            yield pa.RecordBatch.from_arrays(
                [rows.column("vec_id"), rows.column("label"), pa.array(code, pa.string()), pa.array(error, pa.int64())],
                ["vec_id", "label", "code", "error"],
            )

    schema = ints.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).schema
    return ints.mapInArrow(assign, schema)


def compress(
    vectors: DataFrame,
    codes: Codes | None = None,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
) -> tuple[DataFrame, Codebooks | None]:
    """``vec_id, label, code, error`` of every vector that can be coded, and the codebooks.

    Vectors that are null or hold null or non-finite components are dropped. All others are coded, repeated rows and those with null ids
    or labels too; ties go to the lower entry. Vectors must share one length that the parts divide, else the job fails with
    a message, as for components too large for exact integers. Ids must be whole numbers; other columns are not looked at. An empty table gives
    an empty one and no codebooks.
    """
    codes = codes or Codes()
    ints = materialise(integers(vectors, codes.scale, id_col, label_col, vector_col), "integers")
    books = fit(ints, codes)
    return coded(ints, books or Codebooks([np.zeros((0, 0), np.int64)] * codes.parts)), books


def with_label_error(found: DataFrame, books: Codebooks | None) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256, label`` of what :func:`compress` gives."""
    found = materialise(found, "codes")
    by_label = found.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error"))
    joined = found.join(by_label, F.col("label").eqNullSafe(F.col("same")))
    digest = F.lit(books.sha256() if books else "").alias("codebooks_sha256")
    return joined.select("vec_id", "code", "error", "label_error", digest, "label")
