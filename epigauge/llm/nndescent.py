"""Embedding near-dedup by NN-descent: neighbour lists refined through neighbours of neighbours."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epigauge.llm.common import number_within
from epigauge.llm.graph import components
from epigauge.session import materialise


@dataclass(frozen=True)
class Descent:
    """``cosine`` that links two vectors, and how the search goes about it.

    ``neighbours`` is the length of a list, ``longest`` that to which a list grows that is full of links, ``growth``
    times as long at a step, ``orders`` the number of random orders that fill the first lists from runs of ``run`` vectors, ``steps`` the refinements before an audit. The audit takes
    ``audited`` vectors; below ``recall`` the search goes on with new orders, at most ``rounds`` times.
    ``block`` vectors of a clump are compared at once.
    """

    cosine: float = 0.93
    neighbours: int = 8
    longest: int = 64
    growth: int = 2
    orders: int = 6
    run: int = 64
    steps: int = 2
    audited: int = 512
    recall: float = 0.999
    rounds: int = 4
    block: int = 512
    bits: int = 24


def matrix(column: pa.Array, kind: str) -> np.ndarray:
    """Equally long binary values as the rows of a matrix."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1)


def runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str], most: int) -> Iterator[pa.Table]:
    """Consecutive rows that agree in ``keys``, at most ``most`` at a time."""
    left: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if left is not None:
            rows = pa.concat_tables([left, rows]).combine_chunks()
        if not rows.num_rows:
            continue
        new = np.zeros(rows.num_rows, bool)
        new[0] = True
        for k in keys:
            values = rows.column(k).to_numpy(zero_copy_only=False)
            new[1:] |= values[1:] != values[:-1]
        edges = [*np.flatnonzero(new).tolist(), rows.num_rows]
        for a, b in zip(edges[:-2], edges[1:-1], strict=True):
            for at in range(a, b, most):
                yield rows.slice(at, min(most, b - at))
        a, b = edges[-2:]
        while b - a > most:
            yield rows.slice(a, most)
            a += most
        left = rows.slice(a)
    if left is not None and left.num_rows:
        yield left


def units(vectors: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """``vec_id, label, unit`` (double) of the vectors that can be compared at all."""

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            ids, labels, out = [], [], []
            columns = (rows.column(c).to_pylist() for c in ("vec_id", "label", "vector"))
            for i, label, values in zip(*columns, strict=True):
                if label is None or not values or None in values:
                    continue
                x = np.array(values, np.float64)
                largest = np.abs(x).max()
                if not np.isfinite(largest) or largest == 0:
                    continue
                x = x / largest
                ids.append(i)
                labels.append(label)
                out.append((x / np.sqrt(x @ x)).tobytes())
            kinds = (pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip((ids, labels, out), kinds, strict=True)], ["vec_id", "label", "unit"]
            )

    chosen = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    return chosen.mapInArrow(scale, "vec_id long, label string, unit binary")


def top(a: np.ndarray, b: np.ndarray, sims: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sims, pa.float32())], ["u", "v", "sim"])


def gathered(found: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], rows: int = 200_000) -> Iterator[pa.RecordBatch]:
    """Many small results as few batches."""
    held, n = [], 0
    for part in found:
        held.append(part)
        n += len(part[0])
        if n >= rows:
            yield top(*(np.concatenate(c) for c in zip(*held, strict=True)))
            held, n = [], 0
    if held:
        yield top(*(np.concatenate(c) for c in zip(*held, strict=True)))


EDGE = "u long, v long, sim float"


def first_lists(nodes: DataFrame, descent: Descent, turn: int) -> DataFrame:
    """``u, v, sim`` from runs of vectors that stand together in random orders.

    An order sorts the vectors of a label by the signs of their projections on random directions. Ranges of the
    order go to tasks, so a crowded place is spread over several.
    """
    orders, bits, k, run = descent.orders, descent.bits, descent.neighbours, descent.run

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for rows in batches:
            values = rows.column("unit").to_pylist()
            for width in sorted({len(v) for v in values}):
                at = [i for i, v in enumerate(values) if len(v) == width]
                x = np.frombuffer(b"".join(values[i] for i in at), np.float64).reshape(len(at), -1)
                if width not in planes:
                    rng = np.random.default_rng([turn, width])
                    planes[width] = rng.standard_normal((orders, bits + 1, x.shape[1]))
                small = [r.tobytes() for r in x.astype(np.float32)]
                for o in range(orders):
                    p = x @ planes[width][o].T
                    signs = (p[:, :bits] > 0) @ (1 << np.arange(bits)[::-1])
                    kept = rows.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays(
                        [
                            kept.column("block"),
                            pa.array(np.full(len(at), o), pa.int32()),
                            pa.array(signs, pa.int64()),
                            pa.array(p[:, bits], pa.float64()),
                            kept.column("node"),
                            pa.array(small, pa.binary()),
                        ],
                        ["block", "turn", "signs", "along", "node", "small"],
                    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for rows in runs(batches, ("block", "turn"), run):
                ids = rows.column("node").to_numpy()
                if len(ids) < 2:
                    continue
                x = matrix(rows.column("small").combine_chunks(), "f4")
                sims = x @ x.T
                np.fill_diagonal(sims, -2)
                best = np.argsort(-sims, axis=1)[:, : min(k, len(ids) - 1)]
                yield np.repeat(ids, best.shape[1]), ids[best].ravel(), np.take_along_axis(sims, best, 1).ravel()

        return gathered(found())

    keys = "block long, turn int, signs long, along double, node long, small binary"
    order = ["block", "turn", "signs", "along"]
    placed = materialise(nodes.select("node", "block", "unit").mapInArrow(project, keys), "orders")
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(compare, EDGE)


def best_lists(found: DataFrame, neighbours: int, grown: DataFrame | None = None) -> DataFrame:
    """The ``neighbours`` most similar of each vector, of those in ``grown`` (node, longer) so many; every find counts for both ends."""
    both = found.unionByName(found.select(F.col("v").alias("u"), F.col("u").alias("v"), "sim"))
    once = both.groupBy("u", "v").agg(F.max("sim").alias("sim"))
    place = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("sim"), "v"))
    if grown is None:
        return once.withColumn("place", place).filter(F.col("place") <= neighbours).drop("place")
    usual = once.join(grown, once["u"] == grown["node"], "left_anti")
    usual = usual.withColumn("place", place).filter(F.col("place") <= neighbours).drop("place")
    longer = once.join(grown, once["u"] == grown["node"]).withColumn("place", place).filter("place <= longer")
    return usual.unionByName(longer.select("u", "v", "sim"))


def full_lists(lists: DataFrame, length: int, cosine: float) -> DataFrame:
    """``node`` of the vectors whose lists hold ``length`` links or more and nothing else: there may be more."""
    ends = lists.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.min("sim").alias("low"))
    return ends.filter((F.col("n") >= length) & (F.col("low") >= cosine - 1e-4)).select(F.col("u").alias("node"))


def grown_lists(nodes: DataFrame, lists: DataFrame, grown: DataFrame | None, descent: Descent, turn: int) -> tuple[DataFrame, DataFrame | None]:
    """Lists that are full of links, ``growth`` times as long until they are not, or as long as they may get.

    A link is hidden only if the lists at both of its ends are full. So these vectors alone are put in new orders, in
    longer runs, and meet their neighbours' neighbours.
    """
    length = descent.neighbours
    while length < descent.longest:
        full = materialise(full_lists(lists, length, descent.cosine), "full")
        if full.isEmpty():
            break
        length = min(descent.growth * length, descent.longest)
        longer = full.withColumn("longer", F.lit(length))
        if grown is not None:
            longer = longer.unionByName(grown.join(full, "node", "left_anti"))
        grown = materialise(longer, "grown")
        wide = replace(descent, neighbours=length, run=max(descent.run, 2 * length))
        some = nodes.join(full, "node", "left_semi")
        new = first_lists(some, wide, turn + 1_000 * length)
        near = refined(nodes, lists.join(full, lists["u"] == full["node"], "left_semi"), wide, turn + length)
        lists = materialise(best_lists(lists.unionByName(new).unionByName(near), descent.neighbours, grown), "lists")
    return lists, grown


def refined(nodes: DataFrame, lists: DataFrame, descent: Descent, turn: int) -> DataFrame:
    """One step: the neighbours (either way) of each vector meet there; finds better than either's list go on.

    A vector that is a neighbour of very many meets them in runs, which several tasks share.
    """
    bars = lists.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.min("sim").alias("low"))
    bars = bars.select(F.col("u").alias("node"), F.when(F.col("n") >= descent.neighbours, F.col("low")).otherwise(F.lit(-2.0)).alias("bar"))
    meet = lists.select(F.col("v").alias("at"), F.col("u").alias("node"))
    meet = meet.unionByName(lists.select(F.col("u").alias("at"), F.col("v").alias("node"))).distinct()
    state = nodes.select("node", "small").join(bars, "node")
    rows = meet.join(state, "node").withColumn("spin", F.xxhash64("node", F.lit(turn)))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for met in runs(batches, ("at",), descent.run):
                ids = met.column("node").to_numpy()
                if len(ids) < 2:
                    continue
                x, bar = matrix(met.column("small").combine_chunks(), "f4"), met.column("bar").to_numpy()
                sims = x @ x.T
                a, b = np.triu_indices(len(ids), 1)
                s = sims[a, b]
                better = s > np.minimum(bar[a], bar[b])
                if better.any():
                    yield ids[a[better]], ids[b[better]], s[better]

        return gathered(found())

    dealt = rows.repartitionByRange("at", "spin").sortWithinPartitions("at", "spin")
    return dealt.select("at", "node", "small", "bar").mapInArrow(join, EDGE)


def in_blocks(rows: DataFrame, group: str, order: str, size: int) -> DataFrame:
    """Every two blocks (``i``, ``j``) of ``size`` rows of a group in one place; ``own`` is the block of a row."""
    blocks = rows.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / size).alias("blocks"))
    placed = number_within(rows, [group], [order], "place", rows.count(), attach=blocks)
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    dealt = placed.select(*rows.columns, F.floor(F.col("place") / size).alias("own"), other)
    pair = dealt.select(*rows.columns, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own")
    return pair.repartition(group, "i", "j").sortWithinPartitions(group, "i", "j", order)


def clumped(nodes: DataFrame, lists: DataFrame, descent: Descent) -> DataFrame:
    """``node, root`` of vectors connected by links close to the bound, those behind full lists included."""
    close = lists.filter(F.col("sim") >= descent.cosine - 1e-4).select(F.col("u").alias("a"), F.col("v").alias("b"))
    clumps = materialise(components(close), "clumps")
    more = bridges(nodes, lists, clumps, descent)
    if more is None or more.isEmpty():
        return clumps
    stars = clumps.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return materialise(components(stars.unionByName(more)), "clumps")


def bridges(nodes: DataFrame, lists: DataFrame, clumps: DataFrame, descent: Descent) -> DataFrame | None:
    """``a, b``: a link for each two clumps that are linked between vectors whose longest lists are full of links.

    The last guard: such lists may hide links to other clumps. A clump's full vectors are dealt into cells with a centre and a widest
    angle; two cells of different clumps whose angles leave room for a link are compared in full.
    """
    cosine, block = descent.cosine, descent.block
    full = full_lists(lists, descent.longest, cosine)
    rows = clumps.join(full, "node").join(nodes.select("node", "block", "unit"), "node")
    rows = materialise(rows, "full")
    if rows.groupBy("block").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a < b").isEmpty():
        return None
    placed = number_within(rows, ["root"], ["node"], "place", rows.count())
    placed = placed.select("block", "root", F.floor(F.col("place") / block).alias("part"), "node", "unit")
    placed = materialise(placed, "placed")

    def centre(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for cell in runs(batches, ("root", "part"), block):
            x = matrix(cell.column("unit").combine_chunks(), "f8")
            c = x.mean(axis=0)
            size = np.sqrt(c @ c)
            c = c / size if size > 1e-6 else x[0]
            wide = float(np.arccos(np.clip(x @ c, -1, 1)).max())
            out.append((*(cell.column(k)[0].as_py() for k in ("block", "root", "part")), c.tobytes(), wide))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.float64())
        columns = list(zip(*out, strict=True)) or [[]] * len(kinds)
        names = ["block", "root", "part", "centre", "wide"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    cells = placed.repartition("root", "part").sortWithinPartitions("root", "part")
    cells = cells.mapInArrow(centre, "block long, root long, part long, centre binary, wide double")
    cells = materialise(cells.withColumn("cell", F.monotonically_increasing_id()), "cells")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, ("block", "i", "j"), 2 * block):
            cell, root, wide, own = (rows.column(k).to_numpy() for k in ("cell", "root", "wide", "own"))
            c = matrix(rows.column("centre").combine_chunks(), "f8")
            left, right = own == own.min(), own == own.max()
            apart = np.arccos(np.clip(c[left] @ c[right].T, -1, 1)) - wide[left][:, None] - wide[right][None, :]
            near = (apart <= np.arccos(cosine) + 1e-6) & (root[left][:, None] != root[right][None, :])
            if own.min() == own.max():
                near = np.triu(near)
            a, b = np.nonzero(near)
            yield pa.RecordBatch.from_arrays([pa.array(cell[left][a], pa.int64()), pa.array(cell[right][b], pa.int64())], ["one", "other"])

    slim = cells.select("block", "root", "cell", "centre", "wide")
    close = materialise(in_blocks(slim, "block", "cell", block).mapInArrow(meet, "one long, other long"), "close")
    ends = close.withColumn("cell", F.explode(F.array("one", "other")))
    both = ends.join(cells.select("cell", "root", "part"), "cell").join(placed.select("root", "part", "node", "unit"), ["root", "part"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for rows in runs(batches, ("one", "other"), 2 * block):
            ids = rows.column("node").to_numpy()
            x = matrix(rows.column("unit").combine_chunks(), "f8")
            left = rows.column("cell").to_numpy() == rows.column("one")[0].as_py()
            # One link joins the two clumps: their other links are counted where the joint clump is compared.
            a, b = np.nonzero(x[left] @ x[~left].T >= cosine)
            if len(a):
                out.append((ids[left][a[0]], ids[~left][b[0]]))
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    dealt = both.select("one", "other", "cell", "node", "unit").repartition("one", "other")
    return materialise(dealt.sortWithinPartitions("one", "other", "cell").mapInArrow(link, "a long, b long"), "bridges")


def linked(nodes: DataFrame, clumps: DataFrame, descent: Descent) -> tuple[DataFrame, DataFrame]:
    """Links counted per node (``node, links``: members of linked classes) and ``a, b`` that connect them.

    The members of a clump are compared in double, a block with a block at a time, and links are counted
    where they are found, never listed. Of the links of a pair of blocks those that connect it go on.
    """
    clumps = materialise(clumps.join(nodes.select("node", "unit", "weight"), "node"), "clumps")
    cosine, block = descent.cosine, descent.block

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(parts):
            n, links, a = (np.concatenate(c) for c in zip(*parts, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(links, pa.int64()), pa.array(a, pa.int64())], ["node", "links", "to"])

        held, size = [], 0
        for rows in runs(batches, ("root", "i", "j"), 2 * block):
            ids, weight, own = (rows.column(c).to_numpy() for c in ("node", "weight", "own"))
            x = matrix(rows.column("unit").combine_chunks(), "f8")
            left = own == rows.column("i")[0].as_py()
            same = rows.column("i")[0].as_py() == rows.column("j")[0].as_py()
            right = left if same else ~left
            near = x[left] @ x[right].T >= cosine
            if same:
                np.fill_diagonal(near, False)
            one, two = ids[left], ids[right]
            sums = [(one, near @ weight[right])] if same else [(one, near @ weight[right]), (two, weight[left] @ near)]
            # Smallest linked node, again and again, until nothing changes: the connected parts of this pair.
            mark_one, mark_two = one.copy(), mark_two_of(one, two, same)
            top_id = np.iinfo(np.int64).max
            while True:
                before = mark_one.sum(), mark_two.sum()
                mark_one = np.minimum(mark_one, np.where(near, mark_two[None, :], top_id).min(axis=1, initial=top_id))
                if same:
                    mark_two = mark_one
                mark_two = np.minimum(mark_two, np.where(near, mark_one[:, None], top_id).min(axis=0, initial=top_id))
                if same:
                    mark_one = mark_two
                if before == (mark_one.sum(), mark_two.sum()):
                    break
            marks = [mark_one] if same else [mark_one, mark_two]
            for (n, s), m in zip(sums, marks, strict=True):
                held.append((n, s, m))
                size += len(n)
            if size > 100_000:
                yield result(held)
                held, size = [], 0
        if held:
            yield result(held)

    dealt = in_blocks(clumps.select("root", "node", "unit", "weight"), "root", "node", block)
    counted = materialise(dealt.mapInArrow(count, "node long, links long, to long"), "counted")
    ties = counted.filter("node <> to").select(F.col("node").alias("a"), F.col("to").alias("b"))
    return counted.groupBy("node").agg(F.sum("links").alias("links")), ties


def whole(nodes: DataFrame) -> DataFrame:
    """All comparable vectors as one clump: what the search could not settle is compared in full."""
    return nodes.join(nodes.groupBy("block").agg(F.min("node").alias("root")), "block").select("node", "root")


def mark_two_of(one: np.ndarray, two: np.ndarray, same: bool) -> np.ndarray:
    return one if same else two.copy()


def drawn(nodes: DataFrame, clumps: DataFrame, most: int) -> DataFrame:
    """``node, block, unit`` of about ``most`` vectors, equally many of clumps of 1, 2 to 3, 4 to 7, ... members."""
    sizes = clumps.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    sized = nodes.join(clumps.join(sizes, "root").select("node", "size"), "node", "left")
    sized = sized.withColumn("scale", F.floor(F.log2(F.coalesce("size", F.lit(1)))))
    sized = materialise(sized.select("node", "block", "unit", "scale"), "sized")
    counts = sorted((r["count"], r["scale"]) for r in sized.groupBy("scale").count().collect())
    chosen, left = sized.limit(0), most
    for place, (count, scale) in enumerate(counts):
        share = min(count, max(1, left // (len(counts) - place)))
        left -= share
        part = sized.filter(F.col("scale") == scale)
        chosen = chosen.unionByName(part.orderBy(F.xxhash64("node"), "node").limit(share))
    return chosen.select("node", "block", "unit")


def audit(nodes: DataFrame, counts: DataFrame, clumps: DataFrame, descent: Descent) -> float:
    """Mean share of its links that was found of each of ``audited`` vectors that has links; 1 if none has."""
    asked = drawn(nodes, clumps, descent.audited).toPandas()
    by_block = {b: (g["node"].to_numpy(), g["unit"].tolist()) for b, g in asked.groupby("block")}
    cosine = descent.cosine

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, int] = {}
        queries = {b: (n, np.frombuffer(b"".join(u), np.float64).reshape(len(u), -1)) for b, (n, u) in by_block.items()}
        for rows in batches:
            blocks = rows.column("block").to_numpy()
            for b in np.unique(blocks):
                if b not in queries:
                    continue
                part = rows.filter(pa.array(blocks == b))
                ids, weight = part.column("node").to_numpy(), part.column("weight").to_numpy()
                names, x = queries[b]
                near = (x @ matrix(part.column("unit"), "f8").T >= cosine) & (names[:, None] != ids[None, :])
                for n, s in zip(names.tolist(), (near @ weight).tolist(), strict=True):
                    sums[n] = sums.get(n, 0) + s
        yield pa.RecordBatch.from_pydict({"node": pa.array(list(sums), pa.int64()), "links": pa.array(list(sums.values()), pa.int64())})

    true = nodes.select("node", "block", "unit", "weight").mapInArrow(search, "node long, links long")
    true = true.groupBy("node").agg(F.sum("links").alias("true"))
    share = F.avg(F.coalesce("links", F.lit(0)) / F.col("true"))
    recall = true.filter(F.col("true") > 0).join(counts, "node", "left").agg(share.alias("share")).first()["share"]
    return 1.0 if recall is None else recall


def near_vectors(
    vectors: DataFrame, descent: Descent | None = None, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding"
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Vectors are compared only under equal labels (and lengths). Null labels and vectors that are null, empty,
    zero or not finite link with nothing. Equal vectors are one node and each counts as a link of the
    others. Repeated rows are rows of their own; of rows with one id and vector all or none are kept. Other
    columns are not looked at. An empty table gives an empty one.
    """
    descent = descent or Descent()
    unit = materialise(units(vectors, id_col, label_col, vector_col), "units")
    one = unit.groupBy("label", "unit").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("weight"))
    block = F.xxhash64("label", F.length("unit")).alias("block")
    nodes = one.select(F.monotonically_increasing_id().alias("node"), block, "*")
    nodes = materialise(nodes, "vectors")
    nodes = materialise(nodes.mapInArrow(narrowed, f"{nodes.schema.simpleString()[7:-1].replace(':', ' ')}, small binary"), "vectors")
    found, grown, recall = None, None, 0.0
    for turn in range(descent.rounds):
        new = first_lists(nodes, descent, turn)
        lists = materialise(best_lists(new if found is None else new.unionByName(found), descent.neighbours, grown), "lists")
        for step in range(descent.steps):
            better = refined(nodes, lists, descent, turn * descent.steps + step)
            lists = materialise(best_lists(lists.unionByName(better), descent.neighbours, grown), "lists")
        lists, grown = grown_lists(nodes, lists, grown, descent, turn)
        found = lists
        clumps = clumped(nodes, lists, descent)
        counts, ties = linked(nodes, clumps, descent)
        counts = materialise(counts, "counts")
        recall = audit(nodes, counts, clumps, descent)
        if recall >= descent.recall:
            break
    else:
        counts, ties = linked(nodes, whole(nodes), descent)
    roots = components(ties)
    named = nodes.join(roots, "node", "left").join(counts, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    others = (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    named = named.join(least, "root").select("label", "unit", others, "component_id")
    known = unit.join(named, ["label", "unit"]).select("vec_id", "n_links", "component_id")
    return all_rows(vectors, known, id_col)


def narrowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The unit vectors once more, in single precision, for the search."""
    for rows in batches:
        small = [np.frombuffer(u, np.float64).astype(np.float32).tobytes() for u in rows.column("unit").to_pylist()]
        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(small, pa.binary())], [*rows.schema.names, "small"])


def all_rows(vectors: DataFrame, known: DataFrame, id_col: str) -> DataFrame:
    """The found rows, and those of ``vectors`` that could not be compared."""
    # Rows are matched by number within their id, so that repeated ids keep their count.
    def numbered(df: DataFrame, *order: str) -> DataFrame:
        return df.withColumn("again", F.row_number().over(Window.partitionBy("vec_id").orderBy(*order)))

    every = numbered(vectors.select(F.col(id_col).cast("long").alias("vec_id")), "vec_id")
    left = numbered(known, "component_id", "n_links").withColumnRenamed("vec_id", "id").withColumnRenamed("again", "time")
    met = every.join(left, F.col("vec_id").eqNullSafe(F.col("id")) & (F.col("again") == F.col("time")), "left")
    component = F.when(F.col("time").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    rows = met.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"))
    return rows.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
