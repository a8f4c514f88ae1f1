"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epigauge.llm.common import WORDS, free_name, number_within, text_of
from epigauge.session import materialise

#: Newton stops when every source's expected words are this close to its target, relatively.
CLOSE = 1e-7
STEPS = 200
#: Most moves per source that bring the rounded words closer to the target; each leaves less than it met.
MOVES = 8


def targets(sizes: np.ndarray, weights: np.ndarray, share: float, cap: float) -> np.ndarray:
    """Words per source: ``share`` of all words split by weight, none above ``cap`` times its own words.

    The excess of a capped source goes to the others by weight, until none is above.
    """
    total, most = share * sizes.sum(), cap * sizes
    out, free = np.zeros(len(sizes)), np.ones(len(sizes), bool)
    while free.any():
        left = total - most[~free].sum()
        out = np.where(free, left * weights / weights[free].sum(), most)
        above = free & (out > most)
        if not above.any():
            break
        free &= ~above
    return np.minimum(out, most)


def rate(tilt: Column, size: Column, scale: Column, cap: int) -> Column:
    """Expected copies of a row: copy counts 0..cap, evenly likely draws tilted by exp(tilt * size)."""
    tilted = F.lit(float(cap)) / (F.lit(1.0) + F.exp(-tilt * size / scale))
    return F.when(tilt.isNull(), F.lit(float(cap))).otherwise(tilted)


def balance(hist: DataFrame, goals: dict[str | None, float], sums: dict[str | None, tuple[int, int]], cap: int) -> DataFrame:
    """``source, tilt, scale``: the solution of the convex dual, one multiplier per source.

    ``hist`` (source, size, n) is all that the constraints depend on. Every Newton step is one aggregation over
    it; a step that leaves the bracket of its multiplier is replaced by a bisection. Only sums per source come
    to the driver. Sums are decimal, so they do not depend on the order of the rows. A null tilt means
    that every row is taken ``cap`` times.
    """
    spark = hist.sparkSession
    names = list(goals)
    goal = np.array([goals[k] for k in names], float)
    scale = np.array([max(sums[k][0], 1) / max(sums[k][1], 1) for k in names], float)
    most = cap * np.array([sums[k][0] for k in names], float)
    full = goal >= most * (1 - 1e-9)
    tilt, low, high = np.zeros(len(names)), np.full(len(names), -np.inf), np.full(len(names), np.inf)

    def frame() -> DataFrame:
        rows = [(k, None if f else float(t), float(s)) for k, t, s, f in zip(names, tilt, scale, full, strict=True)]
        return spark.createDataFrame(rows, "source string, tilt double, scale double")

    def exact(value: Column) -> Column:
        return F.sum(value.cast("decimal(30,9)")).cast("double")

    place = {k: i for i, k in enumerate(names)}
    for _ in range(STEPS):
        state = frame().withColumnRenamed("source", "tilted")
        now = hist.join(state, F.col("source").eqNullSafe(F.col("tilted")))  # a row per source: sent if they are few
        r = rate(F.col("tilt"), F.col("size"), F.col("scale"), cap)
        words = F.col("n") * F.col("size")
        slope = words * F.col("size") / F.col("scale") * r * (F.lit(1.0) - r / F.lit(float(cap)))
        got = now.filter("tilt is not null").groupBy("source").agg(exact(words * r).alias("m"), exact(slope).alias("h"))
        gap, steep = np.zeros(len(names)), np.ones(len(names))
        for row in got.collect():
            i = place[row["source"]]
            gap[i], steep[i] = row["m"] - goal[i], row["h"]
        work = ~full & (np.abs(gap) > CLOSE * np.maximum(goal, 1.0))
        if not work.any():
            break
        high = np.where(work & (gap > 0), tilt, high)
        low = np.where(work & (gap < 0), tilt, low)
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(steep > 0, tilt - gap / steep, np.nan)
            half = np.where(np.isinf(low), high - 2 * np.abs(high) - 1, np.where(np.isinf(high), low + 2 * np.abs(low) + 1, (low + high) / 2))
        inside = np.isfinite(step) & (step > low) & (step < high) & (np.abs(step - tilt) < 8 + np.abs(tilt))
        tilt = np.where(work, np.where(inside, step, half), tilt)
    else:
        far = [names[i] for i in np.flatnonzero(work)]
        raise RuntimeError(f"the mix did not settle in {STEPS} steps for the sources {far[:10]}")
    return frame()


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    cap: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies`` for every row.

    Size is the number of words (null text: 0). Sources by code point, null last, weigh ``weights`` in turn.
    Rates are tilted by size within each source so that the expected words equal the target; they are rounded
    to 0..cap copies along the sizes, so a source's words differ from its target by less than one of its
    documents, mostly by far less after a few single moves. Rows without words get copies that weigh nothing.
    Repeated rows are rows of their own. Reruns give the same copies (rows that agree in id and size may swap).
    An empty table gives an empty one. What comes to the driver are sums per source.
    """
    source = F.col(source_col).cast("string")
    size = F.regexp_count(text_of(text_col), F.lit(WORDS)).cast("long")
    base = materialise(docs.select(F.col(id_col).alias("doc_id"), source.alias("source"), size.alias("size")), "sizes")
    hist = materialise(base.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "size-counts")
    found = hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words"), F.sum("n").alias("n")).collect()
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sums = {r["source"]: (r["words"], r["n"]) for r in found}
    turn = np.array([weights[i % len(weights)] for i in range(len(found))], float)
    wanted = targets(np.array([r["words"] for r in found], float), turn, share, cap)
    goals = {r["source"]: float(t) for r, t in zip(found, wanted, strict=True)}
    spark = docs.sparkSession
    tilts = balance(hist, goals, sums, cap).withColumnRenamed("source", "tilted")
    facts = spark.createDataFrame(
        [(k, s[0], goals[k]) for k, s in sums.items()], "named string, source_size long, target double"
    )
    per_source = tilts.join(facts, F.col("tilted").eqNullSafe(F.col("named"))).drop("named")
    rated = hist.join(per_source, F.col("source").eqNullSafe(F.col("tilted"))).drop("tilted")
    along = Window.partitionBy("source").orderBy("size")
    # Rates rounded to nine decimals: a last digit that differs between runs must not move a copy.
    due = F.round(F.col("n") * rate(F.col("tilt"), F.col("size"), F.col("scale"), cap), 5).cast("decimal(28,5)")
    upto = F.floor(F.sum(due).over(along.rowsBetween(Window.unboundedPreceding, 0)) + F.lit(0.5).cast("decimal(2,1)"))
    rounded = rated.withColumn("upto", upto.cast("long"))
    rounded = rounded.withColumn("made", F.col("upto") - F.coalesce(F.lag("upto").over(along), F.lit(0).cast("long")))
    rounded = materialise(rounded.select("source", "size", "n", "source_size", "target", "made"), "copies")
    rounded = nearer(rounded, cap)
    flag, name = F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name")
    plan = rounded.select(flag, name, "size", "n", "source_size", "target", "made")
    keyed = base.select("doc_id", "source", "size", flag, name)
    placed = number_within(
        keyed, ["none", "name", "size"], ["doc_id"], "place", sum(s[1] for s in sums.values()), attach=plan
    )
    extra = (F.col("place") < F.col("made") % F.col("n")).cast("long")
    copies = F.floor(F.col("made") / F.col("n")).cast("long") + extra
    return placed.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"))


def nearer(rounded: DataFrame, cap: int) -> DataFrame:
    """Move single copies where that brings a source's words closer to its target.

    Each round takes, per source, the largest size that still fits into what is missing (or is too much).
    """
    spark = rounded.sparkSession
    moved: dict[tuple[str | None, int], int] = {}
    sums = rounded.groupBy("source").agg(
        F.sum(F.col("made") * F.col("size")).alias("words"), F.first("target").alias("target")
    )
    gaps = {r["source"]: round(r["target"] - r["words"]) for r in sums.collect()}

    def applied() -> DataFrame:
        if not moved:
            return rounded
        rows = [(k, s, m) for (k, s), m in moved.items()]
        moves = spark.createDataFrame(rows, "to string, at long, move long")  # at most MOVES rows per source
        same = F.col("source").eqNullSafe(F.col("to")) & (F.col("size") == F.col("at"))
        more = F.col("made") + F.coalesce("move", F.lit(0).cast("long"))
        return rounded.join(moves, same, "left").withColumn("made", more).drop("to", "at", "move")

    for _ in range(MOVES):
        open_gaps = [(k, g) for k, g in gaps.items() if g]
        if not open_gaps:
            break
        wanted = spark.createDataFrame(open_gaps, "to string, gap long")
        now = applied().join(wanted, F.col("source").eqNullSafe(F.col("to")))
        room = F.when(F.col("gap") > 0, F.col("made") < cap * F.col("n")).otherwise(F.col("made") > 0)
        fit = now.filter((F.col("size") > 0) & (F.col("size") <= F.abs("gap")) & room)
        best = fit.groupBy("source").agg(
            F.max(F.struct("size", F.when(F.col("gap") > 0, cap * F.col("n") - F.col("made")).otherwise(F.col("made")).alias("room"))).alias("b")
        ).collect()
        if not best:
            break
        for row in best:
            k, (s, left) = row["source"], row["b"]
            g = gaps[k]
            m = min(abs(g) // s, left) * (1 if g > 0 else -1)
            moved[k, s] = moved.get((k, s), 0) + m
            gaps[k] = g - m * s
    return applied()


def resample(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **settings: object
) -> DataFrame:
    """Every row as often as the mix takes it, with all its columns.

    Rows with an id of their own are matched by it. Rows that share one, or have none, are matched by source and size as well, and
    numbered where they agree in all three: each source keeps to its target. Nulls, empty and very long texts, repeated rows and
    empty tables as in :func:`mix`; columns of any name come through.
    """
    mixed = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **settings)
    taken = materialise(mixed.select("doc_id", "source", "size", "copies"), "taken")
    by_id = taken.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), F.max("copies").alias("copies"))
    # Rows without a copy are left out here already, so that only what is taken moves.
    by_id = materialise(by_id.filter("copies > 0").withColumnsRenamed({"doc_id": "mixed_id", "copies": "mixed_copies"}), "plan")
    plan, shared = by_id.filter("rows = 1").drop("rows"), by_id.filter("rows > 1").select("mixed_id")
    out = repeated(docs.join(plan, docs[id_col].eqNullSafe(plan["mixed_id"])), docs, plan["mixed_copies"])
    if shared.isEmpty():
        return out
    source, size, row, place = (free_name(docs, name) for name in ("source_of", "size_of", "row_of", "place_of"))
    apart = docs.join(shared, docs[id_col].eqNullSafe(shared["mixed_id"]), "left_semi")
    words = F.regexp_count(text_of(text_col), F.lit(WORDS)).cast("long")
    none, name, unnamed, named = (free_name(docs, c) for c in ("no_source", "source_name", "no_id", "id_name"))
    keyed = apart.withColumns({source: F.col(source_col).cast("string"), size: words})
    keyed = keyed.withColumns(
        {
            none: F.col(source).isNull(),
            name: F.coalesce(source, F.lit("")),
            unnamed: F.col(id_col).isNull(),
            named: F.coalesce(F.col(id_col).cast("string"), F.lit("")),
        }
    )
    group = [none, name, unnamed, named, size]
    keyed = materialise(keyed.withColumn(row, F.monotonically_increasing_id()), "shared-ids")
    sums = taken.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n"), F.sum("copies").alias("mixed_copies"))
    sums = sums.select(
        F.col("source").isNull().alias(none),
        F.coalesce("source", F.lit("")).alias(name),
        F.col("doc_id").isNull().alias(unnamed),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias(named),
        F.col("size").alias(size),
        F.col("n").alias("mixed_rows"),
        "mixed_copies",
    )
    placed = number_within(keyed, group, [row], place, keyed.count(), attach=sums)
    copies = F.floor(F.col("mixed_copies") / F.col("mixed_rows")).cast("long")
    copies = copies + (F.col(place) < F.col("mixed_copies") % F.col("mixed_rows")).cast("long")
    rest = placed.withColumn("mixed_copies", copies).filter("mixed_copies > 0")
    return out.unionByName(repeated(rest, rest, rest["mixed_copies"]).select(*docs.columns))


def repeated(rows: DataFrame, docs: DataFrame, copies: Column) -> DataFrame:
    """The columns of ``docs``, each row ``copies`` times."""
    time = free_name(docs, "time")
    every = F.explode(F.sequence(F.lit(1).cast("long"), copies)).alias(time)
    return rows.select(*(docs[c] for c in docs.columns), every).drop(time)
