"""Removal of repeated passages by blockwise suffix sorting with a difference cover."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epigauge.llm.common import text_of
from epigauge.llm.minhash import Shingler, scrambled
from epigauge.session import materialise

#: Residues modulo PERIOD such that any two positions reach the cover by a common step below PERIOD (fixed values).
PERIOD = 7
COVER = (1, 2, 4)
STEP = np.array(
    [
        [next(s for s in range(PERIOD) if (a + s) % PERIOD in COVER and (b + s) % PERIOD in COVER) for b in range(PERIOD)]
        for a in range(PERIOD)
    ]
)
#: Positions of a text that are looked at together when anchors are chosen.
SEGMENT = 1 << 20


@dataclass(frozen=True)
class Repeats:
    """Strings of ``width`` bytes that also start earlier are removed.

    ``anchor`` is the length of the string that names a window, ``bucket_bytes`` the text whose anchors one
    task counts, ``block_bytes`` the text whose suffixes are sorted at once; an anchor that occurs more than
    ``hot`` times has its windows dealt one by one.
    """

    width: int = 100
    anchor: int = 32
    bucket_bytes: int = 8 << 20
    block_bytes: int = 1 << 20
    hot: int = 20_000


def words_at(text: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """``n`` (at most 8) bytes from each position as one number, the first byte highest; ``text`` is padded."""
    out = np.zeros(len(at), np.uint64)
    for i in range(n):
        out = (out << np.uint64(8)) | text[at + i].astype(np.uint64)
    return out


def cover_ranks(text: np.ndarray, size: int, depth: int) -> np.ndarray:
    """The rank of every cover position of ``text[:size]`` by its first ``depth`` bytes or more.

    The cover is closed under steps of PERIOD, so a rank by 7 bytes gives one by 14, 28, ... bytes.
    """
    every = np.arange(size)
    sample = every[np.isin(every % PERIOD, COVER)]
    rank = np.zeros(size + 2 * depth + PERIOD, np.int64)
    key, have = words_at(text, sample, PERIOD), PERIOD
    while True:
        values, place = np.unique(key, return_inverse=True)
        rank[sample] = place + 1
        if have >= depth or len(values) == len(sample):
            return rank
        key = rank[sample] * (len(values) + 2) + rank[sample + have]
        have *= 2


def equal_windows(raw: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``starts`` begin the same ``width`` (at least 16) bytes: indexes into ``starts``, and a group number for each.

    Windows without an equal are left out. Suffixes are sorted by their first 16 bytes; ties are put in order
    by the ranks of the cover positions that both reach by a common step; neighbours in the final order are
    compared byte by byte.
    """
    size = len(raw)
    text = np.concatenate((raw, np.zeros(2 * width + 32, np.uint8)))
    high, low = words_at(text, starts, 8), words_at(text, starts + 8, 8)
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    new = np.ones(len(order), bool)
    new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    tie = np.cumsum(new) - 1
    tied = np.bincount(tie)[tie] > 1
    order, tie = order[tied], tie[tied]
    if not len(order):
        return order, tie
    at = starts[order]
    rank = cover_ranks(text, size, width)
    scale, residue = int(rank.max()) + 1, at % PERIOD
    classes = [np.flatnonzero(residue == c) for c in range(PERIOD)]
    place = np.zeros(len(at), np.int64)
    for a, mine in enumerate(classes):
        for b, theirs in enumerate(classes):
            if len(mine) and len(theirs):
                step = STEP[a, b]
                here = tie[mine] * scale + rank[at[mine] + step]
                there = np.sort(tie[theirs] * scale + rank[at[theirs] + step])
                place[mine] += np.searchsorted(there, here)
    final = np.argsort(place, kind="stable")
    order, at = order[final], at[final]
    same = np.zeros(len(at), bool)
    windows = np.lib.stride_tricks.sliding_window_view(text, width)
    for k in range(1, len(at), 20_000):
        end = min(k + 20_000, len(at))
        same[k:end] = (windows[at[k:end]] == windows[at[k - 1 : end - 1]]).all(axis=1)
    group = np.cumsum(~same) - 1
    several = np.bincount(group)[group] > 1
    return order[several], group[several]


class Anchors:
    """Names windows by the smallest hash among the ``anchor``-byte strings inside (the leftmost, if equal)."""

    def __init__(self, repeats: Repeats):
        self.repeats, self.shingler = repeats, Shingler(1)

    def of(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``key, place, first, last`` of every anchor: the windows that start at first..last have it."""
        width, k = self.repeats.width, self.repeats.anchor
        parts = []
        step = SEGMENT - width + 1
        for begin in range(0, max(len(raw) - width + 1, 0), step):
            key, place, first, last = self._segment(np.frombuffer(raw, np.uint8)[begin : begin + SEGMENT], width, k)
            parts.append((key, place + begin, first + begin, last + begin))
        if not parts:
            return tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64))
        return tuple(np.concatenate(c) for c in zip(*parts, strict=True))

    def _segment(self, raw: np.ndarray, width: int, k: int):
        s, n = self.shingler, len(raw)
        if n > len(s.up):
            s._grow(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(s.letters[raw] * s.up[:n], out=sums[1:])
        hashes = scrambled((sums[k:] - sums[:-k]) * s.down[: n - k + 1])
        packed = (hashes & ~np.uint64(SEGMENT - 1)) | np.arange(len(hashes), dtype=np.uint64)
        span, have = width - k + 1, 1
        low = packed
        while 2 * have <= span:
            low = np.minimum(low[:-have], low[have:])
            have *= 2
        if have < span:
            low = np.minimum(low[: n - width + 1], low[span - have : span - have + n - width + 1])
        place = (low & np.uint64(SEGMENT - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        last = np.append(first[1:], len(place)) - 1
        return hashes[place[first]], place[first], first, last


def count_anchors(texts: DataFrame, repeats: Repeats, buckets: int) -> DataFrame:
    """``code, places``: the anchors of each text that occur elsewhere too; and for a null code, hot names instead of places.

    Anchors go to their buckets as packed arrays: 24 bytes for about 35 bytes of text. Names are combined before that: one
    that occurs several times in a batch of texts sends one record with its number, and its other records need no
    answer, so a bucket holds one record a name and batch. Copies of a text have the same code and places and count once.
    """
    record = np.dtype([("key", "<u8"), ("code", "<i8"), ("place", "<u4"), ("times", "<u4")])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, seen = Anchors(repeats), set()
        for rows in batches:
            found = []
            for code, text in zip(rows.column("code").to_pylist(), rows.column("text"), strict=True):
                if code in seen:
                    continue
                seen.add(code)
                key, place, _, _ = anchors.of(text.as_py().encode())
                part = np.empty(len(key), record)
                part["key"], part["code"], part["place"], part["times"] = key, code, place, 1
                found.append(part)
            if not found:
                continue
            every = np.concatenate(found)
            every = every[np.argsort(every["key"], kind="stable")]
            first = np.flatnonzero(np.concatenate(([True], every["key"][1:] != every["key"][:-1]))) if len(every) else np.zeros(0, int)
            times = np.diff(np.append(first, len(every)))
            told = every[first]
            told["times"] = times
            several = np.repeat(times > 1, times)
            dealt = []
            for known, part, by in ((False, told, told["key"] >> np.uint64(16)), (True, every[several], every["code"][several].view(np.uint64))):
                bucket = by % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                part, bucket = part[order], bucket[order]
                edges = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
                dealt += [(b, known, part[edges[b] : edges[b + 1]].tobytes()) for b in np.flatnonzero(np.diff(edges)).tolist()]
            columns = list(zip(*dealt, strict=True)) or [[], [], []]
            kinds = (pa.int64(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["bucket", "known", "records"])

    def by_text(every: np.ndarray, hot: np.ndarray) -> pa.RecordBatch:
        code, place = every["code"], every["place"].astype(np.int64)
        order = np.argsort(code, kind="stable")
        code, place = code[order], place[order]
        first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else np.zeros(0, np.int64)
        ends = np.append(first, len(code))
        codes = pa.array(code[first], pa.int64())
        if len(hot):
            ends = np.append(ends, len(code) + len(hot))
            place = np.concatenate((place, hot.view(np.int64)))
            codes = pa.concat_arrays([codes, pa.array([None], pa.int64())])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(place, pa.int64()))
        return pa.RecordBatch.from_arrays([codes, lists], ["code", "places"])

    def reply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        bucket = None

        def result() -> pa.RecordBatch:
            every = np.concatenate([np.frombuffer(h, record) for h in held])
            every = every[np.lexsort((every["place"], every["code"], every["key"]))]
            # Copies of a text that other tasks held: the same record, told once.
            again = np.zeros(len(every), bool)
            again[1:] = (every[1:][["key", "code", "place"]] == every[:-1][["key", "code", "place"]]) & (every["times"][1:] == 1) & (every["times"][:-1] == 1)
            every = every[~again]
            new = np.ones(len(every), bool)
            new[1:] = every["key"][1:] != every["key"][:-1]
            first = np.flatnonzero(new)
            times = np.add.reduceat(every["times"].astype(np.int64), first)
            each = np.repeat(times, np.diff(np.append(first, len(every))))
            # Those with several in their batch have been answered there.
            return by_text(every[(each > 1) & (every["times"] == 1)], every["key"][first[times > repeats.hot]])

        for rows in batches:
            columns = (rows.column(c).to_pylist() for c in ("bucket", "known", "records"))
            for b, known, records in zip(*columns, strict=True):
                if held and b != bucket:
                    yield result()
                    held.clear()
                bucket = b
                if known:
                    yield by_text(np.frombuffer(records, record), np.zeros(0, np.uint64))
                else:
                    held.append(records)
        if held:
            yield result()

    sent = texts.select("code", "text").mapInArrow(send, "bucket long, known boolean, records binary")
    met = sent.repartition(F.col("bucket")).sortWithinPartitions("bucket")
    return met.mapInArrow(reply, "code long, places array<long>")


def windows_of(candidates: DataFrame, repeats: Repeats) -> DataFrame:
    """``key, node, start, piece``: around each repeated anchor the text of all windows that it names."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(repeats)
        names = ["key", "node", "start", "piece"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for rows in batches:
            out: list[list] = [[] for _ in names]
            for node, text, wanted in zip(*(rows.column(c) for c in ("node", "text", "places")), strict=True):
                raw = text.as_py().encode()
                key, place, first, last = anchors.of(raw)
                use = np.isin(place, wanted.values.to_numpy())
                firsts = first[use].tolist()
                out[0] += key[use].view(np.int64).tolist()
                out[1] += [node.as_py()] * len(firsts)
                out[2] += firsts
                out[3] += [raw[a : b + repeats.width] for a, b in zip(firsts, last[use].tolist(), strict=True)]
                if len(out[0]) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)
                    out = [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

    return candidates.select("node", "text", "places").mapInArrow(cut, "key long, node long, start long, piece binary")


SPANS = "node long, lo long, hi long"


def spans(node: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (node, lo, hi)], ["node", "lo", "hi"])


def repeated_in(rows: list[tuple[int, int, int, bytes]], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``node, lo, hi`` to remove, for rows (key, node, start, piece) in this order, whole keys only."""
    seen: dict[tuple[int, bytes], None] = {}
    copies, chosen, per_key = [], [], {}
    for key, node, start, piece in rows:
        if (key, piece) in seen:  # the same windows stand earlier: all of them go
            copies.append((node, start, start + len(piece)))
        else:
            seen[key, piece] = None
            chosen.append((key, node, start, piece))
            per_key[key] = per_key.get(key, 0) + 1
    chosen = [c for c in chosen if per_key[c[0]] > 1]
    out = np.array(copies, np.int64).reshape(-1, 3)
    if chosen:
        lengths = np.array([len(c[3]) for c in chosen])
        begin = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        many = lengths - width + 1
        owner = np.repeat(np.arange(len(chosen)), many)
        within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        raw = np.frombuffer(b"".join(c[3] for c in chosen), np.uint8)
        index, group = equal_windows(raw, begin[owner] + within, width)
        # Pieces stand in order, and equal windows stand at equal places of their pieces.
        least = np.full(group.max() + 1 if len(group) else 0, len(chosen))
        np.minimum.at(least, group, owner[index])
        gone = np.sort(index[owner[index] > least[group]])
        if len(gone):
            cut = np.concatenate(([True], (gone[1:] != gone[:-1] + 1) | (owner[gone[1:]] != owner[gone[:-1]])))
            a, b = gone[cut], gone[np.append(np.flatnonzero(cut)[1:] - 1, len(gone) - 1)]
            node, start = (np.array([c[i] for c in chosen], np.int64) for i in (1, 2))
            o = owner[a]
            more = np.stack((node[o], start[o] + within[a], start[o] + within[b] + width), axis=1)
            out = np.concatenate((out, more))
    return out[:, 0], out[:, 1], out[:, 2]


def sort_blocks(pieces: DataFrame, repeats: Repeats) -> DataFrame:
    """``node, lo, hi``: bytes covered by windows that stand earlier too; whole keys are taken a block at a time."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, key = 0, None
        for rows in batches:
            for row in zip(*(rows.column(c).to_pylist() for c in ("key", "node", "start", "piece")), strict=True):
                if size > repeats.block_bytes and row[0] != key:
                    yield spans(*repeated_in(held, repeats.width))
                    held, size = [], 0
                key = row[0]
                held.append(row)
                size += len(row[3])
        if held:
            yield spans(*repeated_in(held, repeats.width))

    # Dealt by another number than a join's key: a join by "key" below could stand in for this exchange, and a join may
    # split its keys or read them as they were written. Here all rows of a key must meet in one task.
    dealt = pieces.repartition(F.xxhash64("key")).sortWithinPartitions("key", "node", "start")
    return dealt.mapInArrow(find, SPANS)


def hot_windows(pieces: DataFrame, repeats: Repeats) -> DataFrame:
    """The same for names that occur very often: their windows are dealt out one by one, by their bytes.

    Equal windows of one batch are settled there; only the first of them meets those of other batches.
    """
    width = repeats.width

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if not rows.num_rows:
                continue
            texts = rows.column("piece").to_pylist()
            many = np.array([len(t) - width + 1 for t in texts])
            raw = np.frombuffer(b"".join(texts), np.uint8)
            begin = np.repeat(np.cumsum([0, *map(len, texts[:-1])]), many)
            within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            # Two windows of one length are equal as padded strings only if all their bytes are.
            windows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(raw, width)[begin + within]).view(f"S{width}").ravel()
            node = np.repeat(rows.column("node").to_numpy(), many)
            start = np.repeat(rows.column("start").to_numpy(), many) + within
            order = np.lexsort((start, node, windows))
            windows, node, start = windows[order], node[order], start[order]
            again = np.zeros(len(order), bool)
            again[1:] = windows[1:] == windows[:-1]
            raw = windows.tobytes()
            values = [raw[i : i + width] for i in range(0, len(raw), width)]
            columns = [pa.array(values, pa.binary()), pa.array(node), pa.array(start), pa.array(again)]
            yield pa.RecordBatch.from_arrays(columns, ["window", "node", "start", "again"])

    windows = materialise(pieces.select("node", "start", "piece").mapInArrow(deal, "window binary, node long, start long, again boolean"), "hot-windows")
    left = windows.filter("not again")
    first = materialise(left.groupBy("window").agg(F.min(F.struct("node", "start")).alias("first")), "hot-firsts")
    met = left.join(first, "window").filter((F.col("node") != F.col("first.node")) | (F.col("start") != F.col("first.start")))
    gone = windows.filter("again").select("node", "start").unionByName(met.select("node", "start"))
    return gone.select("node", F.col("start").alias("lo"), (F.col("start") + width).alias("hi"))


def cut_out(candidates: DataFrame, removed: DataFrame) -> DataFrame:
    """``node, n_removed, n_spans, kept`` (the remaining bytes) for the texts that lose something."""
    parts = removed.groupBy("node").agg(F.collect_list(F.struct("lo", "hi")).alias("parts"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out: list[list] = [[], [], [], []]
            for node, text, parts in zip(*(rows.column(c) for c in ("node", "text", "parts")), strict=True):
                raw = text.as_py().encode()
                flat = parts.values.flatten()
                lo, hi = flat[0].to_numpy(), flat[1].to_numpy()
                depth = np.zeros(len(raw) + 1, np.int64)
                np.add.at(depth, lo, 1)
                np.add.at(depth, hi, -1)
                gone = np.cumsum(depth[:-1]) > 0
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                begins = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                for column, value in zip(out, (node.as_py(), int(gone.sum()), begins, kept), strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["node", "n_removed", "n_spans", "kept"]
            )

    met = candidates.select("node", "text").join(parts, "node")
    return met.select("node", "text", "parts").mapInArrow(cut, "node long, n_removed long, n_spans long, kept binary")


def remove_repeats(docs: DataFrame, repeats: Repeats | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` for every row.

    Texts are UTF-8 bytes; a null text is empty. Every byte covered by a ``width``-byte string that also
    starts earlier (smaller id, null ids last; or the same text, earlier) goes. Of equal texts only the first can
    keep anything; rows that share an id come in the order of their digests, repeated rows are copies of the first.
    ``kept`` holds the remaining bytes of the texts that lost some of their own, else null. Other columns are
    not looked at. An empty table gives an empty one.
    """
    repeats = repeats or Repeats()
    raw = F.encode(text_of(text_col), "UTF-8")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"), F.sha2(raw, 256).alias("sha"))
    texts = texts.withColumn("code", F.xxhash64("sha"))
    rows = materialise(texts.select("doc_id", "sha", "code", F.octet_length("text").cast("long").alias("n_bytes")), "texts")
    firsts = rows.groupBy("sha", "code").agg(F.min("doc_id").alias("first_id"))
    order = [F.col("first_id").isNull(), F.col("first_id"), F.col("sha")]
    # Partition numbers stand high in these numbers, so they rise along the order.
    firsts = firsts.repartitionByRange(*order).sortWithinPartitions(*order).select("*", F.monotonically_increasing_id().alias("node"))
    firsts = materialise(firsts, "firsts")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    long_texts = texts.filter(F.octet_length("text") >= repeats.width)
    counted = materialise(count_anchors(long_texts, repeats, int(total // repeats.bucket_bytes) + 1), "anchors")
    anchored = counted.filter("code is not null").groupBy("code").agg(F.flatten(F.collect_list("places")).alias("places"))
    wanted = firsts.join(anchored, "code").select("sha", "first_id", "node", "places").hint("shuffle_hash")
    found = long_texts.withColumnRenamed("sha", "own").join(
        wanted, (F.col("own") == F.col("sha")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    )
    found = found.select("node", "text", "places")
    # A row that stands there twice is one candidate, else it would meet its own windows.
    candidates = materialise(found.dropDuplicates(["node"]) if repeated(rows) else found, "candidates")
    pieces = windows_of(candidates, repeats)
    hot = counted.filter("code is null").select(F.explode("places").alias("key")).distinct()
    if hot.isEmpty():
        removed = sort_blocks(pieces, repeats)
    else:
        hot = F.broadcast(hot)  # 8 bytes for over ``hot`` anchors each
        removed = sort_blocks(pieces.join(hot, "key", "left_anti"), repeats)
        removed = removed.unionByName(hot_windows(pieces.join(hot, "key", "left_semi"), repeats))
    cut = cut_out(candidates, removed).withColumn("cut_sha", F.sha2("kept", 256))
    facts = firsts.join(cut, "node", "left").select("sha", "first_id", "n_removed", "n_spans", "cut_sha", "kept")
    again = F.row_number().over(Window.partitionBy("doc_id", "sha").orderBy("n_bytes"))
    # One join with a row per text: the many copies of a text can be split over tasks.
    met = rows.withColumn("again", again).join(facts, "sha")
    is_first = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("again") == 1)
    whole = ~is_first & (F.col("n_bytes") >= repeats.width)
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    zero = F.lit(0).cast("long")
    return met.select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).when(is_first, F.coalesce("n_removed", zero)).otherwise(zero).alias("n_removed"),
        F.when(whole, F.lit(1).cast("long")).when(is_first, F.coalesce("n_spans", zero)).otherwise(zero).alias("n_spans"),
        F.when(whole, nothing).when(is_first, F.coalesce("cut_sha", "sha")).otherwise(F.col("sha")).alias("kept_sha256"),
        F.when(is_first, F.col("kept")).alias("kept"),
    )


def repeated(rows: DataFrame) -> bool:
    """Whether some row stands there twice."""
    return not rows.groupBy("doc_id", "sha").count().filter("count > 1").isEmpty()
