"""Best-fit packing of documents into sequences, exact complements first."""

from __future__ import annotations

import base64
import sys
import types
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from epigauge.llm.common import number_within, text_of
from epigauge.session import materialise

#: Tokens of texts that a task hands on at once, about.
TOKENS_PER_BATCH = 2_000_000


@dataclass(frozen=True)
class Vocabulary:
    """A public byte-level vocabulary: the tokenizer's file, and the same ranks and pattern for the faster reader.

    ``added`` strings are tokens of their own for the tokenizer, which then reads the text itself.
    """

    tokenizer: str
    ranks: str | None = None
    pattern: str | None = None
    added: tuple[str, ...] = ("<|endoftext|>",)

    def encoder(self):
        """A function from texts to id arrays; kept by the worker between tasks."""
        kept = sys.modules.setdefault("_epigauge_encoders", types.ModuleType("_epigauge_encoders")).__dict__
        if self in kept.setdefault("made", {}):
            return kept["made"][self]
        slow = None

        def by_tokenizer(text: str) -> np.ndarray:
            nonlocal slow
            if slow is None:  # few texts need it, and it is large
                from tokenizers import Tokenizer

                slow = Tokenizer.from_file(self.tokenizer)
            return np.array(slow.encode(text, add_special_tokens=False).ids, "<u4")

        encode = by_tokenizer
        if self.ranks:
            import tiktoken

            with open(self.ranks, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            fast = tiktoken.Encoding("public", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})

            def encode(text: str) -> np.ndarray:
                if any(token in text for token in self.added):
                    return by_tokenizer(text)
                try:
                    return np.asarray(fast.encode_to_numpy(text, disallowed_special=()), "<u4")
                except ValueError as error:
                    if "backtrack" not in str(error).lower():
                        raise
                    return by_tokenizer(text)  # the pattern gives up on very long blank runs

        kept["made"][self] = encode
        return encode


def pieces(
    docs: DataFrame, vocabulary: Vocabulary, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, piece, start, length, ids`` (little-endian unsigned 32-bit): each document's ids, then ``end_id``.

    Documents of up to ``capacity`` ids are one piece; longer ones are cut, the first piece being the shorter
    one. A null or empty text is the end id alone. Other columns are not looked at.
    """
    schema = "doc_id long, piece int, start long, length long, ids binary"
    names = ["doc_id", "piece", "start", "length", "ids"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = vocabulary.encoder()
        out: list[list] = [[] for _ in names]

        def batch() -> pa.RecordBatch:
            done = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)
            for c in out:
                c.clear()
            return done

        for rows in batches:
            held = 0
            for doc, text in zip(rows.column("doc_id").to_pylist(), rows.column("text"), strict=True):
                raw = encode(text.as_py()).tobytes() + end_id.to_bytes(4, "little")
                n = len(raw) // 4
                held += n
                first = (n - 1) % capacity + 1
                edges = [0, *range(first, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    for column, value in zip(out, (doc, k, a, b - a, raw[4 * a : 4 * b]), strict=True):
                        column.append(value)
                if held > TOKENS_PER_BATCH:
                    yield batch()
                    held = 0
            if out[0]:
                yield batch()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(cut, schema)


def complements(gap: int, have: np.ndarray, index: np.ndarray, used: int) -> tuple[int, ...] | None:
    """One, two or three available lengths that sum to ``gap`` exactly; ``used`` is the length that left the gap."""
    have = have.copy()
    have[used] -= 1
    if have[gap]:
        return (gap,)
    half = index[(index <= gap // 2) & (have[index] > 0)]
    pair = half[(have[gap - half] > 0) & ((gap - half != half) | (have[half] > 1))]
    if len(pair):
        return (int(pair[0]), gap - int(pair[0]))  # the largest partner: small pieces stay for later gaps
    for a in index[(index <= gap // 3) & (have[index] > 0)]:
        have[a] -= 1
        rest = gap - a
        half = index[(index <= rest // 2) & (have[index] > 0)]
        pair = half[(have[rest - half] > 0) & ((rest - half != half) | (have[half] > 1))]
        have[a] += 1
        if len(pair):
            return (int(a), int(pair[0]), int(rest - pair[0]))
    return None


def plan(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how many sequences have each, for ``counts[length]`` pieces.

    From the longest piece down, combinations that fill the gap exactly are consumed, as often as the counts
    allow; what is left is packed best-fit by decreasing length. The work and the plan depend on the
    capacity, not on the number of pieces.
    """
    have, out = counts.astype(np.int64).copy(), []
    rest = np.zeros_like(have)
    if have[capacity]:
        out.append(((capacity,), int(have[capacity])))
    have[capacity] = 0
    for length in range(capacity - 1, 0, -1):
        while have[length]:
            index = np.flatnonzero(have)
            found = complements(capacity - length, have, index, length)
            if found is None:
                rest[length], have[length] = have[length], 0
                break
            pattern = (length, *found)
            values, times = np.unique(pattern, return_counts=True)
            n = int((have[values] // times).min())
            have[values] -= n * times
            out.append((pattern, n))
    # Best fit: open sequences by the room they have left.
    room: dict[int, list[list]] = {}
    for length in range(capacity - 1, 0, -1):
        left = int(rest[length])
        while left:
            fits = [r for r in room if r >= length]
            if not fits:
                each = capacity // length
                full, last = divmod(left, each)
                for times, n in ((each, full), (last, 1 if last else 0)):
                    if n:
                        room.setdefault(capacity - times * length, []).append([(length,) * times, n])
                break
            r = min(fits)
            pattern, n = room[r][-1]
            take = min(n, left)
            if take == n:
                room[r].pop()
                if not room[r]:
                    del room[r]
            else:
                room[r][-1][1] -= take
            room.setdefault(r - length, []).append([(*pattern, length), take])
            left -= take
    return out + [(tuple(p), n) for opened in room.values() for p, n in opened]


#: Piece lengths are the high bits of a place, numbers within a length the low ones.
NUMBER_BITS = 48


def places(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted first places of runs of equal pieces; the first sequence and the offset of each run."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, n in patterns:
        offset = 0
        for length in pattern:
            rows.append(((length << NUMBER_BITS) | taken.get(length, 0), sequence, offset))
            taken[length] = taken.get(length, 0) + n
            offset += length
        sequence += n
    rows.sort()
    a = np.array(rows, np.int64).reshape(-1, 3)
    return a[:, 0], a[:, 1], a[:, 2]


def pack(cut: DataFrame, capacity: int = 2048) -> DataFrame:
    """``cut`` (doc_id, piece, length and more) with ``sequence_id`` and ``offset``.

    Only the count of each length comes to the driver: at most ``capacity`` numbers. Pieces are numbered
    within their length in parallel, and the plan says which run of numbers goes where. ``cut`` is read
    several times, so it should be a written table. An empty table gives an empty one.
    """
    found = cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = np.zeros(capacity + 1, np.int64)
    for row in found:
        counts[row["length"]] = row["n"]
    first, sequence, offset = places(plan(counts, capacity))
    numbered = number_within(cut, ["length"], ["doc_id", "piece"], "place", int(counts.sum()))

    @pandas_udf("sequence_id long, offset long")
    def place(lengths: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        at = (lengths.to_numpy(np.int64) << NUMBER_BITS) | numbers.to_numpy(np.int64)
        run = np.searchsorted(first, at, side="right") - 1
        return pd.DataFrame({"sequence_id": sequence[run] + at - first[run], "offset": offset[run]})

    placed = numbered.withColumn("placed", place(F.col("length"), F.col("place")))
    return placed.select(*cut.columns, "placed.sequence_id", "placed.offset")


def pack_documents(docs: DataFrame, vocabulary: Vocabulary, capacity: int = 2048) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece of every document.

    Ids are not moved by the packing; :func:`pieces` gives them again, piece by piece.
    """
    cut = pieces(docs, vocabulary, capacity)
    narrow = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(materialise(narrow, "pieces"), capacity)
