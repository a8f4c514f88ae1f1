"""Byte-level BPE over overlapping chunks: pre-tokens found in parallel, stitched where they agree, then encoded."""

from __future__ import annotations

import base64
import hashlib
import sys
import types
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epigauge.llm.common import text_of
from epigauge.session import materialise

#: Bytes of results that a task hands on at once, about.
BYTES_PER_BATCH = 8_000_000
#: Distinct pre-tokens, of at most so many characters, whose ids a worker keeps; more, and it starts anew.
KEPT_PIECES, KEPT_LENGTH = 100_000, 64
#: Texts that a task remembers to have cut already.
KEPT_TEXTS = 100_000


@dataclass(frozen=True)
class Ranks:
    """A public vocabulary of byte strings with their ranks, and the pattern whose matches are encoded one by one.

    A match may depend on ``ahead`` characters behind its end at most.
    """

    path: str
    pattern: str
    ahead: int = 8

    def codec(self) -> Codec:
        """Kept by the worker between tasks."""
        kept = sys.modules.setdefault("_epigauge_codecs", types.ModuleType("_epigauge_codecs")).__dict__
        if self not in kept:
            kept[self] = Codec(self)
        return kept[self]


@dataclass(frozen=True)
class Chunks:
    """Characters of a chunk, and how many of the next chunk's it also reads.

    A text of up to ``size + overlap`` characters is one chunk. Where two chunks don't come to agree inside an overlap (a
    pre-token longer than that), the text is cut again into chunks ``growth`` times as large.
    """

    size: int = 32_768
    overlap: int = 1_024
    growth: int = 8


class Codec:
    """Pre-tokens, ids and bytes of texts."""

    def __init__(self, ranks: Ranks):
        import regex
        import tiktoken

        with open(ranks.path, "rb") as lines:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.pieces_of = regex.compile(ranks.pattern).findall
        self.whole = tiktoken.Encoding("pieces", pat_str="(?s:.+)", mergeable_ranks=table, special_tokens={})
        self.bytes_of = {rank: token for token, rank in table.items()}
        self.kept: dict[str, bytes] = {}
        self.odd = self.stand_ins = None

    def _compare_classes(self) -> None:
        """Characters that the two pattern libraries class differently, with a stand-in of the class wanted.

        Their Unicode versions differ; the vocabulary's own library decides.
        """
        import regex
        import tiktoken

        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        single = {bytes([b]): b for b in range(256)}
        self.stand_ins, classed, named = {}, set(), set()
        for kind, stand_in in ((r"\p{L}", "é"), (r"\p{N}", "²"), (r"\s", " ")):
            reader = tiktoken.Encoding("class", pat_str=f"{kind}+", mergeable_ranks=single, special_tokens={})
            wanted = set(bytes(reader.encode_ordinary(every)).decode())
            found = set("".join(regex.findall(f"{kind}+", every)))
            self.stand_ins |= dict.fromkeys(wanted - found, stand_in)
            classed, named = classed | wanted, named | found
        self.stand_ins |= dict.fromkeys(named - classed, "…")
        self.odd = frozenset(self.stand_ins)
        self.stand_ins = str.maketrans(self.stand_ins)

    def pieces(self, text: str) -> list[str]:
        """The pre-tokens, one after the other; together they are the text."""
        if text.isascii():
            return self.pieces_of(text)
        if self.stand_ins is None:
            self._compare_classes()
        if self.odd.isdisjoint(text):
            return self.pieces_of(text)
        found = self.pieces_of(text.translate(self.stand_ins))
        return self.slices(text, np.fromiter(map(len, found), np.int64, len(found)))

    @staticmethod
    def slices(text: str, lengths: np.ndarray) -> list[str]:
        ends = np.cumsum(lengths).tolist()
        return [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def encode(self, pieces: Iterable[str]) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        kept, out = self.kept, []
        for piece in pieces:
            ids = kept.get(piece)
            if ids is None:
                ids = np.array(self.whole.encode_ordinary(piece), "<u4").tobytes()
                if len(piece) <= KEPT_LENGTH:
                    if len(kept) >= KEPT_PIECES:
                        kept.clear()
                    kept[piece] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class Batches:
    """Rows of results, handed on whenever they are many bytes."""

    def __init__(self, **columns: pa.DataType):
        self.kinds, self.rows, self.held = columns, [], 0

    def add(self, *row) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.held += sum(len(v) for v in row if isinstance(v, (bytes, str)))
        if self.held >= BYTES_PER_BATCH or len(self.rows) >= 20_000:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = [pa.array(c, k) for c, k in zip(zip(*self.rows, strict=True), self.kinds.values(), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, list(self.kinds))
        self.rows, self.held = [], 0


def short_ids(texts: DataFrame, ranks: Ranks) -> DataFrame:
    """``doc_id, ids`` of texts that are one chunk each."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, out = ranks.codec(), Batches(doc_id=pa.int64(), ids=pa.binary())
        for rows in batches:
            for doc, text in zip(rows.column("doc_id").to_pylist(), rows.column("text"), strict=True):
                yield from out.add(doc, codec.encode(codec.pieces(text.as_py())))
        yield from out.rest()

    return texts.select("doc_id", "text").mapInArrow(encode, "doc_id long, ids binary")


def cut(texts: DataFrame, chunks: Chunks) -> DataFrame:
    """``digest, part, start, last, chunk``: the chunks of each text, once a task however often the text is there."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Batches(digest=pa.string(), part=pa.int64(), start=pa.int64(), last=pa.bool_(), chunk=pa.string())
        seen: set[str] = set()
        for rows in batches:
            for digest, value in zip(rows.column("digest").to_pylist(), rows.column("text"), strict=True):
                if digest in seen:
                    continue
                if len(seen) >= KEPT_TEXTS:
                    seen.clear()
                seen.add(digest)
                text = value.as_py()
                parts = max(1, -(-(len(text) - chunks.overlap) // chunks.size))
                for part in range(parts):
                    start = part * chunks.size
                    chunk = text[start : start + chunks.size + chunks.overlap]
                    yield from out.add(digest, part, start, part == parts - 1, chunk)
        yield from out.rest()

    return texts.select("digest", "text").mapInArrow(split, "digest string, part long, start long, last boolean, chunk string")


def pre_tokenised(parts: DataFrame, ranks: Ranks, chunks: Chunks) -> DataFrame:
    """``digest, part, last, chunk, lengths`` with the chunk's pre-tokens, and the places where neighbours may agree.

    ``head`` are the pre-tokens' first places in the part of the chunk that its predecessor reads too, ``tail`` those in the part
    that its successor reads too and that no character behind the chunk can change.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, places = ranks.codec(), pa.list_(pa.int64())
        out = Batches(
            digest=pa.string(), part=pa.int64(), start=pa.int64(), last=pa.bool_(), chunk=pa.string(), lengths=pa.binary(), head=places, tail=places
        )
        before = None
        for rows in batches:
            columns = (rows.column(c) for c in ("digest", "part", "start", "last", "chunk"))
            for digest, part, start, last, chunk in zip(*columns, strict=True):
                key = (digest.as_py(), part.as_py())
                if key == before:  # another task held the same text
                    continue
                before, at, text = key, start.as_py(), chunk.as_py()
                pieces = codec.pieces(text)
                lengths = np.fromiter(map(len, pieces), "<u4", len(pieces))
                cuts = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
                head = cuts[cuts <= chunks.overlap] + at
                tail = cuts[(cuts >= chunks.size) & (cuts <= len(text) - ranks.ahead)] + at
                yield from out.add(*key, at, last.as_py(), text, lengths.tobytes(), head.tolist(), [] if last.as_py() else tail.tolist())
        yield from out.rest()

    schema = "digest string, part long, start long, last boolean, chunk string, lengths binary, head array<long>, tail array<long>"
    return parts.repartition("digest", "part").sortWithinPartitions("digest", "part").mapInArrow(find, schema)


def stitched(found: DataFrame) -> DataFrame:
    """``digest, part, first, until, agreed``: which places of the text each chunk answers for.

    Pre-tokens depend on what follows only. From the first place that two neighbours both start a pre-token at, the
    later one is right wherever the earlier one is.
    """
    ours = found.select("digest", "part", "start", "last", "tail")
    heads = found.filter("part > 0").select("digest", (F.col("part") - 1).alias("part"), F.col("head").alias("next_head"))
    met = ours.join(heads, ["digest", "part"], "left")
    met = met.select("digest", "part", "last", F.array_min(F.array_intersect("tail", "next_head")).alias("until"))
    before = met.select("digest", (F.col("part") + 1).alias("part"), F.col("until").alias("first"))
    joined = met.join(before, ["digest", "part"], "left")
    whole = F.col("last") | F.col("until").isNotNull()
    return joined.select("digest", "part", F.when(F.col("part") == 0, 0).otherwise(F.col("first")).alias("first"), "until", whole.alias("agreed"))


def chunk_ids(found: DataFrame, spans: DataFrame, ranks: Ranks) -> DataFrame:
    """``digest, part, ids`` of the pre-tokens that each chunk answers for."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, out = ranks.codec(), Batches(digest=pa.string(), part=pa.int64(), ids=pa.binary())
        for rows in batches:
            columns = (rows.column(c) for c in ("digest", "part", "start", "first", "until", "chunk", "lengths"))
            for row in zip(*columns, strict=True):
                digest, part, start, first, until, chunk, raw = (v.as_py() for v in row)
                lengths = np.frombuffer(raw, "<u4").astype(np.int64)
                places = np.cumsum(lengths) - lengths + start
                mine = places >= first
                if until is not None:
                    mine &= places < until
                text = chunk[first - start :]
                yield from out.add(digest, part, codec.encode(codec.slices(text, lengths[mine])))
        yield from out.rest()

    joined = found.select("digest", "part", "start", "chunk", "lengths").join(spans, ["digest", "part"])
    rows = joined.select("digest", "part", "start", "first", "until", "chunk", "lengths")
    return rows.mapInArrow(encode, "digest string, part long, ids binary")


def long_ids(texts: DataFrame, ranks: Ranks, chunks: Chunks) -> DataFrame:
    """``digest, part, ids`` of each distinct text, whatever its length; the ids of the parts follow each other.

    The chunks of a text are dealt out over all tasks, and only places and numbers decide how they fit together. What does not fit
    is cut again more coarsely, at last as one chunk.
    """
    done = []
    while True:
        found = materialise(pre_tokenised(cut(texts, chunks), ranks, chunks), "chunks")
        spans = materialise(stitched(found), "spans")
        failed = spans.filter(~F.col("agreed")).select("digest").distinct()
        whole = spans.filter(F.col("agreed")).join(failed, "digest", "left_anti")
        done.append(chunk_ids(found, whole.drop("agreed"), ranks))
        failed = materialise(failed, "failed")
        if failed.isEmpty():
            return reduce(DataFrame.unionByName, done)
        texts = texts.join(failed, "digest", "left_semi")
        chunks = Chunks(chunks.size * chunks.growth, chunks.overlap * chunks.growth, chunks.growth)


def split_by_length(docs: DataFrame, chunks: Chunks, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``doc_id, text`` of texts of one chunk, and ``doc_id, digest, text`` of the longer ones."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    longer = F.char_length("text") > chunks.size + chunks.overlap
    return texts.filter(~longer), texts.filter(longer).withColumn("digest", F.sha2("text", 256))


def encode(
    docs: DataFrame, ranks: Ranks, chunks: Chunks | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, part, ids`` (little-endian unsigned 32-bit): every text's ids, in parts from 0 on that follow each other.

    Each match of the pattern is encoded on its own by the ranks, special tokens are ordinary text. A null text counts as empty; an empty text is
    one part without ids; texts longer than a chunk are several parts. Repeated rows, of one id or of a null id, come out
    as often as they came in; equal long texts are worked out once. Ids must be whole numbers; no other column is looked at. An empty
    table gives an empty one.
    """
    chunks = chunks or Chunks()
    short, longer = split_by_length(docs, chunks, id_col, text_col)
    parts = long_ids(longer.select("digest", "text"), ranks, chunks)
    one = short_ids(short, ranks).select("doc_id", F.lit(0).cast("long").alias("part"), "ids")
    return one.unionByName(longer.select("doc_id", "digest").join(parts, "digest").select("doc_id", "part", "ids"))


def decode(encoded: DataFrame, ranks: Ranks) -> DataFrame:
    """``encoded`` (``ids`` and other columns) with ``bytes``: the tokens' raw bytes, one after the other.

    A part may end inside a character; the parts of a document together are its text in UTF-8. Null ids give null.
    """
    others = [c for c in encoded.columns if c != "ids"]
    schema = encoded.select(*others, "ids").withColumn("bytes", F.col("ids")).schema

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = ranks.codec()
        for rows in batches:
            raw = [None if v is None else codec.decode(v) for v in rows.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(raw, pa.binary())], [*rows.schema.names, "bytes"])

    return encoded.select(*others, "ids").mapInArrow(read, schema)


def folded(parts: DataFrame, ranks: Ranks) -> DataFrame:
    """``digest, n_tokens, ids_sha256, decoded_sha256`` over the parts of each text, read one part at a time."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = ranks.codec()
        out = Batches(digest=pa.string(), n_tokens=pa.int64(), ids_sha256=pa.string(), decoded_sha256=pa.string())
        now, n, ids, raw = None, 0, hashlib.sha256(), hashlib.sha256()
        for rows in batches:
            for digest, value in zip(rows.column("digest").to_pylist(), rows.column("ids"), strict=True):
                if digest != now:
                    if now is not None:
                        yield from out.add(now, n, ids.hexdigest(), raw.hexdigest())
                    now, n, ids, raw = digest, 0, hashlib.sha256(), hashlib.sha256()
                part = value.as_py()
                n += len(part) // 4
                ids.update(part)
                raw.update(codec.decode(part))
        if now is not None:
            yield from out.add(now, n, ids.hexdigest(), raw.hexdigest())
        yield from out.rest()

    rows = parts.repartition("digest").sortWithinPartitions("digest", "part").select("digest", "ids")
    return rows.mapInArrow(fold, "digest string, n_tokens long, ids_sha256 string, decoded_sha256 string")


def summary(
    docs: DataFrame, ranks: Ranks, chunks: Chunks | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` (lowercase hex) of :func:`encode` and :func:`decode`, one row per row.

    Nulls, empty and very long texts, repeated rows, other columns and empty tables as there.
    """
    chunks = chunks or Chunks()
    short, longer = split_by_length(docs, chunks, id_col, text_col)
    one = decode(short_ids(short, ranks), ranks)
    n = F.floor(F.length("ids") / 4).cast("long").alias("n_tokens")
    one = one.select("doc_id", n, F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
    parts = long_ids(longer.select("digest", "text"), ranks, chunks)
    rest = longer.select("doc_id", "digest").join(folded(parts, ranks), "digest").drop("digest")
    return one.unionByName(rest)
