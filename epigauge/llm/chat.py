"""Chat formatting with a grammar round trip: what is rendered must parse back to the same turns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epigauge.llm.common import text_of

#: Turns and characters of one rendered part; longer conversations go on in the next part.
PART_TURNS = 256
PART_CHARS = 1_000_000


@dataclass(frozen=True)
class Template:
    """Markers of the turns. A turn is opening, text, closing; the ``plain`` role has no opening of its own.

    Roles without markers here are written as ``other[0] role other[1] text other[2]``.
    """

    marks: dict[str, tuple[str, str]] = field(
        default_factory=lambda: {"user": ("[INST] ", " [/INST]"), "system": ("<<SYS>>", "<</SYS>>"), "assistant": ("", "</s>")}
    )
    plain: str = "assistant"
    other: tuple[str, str, str] = ("<|role|>", "<|text|>", "<|end|>")
    escape: str = "\\"

    @property
    def controls(self) -> list[str]:
        """Every marker, the longest first."""
        found = {m.strip() for pair in self.marks.values() for m in pair if m} | set(self.other)
        return sorted(found, key=lambda m: (-len(m), m))


class Grammar:
    """Writes and reads turns under a template."""

    def __init__(self, template: Template):
        self.template = template
        esc = template.escape
        self._codes = {c: f"{esc}{chr(97 + i)}" for i, c in enumerate(template.controls)}
        self._single = {c: f"{esc}{chr(65 + i)}" for i, c in enumerate(sorted({x for m in template.controls for x in m}))}
        self._back = {v[1]: k for k, v in {**self._codes, **self._single}.items()} | {"0": esc}

    def escape(self, text: str, level: int) -> str:
        """Level 0: as it is. 1: whole control strings. 2: each character of a control string."""
        if not level:
            return text
        text = text.replace(self.template.escape, self.template.escape + "0")
        if level == 1:
            for control, code in self._codes.items():
                text = text.replace(control, code)
            return text
        return "".join(self._single.get(c, c) for c in text)

    def unescape(self, text: str) -> str:
        first, *rest = text.split(self.template.escape)
        return first + "".join(self._back.get(r[:1], self.template.escape + r[:1]) + r[1:] for r in rest)

    def render(self, role: str, text: str, level: int) -> tuple[str, int, int]:
        """The turn, and where its (escaped) text begins and ends in it."""
        body = self.escape(text, level)
        if role in self.template.marks:
            start, end = self.template.marks[role]
        else:
            a, b, end = self.template.other
            start = a + self.escape(role, level) + b
        return start + body + end, len(start), len(start) + len(body)

    def parse(self, text: str) -> Iterator[tuple[str, int, int]]:
        """``role, begin, end`` of each turn's text; deterministic: the first closing marker ends a turn."""
        at, marks, other = 0, self.template.marks, self.template.other
        while at < len(text):
            role = next((r for r, (a, _) in marks.items() if a and text.startswith(a, at)), None)
            if role is not None:
                begin, close = at + len(marks[role][0]), marks[role][1]
            elif text.startswith(other[0], at):
                cut = text.find(other[1], at)
                if cut < 0:
                    raise ValueError(f"no {other[1]} after {at}")
                role, begin, close = self.unescape(text[at + len(other[0]) : cut]), cut + len(other[1]), other[2]
            else:
                role, begin, close = self.template.plain, at, marks[self.template.plain][1]
            end = text.find(close, begin)
            if end < 0:
                raise ValueError(f"no {close} after {begin}")
            yield role, begin, end
            at = end + len(close)

    def turns(self, text: str) -> list[tuple[str, str]]:
        return [(role, self.unescape(text[a:b])) for role, a, b in self.parse(text)]

    def write(self, turns: Iterable[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
        """The rendered turns and the loss mask: begin and end of each assistant text.

        Every turn is written plainly first and read back; content that does not come back identical is
        escaped, first whole control strings, then their characters. The whole is read back once more.
        """
        turns = list(turns)
        pieces, spans, at = [], [], 0
        for role, text in turns:
            for level in (0, 1, 2):
                piece, a, b = self.render(role, text, level)
                try:
                    same = self.turns(piece) == [(role, text)]
                except ValueError:
                    same = False
                if same:
                    break
            else:
                raise ValueError("a turn does not survive the round trip")
            pieces.append(piece)
            if role == self.template.plain:
                spans.append((at + a, at + b))
            at += len(piece)
        whole = "".join(pieces)
        if self.turns(whole) != turns:
            raise ValueError("the turns do not survive the round trip")
        return whole, spans


def format_chats(
    rows: DataFrame,
    template: Template | None = None,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv_id, part, formatted, loss`` (begin and end of each assistant text) for every conversation.

    Turns come by number (null first), then role, then text. Null texts and roles are empty; a null
    conv_id is a conversation of its own; repeated rows are repeated turns. Parts of a conversation are whole
    turns and stand together, in order, in one partition; a very long conversation streams through a task part
    by part. Other columns are not looked at. An empty table gives an empty one.
    """
    template = template or Template()
    chosen = rows.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(role_col, F.lit("")).alias("role"),
        text_of(text_col).alias("text"),
    )
    dealt = chosen.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = "conv_id long, part int, formatted string, loss array<struct<begin:int,end:int>>"
    arrow = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("part", pa.int32()),
            ("formatted", pa.string()),
            ("loss", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
        ]
    )

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(template)
        conv, part, turns, chars, started = None, 0, [], 0, False
        out: list[tuple] = []

        def flush() -> None:
            text, loss = grammar.write(turns)
            out.append((conv, part, text, [{"begin": a, "end": b} for a, b in loss]))

        def batch() -> pa.RecordBatch:
            columns = [list(c) for c in zip(*out, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

        for rows in batches:
            held = 0
            names = ("conv_id", "role", "text")
            for c, role, text in zip(*(rows.column(n).to_pylist() for n in names), strict=True):
                if started and c != conv:
                    flush()
                    held += chars
                    part, turns, chars = 0, [], 0
                elif turns and (len(turns) >= PART_TURNS or chars + len(text) > PART_CHARS):
                    flush()
                    held += chars
                    part, turns, chars = part + 1, [], 0
                conv, started = c, True
                turns.append((role, text))
                chars += len(text)
                if held > 8 * PART_CHARS:
                    yield batch()
                    held = 0
            if out:
                yield batch()
        if started:
            flush()
            yield batch()

    return dealt.select("conv_id", "role", "text").mapInArrow(render, schema)


def in_order(formatted: DataFrame) -> DataFrame:
    """Parts as :func:`format_chats` leaves them, of a table that was written: files may hold them in any order."""
    return formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part")


def read_back(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """Digests per conversation, read from the rendered parts alone (as :func:`format_chats` leaves them, or :func:`in_order`)."""
    template = template or Template()
    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(template)
        conv, state = None, None

        def result(done: list[tuple]) -> pa.RecordBatch:
            convs, states = [d[0] for d in done], [d[1] for d in done]
            return pa.RecordBatch.from_pydict(
                {
                    "conv_id": pa.array(convs, pa.int64()),
                    "n_turns": pa.array([s["n"] for s in states], pa.int64()),
                    "turns_sha256": pa.array([s["turns"].hexdigest() for s in states], pa.string()),
                    "loss_chars": pa.array([s["chars"] for s in states], pa.int64()),
                    "loss_sha256": pa.array([s["loss"].hexdigest() for s in states], pa.string()),
                    "formatted_chars": pa.array([s["all"] for s in states], pa.int64()),
                }
            )

        for rows in batches:
            done = []
            for row in rows.to_pylist():
                if row["part"] == 0:
                    if state is not None:
                        done.append((conv, state))
                    conv = row["conv_id"]
                    state = {"n": 0, "turns": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "all": 0}
                text = row["formatted"]
                state["all"] += len(text)
                for role, said in grammar.turns(text):
                    state["n"] += 1
                    state["turns"].update(f"{role}\n{said}\n".encode())
                for span in row["loss"]:
                    said = grammar.unescape(text[span["begin"] : span["end"]])
                    state["chars"] += len(said)
                    state["loss"].update(said.encode())
            if done:
                yield result(done)
        if state is not None:
            yield result([(conv, state)])

    return formatted.mapInArrow(digest, schema)
