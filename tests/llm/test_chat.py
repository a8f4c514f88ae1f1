from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from epigauge.llm import chat
from epigauge.llm.chat import Grammar, Template

MARKS = Template().controls + ["\\", "\\0", "[INST] ", " [/INST]", "<", "[", "/", " ", "a", "é"]
TEXT = st.lists(st.sampled_from(MARKS), max_size=6).map("".join) | st.text(max_size=8)
ROLE = st.sampled_from(["user", "assistant", "system", "tool", ""]) | TEXT


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(ROLE, TEXT), max_size=5))
def test_any_turns_come_back(turns):
    grammar = Grammar(Template())
    whole, loss = grammar.write(turns)
    assert grammar.turns(whole) == turns
    assert [grammar.unescape(whole[a:b]) for a, b in loss] == [t for r, t in turns if r == "assistant"]


def test_plain_text_is_not_escaped():
    whole, loss = Grammar(Template()).write([("user", "a < b"), ("assistant", "yes")])
    assert whole == "[INST] a < b [/INST]yes</s>" and whole[slice(*loss[0])] == "yes"


def test_text_out_of_grammar_is_refused():
    for text in ("[INST] open", "no end", "<|role|>r", "<|role|>r<|text|>t"):
        with pytest.raises(ValueError):
            list(Grammar(Template()).parse(text))


SCHEMA = "conv_id long, turn long, role string, text string, part int, formatted string"
SAID = "</s>[INST] ok [/INST]"


def digests(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        told = [t[3] or "" for t in turns if t[2] == "assistant"]
        out[conv] = (
            len(turns),
            hashlib.sha256("".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in turns).encode()).hexdigest(),
            len("".join(told)),
            hashlib.sha256("".join(told).encode()).hexdigest(),
        )
    return out


def read(spark, rows):
    df = spark.createDataFrame([(*r, 7, "old") for r in rows], SCHEMA).repartition(3)
    got = chat.read_back(chat.format_chats(df)).collect()
    assert len(got) == len({r["conv_id"] for r in got})
    return {r["conv_id"]: tuple(r)[1:5] for r in got}


def test_conversations(spark):
    rows = [(-7, 0, "user", SAID), (-7, 1, "assistant", SAID), (1, 0, None, None), (1, 1, "assistant", ""), (1, 1, "assistant", "")]
    rows += [(2, None, "assistant", "first"), (2, 0, "user", "x" * 300_000), (None, 0, "tool", "of none"), (3, 0, "assistant", "é" * 10)]
    assert read(spark, rows) == digests(rows)


def test_long_conversations_go_in_parts(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART_TURNS", 4)
    monkeypatch.setattr(chat, "PART_CHARS", 30)
    rows = [(c, t, "user" if t % 2 else "assistant", f"{SAID} {t}" * (t % 3)) for c in (1, 2, 3) for t in range(57)]
    assert read(spark, rows) == digests(rows)


def test_no_conversations(spark):
    assert read(spark, []) == {}
