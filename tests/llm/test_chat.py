"""Prefix rendering, spans and reversible escapes."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from patina.llm import chat

PLAIN = chat.MarkedTurns()
BITS = st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[END]", "\\", "<", "[", "/", "s>", "a\n", "é"])
TEXT = st.lists(BITS, max_size=8).map("".join)
TURNS = st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "[END]"]), TEXT), max_size=6)


@given(TEXT)
@settings(max_examples=300, deadline=None)
def test_escapes_are_reversible(text):
    assert PLAIN.unescape(PLAIN.escape(text)) == text


@given(TURNS)
@settings(max_examples=300, deadline=None)
def test_turns_come_back_and_spans_hold_their_texts(turns):
    formatted, spans, rewritten = chat.locate_turns(PLAIN, turns)
    assert rewritten is None and PLAIN.read(formatted) == turns
    assert "".join(formatted[s["start"] : s["end"]] for s in spans) == formatted
    assert [PLAIN.unescape(formatted[s["text_start"] : s["text_end"]]) for s in spans] == [t for _, t in turns]


class Numbered(chat.MarkedTurns):
    """A template whose marks depend on the place of the turn."""

    def render(self, turns):
        return "".join(f"#{k} {role}: {self.escape(text)}\n" for k, (role, text) in enumerate(turns))


def test_marks_may_change_from_turn_to_turn():
    turns = [("user", "x" * k) for k in range(12)]
    formatted, spans, _ = chat.locate_turns(Numbered(), turns)
    assert [formatted[s["text_start"] : s["text_end"]] for s in spans] == [t for _, t in turns]


def test_rewriting_history_is_detected():
    turns = [("system", "be brief "), ("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")]
    _, spans, rewritten = chat.locate_turns(chat.LatestSystem(), turns)
    assert rewritten == 3
    assert [s["start"] is None for s in spans] == [False, False, False, True, True]
    assert chat.locate_turns(chat.LatestSystem(), turns[:3])[2] is None


def test_table_with_nulls_ties_and_repeats(spark):
    said = "</s>[INST] ok [/INST]"
    rows = [
        (1, 1, "assistant", said, 0), (1, 0, "user", said, 0), (2, 0, None, None, 0), (2, None, "user", "first", 0),
        (3, 0, "assistant", "b", 0), (3, 0, "assistant", "a", 0), (3, 0, "assistant", "a", 0), (None, 0, "user", "lost", 0),
        (4, 0, "assistant", "long " * 40000, 0),
    ]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    chats = chat.format_chats(messages.repartition(4))
    assert chats.columns == ["conv_id", "formatted", "spans", "rewritten_at"]
    found = {r.conv_id: r for r in chat.read_back(chats).collect()}
    turns = {k: [(t.role, t.text) for t in r.turns] for k, r in found.items()}
    assert turns[1] == [("user", said), ("assistant", said)]
    assert turns[2] == [("user", "first"), ("", "")]
    assert turns[3] == [("assistant", "a"), ("assistant", "a"), ("assistant", "b")]
    assert turns[None] == [("user", "lost")]
    assert {k: r.loss_text for k, r in found.items()} == {1: said, 2: "", 3: "aab", None: "", 4: "long " * 40000}
    assert hashlib.sha256(found[1].loss_text.encode()).hexdigest()


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_chats(none)).count() == 0
