"""Chat formatting with any template, by rendering one more turn at a time.

A template is a black box: turns in, text out. Rendering the first k and the first k + 1
turns and comparing shows which span the new turn added, or that the template rewrote what
it had said before. Rendering the turn again with other words shows where its text lies.
"""

from __future__ import annotations

import os.path
import re
from collections.abc import Iterator, Sequence
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patina.llm.shared import ship

Turn = tuple[str, str]  # role, text


class Template(Protocol):
    def render(self, turns: Sequence[Turn]) -> str: ...

    def escape(self, text: str) -> str: ...

    def unescape(self, text: str) -> str: ...

    def read(self, formatted: str) -> list[Turn]: ...


class MarkedTurns:
    """Every turn between marks of its role; a backslash keeps marks inside texts apart.

    Escaping puts one backslash after the first character of a mark, also where there are
    some already, and unescaping takes one away, so any text comes back unchanged.
    """

    MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
    OTHER = ("[ROLE]", "[/ROLE]", "[END]")
    _MARK = r"(?=<SYS>>|</SYS>>|/?INST\]|/?s>|/?ROLE\]|END\])"
    _PLAIN, _ESCAPED = re.compile(r"([<\[])(\\*)" + _MARK), re.compile(r"([<\[])\\(\\*)" + _MARK)
    _TURN = re.compile(
        r"<<SYS>>(.*?)<</SYS>>|\[INST\](.*?)\[/INST\]|<s>(.*?)</s>|\[ROLE\](.*?)\[/ROLE\](.*?)\[END\]", re.S
    )

    def escape(self, text: str) -> str:
        return self._PLAIN.sub(r"\1\\\2", text)

    def unescape(self, text: str) -> str:
        return self._ESCAPED.sub(r"\1\2", text)

    def render(self, turns: Sequence[Turn]) -> str:
        return "".join(map(self._one, turns))

    def _one(self, turn: Turn) -> str:
        role, text = turn
        if role in self.MARKS:
            before, after = self.MARKS[role]
            return f"{before}{self.escape(text)}{after}"
        before, middle, after = self.OTHER
        return f"{before}{self.escape(role)}{middle}{self.escape(text)}{after}"

    def read(self, formatted: str) -> list[Turn]:
        turns = []
        for found in self._TURN.finditer(formatted):
            system, user, assistant, role, other = found.groups()
            for name, text in (("system", system), ("user", user), ("assistant", assistant)):
                if text is not None:
                    turns.append((name, self.unescape(text)))
            if role is not None:
                turns.append((self.unescape(role), self.unescape(other)))
        return turns


class LatestSystem(MarkedTurns):
    """Moves the system text into the latest user turn, and so rewrites history."""

    def render(self, turns: Sequence[Turn]) -> str:
        system = "".join(text for role, text in turns if role == "system")
        users = [k for k, (role, _) in enumerate(turns) if role == "user"]
        shown = [
            (role, system + text) if users and k == users[-1] else (role, text)
            for k, (role, text) in enumerate(turns)
            if role != "system"
        ]
        return super().render(shown)


def _text_place(template: Template, turns: Sequence[Turn], k: int, before: str) -> tuple[int, int] | None:
    """How many characters stand before and after turn ``k``'s text in what it adds."""
    role = turns[k][0]
    probes = [template.render([*turns[:k], (role, word)]) for word in ("a", "b")]
    if not all(p.startswith(before) for p in probes):
        return None
    one, two = (p[len(before) :] for p in probes)
    head = len(os.path.commonprefix([one, two]))
    tail = len(os.path.commonprefix([one[head:][::-1], two[head:][::-1]]))
    return head, tail


def locate_turns(template: Template, turns: Sequence[Turn]) -> tuple[str, list[dict], int | None]:
    """Render prefix after prefix; give the text, each turn's spans, and the first rewriting turn.

    A turn that rewrites what stood before, and every turn after it, has no spans.
    """
    formatted, spans, rewritten = "", [], None
    places: dict[str, tuple[int, int]] = {}
    for k, (role, text) in enumerate(turns):
        now = template.render(turns[: k + 1])
        if rewritten is None and not now.startswith(formatted):
            rewritten = k
        span = {"role": role, "start": None, "end": None, "text_start": None, "text_end": None}
        if rewritten is None:
            added, shown = now[len(formatted) :], template.escape(text)
            place = places.get(role)
            if place is None or added[place[0] : len(added) - place[1]] != shown:
                place = _text_place(template, turns, k, formatted)
            span["start"], span["end"] = len(formatted), len(now)
            if place is not None and sum(place) <= len(added):
                places[role] = place
                span["text_start"], span["text_end"] = len(formatted) + place[0], len(now) - place[1]
        spans.append(span)
        formatted = now
    return formatted, spans, rewritten


FORMATTED = (
    "formatted string, "
    "spans array<struct<role:string,start:bigint,end:bigint,text_start:bigint,text_end:bigint>>, rewritten_at int"
)


def format_chats(
    messages: DataFrame,
    template: Template | None = None,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation: its id, formatted text, spans of turns, and rewritten_at.

    Spans count code points: [start, end) is what a turn added, [text_start, text_end) its
    text as written there. ``rewritten_at`` is the first turn (from 0) at which the template
    changed what earlier turns had given, else null; spans from there on are null.

    Rows are ordered by turn, null first, then by role and text, so repeated rows are turns
    of their own. Null role and text count as empty; rows without a conversation id form
    one conversation with a null id. Other columns are not used. An empty table gives no
    rows. A conversation is one value, as its formatted text has to be.
    """
    ship(messages.sparkSession)
    template = template or MarkedTurns()
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = messages.select(
        F.col(conversation).alias("id"), F.struct(F.col(turn).alias("at"), blank(role).alias("role"), blank(text).alias("text")).alias("turn")
    )
    grouped = rows.groupBy("id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = [
                    locate_turns(template, [(t["role"], t["text"]) for t in turns])
                    for turns in part.column("turns").to_pylist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *(pa.array([f[i] for f in found], kind) for i, kind in enumerate(_KINDS))],
                    names=["id", "formatted", "spans", "rewritten_at"],
                )

    kind = grouped.schema["id"].dataType.simpleString()
    return grouped.mapInArrow(render, f"id {kind}, {FORMATTED}").withColumnRenamed("id", conversation)


_SPAN = pa.struct(
    [("role", pa.string())] + [(c, pa.int64()) for c in ("start", "end", "text_start", "text_end")]
)
_KINDS = (pa.string(), pa.list_(_SPAN), pa.int32())


def read_back(
    chats: DataFrame, template: Template | None = None, conversation: str = "conv_id", loss_role: str = "assistant"
) -> DataFrame:
    """Turns and loss text of formatted chats, from ``formatted`` and ``spans`` alone.

    Adds turns (role, text), parsed from the formatted text, and loss_text: what the loss
    mask covers, unescaped, which is the text of each ``loss_role`` turn in order. Where
    the template rewrote history, only turns before that are under the mask.
    """
    ship(chats.sparkSession)
    template = template or MarkedTurns()
    kind = chats.schema[conversation].dataType.simpleString()

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns, loss = [], []
            for formatted, spans in zip(
                batch.column("formatted").to_pylist(), batch.column("spans").to_pylist(), strict=True
            ):
                turns.append([{"role": r, "text": t} for r, t in template.read(formatted)])
                loss.append(
                    "".join(
                        template.unescape(formatted[s["text_start"] : s["text_end"]])
                        for s in spans
                        if s["role"] == loss_role and s["text_start"] is not None
                    )
                )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("formatted"),
                    pa.array(turns, pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
                    pa.array(loss, pa.string()),
                ],
                names=["id", "formatted", "turns", "loss_text"],
            )

    rows = chats.select(F.col(conversation).alias("id"), "formatted", "spans")
    return rows.mapInArrow(
        parse, f"id {kind}, formatted string, turns array<struct<role:string,text:string>>, loss_text string"
    ).withColumnRenamed("id", conversation)
