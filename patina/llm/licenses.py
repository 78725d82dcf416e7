"""License statements in texts by template markup.

A template is license wording with optional and replaceable regions. Each is compiled into
an automaton over words: mandatory words are its edges, an optional region may be jumped
over, a replaceable region is a chain of edges that any word takes. All templates form one
automaton, whose sets of states are worked out when a text first needs them. A text is
accepted where a path reads its words from one end of a template to the other, so every
mandatory word stands exactly as the template has it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from patina.errors import PatinaError
from patina.llm.license_templates import TEMPLATES
from patina.llm.shared import ship, text_slices
from patina.llm.words import IS_WORD, LOWER, text_bytes

# Phrases of the contract and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
MOST_SETS = 20_000  # sets of states kept; beyond these they are worked out anew

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_LOWER = bytes(LOWER.tolist())
_MARK = re.compile(r"<<(.*?)>>", re.S)
ADDED = (
    "n_words bigint, phrases array<struct<label:string,first_word:bigint>>, "
    "matches array<struct<label:string,first_word:bigint,last_word:bigint>>"
)
RESULT = ("n_words", "phrases", "matches")


def words_of(text: bytes) -> list[bytes]:
    """Words of a text in UTF-8, A-Z in lower case."""
    return _WORD.findall(text.translate(_LOWER))


def parse(markup: str) -> list:
    """A template as a list of words (bytes), (least, most) for replaceable regions, and lists for optional ones."""
    top: list = []
    open_lists = [top]
    for k, part in enumerate(_MARK.split(markup)):
        if k % 2 == 0:
            open_lists[-1].extend(words_of(part.encode()))
        elif part == "beginOptional":
            open_lists[-1].append([])
            open_lists.append(open_lists[-1][-1])
        elif part == "endOptional" and len(open_lists) > 1:
            open_lists.pop()
        elif found := re.fullmatch(r"var;name=\w+;words=(\d+)-(\d+)", part):
            least, most = int(found[1]), int(found[2])
            if not 0 <= least <= most or not most:
                raise PatinaError(f"a replaceable region cannot have {least} to {most} words")
            open_lists[-1].append((least, most))
        else:
            raise PatinaError(f"unknown markup in a license template: {part}")
    if len(open_lists) > 1:
        raise PatinaError("a license template leaves an optional region open")
    return top


class TokenAutomaton:
    """All templates as one automaton over words."""

    def __init__(self, templates: Sequence[tuple[str, str]]) -> None:
        self.on_word: list[dict[bytes, int]] = []
        self.on_any: list[int | None] = []
        self.jumps: list[list[int]] = []
        self.accepts: dict[int, int] = {}
        self.labels = [label for label, _ in templates]
        self.anchors: list[bytes] = []  # a word that no text accepted by the template lacks
        starts = []
        for number, (_, markup) in enumerate(templates):
            items = parse(markup)
            start = self._state()
            end = self._add(items, start)
            self.accepts[end] = number
            starts.append(start)
            mandatory = [x for x in items if isinstance(x, bytes)]
            if not mandatory:
                raise PatinaError("a license template needs a mandatory word")
            self.anchors.append(max(mandatory, key=len))
        self.start = self._reach(starts)
        if any(self.on_any[s] is not None for s in self.start) or any(s in self.accepts for s in self.start):
            raise PatinaError("a license template must begin with a given word")
        self.first_words = {w for s in self.start for w in self.on_word[s]}
        self._steps: dict[frozenset[int], dict[bytes | None, frozenset[int]]] = {}

    def _state(self) -> int:
        self.on_word.append({})
        self.on_any.append(None)
        self.jumps.append([])
        return len(self.jumps) - 1

    def _add(self, items: list, at: int) -> int:
        """Build the path that reads ``items`` from state ``at``; gives its last state."""
        for item in items:
            if isinstance(item, bytes):
                after = self._state()
                self.on_word[at][item] = after
            elif isinstance(item, tuple):
                least, most = item
                ends, now = [at] if least == 0 else [], at
                for n in range(1, most + 1):
                    self.on_any[now] = after = self._state()
                    now = after
                    if n >= least:
                        ends.append(now)
                after = self._state()
                for end in ends:
                    self.jumps[end].append(after)
            else:
                inner = self._state()
                self.jumps[at].append(inner)
                last = self._add(item, inner)
                after = self._state()
                self.jumps[at].append(after)
                self.jumps[last].append(after)
            at = after
        return at

    def _reach(self, states) -> frozenset[int]:
        """``states`` and all that jumps lead to."""
        seen, left = set(states), list(states)
        while left:
            for to in self.jumps[left.pop()]:
                if to not in seen:
                    seen.add(to)
                    left.append(to)
        return frozenset(seen)

    def step(self, states: frozenset[int], word: bytes) -> frozenset[int]:
        """States after ``word``; words that no edge names share one answer."""
        known = self._steps.get(states)
        if known is None:
            if len(self._steps) >= MOST_SETS:
                self._steps.clear()
            named = {w for s in states for w in self.on_word[s]}
            free = [self.on_any[s] for s in states if self.on_any[s] is not None]
            known = {w: self._reach([*free, *(self.on_word[s][w] for s in states if w in self.on_word[s])]) for w in named}
            known[None] = self._reach(free)
            self._steps[states] = known
        after = known.get(word)
        return known[None] if after is None else after

    def matches(self, words: list[bytes]) -> list[tuple[str, int, int]]:
        """(label, first word, last word): of each template the leftmost texts, each as long as possible."""
        found, free_from = [], [0] * len(self.labels)
        for begin, word in enumerate(words):
            if word not in self.first_words:
                continue
            states, at, longest = self.start, begin, {}
            while states and at < len(words):
                states = self.step(states, words[at])
                for s in states:
                    if s in self.accepts:
                        longest[self.accepts[s]] = at
                at += 1
            for number, end in sorted(longest.items()):
                if begin >= free_from[number]:
                    free_from[number] = end + 1
                    found.append((self.labels[number], begin, end))
        return sorted(set(found), key=lambda m: (m[1], m[2], m[0]))


def phrase_places(words: list[bytes], phrases=PHRASES) -> list[tuple[str, int]]:
    """(label, first word) of every place where a phrase's words stand one after another."""
    found = []
    for phrase, label in phrases:
        parts = words_of(phrase.encode())
        at = -1
        for _ in range(words.count(parts[0])):
            at = words.index(parts[0], at + 1)
            if words[at : at + len(parts)] == parts:
                found.append((label, at))
    return sorted(found, key=lambda m: (m[1], m[0]))


def find_licenses(
    docs: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    templates: Sequence[tuple[str, str]] = tuple(TEMPLATES),
) -> DataFrame:
    """License phrases and accepted templates in every text.

    Returns the columns ``keep`` of every row (all by default) with n_words, phrases (label
    and first word of each place) and matches (label, first and last word of each wording
    that a template accepts). Columns of these names are replaced. A template is found
    wherever it begins; of two overlapping finds of one template the first counts.

    Null and empty text have no words, phrases or matches. Repeated rows stay, and an empty
    table gives no rows. Texts are read whole, in parts of a batch by size, and rows are
    worked on where they are. Only texts that hold the letters of a template's longest
    mandatory word, or of a phrase's last word, are cut into words; the others cannot hold
    any of them.
    """
    ship(docs.sparkSession)
    held = [c for c in (docs.columns if keep is None else keep) if c not in RESULT]
    rows = docs.select(*dict.fromkeys([*held, text]))
    schema = T.StructType([*[rows.schema[c] for c in held], *T.StructType.fromDDL(ADDED)])
    templates = list(templates)
    places = [("label", pa.string()), ("first_word", pa.int64())]
    kinds = [
        pa.int64(),
        pa.list_(pa.struct(places)),
        pa.list_(pa.struct([*places, ("last_word", pa.int64())])),
    ]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = TokenAutomaton(templates)
        anchors = sorted({*automaton.anchors, *(words_of(p.encode())[-1] for p, _ in PHRASES)})
        for whole in batches:
            for batch in text_slices(whole, text):
                raw, at = text_bytes(batch.column(text))
                lower = LOWER[raw].tobytes()
                counts = _word_counts(raw, at)
                phrases: list[list[dict]] = []
                matches: list[list[dict]] = []
                for k in range(len(counts)):
                    one = lower[at[k] : at[k + 1]]
                    words = words_of(one) if any(a in one for a in anchors) else []
                    phrases.append([{"label": n, "first_word": i} for n, i in phrase_places(words)])
                    matches.append(
                        [{"label": n, "first_word": i, "last_word": j} for n, i, j in automaton.matches(words)]
                    )
                columns = (counts, phrases, matches)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c) for c in held),
                        *(pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)),
                    ],
                    names=[*held, *RESULT],
                )

    return rows.mapInArrow(work, schema)


def _word_counts(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number of words of each text."""
    inside = IS_WORD[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = at[:-1][at[:-1] < at[1:]]
    first[begins] = inside[begins]
    total = np.concatenate([[0], np.cumsum(first)])
    return total[at[1:]] - total[at[:-1]]
