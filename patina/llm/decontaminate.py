"""Finding benchmark passages in documents with an Aho-Corasick automaton.

Benchmark items become windows of consecutive normalised words, and all windows become
patterns of one automaton. Each document is normalised in the same way and scanned once,
whatever the number of windows; byte and word positions lead back to the original text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patina.llm.shared import ship, stored, text_slices
from patina.llm.words import IS_WORD, LOWER, find_words, text_bytes

WINDOW = 10
PATTERN_BYTES = 2_000_000  # patterns of one automaton: about 60 bytes of memory for each of these
ITEM_BYTES = 256_000_000  # the benchmark must fit the driver; a larger one is refused
RESULT = ("n_words", "n_hit", "spans", "item_ids")
ADDED = (
    "n_words bigint, n_hit bigint, "
    "spans array<struct<start:bigint,end:bigint,first_word:bigint,last_word:bigint>>, item_ids array<string>"
)


def normalised(raw: np.ndarray, at: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Lower-case words with one space before and after each, and where each text begins."""
    inside = IS_WORD[raw]
    begins = np.zeros(len(raw) + 1, bool)
    begins[at[:-1]] = True
    ends_word = np.zeros(len(raw), bool)
    ends_word[1:] = inside[:-1] & (~inside[1:] | begins[1:-1])
    # A word that ends where its text ends has no byte after it that could become a space.
    last = at[1:][(at[1:] > at[:-1])] - 1
    glued = last[inside[last]]
    out = np.where(inside, LOWER[raw], 32).astype(np.uint8)
    keep = inside | (ends_word & ~begins[:-1])
    pieces, sizes = out[keep], np.concatenate([[0], np.cumsum(keep)])
    tail = np.zeros(len(raw) + 1, np.int64)
    tail[glued + 1] = 1
    grown = sizes + np.cumsum(tail)
    text = np.full(int(grown[-1]), 32, np.uint8)
    kept = np.flatnonzero(keep)
    text[grown[kept]] = pieces
    return text.tobytes(), grown[at]


def window_items(items: list[tuple[str | None, str | None]], width: int) -> list[tuple[bytes, int, list[str]]]:
    """Each distinct window, its number of words, and the ids of the items that hold it."""
    found: dict[bytes, tuple[int, set[str]]] = {}
    raw, at = text_bytes(pa.array([t for _, t in items], pa.string()))
    text, begin = normalised(raw, at)
    for k, (name, _) in enumerate(items):
        words = text[begin[k] : begin[k + 1]].split()
        for i in range(max(1, len(words) - width + 1) if words else 0):
            part = words[i : i + width]
            ids = found.setdefault(b" " + b" ".join(part) + b" ", (len(part), set()))[1]
            if name is not None:
                ids.add(name)
    return [(key, n, sorted(ids)) for key, (n, ids) in sorted(found.items())]


@lru_cache(maxsize=1)
def _automaton(patterns: Broadcast) -> ahocorasick.Automaton | None:
    """Built once in each Python worker; nothing where there are no windows."""
    if not patterns.value:
        return None
    made = ahocorasick.Automaton()
    for key, n, ids in patterns.value:
        made.add_word(key.decode("latin-1"), (n, ids))
    made.make_automaton()
    return made


def _word_spans(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of each run of hit words."""
    edges = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - 1


def _scan(batch: pa.RecordBatch, text: str, patterns: Broadcast) -> Iterator[list]:
    """n_words, n_hit, spans and item ids of each row."""
    automaton = _automaton(patterns)
    raw, at = text_bytes(batch.column(text))
    starts, ends, doc = find_words(raw, at)
    first = np.searchsorted(doc, np.arange(len(at)))
    clean, begin = normalised(raw, at)
    for k in range(len(at) - 1):
        n = int(first[k + 1] - first[k])
        found = list(automaton.iter(" " + clean[begin[k] : begin[k + 1]].decode("latin-1"))) if n and automaton else []
        if not found:
            yield [n, 0, [], []]
            continue
        body = np.frombuffer(clean, np.uint8, int(begin[k + 1] - begin[k]), int(begin[k]))
        gaps = np.flatnonzero(body == 32) + 1  # positions of the space after each word
        cover, ids = np.zeros(n + 1, np.int64), set()
        for end, (width, names) in found:
            last = int(np.searchsorted(gaps, end))
            cover[last - width + 1] += 1
            cover[last + 1] -= 1
            ids.update(names)
        hit = np.cumsum(cover)[:n] > 0
        lows, highs = _word_spans(hit)
        letters = np.concatenate([[0], np.cumsum((raw[at[k] : at[k + 1]] & 0xC0) != 0x80)])
        spans = [
            {
                "start": int(letters[starts[first[k] + a] - at[k]]),
                "end": int(letters[ends[first[k] + b] - at[k]]),
                "first_word": int(a),
                "last_word": int(b),
            }
            for a, b in zip(lows, highs, strict=True)
        ]
        yield [n, int(hit.sum()), spans, sorted(ids)]


def find_passages(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WINDOW,
    keep: list[str] | None = None,
    pattern_bytes: int = PATTERN_BYTES,
) -> DataFrame:
    """Words of each document that lie in a window of ``width`` words of some item.

    Returns the columns ``keep`` of every row (all by default) with n_words, n_hit, spans
    (runs of hit words: code points [start, end) of the original text, and word numbers)
    and item_ids (items of which a window occurs, sorted as strings). Columns of these
    names are replaced. An item of fewer words, but not none, is one window.

    Null or empty text has no words. Items without words have no windows; windows of an
    item without an id count as hits and name no item; repeated items count once. Empty
    tables give no rows, or no hits.

    The windows go to every task. Their size is checked: beyond ``pattern_bytes`` they are
    split over several automata and the documents are scanned once for each, so memory
    stays bounded and every window is still looked for. A benchmark of more than
    ``ITEM_BYTES`` is refused, for the driver holds it while making windows.
    """
    spark = docs.sparkSession
    ship(spark)
    wanted = items.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).alias("text")).distinct()
    total = wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if total > ITEM_BYTES:
        raise ValueError(f"the benchmark holds {total} bytes; at most {ITEM_BYTES} are supported")
    windows = window_items([(r.id, r.text) for r in wanted.collect()], width)
    parts = max(1, math.ceil(sum(len(w[0]) for w in windows) / pattern_bytes))
    held = [c for c in (docs.columns if keep is None else keep) if c not in RESULT]
    carried = list(dict.fromkeys([*held, text]))
    rows = docs.select(*carried)
    out = T.StructType([rows.schema[c] for c in carried])
    out = T.StructType([*out, *T.StructType.fromDDL(ADDED)])
    rows = rows.select(
        *carried, *[F.lit(None).cast(out[c].dataType).alias(c) for c in RESULT]
    )
    for part in range(parts):
        patterns = spark.sparkContext.broadcast(windows[part::parts])
        if part:
            rows = stored(rows)  # one automaton at a time in a worker
        last = part == parts - 1
        schema = T.StructType([f for f in out if not last or f.name in (*held, *RESULT)])

        def scan(batches, patterns=patterns, names=schema.names) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in text_slices(whole, text):
                    old = [batch.column(c).to_pylist() for c in RESULT]
                    new = [
                        _merged(fresh, row) if row[0] is not None else fresh
                        for fresh, row in zip(_scan(batch, text, patterns), zip(*old, strict=True), strict=True)
                    ]
                    made = dict(zip(RESULT, zip(*new, strict=True), strict=True)) if new else dict.fromkeys(RESULT, ())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(made[c], batch.schema.field(c).type) if c in made else batch.column(c)
                            for c in names
                        ],
                        names=names,
                    )

        rows = rows.mapInArrow(scan, schema)
    return rows


def _merged(a: list, b: tuple) -> list:
    """Hits of two automata in one document."""
    hit = np.zeros(a[0], bool)
    where: dict[int, int] = {}
    ends: dict[int, int] = {}
    for span in [*a[2], *b[2]]:
        hit[span["first_word"] : span["last_word"] + 1] = True
        where[span["first_word"]], ends[span["last_word"]] = span["start"], span["end"]
    lows, highs = _word_spans(hit)
    spans = [
        {"start": where[int(i)], "end": ends[int(j)], "first_word": int(i), "last_word": int(j)}
        for i, j in zip(lows, highs, strict=True)
    ]
    return [a[0], int(hit.sum()), spans, sorted({*a[3], *b[3]})]
