"""Periodic runs of words in each text: maximal repetitions by descending LCP.

Suffixes of a text that share a prefix of l words are a class. Going down from the
longest common prefix (LCP), a union-find joins classes of suffixes that are neighbours in
suffix order, and each class keeps its positions in order. Where a union at LCP l puts
position j right after position i, the suffixes at i and j agree on exactly l words, so
words i .. j+l-1 repeat with period j-i. If j-i is at most l this seeds a run, and the run
begins at i if the word before it breaks the period. Each run is seeded at its beginning
exactly once, with its smallest period: a smaller one would put a position between i and j.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from patina.llm.shared import ship, text_slices

MIN_WORDS = 12  # words of the shortest run
ADDED = (
    "n_words bigint, "
    "runs array<struct<start:bigint,length:bigint,period:bigint>>, "
    "kept array<struct<first:bigint,last:bigint>>, collapsed string"
)
RESULT = ("n_words", "runs", "kept", "collapsed")

Run = tuple[int, int, int]  # start, length, period


def word_ids(words: list[bytes]) -> np.ndarray:
    """A number below ``len(words)`` for each word, equal for equal words."""
    last = dict(zip(words, range(len(words)), strict=True))
    return np.fromiter(map(last.__getitem__, words), np.int64, len(words))


def _doubled(ranks: np.ndarray, width: int, size: int) -> np.ndarray:
    """Ranks of windows of ``size`` words from ranks of windows of ``width`` words.

    A window that reaches beyond the end of the text ends in a mark that comes before all
    words, so it differs from all others.
    """
    n = len(ranks)
    second = np.full(n, -1, np.int64)
    second[: max(0, n - (size - width))] = ranks[size - width :]
    return np.unique(ranks * np.int64(n + 1) + second + 1, return_inverse=True)[1].reshape(-1)


def window_ranks(ids: np.ndarray, least: int) -> list[tuple[int, np.ndarray]]:
    """Ranks of windows of ``least`` words, then of 2, 4, ... times as many until all differ.

    Empty where no window of ``least`` words repeats. The last ranks are those of the suffixes.
    """
    n = len(ids)
    if n <= least:
        return []
    ranks, width = ids, 1
    while width < least:
        size = min(2 * width, least)
        ranks, width = _doubled(ranks, width, size), size
    levels = []
    while len(np.unique(ranks)) < n:
        levels.append((width, ranks))
        ranks, width = _doubled(ranks, width, 2 * width), 2 * width
    return [*levels, (width, ranks)] if levels else []


def neighbour_prefixes(ids: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in suffix order that share ``least`` words or more, and how many they share.

    Words are ordered by their numbers, not by the alphabet; classes are the same in any order.
    """
    levels = window_ranks(ids, least)
    none = np.zeros(0, np.int64)
    if not levels:
        return none, none, none
    n = len(ids)
    order = np.argsort(levels[-1][1])
    windows = levels[0][1][order]
    order = order[np.bincount(windows)[windows] > 1]
    a, b = order[:-1], order[1:]
    close = levels[0][1][a] == levels[0][1][b]
    a, b = a[close], b[close]
    shared = np.zeros(len(a), np.int64)
    for width, ranks in reversed(levels):
        i, j = a + shared, b + shared
        inside = (i < n) & (j < n)
        shared += np.where(inside & (ranks[np.minimum(i, n - 1)] == ranks[np.minimum(j, n - 1)]), width, 0)
    alive = np.ones(len(a), bool)
    for _ in range(least - 1):  # windows of ``least`` words leave fewer than these
        i, j = a + shared, b + shared
        alive &= (i < n) & (j < n) & (ids[np.minimum(i, n - 1)] == ids[np.minimum(j, n - 1)])
        shared += alive
    return a, b, shared


def _adjacent(large: list[int], small: list[int]) -> Iterator[tuple[int, int]]:
    """Pairs that become neighbours when two ordered sets are merged, one from each set."""
    at, before = 0, -1
    for k, x in enumerate(small):
        at = bisect_left(large, x, at)
        if at and large[at - 1] > before:
            yield large[at - 1], x
        if at < len(large) and (k + 1 == len(small) or small[k + 1] > large[at]):
            yield x, large[at]
        before = x


def _merge(large: list[int], small: list[int]) -> None:
    """Put the positions of ``small`` into ``large``; both are in order."""
    if len(small) == 1:
        large.insert(bisect_left(large, small[0]), small[0])
    else:
        large.extend(small)
        large.sort()  # two ordered parts, merged in one pass


def find_runs(ids: np.ndarray, least: int = MIN_WORDS) -> list[Run]:
    """Maximal repetitions of at least ``least`` words and two periods, by start and period."""
    # A run of at least ``least`` words and two periods agrees with itself on half as many.
    a, b, shared = neighbour_prefixes(ids, max(1, (least + 1) // 2))
    falling = np.argsort(-shared, kind="stable")
    words = ids.tolist()
    root: dict[int, int] = {}
    members: dict[int, list[int]] = {}

    def find(i: int) -> int:
        top = i
        while (up := root.setdefault(top, top)) != top:
            top = up
        while i != top:
            root[i], i = top, root[i]
        return top

    runs = []
    for i, j, common in zip(a[falling].tolist(), b[falling].tolist(), shared[falling].tolist(), strict=True):
        x, y = find(i), find(j)
        large, small = members.pop(x, None) or [x], members.pop(y, None) or [y]
        if len(large) < len(small):
            x, y, large, small = y, x, small, large
        for first, second in _adjacent(large, small):
            period = second - first
            if period <= common and period + common >= least and (not first or words[first - 1] != words[second - 1]):
                runs.append((first, period + common, period))
        _merge(large, small)
        root[y], members[x] = x, large
    return sorted(runs, key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Whether each word stays: not after the first period of any run that holds it."""
    cover = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    return np.cumsum(cover)[:n] == 0


def _row(text: str | None, least: int) -> tuple:
    words = (text or "").encode().split()
    runs = find_runs(word_ids(words), least)
    if not runs:
        spans = [{"first": 0, "last": len(words) - 1}] if words else []
        return len(words), [], spans, b" ".join(words).decode()
    stay = kept_words(len(words), runs)
    edges = np.diff(np.concatenate([[0], stay.astype(np.int8), [0]]))
    spans = [
        {"first": int(i), "last": int(j) - 1}
        for i, j in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True)
    ]
    left = b" ".join(words[i] for i in np.flatnonzero(stay)).decode()
    return len(words), [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs], spans, left


def collapse_runs(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None, least: int = MIN_WORDS
) -> DataFrame:
    """Find the periodic runs of every text and take out what repeats.

    Returns the columns ``keep`` of every row (all by default) with n_words, runs (start,
    length and period in words, by start and period), kept (runs of words that stay, first
    and last word) and collapsed (these words, joined by one space). Columns of these
    names are replaced. A run is a stretch of at least ``least`` words and two periods
    that no neighbouring word extends; words are what ASCII white space separates.

    Null and empty text have no words and collapse to empty text. Repeated rows stay, and
    an empty table gives no rows. Rows are worked on where they are: nothing is shuffled.
    A text is held whole by one task, at about 8 bytes a word for each doubling of its
    longest repeat.
    """
    ship(docs.sparkSession)
    held = [c for c in (docs.columns if keep is None else keep) if c not in RESULT]
    rows = docs.select(*dict.fromkeys([*held, text]))
    added = T.StructType.fromDDL(ADDED)
    schema = T.StructType([*[rows.schema[c] for c in held], *added])
    kinds = [
        pa.int64(),
        pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])),
        pa.list_(pa.struct([(n, pa.int64()) for n in ("first", "last")])),
        pa.string(),
    ]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, text):
                found = [_row(t, least) for t in batch.column(text).to_pylist()]
                columns = zip(*found, strict=True) if found else [()] * len(kinds)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c) for c in held),
                        *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)),
                    ],
                    names=[*held, *RESULT],
                )

    return rows.mapInArrow(work, schema)
