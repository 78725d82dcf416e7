"""Benchmark windows in documents against plain Python."""

import random
import re

import pytest

from patina.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOC, ITEM = "doc_id long, text string, n_hit string", "item_id long, text string"


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def tables():
    draw = random.Random(5)
    vocabulary = ["Ab", "ç", "naïve", "x1", "THE", "of", "日本"]
    say = lambda n: draw.choice([" ", ", ", "--"]).join(draw.choice(vocabulary) for _ in range(n))
    items = [(i, say(draw.choice([3, 9, 10, 11, 14]))) for i in range(12)]
    items += [(50, None), (51, "..."), (52, "solo"), (None, "no name at all here my dear friend of old times"), items[0]]
    docs = []
    for i in range(60):
        text = say(draw.randrange(0, 30))
        for _ in range(draw.randrange(3)):
            text += "; " + (items[draw.randrange(12)][1]).replace(" ", "\n") + " ! " + say(2)
        docs.append((i, text, "clash"))
    docs += [(100, None, "a"), (101, "", "a"), (102, "Solo", "a"), (103, "(solo)", "a"), (104, "solos", "a"), (None, "SOLO no name at all here my dear friend of old times!", "a")]
    docs += [(105, "z " * 60000 + "solo", "a"), docs[3]]
    return docs, items


def expected(docs, items, width):
    windows = {}
    for name, text in items:
        w = WORD.findall(low(text))
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + width]), set()).update([] if name is None else [str(name)])
    sizes = {len(w) for w in windows}
    out = []
    for key, text, _ in docs:
        spans = [m.span() for m in WORD.finditer(low(text))]
        w = [m.group() for m in WORD.finditer(low(text))]
        hit, names = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    names |= windows[tuple(w[i : i + n])]
        runs = [i for i in sorted(hit) if i - 1 not in hit]
        ends = [i for i in sorted(hit) if i + 1 not in hit]
        out.append((key, len(w), len(hit), [(spans[a][0], spans[b][1], a, b) for a, b in zip(runs, ends, strict=True)], sorted(names)))
    return sorted(out, key=str)


@pytest.mark.parametrize("width, size", [(10, 2_000_000), (3, 2_000_000), (10, 300)])
def test_against_brute_force(spark, width, size):
    docs, items = tables()
    found = decontaminate.find_passages(
        spark.createDataFrame(docs, DOC).repartition(3), spark.createDataFrame(items, ITEM), width=width, pattern_bytes=size
    )
    assert found.columns == ["doc_id", "text", "n_words", "n_hit", "spans", "item_ids"]
    got = [(r.doc_id, r.n_words, r.n_hit, [tuple(s) for s in r.spans], list(r.item_ids)) for r in found.collect()]
    assert sorted(got, key=str) == expected(docs, items, width)


def test_empty_tables(spark):
    docs, items = tables()
    none = decontaminate.find_passages(spark.createDataFrame([], DOC), spark.createDataFrame(items, ITEM))
    assert none.count() == 0
    clean = decontaminate.find_passages(spark.createDataFrame(docs, DOC), spark.createDataFrame([], ITEM), keep=["doc_id"])
    assert clean.columns == ["doc_id", "n_words", "n_hit", "spans", "item_ids"]
    assert {(r.n_hit, len(r.spans), len(r.item_ids)) for r in clean.collect()} == {(0, 0, 0)}


def test_a_benchmark_beyond_the_driver_is_refused(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 10)
    docs, items = tables()
    with pytest.raises(ValueError):
        decontaminate.find_passages(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM))
