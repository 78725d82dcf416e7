"""License templates against regular expressions over all words."""

import random
import re

import pytest

from patina.errors import PatinaError
from patina.llm import licenses
from patina.llm.license_templates import MIT, TEMPLATES
from patina.llm.queries import op12_license_scan, template_pattern

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}
SMALL = [
    ("a", "under the <<beginOptional>>very <<var;name=x;words=0-2>> nice<<endOptional>> mit license"),
    ("b", "licensed <<var;name=who;words=1-3>> under <<beginOptional>>the<<endOptional>>"),
    ("b", "see <<var;name=what;words=2-2>> license <<beginOptional>>file <<beginOptional>>there<<endOptional>><<endOptional>>"),
]


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def every_match(text, templates):
    """Leftmost longest matches of each template by trying every end for every start."""
    w, found = words(text), set()
    for label, markup in templates:
        whole = re.compile(template_pattern(licenses.parse(markup)))
        at = 0
        while at < len(w):
            ends = [j for j in range(at, min(len(w), at + 300)) if whole.fullmatch(" " + " ".join(w[at : j + 1]))]
            if ends:
                found.add((label, at, ends[-1]))
                at = ends[-1]
            at += 1
    return sorted(found, key=lambda m: (m[1], m[2], m[0]))


def texts():
    pick = random.Random(5)
    some = ["under", "the", "very", "nice", "mit", "license", "licensed", "see", "file", "there", "Foo", "é"]
    rows = [" ".join(pick.choice(some) for _ in range(pick.randrange(40))) for _ in range(300)]
    return rows + [None, "", "!!", "MIT  License.\nmit-license", "LICENSED x under"]


def test_matches_against_every_start_and_end():
    automaton = licenses.TokenAutomaton(SMALL)
    for text in texts():
        assert automaton.matches(licenses.words_of((text or "").encode())) == every_match(text, SMALL)


def filled(markup):
    """Two texts of a template: without and with its optional regions."""
    bare = re.sub(r"<<beginOptional>>.*?<<endOptional>>", " ", markup, flags=re.S)
    full = re.sub(r"<<(begin|end)Optional>>", " ", markup)
    return [re.sub(r"<<var;.*?words=(\d+)-(\d+)>>", lambda m: " ".join(["Jane"] * int(m[k])), t) for k, t in ((1, bare), (2, full))]


@pytest.mark.parametrize("label, markup", TEMPLATES)
def test_each_template_accepts_its_own_wording_only(label, markup):
    automaton = licenses.TokenAutomaton(TEMPLATES)
    for text in filled(markup):
        found = automaton.matches(licenses.words_of(("Intro. " + text + " more").encode()))
        assert label in {m[0] for m in found}
        w = words(text)
        mandatory = [x.decode() for x in licenses.parse(markup) if isinstance(x, bytes)]
        for gone in {mandatory[1], mandatory[-1], mandatory[len(mandatory) // 2]}:
            at = len(w) - 1 - w[::-1].index(gone)
            broken = " ".join(w[:at] + ["changed"] + w[at + 1 :])
            one = licenses.TokenAutomaton([(label, markup)])
            assert every_match(broken, [(label, markup)]) == one.matches(licenses.words_of(broken.encode()))


def test_a_changed_word_is_not_accepted():
    one = licenses.TokenAutomaton([("MIT", MIT)])
    good = filled(MIT)[0]
    assert [m[0] for m in one.matches(licenses.words_of(good.encode()))] == ["MIT"]
    assert one.matches(licenses.words_of(good.replace("merge", "merged").encode())) == []
    assert one.matches(licenses.words_of(good.replace("Jane", "Jane " * 21).encode())) == []


@pytest.mark.parametrize("markup", ["<<beginOptional>>x", "<<var;name=a;words=3-1>> x", "<<what>> x", "<<var;name=a;words=1-2>> x", "<<beginOptional>>x<<endOptional>>"])
def test_bad_markup_is_refused(markup):
    with pytest.raises(PatinaError):
        licenses.TokenAutomaton([("x", markup)])


def test_table(spark, tmp_path):
    lines = ["Released under the MIT License.", "x Licensed under the Apache License, Version 2.0.", "the MIT\nLicense; the mit license", "Licensed under CC BY-NC 4.0.", "GNU General Public License, version 3", filled(MIT)[1]]
    rows = [(i, t, 7, "old") for i, t in enumerate(texts() + lines + ["word " * 200_000 + lines[0]])]
    rows += [(None, lines[0], 7, "old"), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, matches string")
    found = licenses.find_licenses(docs.repartition(3))
    assert found.columns == ["doc_id", "text", "n_words", "phrases", "matches"]
    for r in found.collect():
        w = words(r.text)
        assert r.n_words == len(w)
        want = sorted((i, k) for k, p in BASE.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split())
        assert [(p.first_word, p.label) for p in r.phrases] == want
        if len(w) < 1000:
            assert [tuple(m) for m in r.matches] == every_match(r.text, TEMPLATES)
    assert licenses.find_licenses(docs.limit(0)).count() == 0
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    by_id = {r.doc_id: r for r in op12_license_scan(spark, str(tmp_path)).collect()}
    n = len(texts())
    assert [by_id[n + k].labels for k in range(6)] == ["MIT,mit", "Apache-2.0,apache", "mit", "CC-BY-NC-4.0", "gpl", "MIT"]
    assert [by_id[n + k].score for k in range(6)] == [1, 1, 0.5, 1, 0.5, 1]
    long = by_id[n + 6]
    assert (long.n_words, long.n_base, long.first_word, long.last_word) == (200_005, 1, 200_003, 200_003)
