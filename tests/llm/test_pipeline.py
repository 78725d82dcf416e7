"""Each stage of the pipeline against what its operator must do to its own input."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from patina.llm import linededup, toxicity
from patina.llm.queries import learning_fold, read
from patina.llm.shared import stored

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


@pytest.fixture(scope="module")
def steps(spark):
    docs = read(spark, SF, "documents")
    odd = spark.createDataFrame(
        [(90001, None, "en", None, None), (90002, "", None, "src0", 0), (None, "no id at all", "en", "src1", 12)], docs.schema
    )
    out = [stored(docs.unionByName(odd).unionByName(docs.limit(3)))]
    for _, stage in pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF)))
    return [[r.asDict() for r in s.collect()] for s in out]


def key(row):
    return repr(sorted(row.items()))


def test_toxic_documents_go_and_others_stay_untouched(spark, steps):
    before, after = steps[0], steps[1]
    assert not Counter(map(key, after)) - Counter(map(key, before))
    docs = spark.createDataFrame([Row(**r) for r in before], read(spark, SF, "documents").schema)
    model = toxicity.train(docs, read(spark, SF, "labels"), learn_from=learning_fold)
    scores = [r.score for r in toxicity.score(docs, model, keep=["doc_id"]).collect()]
    assert len(after) == sum(s < 0.5 for s in scores)
    clean = {r.doc_id for r in read(spark, SF, "labels").where("toxic = 0").collect()}
    left = {r["doc_id"] for r in after}
    assert len(clean - left) <= 0.1 * len(clean) and {90001, 90002, None} <= left


def test_boilerplate_lines_go(steps):
    before, after = steps[1], steps[2]
    held, total = Counter(), Counter(r["source"] for r in before)
    for r in before:
        held.update({(r["source"], x.strip(" ")) for x in (r["text"] or "").split("\n") if x.strip(" ")})
    bad = {k for k, n in held.items() if n >= linededup.MIN_PAGES and n / total[k[0]] > linededup.RATIO}

    def cleaned(r):
        if r["text"] is None:
            return r
        lines = r["text"].split("\n")
        left = [x for x in lines if (r["source"], x.strip(" ")) not in bad]
        text = "\n".join(left)
        return {**r, "text": text, "n_chars": len(text) if len(left) < len(lines) else r["n_chars"]}

    assert Counter(map(key, map(cleaned, before))) == Counter(map(key, after))


def shingles(text):
    w = words(text)
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similarity(x, y):
    x, y = ({k: 1 + math.log(n) for k, n in c.items()} for c in (x, y))
    every = set(x) | set(y)
    return sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in every) for d in set(x) & set(y))


def test_one_document_of_each_class_stays(steps):
    before, after = steps[2], steps[3]
    sets = {r["doc_id"]: shingles(r["text"]) for r in before if r["doc_id"] is not None}
    ids, root = sorted(sets), {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, i in enumerate(ids):
        for j in ids[:n]:
            common = len(set(sets[i]) & set(sets[j]))
            if common and common >= 0.3 * max(len(sets[i]), len(sets[j])) and similarity(sets[i], sets[j]) >= 0.8:
                low, high = sorted((find(i), find(j)))
                root[high] = low
    left = Counter(r["doc_id"] for r in after)
    assert {i for i in left if i is not None} == {find(i) for i in ids}
    assert all(n == 1 for i, n in left.items() if i is not None) and left[None] == 1


def test_leaking_documents_go(spark, steps):
    windows = set()
    for r in read(spark, SF, "benchmark").collect():
        w = words(r.text)
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(w) for w in windows}

    def leaks(text):
        w = words(text)
        return any(tuple(w[i : i + n]) in windows for n in sizes for i in range(len(w) - n + 1))

    kept = [r for r in steps[3] if not leaks(r["text"])]
    assert Counter(map(key, kept)) == Counter(map(key, steps[4])) and len(kept) < len(steps[3])


def test_the_mix_is_in_training_order(steps):
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    before, after = steps[4], steps[5]
    assert {"epoch", "position"} <= set(after[0])
    taken = sum(map(size, after))
    assert abs(taken - sum(map(size, before))) <= 10 * max(map(size, before))
    assert max(Counter(r["doc_id"] for r in after).values()) <= 3


def test_run_registers(spark):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is pipeline.run and "pipeline" not in entry.oracle_sql()
    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "line_dedup", "minhash", "decontaminate", "mix"]
    numbers = sorted(int(n[2:].split("_")[0]) for n in entry.queries() if re.match(r"op\d+_", n))
    assert numbers == list(range(1, 14))
    assert read(spark, SF, "documents").where(F.col("doc_id").isNull()).count() == 0


def test_stages_keep_columns_of_clashing_names_and_take_empty_tables(spark):
    docs = read(spark, SF, "documents").limit(30)
    clash = {"score": "a", "predicted": "b", "n_hit": "c", "n_words": "d", "spans": "e", "n_lines": "f", "n_dropped": "g", "row": "h", "kept": "i", "component": "j"}
    wide = docs.withColumns({k: F.concat(F.lit(v), F.col("doc_id").cast("string")) for k, v in clash.items()})
    for name, stage in pipeline.STAGES[:-1]:
        found = stage(spark, stored(wide), SF)
        assert found.columns == wide.columns, name
        rows = found.collect()
        assert rows and all(r[k] == f"{v}{r.doc_id}" for r in rows for k, v in clash.items()), name
    for name, stage in pipeline.STAGES:
        assert stage(spark, stored(docs.limit(0)), SF).count() == 0, name
