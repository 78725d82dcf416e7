"""Site-relative line frequency against plain Python."""

from patina.llm import linededup

SCHEMA = "doc_id long, text string, source string, n_lines int, host string"


def pages():
    rows = [(i, f"menu\nbody {i}\n menu \nend {i % 2}", "big", 7, "x") for i in range(40)]
    rows += [(100 + i, f"menu\nother {i}", "small", 7, None) for i in range(5)]
    rows += [(200 + i, "rare\nmenu" if i < 2 else f"text {i}\n\n", None, 7, "y") for i in range(30)]
    rows += [(300, None, "big", 7, "z"), (301, "", "big", 7, "z"), (None, "menu", "big", 7, "z"), (302, "menu\n" * 50000, "big", 7, "z")]
    return [*rows, rows[0]]


def cleaned(rows, ratio, least):
    held, total = {}, {}
    for _, text, host, *_ in rows:
        total[host] = total.get(host, 0) + 1
        for line in {x.strip(" ") for x in (text or "").split("\n")} - {""}:
            held[host, line] = held.get((host, line), 0) + 1
    bad = {k for k, n in held.items() if n >= least and n / total[k[0]] > ratio}
    out = []
    for key, text, host, *_ in rows:
        if text is None:
            out.append((key, None, 0, 0))
            continue
        lines = text.split("\n")
        left = [x for x in lines if (host, x.strip(" ")) not in bad]
        out.append((key, "\n".join(left), len(lines), len(lines) - len(left)))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: tuple(map(str, r)))


def test_against_brute_force(spark):
    for ratio, least in ((0.1, 10), (0.05, 2), (0.6, 1)):
        found = linededup.drop_boilerplate(
            spark.createDataFrame(pages(), SCHEMA).repartition(5), ratio=ratio, min_pages=least
        )
        assert found.columns == ["doc_id", "text", "source", "host", "n_lines", "n_dropped"]
        got = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found.collect()]
        assert ordered(got) == ordered(cleaned(pages(), ratio, least))


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(linededup, "BROADCAST_LINES", 0)
    found = linededup.drop_boilerplate(spark.createDataFrame(pages(), SCHEMA))
    got = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found.collect()]
    assert ordered(got) == ordered(cleaned(pages(), linededup.RATIO, linededup.MIN_PAGES))


def test_hosts_of_any_size_go_by_the_ratio(spark):
    rows = [(1000 * n + i, f"menu\nbody {n} {i}", f"host {n}", 7, "x") for n in (3, 9, 10) for i in range(n)]
    rows += [(90_000 + i, f"{'some' if i < 6 else 'other'}\nbody {i}", "fifty", 7, "x") for i in range(50)]
    rows += [(80_000 + i, "copied\nwhole", "copies", 7, "x") for i in range(2)]
    found = linededup.drop_boilerplate(spark.createDataFrame(rows, SCHEMA)).collect()
    assert ordered((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found) == ordered(cleaned(rows, 0.1, 3))
    dropped = {h: sum(r.n_dropped for r in found if r.source == h) for h in {r.source for r in found}}
    assert dropped == {"host 3": 3, "host 9": 9, "host 10": 10, "fifty": 50, "copies": 0}


def test_empty_table(spark):
    assert linededup.drop_boilerplate(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_runs(spark):
    plan = linededup.drop_boilerplate(spark.createDataFrame(pages(), SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
