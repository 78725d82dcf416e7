"""Main text of pages with known main texts, and of the given pages against a plain extractor."""

from html.parser import HTMLParser

import pytest

from patina.llm import html

PROSE = "A sentence of the main text that goes on for a while, as prose does, and then ends."
CASES = [
    (None, ""),
    ("", ""),
    ("just words", "just words"),
    ("<p>a<p>b", "a\nb"),
    ("<article><h1>T</h1><p>x&nbsp;&amp;\n y<br>z</p><p></p><p> w </p></article>", "T\nx & y z\nw"),
    ("<nav><a>m</a></nav><article><p>a</p><div class='ad box'>buy</div><p>b</p></article><footer>f</footer>", "a\nb"),
    ("<article>a<div class=comments><p>c</p></div><form>q<input>r</form><aside>s</aside></article>", "a"),
    ("<article><p class=ad>buy<p>a</article>tail", "a"),
    ("<article><div class=ad>never closed<p>a</article><p>tail</p>", "tail"),
    ("<body class='has-sidebar'><main><p>a</p></main><p>out</p></body>", "a"),
    ("<article><p>one <b>bo</b>ld <!-- <p>no</p> --> x</p><script>'<p>no</p>'</script></article>", "one bold x"),
    ("<article><p title='a>b'>in</p><ul><li>1<li>2</ul><table><tr><td>c<td>d</table></article>", "in\n1\n2\nc\nd"),
    ("<article><p>cut off &am", "cut off &am"),
    ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
    (f"<ul><li><a>m1</a><li><a>m2</a></ul><div><h1>Head</h1><p>{PROSE}</p><p>Short.</p></div><div role=contentinfo>c</div>", f"Head\n{PROSE}\nShort."),
    ("<article></article><p>only outside</p>", "only outside"),
    ("<article><p>a</p><div class='alert'>b</div><p>c</p></article>", "a\nc"),
    (f"<article><p>a</p><div class='search-history'><p>{PROSE * 9}</p></div><p>c</p></article>", f"a\n{PROSE * 9}\nc"),
    (f"<article><p>a</p><div class='search'><a>{PROSE * 9}</a></div><p>c</p></article>", "a\nc"),
    (f"<article><div>{PROSE}</div><aside>x</aside><div>b</div></article>", f"{PROSE}\nb"),
    (f"<article>teaser</article><div><p>{PROSE}</p></div><p>end</p>", "teaser"),
    (f"<article>teaser</article><div><p>{PROSE * 9}</p><p>end</p></div>", f"teaser\n{PROSE * 9}\nend"),
]


@pytest.mark.parametrize("page, text", CASES)
def test_cases(page, text):
    assert html.main_text(page) == text


LOST = [
    (f"<div><p>{PROSE} {PROSE}</p><div class=ad>x</div><p>Short end.</p></div>", f"{PROSE} {PROSE}\nShort end."),
    (
        f"<nav>n</nav><div><p>{PROSE}{PROSE}</p><aside>a</aside><h2>Head</h2><div class=ad>x</div><p>{PROSE}{PROSE}</p></div>",
        f"{PROSE}{PROSE}\nHead\n{PROSE}{PROSE}",
    ),
    (
        f"<div><p>{PROSE}{PROSE}</p>" + "<div><a>l</a></div>" * 4 + "<h2>Head</h2>" + "<div><a>l</a></div>" * 4 + f"<p>{PROSE}{PROSE}</p></div>",
        f"{PROSE}{PROSE}\nHead\n{PROSE}{PROSE}",
    ),
    ("<div class='content-sidebar-wrap'><main><p>a</p><div class=ad>x</div></main><p>b</p></div>", "a"),
    ("<div class='no-sidebar'><article><p>a</p></article></div>", "a"),
    ("<section id=with-sidebar><div><article>a<div class=comments><article>c</article></div></article></div></section>", "a"),
    ("<form><div class=ad>x</div><div role=\"main\" class='no-sidebar'>a</div></form>", "a"),
]
STILL_DROPPED = [
    ("<article><p>a</p></article><div class=comments><article>c</article></div>", "a"),
    (f"<div><p>{PROSE}{PROSE}</p></div><div class=related><article>teaser</article></div>", f"{PROSE}{PROSE}"),
    (f"<div><p>{PROSE}{PROSE}</p></div><aside><article>{PROSE * 9}</article></aside>", f"{PROSE}{PROSE}"),
    (f"<div><p>{PROSE}{PROSE}</p></div><div class=ad>x</div><div><p>note</p></div>", f"{PROSE}{PROSE}"),
]


@pytest.mark.parametrize("page, text", LOST + STILL_DROPPED)
def test_removed_elements_and_wrappers_take_no_main_text(page, text):
    assert html.main_text(page) == text


def test_surge_and_dive():
    assert html.surges([0, 5, 100, 3, 0, 0, 0, 9, 0], 3, 86) == [(1, 4)]
    assert html.surges([0, 5, 0, 0, 0, 9], 3, 0) == [(1, 2), (5, 6)]
    assert html.surges([], 3, 0) == []


def test_table(spark):
    rows = [(i, f"http://h/{i}", page, "old") for i, (page, _) in enumerate(CASES)]
    rows += [(90, None, "<article>" + "<p>long text</p>" * 100_000 + "</article>", "old"), rows[4], (None, "u", "<p>x", "old")]
    found = html.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    assert found.columns == ["page_id", "url", "text"]
    got = sorted(((r.page_id, r.url, r.text) for r in found.collect()), key=str)
    assert got == sorted(((r[0], r[1], html.main_text(r[2])) for r in rows), key=str)
    assert spark.createDataFrame([], "html string, page_id int").transform(html.extract_main_text).count() == 0


def test_deep_nesting_and_stray_marks_stay_fast():
    assert html.main_text("<div>" * 20_000 + "x" + "</div>" * 20_000) == "x"
    assert html.main_text("<p " * 20_000) == ""
    assert html.main_text("<a href='" * 5_000 + "y") is not None


class Plain(HTMLParser):
    """Lines of a page as (text, in an article), with empty lines for what isn't main text."""

    EMPTY = ("br", "hr", "img", "meta", "link", "input")
    BLOCKS = ("p", "div", "article", "h1", "h2", "h3", "ul", "ol", "li", "nav", "footer", "header", "body", "html", "head")

    def __init__(self, page, window):
        super().__init__(convert_charrefs=True)
        self.window, self.open, self.out, self.now = window, [], [], ""
        self.feed(page)
        self.close()
        self.cut()

    def skipping(self):
        return any(t in ("nav", "footer", "head", "script", "style", "title") or c == "ad" for t, c in self.open)

    def inside(self):
        return any(t == "article" for t, _ in self.open)

    def cut(self):
        text = " ".join(self.now.split())
        if text:
            self.out.append((text, self.inside()))
        self.now = ""

    def empty(self):
        self.out += [("", False)] * self.window

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.now += " "
        if tag in self.EMPTY:
            return
        if tag in self.BLOCKS:
            self.cut()
            if tag == "p" and any(t == "p" for t, _ in self.open):
                self.handle_endtag("p")
        before = self.skipping()
        self.open.append((tag, dict(attrs).get("class")))
        if tag == "article" or (self.skipping() and not before and not self.inside()):
            self.empty()

    def handle_endtag(self, tag):
        if tag in self.BLOCKS:
            self.cut()
        if not any(t == tag for t, _ in self.open):
            return
        before, was = self.skipping(), self.inside()
        while self.open.pop()[0] != tag:
            pass
        if (before and not self.skipping() and not self.inside()) or (was and not self.inside()):
            self.empty()

    def handle_data(self, data):
        if not self.skipping():
            self.now += data


def plain_text(page, window, surge):
    lines = Plain(page, window).out
    weights = [len(t) + 100 if inside else len(t) / 8 for t, inside in lines]
    on, kept = False, []
    for i in range(len(lines)):
        total = 0
        for k in range(i, min(i + window, len(lines))):
            total += weights[k]
        if not on and total > surge and weights[i] > 0:
            on = True
        if on and total == 0:
            on = False
        if on and lines[i][0]:
            kept.append(lines[i][0])
    if not kept:
        kept = [t for t, _ in lines if t]
    return "\n".join(kept)


@pytest.fixture(scope="module")
def given_pages(spark):
    return {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}


@pytest.mark.parametrize("window, surge", [(3, 86), (1, 700), (3, 1000), (5, 2500)])
def test_given_pages_against_the_plain_extractor(given_pages, window, surge):
    for page in given_pages.values():
        assert html.main_text(page, window, surge) == plain_text(page or "", window, surge)


def test_window_sums_decide_on_given_pages(given_pages):
    usual = {i: html.main_text(p) for i, p in given_pages.items()}
    for window, surge in ((3, 1000), (1, 86 + 150), (2, 700)):
        changed = [i for i, p in given_pages.items() if html.main_text(p, window, surge) != usual[i]]
        assert len(changed) > 0.1 * len(given_pages), (window, surge)
