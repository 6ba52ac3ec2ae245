"""Decontamination and main text."""

import re
import time
from html.parser import HTMLParser

import pytest

from tabforge.llm import decontaminate, main_text


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_decontamination(spark, block_bytes):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").selectExpr("cast(item_id as string) item_id", "text")
    more = [("s1", "the of"), ("s2", "zzzz"), ("s3", ""), ("s4", None), (None, "the the"), ("s1", "A, the"), ("0", "and AND")]
    items = items.unionByName(spark.createDataFrame(more, "item_id string, text string"))
    docs = docs.unionByName(spark.createDataFrame([(None, "The OF the"), (5, None), (6, ""), (7, "zzzz")], "doc_id long, text string"))
    got = decontaminate.find_matches(docs.selectExpr("doc_id", "text", "'x' as hits", "1 as n_words"), items, keep=["doc_id", "text"], block_bytes=block_bytes).collect()
    windows = {}
    for r in items.collect():
        w = words(r.text)
        size = min(10, len(w))
        for k in range(len(w) - size + 1 if w and r.item_id is not None else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add(r.item_id)
    assert len(got) == docs.count()
    for r in got:
        w, hit, found = words(r.text), set(), set()
        for size in {len(k) for k in windows}:
            for k in range(len(w) - size + 1):
                if owners := windows.get(tuple(w[k : k + size])):
                    hit.update(range(k, k + size))
                    found |= owners
        assert r.n_words == len(w)
        assert {i for h in r.hits for i in range(h.start, h.end)} == hit
        assert {m.item_id for m in r.matches} == found
        assert all(set(range(m.start, m.start + m.n_words)) <= hit for m in r.matches)


def test_longest_match_and_removal(spark):
    item = " ".join(f"t{i}" for i in range(30))
    text = "a b " + " ".join(f"t{i}" for i in range(5, 25)) + " c " + " ".join(f"t{i}" for i in range(12))
    docs = spark.createDataFrame([(1, text, 3), (2, "clean text", 4), (3, None, None)], "doc_id long, text string, hits int")
    tests = spark.createDataFrame([(9, item)], "item_id long, text string")
    first = decontaminate.find_matches(docs, tests).filter("doc_id = 1").first()
    assert [(m.item_id, m.start, m.n_words) for m in first.matches] == [("9", 2, 20)]
    assert [(h.start, h.end) for h in first.hits] == [(2, 22), (23, 35)]
    assert [tuple(r) for r in decontaminate.remove_contaminated(docs, tests).orderBy("doc_id").collect()] == [(2, "clean text", 4), (3, None, None)]
    assert decontaminate.remove_contaminated(docs, tests.filter("false")).count() == 3
    assert decontaminate.find_matches(docs.filter("false"), tests).count() == 0


def test_main_text_cases():
    page = ('<!DOCTYPE html><html><head><title>t</title><script>var x="</p>";</script></head><body><header>h</header><nav><ul><li>m</ul></nav>'
            '<div class="cookie-notice">c</div><article class="post"><h1>A&amp;B</h1><p>one <b>two</b>\n three<br>four<p>five<ul><li>6<li>7</ul><form>f</form>'
            '<div class="share">s</div><article><p>remark</p></article></article><div id="comments"><p>no</p></div><footer>&copy;</footer>')
    assert main_text.main_text(page) == "A&B\none two three four\nfive\n6\n7"
    assert main_text.main_text("<div class=sidebar>x</div>plain &am <p>text") == "plain &am\ntext"
    assert main_text.main_text("<main>a<aside>b</aside>c</main>d") == "a\nc"
    assert main_text.main_text("") == "" and main_text.main_text("<!-- x") == "" and main_text.main_text("a < b") == "a < b"


def test_templates_are_removed(spark):
    rows = [(i, f"https://User@Site.org:8/p{i}", f"<body><div><span>Home News Shop</span></div><div><p>story {i}</p><p>common</p></div></body>") for i in range(8)]
    rows += [(20 + i, "http://site.org/copy", "<body><div>only copy</div></body>") for i in range(5)]  # copies of a page are no template
    rows += [(30, "http://other.org", rows[0][2]), (31, None, rows[0][2]), (32, "http://site.org", None), (33, "http://site.org", "")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, hashes string")
    got = {r.page_id: r.text for r in main_text.extract(pages, least_share=0.2).collect()}
    assert len(got) == len(rows)
    assert all(got[i] == f"story {i}\ncommon" for i in range(8)) and all(got[20 + i] == "only copy" for i in range(5))
    assert got[30] == got[31] == "Home News Shop\nstory 0\ncommon" and got[32] == got[33] == ""
    assert main_text.extract(pages.filter("false")).count() == 0


@pytest.mark.parametrize("tag", ["article", "main"])
def test_boilerplate_inside_the_article_is_removed(spark, tag):
    promo, author = "<div><span>Try our plans</span></div>", "<section><b>Written by the desk</b></section>"
    rows = [(i, f"http://a.org/{i}", f"<{tag}><h1>Title {i}</h1>{promo}<p>story {i}</p><p>All rights reserved</p><table><tr><td>row {i}<td>Total</table>{author}</{tag}>") for i in range(5)]
    same = f"<{tag}><p>one story</p><p>in two parts</p></{tag}>"  # an article under other menus is one page
    rows += [(10 + i, f"http://a.org/s{i}", f"<div>menu {i}</div>{same}") for i in range(4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for prose in (False, True):
        got = {r.page_id: r.text for r in main_text.extract(pages, prose=prose).collect()}
        assert all(got[i] == f"Title {i}\nstory {i}\nAll rights reserved\nrow {i}\nTotal" for i in range(5))
        assert all(got[10 + i] == "one story\nin two parts" for i in range(4))


def test_recurring_content_of_articles_stays(spark):
    """Headings, sentences, cells and list items that many articles of a host share, and a container that stands in another place in each."""
    rows = [(i, f"http://a.org/{i}", f"<article><header><h1>Report</h1></header><p>A common sentence.</p>{f'<p>filler {i}</p>' * i}<div>Figures</div>{f'<p>more {i}</p>' * (9 - i)}"
             f"<ul><li>Yes</li><li>item {i}</li></ul><p>x <math>a+b</math></p></article>") for i in range(6)]
    got = {r.page_id: r.text for r in main_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(6):
        assert got[i] == "\n".join(["Report", "A common sentence.", *[f"filler {i}"] * i, "Figures", *[f"more {i}"] * (9 - i), "Yes", f"item {i}", "x a+b"])


def test_repeated_rows_and_clashing_names(spark):
    rows = [(1, "http://a.org/1", "<p>one", "x"), (1, "http://a.org/1", "<p>one", "y"), (1, None, None, "z"), (None, "http://a.org/2", "", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = main_text.extract(pages, ["page_id", "text"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "x", "one"), (1, "y", "one"), (1, "z", ""), (None, None, "")], key=str) and got.columns == ["page_id", "text_in", "text"]


def test_names_are_matched_whole():
    kept = '<div class="form-factor">1</div><div id="search-methods">2</div><div class="headerless">3</div><div class="main-article">4</div>'
    gone = '<div class="site-nav">a</div><div class="ad-slot wide">b</div><div id="cookieNotice">c</div><div class="related_list">d</div><div class="share">e</div>'
    assert main_text.main_text(f"<article>{kept}{gone}</article>") == "1\n2\n3\n4"
    stories = "<article><h2>One</h2><p>first</p><article><h2>Two</h2><p>second</p></article><article><p>a remark</p></article></article>"
    assert main_text.main_text(stories) == "One\nfirst\nTwo\nsecond"


@pytest.mark.parametrize("page", ["<a " * 350_000, '<a "' * 250_000, '<a "' * 250_000 + ">", "<!" * 500_000, "<article>" + "<div>" * 50_000, "</div" * 200_000, "<p a='\"" * 100_000 + ">x", "<" * 1_000_000])
def test_broken_markup_takes_linear_time(page):
    start = time.process_time()
    root = main_text.parse(page)
    main_text._digest(root)
    main_text.subtrees(root)
    main_text.main_text(page)
    assert time.process_time() - start < 8


class Plain(HTMLParser):
    """Texts of the outermost articles by the standard library's parser: a block ends at any tag but inline ones."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.blocks, self.text = 0, [], ""

    def end_block(self):
        if text := " ".join(self.text.split()):
            self.blocks.append(text)
        self.text = ""

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.text += " "
        elif tag not in ("b", "a", "i", "em", "strong", "span"):
            self.depth += tag == "article"
            if self.depth:
                self.end_block()

    def handle_endtag(self, tag):
        if tag not in ("b", "a", "i", "em", "strong", "span", "br"):
            if self.depth:
                self.end_block()
            self.depth -= tag == "article"

    def handle_data(self, data):
        if self.depth:
            self.text += data


def test_equals_a_plain_parser_on_the_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    got = {r.page_id: r.text for r in main_text.extract(pages).collect()}
    assert got.keys() == html.keys()
    for i, page in html.items():
        plain = Plain()
        plain.feed(page or "")
        assert got[i] == "\n".join(plain.blocks), i


def test_template_of_a_large_host(spark):
    rows = [(i, f"http://big.org/{i}", f"<body>{'<div>Section menu</div>' if i < 3 else ''}{'<div>Twice only</div>' if i < 2 else ''}<div>text {i}</div></body>") for i in range(600)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in main_text.extract(pages).collect()}
    assert all(got[i] == ("Twice only\n" if i < 2 else "") + f"text {i}" for i in range(600))
    hashes = [len(r.hashes) for r in main_text.templates(pages).collect()]
    assert hashes == [1, 1, 1]  # a page gets its own hashes, not its host's


def test_a_page_of_5000_open_divs(spark):
    deep = "<div>" * 5000 + "deep text"
    rows = [(1, "http://a.org/1", deep), (2, "http://a.org/2", "<main>" + deep), (3, "http://a.org/3", deep + "<article>inner"), (4, "http://a.org/4", "<p>flat")]
    got = {r.page_id: r.text for r in main_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), prose=True).collect()}
    assert got == {1: "deep text", 2: "deep text", 3: "inner", 4: "flat"}
