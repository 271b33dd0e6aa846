import re

import duckdb
import numpy as np
import pandas as pd
import pytest

from rostermart.llm import html_main as h


@pytest.fixture(scope="module")
def sources(sf_dir):
    return [r[0] for r in duckdb.sql(f"SELECT html FROM '{sf_dir.replace('sf0.001', 'sf0.01')}/pages.parquet' ORDER BY page_id").fetchall()]


@pytest.fixture(scope="module")
def trees(sources):
    return h.train(pd.DataFrame({"text": sources[:120]}))


def article(source):
    import html

    inner = re.search(r"<article>(.*?)</article>", source, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", b).replace("<br>", " ")).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(b for b in blocks if b)


def test_articles_of_other_pages(sources, trees):
    assert h.extract(sources[120:], trees) == [article(s) for s in sources[120:]]


def test_layouts_without_article(trees):
    story = "<h1>A title</h1><p>First paragraph of the story, with commas, and words.\n  It\tgoes on.<p>Second one &amp; more &#233;, as <b>it</b> should be, with many words.</p>"
    want = "A title\n\nFirst paragraph of the story, with commas, and words. It goes on.\n\nSecond one & more é, as it should be, with many words."
    around = ['<nav><ul><li><a href="/">Home</a></li><li><a href="/b">About</a></li></ul></nav>', '<div class="cookie-notice"><p>We use cookies on this site.</p></div>',
              "<script>var a = '<p>no</p>';</script><style>p{}</style><!-- <p>no</p> -->"]
    after = ['<section class="comments"><p>A reader says that this story is long, and good.</p></section>', '<aside><p>Read this too.</p></aside>',
             '<form action="/s"><input name=q><p>Sign up for our newsletter</p></form>', '<div class="footer">&copy; 2024 somebody</div>']
    for open_, close in (("<main>", "</main>"), ('<div class="content">', "</div>"), ('<article class="post">', "</article>")):
        page = f"<!DOCTYPE html><html><head><title>T</title></head><body>{''.join(around)}{open_}{story}{close}{''.join(after)}</body></html>"
        assert h.extract([page], trees) == [want]


@pytest.mark.parametrize("source, text", [
    ("", ""), ("plain &lt;text", "plain <text"), ("<p>a<p>b", "a\n\nb"), ("a<br>b", "a b"), ("<b>x<i>y</b>z", "xyz"), ("<li>a<li>b", "a\n\nb"),
    ("x < y", "x < y"), ("<div>a<span>b</span>c</div>d", "abc\n\nd"), ("<script>x", ""), ("a</p></div>b", "a\n\nb"), ("<p title='a>b'>c</p>", "c"), ("<!-- a", ""),
    ("<table><tr><td>1<td>2</table>", "1\n\n2"), ("<head><title>no</title></head>yes", "yes"), ("a<", "a<"), ("<p", "<p")])
def test_blocks(source, text):
    assert h.extract([source], None) == [text]


@pytest.mark.parametrize("tag", ["button", "svg", "select", "template", "BUTTON"])
def test_letters_that_grow_in_lower_case(tag):
    dots = "\u0130" * 40
    source = f"<p>{dots}</p><p>a<{tag}>x</{tag.lower()}> kept text, all of it</p><p>next</p>"
    assert h.extract([source], None) == [f"{dots}\n\na kept text, all of it\n\nnext"]


@pytest.mark.parametrize("source, text", [
    ("<p>So <math><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup></math> holds</p>", "So E=mc2 holds"),
    ("<p>a <math><semantics><mi>x</mi><annotation encoding=t>\\x</annotation></semantics></math>, b</p>", "a x \\x, b"),
    ("<p>a <math><mtable><mtr><mtd>1</mtd><mtd>2</mtd></mtr></mtable></math></p>", "a 1 2"),
    ("<p>see <object data=f><param name=n>the text instead</object> here</p>", "see the text instead here"),
    ("<p>a</p><object><p>b</p></object><canvas>c</canvas><button>no</button>", "a\n\nb\n\nc"), ("<p>a <svg><text>no</text></svg>b", "a b")])
def test_formulas_and_texts_of_objects(source, text):
    assert h.extract([source], None) == [text]


def test_a_head_ends_at_its_own_tag():
    assert h.extract(["<head><title>no</title></head><header>a</header>b"], None) == ["a\n\nb"]
    assert h.extract(["<head><header>a</header>b"], None) == ["a\n\nb"]


def test_nothing_is_kept_inside_something_dropped():
    page = h.parse("<div><p>a</p><div><p>b</p></div></div>")
    assert page.tags == ["body", "div", "p", "div", "p"]
    for odds in ([50, -3, 2, -1, 2], [50, -5, 2, 1, 1], [50, 1, -1, -3, 2.5], [50, -9, 9, -9, 9]):
        kept = h.decode(page, [float(o) for o in odds])
        best = max((sum(-np.log1p(np.exp(-o if k else o)) for o, k in zip(odds, [True, *c], strict=True)), [True, *c])
                   for n in range(16) for c in [[bool(n >> i & 1) for i in range(4)]]
                   if all([True, *c][page.parents[i]] or not [True, *c][i] for i in range(1, 5)))
        assert kept == best[1]


def test_trees_learn_a_rule():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.4)).astype(float)
    trees = h.boost(x[:2000], y[:2000])
    assert ((trees.log_odds(x[2000:]) > 0) == y[2000:]).mean() > 0.95


def test_pages_of_a_table(spark, sources):
    rows = [(i, f"http://u/{i}", s, "t", 1) for i, s in enumerate(sources[:60])] + [(None, None, None, None, None), (60, "u", "", "", 0), (0, "again", sources[0], "", 2)]
    rows.append((61, "long", "<article>" + "<p>some words, here.</p>" * 4000 + "</article>", "", 3))
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int").repartition(3)
    got = h.main_texts(table).collect()
    assert sorted((str(r.page_id), str(r.url), r.text) for r in got) == sorted(
        (str(i), str(u), article(s) if s and i != 61 else "\n\n".join(["some words, here."] * 4000) if s else "") for i, u, s, _, _ in rows)
    assert all(r.n_chars == len(r.text) for r in got)
    assert h.main_texts(table.limit(0)).count() == 0


@pytest.mark.parametrize("piece", ["<a title='x", "<a title='x\"", "<option>x", "<!x", "<b", "<p class=\"a'>", "<a b='>' c=\"", "<select><p>t"])
def test_long_broken_markup_takes_time_in_proportion(piece):
    import time

    page = "<article><p>before</p>" + piece * (1_000_000 // len(piece))
    start = time.monotonic()
    found = h.parse(page)
    assert time.monotonic() - start < 10 and found.runs[0][1] == "before"


def test_tags_end_outside_quotes():
    found = h.parse("<p title='a > b' class=x>one<b t=\">\">two</b> 3 < 4 <a href='x>three</p><p>it's</p>")
    assert "".join(t for _, t, _ in found.runs).replace("<", "|") == "onetwo 3 | 4 "
    lost = h.parse("<p>one <i a='b>two")
    assert "".join(t for _, t, _ in lost.runs) == "one <i a='b>two"
