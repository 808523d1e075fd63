"""Toxicity (operator 4) by held-out accuracy; HTML extraction (operator 2) by known pages."""

import random
import time
import zlib

import pytest
from helpers import no_docs, odd_docs, odd_rows, prose, with_clashes
from pyspark.sql import functions as F

from lapline.llm import html_text, toxicity
from lapline.llm.labelled_pages import labelled_pages

BAD = ("rotter", "swineling", "dunce", "vermin", "grubby")


def _corpus(spark, n=900):
    rng, docs, labels = random.Random(2), [], []
    for i in range(n):
        text, toxic = prose(i, 60), rng.random() < 0.15
        if toxic:
            w = text.split()
            for _ in range(4):
                w.insert(rng.randrange(len(w)), rng.choice(BAD) + rng.choice(("", ",", "s")))
            text = " ".join(w)
        docs.append((i, text))
        if rng.random() < 0.6:
            labels.append((i, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = _corpus(spark)
    scored = toxicity.score(docs, toxicity.fit(docs, labels)).join(labels, "doc_id").withColumn("out", toxicity.held_out(F.col("doc_id"))).collect()
    out = [r for r in scored if r["out"]]
    assert {r["doc_id"] for r in out} == {r["doc_id"] for r in scored if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0}
    right = sum(r["predicted"] == r["toxic"] for r in out)
    caught = sum(r["predicted"] for r in out if r["toxic"])
    assert right >= 0.95 * len(out) and caught >= 0.8 * sum(r["toxic"] for r in out)


def test_held_out_labels_do_not_matter(spark):
    docs, labels = _corpus(spark, 300)
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.fit(docs, x) for x in (labels, turned))
    assert (a[0] == b[0]).all() and a[1] == b[1]


def test_risk_correction_needs_only_positives(spark):
    """Labels other than 1 give the prior alone: with it set, they may be missing."""
    docs, labels = _corpus(spark)
    w, bias = toxicity.fit(docs, labels.filter("toxic = 1"), prior=0.15)
    scored = toxicity.score(docs, (w, bias)).join(labels, "doc_id").collect()
    assert sum(r["predicted"] == r["toxic"] for r in scored) >= 0.93 * len(scored)


def test_odd_rows_have_scores(spark):
    docs, labels = _corpus(spark, 300)
    model = toxicity.fit(docs, labels)
    got = toxicity.score(with_clashes(odd_docs(spark)), model).collect()
    assert len(got) == len(odd_rows()) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert toxicity.score(no_docs(spark), model).count() == 0
    for none in (labels.filter("false"), labels.withColumn("toxic", F.lit(None).cast("int"))):
        w, bias = toxicity.fit(docs, none)
        assert not w.any() and bias < 0
    assert not toxicity.fit(no_docs(spark), labels)[0].any()


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>if (a<b) document.write("<p>no</p>")</script></head>
<body><div class="cookie-notice"><p>We use cookies, accept them.</p><button>Accept</button></div>
<nav><ul><li><a href="/">Home</a><li><a href="/x">News</a></ul></nav><header><h2>The Site</h2></header><!-- <p>hidden</p> -->
<article><h1>Caf&eacute; &amp; more</h1><p>First   paragraph of the
story, with <em>marks</em> and a <a href="#">link</a>; it goes on.<p><b>Second one, unclosed.<br>After the break &#8211; still here.
<div class="ad-slot">Buy shoes now, cheap and fast.</div><p>Third paragraph &lt;ends&gt; the tale here.</p></article>
<aside class="sidebar"><h3>Most read</h3><ul><li><a href="/1">Other story</a></li><li><a href="/2">Next story</a></li></ul></aside>
<section class="comments"><h3>Comments</h3><div class="comment"><p>I do not like this story, says a reader.</p></div></section>
<form action="/s"><label>Mail</label><input name="m"><button>Send</button></form><footer>&copy; 2020 The Site</footer></body></html>"""


def test_a_known_page():
    blocks = html_text.main_blocks(PAGE, html_text.default_labeller())
    assert blocks == ["Café & more", "First paragraph of the story, with marks and a link; it goes on.", "Second one, unclosed. After the break – still here.",
                      "Third paragraph <ends> the tale here."]


def test_held_out_pages():
    labeller, wrong, total = html_text.default_labeller(), 0, 0
    for page, labels in labelled_pages(200, seed=1234):
        blocks = html_text.leaf_blocks(page)
        assert len(blocks) == len(labels)
        wrong += sum(a != b for a, b in zip(labeller.decode(html_text.page_features(blocks)), labels))
        total += len(labels)
    assert wrong <= 0.015 * total


def test_viterbi_is_the_best_path():
    import itertools

    labeller = html_text.default_labeller()
    for page, labels in labelled_pages(30, seed=5):
        features = html_text.page_features(html_text.leaf_blocks(page))[:9]
        s = [sum(labeller.weights.get(n, 0.0) for n in names) for names in features]

        def value(y):
            return labeller.first[y[0]] + sum(a for a, k in zip(s, y) if k) + sum(labeller.step[a][b] for a, b in zip(y, y[1:]))

        if features:
            best = max(value(y) for y in itertools.product((0, 1), repeat=len(features)))
            assert value(labeller.decode(features)) == pytest.approx(best)


def test_labels_by_chain_are_those_of_all_features():
    labeller = html_text.default_labeller()
    for page, _ in labelled_pages(60, seed=77):
        blocks = html_text.leaf_blocks(page)
        features = html_text.page_features(blocks)
        assert all(len(names) == len(set(names)) for names in features)
        assert labeller.label(blocks) == labeller.decode(features)


@pytest.mark.parametrize("page, want", [
    ("<div><p>a<p>b<div>c</div>d</div>", [("a", "div p"), ("b", "div p"), ("c", "div div"), ("d", "div")]),
    ("<ul><li>a<ul><li>b<li>c</ul>d<li>e</ul>", [("a", "ul li"), ("b", "ul li ul li"), ("c", "ul li ul li"), ("d", "ul li"), ("e", "ul li")]),
    ("<table><tr><td>a<td>b<tr><td>c</table>d", [("a", "table tr td"), ("b", "table tr td"), ("c", "table tr td"), ("d", "")]),
    ("<a><div>x</a>y</div>z", [("xy", "a div"), ("z", "a")]),
    ("<div><b>x</div></b></i>y", [("x", "div b"), ("y", "")]),
    ("<p>a<button>b</button>c</section>d", [("a", "p"), ("b", "p button"), ("c", "p"), ("d", "p")])])
def test_what_tags_close(page, want):
    def path(element):
        return path(element.above) + [element.tag] if element.above else []
    assert [(text, " ".join(path(element))) for text, element, _ in html_text.leaf_blocks(page)] == want


@pytest.mark.parametrize("unit", ["<div>", "<div>x", "<div class=a-{}>x", "<b>", "<b><p>x", "<p>x</i></section>", "<ul><li>x", "<a>x</b>", "<i><div></i>x"])
def test_deep_pages_take_time_in_proportion(unit):
    labeller = html_text.default_labeller()
    page = "".join(unit.replace("{}", "".join(chr(97 + int(d)) for d in str(i))) for i in range(40_000))
    began = time.process_time()
    html_text.main_blocks(page, labeller)
    assert time.process_time() - began < 12


@pytest.mark.parametrize("page", [None, "", " ", "plain text", "<", "<<<p", "<p", "</p></div>", "<script>x", "<!-- open", "<p title='a>b", "a < b & c &amp &unknown; &#0; &#xD800;",
                                  "<div " * 3000, "<p>" * 3000 + "x", '<a href="' * 2000, "<b><p></b>x</p>", "\x00<p>\x00</p>"])
def test_broken_pages(page):
    blocks = html_text.main_blocks(page, html_text.default_labeller())
    assert all(b and b == " ".join(b.split()) for b in blocks) or blocks == []


@pytest.mark.parametrize("mark", ['<svg class="i"/>', "<svg/>", "<SVG viewBox='0 0 1 1' />", "<svg a=b/>no</svg>", "<svg><text>no</text></svg>", "<svg-icon></svg-icon>",
                                  "<template-part>", "<style-guide/>", "<title-bar x='1'></title-bar>", "<script>no</script/>", "<style>no</style x>",
                                  "<!-- no --!>", "<!-->", "<!--->", "<!-- no -->"])
def test_text_after_raw_marks_is_read(mark):
    blocks = [b[0] for b in html_text.leaf_blocks(f"<article><h1>T</h1>{mark}<p>one two.</p>{mark}<p>three four.</p></article>")]
    assert blocks == ["T", "one two.", "three four."]


LONG = "x" * 50_000


@pytest.mark.parametrize("mark", [f'<script data-x="{LONG}">no()</script>', f"<div data-x='{LONG}<b>no</b>'></div>", f'<img src="data:{LONG}>">', f'<svg d="{LONG}>"/>',
                                  f'<a title="5" q">one</a> two.<p>{LONG} "</p>'])
def test_long_quoted_values(mark):
    blocks = [b[0] for b in html_text.leaf_blocks(f"<p>{mark}</p><p>three four.</p>")]
    assert blocks == (["one two.", f'{LONG} "'] if "one" in mark else []) + ["three four."]


@pytest.mark.parametrize("unit", ["<x\" ' =\"", "<x '\"", "<svg =\"", "<script ='", '<a href="', "<a =", "<!-", "</a b='"])
@pytest.mark.parametrize("end", ["", "\" <", "' \" <p>"])
def test_broken_quotes_take_time_in_proportion(unit, end):
    began = time.process_time()
    html_text.leaf_blocks(unit * (400_000 // len(unit)) + end)
    assert time.process_time() - began < 15


def test_extract_keeps_every_row(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", ""), (3, "w", "<p>" + "word " * 200_000 + "</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("text", "blocks", "row")})
    got = html_text.extract(pages, keep=["page_id", "url"]).collect()
    assert len(got) == 5 and sorted(len(r["text"]) for r in got if r["page_id"] in (2, None)) == [0, 0]
    assert len({r["text"] for r in got if r["page_id"] == 1}) == 1
    assert html_text.extract(pages.limit(0)).count() == 0
