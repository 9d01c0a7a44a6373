"""Message passing against all labellings, extraction against the pages' own articles and hand-written layouts."""

import html
import math
import re
import time
from itertools import product

import pytest

from reviewlake.llm import pages
from reviewlake.llm.labelled_pages import FILLERS, LAYOUTS


@pytest.fixture(scope="module")
def model():
    return pages.Model(pages.layout_counts())


def test_marginals_are_exact(model):
    nodes, _ = pages.parse("<body><div class=nav><ul><li>a<li>b</ul></div><div id=main><p>One two.<p>Three</div><form><p>x</form></body>")
    assert len(nodes) == 11
    total, ones = 0.0, [0.0] * len(nodes)
    for labels in product((0, 1), repeat=len(nodes)):
        weight = math.exp(model.root[labels[0]])
        for at, node in enumerate(nodes):
            weight *= math.exp(sum(model.evidence[name][labels[at]] for name in pages.features(node) if name in model.evidence))
            if at:
                weight *= math.exp(model.edges[pages.group(node)][labels[node.parent]][labels[at]])
        total += weight
        ones = [one + weight * label for one, label in zip(ones, labels)]
    assert model.marginals(nodes) == pytest.approx([one / total for one in ones])


def test_articles(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for row in pages.extract(table, pages.train(table)).collect():
        article = row.html[row.html.index("<article>") + 9:row.html.index("</article>")]
        blocks = [" ".join(html.unescape(re.sub("<br>", " ", re.sub("</?b>", "", block))).split())
                  for block in re.split("</?(?:p|h1)>", article)]
        assert row.text == "\n".join(block for block in blocks if block) and row.n_chars == len(row.text)


@pytest.mark.parametrize("layout", range(len(LAYOUTS)))
def test_layouts(model, layout):
    for s, m, l in zip(FILLERS["s"], FILLERS["m"], FILLERS["l"]):
        nodes, texts = pages.parse(LAYOUTS[layout].replace("{s}", s).replace("{m}", m).replace("{l}", l))
        labels, chance = pages.marked_labels(nodes), model.marginals(nodes)
        wrong = [text for node, text in texts if (chance[node] >= 0.5) != labels[node]]
        assert len(wrong) <= len(texts) // 6, wrong


def test_unseen_layouts(model):
    shell = "<html><body><header><p>Site title</p></header><nav><a href=/>Home</a></nav>{}<footer>All rights reserved.</footer></body></html>"
    story = "<h1>A title</h1><p>First paragraph of the story, long enough to say something.</p><p>Second one &amp; last.</p>"
    want = "A title\nFirst paragraph of the story, long enough to say something.\nSecond one & last."
    for body in (f"<article>{story}</article>", f"<main>{story}</main>", f'<div class="post">{story}</div>', f'<div id="content"><div>{story}</div></div>',
                 f"<article>{story}<aside><p>Buy this.</p></aside></article>", f'<article>{story}</article><div class="sidebar"><p>Other things here.</p></div>',
                 f'<article>{story}</article><section class="comments"><p>I do not agree with this at all, sorry to say.</p></section>',
                 f'<div class="cookie-notice">We use cookies.</div><main>{story}</main>', f"<main>{story}</main><form>Your name</form>"):
        assert pages.main_text(shell.format(body), model)[0] == want, body


def test_markup():
    parse = lambda source: [text for _, text in pages.parse(source)[1]]
    assert parse("a<br>b &lt;i&gt; &#233;&nbsp;c") == ["a b <i> é c"]
    assert parse("<p>one<p>two</p>three<script>if (a<b) '</p>'</script> four<style>x</style><!-- no --> five") == ["one", "two", "three four five"]
    assert parse("<div title='a>b'>x < y</div><textarea>t</textarea><b>c<p>d</b>e") == ["x < y", "c", "de"]
    assert parse("") == [] and parse("<") == ["<"] and parse("<!-- open") == [] and parse("<p") == []
    assert parse("<ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>d<td>e<tr><td>f</table>") == list("abcdef")


def test_frames(spark, model):
    rows = [(1, None, "x"), (2, "", "x"), (2, "", "x"), (None, "<article><p>" + "Word. " * 100_000, "x")]
    got = pages.extract(spark.createDataFrame(rows, "page_id long, html string, Text string"), model).collect()
    assert [row.n_chars for row in got] == [0, 0, 0, 599_999]
    empty = spark.createDataFrame([], "page_id long, html string")
    assert pages.extract(empty, pages.train(empty)).count() == 0


def test_training_passes_over_null_pages(spark):
    rows = [(at, f"<body><article><p>Story {at} is told here.</p></article><footer>All rights reserved.</footer></body>") for at in range(40)]
    table = spark.createDataFrame([*rows, (40, None), (41, None)], "page_id long, html string")
    got = {row.page_id: row.text for row in pages.extract(table, pages.train(table)).collect()}
    assert got == {**{at: f"Story {at} is told here." for at in range(40)}, 40: "", 41: ""}


def test_omitted_end_tags_hide_no_text():
    parse = lambda source: [text for _, text in pages.parse(source)[1]]
    assert parse("<html><head><title>t</title><meta name=a><link rel=b><body><p>one<p>two") == ["one", "two"]
    assert parse("<head><title>t</title><style>x</style><article><p>one</article>") == ["one"]
    assert parse("<head> <title>t</title> plain <b>text</b>") == ["plain text"] and parse("<head><meta name=a></head><p>a<head>b") == ["ab"]
    assert parse("<p>a <button>go<p>b</p><article>c</article>") == ["a", "b", "c"]
    assert parse("<div><svg><path d=x><p>a</p>b</div><svg><text>x</text></svg>c") == ["a", "b", "c"]
    assert parse("<div><select><option>x<option>y<p>a</div>b") == ["a", "b"] and parse("a<button>x<div>y</div></button>b") == ["a", "b"]
    assert parse("<button>x <button>y</button> a <video><p>b <!-- </video> --><script>'</video>'</script>") == ["a", "b"]
    assert parse("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds") == ["so x=1 holds"]


def test_articles_of_pages_without_head_end(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").where("html is not null")
    model = pages.train(table)
    for row in table.collect():
        want = pages.main_text(row.html, model)[0]
        assert want and pages.main_text(row.html.replace("</head>", "<meta name=a>"), model)[0] == want


@pytest.mark.parametrize("part", ["<div>", "<a '", '<a x="', "<p>", "<li>", "<td>", "<span>", "<head>", "<svg>", "<div><span></b></i>", "<select><option>", "<a x ", "</p>"])
def test_pages_of_many_odd_tags_take_linear_time(part):
    began = time.monotonic()
    pages.parse(part * 50_000 + '"')
    assert time.monotonic() - began < 4


def test_unclosed_tags_and_stray_quotes_are_no_text():
    parse = lambda source: [text for _, text in pages.parse(source)[1]]
    assert parse('<p>one<p title="a>two</p>') == ["one"]
    assert parse("<p a='>'>x</p>") == ["x"] and parse('<p>a<b "c>d</b></p>') == ["ad"]
    assert parse('<a href=x"y>z</a>') == ["z"] and parse("<p title='a' b'>x") == ["x"] and parse("<p x = 'a>b' y>c<p z=>d") == ["c", "d"]
