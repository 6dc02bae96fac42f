from itertools import product
from math import exp

import numpy as np
import pytest

from llm_compare import as_bag
from pulsegrid.llm import html_tree as H


PAGE = (
    "<body><nav><ul><li><a href='/'>Go</a></li><li><a href='/x'>On</a></li></ul></nav><div class='ad'>Buy {0}</div><article>"
    "<h1>T{0}</h1><p>Body &amp; text {0}.</p><p>More {0}.</p><p>End.</p></article><footer>(c) {0}</footer></body>"
)


@pytest.fixture(scope="module")
def model(spark):
    rows = [(p, H.marked_text(p)) for p in (PAGE.format(i) for i in range(200))]
    return H.train(spark.createDataFrame(rows, "html string, main string"))


def texts(source):
    return [t for t in H.parse(source).text if t is not None]


@pytest.mark.parametrize("source, blocks", [
    ("", []), ("plain", ["plain"]), ("<p>a<p>b", ["a", "b"]), ("<p>a <b>b<br>c</b>\n d</p>e", ["a b c d", "e"]),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
    ("<div>x<p>y</div>z", ["x", "y", "z"]),
    ("a<!-- <p>no</p> -->b<!-- never closed <p>c", ["ab"]),
    ("<script>var t='</p><p>x';</script>a<style>b</style><title>t</title>", ["a"]),
    ("<script>never closed <p>a", []),
    ("<p title='a>b' x=\"</p>\">c", ["c"]), ("<p title='open>a</p><p>b", ["a", "b"]),
    ("a &amp;&lt;b&gt; &#233; &nope; &amp", ["a &<b> é &nope; &"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
    ("a < b <3 c", ["a < b <3 c"]), ("cut <a href='x", ["cut"]), ("</p></div>a", ["a"]),
    ("<P>A</P><DIV>B</DIV>", ["A", "B"]), ("<select><option>x</select>y<noscript>z</noscript>", ["y"]),
])
def test_blocks(source, blocks):
    assert texts(source) == blocks


@pytest.mark.parametrize("source, blocks", [
    ("<html><head><title>x</title><body><article><p>a</article></html>", ["a"]),
    ("<html><head><meta charset='utf-8'>\n<title>x</title>\n<article>a</article>", ["a"]),
    ("<head><title>x</title>\n a <b>b</b>", ["a b"]), ("<head><title>x</title><img src='i'>a", ["a"]),
    ("<head><noscript><img src='i'></noscript><title>x</title><script>s</script><p>a", ["a"]),
    ("<head><noscript><link><body><p>a", ["a"]), ("<head><head><p>a", ["a"]), ("<head><textarea>x</textarea>a", ["a"]),
    ("<head><template><p>x</p></template></head><p>a", ["a"]), ("<head><template><body>x</template></head><p>a", ["a"]),
    ("<head><noscript>x</noscript></head>a<noscript>y</noscript>", ["a"]),
    ("<div>a <svg class='i'/> b</div>", ["a b"]), ("<p>a<svg/>b<p>c", ["ab", "c"]),
    ("<p>a<svg><title/><g><path d='M0'/></g><text>x</text></svg>b", ["ab"]),
    ("<p>a<svg><g/><style/><text>x</text></svg>b<math><mi/></math>c", ["abc"]),
    ("<div/>a</div>b", ["a", "b"]), ("<p>a<canvas/>x</canvas>b", ["ab"]),
])
def test_blocks_behind_open_heads_and_closed_svg(source, blocks):
    assert texts(source) == blocks


def test_main_text_without_end_of_head(model):
    page = "<html><head><title>x</title>" + PAGE.format(7) + "</html>"
    assert model.main_text(page) == "T7\nBody & text 7.\nMore 7.\nEnd."


def test_layouts_are_told_apart(model):
    for source, main in H.TEMPLATES:
        assert model.main_text(source) == main


def test_a_layout_that_was_not_trained(model):
    source = (
        "<html><body><div id='nav'><ul><li><a href='/'>Start</a></li><li><a href='/x'>Else</a></li></ul></div>"
        "<div class='advert'>Buy</div><article><h1>Head</h1><p>Text.</p><p>And more text.</p></article>"
        "<div class='comments'><div class='comment'><p>Nice text.</p></div></div><footer>(c)</footer></body></html>"
    )
    assert model.main_text(source) == "Head\nText.\nAnd more text."


def test_marginals_equal_the_sum_over_all_states(model):
    page = H.parse("<body><nav><a href='/'>x</a></nav><article><p>Some text</p></article></body>")
    n = len(page.parent)
    total, content = 0.0, [0.0] * n
    for states in product(range(3), repeat=n):
        weight = 1.0
        for i, s in enumerate(states):
            weight *= exp(sum(model.unary[f][s] for f in H._features(page, i)))
            if i:
                weight *= model.edge[page.text[i] is not None][3 * states[page.parent[i]] + s]
        total += weight
        for i, s in enumerate(states):
            content[i] += weight * (s == H.CONTENT)
    assert np.allclose(model.marginals(page), np.array(content) / total)


def test_deep_and_wide_pages(model):
    assert len(model.marginals(H.parse("<div>" * 5000 + "x"))) == 5002
    wide = "<article>" + "<p>a b.</p>" * 20000 + "</article>"
    assert model.main_text(wide).count("\n") == 19999
    assert model.main_text("<a" * 100_000 + ">") == ""


def test_every_page(spark):
    rows = [(i, f"u{i}", PAGE.format(i), "x", 0) for i in range(40)]
    rows += [(100, None, None, "x", 0), (None, "u", "", "x", 0), rows[0]]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, main int")
    got = H.main_texts(pages).collect()
    want = [(i, u, f"T{i}\nBody & text {i}.\nMore {i}.\nEnd." if h else "") for i, u, h, _, _ in rows]
    assert as_bag(got) == as_bag(want)


def test_trained_on_given_labels(spark):
    """Pages whose markup names mean nothing: only the labels tell the parts apart."""
    page = "<body><div class='qq'><p>{0} menu</p></div><div class='zz'><p>{0} story</p></div></body>"
    labelled = spark.createDataFrame([(page.format(i), f"{i} story") for i in range(300)], "html string, main string")
    pages = spark.createDataFrame([(1, "u", page.format("new"))], "page_id long, url string, html string")
    assert H.main_texts(pages, labelled).first().text == "new story"


def test_empty_table(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert H.main_texts(none).collect() == []
