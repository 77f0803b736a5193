import itertools
import time
from collections import Counter

import numpy as np
import pytest

from held_out_pages import pages
from tellerbook.llm import extraction
from tellerbook.llm.dom import parse
from tellerbook.llm.extraction import FEATURES, PAIRS, Forest, Model, extract, fit, main_texts
from tellerbook.llm.labelled_pages import PAGES

SCHEMA = "page_id long, url string, html string, text string"


@pytest.fixture(scope="module")
def model(spark):
    return fit(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))


def test_marginals_equal_enumeration():
    random = np.random.default_rng(2)
    model = Model(random.normal(size=FEATURES), random.normal(size=(PAIRS, 2, 2)))
    forest = Forest.of([parse("<div>a<p>b</p><ul><li>c</ul></div><p>d"), parse("x")])
    n = len(forest.parents)
    bounds = np.append(forest.starts, len(forest.features))
    total, ones, joint = 0.0, np.zeros(n), np.zeros((n, 2, 2))
    for labels in itertools.product((0, 1), repeat=n):
        weight = sum(
            model.weights[forest.features[bounds[i] : bounds[i + 1]]].sum() * labels[i] for i in range(n)
        ) + sum(model.pairs[forest.pairs[i], labels[forest.parents[i]], labels[i]] for i in range(n) if forest.parents[i] >= 0)
        weight = np.exp(weight)
        total += weight
        ones += weight * np.array(labels)
        for i in range(n):
            joint[i, labels[forest.parents[i]], labels[i]] += weight
    chance, both = model.beliefs(forest)
    assert np.allclose(chance[:, 1], ones / total)
    inner = forest.parents >= 0
    assert np.allclose(both[inner], joint[inner] / total)


def test_pages_labelled_by_hand_are_learnt(model):
    for page, text in zip(PAGES, main_texts(list(PAGES), model), strict=True):
        tree = parse(page)
        marks = extraction._labels(tree, extraction._hand_mark)
        assert text == "\n".join(t for t, m in zip(tree.texts, marks, strict=True) if t and m)


ARTICLE = "The mill by the lake was built long ago, and the people who live near it still bring their corn there."
LAYOUTS = [
    '<div class="navbar"><a href="/">Home</a><a href="/b">Shop</a></div><div class="content"><h1>The mill</h1><p>{0}</p>'
    '<p>{0}</p></div><div class="sidebar"><p>Join our club today.</p></div>',
    "<header><p>Lake news</p></header><article><h1>The mill</h1><p>{0}<p>{0}</article><footer><p>All rights reserved.</p>"
    "</footer>",
    '<main><section class="post"><h1>The mill</h1><p>{0}</p><p>{0}</p></section><div class="comments"><p>I was there.</p>'
    "</div></main>",
]


@pytest.mark.parametrize("layout", LAYOUTS)
def test_other_layouts(model, layout):
    page = f"<html><head><title>t</title><style>p{{}}</style></head><body>{layout.format(ARTICLE)}</body></html>"
    assert main_texts([page], model) == [f"The mill\n{ARTICLE}\n{ARTICLE}"]


def texts(page):
    return [t for t in parse(page).texts if t]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<p><b>one.<br><p>two &amp; &#233;&hellip;", ["one.", "two & é…"]),
        ("<p>a\n\t b<!-- x <p>y --> c</p>", ["a b c"]),
        ('<script>var t="</p>";</script><p title="a>b">x</p>', ["x"]),
        ("<ul><li>a<li>b</ul></div></p>c", ["a", "b", "c"]),
        ("<head><title>t</title><p>body starts here", ["body starts here"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
        ("<p>5 < 6 and a<b>c</b>d", ["5 < 6 and acd"]),
        ("<style>p{}", []),
        ("plain", ["plain"]),
        ("<SCRIPT>x</SCRIPT ><P>y", ["y"]),
        ("<div>" * 3000 + "deep", ["deep"]),
        ("<textarea>a<p>b</textarea><select><option>c</select>d", ["d"]),
    ],
)
def test_blocks_of_a_page(page, want):
    assert texts(page) == want


def test_tables(spark, model):
    rows = [(1, "u", PAGES[0], "clash"), (1, "u", PAGES[0], "clash"), (2, None, None, "c"), (3, "v", "", "c"), (None, "w", "<p>" * 2, "c")]
    found = extract(spark.createDataFrame(rows, SCHEMA), model).collect()
    assert sorted((r.page_id or 0, r.n_chars > 0, r.text is not None) for r in found) == [
        (0, False, True), (1, True, True), (1, True, True), (2, False, True), (3, False, True),
    ]
    assert all(r.n_chars == len(r.text) for r in found)
    assert extract(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_long_page_is_read_whole(model):
    page = "<article>" + f"<p>{ARTICLE}</p>" * 5000 + "</article>"
    assert main_texts([page], model) == ["\n".join([ARTICLE] * 5000)]


def words(page):
    return [t for t in parse(page).texts if t]


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        ("<p title=O'Brien>one</p><p>don't two</p>", ["one", "don't two"]),
        ('<p class=x">one</p><p>two "three"</p>', ["one", 'two "three"']),
        ('<p title="a > b">one</p>', ["one"]),
        ("<p title='a > b' class=\"c>d\">one</p>", ["one"]),
        ('<p title = "a > b">one</p>', ["one"]),
        ('<p title="never closed>one</p><p>two</p>', ["one", "two"]),
        ('<p "odd">one</p>', ["one"]),
        ('<p>one <svg viewBox="0 0 1 1"/> two</p><p>three</p>', ["one", "two", "three"]),
        ("<p>one <math/>two</p>", ["one", "two"]),
        ("<p>one <svg><path d='x'/><g/></svg> two</p>", ["one", "two"]),
        ("a < b <c> d <", ["a < b", "d <"]),
        ("one<!-- > never closed <p>two", ["one"]),
        ("one <a href=x/>two</a> three", ["one two three"]),
        ("<td>a<td>b<tr>c<li>d<li>e", ["a", "b", "c", "d", "e"]),
        ("<b>one<i>two</b>three</i> four", ["onetwothree four"]),
        ("<p>x<i>y<div>z</i> w</div>", ["xy", "z w"]),
    ],
)
def test_tags_with_odd_quotes(page, texts):
    assert words(page) == texts


ENDLESS = ['<a "', '<a x="', "<a x='>", '<a x=">"', "<p>", "<p><x>", "<b>", "</i>", "<i><div>", "</section>", "<td>", "<!", "<!-", "< ", "=\"'", "<svg/>", "<li><b>"]


@pytest.mark.parametrize("part", ENDLESS)
def test_parsing_is_linear(part):
    """Two megabytes of what used to be read again and again."""
    begun = time.perf_counter()
    parse(part * (2_000_000 // len(part)) + "</i><p>end>")
    mixed = "<i><div>" + "<b>" * 100_000 + part * 200_000
    parse(mixed)
    assert time.perf_counter() - begun < 20


def test_held_out_pages(model):
    """Characters of the main text that are found, and of what is found that are main text."""
    both = right = found = 0
    for (_, text), own in zip(pages(), main_texts([h for h, _ in pages()], model), strict=True):
        wanted, got = Counter(text.split("\n")), Counter(own.split("\n"))
        right += sum(len(line) for line in (wanted & got).elements())
        both += sum(len(line) for line in wanted.elements())
        found += sum(len(line) for line in got.elements())
    recall, precision = right / both, right / found
    print(f"recall {recall:.3f}, precision {precision:.3f}")
    # Measured: 0.885 and 0.985; one layout of ten is lost whole (README).
    assert recall > 0.85 and precision > 0.95
