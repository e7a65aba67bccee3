import itertools
import time

import numpy as np
import pytest

from tidemark.llm import main_text
from tidemark.llm.crf import Chain, _marginals, fit
from tidemark.llm.dom import blocks
from tidemark.llm.page_samples import labelled_pages


@pytest.fixture(scope="module")
def model():
    return main_text.default_extractor()


def texts(html):
    return [b.text for b in blocks(html)]


def test_blocks_of_broken_pages():
    assert texts("<p><b>One &amp; two<br><p>three<ul><li>a<li>b &lt;i&gt;</ul>tail") == ["One & two", "three", "a", "b <i>", "tail"]
    assert texts('<script>var t="</p>";if(a<b)</script><style>p{}</style><!-- x <p>y</p> --><p title="a>b">c d</p>') == ["c d"]
    assert texts("<head><title>t</title><p>in body &nbsp; now") == ["in body now"]
    assert texts("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]
    assert texts("a < b <3 &copy; &#233; &unknown; <em>x</em>y <!doctype z><?php q ?>") == ["a < b <3 © é &unknown; xy"]
    assert texts("") == texts("<p>") == texts("<!-- open") == texts("<p class='x") == texts("<script>x") == []
    assert texts("<p>don't <i class=a>stop</i></p><p>won't</p>") == ["don't stop", "won't"]


def test_scanning_is_linear():
    def seconds(html):
        t = time.perf_counter()
        list(blocks(html))
        return time.perf_counter() - t

    for piece in ("<b>", "<div>", "<p>x", "</i>", "<!--", "<", "<a href='", "<td><b>x</td>", "<ul><li>x", "<script>", "&", "<b><div>x</div>", "<a><td></a>"):
        small, large = (min(seconds(piece * n) for _ in range(2)) for n in (2000, 8000))
        assert large < 10 * small + 0.1, piece


def test_viterbi_and_marginals_against_all_labellings():
    rng = np.random.default_rng(4)
    for n in (1, 2, 5, 7):
        scores = rng.normal(0, 1, n)
        chain = Chain(np.zeros(0), rng.normal(0, 1, (2, 2)), rng.normal(0, 1, 2))
        total = {y: chain.first[y[0]] + scores @ np.array(y) + sum(chain.steps[a, b] for a, b in zip(y, y[1:])) for y in itertools.product((0, 1), repeat=n)}
        assert tuple(chain.viterbi(scores.tolist())) == max(total, key=total.get)
        z = sum(np.exp(v) for v in total.values())
        one, edge = _marginals(scores[None], np.ones((1, n), bool), np.array([n]), chain.steps, chain.first)
        assert np.allclose(one[0], [sum(np.exp(v) for y, v in total.items() if y[t]) / z for t in range(n)])
        assert np.isclose(edge.sum(), n - 1)
    assert Chain(np.zeros(0), np.zeros((2, 2)), np.zeros(2)).viterbi([]) == []


def test_training_learns_steps():
    features, labels = [[[0], [1], [1], [0]]] * 20, [[0, 1, 1, 0]] * 20
    chain = fit(features, labels, 2)
    assert chain.viterbi([chain.weights[f[0]] for f in features[0]]) == [0, 1, 1, 0]


def test_held_out_pages(model):
    wrong = total = 0
    for html in labelled_pages(150, seed=77):
        found = list(blocks(html))
        labels = model.chain.viterbi(model.scores(found))
        wrong += sum(a != (b.around.label or 0) for a, b in zip(labels, found))
        total += len(found)
    assert total > 3000 and wrong / total < 0.01


PAGE = """<!DOCTYPE html><html><head><title>T</title></head><body><div class="cookie-banner"><p>We use cookies.</p><button>OK</button></div>
<header><a href="/">Site name</a></header><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><div class="ad">Buy now, cheap.</div>
<article><h1>A long story</h1><p>It began on a cold day &amp; nobody
 knew why, or how it would end.</p><p>Short.</p><p>Then the <a href="/x">river</a> rose, the bridge fell, and all were lost.</p></article>
<aside><h3>Related articles</h3><ul><li><a href="/c">Other story</a></li></ul></aside>
<section class="comments"><h3>2 comments</h3><div class="comment"><p>I did like this story, thank you.</p><a href="/r">Reply</a></div></section>
<form class="newsletter"><label>Your e-mail</label><input><button>Subscribe</button></form><footer>&copy; 2024 Site. All rights reserved.</footer></body></html>"""
WANT = "A long story\nIt began on a cold day & nobody knew why, or how it would end.\nShort.\nThen the river rose, the bridge fell, and all were lost."


def test_a_usual_page(model):
    assert model.extract(PAGE) == WANT
    plain = PAGE.replace("<article>", '<div class="post-content">').replace("</article>", "</div>").replace("<nav>", "<div>").replace("</nav>", "</div>")
    assert model.extract(plain) == WANT


def test_rows_of_any_kind(spark, model):
    rows = [(1, "u", PAGE, 5), (1, "u", PAGE, 6), (None, None, None, None), (3, "v", "", 1), (4, "w", "<article>" + "<p>One sentence, and more.</p>" * 20000 + "</article>", 2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = main_text.extract_main_text(df).collect()
    assert [r.asDict().keys() for r in got][0] == {"page_id": 0, "url": 0, "text": 0, "n_chars": 0}.keys()
    by = sorted(got, key=lambda r: (r.page_id or 0, r.n_chars))
    sentence = len("One sentence, and more.")
    assert [(r.page_id, r.url, r.n_chars) for r in by] == [(None, None, 0), (1, "u", len(WANT)), (1, "u", len(WANT)), (3, "v", 0), (4, "w", 20000 * (sentence + 1) - 1)]
    assert by[1].text == WANT and by[0].text == ""
    assert main_text.extract_main_text(df.limit(0)).count() == 0


def test_pages_of_the_table(spark):
    """The article of each page, read with a pattern that knows how these pages are written."""
    import re
    from html import unescape

    from conftest import SF01
    from tidemark.llm.queries import op13_html_extraction

    html = {r.page_id: r.html for r in spark.read.parquet(f"{SF01}/pages.parquet").collect()}
    wrong = 0
    for r in op13_html_extraction(spark, SF01).collect():
        article = html[r.page_id].split("<article>")[1].split("</article>")[0].replace("<br>", " ")
        parts = [" ".join(unescape(x).split()) for x in re.split(r"</?(?:p|h1)>|<b>", article)]
        wrong += "\n".join(x for x in parts if x) != r.text
    assert wrong <= 1
