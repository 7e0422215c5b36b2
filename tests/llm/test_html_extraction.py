"""HTML extraction: blocks against written examples, gradients against differences, held-out layouts and pages."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolith.llm import html_extraction as hx
from aerolith.llm.html_blocks import NUMBERS, WIDTH, blocks

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pages(spark):
    return [r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id").collect()]


@pytest.fixture(scope="module")
def model(pages):
    return hx.train(pages[:100])


@pytest.mark.parametrize(("page", "texts"), [
    ("", []), ("   ", []), ("plain text", ["plain text"]),
    ("<p>a<b>b</b> c&nbsp;&amp;amp;  <br>d<p>e", ["ab c &amp; d", "e"]),
    ("<ul><li>one<li>two<ul><li>in</ul>after</ul>", ["one", "two", "in", "after"]),
    ("<table><tr><td>1<td>2<tr><th>3</table>", ["1", "2", "3"]),
    ('<script>var x="</p>";</script><style>p{}</style>x<noscript><p>no</p></noscript>y', ["x", "y"]),
    ("<!-- <p>no --><![CDATA[no]]><P CLASS='a>b'>q < 3 &#38; &lt;z&gt;</P></div></p>", ["q < 3 & <z>"]),
    ("<title>t<p>x</title><p>in a head</head><body>b", ["in a head", "b"]),
    ("<p>unclosed <i>tag <a href='x", ["unclosed tag"]), ("<div>a<div>b</div>c</div>d", ["a", "b", "c", "d"]),
])
def test_blocks(page, texts):
    assert [x.text for x in blocks(page)] == texts


def test_deep_and_unclosed_markup_is_linear():
    assert len(blocks("<div>x" * 20_000)) == 20_000
    assert len(blocks("<li>x</b></section>" * 20_000)) == 20_000
    assert [x.text for x in blocks('<a title="' * 5_000)] == []


def test_weak_labels():
    page = '<nav>n</nav><article><header><h1>t</h1></header><p>a</p><div class="ad">x</div><form>f</form></article><footer>z</footer>'
    leaves = blocks(page)
    assert [x.text for x, y in zip(leaves, hx.weak_labels(leaves)) if y] == ["a"] or [x.text for x, y in zip(leaves, hx.weak_labels(leaves)) if y] == ["t", "a"]
    assert hx.weak_labels(blocks("<div>a</div>")) is None


def test_gradients():
    rng = np.random.default_rng(1)
    net = hx.Labeller(3, cells=3)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    x = rng.random((5, 2, WIDTH))
    live = np.array([[1, 1], [1, 1], [1, 1], [1, 0], [1, 0]], float)
    y = rng.integers(0, 2, (5, 2)) * live

    def loss():
        z = net.scores(x, live)
        return float(((np.log1p(np.exp(z)) - y * z) * live).sum() / live.sum())

    grads = net.gradients(x, live, y)
    for k, v in net.w.items():
        for i in rng.integers(0, v.size, 8):
            old, step = v.flat[i], 1e-4
            v.flat[i] = old + step
            up = loss()
            v.flat[i] = old - step
            assert (up - loss()) / (2 * step) == pytest.approx(grads[k].flat[i], abs=1e-3), k
            v.flat[i] = old


def test_held_out_pages(pages, model):
    """Pages that the model has not seen, with their semantic elements."""
    for page, text in zip(pages[150:], hx.extract(model, pages[150:])):
        leaves = blocks(page)
        assert text == "\n\n".join(x.text for x, y in zip(leaves, hx.weak_labels(leaves)) if y)


def test_held_out_layouts(pages, model):
    """Made pages, mostly without semantic elements, of texts that the model has not seen."""
    rng = random.Random(77)
    long = [x.text for p in pages[150:] for x in blocks(p) if x.at.name == "p"]
    short = [x.text for p in pages[150:] for x in blocks(p) if x.at.name in ("li", "div")]
    made = [hx.layout(rng, long, short) for _ in range(200)]
    got = hx.label(model, [blocks(p) for p, _ in made])
    right = sum(int((g == np.array(y, bool)).sum()) for g, (_, y) in zip(got, made))
    assert right > 0.98 * sum(len(y) for _, y in made)


def test_names_alone_are_not_needed(pages, model):
    """A page of bare ``div`` elements: menu, headline, paragraphs, comments."""
    text = [x.text for p in pages[150:160] for x in blocks(p) if x.at.name == "p" and len(x.text) > 200][:6]
    page = ("<html><body><div class=topnav><a href=/>Home</a></div><div class=topnav><a href=/n>News</a></div><div class='content'><h1>" + text[0][:60] + "</h1>"
            + "".join(f"<p>{t}</p>" for t in text) + "</div><div class='comments'><p>" + text[1] + "</p></div><div class=footer>&copy; 2024</div>")
    assert hx.extract(model, [page])[0] == "\n\n".join([text[0][:60].strip(), *text])


def test_long_pages_are_read_whole(pages, model, monkeypatch):
    page = [blocks(pages[0]) * 40]
    whole = hx.label(model, page)[0]
    monkeypatch.setattr(hx, "AT_ONCE", 64)
    assert (hx.label(model, page)[0] == whole).all()


def test_rows(spark, model, pages):
    rows = [(1, "u", pages[0]), (1, "u", pages[0]), (2, None, None), (None, "v", ""), (3, "w", "<nav>a</nav>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for c in ("text", "n_chars", "batch", "x", "y"):
        df = df.withColumn(c, F.lit(1))
    got = sorted((tuple(r) for r in hx.extracted(df, model).collect()), key=str)
    text = hx.extract(model, [pages[0]])[0]
    assert text and got == sorted([(1, "u", text, len(text))] * 2 + [(2, None, "", 0), (None, "v", "", 0), (3, "w", "", 0)], key=str)
    assert hx.extracted(df.where("false"), model).count() == 0


def test_learns_without_pages():
    """No page, or none that says what its main text is, still gives a model."""
    assert hx.extract(hx.train([], layouts=4), [""]) == [""]
    assert NUMBERS < WIDTH
