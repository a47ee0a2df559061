import html
import re

import pytest
from llm_tools import SF
from tidemark.llm import html_blocks


@pytest.fixture(scope="module")
def net(spark):
    return html_blocks.fit(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def article(page):
    """Blocks of the article element, by plain splitting; enough for the given pages."""
    body = re.search(r"<article>(.*?)(</article>|<footer|$)", page, re.S)[1]
    parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1|div)[^>]*>", body))
    return "\n".join(p for p in parts if p)


def test_main_text_of_pages_not_trained_on(spark, net):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").where("page_id >= 2000")
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    rows = html_blocks.extract(pages, net).collect()
    assert len(rows) == len(source)
    right = sum(r["text"] == article(source[r["page_id"]]) for r in rows)
    assert right >= 0.99 * len(rows) and all(r["n_chars"] == len(r["text"]) for r in rows)


def test_containers_of_other_names(net):
    page = """<html><head><title>T</title></head><body><header><h1>Site</h1></header><div class="menu"><ul><li><a href=x>Home</a></ul></div>
    <main><h2>Title &amp; more</h2><p>First paragraph of the text,\n it is long enough.<aside class="related"><p>Read also this.</p></aside>
    <p>Second <i>paragraph</i>, with markup.</p><div class="comments"><p>A reader said so.</p></div></main>
    <div id="sidebar"><p>Popular now: a list.</p></div><div class="cookie-notice">We use cookies.</div>
    <form><label>Name</label><input><p>Subscribe to our letter</p></form><script>var a = "<p>no</p>";</script>
    <section id="comments"><p>A reader comment that is quite long as well.</p></section><footer>&copy; 2020</footer>"""
    found = html_blocks.blocks(page)
    main = net.label([html_blocks.vectors(found)])[0]
    assert [b.text for b, yes in zip(found, main) if yes] == ["Title & more", "First paragraph of the text, it is long enough.", "Second paragraph, with markup."]


def test_gradients_equal_differences():
    import numpy as np

    rng = np.random.default_rng(1)
    net = html_blocks.Net.new(3)
    x, mask = rng.normal(size=(2, 4, html_blocks.WIDTH)), np.array([[True] * 4, [True, True, False, False]])
    y = rng.integers(0, 2, (2, 4)).astype(float)

    def loss():
        p = net.forward(x, mask)[0]
        return -((y * np.log(p) + (1 - y) * np.log(1 - p)) * mask).sum() / mask.sum()

    for name, grad in net.gradients(x, mask, y).items():
        flat, at = net.weights[name].reshape(-1), int(np.abs(grad).argmax())
        old = flat[at]
        flat[at] = old + 1e-5
        up = loss()
        flat[at] = old - 1e-5
        down = loss()
        flat[at] = old
        assert grad.reshape(-1)[at] == pytest.approx((up - down) / 2e-5, rel=1e-3)


def test_odd_pages(spark, net):
    rows = [(1, None, None), (2, "u", ""), (3, "u", "plain"), (None, "u", "<p>" * 3000), (4, "u", "<article><p>" + "word " * 50_000), (4, "u", "<!-- <p>x"), (5, "u", "a < b & c <")]
    pages = spark.createDataFrame([(*r, "?", "?") for r in rows], "page_id bigint, url string, html string, text string, n_chars string")
    got = {(r["page_id"], r["n_chars"]) for r in html_blocks.extract(pages, net).collect()}
    assert {(1, 0), (2, 0), (None, 0), (4, 249_999)} <= got and len(html_blocks.extract(pages, net).columns) == 4


def text_of(net, page):
    found = html_blocks.blocks(page)
    return [b.text for b, yes in zip(found, net.label([html_blocks.vectors(found)])[0]) if yes]


BODY = "<article><h1>Heading of the page</h1><p>First paragraph, long enough to be one.</p><p>Second paragraph of it.</p></article>"


@pytest.mark.parametrize(
    "before",
    [
        "<html><head><title>T</title>",
        "<head><meta charset=x><style>p {}</style>",
        "<html><head><title>T</title></head><body><svg width=1><path d='x'>",
        "<body><div><math><mi>x</mi>",
        "<body><video src=x>",
        "<body><canvas>old",
        "<body><div><svg><title>icon</title></svg></div>",
    ],
)
def test_elements_left_open_hide_no_text(net, before):
    assert text_of(net, before + BODY) == ["Heading of the page", "First paragraph, long enough to be one.", "Second paragraph of it."]


def test_hidden_text_stays_hidden():
    page = "<head><title>T</title><script>a</script></head><p>x<svg><text>icon</text></svg> y<object><p>old</p></object><noscript><p>n</p></noscript><template><p>t</p></template>"
    assert [b.text for b in html_blocks.blocks(page)] == ["x y"]


def test_pages_of_very_many_blocks_and_levels(net):
    import time
    import tracemalloc

    start = time.time()
    deep = html_blocks.blocks("<div>x " * 20_000)
    assert len(deep) == 20_000 and len(net.label([html_blocks.vectors(deep)])[0]) == 20_000
    wide = html_blocks.blocks("<article>" + "<p>Some words of a paragraph.</p>" * 20_000)
    tracemalloc.start()
    labels = net.label([html_blocks.vectors(wide), *[html_blocks.vectors(html_blocks.blocks(BODY))] * 63])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(labels[0]) == 20_000 and len(labels[1]) == 3
    assert peak < 200e6 and time.time() - start < 60
