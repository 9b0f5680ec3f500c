"""Blocks of pages, the network against its own numbers, and main texts of pages whose article is known."""

from __future__ import annotations

import html
import re
from pathlib import Path

import numpy as np
import pytest

from sediment.llm import main_text, queries
from sediment.llm.html_blocks import blocks

SMALL = Path("/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not SMALL.exists(), reason="test tables are not here")
SENTENCES = [
    "The river rose again in the night and took the lower road with it.",
    "Nobody had expected the bridge to hold, but it did until the morning.",
    "We walked up to the old mill and counted the sheep on the other side.",
    "By noon the sun was out.",
    "Every house in the valley had lost something; ours had lost the fence.",
    "My father said that it was worse in the year when he was born.",
    "Later they built a wall, and the water has not come back since.",
]


def texts(page):
    return [b.text for b in blocks(page)]


@pytest.mark.parametrize(
    "page, wanted",
    [
        (None, []),
        ("", []),
        ("plain  text\n only", ["plain text only"]),
        ("<p>one<p>two <b>bold</b>\n\ttext<br>more</p>tail", ["one", "two bold text more", "tail"]),
        ("<p>a &amp; b &lt;c&gt; &#233; &nbsp;&amp</p>", ["a & b <c> é &"]),
        ("<script>var t = '</p><p>no';</script><style>p{}</style><p>yes", ["yes"]),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
        ("<title>t</title><p>x</p><!-- <p>no</p> --><p>y</p><!-- never ends <p>z", ["x", "y"]),
        ("<p>x</p><a href='broken", ["x"]),
        ("<p title='a > b'>x</p>", ["x"]),
        ("1 < 2 and <3", ["1 < 2 and <3"]),
        ("<!DOCTYPE html><?xml x?></>x", ["x"]),
        ("<script>never ends <p>x", []),
        ("<TABLE><TR><TD>a<TD>b<TR><TD>c</TABLE>d", ["a", "b", "c", "d"]),
    ],
)
def test_blocks(page, wanted):
    assert texts(page) == wanted


def test_paths():
    page = '<nav class="MainMenu top"><ul><li><a href=x>home</a> now</ul></nav></b></div><div id=story><p>text</div>after'
    menu, story, after = blocks(page)
    assert menu.path == ("<li", "<nav", "<ul", "main", "menu", "top") and 0.4 < menu.linked < 0.6
    assert story.path == ("<div", "<p", "story") and story.tag == "p" and after.path == ()


def test_deep_and_broken_pages_end():
    assert texts("<div>" * 20_000 + "x" + "</div>" * 5) == ["x"]
    assert texts("<" * 50_000 + " x")[0].endswith("x")
    assert texts("<a b='" * 20_000) == []


def fake(rng, n):
    cells = rng.integers(0, main_text.CELLS, n * 6)
    return cells, np.ones(len(cells)), np.arange(n + 1) * 6


def test_slopes_are_those_of_the_error(monkeypatch):
    monkeypatch.setattr(main_text, "UNITS", 3)
    rng = np.random.default_rng(1)
    network = main_text.Labeller.fresh(rng)
    pages = [(fake(rng, n), rng.integers(0, 2, n).astype(float)) for n in (4, 1, 6)]

    def error():
        chances = np.concatenate(network.probabilities([p for p, _ in pages]))
        labels = np.concatenate([y for _, y in pages])
        return -np.mean(np.log(np.where(labels == 1, chances, 1 - chances)))

    slopes = network._slopes(pages)
    used = pages[0][0][0][0]
    for name, weight in network.weights.items():
        for at in [(used, 1), (used, 7)] if name.endswith("_in") else [(0,) * weight.ndim, (-1,) * weight.ndim]:
            before = weight[at]
            weight[at] = before + 1e-5
            high = error()
            weight[at] = before - 1e-5
            low = error()
            weight[at] = before
            assert abs((high - low) / 2e-5 - slopes[name][at]) < 1e-6, (name, at)


def test_long_pages_in_stretches(monkeypatch):
    rng = np.random.default_rng(2)
    network = main_text.Labeller.fresh(rng)
    pages = [fake(rng, n) for n in (50, 3, 0, 17, 50)]
    whole = network.probabilities(pages)
    assert [len(w) for w in whole] == [50, 3, 0, 17, 50]
    for held in (1, 7, 40):
        monkeypatch.setattr(main_text, "HELD", held)
        for a, b in zip(whole, network.probabilities(pages)):
            assert np.allclose(a, b)


@pytest.fixture(scope="module")
def network():
    return main_text.trained(SENTENCES + [" ".join(SENTENCES[i : i + 3]) for i in range(4)] + ["Home", "Read more", "About us"])


def test_held_out_layouts(network):
    layouts, features = main_text.Layouts([s.upper() for s in SENTENCES], 77), main_text.Features()
    right = total = 0
    for _ in range(200):
        page, labels = layouts.page()
        found = list(blocks(page))
        assert len(found) == len(labels)
        right += ((network.probabilities([features.of(found)])[0] >= 0.5) == np.array(labels)).sum()
        total += len(labels)
    assert right >= 0.97 * total


BODY = "".join(f"<p>{s}</p>" for s in SENTENCES)
PAGES = [
    f"<body><header><a href=/>Site</a></header><nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav><article>{BODY}</article><footer>&copy; Site</footer>",
    f'<body><div class="cookie-banner">We use cookies. <button>OK</button></div><div id="content">{BODY}</div><div class="sidebar"><p>Most read</p><a href=x>Other</a></div>',
    f'<body><main>{BODY}</main><section class="comments"><h3>Comments</h3><div class="comment">{SENTENCES[0]}</div><div class="comment">{SENTENCES[3]}</div></section>',
    f'<body><ul class="menu"><li><a href=x>Home</a></li><li><a href=y>News</a></li></ul><div class="post-content">{BODY}<div class="ad">{SENTENCES[2]}</div></div>',
    f'<body><article>{BODY}<aside class="related"><a href=x>More</a></aside></article><form class="newsletter"><label>Your mail</label><button>Send</button></form><div class="footer">Imprint</div>',
]


@pytest.mark.parametrize("page", PAGES)
def test_known_pages(network, page):
    found = list(blocks(page))
    chances = network.probabilities([main_text.Features().of(found)])[0]
    assert [b.text for b, p in zip(found, chances) if p >= 0.5] == SENTENCES


def test_odd_rows(spark):
    rows = [(1, "u", None, "t", 1), (None, None, "", "t", 1), (2, "u", PAGES[0], "t", 1), (2, "u", PAGES[0], "t", 1)]
    rows += [(3, "u", "<p>" + "long text " * 100_000, "t", 1), (4, "u", "<script>x", "t", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int").repartition(2)
    found = sorted(main_text.main_texts(df).collect(), key=str)
    assert len(found) == 6 and all(r["n_chars"] == len(r["text"]) for r in found)
    assert [r["text"] for r in found if r["page_id"] in (1, 4, None)] == [""] * 3
    twice = [r for r in found if r["page_id"] == 2]
    assert twice[0] == twice[1]
    assert main_text.main_texts(df.limit(0)).collect() == []


@needs_data
def test_pages(spark):
    found = {r["page_id"]: r["text"] for r in queries.REGISTRY["op12_main_text"](spark, str(SMALL)).collect()}
    right = 0
    for row in spark.read.parquet(str(SMALL / "pages.parquet")).collect():
        article = re.search("<article>(.*?)</article>", row["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", p)).split()) for p in re.split("</?p>|</?h1>", article)]
        right += found.pop(row["page_id"]) == "\n\n".join(p for p in parts if p)
    assert not found and right >= 0.98 * spark.read.parquet(str(SMALL / "pages.parquet")).count()
