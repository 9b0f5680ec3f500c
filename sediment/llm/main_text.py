"""The main text of web pages: a recurrent network labels every block with the whole page in view.

A page is the sequence of its text blocks. Each block is a vector of hashed features: the tags it
stands in with the words of their classes, its own tag, its words, and its shape (length, share of
links, punctuation, place). A bidirectional LSTM in numpy reads the sequence from both ends, and a
logistic unit tells of each block whether it belongs to the article.

The network is trained when it is used, on pages made for it: texts of a bounded sample of blocks of
the given pages (``FIT_BLOCKS`` rows of at most ``FIT_CHARS`` characters, chosen by a hash) are laid
out again in random layouts, where it is known which are article and which are menu, header, footer,
side column, notice, advert, form or comment. All pages are labelled, whole, where they are read;
nothing is shuffled.

A null or empty page, and one without any block of an article, gives an empty text. Null addresses and
ids pass through, repeated rows are labelled alike, an empty table gives no rows. Other columns are not
read. There are no ties: a block counts if its own probability is 0.5 or more.
"""

from __future__ import annotations

import random
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.llm.base import prepare
from sediment.llm.html_blocks import Block, blocks
from sediment.llm.words import slices

#: Bounds of the sample whose texts the training pages are made of.
FIT_BLOCKS, FIT_CHARS = 4000, 1000
#: Training pages, passes over them, pages in a step, units of each direction.
PAGES, PASSES, STEP, UNITS = 1200, 8, 30, 24
#: Hash cells of path marks, own tags and words; then shape features.
PATH_CELLS, TAG_CELLS, WORD_CELLS, SHAPES = 512, 64, 256, 40
CELLS = PATH_CELLS + TAG_CELLS + WORD_CELLS + SHAPES
#: Blocks whose inputs are held at once, and bytes of pages (one longer page is held by itself).
HELD, HELD_BYTES = 8192, 1 << 22

# Names that pages give to their parts. One list a kind of part; the last tells the article.
NAMES = {
    "menu": "nav navbar menu main-nav site-nav top-nav navigation breadcrumb breadcrumbs pagination tabs toc topbar menubar",
    "header": "header site-header masthead page-header banner top logo branding topline head",
    "footer": "footer site-footer page-footer bottom colophon copyright foot legal imprint",
    "side": "sidebar side aside widget related recommended trending right-column left-column rail popular teaser more-stories tags",
    "notice": "notice cookie cookies consent cookie-banner alert gdpr popup modal overlay message warning disclaimer paywall",
    "advert": "ad ads advert advertisement adsense ad-slot promo promotion sponsored sponsor banner-ad outbrain ad-container",
    "form": "form newsletter subscribe signup login search search-form contact-form poll survey register",
    "comment": "comment comments comment-list discussion replies responses disqus reader-comments comment-body thread feedback",
    "share": "share social sharing share-buttons social-links follow toolbar tools actions print",
    "article": "article content post entry story main article-body post-content entry-content main-content body-text text page-content blog-post",
}
ELEMENTS = {
    "menu": "nav nav nav div ul",
    "header": "header header div",
    "footer": "footer footer div",
    "side": "aside aside div section",
    "notice": "div div section p dialog",
    "advert": "div div aside section p",
    "form": "form form form div",
    "comment": "section div ul ol div",
    "share": "div ul p",
    "article": "article article main div div section td",
}


class Layouts:
    """Random pages of given texts, with a label for every block."""

    def __init__(self, texts: list[str], seed: int):
        self.texts, self.random = texts or ["text"], random.Random(seed)

    def page(self) -> tuple[str, list[int]]:
        self.labels: list[int] = []
        r = self.random
        parts = []
        for kind, chance in (("notice", 0.3), ("menu", 0.7), ("header", 0.6), ("menu", 0.2), ("form", 0.2), ("advert", 0.4), ("side", 0.3)):
            if r.random() < chance:
                parts.append(self.part(kind))
        parts.append(self.article())
        for kind, chance in (("share", 0.2), ("comment", 0.5), ("form", 0.3), ("advert", 0.3), ("side", 0.5), ("notice", 0.2), ("menu", 0.2), ("footer", 0.8)):
            if r.random() < chance:
                parts.append(self.part(kind))
        for _ in range(r.choice((0, 0, 1, 2))):
            parts.insert(0, (f"<div{self.named(r.choice(['wrapper', 'page', 'container', 'site', 'row', 'layout']))}>", []))
        for _, labels in parts:
            self.labels += labels
        return "<html><head><title>t</title></head><body>" + "\n".join(h for h, _ in parts) + "</body></html>", self.labels

    def named(self, name: str) -> str:
        key = self.random.choice(("class", "class", "id"))
        return f' {key}="{name}{self.random.choice(["", "", "", " clearfix", " wide", "-1", "-box"])}"'

    def opening(self, kind: str) -> tuple[str, str]:
        """Start and end tag: an element that tells the kind, or one whose name does, or both."""
        r = self.random
        tag = r.choice(ELEMENTS[kind].split())
        telling = tag in ("nav", "header", "footer", "aside", "form", "article", "main")
        name = self.named(r.choice(NAMES[kind].split())) if not telling or r.random() < 0.4 else ""
        if tag == "td":
            return f"<table><tr><td{name}>", "</td></tr></table>"
        return f"<{tag}{name}>", f"</{tag}>"

    def words(self, most: int) -> str:
        words = self.random.choice(self.texts).split()
        begin = self.random.randrange(max(len(words) - most, 0) + 1)
        return " ".join(words[begin : begin + self.random.randint(1, most)]).replace("<", "&lt;") or "text"

    def text(self) -> str:
        text = " ".join(self.random.choice(self.texts).split()).replace("&", "&amp;").replace("<", "&lt;")
        if self.random.random() < 0.2:
            text = f"<{(tag := self.random.choice(['b', 'em', 'span', 'i']))}>{text}" + (f"</{tag}>" if self.random.random() < 0.7 else "<br>")
        if self.random.random() < 0.1:
            text += f' <a href="/x">{self.words(3)}</a>'
        return text or "text"

    def part(self, kind: str) -> tuple[str, list[int]]:
        r = self.random
        begin, end = self.opening(kind)
        if kind in ("menu", "share"):
            links = [f'<a href="/{i}">{self.words(2)}</a>' for i in range(r.randint(2, 9))]
            if begin.startswith("<ul"):
                body, n = "".join(f"<li>{x}</li>" for x in links), len(links)
            elif r.random() < 0.7:
                body, n = "<ul>" + "".join(f"<li>{x}" + ("</li>" if r.random() < 0.8 else "") for x in links) + "</ul>", len(links)
            else:
                body, n = " | ".join(links), 1
        elif kind == "form":
            fields = [f"<label>{self.words(3)}</label><input name=q>" for _ in range(r.randint(1, 3))]
            body, n = "".join(fields) + f"<button>{self.words(2)}</button>", len(fields) + 1
            if r.random() < 0.4:
                body, n = f"<p>{self.text()}</p>" + body, n + 1
        elif kind == "comment":
            said = [self.text() for _ in range(r.randint(1, 8))]
            item = "li" if begin.startswith(("<ul", "<ol")) else r.choice(["div", "p", "article", "blockquote"])
            name = self.named("comment") if r.random() < 0.4 else ""
            head = r.random() < 0.5
            body = (f"<h{(k := r.randint(2, 4))}>{self.words(3)}</h{k}>" if head else "") + "".join(f"<{item}{name}>{x}</{item}>" for x in said)
            n = len(said) + head
        elif kind in ("side", "footer", "header") and r.random() < 0.6:
            head = r.random() < 0.5
            items = [f'<a href="/{i}">{self.words(6)}</a>' for i in range(r.randint(1, 6))]
            body = (f"<h{(k := r.randint(1, 4))}>{self.words(5)}</h{k}>" if head else "") + "".join(f"<p>{x}</p>" for x in items)
            n = len(items) + head
        elif r.random() < 0.5:
            copy = "&copy; " if kind == "footer" else ""
            body, n = copy + (self.text() if r.random() < 0.5 else self.words(15)), 1
        else:
            said = [self.text() if r.random() < 0.6 else self.words(12) for _ in range(r.randint(1, 3))]
            body, n = "".join(f"<p>{x}</p>" for x in said), len(said)
        return begin + body + end, [0] * n

    def article(self) -> tuple[str, list[int]]:
        r = self.random
        begin, end = self.opening("article")
        body, labels = [], []
        if r.random() < 0.8:
            body.append(f"<h1>{self.words(12)}</h1>")
            labels.append(1)
        inner = r.random() < 0.25
        if inner:
            body.append(f"<div{self.named(r.choice(['content', 'body', 'text', 'entry-content']))}>")
        style = r.choice(("any", "any", "any", "any", "short", "same", "list"))
        same = self.words(r.choice((1, 3, 30)))
        for _ in range(r.choice((1, 2, 3, 4, 6, 9, 14, 25, 60))):
            chance = r.random() * (0.8 if style in ("short", "same") else 1)
            if chance < 0.75:
                text = {"any": self.text, "short": lambda: self.words(3), "same": lambda: same, "list": lambda: self.words(1) + f" {r.choice('|%#*')} " + self.text()}[style]()
                body.append(f"<p>{text}" + ("</p>" if r.random() < 0.8 else ""))
                labels.append(1)
            elif chance < 0.82:
                body.append(f"<h2>{self.words(8)}</h2>")
                labels.append(1)
            elif chance < 0.88:
                items = [self.words(15) for _ in range(r.randint(2, 5))]
                body.append("<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>")
                labels += [1] * len(items)
            elif chance < 0.92:
                body.append(f"<{(tag := r.choice(['blockquote', 'pre', 'figcaption', 'div']))}>{self.text()}</{tag}>")
                labels.append(1)
            else:
                part, none = self.part(r.choice(("advert", "side", "share", "form", "notice")))
                body.append(part)
                labels += none
        if inner:
            body.append("</div>")
        if r.random() < 0.15:
            part, none = self.part("comment")
            body.append(part)
            labels += none
        return begin + "".join(body) + end, labels


def _cell(text: str, cells: int) -> int:
    return crc32(text.encode("utf-8", "surrogatepass")) % cells


class Features:
    """Cells and weights of blocks; what paths and tags give is looked up."""

    def __init__(self) -> None:
        self.paths: dict[tuple[str, ...], np.ndarray] = {}

    def path(self, path: tuple[str, ...]) -> np.ndarray:
        if path not in self.paths:
            if len(self.paths) > 2000:
                self.paths.clear()
            names = {m for mark in path for m in (mark, mark[:4])}
            self.paths[path] = np.array(sorted({_cell(m, PATH_CELLS) for m in names}), np.int64)
        return self.paths[path]

    def of(self, page: list[Block]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat cells, flat weights, and where each block begins."""
        cells, weights, bounds = [], [], [0]
        for i, block in enumerate(page):
            path = self.path(block.path)
            words = block.text.lower().split()
            own = [
                PATH_CELLS + _cell(block.tag, TAG_CELLS),
                *[CELLS - SHAPES + s for s in _shape(block, len(words), i, len(page))],
            ]
            hashed = np.fromiter((crc32(w.encode("utf-8", "surrogatepass")) % WORD_CELLS for w in words), np.int64, len(words))
            cells += [path, own, hashed + PATH_CELLS + TAG_CELLS]
            weights += [np.ones(len(path) + len(own)), np.full(len(words), 1 / max(len(words), 1))]
            bounds.append(bounds[-1] + len(path) + len(own) + len(words))
        if not page:
            return np.zeros(0, np.int64), np.zeros(0), np.zeros(1, np.int64)
        return np.concatenate(cells).astype(np.int64), np.concatenate(weights), np.array(bounds)


def _shape(block: Block, n_words: int, place: int, n_blocks: int) -> list[int]:
    """Length 0-11, share of links 12-16, place 17-24, end of sentence 25, marks 26-28, lone 29."""
    found = [min(n_words.bit_length(), 11), 12 + int(block.linked * 4), 17 + place * 8 // n_blocks]
    found += [25] * block.text.endswith((".", "!", "?", "…")) + [26] * ("©" in block.text) + [27] * ("|" in block.text)
    return found + [28] * (n_words < 4) + [29] * (n_blocks == 1)


def dense(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    rows = np.concatenate([np.repeat(np.arange(len(b) - 1), np.diff(b)) + n for (_, _, b), n in zip(parts, np.cumsum([0] + [len(p[2]) - 1 for p in parts]))])
    n = sum(len(b) - 1 for _, _, b in parts)
    flat = rows * CELLS + np.concatenate([c for c, _, _ in parts])
    return np.bincount(flat, np.concatenate([w for _, w, _ in parts]), n * CELLS).reshape(n, CELLS)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Labeller:
    """A bidirectional LSTM: for each direction input, state and constant weights of its gates; then the output."""

    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> Labeller:
        weights = {"out": rng.normal(0, 0.2, 2 * UNITS), "end": np.zeros(1)}
        for way in ("ahead", "back"):
            weights[f"{way}_in"] = rng.normal(0, 0.1, (CELLS, 4 * UNITS))
            weights[f"{way}_state"] = rng.normal(0, 1 / np.sqrt(UNITS), (UNITS, 4 * UNITS))
            weights[f"{way}_end"] = np.concatenate([np.zeros(UNITS), np.ones(UNITS), np.zeros(2 * UNITS)])
        return cls(weights)

    def step(self, way: str, inputs: np.ndarray, h: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, ...]:
        gates = inputs + h @ self.weights[f"{way}_state"]
        i, f, o = np.split(_sigmoid(gates[:, : 3 * UNITS]), 3, axis=1)
        g = np.tanh(gates[:, 3 * UNITS :])
        new = f * c + i * g
        t = np.tanh(new)
        return o * t, new, i, f, o, g, t

    def probabilities(self, pages: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> list[np.ndarray]:
        """Of the blocks of each page; pages of like length are read together, a long one in stretches."""
        found: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if len(p[2]) > 1), key=lambda i: len(pages[i][2]))
        while order:
            size = max(HELD // len(pages[order[-1]][2]), 1)
            group, order = order[-size:], order[:-size]
            lengths = np.array([len(pages[i][2]) - 1 for i in group])
            scores = [np.full(n, self.weights["end"][0]) for n in lengths]
            for way, part in (("ahead", self.weights["out"][:UNITS]), ("back", self.weights["out"][UNITS:])):
                h, c = np.zeros((len(group), UNITS)), np.zeros((len(group), UNITS))
                width = max(HELD // len(group), 1)
                for begin in range(0, int(lengths.max()), width):
                    spans = [_stretch(n, begin, width, way) for n in lengths]
                    x = dense([_slice(pages[i], *s) for i, s in zip(group, spans)])
                    inputs = x @ self.weights[f"{way}_in"] + self.weights[f"{way}_end"]
                    starts = np.cumsum([0] + [b - a for a, b in spans])
                    told = np.zeros(len(x))
                    for t in range(max(b - a for a, b in spans)):
                        live = np.array([k for k, (a, b) in enumerate(spans) if t < b - a])
                        # Backwards, a stretch is read from its end.
                        rows = starts[live] + t if way == "ahead" else starts[live + 1] - 1 - t
                        out, new, *_ = self.step(way, inputs[rows], h[live], c[live])
                        h[live], c[live] = out, new
                        told[rows] = out @ part
                    for k, (a, b) in enumerate(spans):
                        scores[k][a:b] += told[starts[k] : starts[k + 1]]
            for i, s in zip(group, scores):
                found[i] = _sigmoid(s)
        return found

    def learn(self, pages: list[tuple[tuple[np.ndarray, np.ndarray, np.ndarray], np.ndarray]], rng: np.random.Generator) -> None:
        """Adam steps on the cross entropy of blocks, with the gradient through all of a page."""
        moments = {k: (np.zeros_like(w), np.zeros_like(w)) for k, w in self.weights.items()}
        steps = 0
        for turn in range(PASSES):
            shuffled = [pages[i] for i in rng.permutation(len(pages))]
            rate = 0.01 * (1 - turn / PASSES) + 0.001
            for at in range(0, len(shuffled), STEP):
                steps += 1
                for k, slope in self._slopes(shuffled[at : at + STEP]).items():
                    first, second = moments[k]
                    first += 0.1 * (slope - first)
                    second += 0.001 * (slope**2 - second)
                    self.weights[k] -= rate * (first / (1 - 0.9**steps)) / (np.sqrt(second / (1 - 0.999**steps)) + 1e-8)

    def _slopes(self, pages: list) -> dict[str, np.ndarray]:
        pages = sorted(pages, key=lambda p: -len(p[1]))
        lengths = [len(y) for _, y in pages]
        starts = np.cumsum([0] + lengths)
        x, labels = dense([p for p, _ in pages]), np.concatenate([y for _, y in pages])
        runs, hidden = {}, np.zeros((len(labels), 2 * UNITS))
        for k, way in enumerate(("ahead", "back")):
            inputs = x @ self.weights[f"{way}_in"] + self.weights[f"{way}_end"]
            h = c = np.zeros((len(pages), UNITS))
            runs[way] = []
            for t in range(lengths[0]):
                n = sum(m > t for m in lengths)  # the longest pages come first
                rows = starts[:n] + t if way == "ahead" else starts[1 : n + 1] - 1 - t
                out, new, *gates = self.step(way, inputs[rows], h[:n], c[:n])
                runs[way].append((rows, h[:n], c[:n], *gates))
                h, c = out, new
                hidden[rows, k * UNITS : (k + 1) * UNITS] = out
        error = (_sigmoid(hidden @ self.weights["out"] + self.weights["end"]) - labels) / len(labels)
        slopes = {"out": hidden.T @ error, "end": np.array([error.sum()])}
        for k, way in enumerate(("ahead", "back")):
            inputs = np.zeros((len(labels), 4 * UNITS))
            state = np.zeros((UNITS, 4 * UNITS))
            dh = dc = np.zeros((0, UNITS))
            for rows, h, c, i, f, o, g, t in reversed(runs[way]):
                more = len(rows) - len(dh)
                dh, dc = (np.vstack([d, np.zeros((more, UNITS))]) for d in (dh, dc))
                dh = dh + error[rows, None] * self.weights["out"][None, k * UNITS : (k + 1) * UNITS]
                dc = dc + dh * o * (1 - t**2)
                gates = np.hstack([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * t * o * (1 - o), dc * i * (1 - g**2)])
                inputs[rows] = gates
                state += h.T @ gates
                dh, dc = gates @ self.weights[f"{way}_state"].T, dc * f
            slopes |= {f"{way}_in": x.T @ inputs, f"{way}_state": state, f"{way}_end": inputs.sum(axis=0)}
        return slopes


def _stretch(n: int, begin: int, width: int, way: str) -> tuple[int, int]:
    """The blocks of a page of ``n`` that are read together, from one end or the other."""
    a, b = min(begin, n), min(begin + width, n)
    return (a, b) if way == "ahead" else (n - b, n - a)


def _slice(page: tuple[np.ndarray, np.ndarray, np.ndarray], a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    cells, weights, bounds = page
    return cells[bounds[a] : bounds[b]], weights[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]


def trained(texts: Iterable[str], seed: int = 1) -> Labeller:
    """A labeller learnt from random layouts of ``texts``."""
    layouts, features = Layouts(sorted(texts), seed), Features()
    rng = np.random.default_rng(seed)
    pages = []
    for _ in range(PAGES):
        page, labels = layouts.page()
        pages.append((features.of(list(blocks(page))), np.array(labels, float)))
    labeller = Labeller.fresh(rng)
    labeller.learn(pages, rng)
    return labeller


def sampled_texts(pages: DataFrame, html_col: str = "html") -> list[str]:
    """At most ``FIT_BLOCKS`` texts of blocks, none longer than ``FIT_CHARS``, those that hash lowest."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = {b.text for page in batch["html"].to_pylist() for b in blocks(page) if len(b.text) <= FIT_CHARS}
            ranked = sorted((crc32(b"fit" + t.encode("utf-8", "surrogatepass")), t) for t in texts)[:FIT_BLOCKS]
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in ranked], pa.int64()), pa.array([t for _, t in ranked], pa.string())], ["rank", "text"])

    n = pages.count()
    share = min(1.0, FIT_BLOCKS / max(n, 1))
    html = F.col(html_col).cast("string")
    some = pages.select(html.alias("html")).filter(F.pmod(F.xxhash64(F.lit("fit"), "html"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1))
    rows = some.mapInArrow(cut, "rank long, text string").distinct().orderBy("rank", "text").limit(FIT_BLOCKS)
    return [r["text"] for r in rows.collect()]


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", seed: int = 1) -> DataFrame:
    """(``page_id``, ``url``, ``text``, ``n_chars``, ``n_blocks``, ``n_main``) of every page."""
    spark = pages.sparkSession
    prepare(spark)
    labeller = spark.sparkContext.broadcast(trained(sampled_texts(pages, html_col), seed).weights)  # 0.7 MB

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, features = Labeller(labeller.value), Features()
        for whole in batches:
            for begin, html in slices(whole["html"], HELD_BYTES):
                batch = whole.slice(begin, len(html))
                found = [list(blocks(page)) for page in html.to_pylist()]
                chances = network.probabilities([features.of(page) for page in found])
                kept = [[b.text for b, p in zip(page, ps) if p >= 0.5] for page, ps in zip(found, chances)]
                texts = ["\n\n".join(page) for page in kept]
                arrays = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                arrays += [pa.array([len(p) for p in some], pa.int64()) for some in (found, kept)]
                names = ["page_id", "url", "text", "n_chars", "n_blocks", "n_main"]
                yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], *arrays], names)

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    kinds = [rows.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return rows.mapInArrow(extract, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long, n_blocks long, n_main long")
