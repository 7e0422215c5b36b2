"""Main text of HTML pages by a recurrent block labeller.

A page is cut into leaf blocks (``html_blocks``), each a vector of its tag path, hashed words and a few
numbers. A bidirectional LSTM in numpy reads the blocks of a page as one sequence, so every block is labelled
in view of the whole page, and those labelled as main text are joined in page order.

There are no labels for pages, so the labeller is trained on weak ones: a bounded sample of pages (``SAMPLE``) whose
blocks are labelled by the semantic elements around them (inside ``article`` or ``main``, not inside navigation, asides,
footers or comments), and layouts made of the sample's own texts with the usual markup for menus, notices, adverts, forms,
sidebars and comments, where the semantic elements are mostly missing. The model is a few hundred
kilobytes; tasks get it with their code, and pages never leave their partition.

Defined results: a null or empty html, and a page without blocks of main text, give an empty text; rows with equal
or null ids are separate pages; an empty table gives no rows; very long pages are read whole, as one sequence; extra columns are ignored,
whatever their names.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm.common import table
from aerolith.llm.html_blocks import NUMBERS, WIDTH, Leaf, blocks, vectors

#: pages to learn from, and the longest of them in characters
SAMPLE, SAMPLE_CHARS = 200, 1 << 16
#: made layouts, passes over them, pages per step, cells of each direction
LAYOUTS, EPOCHS, BATCH, CELLS = 700, 14, 32, 24
#: blocks that are labelled together
AT_ONCE = 4096
OUT = "page_id {id}, url string, text string, n_chars long"

# Names that pages commonly give to their parts (class, id or element).
MAIN = ["<article>", "<main>", "<main><article>", '<div class="content">', '<div id="content">', '<div class="post">', '<div class="entry-content">',
        '<div class="article-body">', '<section class="article">', '<div class="post-content">', '<div class="story-body">', '<div id="main-content">',
        '<div role="main">', '<div class="main"><div class="text">', '<article class="post"><div class="entry">', '<div itemprop="articleBody">',
        "<table><tr><td>", "<section>", "<div>", "<div><div>", ""]
ASIDE = {
    "menu": ["<nav>", '<div class="nav">', '<ul class="menu">', '<div id="navigation">', '<div class="navbar">', '<div class="breadcrumbs">', '<div role="navigation">',
             '<ol class="breadcrumb">', '<div class="main-menu">', '<div class="toc">', '<div class="pagination">', '<ul class="tabs">', '<div class="skip-links">'],
    "head": ["<header>", '<div class="header">', '<div id="header">', '<div class="masthead">', '<div class="site-header">', '<div class="topbar">',
             '<div role="banner">', '<div class="logo">', '<div class="branding">'],
    "foot": ["<footer>", '<div class="footer">', '<div id="footer">', '<div class="site-footer">', '<div class="copyright">', '<div role="contentinfo">',
             '<div class="legal">', '<div class="colophon">', '<div class="bottom">'],
    "side": ["<aside>", '<div class="sidebar">', '<div id="sidebar">', '<div class="widget">', '<div class="related">', '<div class="related-posts">',
             '<div class="recommended">', '<section class="popular">', '<div role="complementary">', '<div class="tags">', '<div class="share">',
             '<div class="social">', '<aside class="sidebar">', '<div class="author-bio">', '<div class="trending">', '<div class="more-stories">', '<div class="links">'],
    "note": ['<div class="notice">', '<div class="cookie-notice">', '<div id="cookie-banner">', '<div class="alert">', '<div class="banner">', '<div class="consent">',
             '<div class="gdpr">', '<div class="popup">', '<div class="modal">', '<div class="message">', '<div role="alert">', '<p class="disclaimer">', '<div class="paywall">',
             '<div class="warning">', '<dialog>', '<div class="overlay">'],
    "ad": ['<div class="ad">', '<div class="ads">', '<div class="advert">', '<div class="advertisement">', '<div id="ad-top">', '<div class="sponsored">', '<div class="promo">',
           '<div class="banner-ad">', '<ins class="adsbygoogle"></ins><div class="adbox">', '<aside class="ad">', '<div class="sponsor">', '<section class="promotion">'],
    "form": ["<form>", '<form class="search">', '<div class="newsletter"><form>', '<form id="login">', '<div class="subscribe">', '<form class="contact"><fieldset>',
             '<div class="signup">', '<form class="comment-form">', '<div class="search-box"><form>'],
    "talk": ['<div class="comments">', '<section id="comments">', '<ol class="comment-list">', '<div id="disqus_thread">', '<div class="comment">', '<div class="discussion">',
             '<section class="reader-comments">', '<div id="respond">', '<div class="replies">', '<ul class="comments">', '<div class="responses">', '<div class="feedback">'],
}
WEAK_OUT = {"<nav", "<aside", "<footer", "<form", "<dialog", "<header"}
SAID = {"menu": ["Home", "About", "Contact", "News", "Products", "Next", "Previous", "Archive"], "head": ["The Daily Page", "Sign in", "Menu"],
        "foot": ["© 2024 All rights reserved.", "Privacy policy", "Terms of use", "Imprint"], "side": ["Related articles", "Most read", "Share this", "Tags:", "About the author"],
        "note": ["We use cookies to improve this site.", "Accept all", "Your browser is out of date.", "Please enable JavaScript."],
        "ad": ["Advertisement", "Sponsored", "Buy now and save.", "Limited offer"], "form": ["Search", "Your e-mail", "Subscribe to our newsletter", "Password", "Send"],
        "talk": ["Comments", "Reply", "Leave a comment", "3 comments", "Anonymous says:", "Report"]}


def weak_labels(leaves: list[Leaf]) -> list[int] | None:
    """1 for blocks inside ``article`` or ``main`` and not in a part that stands beside the text; None for pages with neither."""
    aside = {w for kinds in ASIDE.values() for k in kinds for w in _names(k)} - {w for k in MAIN for w in _names(k)}
    out, some = [], False
    for x in leaves:
        e, main, beside = x.at, False, False
        while e is not None:
            main = main or "<article" in e.tokens or "<main" in e.tokens
            beside = beside or (not main and not WEAK_OUT.isdisjoint(e.tokens)) or not aside.isdisjoint(e.tokens)
            e = e.parent
        some = some or main
        out.append(int(main and not beside))
    return out if some else None


def _names(markup: str) -> set[str]:
    """Class and id words of a piece of markup."""
    found = blocks(markup + "x")
    e, out = found[0].at, set()
    while e is not None:
        out |= {t for t in e.tokens if t[0] != "<" and t[-1] != "*"}
        e = e.parent
    return out


def _closing(markup: str) -> str:
    e, out = blocks(markup + "x")[0].at, ""
    while e.parent is not None:
        out, e = out + f"</{e.name}>", e.parent
    return out


def _escape(text: str, rng: random.Random) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(" ", rng.choice([" "] * 20 + ["&nbsp;", "\n  "]), 1)


def layout(rng: random.Random, long: list[str], short: list[str]) -> tuple[str, list[int]]:
    """A made page and the label of each of its blocks, of main texts ``long`` and other texts ``short``."""
    out, labels = [], []
    noise = lambda: f' class="{rng.choice(short).split()[0]} c{rng.randrange(99)}"' if rng.random() < 0.3 else ""

    def say(markup, text, label, close=True):
        inline = rng.choice([("", "")] * 8 + [("<b>", "</b>"), ("<i>", ""), ("<b>", ""), ("<span>", "</span>")])
        out.append(markup + inline[0] + (_escape(text, rng) or "x") + inline[1] + (f"</{markup[1:].split()[0].rstrip('>')}>" if close and markup else ""))
        labels.append(label)

    def beside(kind):
        own = rng.choice(ASIDE[kind])
        out.append(own)
        if kind in ("menu", "side", "foot", "head") and rng.random() < 0.7:
            ul = rng.random() < 0.7
            out.append("<ul>" if ul else "")
            for _ in range(rng.randint(1, 9)):
                t = rng.choice(SAID[kind]) if rng.random() < 0.3 else " ".join(rng.choice(short).split()[:rng.randint(1, 4)])
                say("<li>" if ul else rng.choice(["<p>", "<div>"]), f"\x01{t}\x02" if rng.random() < 0.8 else t, 0)
            out.append("</ul>" if ul else "")
        elif kind == "talk":
            for _ in range(rng.randint(1, 6)):
                if rng.random() < 0.5:
                    say(rng.choice(["<h3>", "<div>", "<p>", '<div class="author">']), rng.choice(SAID[kind] + short), 0)
                say(rng.choice(["<p>", "<li>", "<div>", '<div class="comment-body">', "<p>"]), rng.choice(long + short), 0)
        elif kind == "form":
            for _ in range(rng.randint(1, 4)):
                say(rng.choice(["<p>", "<div>", "<legend>", "<li>"]), rng.choice(SAID[kind] + short), 0)
                out.append(rng.choice(['<input name="q">', "<select><option>1<option>2</select>", "<button>Go</button>", ""]))
        else:
            for _ in range(rng.randint(1, 3)):
                say(rng.choice(["", "<p>", "<div>", "<p>"]) if len(out) and out[-1] == own else rng.choice(["<p>", "<div>"]),
                    rng.choice(SAID[kind]) if rng.random() < 0.3 else rng.choice(short + long[:3]), 0)
        out.append(_closing(own))

    body = rng.choice(["<body>", '<body class="home">', '<body><div id="page">', '<body><div class="wrapper">', '<body><form id="aspnetForm"><div class="container">'] * 2 + [""])
    out.append("<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head>" + body)
    for kind in rng.sample(["head", "menu", "note", "ad", "form", "menu"], rng.randint(0, 5)):
        beside(kind)
    own = rng.choice(MAIN)
    side_first = rng.random() < 0.2
    if side_first:
        beside("side")
    out.append(own[:-1] + noise() + ">" if own and " " not in own else own)
    if rng.random() < 0.8:
        say(rng.choice(["<h1>", "<h2>", "<header><h1>", "<h1>"]), rng.choice(long)[:rng.randint(10, 80)].strip() or "x", 1, close=False)
        out.append(rng.choice(["</h1>", "</h2>", "</header>"]))
    unclosed = rng.random() < 0.3
    for _ in range(rng.choice([1, 2, 3, 5, 8, 12, 18])):
        r = rng.random()
        if r < 0.72 or not own:
            text = rng.choice(long)
            say("<p" + (noise() if rng.random() < 0.2 else "") + ">", text if rng.random() < 0.8 else " ".join(text.split()[:rng.randint(1, 9)]), 1, close=not unclosed)
        elif r < 0.8:
            out.append(ul := rng.choice(["<ul>", "<ol>"]))
            for _ in range(rng.randint(1, 4)):
                text = rng.choice(long)
                say("<li>", text if rng.random() < 0.5 else " ".join(text.split()[:rng.randint(2, 12)]), 1, close=not unclosed)
            out.append(ul.replace("<", "</"))
        elif r < 0.92:
            say(rng.choice(["<h2>", "<h3>", "<blockquote>", "<pre>", "<div>", "<figcaption>", "<blockquote><p>"]), rng.choice(long), 1)
        else:
            beside(rng.choice(["ad", "side", "form", "note", "ad"]))
    out.append(_closing(own) if own else "")
    for kind in rng.sample(["talk", "side", "ad", "foot", "foot", "note", "form", "menu"], rng.randint(0, 5)):
        beside(kind)
    page = "".join(out).replace("\x01", '<a href="/x">').replace("\x02", "</a>")
    return page + rng.choice(["", "</body></html>", "</html>"]), labels


class Labeller:
    """A bidirectional LSTM with one logistic output per block."""

    def __init__(self, seed: int = 1, cells: int = CELLS):
        rng = np.random.default_rng(seed)
        self.h = cells
        s = 1 / np.sqrt(cells)
        self.w = {}
        for way in "fb":
            self.w["W" + way] = rng.normal(0, 0.08, (WIDTH, 4 * cells))
            self.w["U" + way] = rng.uniform(-s, s, (cells, 4 * cells))
            self.w["c" + way] = np.concatenate([np.zeros(cells), np.ones(cells), np.zeros(2 * cells)])
        self.w["V"], self.w["v"] = rng.uniform(-s, s, 2 * cells), np.zeros(1)
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}

    def _run(self, x: np.ndarray, live: np.ndarray, way: str, keep: bool, start: tuple | None = None):
        """Hidden states (T, B, h) of one direction over x (T, B, width); ``live`` (T, B) is 0 beyond a sequence's end. ``start``: state and cell before."""
        t, b, _ = x.shape
        h, u = self.h, self.w["U" + way]
        g = x.reshape(t * b, -1) @ self.w["W" + way] + self.w["c" + way]
        g = g.reshape(t, b, 4 * h)
        out, cell = np.zeros((t + 1, b, h), np.float32), np.zeros((t + 1, b, h), np.float32)
        order = range(t) if way == "f" else range(t - 1, -1, -1)
        gates = np.empty_like(g) if keep else None
        ph, pc = start or (out[t], cell[t])
        for k in order:
            a = g[k] + ph @ u
            s = 1 / (1 + np.exp(-a[:, :3 * h]))
            n = np.tanh(a[:, 3 * h:])
            m = live[k][:, None]
            pc = (s[:, h:2 * h] * pc + s[:, :h] * n) * m
            ph = s[:, 2 * h:] * np.tanh(pc) * m
            out[k], cell[k] = ph, pc
            if keep:
                gates[k, :, :3 * h], gates[k, :, 3 * h:] = s, n
        return out[:t], cell[:t], gates

    def scores(self, x: np.ndarray, live: np.ndarray) -> np.ndarray:
        """Log odds (T, B) that a block is main text."""
        h = self.h
        return self._run(x, live, "f", False)[0] @ self.w["V"][:h] + self._run(x, live, "b", False)[0] @ self.w["V"][h:] + self.w["v"]

    def long_scores(self, n: int, part) -> np.ndarray:
        """``scores`` of one page of ``n`` blocks, whose vectors ``part(from, to)`` gives, ``AT_ONCE`` blocks at a time."""
        h, z = self.h, np.full(n, self.w["v"][0], np.float32)
        starts = range(0, n, AT_ONCE)
        for q, (way, order) in enumerate((("f", starts), ("b", reversed(starts)))):
            state = None
            for a in order:
                x = part(a, min(n, a + AT_ONCE))[:, None]
                out, cell, _ = self._run(x, np.ones((len(x), 1), np.float32), way, False, state)
                last = -1 if way == "f" else 0
                state = out[last].copy(), cell[last].copy()
                z[a:a + len(x)] += out[:, 0] @ self.w["V"][q * h:(q + 1) * h]
        return z

    def gradients(self, x: np.ndarray, live: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross-entropy over live blocks, by back-propagation through time."""
        t, b, _ = x.shape
        h, flat, out = self.h, x.reshape(t * b, -1), {}
        runs = {way: self._run(x, live, way, True) for way in "fb"}
        z = runs["f"][0] @ self.w["V"][:h] + runs["b"][0] @ self.w["V"][h:] + self.w["v"]
        dz = (1 / (1 + np.exp(-z)) - y) * live / live.sum()
        out["V"] = np.concatenate([np.einsum("tb,tbh->h", dz, runs[w][0]) for w in "fb"])
        out["v"] = dz.sum(keepdims=True).reshape(1)
        for n, way in enumerate("fb"):
            state, cell, gates = runs[way]
            u, v = self.w["U" + way], self.w["V"][n * h:(n + 1) * h]
            da = np.zeros_like(gates)
            dh, dc = np.zeros((b, h), np.float32), np.zeros((b, h), np.float32)
            before = -1 if way == "f" else 1
            order = range(t - 1, -1, -1) if way == "f" else range(t)
            zero = np.zeros((b, h), np.float32)
            prior = np.zeros_like(state)
            for k in order:
                j = k + before
                ok = 0 <= j < t
                pc, prior[k] = (cell[j], state[j]) if ok else (zero, zero)
                m = live[k][:, None]
                i, f, o, g = (gates[k, :, q * h:(q + 1) * h] for q in range(4))
                tc = np.tanh(cell[k])
                dh = (dh + dz[k][:, None] * v) * m
                dc = (dc + dh * o * (1 - tc * tc)) * m
                da[k] = np.concatenate([dc * g * i * (1 - i), dc * pc * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
                dc, dh = dc * f, da[k] @ u.T
            d = da.reshape(t * b, -1)
            out["W" + way], out["c" + way] = flat.T @ d, d.sum(axis=0)
            out["U" + way] = prior.reshape(t * b, h).T @ d
        return out

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, rate: float = 0.01, seed: int = 1) -> None:
        """Adam over batches of pages of similar length; a tenth of the path bits and words are hidden in each pass."""
        rng = np.random.default_rng(seed)
        first, second = ({k: np.zeros_like(v) for k, v in self.w.items()} for _ in range(2))
        step = 0
        by_size = sorted(range(len(pages)), key=lambda k: (len(pages[k][1]), k))
        batches = [by_size[a:a + BATCH] for a in range(0, len(by_size), BATCH)]
        for epoch in range(epochs):
            for a in rng.permutation(len(batches)):
                x, live, y = _stacked([pages[k][0] for k in batches[a]], [pages[k][1] for k in batches[a]])
                x[:, :, :-NUMBERS] *= rng.random(x.shape[1:])[:, :-NUMBERS] > 0.1
                grads = self.gradients(x, live, y)
                size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                step += 1
                pace = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
                for k, g in grads.items():
                    g = g / max(1.0, size)
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.001 * (g * g - second[k])
                    self.w[k] -= (pace * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)


def _stacked(rows: list[np.ndarray], labels: list[np.ndarray] | None = None):
    """(T, B, width) vectors, (T, B) live places and labels of pages, filled up with zeros."""
    t = max(map(len, rows))
    x, live = np.zeros((t, len(rows), WIDTH), np.float32), np.zeros((t, len(rows)), np.float32)
    y = np.zeros((t, len(rows)), np.float32)
    for k, r in enumerate(rows):
        x[:len(r), k], live[:len(r), k] = r, 1
        if labels is not None:
            y[:len(r), k] = labels[k]
    return x, live, y


def page_vectors(pages: list[list[Leaf]]) -> list[np.ndarray]:
    """The block vectors of each page, made together."""
    v = vectors([x for p in pages for x in p], [k for p in pages for k in range(len(p))], [len(p) for p in pages for _ in p])
    return np.split(v, np.cumsum([len(p) for p in pages])[:-1])


def label(model: Labeller, pages: list[list[Leaf]]) -> list[np.ndarray]:
    """For each page, whether each of its blocks is main text."""
    out: list = [np.empty(0, bool)] * len(pages)
    todo = sorted((k for k, p in enumerate(pages) if p), key=lambda k: len(pages[k]))
    while todo and (size := len(pages[k := todo[-1]])) > AT_ONCE:
        todo.pop()
        out[k] = model.long_scores(size, lambda a, b, page=pages[k], size=size: vectors(page[a:b], range(a, b), [size] * (b - a))) > 0
    while todo:
        # pages of similar length, longest first
        n = max(1, AT_ONCE // len(pages[todo[-1]]))
        some, todo = todo[-n:], todo[:-n]
        x, live, _ = _stacked(page_vectors([pages[k] for k in some]))
        z = model.scores(x, live)
        for b, k in enumerate(some):
            out[k] = z[:len(pages[k]), b] > 0
    return out


def extract(model: Labeller, pages: list[str | None]) -> list[str]:
    """Main text of each page."""
    found = [blocks(p or "") for p in pages]
    return ["\n\n".join([x.text for x, keep in zip(leaves, kept) if keep]) for leaves, kept in zip(found, label(model, found))]


def train(sample: list[str], layouts: int = LAYOUTS, seed: int = 1) -> Labeller:
    """A labeller learnt from sample pages and from layouts made of their texts."""
    rng = random.Random(seed)
    real, long, short = [], [], []
    for leaves in map(blocks, sample):
        y = weak_labels(leaves)
        for k, x in enumerate(leaves):
            (long if (y[k] if y else len(x.text) > 80) else short).append(x.text)
        if y:
            real.append((leaves, y))
    long, short = [t for t in long if len(t) < 4000][:5000] or ["Some text."], short[:5000] or ["Home"]
    made = []
    for _ in range(layouts):
        page, y = layout(rng, long, short)
        leaves = blocks(page)
        if len(leaves) == len(y):
            made.append((leaves, y))
    both = [(leaves, y) for leaves, y in real + made if leaves]
    pages = [(v, np.array(y, np.float32)) for v, (_, y) in zip(page_vectors([leaves for leaves, _ in both]), both)]
    model = Labeller(seed)
    model.fit(pages)
    return model


def learn(pages: DataFrame, html_col: str = "html", sample: int = SAMPLE) -> Labeller:
    """A labeller from the ``sample`` different pages of smallest hash among those of at most ``SAMPLE_CHARS`` characters."""
    html = F.col(html_col).cast("string")
    rows = pages.select(html.alias("html")).where((F.length("html") > 0) & (F.length("html") <= SAMPLE_CHARS)).select(F.xxhash64("html").alias("h"), "html")
    # hashes first, then the pages they name: tasks send the driver no page that is not in the sample
    last = rows.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    if last is None:
        return train([])
    return train([r["html"] for r in rows.where(F.col("h") <= last).groupBy("h").agg(F.min("html").alias("html")).orderBy("h").collect()])


def extracted(pages: DataFrame, model: Labeller | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    model = model or learn(pages, html_col)

    def run(batches):
        for b in batches:
            texts = extract(model, b.column("html").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, OUT.format(id=rows.schema["page_id"].dataType.simpleString()))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extracted(table(spark, sf_dir, "pages"))


QUERIES = {"op12_html_extraction": op12_html_extraction}
SQL: dict[str, str] = {}
