"""Main text of web pages by a recurrent block labeller.

A page is a sequence of leaf blocks (`markup.blocks`). Each block is read as a vector: the
embeddings of its hashed tag path, of its hashed words, and a few measures. A bidirectional LSTM
runs over all blocks of the page, so a block is judged with what stands before and after it;
a logistic output tells main text from the rest. All of it is numpy, trained here.

Training pages are a bounded sample of the table (`sample_pages` of at most `sample_chars`
bytes, by hash). Their labels come from their own markup: elements that say what they are
(article, main; nav, aside, footer, form, and class names such as sidebar or comments). From the
texts of the sample, `layouts` further pages per sampled page are laid out with other containers
and class names, or none, with notices, adverts, forms, sidebars and reader comments in and around
the article, so that the labeller does not lean on one site's layout. Every page of the table is
labelled, with all its blocks and words.

Defined results: a null or empty page, and one without main text, has an empty text; a page of one
block without markup is read like any other; repeated rows are read one by one; without any text
to train on all texts are empty; an empty table gives no rows; a very long page is read step by
step, in memory linear in its length; columns with the names of results are replaced.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkseries.llm.markup import PATH_BUCKETS, Block, blocks, named
from sparkseries.llm.words import ALNUM_LOWER, slices, words

WORD_BUCKETS = 2048
PATH_DIM, WORD_DIM, MEASURES = 16, 8, 5
HIDDEN = 16
STEPS = 4096  # blocks of a long page at a time
CELLS = 16_384  # blocks of a batch of pages

# Words of class names and ids by which training pages mark what is not the article.
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments cookie cookies footer login menu nav "
    "navbar navigation newsletter notice promo related search share sidebar signup social sponsored subscribe toolbar widget".split())
ASIDE_NAMES = frozenset("nav aside footer form dialog menu".split())
MAIN_NAMES = frozenset("article main".split())
CONTAINERS = (
    ("article", ""), ("main", ""), ("div", 'class="content"'), ("div", 'id="content"'), ("div", 'class="post"'), ("section", 'class="story"'),
    ("div", 'class="entry-content"'), ("div", 'class="article-body"'), ("div", 'id="main"'), ("div", ""), ("td", ""), ("section", ""))
OTHERS = {  # where it stands: (element, attributes, element of a block, kind of its texts)
    "top": (
        ("nav", "", "li", "links"), ("ul", 'class="menu"', "li", "links"), ("div", 'id="navigation"', "a", "links"), ("div", 'class="breadcrumbs"', "span", "links"),
        ("div", 'class="main-menu"', "li", "links"), ("div", "", "a", "links"), ("header", "", "div", "short"), ("div", 'id="header"', "h2", "short"),
        ("header", 'class="site-header"', "p", "short"), ("div", 'class="site-branding"', "p", "short"), ("div", 'class="logo"', "", "short")),
    "beside": (
        ("aside", "", "p", "text"), ("div", 'class="sidebar"', "div", "text"), ("aside", 'id="sidebar"', "li", "links"), ("div", 'class="related"', "li", "links"),
        ("div", 'class="widget-area"', "h3", "short"), ("div", 'class="widget"', "li", "links"), ("div", "", "li", "links"),
        ("div", 'class="notice"', "p", "text"), ("div", 'class="cookie-banner"', "p", "text"), ("div", 'id="notice"', "div", "short"),
        ("div", 'class="alert"', "", "text"), ("div", 'class="consent"', "p", "text")),
    "advert": (
        ("div", 'class="ad"', "", "text"), ("div", 'class="advert"', "p", "text"), ("div", 'class="sponsored"', "div", "short"), ("div", 'class="promo"', "p", "text"),
        ("div", 'class="adsbygoogle"', "", "text"), ("div", 'id="ad-slot"', "", "short"), ("aside", 'class="sponsor"', "p", "text"),
        ("form", "", "label", "short"), ("form", 'class="search"', "button", "short"), ("div", 'class="newsletter"', "p", "short"), ("div", 'class="login-form"', "div", "short"),
        ("div", 'class="share"', "a", "links")),
    "comments": (
        ("section", 'class="comments"', "p", "text"), ("div", 'id="comments"', "p", "text"), ("ol", 'class="commentlist"', "li", "text"), ("div", 'class="comment"', "p", "text"),
        ("div", 'id="respond"', "h3", "short"), ("div", 'class="replies"', "div", "text"), ("div", 'id="disqus"', "p", "text")),
    "bottom": (
        ("footer", "", "p", "short"), ("footer", "", "", "text"), ("div", 'id="footer"', "p", "text"), ("div", 'class="footer"', "li", "links"),
        ("div", 'class="copyright"', "", "short"), ("div", 'class="colophon"', "", "short"), ("div", 'class="site-info"', "p", "short"), ("center", "", "", "short"))}


def marked_region(name: str, rest: str, outer: str | None) -> str | None:
    """What a training page's element says it is: main, other, or as the element around it."""
    said = rest.find("data-region=")
    if said >= 0:
        return rest[said + 13 : rest.index('"', said + 13)]
    if outer == "other":
        return outer
    tokens = named(rest)
    if name in ASIDE_NAMES or (name == "header" and outer != "main") or not ASIDE_WORDS.isdisjoint(tokens):
        return "other"
    return "main" if name in MAIN_NAMES or "main" in tokens or "body" in tokens and "article" in tokens else outer


def escaped(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def laid_out(paragraphs: list[str], scraps: list[str], rng: random.Random) -> str:
    """A page with these paragraphs as its article, in a layout of its own."""

    def scrap(kind: str) -> str:
        taken = rng.choice(scraps).split()
        n = rng.randint(1, 4) if kind == "links" else rng.randint(1, 8) if kind == "short" else rng.randint(5, 60)
        at = rng.randrange(max(1, len(taken) - n + 1))
        return escaped(" ".join(taken[at : at + n]))

    def other(*kinds: tuple[str, str, str, str]) -> str:
        name, attributes, inner, texts = rng.choice(kinds)
        many = rng.randint(2, 8) if texts == "links" else rng.randint(1, 4) if inner else 1
        items = []
        for _ in range(many):
            s = scrap(texts)
            s = f'<a href="/x">{s}</a>' if texts == "links" and inner != "a" else s
            items.append(f"<{inner}>{s}</{inner}>" if inner else s)
        return f'<{name} {attributes} data-region="other">{"".join(items)}</{name}>'

    name, attributes = rng.choice(CONTAINERS)
    body = []
    if rng.random() < 0.8:
        title = f"<h1>{escaped(' '.join(paragraphs[0].split()[:12]))}</h1>"
        body.append(f"<header>{title}</header>" if rng.random() < 0.2 else title)
    for k, p in enumerate(paragraphs):
        p = escaped(p)
        style = rng.random()
        if style < 0.05 and k:
            body.append(f"<h2>{' '.join(p.split()[:6])}</h2>")
        inside = rng.choice(("p", "p", "p", "p", "div", "li", "blockquote"))
        if style > 0.9:
            cut = p.split()
            half = len(cut) // 2
            p = " ".join(cut[:half]) + f' <a href="/y">{" ".join(cut[half : half + 3])}</a> ' + " ".join(cut[half + 3 :])
        body.append(f"<p><b>{p}<br>" if style < 0.15 and inside == "p" else f"<{inside}>{p}</{inside}>")
        if rng.random() < 0.06:
            body.append(other(*OTHERS["advert"], *OTHERS["beside"]))
    if rng.random() < 0.15:
        body.append(other(*OTHERS["comments"]))
    article = f'<{name} {attributes} data-region="main">{"".join(body)}</{name}>'
    if name == "td":
        article = f"<table><tr>{article}</tr></table>"
    before = [other(*OTHERS["top"], *OTHERS["beside"], *OTHERS["advert"]) for _ in range(rng.randint(0, 4))]
    after = [other(*OTHERS["beside"], *OTHERS["advert"], *OTHERS["comments"]) for _ in range(rng.randint(0, 3))]
    after += [other(*OTHERS["bottom"]) for _ in range(rng.randint(0, 2))]
    page = "".join(before + [article] + after)
    for _ in range(rng.randint(0, 3)):
        page = f'<div {rng.choice(["", "class=\"wrapper\"", "id=\"page\"", "class=\"container row\"", "class=\"x1\""])}>{page}</div>'
    return f"<html><head><title>t</title></head><body>{page}</body></html>"


class Features(NamedTuple):
    """Blocks of some pages: path buckets and word buckets with their block numbers' bounds,
    measures, and each page's first block."""

    path: np.ndarray
    path_first: np.ndarray
    word: np.ndarray
    word_first: np.ndarray
    measures: np.ndarray
    first: np.ndarray


def features(pages: list[list[Block]]) -> Features:
    flat = [b for page in pages for b in page]
    path = np.fromiter((t for b in flat for t in b.path), np.int64)
    path_first = np.cumsum([0, *(len(b.path) for b in flat)])
    texts = pa.array([b.text for b in flat], pa.large_string())
    found, counts = [], [np.zeros(1, np.int64)]
    for part in slices(texts):
        w = words(part, ALNUM_LOWER)
        found.append((w.hash % np.uint64(WORD_BUCKETS)).astype(np.int64))
        counts.append(w.counts)
    word = np.concatenate(found) if found else np.zeros(0, np.int64)
    word_first = np.cumsum(np.concatenate(counts))
    chars = np.array([len(b.text) for b in flat], np.float64)
    stops = np.array([b.text[-1] in ".!?:;\"'" if b.text else False for b in flat], np.float64)
    links = np.array([b.links for b in flat])
    count = np.diff(word_first)
    measures = np.stack([np.log1p(chars) / 6, links, stops, np.log1p(count) / 5, np.minimum(chars / (count + 1), 20) / 10], axis=1)
    return Features(path, path_first, word, word_first, measures.astype(np.float32), np.cumsum([0, *(len(p) for p in pages)]))


class Labeller(NamedTuple):
    """Weights: path and word embeddings; per direction input, recurrent and bias; output."""

    path: np.ndarray
    word: np.ndarray
    w: tuple[np.ndarray, np.ndarray]
    u: tuple[np.ndarray, np.ndarray]
    b: tuple[np.ndarray, np.ndarray]
    out: np.ndarray  # both directions
    bias: np.ndarray


def bag(table: np.ndarray, ids: np.ndarray, first: np.ndarray, power: float, portion: int = 1 << 18) -> np.ndarray:
    """Sum of the embeddings of each block's ids, divided by their number to the power."""
    n = np.diff(first)
    out = np.zeros((len(n), table.shape[1]), np.float32)
    at = 0
    while at < len(n):  # a bounded number of ids at a time
        to = max(at + 1, int(np.searchsorted(first, first[at] + portion, side="right")) - 1)
        for lo in range(first[at], first[to], portion):  # more than once for a very long block
            hi = min(lo + portion, first[to])
            owner = np.repeat(np.arange(at, to), n[at:to])[lo - first[at] : hi - first[at]]
            for d in range(table.shape[1]):
                out[at:to, d] += np.bincount(owner - at, table[ids[lo:hi], d], minlength=to - at).astype(np.float32)
        at = to
    return out / np.maximum(n, 1)[:, None].astype(np.float32) ** power


def inputs(f: Features, path: np.ndarray, word: np.ndarray) -> np.ndarray:
    return np.concatenate([bag(path, f.path, f.path_first, 0.5), bag(word, f.word, f.word_first, 1.0), f.measures], axis=1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def run_lstm(x: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray, h: np.ndarray, c: np.ndarray, keep: bool = False):
    """Hidden states (steps, pages, HIDDEN) over x (steps, pages, inputs), the last state, and if
    wanted what the backward pass needs."""
    steps, pages, _ = x.shape
    n = h.shape[1]
    pre = (x.reshape(steps * pages, -1) @ w + b).reshape(steps, pages, 4 * n)
    states = np.empty((steps, pages, n), np.float32)
    kept = []
    for t in range(steps):
        z = pre[t] + h @ u
        gates = sigmoid(z[:, : 3 * n])
        new = np.tanh(z[:, 3 * n :])
        before = c
        c = gates[:, n : 2 * n] * c + gates[:, :n] * new
        squashed = np.tanh(c)
        if keep:
            kept.append((gates, new, before, squashed, h))
        h = gates[:, 2 * n :] * squashed
        states[t] = h
    return states, (h, c), kept


def back_lstm(x: np.ndarray, w: np.ndarray, u: np.ndarray, grad: np.ndarray, kept):
    """Gradients of the input, w, u and b, given those of the hidden states."""
    steps, pages, size = x.shape
    n = u.shape[0]
    g_pre = np.empty((steps, pages, 4 * n), np.float32)
    g_u = np.zeros_like(u)
    g_h, g_c = np.zeros((pages, n), np.float32), np.zeros((pages, n), np.float32)
    for t in range(steps - 1, -1, -1):
        gates, new, before, squashed, h = kept[t]
        i, f, o = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :]
        g_h = g_h + grad[t]
        g_c = g_c + g_h * o * (1 - squashed**2)
        z = np.concatenate([g_c * new * i * (1 - i), g_c * before * f * (1 - f), g_h * squashed * o * (1 - o), g_c * i * (1 - new**2)], axis=1)
        g_pre[t] = z
        g_u += h.T @ z
        g_h, g_c = z @ u.T, g_c * f
    flat = g_pre.reshape(-1, 4 * n)
    return (flat @ w.T).reshape(x.shape), x.reshape(-1, size).T @ flat, g_u, flat.sum(axis=0)


def places(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Block numbers of pages as (steps, pages), forward and backward; -1 beyond a page's end."""
    n = np.diff(first)
    t = np.arange(n.max())[:, None]
    inside = t < n
    return np.where(inside, first[:-1] + t, -1), np.where(inside, first[1:] - 1 - t, -1)


def start(seed: int = 11) -> Labeller:
    rng = np.random.default_rng(seed)
    size = PATH_DIM + WORD_DIM + MEASURES
    make = lambda *shape: rng.normal(0, 0.2, shape).astype(np.float32)
    bias = np.zeros(4 * HIDDEN, np.float32)
    bias[HIDDEN : 2 * HIDDEN] = 1  # remember at first
    return Labeller(make(PATH_BUCKETS, PATH_DIM), make(WORD_BUCKETS, WORD_DIM), (make(size, 4 * HIDDEN), make(size, 4 * HIDDEN)),
                    (make(HIDDEN, 4 * HIDDEN), make(HIDDEN, 4 * HIDDEN)), (bias.copy(), bias.copy()), make(2 * HIDDEN), np.zeros(1, np.float32))


def spread(ids: np.ndarray, first: np.ndarray, grad: np.ndarray, power: float, size: int) -> np.ndarray:
    """Gradient of an embedding table from those of the bags."""
    n = np.diff(first)
    g = np.repeat(grad / np.maximum(n, 1)[:, None] ** power, n, axis=0)
    return np.stack([np.bincount(ids, g[:, d], minlength=size) for d in range(g.shape[1])], axis=1)


def train(pages: list[list[Block]], passes: int = 6, batch: int = 16, rate: float = 0.01, most: int = 150, seed: int = 11) -> Labeller:
    """Adam on the logistic loss of the marked blocks. A page is shown in parts of at most `most`
    blocks, here only."""
    parts = [page[at : at + most] for page in pages for at in range(0, len(page), most)]
    parts = [p for p in parts if any(b.region for b in p)]
    net = start(seed)
    if not parts:
        return net
    params = [net.path, net.word, *net.w, *net.u, *net.b, net.out, net.bias]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    rng = np.random.default_rng(seed)
    step = 0
    parts.sort(key=len)
    groups = [parts[at : at + batch] for at in range(0, len(parts), batch)]  # alike in length
    ready = [(features(g), np.array([b.region == "main" for p in g for b in p]), np.array([b.region is not None for p in g for b in p])) for g in groups]
    total = passes * len(groups)
    for _ in range(passes):
        for k in rng.permutation(len(groups)):
            f, main, said = ready[k]
            x = inputs(f, params[0], params[1])
            padded = np.concatenate([x, np.zeros((1, x.shape[1]), np.float32)])
            grids = places(f.first)
            logit = np.zeros(len(x), np.float32)
            runs = []
            for d, grid in enumerate(grids):
                h = np.zeros((grid.shape[1], HIDDEN), np.float32)
                states, _, kept = run_lstm(padded[grid], params[2 + d], params[4 + d], params[6 + d], h, h, keep=True)
                runs.append((states, kept))
                logit[grid[grid >= 0]] += states[grid >= 0] @ params[8][d * HIDDEN : (d + 1) * HIDDEN]
            g_logit = (sigmoid(logit + params[9]) - main) * said / max(said.sum(), 1)
            grads = [np.zeros_like(p) for p in params]
            grads[9][0] = g_logit.sum()
            g_x = np.zeros_like(x)
            for d, (grid, (states, kept)) in enumerate(zip(grids, runs)):
                inside = grid >= 0
                g = np.where(inside, np.append(g_logit, 0)[grid], 0).astype(np.float32)
                own = slice(d * HIDDEN, (d + 1) * HIDDEN)
                grads[8][own] = (states * g[:, :, None]).sum(axis=(0, 1))
                back, grads[2 + d], grads[4 + d], grads[6 + d] = back_lstm(padded[grid], params[2 + d], params[4 + d], g[:, :, None] * params[8][own], kept)
                g_x[grid[inside]] += back[inside]
            grads[0] = spread(f.path, f.path_first, g_x[:, :PATH_DIM], 0.5, PATH_BUCKETS)
            grads[1] = spread(f.word, f.word_first, g_x[:, PATH_DIM : PATH_DIM + WORD_DIM], 1.0, WORD_BUCKETS)
            step += 1
            now = rate * min(1.0, 2 * (1 - step / (total + 1)))
            for i, (p, g) in enumerate(zip(params, grads)):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.99 * second[i] + 0.01 * g * g
                p -= (now * first[i] / (1 - 0.9**step) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return Labeller(params[0], params[1], tuple(params[2:4]), tuple(params[4:6]), tuple(params[6:8]), params[8], params[9])


def main_share(net: Labeller, pages: list[list[Block]]) -> list[np.ndarray]:
    """The probability of being main text, for each block of each page."""
    order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
    out: list[np.ndarray] = [np.zeros(0)] * len(pages)
    at = 0
    while at < len(order):
        to = at + 1
        while to < len(order) and (to + 1 - at) * len(pages[order[to]]) <= CELLS:
            to += 1
        group = [pages[i] for i in order[at:to]]
        if group[-1]:
            f = features(group)
            x = inputs(f, net.path, net.word)
            logit = np.full(len(x), net.bias[0], np.float32)
            padded = np.concatenate([x, np.zeros((1, x.shape[1]), np.float32)])
            for d, grid in enumerate(places(f.first)):
                state = (np.zeros((grid.shape[1], HIDDEN), np.float32),) * 2
                for t in range(0, len(grid), STEPS):
                    part = grid[t : t + STEPS]
                    states, state, _ = run_lstm(padded[part], net.w[d], net.u[d], net.b[d], *state)
                    logit[part[part >= 0]] += states[part >= 0] @ net.out[d * HIDDEN : (d + 1) * HIDDEN]
            for i, p in zip(order[at:to], np.split(sigmoid(logit), f.first[1:-1])):
                out[i] = p
        at = to
    return out


def training_pages(pages: DataFrame, html: str, key: str, sample_pages: int, sample_chars: int, layouts: int, seed: int = 5) -> list[list[Block]]:
    """The marked blocks of the sampled pages and of the pages laid out from their texts."""
    draw = F.pmod(F.xxhash64(F.col(key).cast("string"), html), F.lit(1 << 40))
    short = pages.where(F.octet_length(html).between(1, sample_chars)).select(F.col(html).alias("html"), draw.alias("draw"))
    # About three times the sample by hash, then the exact number: tasks send no more than that together.
    most = int((1 << 40) * min(1.0, 3 * sample_pages / max(short.count(), 1))) + 1
    rows = short.where(F.col("draw") < most).orderBy("draw", "html").limit(sample_pages).collect()
    sample = [blocks(r["html"], marked_region) for r in rows]
    rng = random.Random(seed)
    out = [page for page in sample if any(b.region == "main" for b in page)]
    scraps = [b.text for page in sample for b in page]
    stories = [[b.text for b in page if b.region == "main"] or [b.text for b in page] for page in sample if page]
    for story in stories:
        for _ in range(layouts):
            at = rng.randrange(len(story))
            out.append(blocks(laid_out(story[at : at + rng.randint(1, 12)], scraps, rng), marked_region))
    return out


def fit_labeller(pages: DataFrame, html: str = "html", key: str = "page_id", sample_pages: int = 250, sample_chars: int = 50_000,
                 layouts: int = 4) -> Labeller | None:
    """Train on the bounded sample; None if it has no text."""
    sample = training_pages(pages, html, key, sample_pages, sample_chars, layouts)
    return train(sample) if any(sample) else None


def with_article(pages: DataFrame, net: Labeller | None, html: str = "html", least: float = 0.5) -> DataFrame:
    """All rows and columns of `pages`, but the html, plus text, n_chars and n_blocks (those kept)."""
    rest = [c for c in pages.columns if c not in ("text", "n_chars", "n_blocks", html)]
    rows = pages.select(*rest, html)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, kept = [], []
            for part in slices(batch.column(len(rest))):
                found = [blocks(part.data[a:b].tobytes().decode("utf-8", "replace")) for a, b in zip(part.offsets, part.offsets[1:])]
                shares = main_share(net, found) if net else [np.zeros(len(p)) for p in found]
                for page, p in zip(found, shares):
                    main = [b.text for b, v in zip(page, p) if v >= least]
                    texts.append("\n".join(main))
                    kept.append(len(main))
            arrays = [*batch.columns[: len(rest)], pa.array(texts, pa.string()), pa.array(kept, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [*rest, "text", "n_blocks"])

    schema = rows.select(*rest, F.lit("").alias("text"), F.lit(0).cast("long").alias("n_blocks")).schema
    out = rows.mapInArrow(run, schema)
    return out.select(*rest, "text", F.char_length("text").cast("long").alias("n_chars"), "n_blocks")


def articles(pages: DataFrame, html: str = "html", key: str = "page_id", **sample) -> DataFrame:
    """Fit on a sample of the pages, then extract the main text of all."""
    return with_article(pages, fit_labeller(pages, html, key, **sample), html)
