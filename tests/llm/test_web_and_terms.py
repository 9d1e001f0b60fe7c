"""Source divergence, page extraction and fill-in-the-middle forms against plain Python."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkseries.llm import articles as A
from sparkseries.llm import divergence as D
from sparkseries.llm.infill import UNIT, infilled, restored
from sparkseries.llm.markup import blocks

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")

# ------------------------------------------------------------------ divergence


def by_hand(rows, least, top):
    df, cnt, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = TERM.findall((text or "").translate(LOWER))
        df[lang].update(set(terms))
        cnt[lang, source].update(terms)
    gap = lambda p, q: (p - q) ** 2 // (p + q)
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in df[lang].items() if n >= least]
        sources = [s for own, s in groups if own == lang]

        def shares(count):
            below = sum(count[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 2) // below for t in kept}

        whole = Counter()
        for s in sources:
            whole.update(cnt[lang, s])
        q, of = shares(whole), {s: shares(cnt[lang, s]) for s in sources}
        for s in sources:
            pairs = sorted((-sum(gap(of[s][t], of[o][t]) for t in kept), o.encode(), o) for o in sources if o != s)
            terms = sorted((-gap(of[s][t], q[t]), t.encode(), t) for t in kept if cnt[lang, s][t] and of[s][t] > q[t])[:top]
            for part, found in (("pair", pairs), ("term", terms)):
                out += [(lang, s, part, item, -v, i + 1) for i, (v, _, item) in enumerate(found)]
    return sorted(out)


def term_rows(seed, n=400):
    rng = random.Random(seed)
    vocabulary = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["É", "ß", "Über-all", "it's", "a1b", "x,y", "THE", "the"]
    rows = []
    for _ in range(n):
        words = [rng.choice(vocabulary[: rng.choice((5, 20, 68))]) + rng.choice(["", "", ",", "."]) for _ in range(rng.randrange(0, 30))]
        rows.append((" ".join(words), rng.choice(["en", "en", "de", None]), rng.choice(["a", "b", "é", "Z", None])))
    return rows


@pytest.mark.parametrize("least, block", [(10, 8 << 20), (10, 300), (3, 300), (70, 1000), (10_000, 300)])
def test_divergences_equal_those_by_hand(spark, monkeypatch, least, block):
    monkeypatch.setattr(D, "BLOCK_BYTES", block)
    monkeypatch.setattr(D, "ROWS", max(block // 20, 20))
    rows = term_rows(least) + [("", "fr", "only"), (None, "fr", "two"), ("12 34", "en", "numbers"), ("one " * 40, "xx", "s"), ("one " * 40, "xx", "s")]
    docs = spark.createDataFrame([(i, *r, "old") for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, value string").repartition(3)
    assert sorted(map(tuple, D.divergences(docs, least, 5).collect())) == by_hand(rows, least, 5)


def test_documents_of_a_term_are_counted_over_all_its_chunks(spark):
    # "the" in 9 + 1 documents by two chunks, "cat" in 9 by two chunks that share documents
    rows = [("the cat", "en", "a")] * 9 + [("The,", "en", "b")] + [("cat. cat", "en", "b")] * 0
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    assert {r["term"]: sum(r["n"]) for r in D.term_counts(docs, 10)[0].collect()} == {"the": 10}
    both = spark.createDataFrame([("cat cat, cat.", "en", "a")] * 9, "text string, lang string, source string")
    assert D.term_counts(both, 10)[0].count() == 0 and D.term_counts(both, 9)[0].collect()[0]["n"] == [27]


def test_divergence_of_nothing_and_of_long_texts(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert D.divergences(empty).count() == 0
    long = [("alpha beta " * 150_000, "en", "a"), ("x" * 2_000_000 + " alpha", "en", "b"), ("beta", "en", "b")]
    docs = spark.createDataFrame(long, "text string, lang string, source string")
    assert sorted(map(tuple, D.divergences(docs, 2, 5).collect())) == by_hand(long, 2, 5)


def test_shares_are_exact_for_large_counts(spark):
    n, total, size = 700_000_000_000, 5_000_000_000_001, 1_234_567
    row = spark.range(1).select(D.share(F.lit(n), F.lit(total), F.lit(size)).alias("p"), D.share(F.lit(0), F.lit(0), F.lit(0)).alias("q")).collect()[0]
    assert row["p"] == 1 + 10**9 * (n + 2) // (total + 2 * size) and row["q"] is None


# ------------------------------------------------------------------ infill


def cut_by_hand(doc_id, text, plain=10, spm=20):
    text = text or ""
    units = re.findall(UNIT, text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100 - plain:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


INFILL_TEXTS = [None, "", "a", " ", "\n\n", "Hello world, é ß x.", "a<P>b", "<S>", "x <M", "<P", "😀 a😀b́ c", "tab\tand\r\nlines\x00\x0b", "$1 \\2 {3}+", "ab " * 3000, "  a\u0085b"]


@pytest.mark.parametrize("plain, spm", [(10, 20), (0, 50), (100, 0)])
def test_infilled_texts_equal_those_by_hand(spark, plain, spm):
    rows = [(i * 7 + k, t, "old") for k in range(5) for i, t in enumerate(INFILL_TEXTS)] + [(None, "a null id", "old"), (3, "same id", "old"), (3, "same id", "old")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string")
    out = infilled(docs, plain=plain, spm=spm).withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    want = [cut_by_hand(i, t, plain, spm) for i, t, _ in rows]
    assert [(r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in out] == want
    assert [r["back"] for r in out] == [t or "" for _, t, _ in rows]


def test_infilled_long_texts_other_markers_and_names(spark):
    long = "ab😀 c,\n" * 400_000
    docs = spark.createDataFrame([(4, long, 1, 2, 3), (5, "x" * 2_000_000, 1, 2, 3)], "key long, body string, n int, cut int, draws int")
    out = infilled(docs, "key", "body", plain=0, markers=("[$1]", "{s}", "|m\\"))
    rows = out.withColumn("back", restored(F.col("output"), F.col("form"), ("[$1]", "{s}", "|m\\"))).collect()
    assert [r["back"] for r in rows] == [long, "x" * 2_000_000] and [r["n"] for r in rows] == [2_400_000, 1]
    assert [r["cut"] for r in rows] == [2, 2] and [r["draws"] for r in rows] == [3, 3] and out.columns == ["key", "body", "cut", "draws", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert infilled(docs.limit(0), "key", "body").count() == 0


# ------------------------------------------------------------------ pages


def texts(html):
    return [b.text for b in blocks(html)]


def test_blocks_of_tag_soup():
    assert texts("") == [] and texts("only text &amp; more") == ["only text & more"]
    assert texts("<p>a<p>b <b>bold</b>, x<br>y</p>c") == ["a", "b bold, x y", "c"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul></ul>d") == ["a", "b", "c", "d"]
    assert texts("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]
    assert texts("<!-- a <p>b</p> -->c<!doctype x><!-->d") == ["cd"]
    assert texts("<script>var t='</p><p>x';</script><STYLE>p{}</style><title>t</title>a<textarea>b</textarea>") == ["a"]
    assert texts("<script>never ends <p>x</p>") == [] and texts("a<!-- never ends <p>x") == ["a"] and texts("a<p class='x") == ["a"]
    assert texts('<p title="a > b" class=c>x</p><p title=\'">\'>y</p><a href="it\'s">z</a>') == ["x", "y", "z"]
    assert texts("1 < 2 <p>3 > 2 </ >x</>y</p>") == ["1 < 2", "3 > 2 xy"]
    assert texts("<p>&lt;b&gt; &eacute;&#233;&#xE9; &copy &am &nosuch;&nbsp;z</p>") == ["<b> ééé © &am &nosuch; z"]
    assert texts("</p></div>a</span>b</p>c") == ["ab", "c"]
    assert [round(b.links, 2) for b in blocks("<p><a>aaaa</a>bbbb</p><p>c</p><a>d")] == [0.5, 0, 1]


def test_blocks_are_linear_in_odd_pages():
    for html in ("<div>" * 100_000 + "x", "<p>" * 100_000 + "x", '<a b="' * 50_000, "</b>" * 100_000 + "x", "<" * 200_000, "&" * 100_000, "<b><p>" * 30_000 + "x"):
        assert len(blocks(html)) <= 1


def story(rng, n):
    pool = [f"{rng.choice('bdfgklmnprst')}{rng.choice('aeiou')}{rng.choice('lmnrst')}{rng.choice(['', 'a', 'en', 'ing'])}" for _ in range(150)]
    return [" ".join(rng.choice(pool) for _ in range(rng.randint(8, 40))).capitalize() + "." for _ in range(n)]


def page(rng, paragraphs, kind):
    menu = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in story(rng, 1)[0].split()[:6])
    head = f"<html><head><title>{paragraphs[0]}</title><script>var x='</p>';</script></head><body>"
    body = "".join(f"<p>{A.escaped(p)}</p>" for p in paragraphs[1:])
    aside = story(rng, 1)[0]
    if kind == 0:
        return f'{head}<nav><ul>{menu}</ul></nav><div class="ad">{aside}</div><article><h1>{paragraphs[0]}</h1>{body}</article><footer>&copy; {aside}</footer></body></html>'
    return (f'{head}<div id="top-menu"><ul>{menu}</ul></div><div class="post-content"><h1>{paragraphs[0]}</h1>{body}</div>'
            f'<div class="sidebar-left"><p>{aside}</p></div><div id="comments-area"><div class="comment">{aside}</div></div><div class="site-footer">{aside}</div>')


@pytest.fixture(scope="module")
def site():
    rng = random.Random(4)
    rows, want = [], []
    for i in range(120):
        paragraphs = story(rng, rng.randint(2, 9))
        rows.append((i, f"http://x/{i}", page(rng, paragraphs, 0 if i < 100 else 1), "old"))
        want.append("\n".join(paragraphs))
    return rows, want


def test_articles_of_pages_also_of_layouts_without_labels(spark, site):
    rows, want = site
    rows = rows + [(200, "u", None, "old"), (201, "u", "", "old"), (202, "u", "<script>x</script>", "old"), (0, "u", rows[0][2], "old")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    net = A.fit_labeller(pages.where("page_id < 80"))
    out = A.with_article(pages, net).collect()
    got = {(r["page_id"], r["url"]): r for r in out}
    exact = [got[i, f"http://x/{i}"]["text"] == w for i, w in enumerate(want)]
    assert all(exact[:100]) and sum(exact[100:]) >= 19
    assert [got[i, "u"]["text"] for i in (200, 201, 202)] == [""] * 3 and got[0, "u"]["text"] == want[0]
    assert all(r["n_chars"] == len(r["text"]) for r in out) and len(out) == len(rows)
    again = A.with_article(pages, A.fit_labeller(pages.where("page_id < 80").repartition(5))).collect()
    assert {(r["page_id"], r["url"]): r["text"] for r in again} == {k: r["text"] for k, r in got.items()}
    assert A.articles(pages.limit(0)).count() == 0
    assert [r["text"] for r in A.articles(pages.where("page_id in (200, 201)")).collect()] == ["", ""]


def test_long_pages_are_read_in_parts_like_in_one(spark, site, monkeypatch):
    rng = random.Random(8)
    net = A.train([blocks(r[2], A.marked_region) for r in site[0][:40]])
    paragraphs = story(rng, 6000) + ["long " * 300_000]
    found = [blocks(page(rng, paragraphs, 0)), blocks(site[0][0][2]), [], blocks("x")]
    one = A.main_share(net, found)
    monkeypatch.setattr(A, "STEPS", 7)
    monkeypatch.setattr(A, "CELLS", 1)
    for a, b in zip(one, A.main_share(net, found)):
        assert np.allclose(a, b, atol=1e-5)
    kept = {b.text for b, v in zip(found[0], one[0]) if v >= 0.5}
    assert sum(" ".join(p.split()) in kept for p in paragraphs) > 0.999 * len(paragraphs)


def test_labeller_equals_a_plain_forward_pass_and_its_gradients(site):
    found = [blocks(r[2], A.marked_region) for r in site[0][:3]]
    net = A.train(found, passes=1)
    f = A.features(found)

    def vector(block):
        path = sum(net.path[t] for t in block.path) / len(block.path) ** 0.5
        hashes = [h for part in A.slices(pa.array([block.text], pa.large_string())) for h in A.words(part, A.ALNUM_LOWER).hash]
        word = sum(net.word[int(h) % A.WORD_BUCKETS] for h in hashes) / max(len(hashes), 1)
        return np.concatenate([path, word, np.zeros(A.MEASURES)])

    def step(x, h, c, d):
        z = x @ net.w[d] + h @ net.u[d] + net.b[d]
        i, g, o = (1 / (1 + np.exp(-z[k * A.HIDDEN : (k + 1) * A.HIDDEN])) for k in range(3))
        c = g * c + i * np.tanh(z[3 * A.HIDDEN :])
        return o * np.tanh(c), c

    at = 0
    for page_blocks, shares in zip(found, A.main_share(net, found)):
        x = [vector(b) for b in page_blocks]
        for k in range(len(x)):
            x[k][-A.MEASURES :] = f.measures[at + k]
        logit = np.full(len(x), net.bias[0], np.float64)
        for d, order in enumerate((range(len(x)), range(len(x) - 1, -1, -1))):
            h = c = np.zeros(A.HIDDEN)
            for k in order:
                h, c = step(x[k], h, c, d)
                logit[k] += h @ net.out[d * A.HIDDEN : (d + 1) * A.HIDDEN]
        assert np.allclose(shares, 1 / (1 + np.exp(-logit)), atol=1e-4)
        at += len(x)


def test_gradients_of_the_recurrent_layer():
    rng = np.random.default_rng(1)
    x, w, u, b = rng.normal(size=(5, 3, 4)), rng.normal(size=(4, 4 * 2)), rng.normal(size=(2, 4 * 2)), rng.normal(size=8)
    weight = rng.normal(size=(5, 3, 2))
    zero = np.zeros((3, 2))

    def loss():
        return float((A.run_lstm(x, w, u, b, zero, zero)[0] * weight).sum())

    _, _, kept = A.run_lstm(x, w, u, b, zero, zero, keep=True)
    grads = A.back_lstm(x, w, u, weight, kept)
    for value, grad in zip((x, w, u, b), grads):
        for at in list(np.ndindex(value.shape))[::3]:
            old = value[at]
            value[at] = old + 1e-3
            up = loss()
            value[at] = old - 1e-3
            down = loss()
            value[at] = old
            assert abs((up - down) / 2e-3 - grad[at]) < 1e-2
