"""Language network and quality ranking against plain Python, text by text."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkseries.llm import language as L
from sparkseries.llm import ranking as R

TEXTS = ["", " ", "a", "Plain words, in a line.", "ÄÖÜ ß été 12 34!\nSecond line | here", "x " * 300, "Is? it! SO; very: short.\n\nIs? it!", "word" * 200,
         "the the the the", "#*$%& <>|", "tabs\tand\x0bmore\r\nlines.\nlines.\nlines."]


def plain_language(net, text):
    """Mean log probabilities over the windows of a text, weighted by real bytes."""
    raw = text.encode()
    total = np.zeros(len(net.langs))
    cuts = [raw[i:i + L.WINDOW] for i in range(0, max(len(raw), 1), L.WINDOW)]
    for cut in cuts:
        window = list(cut) + [0] * (L.WINDOW - len(cut))
        hidden = []
        for bank in net.banks:
            width = bank.shape[0] // net.embed.shape[1]
            best = [-math.inf] * bank.shape[1]
            for i in range(L.WINDOW - width + 1):
                x = np.concatenate([net.embed[b] for b in window[i:i + width]])
                best = np.maximum(best, x @ bank)
            hidden += list(best)
        hidden = np.maximum(np.array(hidden) + net.bias, 0)
        logits = hidden @ net.out + net.out_bias
        total += (logits - logits.max() - math.log(np.exp(logits - logits.max()).sum())) * max(len(cut), 1)
    total /= max(len(raw), 1)
    p = np.exp(total - total.max())
    return p / p.sum()


def test_language_of_texts_equals_a_plain_forward_pass(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(pool) for _ in range(30)), lang) for i in range(60)
            for pool, lang in [(("the", "and", "with", "thing"), "en") if i % 2 else (("der", "und", "mit", "schön"), "de")]]
    net = L.fit_language(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    texts = TEXTS + [rows[0][1], rows[1][1], (rows[0][1] + " ") * 20]
    out = L.with_language(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), net).orderBy("doc_id").collect()
    for r, text in zip(out, texts):
        if not any(c.isalpha() for c in text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        p = plain_language(net, text)
        assert r.score == pytest.approx(p.max(), abs=1e-4) and (p.max() - sorted(p)[-2] < 1e-3 or r.lang_pred == net.langs[int(p.argmax())])


def plain_measures(text):
    """The measures of one text, by name."""
    raw, w = text.encode(), re.findall(r"[^\x20\x09-\x0D]+", text)
    low = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in w]
    n, size = len(w), len(raw)
    per = lambda a, b: a / max(b, 1)
    grams = [tuple(low[i:i + 3]) for i in range(n - 2)]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    ends = [re.findall(r"[^\x20\x09-\x0D]+", x)[-1] for x in lines]
    ascii_ = lambda chars: sum(chr(b) in chars for b in raw)
    return {
        "log_words": math.log1p(n), "word_length": per(size, n), "upper": per(sum(65 <= b < 91 for b in raw), size), "digits": per(sum(48 <= b < 58 for b in raw), size),
        "symbols": per(ascii_(R.SYMBOLS), size), "stops": per(ascii_(".,;:"), n), "shouts": per(ascii_("!?"), n), "bytes_over_127": per(sum(b > 127 for b in raw), size),
        "lone_separators": per(sum(x in R.SEPARATORS and len(x) == 1 for x in w), n), "distinct_words": per(len(set(low)), n),
        "word_runs": per(sum(a == b for a, b in zip(low, low[1:])), n), "repeated_windows": per(len(grams) - len(set(grams)), n),
        "ended_lines": per(sum(e[-1] in R.TERMINAL for e in ends), len(lines)), "line_words": math.log1p(per(n, len(lines))),
        "repeated_lines": per(len(lines) - len(set(lines)), len(lines)), "capitalised": per(sum("A" <= x[0] <= "Z" for x in w), n),
        "symbol_words": per(sum(x.encode()[-1:].decode("latin-1") in R.SYMBOLS for x in w), n), "short": float(n < 20),
    }


def test_quality_scores_equal_plain_ones(spark):
    rng = random.Random(4)
    good = [" ".join(rng.choice(["some", "words", "make", "a", "sentence"]) for _ in range(40)).capitalize() + "." for _ in range(40)]
    bad = [" ".join(rng.choice(["###", "BUY", "now!!!", "|", "$$$"]) for _ in range(30)) for _ in range(40)]
    texts = TEXTS + good + bad
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    first = len(TEXTS)
    labels = spark.createDataFrame([(first + i, int(i < 40)) for i in range(80)], "doc_id long, quality int")
    out = {r.doc_id: r for r in R.quality_scores(docs, labels, F.lit(True)).collect()}
    x = np.array([[np.float32(plain_measures(t)[m]) for m in R.MEASURES] for t in texts], float)
    found = [r["_measures"] for r in R.with_measures(docs, "text", ["doc_id"]).orderBy("doc_id").collect()]
    assert np.allclose(x, np.array(found), atol=1e-5)
    # The order of the rows does not matter to the fit but through the draws, so the model is taken from the same rows.
    measured = R.with_measures(docs, "text", ["doc_id"]).withColumnRenamed("doc_id", "_id")
    side = lambda lo, hi: R.sample(measured.where(F.col("_id").between(lo, hi - 1)), 8000, hi - lo)
    model = R.fit(side(first, first + 40), side(first + 40, first + 80))
    raw = {i: float(np.clip((v - model.centre) / model.scale, -6, 6) @ model.weights) for i, v in enumerate(x)}
    ordered = sorted(raw[i] for i in range(first, first + 80))
    threshold, spread = (ordered[39] + ordered[40]) / 2, np.std(ordered) / 2 + 1e-9
    agree = 0
    for i in range(len(texts)):
        z = (raw[i] - threshold) / spread + math.log(0.7 / 0.3)
        agree += abs(out[i].score - 1 / (1 + math.exp(-max(-30, min(30, z))))) < 0.02
        assert out[i].predicted == int(out[i].score >= 0.7)
    assert agree >= 0.95 * len(texts)
    assert all(out[first + i].predicted == int(i < 40) for i in range(80))
