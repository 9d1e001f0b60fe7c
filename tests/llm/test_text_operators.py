"""Text operators against plain Python on small tables, with the odd cases of each."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkseries.llm import lm
from sparkseries.llm.decontaminate import contaminated
from sparkseries.llm.language import language_of
from sparkseries.llm.licenses import NOTICES, PHRASES, Pattern, Template, candidates, license_scan, matches, need
from sparkseries.llm.lines import BOILERPLATE, BOILERPLATE_LINE_WORDS, SEPARATORS, SYMBOLS, TERMINAL, cleaned
from sparkseries.llm.lm import lm_scores
from sparkseries.llm.ranking import quality_scores, ranked_value
from sparkseries.llm.words import ALNUM_LOWER, SPACED, SPACED_LOWER, grams, slices, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED_RE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_RE = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

ODD = [None, "", " ", "\n\n", "a", "Ä é ß", "1 2 3 ###", "word " * 40, "x" * 5000, "tab\tand\x0bmore\r\nlines\n", "A a A a A a"]


def alnum(text):
    return ALNUM_RE.findall((text or "").translate(LOWER))


def frame(spark, texts, extra="score"):
    """Documents with ids 0.. and a column whose name clashes with results."""
    return spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], f"doc_id long, text string, {extra} string")


def random_texts(seed, n=40, vocabulary=30):
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(vocabulary)] + ["Éa", "ß", "the", "The"]
    return [" ".join(rng.choice(pool) + rng.choice(["", ".", ",", "\n", " |"]) for _ in range(rng.randrange(0, 120))) for _ in range(n)]


@pytest.mark.parametrize("letters, pattern, lower", [(SPACED, SPACED_RE, False), (SPACED_LOWER, SPACED_RE, True), (ALNUM_LOWER, ALNUM_RE, True)])
def test_words_are_those_of_the_pattern(letters, pattern, lower):
    texts = ODD + random_texts(1)
    seen = {}
    for limit in (1, 200, 1 << 20):
        got = []
        for part in slices(pa.array(texts, pa.string()), limit):
            w = words(part, letters)
            for i in range(len(w.first) - 1):
                raw = [part.data[a:b].tobytes().decode() for a, b in zip(w.start[w.first[i]:w.first[i + 1]], w.end[w.first[i]:w.first[i + 1]])]
                got.append([x.translate(LOWER) if lower else x for x in raw])
                for word, h in zip(raw, w.hash[w.first[i]:w.first[i + 1]]):
                    key = word.translate(LOWER) if lower else word
                    assert seen.setdefault(key, h) == h
        assert got == [pattern.findall((t or "").translate(LOWER) if lower else t or "") for t in texts]
    assert len(set(seen.values())) == len(seen)


def test_long_texts_have_the_hashes_of_short_ones():
    few = [f"word{i} x" for i in range(50)]
    long = " ".join(few * 9000) + " " + "y" * 2_500_000 + " end"
    part = next(slices(pa.array([long])))
    w = words(part, SPACED)
    short = words(next(slices(pa.array([" ".join(few), "y" * 2_500_000 + " end"]))), SPACED)
    assert len(part.data) > 3 << 20 and (w.hash[:100] == short.hash[:100]).all() and (w.hash[900_000 - 100 : 900_000] == w.hash[:100]).all()
    alone = words(next(slices(pa.array(["y" * 2_500_000 + " end"]))), SPACED)
    assert (w.hash[-2:] == alone.hash).all() and len(w.hash) == 900_002


def test_grams_do_not_cross_texts():
    part = next(slices(pa.array(["a b c", "a b", "", "c a b c"])))
    h, ok = grams(words(part, SPACED), 3)
    assert ok.tolist() == [True, False, False, False, False, True, True, False, False]
    assert h[0] == h[6] and h[0] != h[5]


# ------------------------------------------------------------------ lines


def judged(text):
    w = SPACED_RE.findall(text or "")
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {i + o for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for o in range(3)}
    lines = [x for x in (text or "").split("\n") if SPACED_RE.search(x)]
    good = []
    for line in lines:
        lw = SPACED_RE.findall(line)
        plain = " " + " ".join(alnum(line)) + " "
        ok = lw[-1][-1] in TERMINAL
        ok &= 5 * sum(x in SEPARATORS for x in lw) < len(lw)
        ok &= 2 * sum(c in SYMBOLS for c in line) < len(lw)
        ok &= not (len(lw) <= BOILERPLATE_LINE_WORDS and any(f" {p} " in plain for p in BOILERPLATE))
        if ok:
            good.append(line)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    kept = not failed and 2 * sum(len(SPACED_RE.findall(x)) for x in good) >= len(w)
    return (len(w), sum(map(len, w)), sum(c in SYMBOLS for c in text or ""), len(lines) - len(set(lines)), len(covered), failed, kept, "\n".join(good))


def test_line_rules(spark):
    texts = ODD + random_texts(2, 60) + [
        "Home | About | Contact | Login\n" + "A fine sentence of words stands here. " * 3 + "\nAll rights reserved.\nPrivacy policy | terms of use",
        "cookie\npolicy stands over two lines.\nHere is a cookie policy.",
        "\n".join(f"Line number {i} ends well." for i in range(30)) + "\n" + "$$$ ### $$$.",
    ]
    rows = cleaned(frame(spark, texts, "kept")).orderBy("doc_id").collect()
    assert len(rows) == len(texts)
    for r, t in zip(rows, texts):
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept, r.clean_text) == judged(t), t
    assert cleaned(frame(spark, [])).count() == 0


# ------------------------------------------------------------------ licenses


def scanned(text):
    w = alnum(text)
    places, base, labels, score = [], set(), set(), 0.0
    for t in PHRASES:
        p = t.text.split()
        at = [i for i in range(len(w)) if w[i:i + len(p)] == p]
        places += at
        if at:
            base.add(t.label)
            score = 1.0
    for t in NOTICES:
        p = t.text.split()
        best = max([len(set(w[i:i + len(p)]) & set(p)) for i in range(len(w))], default=0)
        if best >= need(t, len(set(p))):
            labels.add(t.label)
            score = max(score, best / len(set(p)))
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | labels)), score)


def test_license_scan(spark):
    texts = ODD + random_texts(3, 10) + [
        "Under the MIT License, or the mit-license; GNU General Public License v3. CC BY 4.0",
        "license mit", "apache", "Licensed under an Apache License version 2", "cc by " * 50, "gnu general public",
        "Permission is hereby granted, free of charge, to any human obtaining some copy of this software",
        "nothing of the sort " * 500 + "Apache License",
    ]
    rows = license_scan(frame(spark, texts, "labels")).orderBy("doc_id").collect()
    for r, t in zip(rows, texts):
        got = (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score)
        assert got[:6] == scanned(t)[:6] and abs(got[6] - scanned(t)[6]) < 1e-12, t
    assert license_scan(frame(spark, [])).count() == 0


def test_long_templates_from_a_table(spark):
    rng = random.Random(31)
    pool = [f"t{i}" for i in range(400)]
    long = [" ".join(rng.choice(pool) for _ in range(n)) for n in (300, 500)]
    worn = lambda t, share: " ".join("other" if rng.random() < share else x for x in t.split())
    noise = lambda n: " ".join(rng.choice(pool + ["a", "b"] * 300) for _ in range(n))
    texts = [noise(200) + " " + worn(t, share) + " " + noise(100) for t in long for share in (0.0, 0.1, 0.15, 0.3, 0.5)] + [noise(900), ""]
    table = spark.createDataFrame([("one", long[0], False, 0.8), ("two", long[1], False, 0.8), ("none", None, False, 0.8)], "label string, text string, phrase boolean, containment double")
    rows = license_scan(frame(spark, texts), templates=table).orderBy("doc_id").collect()
    for r, t in zip(rows, texts):
        w, labels, score = alnum(t), set(), 0.0
        for label, p in zip(("one", "two"), map(str.split, long)):
            size = len(set(p))
            best = max([len(set(w[i:i + len(p)]) & set(p)) for i in range(len(w))], default=0)
            if best >= need(Template(label, ""), size):
                labels.add(label)
                score = max(score, best / size)
        assert r.labels == ",".join(sorted(labels)) and abs(r.score - score) < 1e-12


def test_positional_filter_removes_blocks_and_no_match():
    rng = random.Random(32)
    removed = kept = 0
    for _ in range(40):
        template = [f"w{i}" for i in rng.sample(range(30), 12)]
        text = " ".join(f"w{rng.randrange(45)}" for _ in range(300))
        w = words(next(slices(pa.array([text]))), ALNUM_LOWER)
        hashes = words(next(slices(pa.array([" ".join(template)]))), ALNUM_LOWER).hash
        p = Pattern(Template("x", " ".join(template), containment=0.5), hashes, hashes, 6)
        some, every = candidates(w, p)[0], candidates(w, p, positional=False)[0]
        removed += len(every) - len(some)
        start, _ = matches(w, p)
        assert set(start) <= set(some) <= set(every)
        want = [i for i in range(300) if len(set(text.split()[i:i + 12]) & set(template)) >= 6]
        kept += len(want)
        assert start.tolist() == want
    assert removed > 1000 and kept > 50


# ------------------------------------------------------------------ decontamination


def hit(text, items, width):
    w = alnum(text)
    inside, found = set(), set()
    for item, t in items:
        v = alnum(t)
        for j in range(max(1, len(v) - width + 1) if v else 0):
            window = v[j:j + width]
            for i in range(len(w) - len(window) + 1):
                if w[i:i + len(window)] == window:
                    inside.update(range(i, i + len(window)))
                    found.add(str(item))
    return len(w), len(inside), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(inside)


def test_shipped_and_joined_windows_give_the_same_rows(spark):
    texts = ODD + random_texts(6, 60, 12) + [" ".join(["the the the the"] * 40)]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(random_texts(7, 12, 12) + ["the the the the", "a", None, "w1"])], "item_id long, text string")
    docs = frame(spark, texts + texts[-3:], "hits").repartition(3)
    rows = [sorted(map(str, contaminated(docs, bench, width=4, block_windows=n).collect())) for n in (200_000, 1)]
    assert rows[0] == rows[1] and sum("contaminated=True" in r for r in rows[0]) > 10


def test_joined_windows_read_the_documents_twice(spark, tmp_path, monkeypatch):
    from sparkseries.llm import decontaminate

    monkeypatch.setattr(decontaminate, "FILTER_BITS", 1 << 16)
    frame(spark, random_texts(8, 200)).write.parquet(str(tmp_path / "d"))
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(random_texts(9, 30))], "item_id long, text string")
    docs = spark.read.parquet(str(tmp_path / "d"))
    out = contaminated(docs, bench, width=4, block_windows=10)
    assert out.where("contaminated").count() > 0 and out.count() == 200
    # What is left to run reads the documents once more, however many windows there are.
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan parquet [doc_id") <= 1


@pytest.mark.parametrize("block_windows", [200_000, 7])
def test_decontamination(spark, block_windows):
    texts = ODD + random_texts(4, 30, vocabulary=4)
    items = [(10, "w1 w2 w3 w1"), (9, "W0"), (9, "ß the"), (11, None), (12, ""), (13, "w1 W2"), (2, " ".join(["w3", "w2", "w1"] * 5)), (10, "zz yy")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = contaminated(frame(spark, texts, "n_items"), bench, width=4, block_windows=block_windows).orderBy("doc_id").collect()
    for r, t in zip(rows, texts):
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == hit(t, items, 4), t
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in contaminated(frame(spark, texts), none).collect())


# ------------------------------------------------------------------ language


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(3))
    rows = language_of(docs, fold != 1, sample_rows=300).where(fold == 1).select("lang", "lang_pred", "score").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_odd_cases(spark):
    docs = frame(spark, ODD, "lang_pred").withColumn("lang", F.lit(None).cast("string"))
    rows = language_of(docs, F.lit(True)).collect()
    assert {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)}
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "even").otherwise("odd"))
    rows = {r.doc_id: r for r in language_of(docs, F.lit(True)).collect()}
    assert len(rows) == len(ODD)
    for i, t in enumerate(ODD):
        assert (rows[i].lang_pred == "und") == (not any(c.isalpha() for c in t or ""))


# ------------------------------------------------------------------ language model


def test_lm_counts_and_normalisation(spark):
    texts = ODD + random_texts(5, 30)
    docs = frame(spark, texts, "base_score")
    rows = lm_scores(docs, F.col("doc_id") % 3 != 0).orderBy("doc_id").collect()
    split = [SPACED_RE.findall((t or "").translate(LOWER)) + [None] for t in texts]
    count = Counter(w for i, t in enumerate(split) if i % 3 for w in t)
    total = sum(count.values())
    for r, t in zip(rows, split):
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(w in count for w in t), total)
        want = sum(np.log10((count[w] + 0.1) / (total + 0.1 * (len(count) + 1))) for w in t)
        assert r.base_score == pytest.approx(want)
        assert r.score < 0


def random_weights(n, seed=0):
    rng = np.random.default_rng(seed)
    make = lambda *shape: rng.normal(0, 1, shape).astype(np.float32)
    width = lm.level_width(n)
    levels = [n, -(-n // width), -(-(-(-n // width)) // width)]
    return lm.Weights(make(n, lm.DIM), make(2, lm.DIM), *(x for size in levels for x in (make(size, lm.DIM), make(size))))


@pytest.mark.parametrize("n", [2, 3, 50, 400])
def test_lm_probabilities_sum_to_one(n, monkeypatch):
    monkeypatch.setattr(lm, "CONTEXTS", 7)
    w = random_weights(n)
    for one, two in ((0, 1), (n - 1, 0), (1, n // 2)):
        p = np.exp(w.log_prob(np.full(n, one), np.full(n, two), np.arange(n)))
        assert p.sum() == pytest.approx(1, abs=1e-4) and (p > 0).all()
    rng = np.random.default_rng(1)
    many = rng.integers(0, n, (3, 300))
    single = [w.log_prob(*(np.array([x]) for x in t))[0] for t in many.T]
    assert np.allclose(w.log_prob(*many), single, atol=1e-4)


def test_lm_score_of_a_text_by_hand(spark):
    """One text's score from the model's weights, word by word, with rare and unknown words."""
    texts = random_texts(40, 60, 20) + ["w1 w2 once w3 never", "", None]
    docs = frame(spark, texts)
    train_on = F.col("doc_id") < 60
    out = {r.doc_id: r for r in lm_scores(docs, train_on).collect()}
    counts = Counter()
    for t in texts[:60]:
        counts.update((t or "").translate(LOWER).split() + ["</s>"])
    # The same weights, as training is the same for the same texts.
    lex, _ = lm.lexicon(lm.word_counts(docs.where(train_on), "text"))
    w = lm.train(docs.where(train_on), "text", lex)
    kept = [t for t, n in counts.items() if n >= lm.MIN_COUNT and t != "</s>"]
    hashes = {t: int(words(next(slices(pa.array([t]))), SPACED_LOWER).hash[0]) for t in counts}
    number = {t: int(lex.look_up(np.array([hashes[t]], np.uint64))[1][0]) for t in kept} | {"</s>": lm.STOP}
    assert sorted(number.values()) == list(range(1, len(kept) + 2)) and lex.size == len(kept) + 2
    rest = {t: n for t, n in counts.items() if t not in number}
    for i in (0, 7, 60, 61, 62):
        tokens, total, before = (texts[i] or "").translate(LOWER).split() + ["</s>"], 0.0, [lm.STOP, lm.STOP]
        for t in tokens:
            word = number.get(t, lm.OTHER)
            q = w.context[before[-1]] * w.place[0] + w.context[before[-2]] * w.place[1]
            c = word // w.width
            levels = [(w.section, w.section_bias, 0, c // w.width), (w.group, w.group_bias, c // w.width, c), (w.word, w.word_bias, c, word)]
            for k, (vectors, biases, block, target) in enumerate(levels):
                part = slice(None) if k == 0 else slice(block * w.width, (block + 1) * w.width)
                s = vectors[part] @ q + biases[part]
                total += s[target - (part.start or 0)] - np.log(np.exp(s).sum())
            if word == lm.OTHER:
                total += np.log((rest.get(t, 0) + 0.1) / (sum(rest.values()) + 0.1 * (len(rest) + 1)))
            before.append(word)
        assert out[i].score == pytest.approx(total / np.log(10), rel=1e-4)


def test_lm_learns_order(spark):
    """On texts with a fixed word order the model beats the word counts on held-out rows."""
    rng = random.Random(8)
    texts = []
    for _ in range(120):
        at = rng.randrange(20)
        texts.append(" ".join(f"n{(at + i) % 20}" for i in range(60)))
    rows = lm_scores(frame(spark, texts, "other"), F.col("doc_id") < 100).where("doc_id >= 100").collect()
    assert sum(r.score for r in rows) > 0.8 * sum(r.base_score for r in rows)


@pytest.mark.parametrize("total", [None, 10_000_000])
def test_lm_learns_once_from_every_token(total, monkeypatch):
    """Whatever the size of the input, a task learns once from each token of its share."""
    column = pa.array(random_texts(17, 400))
    ids = [lm.tokens(part) for part in slices(column)]
    keys, counts = np.unique(np.concatenate([h for h, _ in ids]), return_counts=True)
    lex = lm.Lexicon(keys, counts, np.where(keys == lm.END, lm.STOP, np.cumsum(keys != lm.END) + 1),
                     total or int(counts.sum()), len(keys), 0, 0, len(keys) + 1)
    wanted = Counter()
    for h, first in ids:
        own = lex.look_up(h)[1]
        wanted.update(zip(*(x.tolist() for x in (*lm.contexts(own, first), own))))
    learned = Counter()

    class Noted(lm.Trainer):
        def learn(self, one, two, word):
            learned.update(zip(one.tolist(), two.tolist(), word.tolist()))
            super().learn(one, two, word)

    class Rows:
        """Runs the training function of the first step on the texts, then stops."""

        def select(self, *_):
            return self

        coalesce = select

        def mapInArrow(self, run, _):
            rows = [pa.RecordBatch.from_arrays([column.slice(at, 150)], ["text"]) for at in range(0, len(column), 150)]
            list(run(iter(rows)))
            raise StopIteration

    monkeypatch.setattr(lm, "Trainer", Noted)
    with pytest.raises(StopIteration):
        lm.train(Rows(), "text", lex)
    assert learned == wanted


def test_lm_without_training_rows(spark):
    rows = lm_scores(frame(spark, ["a b", None], "x"), F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in rows)
    assert lm_scores(frame(spark, [], "x"), F.lit(True)).count() == 0


# ------------------------------------------------------------------ quality


def test_quality_held_out(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(4))
    out = quality_scores(docs, labels, fold != 2).join(labels, "doc_id").where(fold == 2).collect()
    good, bad = [r.score for r in out if r.quality], [r.score for r in out if not r.quality]
    order = np.mean([[1.0 if g > b else 0.5 if g == b else 0.0 for b in bad] for g in good]) if bad else 1.0
    assert order > 0.9
    assert all(0 < r.score < 1 and r.predicted == int(r.score >= 0.7) for r in out)


def test_quality_odd_cases(spark):
    docs = frame(spark, ODD + ODD, "quality")
    for marks in ([], [(0, 1)], [(0, None), (1, 0)], [(i, i % 2) for i in range(22)] * 2):
        labels = spark.createDataFrame(marks, "doc_id long, quality int")
        rows = quality_scores(docs, labels, F.lit(True)).collect()
        assert len(rows) == 2 * len(ODD) and all(0 < r.score < 1 for r in rows)


def test_threshold_covers_all_labels(spark):
    """The cut leaves as many labelled rows below it as are bad, however small the sample of the fit."""
    rng = random.Random(21)
    rows = [(i, " ".join(rng.choice(["the", "of", "a1", "$$", "word", "Long"]) for _ in range(rng.randrange(5, 60)))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(len(t) > 90)) for i, t in rows], "doc_id long, quality int")
    out = quality_scores(docs, labels, F.lit(True), sample_rows=20).collect()
    assert abs(sum(r.predicted for r in out) - sum(len(t) > 90 for _, t in rows)) <= 1


def test_ranked_value(spark):
    rng = random.Random(22)
    for values in ([1.5], [2.0] * 9 + [3.0], [rng.gauss(0, 1) ** 9 for _ in range(500)], [-1e300, 0.0, 5e-324, 1e-300, 1.0]):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        for rank in {0, len(values) // 2, len(values) - 1}:
            assert ranked_value(df, "v", rank, bins=8) == sorted(values)[rank]
