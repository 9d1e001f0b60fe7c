"""Line-first cleaning: rules judge each line, failing lines go, a document that lost too much goes.

A line fails if it does not end like a sentence, is strewn with symbols, reads like a navigation bar (many of its words
are lone separators), or is a short line with a boilerplate phrase. The cleaned text is the
passing lines; a document is rejected if less than half of its words are in passing lines.

Defined results: a null text has no words and fails; blank lines are neither kept nor counted;
repeated rows are judged one by one; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkseries.llm.words import ALNUM_LOWER, LINES, SPACED, Texts, Words, grams, hash_words, mix, per_text, slices, words

SYMBOLS = "#*$%&|<>"
SEPARATORS = "|>/·•»"
TERMINAL = ".!?:;\"')]…”’»。！？"
BOILERPLATE = (
    "all rights reserved", "cookie policy", "enable javascript", "lorem ipsum", "privacy policy",
    "sign in", "sign up", "skip to content", "subscribe to our newsletter", "terms of service", "terms of use",
)
BOILERPLATE_LINE_WORDS = 20
MIN_WORDS = 50

COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_clean_words")


def ends_with_any(data: np.ndarray, start: np.ndarray, end: np.ndarray, chars: str) -> np.ndarray:
    """Whether each byte range ends with one of the characters."""
    out = np.zeros(len(end), bool)
    for c in chars:
        raw = c.encode()
        hit = end - start >= len(raw)
        for k, b in enumerate(reversed(raw)):
            hit &= data[np.maximum(end - 1 - k, 0)] == b
        out |= hit
    return out


def is_lone(data: np.ndarray, start: np.ndarray, end: np.ndarray, chars: str) -> np.ndarray:
    """Whether each byte range is exactly one of the characters."""
    out = np.zeros(len(end), bool)
    for c in chars:
        raw = c.encode()
        hit = end - start == len(raw)
        for k, b in enumerate(raw):
            hit &= data[np.minimum(start + k, len(data) - 1)] == b
        out |= hit
    return out


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position: is its key anywhere else; is it not the first of its key."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    later = np.zeros(len(keys), bool)
    later[order[1:][same]] = True
    twice = later.copy()
    twice[order[:-1][same]] = True
    return twice, later


def phrase_starts(w: Words, phrases: tuple[str, ...]) -> np.ndarray:
    """Word positions at which one of the phrases stands."""
    found = []
    hashed = hash_words(list(phrases), ALNUM_LOWER)
    for h in hashed:
        n = len(h)
        at = np.flatnonzero(w.hash == h[0])
        at = at[at + n <= len(w.hash)]
        at = at[w.text[at] == w.text[at + n - 1]] if len(at) else at
        for j in range(1, n):
            at = at[w.hash[at + j] == h[j]]
        found.append(at)
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def inside_line(values_start: np.ndarray, line_start: np.ndarray) -> np.ndarray:
    """The line (number) that holds each start position."""
    return np.searchsorted(line_start, values_start, side="right") - 1


def judge(t: Texts, with_text: bool = False):
    """Measures of a slice of texts (see COLUMNS) and, on request, the bytes and lengths of the clean texts."""
    w = words(t, SPACED)
    n = len(t.offsets) - 1
    solid = SPACED.inside[t.data] & ((t.data & 0xC0) != 0x80)
    marks = np.zeros(256, bool)
    marks[[ord(c) for c in SYMBOLS]] = True
    symbols = per_text(marks[t.data], t.offsets)
    chars = per_text(solid, t.offsets)

    # Windows of three words that stand twice or more in their text.
    window, ok = grams(w, 3)
    at = np.flatnonzero(ok)
    twice, _ = repeated(window[at] ^ mix(w.text[at].astype(np.uint64) + np.uint64(1)))
    at = at[twice]
    covered = np.zeros(len(w.hash), bool)
    for j in range(3):
        covered[at + j] = True

    # Lines that hold a word.
    lines = words(t, LINES)
    of_word = inside_line(w.start, lines.start)
    n_words = np.bincount(of_word, minlength=len(lines.hash)).astype(np.int64)
    real = np.flatnonzero(n_words > 0)
    _, later = repeated(lines.hash[real] ^ mix(lines.text[real].astype(np.uint64) + np.uint64(1)))
    dup = np.bincount(lines.text[real][later], minlength=n)

    last = np.cumsum(n_words)[real] - 1
    good = np.zeros(len(lines.hash), bool)
    if len(real):
        lone = is_lone(t.data, w.start, w.end, SEPARATORS)
        bars = np.bincount(of_word[lone], minlength=len(lines.hash))
        good[real] = ends_with_any(t.data, w.start[last], w.end[last], TERMINAL)
        good &= 5 * bars < np.maximum(n_words, 1)
        strewn = per_text(marks[t.data], np.r_[lines.start, len(t.data)])
        good &= 2 * strewn < np.maximum(n_words, 1)
        plain = words(t, ALNUM_LOWER)
        starts = phrase_starts(plain, BOILERPLATE)
        if len(starts):
            # A phrase counts if it stays within one line.
            line = inside_line(plain.start[starts], lines.start)
            ends = [len(p) for p in hash_words(list(BOILERPLATE), ALNUM_LOWER)]
            reach = np.minimum(starts + max(ends) - 1, len(plain.hash) - 1)
            own = inside_line(plain.start[reach], lines.start) == line
            if not own.all():
                own |= phrase_within(plain, starts, lines.start, line)
            hit = line[own]
            good[hit[n_words[hit] <= BOILERPLATE_LINE_WORDS]] = False
    clean = np.bincount(lines.text, n_words * good, minlength=n).astype(np.int64)
    columns = [w.counts, chars, symbols, dup, per_text(covered, w.first), clean]
    if not with_text:
        return columns, None
    edge = np.zeros(len(t.data) + 2, np.int64)
    kept = np.flatnonzero(good)
    final = np.ones(len(kept), bool)  # the last kept line of its text gets no line feed
    final[:-1] = lines.text[kept[1:]] != lines.text[kept[:-1]]
    np.add.at(edge, lines.start[kept], 1)
    np.add.at(edge, lines.end[kept] + np.where(final, 0, 1), -1)
    use = np.cumsum(edge)[: len(t.data)] > 0
    return columns, (t.data[use], per_text(use, t.offsets))


def phrase_within(plain: Words, starts: np.ndarray, line_start: np.ndarray, line: np.ndarray) -> np.ndarray:
    """For each start: does a phrase that stands there end in the same line?"""
    out = np.zeros(len(starts), bool)
    for h in hash_words(list(BOILERPLATE), ALNUM_LOWER):
        fits = starts + len(h) <= len(plain.hash)
        for j, v in enumerate(h):
            fits &= plain.hash[np.minimum(starts + j, len(plain.hash) - 1)] == v
        end = np.minimum(starts + len(h) - 1, len(plain.hash) - 1)
        out |= fits & (inside_line(plain.start[end], line_start) == line)
    return out


def cleaned(docs: DataFrame, text: str = "text", with_text: bool = True, min_kept: float = 0.5) -> DataFrame:
    """All rows and columns of `docs` plus measures, verdicts and (unless switched off) `clean_text`.

    `base_failed`: under 50 words, or over half of the words in repeated three-word windows.
    `kept`: not base_failed, and at least `min_kept` of the words are in lines that passed.
    Columns of the same names are replaced.
    """
    added = [*COLUMNS, *(["clean_text"] if with_text else [])]
    rest = [c for c in docs.columns if c not in (*added, "base_failed", "kept")]
    rows = docs.select(*rest)
    at = rest.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, texts = [], []
            for part in slices(batch.column(at)):
                columns, clean = judge(part, with_text)
                found.append(columns)
                if with_text:
                    data, length = clean
                    offsets = np.concatenate(([0], np.cumsum(length)))
                    texts.append(pa.LargeStringArray.from_buffers(len(length), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)))
            arrays = list(batch.columns)
            for k in range(len(COLUMNS)):
                arrays.append(pa.array(np.concatenate([f[k] for f in found]) if found else np.zeros(0), pa.int64()))
            if with_text:
                arrays.append(pa.concat_arrays(texts).cast(pa.string()) if texts else pa.array([], pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, [*rest, *added])

    schema = rows.withColumns({c: F.lit(0).cast("long") for c in COLUMNS})
    if with_text:
        schema = schema.withColumn("clean_text", F.lit("").cast("string"))
    out = rows.mapInArrow(run, schema.schema)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    enough = F.col("n_clean_words") >= F.lit(min_kept) * F.col("n_words")
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & enough)
