"""License scan: an exact set-similarity join of text blocks with license templates.

A block is a run of as many consecutive words as the template has (fewer at the end of a text).
It matches a template if it holds at least `containment` of the template's distinct words.
Template words are ordered by how often they occur in the whole corpus, rarest first; a block
that matches must hold one of the first |T| - need + 1 of them (the prefix), so only blocks
around such words are looked at. The length filter needs `need` words in the block. The positional
filter takes the first prefix word in the block: before it stand at most need - 1 of the template's
words, as the others are prefix words, so together with the template words still to come there must be
enough; what is left is counted. Phrases (containment 1, consecutive) are confirmed word by word
afterwards.

The templates are a stated set, given in the code or as a table (`templates_of`), and are shipped to the
tasks: at most `MAX_TEMPLATE_WORDS` words of them. The corpus is read twice and never shuffled.

Defined results: a null or empty text has no words and no labels, score 0; repeated rows are
scanned one by one; overlapping places all count; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkseries.llm.words import ALNUM_LOWER, Words, hash_words, slices, words


@dataclass(frozen=True)
class Template:
    """`phrase`: the words must stand consecutively (a base place); else a set match gives the label."""

    label: str
    text: str
    phrase: bool = False
    containment: float = 0.8


PHRASES = (
    Template("gpl", "gnu general public license", True, 1.0),
    Template("apache", "apache license", True, 1.0),
    Template("cc-by", "cc by", True, 1.0),
    Template("mit", "mit license", True, 1.0),
)

NOTICES = (
    Template("apache-2.0", "licensed under the apache license version 2 0"),
    Template("gpl-3.0", "licensed under the gnu general public license version 3"),
    Template("mit", "released under the mit license"),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0"),
)


MAX_TEMPLATE_WORDS = 1_000_000
CELLS = 1 << 20  # words of blocks compared at once


@dataclass
class Pattern:
    """A template made ready: its words, their set, the number needed and the prefix words."""

    template: Template
    words: np.ndarray
    distinct: np.ndarray  # rarest first
    need: int

    @property
    def prefix(self) -> np.ndarray:
        return self.distinct[: len(self.distinct) - self.need + 1]


def need(template: Template, n_distinct: int) -> int:
    return max(1, math.ceil(template.containment * n_distinct - 1e-9))


def counts_of(docs: DataFrame, text: str, vocabulary: np.ndarray) -> np.ndarray:
    """How often each of the given word hashes (sorted) occurs in the corpus; one sum per task."""
    low = np.zeros(1 << 16, bool)
    low[(vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for part in slices(batch.column(0)):
                h = words(part, ALNUM_LOWER).hash
                h = h[low[(h & np.uint64(0xFFFF)).astype(np.int64)]]
                at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
                total += np.bincount(at[vocabulary[at] == h], minlength=len(vocabulary))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["word", "n"])

    out = np.zeros(len(vocabulary), np.int64)
    if len(vocabulary):
        for r in docs.select(text).mapInArrow(count, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect():
            out[r["word"]] = r["n"]
    return out


def patterns(docs: DataFrame, text: str, templates: tuple[Template, ...]) -> list[Pattern]:
    hashed = hash_words([t.text for t in templates], ALNUM_LOWER)
    vocabulary = np.unique(np.concatenate(hashed)) if hashed else np.zeros(0, np.uint64)
    often = counts_of(docs, text, vocabulary)
    out = []
    for t, h in zip(templates, hashed):
        distinct = np.unique(h)
        rank = np.lexsort((distinct, often[np.searchsorted(vocabulary, distinct)]))
        if len(distinct):
            out.append(Pattern(t, h, distinct[rank], need(t, len(distinct))))
    return out


def templates_of(table: DataFrame) -> tuple[Template, ...]:
    """The templates of a table (label, text and, if there, phrase and containment); null texts are left out."""
    rows = table.where(F.col("text").isNotNull()).limit(MAX_TEMPLATE_WORDS + 1).collect()
    out = tuple(Template(r["label"], r["text"], *(r[c] for c in ("phrase", "containment") if c in table.columns)) for r in rows)
    if sum(len(t.text.split()) for t in out) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"more than {MAX_TEMPLATE_WORDS} words of templates")
    return out


def candidates(w: Words, p: Pattern, positional: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(start of the blocks that pass the filters, whether a word is one of the template's)."""
    length = len(p.words)
    member = np.isin(w.hash, p.distinct)
    at = np.flatnonzero(member)
    at = at[np.isin(w.hash[at], p.prefix)]
    if not len(at):
        return at, member
    around = (at[:, None] - np.arange(length)).ravel()
    start = np.unique(around[around >= np.repeat(w.first[w.text[at]], length)])
    end = np.minimum(start + length, w.first[w.text[start] + 1])
    start, end = (x[end - start >= p.need] for x in (start, end))  # length filter
    if positional and len(start):
        first = at[np.searchsorted(at, start)]  # every block holds a prefix word
        many = np.r_[0, np.cumsum(member)]
        bound = np.minimum(many[first] - many[start], p.need - 1) + many[end] - many[first]
        start = start[bound >= p.need]
    return start, member


def matches(w: Words, p: Pattern) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the blocks that match a pattern, and the share of its distinct words they hold."""
    length = len(p.words)
    start, member = candidates(w, p)
    if not len(start):
        return start, np.zeros(0)
    # A word of the template counts at its first place in the block.
    at = np.flatnonzero(member)
    order = at[np.lexsort((at, w.hash[at]))]
    before = np.full(len(w.hash) + 1, -1)
    same = w.hash[order[1:]] == w.hash[order[:-1]]
    before[order[1:][same]] = order[:-1][same]
    member = np.r_[member, False]
    good, held = [], []
    for lo in range(0, len(start), max(1, CELLS // length)):
        some = start[lo : lo + max(1, CELLS // length)]
        cells = some[:, None] + np.arange(length)
        cells = np.where(cells < w.first[w.text[some] + 1][:, None], cells, len(w.hash))
        n = (member[cells] & (before[cells] < some[:, None])).sum(axis=1)
        fits = n >= p.need
        if p.template.phrase:
            fits &= (np.r_[w.hash, np.uint64(0)][cells] == p.words).all(axis=1)
        good.append(some[fits])
        held.append(n[fits])
    return np.concatenate(good), np.concatenate(held) / len(p.distinct)


def scan(w: Words, ready: list[Pattern]):
    """Per text: base places, first and last of them, base labels, all labels, best score."""
    n = len(w.first) - 1
    n_base = np.zeros(n, np.int64)
    first = np.full(n, np.iinfo(np.int64).max)
    last = np.full(n, -1)
    score = np.zeros(n)
    base: list[set[str]] = [set() for _ in range(n)]
    every: list[set[str]] = [set() for _ in range(n)]
    for p in ready:
        start, held = matches(w, p)
        text = w.text[start]
        np.maximum.at(score, text, held)
        if p.template.phrase:
            n_base += np.bincount(text, minlength=n)
            np.minimum.at(first, text, start - w.first[text])
            np.maximum.at(last, text, start - w.first[text])
        for i in np.unique(text):
            every[i].add(p.template.label)
            if p.template.phrase:
                base[i].add(p.template.label)
    return n_base, first, last, base, every, score


def license_scan(docs: DataFrame, text: str = "text", templates: tuple[Template, ...] | DataFrame = PHRASES + NOTICES) -> DataFrame:
    """All rows and columns of `docs` plus n_words, n_base, first_word, last_word (null without a
    place), base_labels, labels (sorted, comma-joined) and score (largest share of a template
    held, 0 without a match). Columns of the same names are replaced."""
    added = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    rest = [c for c in docs.columns if c not in added]
    rows = docs.select(*rest)
    ready = patterns(rows, text, templates_of(templates) if isinstance(templates, DataFrame) else templates)
    at = rest.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in added]
            for part in slices(batch.column(at)):
                w = words(part, ALNUM_LOWER)
                n_base, first, last, base, every, score = scan(w, ready)
                none = n_base == 0
                parts = [pa.array(w.counts), pa.array(n_base), pa.array(first, mask=none), pa.array(last, mask=none),
                         pa.array([",".join(sorted(x)) for x in base], pa.string()),
                         pa.array([",".join(sorted(x)) for x in every], pa.string()), pa.array(score)]
                for c, x in zip(columns, parts):
                    c.append(x)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            arrays = [pa.concat_arrays(c).cast(k) if c else pa.array([], k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*rest, *added])

    long = {c: F.lit(0).cast("long") for c in added[:4]}
    schema = rows.withColumns({**long, "base_labels": F.lit("").cast("string"), "labels": F.lit("").cast("string"), "score": F.lit(0.0)}).schema
    for f in schema.fields:
        f.nullable = True
    return rows.mapInArrow(run, schema)
