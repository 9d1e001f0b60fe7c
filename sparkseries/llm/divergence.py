"""Divergence of sources by their terms, by chunk factorization.

1. Tasks cut texts at white space and count each distinct chunk per document. A block of texts
   gives one row per (chunk, lang): its documents, its occurrences by source and, while they are
   few, the documents themselves.
2. The rows meet by chunk. Each globally distinct chunk is cut into terms once, and its counts are
   joined to its terms. A chunk may hold several terms, and a term stand in several chunks
   ("the", "the,").
3. The rows meet by (lang, term). A term's documents are as many as its most frequent chunk has, at
   least, and as all its chunks have, at most. Where these bounds leave open whether it is frequent
   enough, all its chunks are rare, so their documents are listed, and the distinct ones are
   counted. Each kept term leaves one row with its occurrences by source.
4. A source is compared with its language, and with each other source of it, by
   f = floor((p - q)**2 / (p + q)) over all kept terms, in whole numbers. A pair's sum starts from
   the value for terms that neither has; histograms of each source's shares add what its terms
   change against an empty other side, and terms that both have are corrected.

Nothing is gathered by document: a hot source, chunk or term is a row per block, and rows of one key
are added up as they come, so a task holds one row of it. A row has at most one number per source
of a language; output `pair` has one row per pair of them.

Defined results: a null text, lang or source counts as ''; a row is a document, also if its id or
text is repeated; texts without terms, and empty ones, still make their (lang, source) occur; ties
are ordered by the item's UTF-8 bytes; without kept terms a pair's value is 0; an empty table gives
no rows; a very long text is a block of its own, a long chunk is one row; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkseries.llm.shared import written
from sparkseries.llm.words import SPACED, slices, spans

BLOCK_BYTES = 24 << 20
ROWS = 100_000  # of a table that is worked on at once
SCALE = 1_000_000_000
ADDED = 2  # to each count

# Bytes of terms, [^\x00-\x40\x5B-\x60\x7B-\x7F]
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Counts(NamedTuple):
    """Counts of some rows: bounds of the documents, occurrences by source (`size` entries a row),
    and documents listed (`held` entries a row)."""

    low: np.ndarray
    high: np.ndarray
    size: np.ndarray
    source: np.ndarray
    n: np.ndarray
    held: np.ndarray
    ids: np.ndarray


def combined(c: Counts, owner: np.ndarray, m: int, few: int, peak: bool) -> Counts:
    """Rows of the same owner (0 to m - 1) as one. The lower bound is their sum, or their largest
    (`peak`); documents stay listed while it is below `few`."""
    low, high = np.zeros(m, np.int64), np.zeros(m, np.int64)
    (np.maximum if peak else np.add).at(low, owner, c.low)
    np.add.at(high, owner, c.high)
    at = np.repeat(owner, c.size)
    order = np.lexsort((c.source, at))
    at, source, n = at[order], c.source[order], c.n[order]
    edge = np.flatnonzero(np.r_[True, (np.diff(at) != 0) | (source[1:] != source[:-1])][: len(at)])
    n = np.add.reduceat(n, edge) if len(edge) else n
    who = np.repeat(owner, c.held)
    rare = low[who] < few
    who, ids = who[rare], c.ids[rare]
    order = np.lexsort((ids, who))
    who, ids = who[order], ids[order]
    new = np.r_[True, (np.diff(who) != 0) | (np.diff(ids) != 0)][: len(who)]
    return Counts(low, high, np.bincount(at[edge], minlength=m), source[edge], n, np.bincount(who[new], minlength=m), ids[new])


def taken(c: Counts, rows: np.ndarray, times: np.ndarray | int = 1) -> Counts:
    """The given rows, repeated ones too, with their occurrences multiplied."""

    def entries(size: np.ndarray) -> np.ndarray:
        begin = np.cumsum(size) - size
        count = size[rows]
        return np.repeat(begin[rows] - (np.cumsum(count) - count), count) + np.arange(count.sum())

    own, listed = entries(c.size), entries(c.held)
    n = c.n[own] * np.repeat(np.broadcast_to(times, len(rows)), c.size[rows])
    return Counts(c.low[rows], c.high[rows], c.size[rows], c.source[own], n, c.held[rows], c.ids[listed])


def lists(size: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)].astype(np.int32)), pa.array(values, pa.int64()))


SCHEMA = "key string, lang string, low long, high long, source array<long>, n array<long>, ids array<long>"


def packed(key: pa.Array, lang: pa.Array, c: Counts) -> pa.RecordBatch:
    arrays = [key.cast(pa.string()), lang, pa.array(c.low), pa.array(c.high), lists(c.size, c.source), lists(c.size, c.n), lists(c.held, c.ids)]
    return pa.RecordBatch.from_arrays(arrays, [part.split()[0] for part in SCHEMA.split(", ")])


def unpacked(t: pa.Table) -> tuple[pa.Array, pa.Array, Counts]:
    key, lang, low, high, source, n, ids = (c.combine_chunks() for c in t.columns)
    flat = lambda a: a.flatten().to_numpy()
    size = lambda a: np.diff(a.offsets.to_numpy()).astype(np.int64)
    return key, lang, Counts(low.to_numpy(), high.to_numpy(), size(source), flat(source), flat(n), size(ids), flat(ids))


def numbered(key: pa.Array, lang: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Number of each row's (key, lang), from 0, and the first row of each."""
    a, b = key.dictionary_encode(), lang.dictionary_encode()
    pair = a.indices.to_numpy().astype(np.int64) * len(b.dictionary) + b.indices.to_numpy()
    _, first, owner = np.unique(pair, return_index=True, return_inverse=True)
    return owner, first


def chunk_rows(docs: DataFrame, few: int) -> DataFrame:
    """A row per (chunk, lang) of each block of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.Array, np.ndarray, int]] = []
        ids, langs, sources, size = [], [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            base = np.cumsum([0, *(n for _, _, n in held)])
            doc = np.concatenate([d + b for (_, d, _), b in zip(held, base)])
            coded = pa.concat_arrays([c for c, _, _ in held]).dictionary_encode()
            code = coded.indices.to_numpy().astype(np.int64)
            lang = pa.concat_arrays(langs).dictionary_encode()
            lang_of, source_of, id_of = lang.indices.to_numpy(), np.concatenate(sources), np.concatenate(ids)
            order = np.lexsort((source_of, lang_of))  # documents by language and source
            number = np.empty(len(order), np.int64)
            number[order] = np.arange(len(order))
            key, times = np.unique(code * len(order) + number[doc], return_counts=True)
            at, who = key // max(len(order), 1), order[key % max(len(order), 1)]
            changed = (np.diff(at) != 0) | (np.diff(lang_of[who]) != 0)
            row = np.flatnonzero(np.r_[True, changed][: len(key)])
            entry = np.flatnonzero(np.r_[True, changed | (source_of[who][1:] != source_of[who][:-1])][: len(key)])
            n_docs = np.diff(np.r_[row, len(key)])
            listed = n_docs < few
            n = np.add.reduceat(times, entry) if len(entry) else times
            c = Counts(n_docs, n_docs, np.diff(np.r_[np.searchsorted(entry, row), len(entry)]), source_of[who[entry]], n,
                       np.where(listed, n_docs, 0), id_of[who][np.repeat(listed, n_docs)])
            for lo in range(0, len(row), ROWS):
                part = np.arange(lo, min(lo + ROWS, len(row)))
                yield packed(coded.dictionary.take(pa.array(at[row[part]])), lang.dictionary.take(pa.array(lang_of[who[row[part]]])), taken(c, part))

        for batch in batches:
            for part in slices(batch.column(1)):
                start, end = spans(part, SPACED.inside)
                offsets = np.r_[0, np.cumsum(end - start)].astype(np.int64)
                chunks = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(part.data[SPACED.inside[part.data]]))
                n = len(part.offsets) - 1
                held.append((chunks, np.searchsorted(part.offsets, start, side="right") - 1, n))
                rows = slice(part.row, part.row + n)
                ids.append(batch.column(0).to_numpy()[rows])
                langs.append(batch.column(2)[rows])
                sources.append(batch.column(3).to_numpy()[rows])
                size += len(part.data)
                if size >= BLOCK_BYTES:
                    yield from flush()
                    held, ids, langs, sources, size = [], [], [], [], 0
        if held:
            yield from flush()

    return docs.mapInArrow(run, SCHEMA)


def whole_keys(batches: Iterator[pa.RecordBatch], few: int, peak: bool) -> Iterator[tuple[pa.Array, pa.Array, Counts]]:
    """Combined rows of each (key, lang) of a sorted partition; a key is never split over two portions."""
    names, rest, held, size = None, None, [], 0

    def combine(t: pa.Table):
        key, lang, c = unpacked(t)
        owner, first = numbered(key, lang)
        first = pa.array(first)
        return key.take(first), lang.take(first), combined(c, owner, len(first), few, peak)

    def portion(last: bool):
        nonlocal rest, held, size
        t = pa.Table.from_batches(([rest] if rest is not None else []) + held)
        rest, held, size = None, [], 0
        key, lang, c = combine(t)
        if last:
            return key, lang, c
        coded = key.dictionary_encode()
        tail = coded.indices.to_numpy() == coded.dictionary.index(t.column(0)[-1]).as_py()
        sides = [np.flatnonzero(tail), np.flatnonzero(~tail)]
        left, now = ((key.take(pa.array(rows)), lang.take(pa.array(rows)), taken(c, rows)) for rows in sides)
        rest = packed(*left).cast(names)
        return now

    for batch in batches:
        names = batch.schema
        held.append(batch)
        size += batch.num_rows
        if size >= ROWS:
            yield portion(False)
    if held or rest is not None:
        yield portion(True)


def term_rows(chunks: DataFrame, few: int) -> DataFrame:
    """A row per (term, lang), added up within portions of the chunks, which are cut into terms once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, lang, c in whole_keys(batches, few, False):
            coded = key.dictionary_encode()
            code = coded.indices.to_numpy().astype(np.int64)
            held, where = [], []
            for part in slices(coded.dictionary):
                start, end = spans(part, _LETTER)
                offsets = np.r_[0, np.cumsum(end - start)].astype(np.int64)
                held.append(pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(_LOWER[part.data[_LETTER[part.data]]])))
                where.append(part.row + np.searchsorted(part.offsets, start, side="right") - 1)
            if not held or not sum(map(len, held)):
                continue
            terms = pa.concat_arrays(held).dictionary_encode()
            # (chunk, term) with the number of times, then joined to the rows of the chunk
            pair, times = np.unique(np.concatenate(where) * len(terms.dictionary) + terms.indices.to_numpy(), return_counts=True)
            chunk, term = pair // len(terms.dictionary), pair % len(terms.dictionary)
            begin = np.searchsorted(chunk, code)
            count = np.searchsorted(chunk, code, side="right") - begin
            row = np.repeat(np.arange(len(code)), count)
            at = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(len(row))
            spread = taken(c, row, times[at])
            term, lang = terms.dictionary.take(pa.array(term[at])), lang.take(pa.array(row))
            owner, first = numbered(term, lang)
            if len(first):
                first = pa.array(first)
                yield packed(term.take(first), lang.take(first), combined(spread, owner, len(first), few, True))

    return chunks.mapInArrow(run, SCHEMA)


def kept_terms(terms: DataFrame, few: int) -> DataFrame:
    """(lang, term, source, n): the terms in at least `few` documents of the language, with their
    occurrences by source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, lang, c in whole_keys(batches, few, True):
            keep = np.flatnonzero((c.low >= few) | ((c.high >= few) & (c.held >= few)))
            t = packed(key.take(pa.array(keep)), lang.take(pa.array(keep)), taken(c, keep))
            yield pa.RecordBatch.from_arrays([t["lang"], t["key"], t["source"], t["n"]], ["lang", "term", "source", "n"])

    return terms.mapInArrow(run, "lang string, term string, source array<long>, n array<long>")


def share(n: Column, total: Column, size: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * size)), in decimals; null without kept terms."""
    wide = lambda c: c.cast("decimal(19,0)")
    above = F.lit(SCALE).cast("decimal(10,0)") * wide(n + ADDED)
    below = wide(total + ADDED * size)
    return F.call_function("div", above, F.nullif(below, F.lit(0).cast("decimal(19,0)"))) + 1


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def source_groups(docs: DataFrame) -> tuple[DataFrame, Column]:
    """The (lang, source, number) that occur, and the number of a row's source: a hash that differs for
    all sources of a language."""
    pairs = written(docs.select("lang", "source").distinct(), "groups")
    seed = 0
    while True:
        number = F.xxhash64(F.lit(seed), F.col("source"))
        if pairs.groupBy("lang", number).count().where("count > 1").isEmpty():
            return pairs.withColumn("number", number), number
        seed += 1


def term_counts(docs: DataFrame, least: int = 10, text: str = "text", lang: str = "lang",
                source: str = "source") -> tuple[DataFrame, DataFrame]:
    """(lang, term, source, n) of the terms in at least `least` documents of a language, with the numbers
    and occurrences of its sources, and the (lang, source, number) that occur."""
    blank = lambda c, name: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
    found = docs.select(blank(text, "text"), blank(lang, "lang"), blank(source, "source"))
    groups, number = source_groups(found)
    rows = found.select(F.monotonically_increasing_id().alias("id"), "text", "lang", number.alias("source"))
    by_chunk = chunk_rows(rows, least).repartition("key").sortWithinPartitions("key", "lang")
    by_term = term_rows(by_chunk, least).repartition("key", "lang").sortWithinPartitions("key", "lang")
    return written(kept_terms(by_term, least), "terms"), groups


def divergences(docs: DataFrame, least: int = 10, top: int = 10, text: str = "text", lang: str = "lang",
                source: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): part `pair` compares a source with each other one of
    its language, part `term` ranks the `top` terms that are more frequent in it than in the language."""
    terms, groups = term_counts(docs, least, text, lang, source)
    zero = F.lit(0).cast("long")
    each = terms.select("lang", F.explode(F.arrays_zip("source", "n")).alias("e"))
    totals = each.groupBy("lang", F.col("e.source").alias("number")).agg(F.sum("e.n").alias("total"), F.count(F.lit(1)).alias("held"))
    sizes = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("size"), F.sum(F.aggregate("n", zero, lambda a, b: a + b)).alias("lang_total"))
    groups = groups.join(totals, ["lang", "number"], "left").join(sizes, "lang", "left").select(
        "lang", "source", "number", *[F.coalesce(c, zero).alias(c) for c in ("total", "held", "size", "lang_total")])
    groups = written(groups.withColumn("p0", share(zero, F.col("total"), F.col("size"))), "sources")

    # One row per term: its share in the language, and the shares of the sources that have it.
    known = groups.groupBy("lang", "size", "lang_total").agg(
        F.map_from_entries(F.collect_list(F.struct("number", F.struct("source", "total", "p0")))).alias("known"))
    rows = terms.select("lang", "term", F.arrays_zip("source", "n").alias("entries"),
                        F.aggregate("n", zero, lambda a, b: a + b).alias("n")).join(known, "lang")

    def with_share(e: Column) -> Column:
        info = F.element_at("known", e["source"])
        return F.struct(info["source"].alias("source"), share(e["n"], info["total"], F.col("size")).alias("p"), info["p0"].alias("p0"))

    rows = written(rows.select("lang", "term", share(F.col("n"), F.col("lang_total"), F.col("size")).alias("q"),
                               F.transform("entries", with_share).alias("entries")), "shares")
    shares = rows.select("lang", "term", "q", F.inline("entries"))
    p, q = F.col("p"), F.col("q")
    over = shares.where(p > q).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap(p, q).alias("value"))

    other = groups.select("lang", F.col("source").alias("item"), F.col("held").alias("held2"), F.col("p0").alias("r0"))
    p0, r, r0 = (F.col(c) for c in ("p0", "r", "r0"))
    apart = F.col("source") != F.col("item")
    empty = (F.col("size") - F.col("held") - F.col("held2")) * gap(p0, r0)
    base = groups.join(other, "lang").where(apart).select("lang", "source", "item", F.coalesce(empty, zero).alias("value"))
    # Terms of one side against none on the other: a source's distinct shares, each with its terms.
    bars = shares.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("m"))
    alone = bars.join(other, "lang").where(apart).groupBy("lang", "source", "item").agg(F.sum(F.col("m") * gap(p, r0)).alias("value"))
    # Terms of both, each pair once.
    both = rows.select("lang", "entries", F.inline("entries")).select("lang", "source", "p", "p0", F.explode("entries").alias("e"))
    both = both.select("lang", "source", "p", "p0", F.col("e.source").alias("item"), F.col("e.p").alias("r"), F.col("e.p0").alias("r0"))
    change = gap(p, r) - gap(p, r0) - gap(p0, r) + gap(p0, r0)
    common = both.where(F.col("source") < F.col("item")).groupBy("lang", "source", "item").agg(F.sum(change).alias("value"))
    turned = alone.unionByName(common).select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    pairs = base.unionByName(alone).unionByName(common).unionByName(turned).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    ranked = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(ranked).alias("rank")
    return pairs.select("*", rank).unionByName(over.select("*", rank).where(F.col("rank") <= top))
