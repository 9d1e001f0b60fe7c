"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

A window is `width` consecutive words of an item (a shorter item is one window). The words of
the windows are ordered by how often they occur in the documents, rarest first. A document place
that contains a window contains its rarest word, so with full containment the necessary prefix
is one word: document words that are the rarest word of a window are joined with it; the length
bound (the window fits into the text) and the positional bound (the word's offset in the window
fixes the start) leave candidates whose words are then compared one by one.

Items are a stated query set. Up to `block_windows` windows are shipped to the tasks: the documents
are read once for the counts and once for the places, and are not shuffled. More windows stay a
table: the documents are read once for the counts of the window words and once for the places of
the rarest ones, each with the words around it, both through a bit filter of fixed size; these places
are joined with the windows on the rarest word, checked by position, and compared in the join. The
hits are then joined to the documents by two hashes of the text; where they are many, Spark shuffles
the documents for it once. Both ways give the same rows.

Defined results: null and empty texts have no words and match nothing; an item without words has
no window; repeated item ids are one item; repeated documents are judged one by one; overlapping
places count each word once; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkseries.llm.licenses import counts_of
from sparkseries.llm.shared import free_name, written
from sparkseries.llm.words import ALNUM_LOWER, Words, signed, slices, words

HITS = "array<struct<start:bigint,end:bigint>>"
FILTER_BITS = 1 << 26


def item_windows(items: DataFrame, id_: str, text: str, width: int) -> DataFrame:
    """(item, window): the word hashes of each distinct window, packed, 8 bytes a word."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for part in slices(batch.column(1)):
                w = words(part, ALNUM_LOWER)
                out_id, out = [], []
                for i in range(len(w.first) - 1):
                    h = w.hash[w.first[i] : w.first[i + 1]]
                    if len(h) and ids[part.row + i] is not None:
                        for j in range(max(1, len(h) - width + 1)):
                            out.append(h[j : j + width].tobytes())
                            out_id.append(ids[part.row + i])
                yield pa.RecordBatch.from_arrays([pa.array(out_id, pa.string()), pa.array(out, pa.binary())], ["item", "window"])

    rows = items.select(F.col(id_).cast("string").alias("item"), F.col(text).alias("text"))
    return rows.mapInArrow(cut, "item string, window binary").distinct()


class Block:
    """The windows of one block, ready to be found: grouped by their rarest word."""

    def __init__(self, rows, docs: DataFrame, text: str):
        pairs = sorted((bytes(r["window"]), r["item"]) for r in rows)
        self.items = sorted({item for _, item in pairs})
        number = {item: k for k, item in enumerate(self.items)}
        self.windows: list[np.ndarray] = []
        self.item_of: list[np.ndarray] = []
        owner: list[list[int]] = []
        previous = None
        for raw, item in pairs:
            if raw != previous:
                self.windows.append(np.frombuffer(raw, np.uint64))
                owner.append([])
                previous = raw
            owner[-1].append(number[item])
        self.item_of = [np.array(x, np.int64) for x in owner]
        vocabulary = np.unique(np.concatenate(self.windows))
        often = counts_of(docs, text, vocabulary)
        rare, offset = [], []
        for v in self.windows:
            n = often[np.searchsorted(vocabulary, v)]
            k = int(np.lexsort((v, n))[0])
            rare.append(v[k])
            offset.append(k)
        self.size = np.array([len(v) for v in self.windows])
        self.offset = np.array(offset)
        order = np.argsort(np.array(rare, np.uint64), kind="stable")
        self.order = order
        self.keys, begin, count = np.unique(np.array(rare, np.uint64)[order], return_index=True, return_counts=True)
        self.begin, self.count = begin, count
        widest = int(self.size.max())
        self.table = np.zeros((len(self.windows), widest), np.uint64)
        for k, v in enumerate(self.windows):
            self.table[k, : len(v)] = v
        self.windows = []
        self.low = np.zeros(1 << 16, bool)
        self.low[(self.keys & np.uint64(0xFFFF)).astype(np.int64)] = True

    def find(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """(start word, window number) of every place of every window."""
        at = np.flatnonzero(self.low[(w.hash & np.uint64(0xFFFF)).astype(np.int64)])
        key = np.minimum(np.searchsorted(self.keys, w.hash[at]), len(self.keys) - 1)
        same = self.keys[key] == w.hash[at]
        at, key = at[same], key[same]
        n = self.count[key]
        place = np.repeat(at, n)
        nth = np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n)
        window = self.order[np.repeat(self.begin[key], n) + nth]
        start = place - self.offset[window]
        text = w.text[place]
        fits = (start >= w.first[text]) & (start + self.size[window] <= w.first[text + 1])
        start, window = start[fits], window[fits]
        for j in range(self.table.shape[1]):
            if not len(start):
                break
            short = j >= self.size[window]
            good = short | (w.hash[np.minimum(start + j, len(w.hash) - 1)] == self.table[window, j])
            start, window = start[good], window[good]
        return start, window


def with_hits(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
              width: int = 10, block_windows: int = 200_000) -> DataFrame:
    """All rows and columns of `docs` plus n_words, hits (array of [start, end) word ranges, not
    merged between blocks) and items (ids with a window in the text, as strings).
    Columns of the same names are replaced."""
    windows = written(item_windows(items, item_id, item_text, width), "windows")
    rest = [c for c in docs.columns if c not in ("n_words", "hits", "items")]
    source = docs.select(*rest)
    if windows.count() > block_windows:
        return joined_hits(source, windows, text, width)
    rows = windows.collect()
    block = Block(rows, source, text) if rows else None
    out = source.withColumns({"n_words": F.lit(None).cast("long"), "hits": F.lit(None).cast(HITS), "items": F.lit(None).cast("array<string>")})
    return out.mapInArrow(marker(block, rest.index(text)), out.schema)


def bit_filter(words_: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """One bit per remainder of the word hashes: `bits` / 8 bytes on the driver, whatever their number."""
    place = F.pmod("word", F.lit(bits)) + 1
    found = words_.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap")).collect()
    out = np.zeros(bits // 8, np.uint8)
    for r in found:
        part = np.frombuffer(bytes(r["bitmap"]), np.uint8)
        at = (r["bucket"] - 1) * len(part)
        out[at : at + len(part)] = part[: len(out) - at]
    return out


def passes(filter_: np.ndarray, h: np.ndarray) -> np.ndarray:
    place = np.mod(h.view(np.int64), len(filter_) * 8)
    return (filter_[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def joined_hits(docs: DataFrame, windows: DataFrame, text: str, width: int) -> DataFrame:
    """`with_hits` by a join, for any number of windows."""
    at = docs.columns.index(text)
    parts = windows.select("window").distinct().withColumn("n", (F.octet_length("window") / 8).cast("int"))
    spread = parts.mapInArrow(_window_words, "window binary, n int, offset int, word long")
    spread = written(spread, "window-words")
    wanted = bit_filter(spread.select("word").distinct())

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(0)):
                h = words(part, ALNUM_LOWER).hash
                values, n = np.unique(h[passes(wanted, h)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(signed(values)), pa.array(n, pa.int64())], ["word", "n"])

    counts = docs.select(text).mapInArrow(tally, "word long, n long").groupBy("word").agg(F.sum("n").alias("often"))
    rarest = spread.join(counts, "word", "left").groupBy("window", "n").agg(
        F.min(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "word", "offset")).alias("best"))
    # A window with a word that no document has stands nowhere.
    keyed = written(rarest.where("best.often > 0").select("window", "n", "best.word", "best.offset"), "keys")
    keys = bit_filter(keyed.select("word").distinct())

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(0)):
                w = words(part, ALNUM_LOWER)
                hit = np.flatnonzero(passes(keys, w.hash))
                owner = w.text[hit]
                low, high = np.maximum(hit - width + 1, w.first[owner]), np.minimum(hit + width, w.first[owner + 1])
                around = [w.hash[a:b].tobytes() for a, b in zip(low, high)]
                rows = pa.array(owner + part.row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).take(rows), batch.column(2).take(rows), pa.array(signed(w.hash[hit])), pa.array(hit - w.first[owner]), pa.array((hit - low).astype(np.int32)), pa.array(around, pa.binary())],
                    ["one", "two", "word", "place", "before", "around"])

    own = [F.xxhash64(text), F.xxhash64(F.lit(1), F.col(text))]
    found = docs.select(text, own[0].alias("one"), own[1].alias("two")).mapInArrow(
        places, "one long, two long, word long, place long, before int, around binary")
    begin = F.col("before") - F.col("offset")
    good = found.join(keyed, "word").where((begin >= 0) & (F.substring("around", 8 * begin + 1, 8 * F.col("n")) == F.col("window")))
    start = F.col("place") - F.col("offset")
    hits = good.select("one", "two", "window", F.struct(start.alias("start"), (start + F.col("n")).alias("end")).alias("hit")).distinct()
    hits = written(hits, "hits")
    named = hits.select("one", "two", "window").distinct().join(windows, "window").groupBy("one", "two").agg(F.array_sort(F.collect_set("item")).alias("items"))
    # Places that overlap or touch are one range, as the shipped windows give them.
    order = Window.partitionBy("one", "two").orderBy("start")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    ranges = hits.select("one", "two", "hit.*").groupBy("one", "two", "start").agg(F.max("end").alias("end"))
    ranges = ranges.withColumn("new", F.when(F.col("start") <= reach, 0).otherwise(1)).withColumn("range", F.sum("new").over(order))
    ranges = ranges.groupBy("one", "two", "range").agg(F.struct(F.min("start").alias("start"), F.max("end").alias("end")).alias("hit"))
    spans = ranges.groupBy("one", "two").agg(F.array_sort(F.collect_list("hit")).alias("hits"))
    hits = written(spans.join(named, ["one", "two"]), "found")

    names = docs.columns
    one, two, n = (free_name([*names, "hits", "items"], c) for c in ("one", "two", "n_words"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [words(part, ALNUM_LOWER).counts for part in slices(batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(found) if found else np.zeros(0), pa.int64())], [*batch.schema.names, n])

    rows = docs.withColumns({one: own[0], two: own[1]})
    rows = rows.mapInArrow(count, rows.withColumn(n, F.lit(0).cast("long")).schema)
    out = rows.join(hits.withColumnsRenamed({"one": one, "two": two}), [one, two], "left")
    return out.select(*names, F.col(n).alias("n_words"), F.coalesce("hits", F.array().cast(HITS)).alias("hits"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def _window_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(window, n, offset, word) of each word of each window."""
    for batch in batches:
        n = batch.column(1).to_numpy()
        row = pa.array(np.repeat(np.arange(len(n)), n))
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        found = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), pa.array(offset.astype(np.int32)), pa.array(found)], ["window", "n", "offset", "word"])


def marker(block: Block | None, at: int):
    """Task function that adds a block's places to the columns n_words, hits and items."""
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, hits, items = [], batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            for part in slices(batch.column(at)):
                w = words(part, ALNUM_LOWER)
                counts.append(w.counts)
                start, window = block.find(w) if block else (np.zeros(0, np.int64), np.zeros(0, np.int64))
                if not len(start):
                    continue
                order = np.argsort(start, kind="stable")
                start, window = start[order], window[order]
                end = start + block.size[window]
                text = w.text[start]
                edges = np.flatnonzero(np.diff(text)) + 1
                for s, e, v, i in zip(np.split(start, edges), np.split(end, edges), np.split(window, edges), text[np.r_[0, edges]]):
                    base = w.first[i]
                    reach = np.maximum.accumulate(e)
                    opens = np.flatnonzero(np.r_[True, s[1:] > reach[:-1]])
                    closes = reach[np.r_[opens[1:] - 1, len(s) - 1]]
                    row = part.row + int(i)
                    hits[row] = (hits[row] or []) + [{"start": int(a - base), "end": int(z - base)} for a, z in zip(s[opens], closes)]
                    found = np.unique(np.concatenate([block.item_of[k] for k in np.unique(v)]))
                    items[row] = sorted({*(items[row] or []), *(block.items[k] for k in found)})
            arrays = list(batch.columns)
            arrays[-3] = pa.array(np.concatenate(counts) if counts else np.zeros(0), pa.int64())
            arrays[-2] = pa.array([x or [] for x in hits], pa.list_(span))
            arrays[-1] = pa.array([x or [] for x in items], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, batch.schema.names)

    return mark


def covered_words(hits: str = "hits") -> Column:
    """Words inside the union of the ranges."""
    folded = F.aggregate(
        F.array_sort(F.col(hits)),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("until")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(x["end"] - F.greatest(x["start"], acc["until"]), F.lit(0).cast("long"))).alias("n"),
            F.greatest(acc["until"], x["end"]).alias("until"),
        ),
    )
    return folded["n"]


def contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """`with_hits` plus n_hit, n_items, items_sha256 and contaminated. Columns of the same names
    are replaced."""
    out = with_hits(docs, items, **options)
    return out.withColumns({
        "n_hit": F.when(F.size("hits") == 0, F.lit(0).cast("long")).otherwise(covered_words("hits")),
        "n_items": F.size("items").cast("long"),
        "items_sha256": F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256),
    }).withColumn("contaminated", F.col("n_hit") > 0)
