"""Repeated passages by collinear chaining of seeds.

1. Each text becomes a row of word codes (two bytes of a word's hash); all later steps read these.
2. Seeds: the runs of k words whose hash falls in a fixed share, short enough that texts of which
   every fifth word differs share some; and chosen runs of 25 words, those with the least hash
   among 26 neighbours, of which any `min_words` (50) equal words share one. All places of a seed
   are matched with its source: its first place in the document of the smallest id that has it, so
   a passage that repeats gives one match per place, not per pair. Places in the source's own text
   match it too, from `min_words` words after it on.
3. Around each chosen run that stands in two places, all runs of `min_words` words are seeds of a
   second round. Such a run is a passage with its source by itself, so every exact passage is found
   whatever else its parts stand in. Of unbroken matches every 25th and the last ones are kept,
   which cover the same words.
4. The matches of a (document, source) pair are chained: ordered in both texts, a seed scores
   its words, a gap costs by its length in both texts. A Fenwick tree over the source positions
   gives the best predecessor, so a pair of n matches takes n log n steps.
5. Chains are aligned on the words of both texts: along the diagonals of their seeds, with the
   best switch between two diagonals, and beyond both ends. Every stretch of an alignment that is
   long and alike enough is in a reported passage, whatever gaps the chain bridges.

Seeds travel in sorted, compressed portions, one per block of texts and bucket of hashes; a bucket
holds about `BUCKET_SEEDS`. Seeds that a sample shows to be more frequent than that are kept out of the
buckets: their sources are an aggregate with partial sums, at most one row per `HOT` places of
seeds, shipped to the tasks, which match the places where they stand. One task holds a bucket, one
pair's matches or two texts' slices at a time.

Defined results: null, empty and short texts have no passage; of equal texts the one with the
smallest id is the source; a passage that repeats inside one text has that text as source of its
later copies; rows of one id are one document (alignment uses one of them); a null
id has no passage; a very long text is worked on in slices but for its codes and matches; columns
other than id and text are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkseries.llm.shared import free_name, written
from sparkseries.llm.words import SPACED_LOWER, Words, grams, slices, words

K = 4
SHARE = 2  # of the short seeds every second hash
PART = 25  # words of a chosen run
SLICE_WORDS = 1 << 20
BUCKET_SEEDS = 1_500_000
HOT = 1_000_000
SAMPLE = 32  # of the documents, for the hot seeds
SHORT, CHOSEN, LONG = 0, 1, 2  # kinds of seeds
WEIGHT = 8  # score of a seed in a chain
GAP = 0.25  # cost of a gap, per word of it in either text


def code_slices(column: pa.Array) -> Iterator[tuple[int, Words]]:
    """(first row, words) of a column of codes, about `SLICE_WORDS` words at a time."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + 2 * SLICE_WORDS, side="right")) - 1)
        codes = data[offsets[row] : offsets[to]].view(np.uint16).astype(np.uint64)
        first = (offsets[row : to + 1] - offsets[row]) // 2
        yield row, Words(codes, first, first, np.repeat(np.arange(to - row), np.diff(first)), first)
        row = to


def code_arrays(column: pa.Array) -> Iterator[np.ndarray]:
    """The codes of each row."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return (data[a:b].view(np.uint16) for a, b in zip(offsets, offsets[1:]))


def rolling(least, x: np.ndarray, size: int) -> np.ndarray:
    """`least` (np.minimum or np.maximum) of each `size` neighbours, in steps that double."""
    step = 1
    while 2 * step <= size:
        x = least(x[:-step], x[step:])
        step *= 2
    return least(x[: len(x) - (size - step)], x[size - step :])


def chosen_runs(w: Words, part: int, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the runs of `part` words that have the least hash of some `min_words` words."""
    h, ok = grams(w, part)
    near = min_words - part + 1
    windows = len(h) - min_words + 1
    if windows < 1:
        return np.zeros(0, np.int64), h[:0]
    least = rolling(np.minimum, h[: windows + near - 1], near)
    least[w.text[:windows] != w.text[min_words - 1 :]] = 0  # windows over the end of a text
    best = rolling(np.maximum, np.r_[np.zeros(near - 1, np.uint64), least, np.zeros(near - 1, np.uint64)], near)
    at = np.flatnonzero(ok[: len(best)] & (h[: len(best)] == best) & (best > 0))
    return at, h[at]


class Seeds(NamedTuple):
    """Seeds of some texts: row of the text, place in it, hash, and the words before and after."""

    row: np.ndarray
    place: np.ndarray
    hash: np.ndarray
    around: np.ndarray


def first_seeds(column: pa.Array, places: pa.Array | None, k: int, part: int, min_words: int, share: int) -> Iterator[tuple[int, Seeds]]:
    """(kind, seeds) of the first round."""
    for row, w in code_slices(column):
        h, ok = grams(w, k)
        at = np.flatnonzero(ok & (h % np.uint64(share) == 0))
        for kind, at, h in ((SHORT, at, h[at] & ~np.uint64(0xFFFF)), (CHOSEN, *chosen_runs(w, part, min_words))):
            yield kind, Seeds(w.text[at] + row, at - w.first[w.text[at]], h, np.zeros(len(at), np.int64))


def long_seeds(column: pa.Array, places: pa.Array, k: int, part: int, min_words: int, share: int) -> Iterator[tuple[int, Seeds]]:
    """(kind, seeds) of the second round: all runs of `min_words` words with a run of `part` words at one of `places`."""
    offsets, flat = places.offsets.to_numpy(), places.flatten().to_numpy()
    for row, w in code_slices(column):
        n = len(w.first) - 1
        if not len(w.hash):
            continue
        at = flat[offsets[row] : offsets[row + n]] + np.repeat(w.first[:-1], np.diff(offsets[row : row + n + 1]))
        text = np.repeat(np.arange(n), np.diff(offsets[row : row + n + 1]))
        inside = at + part <= w.first[text + 1]  # else of another row of a repeated id
        at, text = at[inside], text[inside]
        cover = np.zeros(len(w.hash) + 1, np.int64)
        np.add.at(cover, np.maximum(at - (min_words - part), w.first[text]), 1)
        np.add.at(cover, at + 1, -1)
        h, ok = grams(w, min_words)
        at = np.flatnonzero(ok & (np.cumsum(cover)[:-1] > 0))
        codes = np.r_[w.hash, 0].astype(np.int64)
        text = w.text[at]
        before = np.where(at > w.first[text], codes[at - 1], -1)
        after = np.where(at + min_words < w.first[text + 1], codes[np.minimum(at + min_words, len(w.hash))], -1)
        yield LONG, Seeds(text + row, at - w.first[text], h[at], (before << 32) + after)


def hot_seeds(rows: DataFrame, seeds_of, options: tuple) -> np.ndarray:
    """Seeds that stand in about `HOT` places or more, by a sample of the documents; sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [s.hash | np.uint64(kind) if kind == SHORT else s.hash for kind, s in seeds_of(batch.column(1), batch.column(2), *options)]
            if found:
                values, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n, pa.int64())], ["seed", "n"])

    sample = rows.where(F.pmod(F.xxhash64("id"), F.lit(SAMPLE)) == 0).mapInArrow(run, "seed long, n long")
    found = sample.groupBy("seed").agg(F.sum("n").alias("n")).where(F.col("n") >= HOT // SAMPLE).toArrow()
    return np.sort(found.column("seed").to_numpy().astype(np.int64).view(np.uint64))


def sealed(ids: pa.Array, seeds: Seeds) -> bytes:
    """Sorted seeds as a compressed Arrow stream, hashes as differences."""
    batch = pa.RecordBatch.from_arrays(
        [ids, pa.array(np.diff(seeds.hash, prepend=np.uint64(0)).view(np.int64)), pa.array(seeds.place.astype(np.int32)), pa.array(seeds.around)],
        ["id", "hash", "place", "around"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def opened(payload: bytes) -> tuple[pa.Array, Seeds]:
    with pa.ipc.open_stream(payload) as stream:
        batch = stream.read_next_batch()
    ids, h, place, around = batch.columns
    return ids, Seeds(place.to_numpy(), place.to_numpy().astype(np.int64), np.cumsum(h.to_numpy().view(np.uint64), dtype=np.uint64), around.to_numpy())


def matches(ids: pa.Array, s: Seeds, kind: int, min_words: int, part: int) -> tuple[pa.Array, ...]:
    """(id, source, place, source place) of all places of seeds that stand in several, and for chosen
    runs (id, null, place, null) of all of their places."""
    coded = ids.dictionary_encode()
    rank = np.empty(len(coded.dictionary), np.int64)
    rank[pa.compute.sort_indices(coded.dictionary).to_numpy()] = np.arange(len(rank))
    own = rank[coded.indices.to_numpy()]
    order = np.lexsort((s.place, own, s.hash))
    h, own, place, around = s.hash[order], own[order], s.place[order], s.around[order]
    new = np.r_[True, h[1:] != h[:-1]][: len(h)]
    start = np.flatnonzero(new)[np.cumsum(new) - 1]
    several = np.repeat(np.diff(np.r_[np.flatnonzero(new), len(h)]) > 1, np.diff(np.r_[np.flatnonzero(new), len(h)]))
    hit = several & ((own != own[start]) | (place - place[start] >= min_words))
    if kind == LONG:
        same = around == around[start]
        inner = same & (around >> 32 >= 0) & (around & 0xFFFFFFFF < 0xFFFFFFFF)
        hit &= ~inner | (place % part == 0)
    hit = np.flatnonzero(hit)
    shown = np.flatnonzero(several) if kind == CHOSEN else hit[:0]
    take = lambda rows: ids.take(pa.array(order[rows]))
    gap = pa.nulls(len(shown), ids.type)
    ints = lambda a, b: pa.array(np.r_[a, b].astype(np.int32))
    return (pa.concat_arrays([take(hit), take(shown)]), pa.concat_arrays([take(start[hit]), gap]),
            ints(place[hit], place[shown]), ints(place[start[hit]], np.full(len(shown), -1)))


MATCH = ("id", "source", "place", "source_place", "kind")


def seed_matches(rows: DataFrame, seeds_of, n_seeds: int, *options) -> DataFrame:
    """(id, source, place, source_place, kind) of the seeds of `rows` (id, codes, places)."""
    buckets = max(1, -(-n_seeds // BUCKET_SEEDS))
    min_words, part = options[2], options[1]
    hot = hot_seeds(rows, seeds_of, options) if n_seeds >= HOT else np.zeros(0, np.uint64)

    def is_hot(h: np.ndarray) -> np.ndarray:
        return hot[np.minimum(np.searchsorted(hot, h), len(hot) - 1)] == h if len(hot) else np.zeros(len(h), bool)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {SHORT: [], CHOSEN: [], LONG: []}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for kind, found in held.items():
                if not found:
                    continue
                ids = pa.concat_arrays([i for i, _ in found])
                s = Seeds(*(np.concatenate(x) for x in zip(*(s for _, s in found))))
                found.clear()
                bucket = ((s.hash >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
                order = np.lexsort((s.hash, bucket))
                edge = np.searchsorted(bucket[order], np.arange(buckets + 1))
                for b in np.flatnonzero(np.diff(edge)):
                    at = order[edge[b] : edge[b + 1]]
                    payload = sealed(ids.take(pa.array(at)), Seeds(*(x[at] for x in s)))
                    yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([kind], pa.int32()), pa.array([payload], pa.binary())], ["bucket", "kind", "payload"])

        for batch in batches:
            for kind, s in seeds_of(batch.column(1), batch.column(2), *options):
                cold = np.flatnonzero(~is_hot(s.hash))
                if len(cold):
                    held[kind].append((batch.column(0).take(pa.array(s.row[cold])), Seeds(*(x[cold] for x in s))))
                    size += len(cold)
                if size >= BUCKET_SEEDS:
                    yield from flush()
                    size = 0
        yield from flush()

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def found() -> Iterator[pa.RecordBatch]:
            if held:
                columns = matches(pa.concat_arrays([i for i, _ in held]), Seeds(*(np.concatenate(x) for x in zip(*(s for _, s in held)))), now[1], min_words, part)
                t = pa.table([*columns, pa.array(np.full(len(columns[0]), now[1]), pa.int32())], MATCH)
                yield from t.to_batches(1 << 17)

        for batch in batches:
            for i in range(batch.num_rows):
                key = (batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
                if key != now:
                    yield from found()
                    now, held = key, []
                held.append(opened(batch.column(2)[i].as_py()))
        yield from found()

    schema = rows.select("id", F.col("id").alias("source"), *[F.lit(0).alias(c) for c in MATCH[2:]]).schema
    packed = rows.mapInArrow(pack, "bucket int, kind int, payload binary").repartition("bucket", "kind").sortWithinPartitions("bucket", "kind")
    out = packed.mapInArrow(join, schema)
    return out.unionByName(hot_matches(rows, seeds_of, hot, options, schema)) if len(hot) else out


def hot_matches(rows: DataFrame, seeds_of, hot: np.ndarray, options: tuple, schema) -> DataFrame:
    """The matches of the hot seeds: their sources are aggregated first, then the places are matched
    where they are."""
    min_words, part = options[2], options[1]

    def places(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, Seeds]]:
        for kind, s in seeds_of(batch.column(1), batch.column(2), *options):
            at = np.minimum(np.searchsorted(hot, s.hash), len(hot) - 1)
            keep = np.flatnonzero(hot[at] == s.hash)
            if len(keep):
                yield kind, at[keep], Seeds(*(x[keep] for x in s))

    def earliest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, at, s in places(batch):
                order = np.lexsort((s.place, s.row, at))
                edge = order[np.r_[True, (np.diff(at[order]) != 0) | (np.diff(s.row[order]) != 0)]]
                ids = batch.column(0).take(pa.array(s.row[edge]))
                yield pa.RecordBatch.from_arrays([pa.array(at[edge].astype(np.int64)), ids, pa.array(s.place[edge].astype(np.int32)), pa.array(s.around[edge])], ["at", "id", "place", "around"])

    first = rows.select(F.lit(0).cast("long").alias("at"), "id", F.lit(0).alias("place"), F.lit(0).cast("long").alias("around")).schema
    best = rows.mapInArrow(earliest, first).groupBy("at").agg(F.min(F.struct("id", "place", "around")).alias("best")).select("at", "best.*").toArrow()
    best = best.take(pa.compute.sort_indices(best.column("at"))).combine_chunks()
    known = best.column("at").to_numpy()
    source, source_place, source_around = best.column("id").combine_chunks(), best.column("place").to_numpy().astype(np.int64), best.column("around").to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, at, s in places(batch):
                at = np.searchsorted(known, at)
                ids = batch.column(0).take(pa.array(s.row))
                other = source.take(pa.array(at))
                away = ~pa.compute.equal(ids, other).to_numpy(zero_copy_only=False)
                hit = away | (s.place - source_place[at] >= min_words)
                if kind == LONG:
                    inner = (s.around == source_around[at]) & (s.around >> 32 >= 0) & (s.around & 0xFFFFFFFF < 0xFFFFFFFF)
                    hit &= ~inner | (s.place % part == 0)
                hit = pa.array(np.flatnonzero(hit))
                shown = pa.array(np.arange(len(at) if kind == CHOSEN else 0))
                t = pa.table([
                    pa.concat_arrays([ids.take(hit), ids.take(shown)]), pa.concat_arrays([other.take(hit), pa.nulls(len(shown), ids.type)]),
                    pa.array(np.r_[s.place[hit], s.place[shown]].astype(np.int32)), pa.array(np.r_[source_place[at][hit], np.full(len(shown), -1)].astype(np.int32)),
                    pa.array(np.full(len(hit) + len(shown), kind), pa.int32())], MATCH)
                yield from t.to_batches()

    return rows.mapInArrow(run, schema)


def chains(x: np.ndarray, y: np.ndarray, k: int) -> list[np.ndarray]:
    """Index lists of disjoint collinear chains of at least two matches, best first.

    score(i) = k + max(0, score(j) - GAP * ((x_i - x_j) + (y_i - y_j))) over j before i in both
    texts. Adding GAP * (x + y) to the scores makes the best j a prefix maximum over y.
    """
    n = len(x)
    order = np.lexsort((-y, x))  # of equal x the larger y first, so that they do not chain
    xs, ys = x[order].tolist(), y[order].tolist()
    rank = np.unique(y[order], return_inverse=True)[1].tolist()
    size = max(rank) + 1
    tree_value, tree_at = [0.0] * (size + 1), [-1] * (size + 1)
    score, back = [0.0] * n, [-1] * n
    for i in range(n):
        level = GAP * (xs[i] + ys[i])
        best, at = level, -1
        r = rank[i]  # strictly smaller y
        while r > 0:
            if tree_at[r] >= 0 and tree_value[r] > best:
                best, at = tree_value[r], tree_at[r]
            r -= r & -r
        score[i] = k + best - level
        back[i] = at
        value, r = score[i] + level, rank[i] + 1
        while r <= size:
            if tree_at[r] < 0 or tree_value[r] < value:
                tree_value[r], tree_at[r] = value, i
            r += r & -r
    used = [False] * n
    out = []
    for i in sorted(range(n), key=lambda i: (-score[i], i)):
        path = []
        while i >= 0 and not used[i]:
            used[i] = True
            path.append(i)
            i = back[i]
        if len(path) > 1:
            out.append(order[np.array(path[::-1])])
    return out


def runs_of(x: np.ndarray, y: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """A chain as runs (start, end, shift) of x on one diagonal; y = x - shift."""
    shift = x - y
    edge = np.flatnonzero(np.diff(shift)) + 1
    return [(int(a[0]), int(a[-1]) + k, int(s[0])) for a, s in zip(np.split(x, edge), np.split(shift, edge))]


def thinned(x: np.ndarray, y: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Matches without those that only repeat words of others: of the matches on a diagonal that
    leave no word between them, one in k words and the last one are kept."""
    order = np.lexsort((x, x - y))
    x, y = x[order], y[order]
    new = np.r_[True, (np.diff(x) != 0) | (np.diff(y) != 0)][: len(x)]
    x, y = x[new], y[new]
    edge = np.ones(len(x) + 1, bool)
    edge[1:-1] = (np.diff(x) > k) | (np.diff(x - y) != 0)
    start = np.maximum.accumulate(np.where(edge[:-1], np.arange(len(x)), 0))
    step = (x - x[start]) // k
    keep = edge[:-1] | edge[1:]
    keep[1:] |= step[1:] != step[:-1]
    return x[keep], y[keep]


def straight(x: np.ndarray) -> list[np.ndarray]:
    """`chains` of matches on one diagonal, ascending: the best predecessor is always the last one."""
    out, begin, value = [], 0, -1.0
    for i, level in enumerate((2 * GAP * (x - x[0])).tolist()):
        if value <= level and i:
            out.append((begin, i))
            begin = i
        value = WEIGHT + max(value, level)
    return [np.arange(a, b) for a, b in [*out, (begin, len(x))] if b - a > 1]


def joined(x: np.ndarray, y: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """Runs (start, end, shift) of matches of `size` words each, that meet on one diagonal."""
    shift = x - y
    order = np.lexsort((x, shift))
    x, shift = x[order], shift[order]
    edge = np.flatnonzero((np.diff(shift) != 0) | (np.diff(x) > size)) + 1
    return sorted((int(a[0]), int(a[-1]) + size, int(d[0])) for a, d in zip(np.split(x, edge), np.split(shift, edge)) if len(a))


def fewest(runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """As few of the sorted runs as cover their words."""
    cover: list[tuple[int, int, int]] = []
    for run in runs:
        if cover and run[1] <= cover[-1][1]:
            continue
        if len(cover) > 1 and run[0] <= cover[-2][1]:
            cover.pop()
        cover.append(run)
    return cover


def chained_runs(x: np.ndarray, y: np.ndarray, kind: np.ndarray, k: int, part: int, min_words: int) -> list[list[tuple[int, int, int]]]:
    """The chains of a pair's seeds, as runs, and the runs of its long seeds that are in no chain.
    Chosen and long runs, as few as cover their words, chain as the short seeds in them."""
    out = []
    xs, ys = [x[kind == SHORT]], [y[kind == SHORT]]
    long = joined(x[kind == LONG], y[kind == LONG], min_words)
    for start, end, shift in fewest(sorted(joined(x[kind == CHOSEN], y[kind == CHOSEN], part) + long, key=lambda run: (run[0], -run[1]))):
        xs.append(np.r_[start : end - k : k, end - k])
        ys.append(xs[-1] - shift)
    xs, ys = thinned(np.concatenate(xs), np.concatenate(ys), k)
    if len(xs) > 1:
        found = straight(xs) if (xs - ys == xs[0] - ys[0]).all() else chains(xs, ys, WEIGHT)
        out = [runs_of(xs[path], ys[path], k) for path in found]
    held: dict[int, list[tuple[int, int]]] = {}
    for runs in out:
        for start, end, d in runs:
            held.setdefault(d, []).append((start, end))
    return out + [[run] for run in fewest(long) if not any(start <= run[0] and run[1] <= end for start, end in held.get(run[2], []))]


def columns(a: np.ndarray, b: np.ndarray, runs: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Word pairs (position in a, position in b) of a chain from end to end of both slices: along
    the diagonals of its runs, with the switch between two diagonals at which most words agree."""
    _, end, shift = runs[0]
    end = min(end, len(a), len(b) + shift)
    at_a = [np.arange(max(0, shift), end)]
    at_b = [at_a[0] - shift]
    for begin, until, new in runs[1:]:
        left = end - shift  # the end of the last run in b
        length = max(0, min(begin - end, begin - new - left))
        if length:
            one = a[end : end + length] == b[left : left + length]
            two = a[begin - length : begin] == b[begin - length - new : begin - new]
            turn = int((np.r_[0, np.cumsum(one)] + np.r_[np.cumsum(two[::-1])[::-1], 0]).argmax())
            before, after = np.arange(end, end + turn), np.arange(begin - length + turn, begin)
            at_a += [before, after]
            at_b += [before - shift, after - new]
        run = np.arange(max(begin, end, left + new), min(until, len(a), len(b) + new))
        at_a.append(run)
        at_b.append(run - new)
        if len(run):
            end, shift = int(run[-1]) + 1, new
    run = np.arange(end, min(len(a), len(b) + shift))
    return np.concatenate([*at_a, run]), np.concatenate([*at_b, run - shift])


def widest(at_a: np.ndarray, at_b: np.ndarray, same: np.ndarray, first: np.ndarray, end: np.ndarray, min_words: int, likeness: float) -> list[tuple[int, int]]:
    """The stretches from a value of `first` to one of `end`, ascending columns, that are long and
    alike enough, less those inside another one and those that their neighbours cover."""
    agree = np.r_[0, np.cumsum(same)]
    need = [(agree[first] - likeness * at[first] - 1e-6, agree[end] - likeness * (at[end - 1] + 1)) for at in (at_a, at_b)]
    out, reach = [], -1
    for i in range(len(first)):
        if reach == len(end) - 1:
            break
        q = max(i, reach + 1)
        long = at_a[end[q:] - 1] + 1 - at_a[first[i]] >= min_words
        good = np.flatnonzero(long & (need[0][1][q:] >= need[0][0][i]) & (need[1][1][q:] >= need[1][0][i]))
        if len(good):
            reach = q + int(good[-1])
            if len(out) > 1 and first[i] <= out[-2][1]:
                out.pop()
            out.append((int(first[i]), int(end[reach])))
    return out


def stretches(at_a: np.ndarray, at_b: np.ndarray, same: np.ndarray, min_words: int, likeness: float) -> list[tuple[int, int]]:
    """Column ranges of the passages of an alignment; together they cover each range of at least
    `min_words` words, the first and last agreeing, of which `likeness` agree. A passage begins
    and ends with three agreeing words, unless what these leave of it is covered by no passage."""
    if same.sum() < likeness * min_words:
        return []
    joined = np.r_[False, same[1:] & same[:-1] & (np.diff(at_a) == 1) & (np.diff(at_b) == 1), False]
    first, end = np.flatnonzero(same & ~joined[:-1]), np.flatnonzero(same & ~joined[1:]) + 1
    firm = end - first >= 3
    out = widest(at_a, at_b, same, first[firm], end[firm], min_words, likeness)
    covered = np.zeros(len(same) + 1, np.int64)
    for lo, hi in out:
        covered[lo:hi] = 1
    missing = np.r_[0, np.cumsum(1 - covered)]
    for lo, hi in widest(at_a, at_b, same, first, end, min_words, likeness):
        inner = np.flatnonzero(firm & (first >= lo) & (end <= hi))
        if not len(inner) or missing[end[inner[-1]]] > missing[first[inner[0]]]:
            out.append((lo, hi))
    return out


def repeated_passages(docs: DataFrame, id_: str = "doc_id", text: str = "text", min_words: int = 50, likeness: float = 0.8,
                      k: int = K) -> DataFrame:
    """(id, start_word, end_word, source id, source_start, source_end, n_agree): each passage of at
    least `min_words` words that also stands in a document with a smaller id, or at least as many
    words earlier in the same document, with at least
    `likeness` of its words agreeing. Word positions count from 0, ends are exclusive."""
    margin = min_words + k
    part = min(PART, (min_words + 1) // 2)
    codes = written(word_codes(docs, id_, text, min_words), "codes")
    n_words = (codes.agg(F.sum(F.octet_length("codes"))).collect()[0][0] or 0) // 2
    plain = codes.select("id", "codes", F.lit(None).cast("array<int>").alias("places"))
    options = (k, part, min_words, SHARE)
    near = written(seed_matches(plain, first_seeds, n_words // SHARE + n_words // 10, *options), "matches")
    shown = written(near.where("source IS NULL").groupBy("id").agg(F.collect_list("place").alias("places"), F.count(F.lit(1)).alias("n")), "places")
    n_long = (shown.agg(F.sum("n")).collect()[0][0] or 0) * (part // 3 + 1)
    around = codes.join(shown.drop("n"), "id")
    far = written(seed_matches(around, long_seeds, n_long, *options), "long-matches")
    found = near.where("source IS NOT NULL").unionByName(far)
    pairs = found.groupBy("id", "source").agg(
        F.collect_list(F.struct("place", "source_place", "kind")).alias("matches"), F.max("kind").alias("kind"))
    pairs = pairs.where((F.size("matches") > 1) | (F.col("kind") > SHORT)).drop("kind")

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            offsets = lists.offsets.to_numpy()
            flat = lists.flatten()
            place, source, kind = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1, 2))
            offsets = offsets - offsets[0]
            row, out = [], []
            for i in range(batch.num_rows):
                at = slice(offsets[i], offsets[i + 1])
                for runs in chained_runs(place[at], source[at], kind[at], k, part, min_words):
                    row.append(i)
                    out.append(np.array(runs, np.int32).ravel())
            at = pa.array(row, pa.int32())
            ends = pa.array(np.r_[0, np.cumsum([len(r) for r in out])].astype(np.int32))
            runs = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(out) if out else np.zeros(0, np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), runs], ["id", "source", "runs"])

    schema = pairs.select("id", "source", F.lit(None).cast("array<int>").alias("runs")).schema
    chained = pairs.mapInArrow(chain, schema)
    size = F.size("runs")
    first, last, shift = F.get("runs", F.lit(0)), F.get("runs", size - 2), F.get("runs", size - 1)
    chained = written(chained.withColumns({
        "a_from": F.greatest(first - margin, F.lit(0)), "a_to": last + margin,
        "b_from": F.greatest(first - F.get("runs", F.lit(2)) - margin, F.lit(0)), "b_to": last - shift + margin}), "chains")

    cut = lambda lo, hi: F.substring(F.col("codes"), 2 * F.col(lo) + 1, 2 * (F.col(hi) - F.col(lo)))
    one = chained.join(codes, "id").withColumn("a", cut("a_from", "a_to")).drop("codes")
    both = one.join(codes.withColumnRenamed("id", "source"), "source").withColumn("b", cut("b_from", "b_to")).drop("codes")
    both = both.select("id", "source", "runs", "a_from", "b_from", "a", "b")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, out = [], []
            runs, ends = batch.column(2).flatten().to_numpy(), batch.column(2).offsets.to_numpy() - batch.column(2).offsets[0].as_py()
            a_from, b_from = (batch.column(i).to_numpy() for i in (3, 4))
            for i, (a, b) in enumerate(zip(code_arrays(batch.column(5)), code_arrays(batch.column(6)))):
                lo_a, lo_b = int(a_from[i]), int(b_from[i])
                flat = runs[ends[i] : ends[i + 1]].reshape(-1, 3).tolist()
                local = [(s - lo_a, e - lo_a, d - lo_a + lo_b) for s, e, d in flat]
                if local[-1][1] > len(a) or local[-1][1] - local[-1][2] > len(b):
                    continue  # another row of a repeated id
                if len(local) == 1:  # one diagonal
                    shift = local[0][2]
                    lo, hi = max(0, shift), min(len(a), len(b) + shift)
                    same = a[lo:hi] == b[lo - shift : hi - shift]
                    if np.count_nonzero(same) < likeness * min_words:
                        continue
                    at_a = np.arange(lo, hi)
                    at_b = at_a - shift
                else:
                    at_a, at_b = columns(a, b, local)
                    same = a[at_a] == b[at_b]
                for lo, hi in stretches(at_a, at_b, same, min_words, likeness):
                    row.append(i)
                    out.append((at_a[lo] + lo_a, at_a[hi - 1] + 1 + lo_a, at_b[lo] + lo_b, at_b[hi - 1] + 1 + lo_b, same[lo:hi].sum()))
            at = pa.array(row, pa.int32())
            table = np.array(out, np.int64).reshape(-1, 5)
            arrays = [batch.column(0).take(at), pa.array(table[:, 0]), pa.array(table[:, 1]), batch.column(1).take(at), *(pa.array(table[:, j]) for j in (2, 3, 4))]
            yield pa.RecordBatch.from_arrays(arrays, names)

    names = [id_, "start_word", "end_word", f"source_{id_}", "source_start", "source_end", "n_agree"]
    long = lambda name: F.lit(0).cast("long").alias(name)
    schema = both.select(F.col("id").alias(id_), long(names[1]), long(names[2]), F.col("source").alias(names[3]), *[long(x) for x in names[4:]]).schema
    return both.mapInArrow(align, schema)


def word_codes(docs: DataFrame, id_: str, text: str, min_words: int) -> DataFrame:
    """(id, codes): two bytes of hash per word, of texts that can hold a passage."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                w = words(part, SPACED_LOWER)
                use = np.flatnonzero(w.counts >= min_words)
                code = (w.hash & np.uint64(0xFFFF)).astype(np.uint16)
                packed = [code[w.first[i] : w.first[i + 1]].tobytes() for i in use]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(use + part.row)), pa.array(packed, pa.binary())], ["id", "codes"])

    rows = docs.where(F.col(id_).isNotNull()).select(F.col(id_).alias("id"), F.col(text).alias("text"))
    schema = rows.select("id", F.lit(None).cast("binary").alias("codes")).schema
    return rows.mapInArrow(run, schema)


def without_passages(docs: DataFrame, passages: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with the words of the passages cut out of their texts; a text of which no word is
    left goes. Columns stay as they are. Texts without a passage are not changed."""
    names = docs.columns
    own, cut = free_name(names, "own_id"), free_name(names, "cut")
    ranges = passages.groupBy(F.col(id_).alias(own)).agg(F.collect_list(F.struct("start_word", "end_word")).alias(cut))
    rows = docs.join(ranges, docs[id_] == ranges[own], "left").drop(own)
    at, cut_at = names.index(text), len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = batch.column(cut_at).to_pylist()
            column, texts, keep = batch.column(at), [], []
            for i, ranges in enumerate(cuts):
                value = column[i].as_py()
                if ranges:
                    value = cut_words(value, [(r["start_word"], r["end_word"]) for r in ranges])
                    if not value.strip():
                        continue
                keep.append(i)
                texts.append(value)
            arrays = [c.take(pa.array(keep, pa.int32())) for c in batch.columns[:cut_at]]
            arrays[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names)

    return rows.mapInArrow(run, docs.schema)


def cut_words(text: str, ranges: list[tuple[int, int]]) -> str:
    """The text without the words of the ranges."""
    part = next(iter(slices(pa.array([text], pa.large_string()))))
    w = words(part, SPACED_LOWER)
    gone = np.zeros(len(part.data) + 1, np.int64)
    n = len(w.hash)
    for a, b in ranges:
        if a < n:
            gone[w.start[a]] += 1
            gone[w.end[min(b, n) - 1]] -= 1
    return part.data[np.cumsum(gone)[:-1] == 0].tobytes().decode("utf-8", "replace")
