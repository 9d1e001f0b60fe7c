"""Near-duplicate documents by MinHash with tensored banding.

A document is the set of its distinct word shingles. Two small collections of `half_keys` half
keys are computed, each half key from `rows` minhashes; table (i, j) is keyed by half key i of
the first collection with half key j of the second. So half_keys ** 2 tables of 2 * rows
minhashes each cost only 2 * half_keys * rows minhash functions.

1. Documents with equal sets are one class, represented by the smallest id.
2. Classes that share a key with another class are candidates; their full sets are made.
3. A shingle that only one candidate has cannot be shared. With it, |A| - unique(A) bounds what A
   can share with anyone, and a pair is only looked at if the bound allows the similarity.
4. In every table each candidate is compared with the member of its bucket that has the fewest
   unique shingles (the centre of a group of copies), by full sets. Links make components.
5. Documents that share a bucket with another component are joined once more, exactly, by their
   rarest shingles with positional bounds, and what that leaves is compared by full sets. So no
   pair that shares a bucket is left out, and a group of copies costs about its size.

A pair at exactly the threshold shares no table with probability at most `miss`; more similar
pairs are missed more rarely. Every link between classes is confirmed on full sets; texts are of one
class if the number of their shingles and two 64-bit sums over all of them are equal.

Defined results: a text with fewer words than a shingle is one shingle; a null or empty text has
an empty set and is linked with nothing; a null id is never linked and has a null component;
rows of one id are one document; a very long text counts whole, its set in one task; columns other than id
and text are not read, so their names do not matter; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkseries.llm.components import components
from sparkseries.llm.shared import written
from sparkseries.llm.words import SPACED_LOWER, Texts, grams, mix, per_text, signed, slices, words


def shingle_sets(t: Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a slice of texts, ordered by (text, hash): (text, hash)."""
    w = words(t, SPACED_LOWER)
    h, ok = grams(w, size)
    at = np.flatnonzero(ok)
    found, text = h[at], w.text[at]
    count = w.counts
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        whole = [grams(type(w)(w.hash[a:b], w.start[a:b], w.end[a:b], np.zeros(b - a, np.int64), np.array([0, b - a])), int(b - a))[0][0]
                 for a, b in zip(w.first[short], w.first[short + 1])]
        salted = mix(np.array(whole, np.uint64) + (size - count[short]).astype(np.uint64))
        found, text = np.concatenate([found, salted]), np.concatenate([text, short])
    order = np.lexsort((found, text))
    found, text = found[order], text[order]
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
    return text[fresh], found[fresh]


def half_keys_for(similarity: float, rows: int, miss: float) -> int:
    """Half keys per collection so that a pair of this similarity shares no table with
    probability at most `miss`: one collection fails with (1 - s**rows) ** half_keys."""
    return math.ceil(math.log(miss / 2) / math.log(1 - similarity**rows))


def sketches(docs: DataFrame, id_: str, text: str, size: int, rows: int, half_keys: int) -> DataFrame:
    """(id, n, f1, f2, one, two): set size, fingerprint of the set, both collections of half keys."""
    k = 2 * half_keys * rows
    factors = mix(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0xA5A5F00D1234567)) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for part in slices(batch.column(1)):
                owner, h = shingle_sets(part, size)
                n = len(part.offsets) - 1
                first = np.searchsorted(owner, np.arange(n + 1))
                count = np.diff(first)
                full = np.flatnonzero(count)
                keys = np.zeros((n, 2 * half_keys), np.int32)
                if len(full):
                    begin = first[full]
                    for j in range(2 * half_keys):
                        acc = np.zeros(len(full), np.uint64)
                        for r in range(rows):
                            low = np.minimum.reduceat(h * factors[j * rows + r], begin)
                            acc = mix(acc + low + np.uint64(r + 1))
                        keys[full, j] = (acc >> np.uint64(32)).astype(np.uint32).view(np.int32)
                f1 = np.zeros(n, np.uint64)
                f2 = np.zeros(n, np.uint64)
                if len(full):
                    f1[full] = np.add.reduceat(h, begin)
                    f2[full] = np.bitwise_xor.reduceat(mix(h), begin)
                out.append((count, f1, f2, keys))
            columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.uint64)] * 3 + [np.zeros((0, 2 * half_keys), np.int32)]
            n = len(columns[0])
            offsets = pa.array(np.arange(n + 1, dtype=np.int32) * half_keys)
            halves = [pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(columns[3][:, s]).ravel(), pa.int32()))
                      for s in (slice(0, half_keys), slice(half_keys, None))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(columns[0].astype(np.int64)), pa.array(signed(columns[1])), pa.array(signed(columns[2])), *halves],
                ["id", "n", "f1", "f2", "one", "two"])

    rows_in = docs.select(F.col(id_).alias("id"), F.col(text).alias("text"))
    schema = rows_in.select(
        "id", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("f1"), F.lit(0).cast("long").alias("f2"),
        F.lit(None).cast("array<int>").alias("one"), F.lit(None).cast("array<int>").alias("two")).schema
    return rows_in.mapInArrow(run, schema)


def full_sets(docs: DataFrame, id_: str, text: str, wanted: DataFrame, size: int) -> DataFrame:
    """(id, set): distinct shingles of the wanted ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                owner, h = shingle_sets(part, size)
                n = len(part.offsets) - 1
                offsets = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
                sets = pa.ListArray.from_arrays(pa.array(offsets), pa.array(signed(h)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.row, n), sets], ["id", "set"])

    rows = docs.select(F.col(id_).alias("id"), F.col(text).alias("text")).join(wanted, "id", "left_semi")
    schema = rows.select("id", F.lit(None).cast("array<bigint>").alias("set")).schema
    return rows.mapInArrow(run, schema)


def reachable(shared: Column, n_a: Column, n_b: Column, least: tuple[int, int]) -> Column:
    """Whether `shared` elements of sets of these sizes reach the similarity least[0] / least[1]."""
    return least[1] * shared >= least[0] * (n_a + n_b - shared)


def confirmed(pairs: DataFrame, sets: DataFrame, least: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    one = sets.select(F.col("id").alias("a"), F.col("set").alias("set_a"))
    two = sets.select(F.col("id").alias("b"), F.col("set").alias("set_b"))
    both = pairs.select("a", "b").join(one, "a").join(two, "b")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    return both.where(reachable(shared, F.size("set_a"), F.size("set_b"), least)).select("a", "b")


def pairs_apart(sets: DataFrame, rest: DataFrame, least: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) of different components that can be similar enough: an exact prefix join.

    Shingles are ordered rarest first. Sets of sizes n and m that are similar enough share at
    least num * (n + m) / (num + den) elements, so their first common shingle stands early in
    both. How early depends on both sizes: each document gives its early shingles once per size
    class of the partner, and partners are joined by (shingle, both classes). Shingles of one
    component only are left out, and of every shingle's rows those of its largest component are
    on one side of the join only, so a group of copies is not compared with itself.
    """
    num, den = least
    weight = rest.groupBy("root").agg(F.count(F.lit(1)).alias("weight"))
    rows = sets.join(rest.join(weight, "root"), sets["id"] == rest["rep"]).select(
        "id", "root", "weight", F.size("set").cast("long").alias("n"), F.explode("set").alias("shingle"))
    often = rows.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("often"), F.min("root").alias("low"), F.max("root").alias("high"), F.max_by("root", "weight").alias("main"))
    order = Window.partitionBy("id", "n").orderBy("often", "shingle")
    place = (F.row_number().over(order) - 1).cast("long")
    early = rows.join(written(often, "often"), "shingle").withColumn("place", place).where(
        (F.col("low") != F.col("high")) & (den * (F.col("n") - F.col("place")) >= num * F.col("n")))
    size_class = lambda n: F.floor(F.log(n) / math.log(1.04))
    most = F.floor((F.col("n") - F.col("place")) * (num + den) / num) - F.col("n")  # largest partner
    early = early.withColumns({
        "own": size_class(F.col("n")), "from": size_class(F.greatest(F.floor(F.col("n") * num / den), F.lit(1))),
        "to": size_class(F.least(most, F.ceil(F.col("n") * den / num)))})
    early = early.where(F.col("from") <= F.col("to")).withColumn("partner", F.explode(F.sequence("from", "to")))
    early = written(early.select("shingle", "id", "root", "main", "n", "place", "own", "partner"), "early")
    a = early.select("shingle", F.col("own").alias("x"), F.col("partner").alias("y"), *[F.col(c).alias(f"{c}_a") for c in ("id", "root", "n", "place")])
    b = early.where("root <> main").select(
        "shingle", F.col("partner").alias("x"), F.col("own").alias("y"), *[F.col(c).alias(f"{c}_b") for c in ("id", "root", "n", "place")])
    both = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    pairs = a.join(b, ["shingle", "x", "y"]).where((F.col("root_a") != F.col("root_b")) & reachable(both, F.col("n_a"), F.col("n_b"), least))
    return pairs.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_: str = "doc_id", text: str = "text", shingle: int = 5, least: tuple[int, int] = (8, 10),
                    rows: int = 3, miss: float = 5e-4) -> DataFrame:
    """One row per row of `docs`: id, n_shingles, component_id, kept.

    Documents are linked if least[1] * |A and B| >= least[0] * |A or B|.
    """
    half_keys = half_keys_for(least[0] / least[1], rows, miss)
    all_rows = written(sketches(docs, id_, text, shingle, rows, half_keys), "sketches")
    linked = all_rows.where(F.col("id").isNotNull() & (F.col("n") > 0))
    classes = written(
        linked.groupBy("n", "f1", "f2").agg(F.min("id").alias("rep"), F.first("one").alias("one"), F.first("two").alias("two")), "classes")

    keys = classes.select("rep", "two", F.posexplode("one").alias("i", "x")).select("rep", "i", "x", F.posexplode("two").alias("j", "y")) \
        .select("rep", F.xxhash64("i", "x", "j", "y").alias("key"))
    shared = keys.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low <> high").select("key")
    # Aggregates are written before they are joined: Spark can then split a bucket with many rows.
    members = written(keys.join(written(shared, "shared"), "key", "left_semi").distinct(), "members")

    sets = written(full_sets(docs, id_, text, members.select(F.col("rep").alias("id")).distinct(), shingle), "sets")
    owners = sets.select("id", F.explode("set").alias("shingle")).groupBy("shingle").agg(
        F.min("id").alias("id"), F.max("id").alias("other"))
    unique = owners.where("id = other").groupBy("id").agg(F.count(F.lit(1)).alias("unique"))
    sizes = sets.groupBy("id").agg(F.max(F.size("set")).alias("n"))
    info = written(sizes.join(unique, "id", "left").select(
        F.col("id").alias("rep"), F.col("n").cast("long").alias("n"), F.coalesce("unique", F.lit(0)).alias("u")), "info")
    able = info.where(least[1] * (F.col("n") - F.col("u")) >= least[0] * F.col("n"))
    places = written(members.join(able, "rep"), "places")

    def allowed(a: str, b: str) -> Column:
        shared = F.least(F.col(f"n_{a}") - F.col(f"u_{a}"), F.col(f"n_{b}") - F.col(f"u_{b}"))
        return reachable(shared, F.col(f"n_{a}"), F.col(f"n_{b}"), least)

    # First pairs: every member with the centre of its bucket.
    centre = places.groupBy("key").agg(F.min(F.struct((F.col("u") / F.col("n")).alias("share"), "rep", "n", "u")).alias("c")).select(
        "key", F.col("c.rep").alias("b"), F.col("c.n").alias("n_b"), F.col("c.u").alias("u_b"))
    side = places.select("key", F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("u").alias("u_a"))
    tried = written(side.join(written(centre, "centres"), "key").where((F.col("a") != F.col("b")) & allowed("a", "b")).select("a", "b").distinct(), "tried")
    links = written(confirmed(tried, sets, least), "links")
    labels = components(links)

    # Then the documents that share a bucket with another component.
    at = places.join(labels.withColumnRenamed("id", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    apart = at.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
    rest = at.join(written(apart, "mixed"), "key", "left_semi").select("rep", "root").distinct()
    late = written(confirmed(written(pairs_apart(sets, written(rest, "apart"), least), "pairs"), sets, least), "late")
    if not late.isEmpty():
        labels = components(links.unionByName(late))

    reps = classes.select("n", "f1", "f2", "rep")
    out = all_rows.select("id", "n", "f1", "f2").join(reps, ["n", "f1", "f2"], "left").join(labels.withColumnRenamed("id", "rep"), "rep", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("root", "rep", "id"))
    out = out.select(F.col("id").alias(id_), F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.col(id_).eqNullSafe(F.col("component_id")))
