"""Position of each row inside its series.

Two forms with the same result:

- plain: one window per series. Right for resampled series, whose length is bounded by the time
  span (a year of hours is 8,760 rows) however many raw readings they stand for.
- blocked: for raw series of any length. Rows are counted by (series, time block), a table that
  running sums turn into offsets; consecutive blocks are merged into chunks of about
  `chunk_rows` rows, and rows are numbered inside (series, chunk). A block that holds more rows
  than that is split by marks on the order columns, taken from a sample of its rows, so a
  series, a day or a single minute may hold a third of all rows. The count table is made at
  once (one job), because its size decides how it is joined.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkseries.operators.joins import join_on, sized


def with_position(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    pos: str = "pos",
    total: str | None = None,
    block: Column | None = None,
    chunk_rows: int = 1_000_000,
) -> DataFrame:
    """Add the 1-based position by `order` and, on request, the series length.

    `order` should be unique inside a series; add a tie-break column where it is not. `block`
    is a non-decreasing function of the first order column, such as its minute.
    """
    if block is None:
        series = Window.partitionBy(*keys)
        out = df.withColumn(pos, F.row_number().over(series.orderBy(*order)).cast("long"))
        return out.withColumn(total, F.count(F.lit(1)).over(series)) if total else out

    rows = split_blocks(df.withColumn("_block", block), keys, order, chunk_rows)
    chunks = block_chunks(rows, keys, chunk_rows)
    chunks = sized(chunks.select(*keys, "_block", "_part", "_start", "_total"))
    # A left join: whatever the counts say, no row is lost.
    joined = join_on(rows, chunks, [*keys, "_block"], "left")
    inside = Window.partitionBy(*keys, "_part").orderBy(*order)
    out = joined.withColumn(pos, (F.col("_start") + F.row_number().over(inside)).cast("long"))
    extra = [F.col("_total").alias(total)] if total else []
    return out.select(*df.columns, pos, *extra)


def label_by_position(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], label: Callable[[Column, Column], Column], out: str, block: Column,
    chunk_rows: int = 1_000_000,
) -> DataFrame:
    """Add `label(position, series length)`, a label that is constant on runs of positions.

    A block whose first and last position have the same label takes it as a whole, from the
    counts alone; only the blocks that hold a boundary are ranked. So the rows are not shuffled,
    but for those few.
    """
    rows = split_blocks(df.withColumn("_block", block), keys, order, chunk_rows)
    counts = block_chunks(rows, keys, chunk_rows).select(*keys, "_block", "_before", "_end", "_total")
    first, last = label(F.col("_before") + 1, F.col("_total")), label(F.col("_end"), F.col("_total"))
    counts = sized(counts.withColumn("_label", first).withColumn("_whole", first.eqNullSafe(last)).drop("_end"))
    joined = join_on(rows, counts, [*keys, "_block"], "left")
    whole = joined.where(F.coalesce("_whole", F.lit(True)))
    inside = Window.partitionBy(*keys, "_block").orderBy(*order)
    cut = joined.where(~F.col("_whole")).withColumn("_label", label(F.col("_before") + F.row_number().over(inside), F.col("_total")))
    return whole.unionByName(cut).select(*df.columns, F.col("_label").alias(out))


def split_blocks(rows: DataFrame, keys: Sequence[str], order: Sequence[str], chunk_rows: int, sample: int = 16) -> DataFrame:
    """`rows` with the `_block` of large blocks split into parts of about `chunk_rows` rows.

    About `sample` rows per part of a large block are drawn by hash; every `sample`-th of them
    in order is a mark, and a row's part is the number of marks up to it. Parts are as ordered
    as blocks are. Without a large block the rows are returned as they are.
    """
    by = [*keys, "_block"]
    large = sized(rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") > chunk_rows))
    if large.isEmpty():
        return rows
    at = F.struct(*order)
    draw = F.pmod(F.xxhash64(*order), F.lit(1 << 30)) / float(1 << 30)
    drawn = join_on(rows, large, by).where(draw < F.lit(sample * 1.0) / chunk_rows).groupBy(*by).agg(F.sort_array(F.collect_list(at)).alias("_drawn"))
    every = F.sequence(F.lit(sample), F.size("_drawn"), F.lit(sample))
    marks = F.when(F.size("_drawn") >= sample, F.transform(every, lambda i: F.element_at("_drawn", i)))
    marked = join_on(rows, sized(drawn.select(*by, marks.alias("_marks"))), by, "left")
    part = F.coalesce(F.size(F.filter("_marks", lambda m: m <= at)), F.lit(0))
    part = F.when(F.col("_marks").isNull(), 0).otherwise(part)
    return marked.select(*[c for c in rows.columns if c != "_block"], F.struct(F.col("_block").alias("block"), part.alias("part")).alias("_block"))


def block_chunks(rows: DataFrame, keys: Sequence[str], chunk_rows: int) -> DataFrame:
    """One row per series and `_block`: its chunk `_part`, the rows of the series before the
    block (`_before`), up to its end (`_end`), before its chunk (`_start`) and in all (`_total`)."""
    in_order = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.groupBy(*keys, "_block")
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_before", F.coalesce(F.sum("_size").over(in_order), F.lit(0)))
        .withColumn("_end", F.col("_before") + F.col("_size"))
        .withColumn("_total", F.sum("_size").over(Window.partitionBy(*keys)))
        .withColumn("_part", F.floor(F.col("_before") / chunk_rows))
        .withColumn("_start", F.min("_before").over(Window.partitionBy(*keys, "_part")))
    )


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    before: int,
    after: int,
    block: Column | None = None,
    chunk_rows: int = 100_000,
):
    """Prepare row-offset windows that never need a whole series in one task.

    Returns (rows, window, home). Without `block` the window spans the series. With it, rows
    are cut into chunks of about `chunk_rows` rows, and each chunk also receives copies of the
    whole blocks that hold its `before` / `after` neighbouring rows. After the window columns
    are added, keep the `home` rows. Which blocks a chunk needs follows from the block counts
    alone, so the rows themselves are shuffled and sorted once.
    """
    if block is None:
        return df, Window.partitionBy(*keys).orderBy(*order), None
    rows = split_blocks(df.withColumn("_block", block), keys, order, chunk_rows)
    chunks = block_chunks(rows, keys, chunk_rows)
    needed = [F.array("_part")]
    if before > 0:
        # The next block starts where this one ends: a chunk that holds a block starting less
        # than `before` rows later looks back into this one.
        reach = Window.partitionBy(*keys).orderBy("_before").rangeBetween(0, before - 1)
        chunks = chunks.withColumn("_later", F.collect_set("_part").over(reach)).withColumn(
            "_later", F.lead("_later").over(Window.partitionBy(*keys).orderBy("_before"))
        )
        needed.append(F.coalesce(F.col("_later"), F.array().cast("array<bigint>")))
    if after > 0:
        reach = Window.partitionBy(*keys).orderBy("_end").rangeBetween(1 - after, 0)
        chunks = chunks.withColumn("_earlier", F.collect_set("_part").over(reach)).withColumn(
            "_earlier", F.lag("_earlier").over(Window.partitionBy(*keys).orderBy("_end"))
        )
        needed.append(F.coalesce(F.col("_earlier"), F.array().cast("array<bigint>")))
    chunks = chunks.select(*keys, "_block", "_part", F.array_distinct(F.concat(*needed)).alias("_needed"))
    rows = join_on(rows, sized(chunks), [*keys, "_block"], "left")
    # A row of a block that was not counted makes a chunk of its own kind and is kept.
    rows = rows.withColumn("_part", F.coalesce("_part", F.lit(-1).cast("long")))
    rows = rows.withColumn("_chunk", F.explode(F.coalesce("_needed", F.array("_part"))))
    return rows, Window.partitionBy(*keys, "_chunk").orderBy(*order), F.col("_chunk") == F.col("_part")
