"""Mixing sources to target weights: budgets down a tree, then a token prefix of each leaf.

Leaves are the combinations of the level columns (domain, language, source). A leaf offers its
tokens `max_epochs` times. From the root down, a node's budget is shared among its children by
weight; a child that cannot fill its share gives the rest to its siblings, by weight. What a
whole subtree cannot fill is known from the sums of its leaves before its parent is shared out,
so siblings absorb a shortage first, and only what they cannot take reaches the ancestors. The
level at which shares are cut follows from running sums over the children ordered by offer per
weight, so the whole tree takes one window per level and no loop over nodes.

A leaf passes through its documents in epochs; in each epoch they are ordered by a hash of seed,
epoch and id. Whole epochs are taken as long as the budget lasts; of the next one the documents
whose running token sum stays within the rest. The running sum is taken over 4096 bins of the
hash first, then over 4096 bins inside the one where the budget ends, and by document only inside
the last of these, so a leaf with a third of all rows is never sorted in one task. The documents
meet one row per leaf, which says where its budget ends; texts are not shuffled while these are few.

Defined results: a null level value is the level `(none)`; a null or empty text has no tokens
and is taken with every whole epoch; weights not named count 1, weight 0 takes nothing; repeated
rows are documents of their own; ties of the hash go by token number; an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkseries.llm.shared import written

BIN_DIGITS = 3  # hexadecimal digits of the hash that make a bin
ROUNDS = 2
WORD = r"[^\x20\x09-\x0D]+"
NONE = "(none)"


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def weight_of(level: str, weights: Mapping[str, float]) -> Column:
    if not weights:
        return F.lit(1.0)
    table = F.create_map(*[F.lit(x) for pair in weights.items() for x in (pair[0], float(pair[1]))])
    return F.coalesce(F.try_element_at(table, F.col(level)), F.lit(1.0))


def shared_out(children: DataFrame, parent: Sequence[str], level: str) -> DataFrame:
    """`children` (parent columns, level, cap, weight, given) with their `budget`: each takes
    weight * x of `given`, but not more than its cap, with one x for all siblings."""
    family = Window.partitionBy(*parent)
    per_weight = F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(F.lit(float("inf")))
    order = family.orderBy("_ratio", level)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    from_here = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = children.withColumn("_ratio", per_weight).withColumns({
        "_caps": F.coalesce(F.sum("cap").over(before), F.lit(0)), "_weights": F.sum("weight").over(from_here)})
    full = (F.col("weight") > 0) & (F.col("cap") * F.col("_weights") <= F.col("weight") * (F.col("given") - F.col("_caps")))
    rows = rows.withColumn("_full", full)
    rows = rows.withColumns({
        "_taken": F.sum(F.when(F.col("_full"), F.col("cap")).otherwise(0)).over(family),
        "_open": F.sum(F.when(F.col("_full"), 0.0).otherwise(F.col("weight"))).over(family)})
    rest = F.when(F.col("_open") > 0, F.col("weight") * (F.col("given") - F.col("_taken")) / F.col("_open")).otherwise(0.0)
    budget = F.when(F.col("_full"), F.col("cap").cast("double")).otherwise(rest)
    return rows.withColumn("budget", budget).drop("_ratio", "_caps", "_weights", "_full", "_taken", "_open")


def leaf_budgets(leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, float]], share: float, max_epochs: int) -> DataFrame:
    """Leaves (levels, tokens) with `budget` in whole tokens; the root's budget is `share` of all
    tokens."""
    caps = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    nodes = caps.groupBy().agg(F.least(F.round(F.sum("tokens") * F.lit(share)), F.sum("cap").cast("double")).alias("given"))
    for d, level in enumerate(levels):
        parent = list(levels[:d])
        children = caps.groupBy(*parent, level).agg(F.sum("cap").alias("cap")).withColumn("weight", weight_of(level, weights[level]))
        joined = children.join(nodes, parent) if parent else children.withColumn("given", nodes.scalar())
        nodes = shared_out(joined, parent, level).select(*parent, level, F.col("budget").alias("given"))
    return leaves.join(nodes.select(*levels, F.round("given").cast("long").alias("budget")), list(levels))


def bin_of_end(rows: DataFrame, names: Sequence[str], digits: int) -> DataFrame:
    """Per leaf the bin in which its budget ends, of the bins by the next `BIN_DIGITS` of `_order` after
    the first `digits`, as all its digits (`_edge`), and the tokens before it (`_begin`)."""
    bins = rows.groupBy(*names, "_rest", "_begin", F.substring("_order", 1, digits + BIN_DIGITS).alias("_bin")).agg(F.sum("_n").alias("_sum"))
    # Running sums in two levels, so that no window holds all bins of a leaf.
    bins = written(bins.withColumn("_group", F.substring("_bin", 1, digits + BIN_DIGITS - 1)), "bins")
    groups = bins.groupBy(*names, "_group").agg(F.sum("_sum").alias("_all"))
    before = Window.partitionBy(*names).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(*names, "_group", F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("_before"))
    along = Window.partitionBy(*names, "_group").orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.col("_begin") + F.col("_before") + F.sum("_sum").over(along)
    bins = bins.join(groups, [*names, "_group"]).withColumn("_end", end).withColumn("_start", F.col("_end") - F.col("_sum"))
    bins = bins.where((F.col("_start") <= F.col("_rest")) & (F.col("_end") > F.col("_rest")))
    return bins.select(*names, F.col("_bin").alias("_edge"), F.col("_start").alias("_begin"))


def mixed(docs: DataFrame, levels: Mapping[str, Column], weights: Mapping[str, Mapping[str, float]], share: float = 1.0,
          max_epochs: int = 3, seed: int = 0, id_: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """One row per document and epoch taken: id, the levels, n_tokens, epoch; with `carry` all
    columns of `docs` and the epoch (a column of that name is replaced).

    `levels` names the tree's levels from the root down, each with the expression over `docs`
    that gives its value.
    """
    names = [f"_level{i}" for i in range(len(levels))]
    own = {f"_level{i}": weights.get(k, {}) for i, k in enumerate(levels)}
    kept = {f"_c{i}": c for i, c in enumerate(docs.columns) if c != "epoch"} if carry else {}
    source = docs.select(
        *[F.col(f"`{c}`").alias(k) for k, c in kept.items()], F.col(id_).alias("_id"), n_words(text).alias("_n"),
        *[F.coalesce(c.cast("string"), F.lit(NONE)).alias(n) for n, c in zip(names, levels.values())])
    rows = written(source.select("_id", "_n", *names), "tokens")
    leaves = rows.groupBy(*names).agg(F.sum("_n").alias("tokens"))
    budgets = leaf_budgets(leaves, names, own, share, max_epochs)
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("long")
    budgets = budgets.withColumn("_whole", whole).withColumn("_rest", F.col("budget") - F.col("_whole") * F.col("tokens"))
    budgets = written(budgets.select(*names, "_whole", "_rest"), "budgets")

    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_whole").cast("string"), F.coalesce(F.col("_id").cast("string"), F.lit(""))).cast("binary"))
    ends = budgets.withColumns({"_edge": F.lit(""), "_begin": F.lit(0).cast("long")})
    for digits in range(0, BIN_DIGITS * ROUNDS, BIN_DIGITS):
        inside = rows.join(ends, names).withColumn("_order", order)
        if digits:
            inside = inside.where(F.substring("_order", 1, digits) == F.col("_edge"))
        edges = written(bin_of_end(inside, names, digits), "ends")
        ends = budgets.join(edges, names, "left")

    taken = (source if carry else rows).join(ends, names).withColumn("_order", order)
    bin_ = F.substring("_order", 1, BIN_DIGITS * ROUNDS)
    at_edge = taken.where(bin_ == F.col("_edge"))
    inside = Window.partitionBy(*names).orderBy("_order", "_n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at_edge = at_edge.withColumn("_part", F.col("_begin") + F.sum("_n").over(inside) <= F.col("_rest"))
    # A leaf without an end of its own has no rest.
    others = taken.where(F.col("_edge").isNull() | (bin_ != F.col("_edge"))).withColumn("_part", F.coalesce(bin_ < F.col("_edge"), F.lit(False)))
    taken = others.unionByName(at_edge).withColumn("_times", F.col("_whole") + F.when(F.col("_part") & (F.col("_rest") > 0), 1).otherwise(0))
    taken = taken.where("_times > 0").withColumn("_epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_times") - 1)))
    if carry:
        return taken.select(*[F.col(k).alias(c) for k, c in kept.items()], F.col("_epoch").alias("epoch"))
    return taken.select(F.col("_id").alias(id_), *[F.col(n).alias(k) for n, k in zip(names, levels)], F.col("_n").alias("n_tokens"), F.col("_epoch").alias("epoch"))
