"""Locally weighted regression of a series on time (Cleveland, "Robust Locally Weighted Regression
and Smoothing Scatterplots", 1979).

Each row gets the value at its time of a line through its `span` nearest rows, weighted by the
tricube of their distance. Robust rounds then weigh each row down by its distance from the last
round's smooth, measured in medians of the series.

A neighbourhood is a window of a bounded number of rows; sums over it are expressions on arrays.
Give it resampled series, whose length the time span bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkseries.operators.joins import join_on, sized
from sparkseries.operators.metrics import exact_median


def time_number(df: DataFrame, ts: str) -> Column:
    """Days of a date, seconds of a timestamp, or the number itself, as a double."""
    kind = df.schema[ts].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(ts).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(ts)).cast("double")
    return F.col(ts).cast("double")


def _with_line(rows: DataFrame) -> DataFrame:
    """`_fit`: the value at `_x` of the line through the structs (dist, x, y, trust) of `_near`. Each step is
    a column of its own, so that nothing is computed once per neighbour that is the same for all."""
    zero = F.lit(0.0)
    total = lambda f: F.aggregate("_near", zero, lambda acc, p: acc + f(p))
    rows = rows.withColumn("_reach", F.element_at("_near", -1)["dist"])
    part = lambda p: F.when(F.col("_reach") > 0, F.pow(1 - F.pow(p["dist"] / F.col("_reach"), 3), 3)).otherwise(F.lit(1.0)) * p["trust"]
    rows = rows.withColumn("_near", F.transform("_near", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), part(p).alias("w"))))
    rows = rows.withColumn("_mass", total(lambda p: p["w"]))
    mean = lambda name: F.try_divide(total(lambda p: p["w"] * p[name]), F.col("_mass"))
    rows = rows.withColumns({"_mx": mean("x"), "_my": mean("y")})
    mx, my = F.col("_mx"), F.col("_my")
    rows = rows.withColumns({
        "_sxy": total(lambda p: p["w"] * (p["x"] - mx) * (p["y"] - my)), "_sxx": total(lambda p: p["w"] * (p["x"] - mx) * (p["x"] - mx))})
    slope = F.coalesce(F.try_divide(F.col("_sxy"), F.col("_sxx")), zero)
    return rows.withColumn("_fit", my + slope * (F.col("_x") - mx)).drop("_near", "_reach", "_mass", "_mx", "_my", "_sxy", "_sxx")


def local_regression(df: DataFrame, keys: Sequence[str], ts: str, value: str, span: int = 10, robust: int = 0,
                     out: str = "smooth") -> DataFrame:
    """All rows and columns of `df` plus `out`. Of rows equally near the earlier one counts first.

    Rows without a time or a value smooth nothing and get null; where robust rounds leave a row no neighbour
    of any weight it gets null, too; a single row is its own smooth; columns named `out` are replaced.
    """
    if span < 2:
        raise ValueError("a line needs a span of two rows at least")
    names = [c for c in df.columns if c != out]
    known = F.col(ts).isNotNull() & F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))
    rows = df.select(*names).where(known).withColumns({"_x": time_number(df, ts), "_y": F.col(value).cast("double"), "_trust": F.lit(1.0)})
    around = Window.partitionBy(*keys).orderBy("_x", "_y").rowsBetween(1 - span, span - 1)

    def smoothed(rows: DataFrame) -> DataFrame:
        found = F.collect_list(F.struct("_x", "_y", "_trust")).over(around)
        rows = rows.withColumn("_near", found)
        dist = F.transform("_near", lambda p: F.struct(
            F.abs(p["_x"] - F.col("_x")).alias("dist"), p["_x"].alias("x"), p["_y"].alias("y"), p["_trust"].alias("trust")))
        rows = rows.withColumn("_near", F.slice(F.array_sort(dist), 1, span))
        return _with_line(rows)

    rows = smoothed(rows)
    for _ in range(robust):
        rows = sized(rows)  # a round reads the last one's rows several times
        rows = rows.withColumn("_off", F.abs(F.col("_y") - F.col("_fit")))
        rows = join_on(rows, exact_median(rows, list(keys), "_off", "_median"), list(keys), "left")
        far = F.try_divide(F.col("_off"), 6 * F.col("_median"))
        # With a median of 0 only the rows on the smooth count.
        trust = F.when(F.col("_median") > 0, F.when(far < 1, F.pow(1 - far * far, 2)).otherwise(0.0)).otherwise((F.col("_off") == 0).cast("double"))
        rows = smoothed(rows.withColumn("_trust", F.coalesce(trust, F.lit(0.0))).drop("_off", "_median", "_fit"))
    rest = df.select(*names).where(~F.coalesce(known, F.lit(False))).withColumn(out, F.lit(None).cast("double"))
    return rows.select(*names, F.col("_fit").alias(out)).unionByName(rest)
