"""Hyperparameter search per series: grid or random, on time-ordered folds.

Candidates are a short list of parameters known to the driver. Folds are expanding windows
over the train rows only. Because the linear model is fitted from sums, a fold's train part is
a running total of segment sums: no row is copied per fold or candidate.
"""

from __future__ import annotations

import functools
import itertools
import random
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkseries.functions import linalg, scoring
from sparkseries.operators.joins import join_on
from sparkseries.operators.metrics import best_candidate, score
from sparkseries.operators.models import MODEL_FIELDS, linear_yhat, moments, predict_ridge
from sparkseries.operators.rank import with_position
from sparkseries.operators.splits import fold_segments, time_series_folds

Candidate = dict[str, float]


def grid(**values: Sequence[float]) -> list[Candidate]:
    """All combinations, numbered in order: grid(l2=[1, 10], n_lags=[4, 8])."""
    names = list(values)
    return [
        {"candidate_id": i, **dict(zip(names, point))}
        for i, point in enumerate(itertools.product(*values.values()))
    ]


def random_candidates(trials: int, seed: int, **ranges) -> list[Candidate]:
    """Seeded random draws. A range is ("int", a, b), ("float", a, b) or ("log", a, b)."""
    rng = random.Random(seed)

    def draw(kind, low, high):
        if kind == "int":
            return rng.randint(low, high)
        if kind == "log":
            return float(np.exp(rng.uniform(np.log(low), np.log(high))))
        return rng.uniform(low, high)

    return [
        {"candidate_id": i, **{name: draw(*spec) for name, spec in ranges.items()}}
        for i in range(trials)
    ]


def candidate_array(candidates: Sequence[Candidate]):
    """The candidates as one literal array column, to be exploded without a join."""
    names = [n for n in candidates[0] if n != "candidate_id"]
    return F.array(
        *[
            F.struct(
                F.lit(int(c["candidate_id"])).alias("candidate_id"),
                *[F.lit(float(c[n])).alias(n) for n in names],
            )
            for c in candidates
        ]
    )


def expand_trials(
    df: DataFrame, keys: Sequence[str], ts: str, candidates: Sequence[Candidate], k: int
) -> DataFrame:
    """Rows x folds x candidates, for user models that need raw rows per trial.

    Group the result by (keys, candidate_id, fold). Linear models use `fold_scores` instead,
    which copies nothing.
    """
    rows = time_series_folds(df, keys, ts, k).withColumn("_c", F.explode(candidate_array(candidates)))
    return rows.select(*[c for c in rows.columns if c != "_c"], "_c.*")


def run_trials(
    trials: DataFrame,
    fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
    schema: T.StructType | str,
    by: Sequence[str] = (),
    parallelism: int | None = None,
) -> DataFrame:
    """Spread independent trials over the executors and run `fn` on their batches.

    Trials are dealt by the columns `by` that tell them apart, and Spark sizes the partitions; a
    number of partitions is only fixed where `parallelism` asks for it.
    """
    if parallelism:
        dealt = trials.repartition(parallelism)
    else:
        dealt = trials.repartition(*by) if by else trials.hint("rebalance")
    return dealt.mapInPandas(fn, schema)


def with_roles(
    df: DataFrame, keys: Sequence[str], ts: str, fraction: float, k: int | None = None, validation: float | None = None
) -> DataFrame:
    """All labels a search needs, from one ranking of the rows: a prefix of a series has the same
    positions as the series.

    `part` ('train' or 'test'); with `k` the `segment` of the train rows as in `fold_segments`,
    0 where a series is too short for folds; with `validation` the `inner` label of the train
    rows ('fit' or 'check').
    """
    rows = with_position(df, keys, [ts], pos="_rn", total="_n")
    place, n_train = F.col("_rn"), F.col("_n") - F.ceil(F.col("_n") * F.lit(fraction))
    train = place <= n_train
    labels = {"part": F.when(train, "train").otherwise("test")}
    if k is not None:
        size = F.floor(n_train / (k + 1))
        first = n_train - k * size
        segment = F.when((size > 0) & (place > first), F.ceil(F.try_divide(place - first, size))).otherwise(0)
        labels["segment"] = F.when(train, segment).cast("int")
    if validation is not None:
        held = F.ceil(n_train * F.lit(validation))
        labels["inner"] = F.when(train, F.when(place > n_train - held, "check").otherwise("fit"))
    return rows.select(*df.columns, *[c.alias(n) for n, c in labels.items()])


def _solve(m: linalg.Moments, candidate: Candidate):
    used = int(candidate["n_lags"]) if "n_lags" in candidate else None
    return linalg.ridge(m, float(candidate["l2"]), used)


def _fold_table(segments, packed, d: int, k: int, candidates: Sequence[Candidate]) -> list[tuple]:
    """(candidate_id, fold, mse, r2) from the k+1 segment moments of one series."""
    by_segment = {int(s): linalg.unpack(p, d) for s, p in zip(segments, packed)}
    none = linalg.empty(d)
    out = []
    train = none
    for fold in range(k):
        train = linalg.combine(train, by_segment.get(fold, none))
        test = by_segment.get(fold + 1, none)
        if train.n <= 0 or test.n <= 0:
            continue
        spread = linalg.total_squares(test)
        for c in candidates:
            sse = linalg.squared_error(test, *_solve(train, c))
            r2 = 1 - sse / spread if spread > 0 else None
            out.append((int(c["candidate_id"]), fold, sse / test.n, r2))
    return out


def _segment_moments(segmented, keys, features, y):
    sums = moments(segmented, [*keys, "segment"], features, y)
    # At most k+1 sums per series: as arrays, one Arrow batch carries many series.
    return sums.groupBy(*keys).agg(
        F.collect_list("segment").alias("segments"), F.collect_list("moments").alias("moments")
    )


def fold_scores(
    train: DataFrame,
    keys: Sequence[str],
    ts: str,
    features: Sequence[str],
    y: str,
    candidates: Sequence[Candidate],
    k: int = 10,
) -> DataFrame:
    """(keys, candidate_id, fold, mse, r2) for every candidate on every past-only fold.

    Features must be ordered so that the candidate parameter `n_lags` keeps the first ones.
    """
    keys, d = list(keys), len(features)
    segmented = fold_segments(train, keys, ts, k).where("segment IS NOT NULL")
    sums = _segment_moments(segmented, keys, features, y)

    def evaluate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pdf[keys].copy()
            out["_scores"] = [_fold_table(s, p, d, k, candidates) for s, p in zip(pdf["segments"], pdf["moments"])]
            out = out.explode("_scores", ignore_index=True).dropna(subset="_scores")
            scores = pd.DataFrame(out["_scores"].tolist(), index=out.index, columns=["candidate_id", "fold", "mse", "r2"])
            yield out[keys].join(scores)

    schema = T.StructType(
        [*(sums.schema[c] for c in keys),
         T.StructField("candidate_id", T.LongType()), T.StructField("fold", T.IntegerType()),
         T.StructField("mse", T.DoubleType()), T.StructField("r2", T.DoubleType())]
    )
    return sums.mapInPandas(evaluate, schema)


def tune_ridge(
    train: DataFrame,
    keys: Sequence[str],
    ts: str,
    features: Sequence[str],
    y: str,
    candidates: Sequence[Candidate],
    k: int = 10,
    metric: str = "r2",
) -> DataFrame:
    """Best candidate per series by mean fold score, refitted on all train rows.

    (keys, candidate_id, best_params, cv_score, n_train, intercept, weights, means). Equal
    scores go to the smallest candidate id, and so does a series that is too short for folds; its
    cv_score is null. Python receives k+1 sums per series.
    """
    segmented = fold_segments(train, keys, ts, k).withColumn("segment", F.coalesce("segment", F.lit(0)))
    return _tuned_model(segmented, keys, features, y, candidates, k, metric)


def _tuned_model(segmented, keys, features, y, candidates, k, metric) -> DataFrame:
    """`tune_ridge` on train rows that carry their `segment`."""
    keys, d = list(keys), len(features)
    sums = _segment_moments(segmented, keys, features, y)
    params = {int(c["candidate_id"]): c for c in candidates}
    sign = {"r2": -1.0, "mse": 1.0}[metric]
    columns = [*keys, "candidate_id", "best_params", "cv_score", "n_train", "intercept", "weights", "means"]

    position = {"mse": 2, "r2": 3}[metric]

    def best_model(segments, packed) -> tuple | None:
        """The chosen columns of one series; None where no row counts."""
        found: dict[int, list[float]] = {}
        for row in _fold_table(segments, packed, d, k, candidates):
            if row[position] is not None:
                found.setdefault(row[0], []).append(row[position])
        total = functools.reduce(linalg.combine, (linalg.unpack(p, d) for _, p in sorted(zip(segments, packed))))
        if total.n <= 0:
            return None
        best, score = min(params), None
        if found:
            least, best = min((sign * float(np.mean(v)), c) for c, v in found.items())
            score = sign * least
        intercept, weights = _solve(total, params[best])
        chosen = {n: float(v) for n, v in params[best].items() if n != "candidate_id"}
        return best, chosen, score, int(total.n), intercept, weights, total.mean[:-1]

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [
                (*key, *model)
                for key, model in zip(
                    pdf[keys].itertuples(index=False, name=None), map(best_model, pdf["segments"], pdf["moments"])
                )
                if model is not None
            ]
            yield pd.DataFrame(rows, columns=columns)

    schema = T.StructType(
        [*(sums.schema[c] for c in keys),
         T.StructField("candidate_id", T.LongType()),
         T.StructField("best_params", T.MapType(T.StringType(), T.DoubleType())),
         T.StructField("cv_score", T.DoubleType()),
         *MODEL_FIELDS]
    )
    return sums.mapInPandas(choose, schema)


def tuned_scores(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    features: Sequence[str],
    y: str,
    candidates: Sequence[Candidate],
    k: int = 10,
    metric: str = "r2",
    fraction: float = 0.2,
    metrics: Sequence[str] = ("rmse", "mape"),
) -> DataFrame:
    """Tune each series on its train rows, refit, score on the held-out last `fraction`:
    (keys, candidate_id, best_params, cv_score, metrics).

    Every series has a row. One too short for folds takes the smallest candidate id and a null
    cv_score; one without train rows has null results. The rows are ranked once.
    """
    parts = with_roles(df, keys, ts, fraction, k)
    model = _tuned_model(parts.where("part = 'train'"), keys, features, y, candidates, k, metric)
    # The choice travels as text so that it can be a grouping key next to the series.
    model = model.withColumn("_params", F.to_json("best_params")).drop("best_params")
    chosen = ["candidate_id", "_params", "cv_score"]
    test = join_on(parts.where("part = 'test'"), model.select(*keys, *chosen, "intercept", "weights"), keys, "left")
    out = score(test.withColumn("yhat", linear_yhat(features)), y, "yhat", [*keys, *chosen], metrics)
    params = F.from_json("_params", "map<string,double>").alias("best_params")
    return out.select(*keys, "candidate_id", params, "cv_score", "n_rows", *metrics)


def random_search(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    features: Sequence[str],
    y: str,
    candidates: Sequence[Candidate],
    fraction: float = 0.2,
    validation: float = 0.2,
    metrics: Sequence[str] = ("rmse", "mape"),
) -> DataFrame:
    """Choose by the MAPE of a validation part inside the train rows, refit, score on test.

    Each (series, candidate) is an independent trial of `run_trials`. The trials of a series
    travel as one array to its validation rows, which sum their errors per place in the array:
    no row is copied per trial. The rows are ranked once.
    """
    keys, d = list(keys), len(features)
    rows = with_roles(df, keys, ts, fraction, validation=validation)
    train, test = rows.where("part = 'train'"), rows.where("part = 'test'").select(*df.columns)
    params = {int(c["candidate_id"]): c for c in candidates}
    ids = sorted(params)

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fits = [
                _solve(linalg.unpack(p, d), params[int(c)])
                for p, c in zip(pdf["moments"], pdf["candidate_id"])
            ]
            out = pdf[[*keys, "candidate_id"]].copy()
            out["intercept"] = [b for b, _ in fits]
            out["weights"] = [w for _, w in fits]
            yield out

    def trials(rows: DataFrame, chosen: DataFrame | None = None) -> DataFrame:
        sums = moments(rows, keys, features, y)
        if chosen is None:
            table = sums.withColumn("candidate_id", F.explode(F.array(*[F.lit(c).cast("long") for c in ids])))
        else:
            table = join_on(sums, chosen.select(*keys, "candidate_id"), keys)
        schema = T.StructType(
            [*(sums.schema[c] for c in keys), T.StructField("candidate_id", T.LongType()), *MODEL_FIELDS[1:3]]
        )
        return run_trials(table, fit, schema, by=[*keys, "candidate_id"])

    fitted = (
        trials(train.where("inner = 'fit'"))
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("candidate_id", "intercept", "weights"))).alias("_trials"))
    )

    def error(trial: Column) -> Column:
        yhat = trial["intercept"]
        for i, name in enumerate(features):
            yhat = yhat + trial["weights"][i] * F.col(name)
        return scoring.floored_percentage(F.col(y), yhat)

    checks = join_on(train.where("inner = 'check'"), fitted, keys).withColumn("_errors", F.transform("_trials", error))
    means = checks.groupBy(*keys).agg(F.array(*[F.avg(F.col("_errors")[i]) for i in range(len(ids))]).alias("_means"))
    numbers = F.array(*[F.lit(c).cast("long") for c in ids])
    trial_scores = means.select(*keys, F.inline(F.arrays_zip(numbers.alias("candidate_id"), F.col("_means").alias("validation_mape"))))
    trial_scores = trial_scores.toDF(*keys, "candidate_id", "validation_mape")
    best = best_candidate(trial_scores, keys, "candidate_id", "validation_mape")
    final = trials(train, best)
    scored = score(predict_ridge(test, final, keys, features), y, "yhat", keys, metrics)
    return join_on(best, scored, keys).select(*keys, "candidate_id", "validation_mape", "n_rows", *metrics)
