"""Adaptive parameter search per series: Parzen-estimator proposals, early stopping on folds.

Trials come in rounds. The first round is random; then the trials so far are split into the best
quarter and the others, each axis gets a density of either part (Gaussians around the trials, and a
uniform prior), and of some draws from the better density the one with the best ratio of the two is
tried. The trials of a round see a few folds first; the better half goes on to more folds, so a poor
trial costs few of them. A trial that has seen more folds ranks before one that was stopped.

A series travels as the sums of its segments (as in `tuning`): a trial is a solve per fold,
whatever the number of rows, and the series are spread over the executors. Draws depend on the seed
and the series' keys only, not on partitions or attempts.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkseries.functions import linalg
from sparkseries.operators.joins import join_on
from sparkseries.operators.metrics import score
from sparkseries.operators.models import MODEL_FIELDS, linear_yhat
from sparkseries.operators.tuning import _segment_moments, _solve, with_roles

Axis = tuple[str, float, float]  # ("int" | "float" | "log", low, high)
BEST_SHARE = 0.25
DRAWS = 24


class Trial(NamedTuple):
    round: int
    place: tuple[float, ...]  # in the unit cube
    params: dict[str, float]
    folds: int
    score: float | None  # smaller is better; None where no fold counts
    stopped: bool


def value_at(axis: Axis, u: float) -> float:
    """The axis value at a place in [0, 1]; every whole number has an equal part."""
    kind, low, high = axis
    if kind == "int":
        return float(min(int(low) + int(u * (high - low + 1)), int(high)))
    if kind == "log":
        return float(math.exp(math.log(low) + u * (math.log(high) - math.log(low))))
    return float(low + u * (high - low))


def _widths(centres: np.ndarray) -> np.ndarray:
    """Each Gaussian reaches to the farther one of its neighbours."""
    at = np.r_[0.0, centres, 1.0]
    return np.clip(np.maximum(at[1:-1] - at[:-2], at[2:] - at[1:-1]), 1.0 / (2 + len(centres)) / 2, 0.5)


def _log_density(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Of a mixture of Gaussians cut to [0, 1] and one uniform part."""
    centres = np.sort(centres)
    width = _widths(centres)
    erf = np.vectorize(math.erf)
    inside = 0.5 * (erf((1 - centres) / width / math.sqrt(2)) + erf(centres / width / math.sqrt(2)))
    bumps = np.exp(-0.5 * ((x[:, None] - centres) / width) ** 2) / (width * math.sqrt(2 * math.pi) * inside)
    return np.log((bumps.sum(axis=1) + 1.0) / (len(centres) + 1))


def _draw(centres: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    centres = np.sort(centres)
    width = _widths(centres)
    pick = rng.integers(0, len(centres) + 1, n)  # the last one is the uniform part
    out = rng.random(n)
    for i in np.flatnonzero(pick < len(centres)):
        for _ in range(20):
            x = rng.normal(centres[pick[i]], width[pick[i]])
            if 0 <= x <= 1:
                out[i] = x
                break
    return out


def propose(history: Sequence[Trial], n_axes: int, n: int, rng: np.random.Generator) -> list[tuple[float, ...]]:
    """`n` places in the unit cube to try next."""
    known = sorted((t for t in history if t.score is not None), key=lambda t: (-t.folds, t.score))
    if len(known) < 4:
        return [tuple(rng.random(n_axes)) for _ in range(n)]
    cut = max(2, math.ceil(BEST_SHARE * len(known)))
    good, bad = (np.array([t.place for t in part]) for part in (known[:cut], known[cut:]))
    out = []
    for _ in range(n):
        drawn = np.stack([_draw(good[:, a], DRAWS, rng) for a in range(n_axes)], axis=1)
        ratio = sum(_log_density(drawn[:, a], good[:, a]) - _log_density(drawn[:, a], bad[:, a]) for a in range(n_axes))
        out.append(tuple(drawn[int(ratio.argmax())]))
    return out


def rungs(folds: int, n_trials: int) -> list[tuple[int, int]]:
    """(folds seen, trials that go on): half of the trials and twice the folds each time."""
    out, seen = [], max(1, folds // 4)
    while True:
        n_trials = max(1, math.ceil(n_trials / 2))
        if seen >= folds:
            return [*out, (folds, 0)]
        out.append((seen, n_trials))
        seen = min(folds, 2 * seen)


def searched(axes: Mapping[str, Axis], evaluate: Callable[[dict[str, float], int], float | None], folds: int, rounds: int,
             per_round: int, rng: np.random.Generator) -> list[Trial]:
    """All trials of one search. `evaluate(params, fold)` is a loss, or None where the fold does not count."""
    names = list(axes)
    history: list[Trial] = []
    for r in range(rounds):
        places = propose(history, len(names), per_round, rng)
        params = [{n: value_at(axes[n], u) for n, u in zip(names, place)} for place in places]
        losses: list[list[float | None]] = [[] for _ in places]
        running = list(range(len(places)))
        for seen, keep in rungs(folds, per_round):
            for i in running:
                losses[i] += [evaluate(params[i], fold) for fold in range(len(losses[i]), seen)]
            if keep:
                running = sorted(running, key=lambda i: (_mean(losses[i]) is None, _mean(losses[i]) or 0.0, i))[:keep]
        history += [Trial(r, places[i], params[i], len(losses[i]), _mean(losses[i]), len(losses[i]) < folds) for i in range(len(places))]
    return history


def _mean(values: Sequence[float | None]) -> float | None:
    known = [v for v in values if v is not None]
    return float(np.mean(known)) if known else None


def best_trial(history: Sequence[Trial]) -> int:
    """Number of the best trial that saw all folds; the first one on ties or without scores."""
    order = [(-t.folds, t.score is None, t.score or 0.0, i) for i, t in enumerate(history)]
    return min(order)[-1]


def _searched_models(parts: DataFrame, keys: Sequence[str], features: Sequence[str], y: str, axes: Mapping[str, Axis],
                     k: int, rounds: int, per_round: int, metric: str, seed: int) -> DataFrame:
    """(keys, trials, best trial, intercept, weights) from train rows that carry their `segment`."""
    keys, d = list(keys), len(features)
    sums = _segment_moments(parts, keys, features, y)

    def one(key: tuple, segments, packed):
        by_segment = {int(s): linalg.unpack(p, d) for s, p in zip(segments, packed)}
        none = linalg.empty(d)
        train, test, so_far = [], [], none
        for fold in range(k):
            so_far = linalg.combine(so_far, by_segment.get(fold, none))
            train.append(so_far)
            test.append(by_segment.get(fold + 1, none))
        total = linalg.combine(so_far, by_segment.get(k, none))
        if total.n <= 0:
            return None

        def evaluate(params: dict[str, float], fold: int) -> float | None:
            if train[fold].n <= 0 or test[fold].n <= 0:
                return None
            sse = linalg.squared_error(test[fold], *_solve(train[fold], params))
            if metric == "mse":
                return sse / test[fold].n
            spread = linalg.total_squares(test[fold])
            return sse / spread - 1 if spread > 0 else None  # the negative r2

        rng = np.random.default_rng(crc32(repr((seed, *key)).encode()))
        history = searched(axes, evaluate, k, rounds, per_round, rng)
        best = best_trial(history)
        intercept, weights = _solve(total, history[best].params)
        sign = -1.0 if metric == "r2" else 1.0
        rows = [(i, t.round, t.params, t.folds, None if t.score is None else sign * t.score, t.stopped) for i, t in enumerate(history)]
        return rows, best, int(total.n), intercept, weights, total.mean[:-1]

    columns = [*keys, "trials", "trial", "n_train", "intercept", "weights", "means"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            names = pdf[keys].itertuples(index=False, name=None)
            found = [(*key, *result) for key, s, p in zip(names, pdf["segments"], pdf["moments"]) if (result := one(key, s, p))]
            yield pd.DataFrame(found, columns=columns)

    trial = "array<struct<trial:int,round:int,params:map<string,double>,folds:int,score:double,stopped:boolean>>"
    fields = T.StructType([*(sums.schema[c] for c in keys)]).add("trials", T._parse_datatype_string(trial)).add("trial", T.IntegerType())
    return sums.mapInPandas(run, T.StructType([*fields, *MODEL_FIELDS]))


def adaptive_trials(train: DataFrame, keys: Sequence[str], ts: str, features: Sequence[str], y: str, axes: Mapping[str, Axis],
                    k: int = 10, rounds: int = 3, per_round: int = 10, metric: str = "r2", seed: int = 0) -> DataFrame:
    """(keys, trial, round, params, folds, score, stopped): every trial of every series' search."""
    parts = with_roles(train, keys, ts, 0.0, k)
    models = _searched_models(parts, keys, features, y, axes, k, rounds, per_round, metric, seed)
    return models.select(*keys, F.inline("trials"))


def adaptive_search(df: DataFrame, keys: Sequence[str], ts: str, features: Sequence[str], y: str, axes: Mapping[str, Axis],
                    k: int = 10, rounds: int = 3, per_round: int = 10, metric: str = "r2", seed: int = 0, fraction: float = 0.2,
                    metrics: Sequence[str] = ("rmse", "mape")) -> DataFrame:
    """Search each series on its train rows, refit its best trial, score the held-out last `fraction`:
    (keys, trial, best_params, cv_score, n_rows, metrics).

    A series too short for folds takes its first trial and a null cv_score. Rows are ranked once.
    """
    keys = list(keys)
    parts = with_roles(df, keys, ts, fraction, k)
    models = _searched_models(parts.where("part = 'train'"), keys, features, y, axes, k, rounds, per_round, metric, seed)
    won = F.element_at("trials", F.col("trial") + 1)
    # The choice travels as text so that it can be a grouping key next to the series.
    models = models.select(*keys, "trial", F.to_json(won["params"]).alias("_params"), won["score"].alias("cv_score"), "intercept", "weights")
    chosen = ["trial", "_params", "cv_score"]
    test = join_on(parts.where("part = 'test'"), models, keys, "left")
    out = score(test.withColumn("yhat", linear_yhat(features)), y, "yhat", [*keys, *chosen], metrics)
    return out.select(*keys, "trial", F.from_json("_params", "map<string,double>").alias("best_params"), "cv_score", "n_rows", *metrics)
