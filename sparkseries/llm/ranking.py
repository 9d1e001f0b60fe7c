"""Text quality by Bradley-Terry ranking.

Each text is a vector of measures (lengths, character classes, repetition, line shape). From
labelled rows, pairs (a good text, a bad text) are drawn; a linear score is learned by logistic
loss on the difference of their measures. The threshold is a quantile of the scores: the share
of bad rows among the labelled. Scores are mapped to (0, 1) so that the threshold meets `cut`.

The measures of all texts are made in one pass and written once; the labelled sample that is
brought to the driver is bounded: `sample_rows` rows of each class, picked by hash of the id.

Defined results: null and empty texts have zero measures and a score like any other; rows with a
null label or no label teach nothing; with one class only every text gets that class, with no
label at all the class 0; repeated rows are scored one by one; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkseries.llm.lines import SEPARATORS, SYMBOLS, TERMINAL, ends_with_any, inside_line, is_lone, repeated
from sparkseries.llm.shared import written
from sparkseries.llm.words import LINES, SPACED, SPACED_LOWER, Texts, grams, mix, per_text, slices, words

MEASURES = (
    "log_words", "word_length", "upper", "digits", "symbols", "stops", "shouts", "bytes_over_127", "lone_separators",
    "distinct_words", "word_runs", "repeated_windows", "ended_lines", "line_words", "repeated_lines", "capitalised",
    "symbol_words", "short",
)


def byte_class(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


def share(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def measures(t: Texts) -> np.ndarray:
    """(texts, MEASURES) of a slice."""
    n = len(t.offsets) - 1
    w = words(t, SPACED_LOWER)
    count, text = w.counts, w.text
    size = np.diff(t.offsets)
    salt = mix(text.astype(np.uint64) + np.uint64(1))
    upper = np.zeros(256, bool)
    upper[65:91] = True
    digit = np.zeros(256, bool)
    digit[48:58] = True
    of = lambda table: per_text(table[t.data], t.offsets)
    by_text = lambda flags: np.bincount(text, flags, minlength=n)
    _, later = repeated(w.hash ^ salt)
    run = np.zeros(len(text), bool)
    run[1:] = (w.hash[1:] == w.hash[:-1]) & (text[1:] == text[:-1])
    window, ok = grams(w, 3)
    at = np.flatnonzero(ok)
    _, again = repeated(window[at] ^ salt[at])
    lines = words(t, LINES)
    of_word = inside_line(w.start, lines.start)
    line_words = np.bincount(of_word, minlength=len(lines.hash))
    real = np.flatnonzero(line_words)
    last = np.cumsum(line_words)[real] - 1
    ended = ends_with_any(t.data, w.start[last], w.end[last], TERMINAL) if len(real) else np.zeros(0, bool)
    n_lines = np.bincount(lines.text[real], minlength=n)
    _, line_again = repeated(lines.hash[real] ^ mix(lines.text[real].astype(np.uint64) + np.uint64(1)))
    symbol = byte_class(SYMBOLS)
    tail = symbol[t.data[np.maximum(w.end - 1, 0)]] if len(w.end) else np.zeros(0, bool)
    lone = is_lone(t.data, w.start, w.end, SEPARATORS) if len(w.end) else np.zeros(0, bool)
    head = upper[t.data[w.start]] if len(w.start) else np.zeros(0, bool)
    columns = [
        np.log1p(count), share(size, count), share(of(upper), size), share(of(digit), size), share(of(symbol), size),
        share(of(byte_class(".,;:")), count), share(of(byte_class("!?")), count), share(of(np.arange(256) > 127), size),
        share(by_text(lone), count), share(count - by_text(later), count), share(by_text(run), count),
        share(np.bincount(text[at][again], minlength=n), count), share(np.bincount(lines.text[real][ended], minlength=n), n_lines),
        np.log1p(share(count, n_lines)), share(np.bincount(lines.text[real][line_again], minlength=n), n_lines),
        share(by_text(head), count), share(by_text(tail), count), (count < 20).astype(float),
    ]
    return np.stack(columns, axis=1)


@dataclass
class Ranker:
    """Standardisation, weights, and the map from scores to (0, 1)."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    spread: float
    level: float  # logit of the cut

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -6, 6) @ self.weights


def fit(good: np.ndarray, bad: np.ndarray, cut: float = 0.7, pairs: int = 40_000, steps: int = 300, seed: int = 11) -> Ranker:
    """Weights that put the good one of each pair first; logistic loss on differences, Adam."""
    level = float(np.log(cut / (1 - cut)))
    if not len(good) or not len(bad):
        width = good.shape[1]
        sure = 4.0 if len(good) else -4.0
        return Ranker(np.zeros(width), np.ones(width), np.zeros(width), -sure, 1.0, 0.0)
    both = np.concatenate([good, bad])
    centre, scale = both.mean(axis=0), both.std(axis=0) + 1e-9
    rng = np.random.default_rng(seed)
    a = np.clip((good - centre) / scale, -6, 6)[rng.integers(0, len(good), pairs)]
    b = np.clip((bad - centre) / scale, -6, 6)[rng.integers(0, len(bad), pairs)]
    diff = a - b
    w = np.zeros(diff.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for k in range(1, steps + 1):
        p = 1 / (1 + np.exp(np.clip(diff @ w, -30, 30)))  # probability of the wrong order
        g = -(diff * p[:, None]).mean(axis=0) + 1e-3 * w
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        w = w - 0.05 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return Ranker(centre, scale, w, 0.0, 1.0, level)


def ranked_value(values: DataFrame, name: str, rank: int, bins: int = 1024) -> float:
    """The value with `rank` smaller ones before it, exactly: the range is narrowed to the bin that
    holds it until one value is left; the driver gets one row per bin."""
    value = F.col(name)
    lo, hi = values.agg(F.min(value), F.max(value)).first()
    while lo < hi:
        at = F.least(F.floor((value - lo) / (hi - lo) * bins), F.lit(bins - 1)).alias("bin")
        found = values.where(value.between(lo, hi)).groupBy(at).agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")).collect()
        for r in sorted(found, key=lambda r: r["bin"]):
            if rank < r["n"]:
                lo, hi = r["lo"], r["hi"]
                break
            rank -= r["n"]
    return lo


def placed(model: Ranker, known: DataFrame, n_bad: int) -> Ranker:
    """Set the threshold between as many of the lowest scores of all labelled rows as there are bad
    rows and the rest, and the spread to that of all scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(model.raw(rows_of(batch.column(0))))], ["raw"])

    scores = written(known.select("_measures").mapInArrow(run, "raw double"), "scores")
    model.threshold = (ranked_value(scores, "raw", n_bad - 1) + ranked_value(scores, "raw", n_bad)) / 2
    model.spread = scores.agg(F.stddev_pop("raw")).first()[0] / 2 + 1e-9
    return model


def rows_of(column: pa.Array) -> np.ndarray:
    """One row of measures per value of an array column."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(MEASURES)).astype(np.float64)


def with_measures(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The kept columns and `measures` (array of float) of every row."""
    rows = docs.select(*keep, F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measures(part) for part in slices(batch.column(len(keep)))]
            x = np.concatenate(found) if found else np.zeros((0, len(MEASURES)))
            flat = pa.array(x.astype(np.float32).ravel(), pa.float32())
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(MEASURES))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.ListArray.from_arrays(offsets, flat)], [*keep, "_measures"])

    schema = rows.drop("_text").withColumn("_measures", F.lit(None).cast("array<float>")).schema
    return rows.mapInArrow(run, schema)


def sample(rows: DataFrame, size: int, total: int) -> np.ndarray:
    """Measures of about `size` of `total` rows, picked by hash, never more than twice as many."""
    draw = F.pmod(F.xxhash64("_id", F.lit(5)), F.lit(1 << 30)) / float(1 << 30)
    picked = rows.where(draw < min(1.0, size / max(total, 1))).select("_measures").limit(2 * size).toArrow().column(0)
    flat = picked.combine_chunks().flatten() if picked.num_chunks else pa.array([], pa.float32())
    return flat.to_numpy(zero_copy_only=False).reshape(-1, len(MEASURES)).astype(np.float64)


def quality_scores(docs: DataFrame, labels: DataFrame, train_on: Column, id_: str = "doc_id", text: str = "text",
                   label: str = "quality", cut: float = 0.7, sample_rows: int = 8_000) -> DataFrame:
    """One row per document: id, `score` in (0, 1), `predicted` (score >= cut).

    `train_on` is a condition on the id column that says which labels may be learned from.
    """
    rows = written(with_measures(docs, text, [id_]).withColumnRenamed(id_, "_id"), "measures")
    marks = labels.where(train_on & F.col(label).isNotNull()).groupBy(F.col(id_).alias("_key")).agg(F.max(label).alias("_label"))
    known = written(rows.join(marks, rows["_id"] == marks["_key"]).select("_id", "_measures", "_label"), "labelled")
    n = {bool(r["good"]): r["n"] for r in known.groupBy((F.col("_label") > 0).alias("good")).agg(F.count(F.lit(1)).alias("n")).collect()}
    good = sample(known.where(F.col("_label") > 0), sample_rows, n.get(True, 0))
    bad = sample(known.where(F.col("_label") <= 0), sample_rows, n.get(False, 0))
    model = fit(good, bad, cut)
    if len(good) and len(bad):
        model = placed(model, known, n[False])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = (model.raw(rows_of(batch.column(1))) - model.threshold) / model.spread + model.level
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], [id_, "score"])

    schema = rows.select(F.col("_id").alias(id_), F.lit(0.0).alias("score")).schema
    out = rows.select("_id", "_measures").mapInArrow(run, schema)
    return out.withColumn("predicted", (F.col("score") >= cut).cast("int"))
