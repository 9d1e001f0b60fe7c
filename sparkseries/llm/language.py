"""Language of whole texts by a byte convolutional network.

A text is cut into fixed-length windows of bytes. Each byte is embedded; filters of several
widths slide over the window; the largest response of each filter over the window feeds a
softmax over languages. The network is trained here, in numpy, on windows of labelled rows, and
applied in the tasks to batches of windows. A text's score is the mean of its windows' log
probabilities, weighted by their real bytes.

The training rows are a bounded sample: `sample_rows` rows per language, picked by the hash of
the id, `windows_per_row` windows of each, spread over the whole text. All rows are predicted,
and all of their windows count.

Defined results: a null or letterless text is `und` with score 0; a text shorter than a window
is padded with zero bytes; repeated rows are predicted one by one; an empty table gives no rows;
with no labelled rows every text is `und`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkseries.llm.shared import written
from sparkseries.llm.words import slices

WINDOW = 192
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
UNKNOWN = "und"


@dataclass
class ByteNet:
    """Weights: byte embedding, one filter bank per width, softmax layer."""

    langs: list[str]
    embed: np.ndarray  # 256 x EMBED
    banks: list[np.ndarray]  # (width * EMBED) x FILTERS
    bias: np.ndarray  # len(widths) * FILTERS
    out: np.ndarray  # len(widths) * FILTERS x langs
    out_bias: np.ndarray


def stacked(e: np.ndarray, width: int) -> np.ndarray:
    """(n, L, d) embedded windows -> (n, L - width + 1, width * d) neighbourhoods."""
    n, length, d = e.shape
    view = np.lib.stride_tricks.as_strided(
        e, (n, length - width + 1, width * d), (e.strides[0], e.strides[1], e.strides[2])
    )
    return np.ascontiguousarray(view)


def forward(net: ByteNet, windows: np.ndarray):
    """Log probabilities of a batch of windows, and what the backward pass needs."""
    e = np.ascontiguousarray(net.embed[windows])
    pooled, places, inputs = [], [], []
    for bank in net.banks:
        x = stacked(e, bank.shape[0] // net.embed.shape[1])
        r = (x.reshape(-1, x.shape[2]) @ bank).reshape(x.shape[0], x.shape[1], -1)
        places.append(r.argmax(axis=1))
        pooled.append(r.max(axis=1))
        inputs.append(x)
    hidden = np.maximum(np.concatenate(pooled, axis=1) + net.bias, 0)
    logits = hidden @ net.out + net.out_bias
    logits -= logits.max(axis=1, keepdims=True)
    logp = logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))
    return logp, hidden, places, inputs


def predict(net: ByteNet, windows: np.ndarray, batch: int = 64) -> np.ndarray:
    """Log probabilities (windows x languages)."""
    out = np.empty((len(windows), len(net.langs)), np.float32)
    d = net.embed.shape[1]
    for at in range(0, len(windows), batch):
        e = np.ascontiguousarray(net.embed[windows[at : at + batch]])
        pooled = []
        for bank in net.banks:
            x = stacked(e, bank.shape[0] // d)
            r = x.reshape(-1, x.shape[2]) @ bank
            pooled.append(r.reshape(x.shape[0], x.shape[1], -1).max(axis=1))
        hidden = np.maximum(np.concatenate(pooled, axis=1) + net.bias, 0)
        logits = hidden @ net.out + net.out_bias
        logits -= logits.max(axis=1, keepdims=True)
        out[at : at + batch] = logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))
    return out


def train(windows: np.ndarray, labels: np.ndarray, langs: list[str], epochs: int = 4, least_steps: int = 500,
          batch: int = 64, rate: float = 0.004, seed: int = 7) -> ByteNet:
    """Adam on the cross entropy; classes are weighted to count alike. Few windows are passed
    more often, for `least_steps` batches."""
    rng = np.random.default_rng(seed)
    shapes = [(256, EMBED)] + [(w * EMBED, FILTERS) for w in WIDTHS]
    params = [rng.normal(0, 0.5 if i == 0 else 0.2, s).astype(np.float32) for i, s in enumerate(shapes)]
    wide = len(WIDTHS) * FILTERS
    params += [np.zeros(wide, np.float32), rng.normal(0, 0.1, (wide, len(langs))).astype(np.float32),
               np.zeros(len(langs), np.float32)]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    share = np.bincount(labels, minlength=len(langs)).astype(np.float64)
    weight = (share.sum() / np.maximum(share, 1) / max((share > 0).sum(), 1)).astype(np.float32)
    step = 0
    for _ in range(max(epochs, least_steps * batch // max(len(windows), 1))):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            net = ByteNet(langs, params[0], params[1 : 1 + len(WIDTHS)], params[-3], params[-2], params[-1])
            logp, hidden, places, inputs = forward(net, windows[rows])
            grad = np.exp(logp)
            grad[np.arange(len(rows)), labels[rows]] -= 1
            grad *= (weight[labels[rows]] / len(rows))[:, None]
            g_hidden = (grad @ net.out.T) * (hidden > 0)
            g = [np.zeros_like(p) for p in params]
            g[-3], g[-2], g[-1] = g_hidden.sum(axis=0), hidden.T @ grad, grad.sum(axis=0)
            for b, w in enumerate(WIDTHS):
                gp = g_hidden[:, b * FILTERS : (b + 1) * FILTERS]
                picked = np.take_along_axis(inputs[b], places[b][:, :, None], axis=1)  # rows x filters x inputs
                g[1 + b] = np.einsum("rf,rfi->if", gp, picked)
                back = gp[:, :, None] * params[1 + b].T[None]  # rows x filters x inputs
                for k in range(w):
                    bytes_at = np.take_along_axis(windows[rows], places[b] + k, axis=1)
                    np.add.at(g[0], bytes_at, back[:, :, k * EMBED : (k + 1) * EMBED])
            step += 1
            for i, (p, d) in enumerate(zip(params, g)):
                first[i] = 0.9 * first[i] + 0.1 * d
                second[i] = 0.99 * second[i] + 0.01 * d * d
                scale = rate / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-6) / (1 - 0.9**step)
                p -= (scale * first[i]).astype(np.float32)
    return ByteNet(langs, params[0], params[1 : 1 + len(WIDTHS)], params[-3], params[-2], params[-1])


def cut_windows(data: np.ndarray, offsets: np.ndarray, size: int = WINDOW):
    """All windows of a slice of texts: (windows, text number, real bytes)."""
    length = np.diff(offsets)
    count = np.maximum((length + size - 1) // size, 1)
    text = np.repeat(np.arange(len(length)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    begin = offsets[:-1][text] + nth * size
    real = np.minimum(size, offsets[1:][text] - begin)
    padded = np.concatenate([data, np.zeros(size, np.uint8)])
    out = padded[begin[:, None] + np.arange(size)]
    out[np.arange(size) >= real[:, None]] = 0
    return out, text, real


def training_windows(docs: DataFrame, text: str, label: str, id_: str, sample_rows: int, windows_per_row: int):
    """Windows of the bounded sample: (windows, label numbers, label values)."""
    rows = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull() & has_letter(F.col(text)))
    sizes = {r[0]: r[1] for r in rows.groupBy(label).agg(F.count(F.lit(1))).collect()}
    langs = sorted(sizes)
    if not langs:
        return np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64), []
    # Twice the wanted share by hash, then the exact number: each language's rows stay spread out.
    share = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(min(1.0, 2 * sample_rows / sizes[k])))])
    draw = F.pmod(F.xxhash64(id_, text), F.lit(1 << 30)) / float(1 << 30)
    picked = rows.where(draw < share[F.col(label)]).select(F.col(label).alias("label"), F.col(text).alias("text"), draw.alias("draw"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, labels, draws = [], [], []
            for part in slices(batch.column(1)):
                windows, text_no, real = cut_windows(part.data, part.offsets)
                count = np.bincount(text_no, minlength=len(part.offsets) - 1)
                nth = np.arange(len(text_no)) - np.repeat(np.cumsum(count) - count, count)
                every = np.maximum(-(-count // windows_per_row), 1)[text_no]
                use = np.flatnonzero(nth % every == 0)
                kept += [windows[i].tobytes() for i in use]
                labels += [batch.column(0)[part.row + int(t)].as_py() for t in text_no[use]]
                draws += [batch.column(2)[part.row + int(t)].as_py() for t in text_no[use]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(labels, pa.string()), pa.array(kept, pa.binary()), pa.array(draws, pa.float64())], ["label", "window", "draw"])

    # About twice the sample, written once: the picks of all languages read it.
    cuts = written(picked.mapInArrow(cut, "label string, window binary, draw double"), "windows")
    parts = [cuts.where(F.col("label") == k).orderBy("draw", "window").limit(sample_rows * windows_per_row) for k in langs]
    taken = parts[0]
    for p in parts[1:]:
        taken = taken.unionByName(p)
    taken = taken.collect()
    windows = np.frombuffer(b"".join(bytes(r["window"]) for r in taken), np.uint8).reshape(-1, WINDOW)
    number = {k: i for i, k in enumerate(langs)}
    return windows, np.array([number[r["label"]] for r in taken], np.int64), langs


def has_letter(text: Column) -> Column:
    return text.rlike(r"\p{L}")


def fit_language(docs: DataFrame, text: str = "text", label: str = "lang", id_: str = "doc_id",
                 sample_rows: int = 600, windows_per_row: int = 3) -> ByteNet | None:
    """Train on at most `sample_rows` rows of each language; None if no row is labelled."""
    windows, labels, langs = training_windows(docs, text, label, id_, sample_rows, windows_per_row)
    return train(windows, labels, langs) if langs else None


def with_language(docs: DataFrame, net: ByteNet | None, text: str = "text", pred: str = "lang_pred",
                  score: str = "score") -> DataFrame:
    """All rows and columns of `docs` plus the predicted language and its probability.

    Columns of the same names are replaced.
    """
    rest = [c for c in docs.columns if c not in (pred, score)]
    rows = docs.select(*rest)
    if net is None:
        return rows.withColumns({pred: F.lit(UNKNOWN), score: F.lit(0.0)})
    at = rest.index(text)
    langs = net.langs

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, prob = [], []
            for part in slices(batch.column(at)):
                sums = np.zeros((len(part.offsets) - 1, len(langs)))
                windows, text_no, real = cut_windows(part.data, part.offsets)
                logp = predict(net, windows) * np.maximum(real, 1)[:, None]
                for k in range(len(langs)):
                    sums[:, k] = np.bincount(text_no, logp[:, k], minlength=len(sums))
                sums /= np.maximum(np.diff(part.offsets), 1)[:, None]
                sums -= sums.max(axis=1, keepdims=True)
                p = np.exp(sums)
                p /= p.sum(axis=1, keepdims=True)
                best.append(p.argmax(axis=1))
                prob.append(p.max(axis=1))
            best = np.concatenate(best) if best else np.zeros(0, np.int64)
            prob = np.concatenate(prob) if prob else np.zeros(0)
            arrays = [*batch.columns, pa.array(langs, pa.string()).take(pa.array(best)), pa.array(prob, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, [*rest, pred, score])

    schema = rows.withColumns({pred: F.lit("").cast("string"), score: F.lit(0.0)}).schema
    known = F.coalesce(has_letter(F.col(text)), F.lit(False))
    out = rows.mapInArrow(label, schema)
    return out.withColumns({pred: F.when(known, F.col(pred)).otherwise(UNKNOWN), score: F.when(known, F.col(score)).otherwise(0.0)})


def language_of(docs: DataFrame, train_on: Column, text: str = "text", label: str = "lang", id_: str = "doc_id",
                **sample) -> DataFrame:
    """Fit on the rows where `train_on` holds, then label all rows."""
    return with_language(docs, fit_language(docs.where(train_on), text, label, id_, **sample), text)
