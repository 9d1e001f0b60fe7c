"""Language-model scores of whole texts by a log-bilinear model with classes of words.

The model predicts the next word from the two words before it: their vectors, weighted by place,
are summed and matched with a vector and a bias of each of three levels: sections, classes of a section,
words of a class, of alike frequency and about the cube root of the words each. The product of a softmax
on each level is the probability of the word. It is trained in numpy by noise-contrastive estimation on
each level. The training texts are dealt over tasks of about `SHARE_TOKENS` tokens, each task learns once from all
tokens of its share, in the same number of slices whatever the size of the input, and the weights are averaged.

The model's words are those that the training texts have at least `MIN_COUNT` times, at most
`MAX_WORDS` (the most frequent), and one member for all others; so its tables grow with the
corpus up to a bound, and what they are trained on grows with it without one.

The softmax is exact: batched matrix products give the scores of all sections in all contexts of a slice, of
all classes of a section and of all words of a class in the contexts of their tokens, and their sums
are the normalisers.
A word outside the model's words has the probability of that member times its smoothed share in it,
so the probabilities of all words sum to one.

Word counts cover all training texts. Counts of the most frequent words (at most `HEAD`) are
shipped to the tasks; the other words of each text are joined with their counts.

Defined results: a null or empty text is the end token alone; repeated rows are scored one by
one; without training texts all scores come from uniform counts; an empty table gives no rows; a very
long text is worked on a slice of tokens at a time; columns with the names of results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkseries.llm.shared import written
from sparkseries.llm.words import SPACED_LOWER, Texts, mix, signed, slices, words

MIN_COUNT = 3
MAX_WORDS = 1 << 17
OTHER, STOP = 0, 1  # model numbers of all other words, and of the end token
DIM = 16
HEAD = 300_000
SHARE_TOKENS = 10_000_000
CONTEXTS = 1024  # rows of a matrix product
STEPS = 32  # slices of a share
RATE, SCALE = 0.15, 1 / 8  # of the steps; weight of a token
PORTION = 1024  # weights that travel together
FLUSH = 2_000_000
END = mix(np.array([0x5E17], np.uint64))[0]


def tokens(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of a slice, with an end token after each text; `first` as in Words."""
    w = words(t, SPACED_LOWER)
    n = len(w.first) - 1
    first = w.first + np.arange(n + 1)
    out = np.full(len(w.hash) + n, END, np.uint64)
    out[np.arange(len(w.hash)) + w.text] = w.hash
    return out, first


def tallies(batches: Iterator[pa.RecordBatch], coded, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Distinct values of `coded(slice)` with their counts, in portions of bounded size."""
    held, size = [], 0

    def flush():
        values, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n, pa.int64())], names)

    for batch in batches:
        for part in slices(batch.column(0)):
            held.append(coded(part))
            size += len(held[-1])
            if size >= FLUSH:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """(word, n): every token's hash and its count over all rows."""
    count = lambda batches: tallies(batches, lambda t: tokens(t)[0], ["word", "n"])
    return docs.select(text).mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Lexicon(NamedTuple):
    """Frequent words: sorted hashes, counts and model numbers; totals over all words."""

    keys: np.ndarray
    counts: np.ndarray
    ids: np.ndarray
    total: int
    distinct: int
    rest_total: int  # tokens and distinct words outside the model's words
    rest_distinct: int
    size: int  # numbers of the model

    def look_up(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count or 0, model number) of each token; count 0 may still be a rarer word."""
        if not len(self.keys):
            return np.zeros(len(h), np.int64), np.where(h == END, STOP, OTHER)
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        same = self.keys[at] == h
        return np.where(same, self.counts[at], 0), np.where(h == END, STOP, np.where(same, self.ids[at], OTHER))

    def unigram(self) -> np.ndarray:
        """Smoothed shares of the model's numbers among the training tokens."""
        out = np.full(self.size, 0.5)
        np.add.at(out, self.ids, np.where(self.ids != OTHER, self.counts, 0))
        out[OTHER] += self.rest_total
        return out / out.sum()


def lexicon(counts: DataFrame) -> tuple[Lexicon, int]:
    """The frequent words, and the count below which a word is not among them.

    The bound comes from a histogram of counts (a few hundred rows), so that at most HEAD words
    are brought to the driver.
    """
    bucket = F.when(F.col("n") < 256, F.col("n")).otherwise(256 + F.floor(16 * F.log2(F.col("n") / 256.0))).alias("bucket")
    histogram = counts.groupBy(bucket).agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n"), F.min("n").alias("least")).collect()
    total, distinct = sum(r["n"] for r in histogram), sum(r["words"] for r in histogram)
    least, taken = None, 0
    for r in sorted(histogram, key=lambda r: -r["bucket"]):
        if taken + r["words"] > HEAD:
            break
        taken += r["words"]
        least = r["least"]
    if least is None:  # no word, or one bucket alone is over the bound
        return Lexicon(*[np.zeros(0, np.int64)] * 3, total, distinct, total, distinct, 2), 1 << 62
    head = counts.where(F.col("n") >= least).toArrow()
    keys = head.column("word").to_numpy().astype(np.int64).view(np.uint64)
    n = head.column("n").to_numpy().astype(np.int64)
    ids = np.full(len(keys), OTHER)
    order = np.lexsort((keys, -n))
    order = order[(keys[order] != END) & (n[order] >= MIN_COUNT)][: MAX_WORDS - 2]
    ids[order] = 2 + np.arange(len(order))
    ids[keys == END] = STOP
    sort = np.argsort(keys)
    model = ids != OTHER
    return Lexicon(keys[sort], n[sort], ids[sort], total, distinct, total - int(n[model].sum()), distinct - int(model.sum()), 2 + len(order)), least


def contexts(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words one and two before each token; before a text's start stands the end token."""
    one = np.empty_like(ids)
    one[1:] = ids[:-1]
    one[first[:-1]] = STOP
    two = np.empty_like(ids)
    two[1:] = one[:-1]
    two[first[:-1]] = STOP
    return one, two


class Weights(NamedTuple):
    """Vectors of words as context, weights of the two places, and per level (words, classes, sections)
    vectors and biases. Class c holds the words from c * width on, section s the classes from s * width on."""

    context: np.ndarray  # words x DIM
    place: np.ndarray  # 2 x DIM
    word: np.ndarray  # words x DIM
    word_bias: np.ndarray
    group: np.ndarray  # classes x DIM
    group_bias: np.ndarray
    section: np.ndarray  # sections x DIM
    section_bias: np.ndarray

    @property
    def width(self) -> int:
        return level_width(len(self.word_bias))

    def log_prob(self, one: np.ndarray, two: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Log probabilities of words after contexts."""
        order = by_class(word, self.width)
        one, two, below = one[order], two[order], word[order]
        q = mixed(self.context, self.place, one, two)
        picked, total, found = np.empty(len(word), np.float32), np.empty(len(word), np.float32), np.zeros(len(word))
        ones = np.ones(max(self.width, len(self.section_bias)), np.float32)
        for vectors, biases, width in (
                (self.word, self.word_bias, self.width), (self.group, self.group_bias, self.width),
                (self.section, self.section_bias, len(self.section_bias))):
            table = np.concatenate([vectors, biases[:, None]], axis=1)
            for c, begin, end in blocks(below, width):
                members = np.ascontiguousarray(table[c * width : (c + 1) * width].T)
                for lo in range(begin, end, CONTEXTS):
                    at = slice(lo, min(lo + CONTEXTS, end))
                    s = q[at] @ members
                    own = s.ravel()[at_member(below[at], width, s)]
                    if s.max() > 60 or own.min() < -60:  # else no exponential leaves its range
                        top = s.max(axis=1)
                        s -= top[:, None]
                        own -= top
                    picked[at] = own
                    total[at] = np.exp(s, out=s) @ ones[: s.shape[1]]
            found += picked - np.log(total)
            below = below // width
        out = np.empty(len(word))
        out[order] = found
        return out


def by_class(word: np.ndarray, width: int) -> np.ndarray:
    """An order in which the words of each class, and the classes of each section, lie together."""
    own = word // width
    return np.argsort(own.astype(np.uint16) if own.max(initial=0) < 1 << 16 else own, kind="stable")


def blocks(members: np.ndarray, width: int) -> Iterator[tuple[int, int, int]]:
    """(block, begin, end) of the runs of members of one block of `width`."""
    own = members // width
    edge = np.r_[0, np.flatnonzero(np.diff(own)) + 1, len(own)]
    return zip(own[edge[:-1]].tolist(), edge[:-1].tolist(), edge[1:].tolist()) if len(own) else iter(())


def at_member(members: np.ndarray, width: int, table: np.ndarray) -> np.ndarray:
    """Places of the rows' own members in the flat `table` (tokens x members of their block)."""
    return np.arange(len(members)) * table.shape[1] + members % width


def mixed(context: np.ndarray, place: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The vectors of contexts, with a one for the biases."""
    q = np.ones((len(one), DIM + 1), np.float32)
    np.multiply(context[one], place[0], out=q[:, :DIM])
    q[:, :DIM] += context[two] * place[1]
    return q


def level_width(size: int) -> int:
    width = max(1, round(size ** (1 / 3)))
    return width if width**3 >= size else width + 1


def level_shares(unigram: np.ndarray, width: int) -> list[np.ndarray]:
    """Shares of the words, the classes and the sections."""
    groups = np.add.reduceat(unigram, np.arange(0, len(unigram), width))
    return [unigram, groups, np.add.reduceat(groups, np.arange(0, len(groups), width))]


def inner_logs(shares: list[np.ndarray], width: int) -> list[np.ndarray]:
    """Log shares within the class, within the section, and of the sections."""
    words_, groups, sections = shares
    inside = lambda low, high: np.log(low / np.repeat(high, width)[: len(low)]).astype(np.float32)
    return [inside(words_, groups), inside(groups, sections), np.log(sections).astype(np.float32)]


def start_weights(unigram: np.ndarray, seed: int = 3) -> Weights:
    """Small vectors; the biases alone give every word its share."""
    rng = np.random.default_rng(seed)
    make = lambda n: rng.normal(0, 0.1, (n, DIM)).astype(np.float32)
    width = level_width(len(unigram))
    logs = inner_logs(level_shares(unigram, width), width)
    levels = [x for log in logs for x in (make(len(log)), log)]
    return Weights(make(len(unigram)), np.array([[1.0] * DIM, [0.5] * DIM], np.float32), *levels)


class Trainer:
    """Noise-contrastive estimation with AdaGrad steps, one per slice of tokens.

    The noise of a token is uniform over its block on each level (its class, its section, the sections), and each
    member is drawn once, so that a block's tokens need one matrix product and the optimum of a score is the
    log probability itself."""

    def __init__(self, weights: Weights, rate: float = RATE, scale: float = SCALE):
        self.context, self.place = weights.context.copy(), weights.place.copy()
        self.levels = [np.concatenate([v, b[:, None]], axis=1) for v, b in zip(weights[2::2], weights[3::2])]
        self.seen = [np.full(x.shape, 1e-3, np.float32) for x in (self.context, self.place, *self.levels)]
        self.rate, self.scale, self.width = np.float32(rate), np.float32(scale), weights.width

    @property
    def weights(self) -> Weights:
        return Weights(self.context, self.place, *(x for t in self.levels for x in (t[:, :DIM], t[:, DIM])))

    def step(self, x: np.ndarray, seen: np.ndarray, grad: np.ndarray) -> None:
        """A step on the weights `x`."""
        seen += grad * grad
        grad *= self.rate
        x -= grad / np.sqrt(seen)

    def learn(self, one: np.ndarray, two: np.ndarray, word: np.ndarray) -> None:
        order = by_class(word, self.width)
        one, two, own = one[order], two[order], word[order]
        q = mixed(self.context, self.place, one, two)
        g_q = np.zeros_like(q)
        start = np.arange(CONTEXTS)
        with np.errstate(over="ignore"):
            for table, seen in zip(self.levels, self.seen[2:]):
                width = self.width if table is not self.levels[-1] else len(table)
                member = own % width
                for c, begin, end in blocks(own, width):
                    rows = slice(c * width, (c + 1) * width)
                    members = table[rows]
                    against = -members.T
                    grad = 0
                    for lo in range(begin, end, CONTEXTS):
                        at = slice(lo, min(lo + CONTEXTS, end))
                        q_at = q[at]
                        g = q_at @ against
                        np.exp(g, out=g)
                        g += 1
                        np.reciprocal(g, out=g)  # the probability that a member is data, not noise
                        flat, true = g.reshape(-1), start[: len(g)] * len(members) + member[at]
                        flat[true] = 2 * flat[true] - 1
                        grad = grad + g.T @ q_at
                        g_q[at] += g @ members
                    grad *= self.scale
                    self.step(members, seen[rows], grad)
                own = own // width
        self.learn_contexts(one, two, g_q)

    def learn_contexts(self, one: np.ndarray, two: np.ndarray, g_q: np.ndarray) -> None:
        met = np.zeros(len(self.context), bool)
        met[one] = met[two] = True
        rows, number = np.flatnonzero(met), np.cumsum(met) - 1
        by_dim = np.ascontiguousarray(g_q[:, :DIM].T) * self.scale
        sums = [np.array([np.bincount(x, g, len(rows)) for g in by_dim], np.float32).T for x in (number[one], number[two])]
        context, seen = self.context[rows], self.seen[0][rows]
        places = np.stack([(g * context).sum(axis=0) for g in sums])
        self.step(context, seen, sums[0] * self.place[0] + sums[1] * self.place[1])
        self.context[rows], self.seen[0][rows] = context, seen
        self.step(self.place, self.seen[1], places)


def train(docs: DataFrame, text: str, lex: Lexicon) -> Weights:
    """The average of the weights that the shares of the texts come to, each learning once from all of its
    tokens, in slices of a `STEPS`-th of the average share."""
    unigram = lex.unigram()
    weights = start_weights(unigram)
    if not lex.total:
        return weights
    model = lex.ids != OTHER
    small = Lexicon(lex.keys[model], lex.counts[model], lex.ids[model], 0, 0, 0, 0, lex.size)
    shares = max(1, round(lex.total / SHARE_TOKENS))
    step = -(-lex.total // (shares * STEPS))
    sizes, total = [x.size for x in weights], lex.total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, n = Trainer(weights), 0
        held, size = [], 0

        def teach(least: int) -> None:
            """Learn from the held tokens, but for a rest of less than `least`."""
            nonlocal held, size
            parts = [np.concatenate(x) for x in zip(*held)]
            at = 0
            while size - at >= least:
                trainer.learn(*(x[at : at + step] for x in parts))
                at += step
            held, size = [tuple(x[at:] for x in parts)], max(size - at, 0)

        for b in batches:
            for part in slices(b.column(0)):
                h, first = tokens(part)
                ids = small.look_up(h)[1]
                held.append((*contexts(ids, first), ids))
                size += len(ids)
                n += len(ids)
                if size >= step:
                    teach(step)
        if size:
            teach(1)
        if n:  # weighted by the share's tokens
            flat = np.concatenate([x.ravel() for x in trainer.weights]) * np.float32(n / total)
            yield from portions(np.split(flat, range(PORTION, len(flat), PORTION)))

    dealt = docs.select(text).coalesce(shares).mapInArrow(run, "i int, v binary")
    sums = dealt.repartition("i").mapInArrow(added, "i int, v binary").orderBy("i").toArrow()
    flat = np.frombuffer(b"".join(sums.column("v").to_pylist()), np.float32)
    parts = np.split(flat, np.cumsum(sizes)[:-1])
    return Weights(*[p.reshape(x.shape) for p, x in zip(parts, weights)])


def portions(values: list[np.ndarray], numbers: list[int] | None = None) -> Iterator[pa.RecordBatch]:
    """Numbered portions of weights, a few hundred a batch."""
    numbers = list(range(len(values))) if numbers is None else numbers
    for lo in range(0, len(values), 256):
        packed = [v.astype(np.float32).tobytes() for v in values[lo : lo + 256]]
        yield pa.RecordBatch.from_arrays([pa.array(numbers[lo : lo + 256], pa.int32()), pa.array(packed, pa.binary())], ["i", "v"])


def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of the portions of one number."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
            v = np.frombuffer(packed.as_buffer(), np.float32)
            if i in sums:
                sums[i] += v
            else:
                sums[i] = v.astype(np.float64)
    yield from portions(list(sums.values()), list(sums))


def scored(docs: DataFrame, text: str, lex: Lexicon, model: Weights) -> DataFrame:
    """All rows and columns plus _n, _known, _base, _model (without the rarer words) and _rare
    (hashes of the words that are not among the frequent ones)."""
    names = docs.columns
    at = names.index(text)
    log_all = np.log10(lex.total + 0.1 * (lex.distinct + 1))
    log_rest = np.log10(lex.rest_total + 0.1 * (lex.rest_distinct + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for part in slices(batch.column(at)):
                h, first = tokens(part)
                n, ids = lex.look_up(h)
                one, two = contexts(ids, first)
                rare = n == 0
                other = ids == OTHER
                seen = np.where(rare, 0.0, np.log10(n + 0.1))
                lp = model.log_prob(one, two, ids) / np.log(10) + np.where(other, seen - log_rest, 0.0)
                count = np.diff(first)
                per = lambda x: np.add.reduceat(x, first[:-1])  # noqa: E731  each text has its end token
                found.append((count, count - per(rare.astype(np.int64)), per(seen) - count * log_all, per(lp), h[rare], per(rare.astype(np.int64))))
            columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0)] * 6
            offsets = np.concatenate(([0], np.cumsum(columns[5]))).astype(np.int32)
            rare = pa.ListArray.from_arrays(pa.array(offsets), pa.array(signed(columns[4].astype(np.uint64))))
            arrays = [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64()), pa.array(columns[3], pa.float64())]
            kept = [c for k, c in enumerate(batch.columns) if k != at]
            yield pa.RecordBatch.from_arrays([*kept, *arrays, rare], [*[x for x in names if x != text], "_n", "_known", "_base", "_model", "_rare"])

    empty = docs.drop(text).withColumns({
        "_n": F.lit(0).cast("long"), "_known": F.lit(0).cast("long"), "_base": F.lit(0.0), "_model": F.lit(0.0),
        "_rare": F.lit(None).cast("array<bigint>")})
    return docs.mapInArrow(run, empty.schema)


def lm_scores(docs: DataFrame, train_on: Column, text: str = "text") -> DataFrame:
    """All rows of `docs` (without the text) plus n_tokens, n_known, train_tokens, base_score and
    score (log10). Columns of the same names are replaced."""
    added = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    docs = docs.select(*[c for c in docs.columns if c not in added])
    training = docs.where(train_on)
    counts = written(word_counts(training, text), "words")
    lex, least = lexicon(counts)
    model = train(training, text, lex)
    rows = written(scored(docs, text, lex, model).withColumn("_row", F.monotonically_increasing_id()), "scores")
    rare = rows.where(F.size("_rare") > 0).select("_row", F.explode("_rare").alias("word"))
    rarer = counts.where(F.col("n") < least)
    looked = rare.join(rarer, "word", "left").groupBy("_row").agg(
        F.count("n").alias("_seen"), F.sum(F.log10(F.coalesce(F.col("n"), F.lit(0)) + F.lit(0.1))).alias("_logs"))
    out = rows.drop("_rare").join(looked, "_row", "left")
    logs = F.coalesce(F.col("_logs"), F.lit(0.0))
    kept = [c for c in docs.columns if c != text]
    return out.select(
        *kept,
        F.col("_n").alias("n_tokens"),
        (F.col("_known") + F.coalesce(F.col("_seen"), F.lit(0))).alias("n_known"),
        F.lit(lex.total).cast("long").alias("train_tokens"),
        (F.col("_base") + logs).alias("base_score"),
        (F.col("_model") + logs).alias("score"),
    )
