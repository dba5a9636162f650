"""Quality scores by positive-unlabelled learning.

Trusted positives and unlabelled texts train a small network on the non-negative unbiased risk
    p E+[l(g)] + max(0, Eu[l(-g)] - p E+[l(-g)])
with the logistic loss l and the class prior p, which is estimated from the data: with a first classifier, the
least ratio of unlabelled to positive texts above a score bounds the part of positives among the unlabelled.
As the risk is that of the supervised logistic loss, the sigmoid of g is the probability of a good text.

A text's features are how its characters, words and lines are made up, and hashed n-grams: its words, pairs of words
and triples of bytes, in HASHED buckets whatever the vocabulary. The network is linear over all of them, with a hidden
layer over the former.

Scores come from the whole text alone, however long. Null and empty texts score as texts with no words. Without
positives or unlabelled rows every score is 0.5. With FEW positives or fewer the prior can't be estimated: it is held to
be 0.5, and the result says so (prior_estimated). Repeated rows score alike; equal scores are equal predictions; of
repeated labels of an id the largest counts. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import operator
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_of_id, sliced, written

_BYTE_GROUPS = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\r\n", b".,;:'\"()-", b"!?", b"#$%&*@^~|\\/<>{}[]=+_`")
_GROUP_OF = np.full(256, len(_BYTE_GROUPS), np.int64)
for _i, _g in enumerate(_BYTE_GROUPS):
    _GROUP_OF[list(_g)] = _i
#: Number of features of how a text is made up, and of buckets of hashed n-grams (half of words, half of bytes).
SHAPE, HASHED = 27, 512
WIDTH = SHAPE + HASHED
#: Positives without which the prior isn't estimated.
FEW = 20


class _Buckets(dict):
    """Words to 32-bit hashes, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        h = self[word] = zlib.crc32(word.encode())
        return h


def hashed_ngrams(raw: bytes, words: list[str], seen: _Buckets, step: int = 1 << 20) -> np.ndarray:
    """Roots of the shares of hashed words and pairs of words, and of triples of bytes."""
    half = HASHED // 2
    bits = np.uint64(64 - (half.bit_length() - 1))
    spread = lambda x: (x * np.uint64(0x9E3779B97F4A7C15) >> bits).astype(np.int64)
    of_words, of_bytes = np.zeros(half), np.zeros(half)
    for a in range(0, len(words), step):
        ids = np.array([seen[w] for w in words[a : a + step + 1]], np.uint64)  # one more, for the pair over the edge
        of_words += np.bincount(spread(ids[:step]), minlength=half) + np.bincount(spread(ids[:-1] * np.uint64(31) + ids[1:]), minlength=half)
    for a in range(0, len(raw) - 2, step):
        x = np.frombuffer(raw, np.uint8, min(step + 2, len(raw) - a), a).astype(np.uint64)
        of_bytes += np.bincount(spread(x[:-2] | x[1:-1] << np.uint64(8) | x[2:] << np.uint64(16)), minlength=half)
    return np.sqrt(np.concatenate([of_words / max(1, of_words.sum()), of_bytes / max(1, of_bytes.sum())]))


def features(text: str | None, seen: _Buckets) -> np.ndarray:
    """All features of a text."""
    text = text or ""
    raw, words = text.encode(), text.split()
    return np.concatenate([shape(text, raw, words), hashed_ngrams(raw, words, seen)]).astype(np.float32)


def shape(text: str, raw: bytes, words: list[str]) -> list[float]:
    """Shares of kinds of characters, of words and of lines, and how much a text repeats itself."""
    n = max(1, len(raw))
    groups = np.bincount(_GROUP_OF[np.frombuffer(raw, np.uint8)], minlength=len(_BYTE_GROUPS) + 1) / n
    m = max(1, len(words))
    distinct = len(set(words))
    lower = set(text.lower().split())
    lines = [x for x in text.split("\n") if x.strip()]
    k = max(1, len(lines))
    sizes = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    packed = len(zlib.compress(raw, 1)) / n if raw else 1.0
    return [
        *groups,
        np.log1p(len(text)), np.log1p(len(words)),
        float(sizes.mean()), float(sizes.std()), float(min(60, sizes.max())), float((sizes == 1).mean()),
        np.log1p(distinct) / np.log1p(m), len(lower) / max(1, distinct),
        sum(map(operator.eq, words, words[1:])) / m,
        sum(map(str.isupper, words)) / m, sum(map(str.isalpha, words)) / m, sum(map(str.istitle, words)) / m,
        np.log1p(len(lines)), len(set(lines)) / k, sum(x.rstrip()[-1] in ".!?:;\"')" for x in lines) / k, np.log1p(len(text) / k),
        packed, packed * np.log1p(len(text)),
    ]


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    prior: float
    prior_estimated: bool

    def logits(self, x: np.ndarray) -> np.ndarray:
        return _forward(self.weights, _normal(x, self.mean, self.scale))[-1]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -40, 40)))


def _normal(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / scale, -6, 6).astype(np.float32)


def _forward(w: list[np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = np.tanh(x[:, : len(w[0])] @ w[0] + w[1])
    return h, h @ w[2] + x @ w[4] + w[3][0]


def _risk(w: list[np.ndarray], p: np.ndarray, u: np.ndarray, prior: float, non_negative: bool) -> tuple[float, list[np.ndarray]]:
    """The unbiased risk on positives p and unlabelled u, and the gradient to go against.

    Where the part for negatives is under zero, the non-negative form goes against that part's gradient alone, upwards.
    """
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    (hp, gp), (hu, gu) = _forward(w, p), _forward(w, u)
    negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
    d_neg_p, d_neg_u = -prior * sig(gp) / len(p), sig(gu) / len(u)
    if non_negative and negative < 0:  # step back from the part that fits too well
        dp, du = -d_neg_p, -d_neg_u
    else:
        dp, du = -prior * sig(-gp) / len(p) + d_neg_p, d_neg_u
    grads = [np.zeros_like(a) for a in w]
    for x, h, g in ((p, hp, dp), (u, hu, du)):
        back = np.outer(g, w[2]) * (1 - h * h)
        for i, a in enumerate((x[:, : len(w[0])].T @ back, back.sum(0), h.T @ g, np.array([g.sum()]), x.T @ g)):
            grads[i] += a
    return float(prior * np.logaddexp(0, -gp).mean() + (max(0.0, negative) if non_negative else negative)), grads


def _descend(positive: np.ndarray, unlabelled: np.ndarray, prior: float, hidden: int, steps: int, seed: int, non_negative: bool = True) -> list[np.ndarray]:
    """Adam on the (non-negative) unbiased risk, on minibatches."""
    draws = np.random.RandomState(seed)
    d, deep = positive.shape[1], min(SHAPE, positive.shape[1])
    w = [draws.normal(0, deep**-0.5, (deep, hidden)), np.zeros(hidden), draws.normal(0, hidden**-0.5, hidden) * 0.1, np.zeros(1), np.zeros(d)]
    w = [a.astype(np.float32) for a in w]
    m, v = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
    weak = np.arange(d) >= deep  # hashed n-grams are many, and each tells little
    pull = [1e-4, 1e-4, 1e-4, 0.0, np.where(weak, 3e-3, 1e-4).astype(np.float32)]
    slow = np.where(weak, 0.2, 1.0).astype(np.float32)
    for t in range(1, steps + 1):
        p = positive[draws.randint(0, len(positive), min(len(positive), 1024))]
        u = unlabelled[draws.randint(0, len(unlabelled), min(len(unlabelled), 2048))]
        rate = 0.02 * (1 - t / steps) + 0.0005
        for i, g in enumerate(_risk(w, p, u, prior, non_negative)[1]):
            g = g + pull[i] * w[i]
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            step = np.float32(rate) * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
            w[i] = w[i] - (step if i < 4 else step * slow)
    return w


def estimate_prior(positive_scores: np.ndarray, unlabelled_scores: np.ndarray) -> float:
    """Part of positives among unlabelled texts: the least ratio of their shares above a score.

    Only scores above which at least a third of the positives lie are looked at, where the ratio is steady.
    """
    cuts = np.quantile(positive_scores, np.linspace(0.0, 0.66, 67))
    ratios = [((unlabelled_scores >= c).mean()) / max(1e-9, (positive_scores >= c).mean()) for c in cuts]
    return float(min(0.98, max(0.02, min(ratios))))


def train(positive: np.ndarray, unlabelled: np.ndarray, hidden: int = 24, steps: int = 1500, seed: int = 7) -> Model | None:
    if not len(positive) or not len(unlabelled):
        return None
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(0, dtype=np.float64), both.std(0, dtype=np.float64) + 1e-3 * (np.arange(both.shape[1]) >= SHAPE) + 1e-6
    del both
    p, u = _normal(positive, mean, scale), _normal(unlabelled, mean, scale)
    enough = len(p) > FEW and len(u) > FEW
    prior = 0.5
    if enough:  # the first classifier: positives against unlabelled, half of each, so that the other half is unseen
        first = _descend(p[::2], u[::2], 0.5, hidden, max(200, steps // 3), seed, False)
        prior = estimate_prior(_forward(first, p[1::2])[-1], _forward(first, u[1::2])[-1])
    return Model(mean, scale, _descend(p, u, prior, hidden, steps, seed + 1), prior, enough)


def _feature_rows(rows: DataFrame, keep: str, schema: str, score=None) -> DataFrame:
    """A value for each row's text: its features as the bytes of 32-bit floats, or the score that a model gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = score.value if score is not None else None
        seen = _Buckets()
        for b in sliced(batches):
            x = np.array([features(t, seen) for t in b.column(1).to_pylist()], np.float32).reshape(b.num_rows, WIDTH)
            if score is None:
                value = pa.array([v.tobytes() for v in x], pa.binary())
            else:
                value = pa.array(model.scores(x) if model else np.full(b.num_rows, 0.5), pa.float64())
            yield pa.RecordBatch.from_arrays([b.column(0), value], names=[keep, "value"])

    return rows.mapInArrow(run, schema)


def training_rows(remainder: int = 2, of: int = 4) -> Column:
    """Rows to learn from: crc32 of the id as text leaves another remainder."""
    return crc_of_id() % of != remainder


def _some(rows: DataFrame, n: int, sample: int) -> np.ndarray:
    """Features of at most twice `sample` of the n rows (the bound), chosen by a hash, repeated rows once, in a fixed order."""
    drawn = rows.withColumn("h", F.xxhash64("doc_id", "text")).filter(F.pmod("h", F.lit(max(1, n // sample))) == 0)
    got = _feature_rows(drawn.select(F.struct("doc_id", "h").alias("key"), "text"), "key", "key struct<doc_id: long, h: long>, value binary").dropDuplicates(["key"]).orderBy("key.h").limit(2 * sample).collect()
    ordered = sorted(got, key=lambda r: (-1 if r.key.doc_id is None else r.key.doc_id, r.key.h))
    return np.array([np.frombuffer(r.value, np.float32) for r in ordered], np.float32).reshape(len(ordered), WIDTH)


def fit(documents: DataFrame, labels: DataFrame, sample: int = 8_000) -> Model | None:
    """A model from the rows to learn from: those with quality 1 are the positives, all of them are the unlabelled
    texts; of both about `sample` documents, at most twice as many, are drawn apart, so that positives don't get fewer as the
    unlabelled grow."""
    rows = documents.filter(training_rows()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("_q")).groupBy("_id").agg(F.max("_q").alias("_q")).filter("_q = 1")
    good = written(rows.select("doc_id").join(known, F.col("doc_id") == F.col("_id"), "left_semi").distinct(), "positives")
    n = good.count()
    if not n:
        return None
    ids = good.filter(F.pmod(F.xxhash64("doc_id"), F.lit(max(1, n // sample))) == 0).orderBy(F.xxhash64("doc_id")).limit(2 * sample)
    positive = _some(rows.join(F.broadcast(ids), "doc_id"), 0, sample)
    return train(positive, _some(rows, rows.count(), sample))


def score_documents(documents: DataFrame, labels: DataFrame, cut: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted, prior (of the model; null without one), prior_estimated of every document."""
    model = fit(documents, labels)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = _feature_rows(rows, "doc_id", "doc_id long, value double", shared)
    return scored.select(
        "doc_id", (~training_rows()).alias("held_out"), F.col("value").alias("score"), (F.col("value") >= cut).cast("int").alias("predicted"),
        F.lit(model.prior if model else None).cast("double").alias("prior"), F.lit(bool(model and model.prior_estimated)).alias("prior_estimated"),
    )
