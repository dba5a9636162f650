"""Language identification: averaged hashed subword embeddings with a linear softmax.

A word counts with its own hash and those of its 3- and 4-character pieces (`<` and `>` mark its ends). A text
is the average of the embeddings of all its pieces, and a softmax over that average gives the languages; pieces
that training never saw count as zero. The model is trained by stochastic gradient descent in numpy on a bounded
sample of labelled texts and their snippets; a held-back part sets the softmax's temperature.

Rejection is calibrated on what the model shall know and on what it shall not. A text in another language may look
like one of the model's by its pieces, but few of its words are known. So each language in turn is held out: the share
of its words that the others' texts know (and that of noise, made by shuffling letters) says how an unknown language
looks; the held-back units say how the known ones do. A text's evidence is the log odds of its known and unknown words
under the two, scaled down to EVIDENCE_WORDS words where it has more. A text is rejected if its evidence against a known
language outweighs ODDS_FOR_KNOWN, or if its score (the softmax's probability) is under even odds; both limits are
lowered where they would cost more than the part `lost` of the held-back units that are predicted rightly.

Null texts and texts without a letter are `und` with score 0 and rejected. Labels that are null are not learnt.
With no labelled row, every text is `und`. Equal scores go to the language that comes first in code point order. Repeated
rows get the same prediction. Texts of any length are read whole. Empty tables give no rows. Other columns are
ignored (predict) or kept (accepted_documents).
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_of_id, sliced, written

LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


def pieces(word: str, buckets: int) -> list[int]:
    marked = f"<{word}>"
    parts = [marked] + [marked[i : i + k] for k in (3, 4) for i in range(len(marked) - k + 1) if len(marked) > k]
    return [zlib.crc32(p.encode()) % buckets for p in parts]


def word_hash(word: str) -> int:
    return zlib.crc32(word.encode())


def counted(words: list[str], buckets: int, cache: dict[str, array]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pieces of some words, and how often each occurs."""
    ids = array("i")
    for w in words:
        p = cache.get(w)
        if p is None:
            if len(cache) > 100_000:
                cache.clear()
            p = cache[w] = array("i", pieces(w, buckets))
        ids += p
    return np.unique(np.frombuffer(ids, np.int32), return_counts=True)


#: Languages that are learnt at most (those with the most texts), and texts that a label needs to be one of them.
MOST_LANGS, LEAST_TEXTS = 1000, 2
#: Texts and words (of texts and snippets) of a sample at most; with more languages each gets fewer.
SAMPLE_TEXTS, SAMPLE_WORDS = 40_000, 16_000_000
#: Steps of the descent for each language, at least.
STEPS_PER_LANG = 600
#: Words of a text that count as evidence for or against a known language; words of a text don't stand alone.
EVIDENCE_WORDS = 64
#: A text is taken to be in a known language by these odds until its words say otherwise.
ODDS_FOR_KNOWN = 100
#: The share of known words in a known language at most: no sample has all of a language's words.
MOST_KNOWN = 0.9


@dataclass
class Model:
    langs: list[str]
    buckets: int
    #: The embedding of each piece, and the softmax's weights: a model's size hardly grows with its languages. Without
    #: weights the embeddings are logits.
    embedding: np.ndarray
    weights: np.ndarray | None
    #: Hashes of the whole words that training saw, ascending.
    known: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.5
    #: Log odds (known language to unknown) of a word that is known, and of one that isn't.
    odds: tuple[float, float] = (0.0, 0.0)
    least_evidence: float = -math.inf
    facts: dict = field(default_factory=dict)

    def knows(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.zeros(len(hashes), bool)
        return self.known[np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)] == hashes

    def sent(self) -> Model:
        """The model as tasks need it: logits of pieces in place of embeddings where there are fewer languages than dimensions."""
        if self.weights is None or len(self.langs) > self.weights.shape[0]:
            return self
        return replace(self, embedding=self.embedding @ self.weights, weights=None)

    def logits(self, sums: np.ndarray) -> np.ndarray:
        return sums if self.weights is None else sums @ self.weights

    def evidence(self, known: np.ndarray | float, words: np.ndarray | float) -> np.ndarray | float:
        return (known * self.odds[0] + (words - known) * self.odds[1]) * np.minimum(1.0, EVIDENCE_WORDS / np.maximum(words, 1))


@dataclass
class Unit:
    """A text or snippet to learn from: its distinct pieces with their counts, its words' hashes, its language."""

    ids: np.ndarray
    counts: np.ndarray
    words: np.ndarray
    lang: str


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train(units: list[Unit], buckets: int = 1 << 18, dim: int = 16, epochs: int = 3, rate: float = 0.05, seed: int = 1, lost: float = 0.0005) -> Model | None:
    """A model from units; every fifth only calibrates it.

    lost: the part of rightly predicted held-back units that a limit of rejection may cost. Limits are set by what
    they cost and not by the precision above them: some labels are wrong, so that a precision near 1 may be out of reach.
    """
    units = [u for u in units if len(u.ids)]
    langs = sorted({u.lang for u in units})
    if not langs:
        return None
    at = {x: i for i, x in enumerate(langs)}
    draws = np.random.RandomState(seed)
    held = np.arange(len(units)) % 5 == 4 if len(units) >= 50 else np.zeros(len(units), bool)
    emb = draws.uniform(-1 / dim, 1 / dim, (buckets, dim)).astype(np.float32)
    w = np.zeros((dim, len(langs)), np.float32)
    seen = np.zeros(buckets, bool)
    use = np.flatnonzero(~held)
    labels = np.array([at[u.lang] for u in units])
    epochs = max(epochs, min(10 * epochs, -(-STEPS_PER_LANG * len(langs) // len(use))))  # many languages have few units each
    steps, done = epochs * len(use), 0
    for _ in range(epochs):
        for i in draws.permutation(use):
            u = units[i]
            p = (u.counts / u.counts.sum()).astype(np.float32)
            h = p @ emb[u.ids]
            g = softmax(h @ w)
            g[labels[i]] -= 1
            lr = rate * (1 - done / steps) + 0.01
            back = w @ g
            w -= lr * 4 * np.outer(h, g)
            seen[u.ids] = True
            emb[u.ids] -= lr * 40 * p[:, None] * back
            done += 1
    model = Model(langs, buckets, np.where(seen[:, None], emb, np.float32(0)), w, np.empty(0, np.int64))
    check = np.flatnonzero(held) if held.any() else use
    logits = np.array([(units[i].counts @ model.embedding[units[i].ids] @ w) / units[i].counts.sum() for i in check])
    gold = labels[check]
    loss = lambda t: -np.log(np.maximum(softmax(logits / t)[np.arange(len(gold)), gold], 1e-12)).mean()
    model.temperature = float(min(np.geomspace(0.25, 25, 80), key=loss))
    probs = softmax(logits / model.temperature)
    top, right = probs.max(1), probs.argmax(1) == gold
    # never over even odds: a language that is likelier than all others together is kept
    model.reject_below = float(min(0.5, np.quantile(top[right], lost))) if right.any() else 0.5
    model.facts = {"units": len(units), "held_accuracy": float(right.mean())}
    _calibrate_evidence(model, units, use, check[right] if right.any() else check, lost, draws)
    return model


def _calibrate_evidence(model: Model, units: list[Unit], use: np.ndarray, check: np.ndarray, lost: float, draws: np.random.RandomState) -> None:
    """Sets how known words are told from unknown ones, and the least evidence."""
    model.known, where = np.unique(np.concatenate([units[i].words for i in use]), return_inverse=True)
    n, langs = len(model.known), {x: k for k, x in enumerate(model.langs)}
    uses = np.bincount(where, minlength=n)
    pairs, times = np.unique(np.repeat([langs[units[i].lang] for i in use], [len(units[i].words) for i in use]).astype(np.int64) * n + where, return_counts=True)
    # a word is a language's own only if a fifth of its uses are there: some labels are wrong
    own = pairs[times >= 0.2 * uses[pairs % n]]
    owners = np.bincount(own % n, minlength=n)

    def others(k: int) -> np.ndarray:
        """Which words are some other language's own."""
        out = owners.copy()
        out[own[np.searchsorted(own, k * n) : np.searchsorted(own, (k + 1) * n)] % n] -= 1
        return out > 0

    def hits(words: np.ndarray, which: np.ndarray) -> int:
        return int(which[np.searchsorted(model.known, words[model.knows(words)])].sum())

    every = np.ones(n, bool)
    share = lambda some, which: (sum(hits(x, which) for x in some) + 1) / (sum(map(len, some)) + 2)
    inside = min(MOST_KNOWN, share([units[i].words for i in check], every))
    noise = [np.array([word_hash("".join(draws.permutation(list(f"w{x}")))) for x in units[i].words], np.int64) for i in check[:50]]
    outside = {"noise": share(noise, every)}
    of: dict[str, list[np.ndarray]] = {}
    for i in check if len(model.langs) > 1 else ():
        of.setdefault(units[i].lang, []).append(units[i].words)
    for lang, some in sorted(of.items()):
        outside[lang] = share(some, others(langs[lang]))
    other = float(np.mean(sorted(outside.values())[-2:]))  # the languages that look most like a known one
    model.facts |= {"known_words": inside, "known_words_held_out": outside}
    if inside <= other:
        return
    model.odds = (math.log(inside / other), math.log((1 - inside) / (1 - other)))
    evidence = np.array([model.evidence(float(hits(units[i].words, every)), float(len(units[i].words))) for i in check])
    # a text is in no language only by odds that outweigh how rare such texts are
    model.least_evidence = float(min(-math.log(ODDS_FOR_KNOWN), np.quantile(evidence, lost, method="lower")))


def fit(documents: DataFrame, usable: Column, per_lang: int = 700, buckets: int = 1 << 18, unit_words: int = 5000) -> Model | None:
    """A model from `per_lang` to twice as many distinct texts of each language (the bound), or all where there are
    fewer, chosen by their hash among the usable rows with a language: each whole text and one snippet of it.

    Of a text with more than `unit_words` words as many, evenly spread over all of it, are learnt. The whole sample is bounded
    by SAMPLE_TEXTS and SAMPLE_WORDS: many languages get fewer texts and words each. A label with fewer than LEAST_TEXTS
    texts isn't learnt where others have more, nor is any beyond the MOST_LANGS with the most texts (equal ones by name).
    """
    rows = documents.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), usable.alias("use")).filter("use AND lang IS NOT NULL AND text IS NOT NULL")
    rows = rows.select("lang", "text", F.xxhash64("text").alias("h"))
    distinct = written(rows.select("lang", "h").distinct(), "lang-texts")
    most = distinct.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "lang").limit(MOST_LANGS).collect()
    found = {r.lang: r.n for r in most if r.n >= LEAST_TEXTS} or {r.lang: r.n for r in most}
    if not found:
        return None
    per_lang = max(1, min(per_lang, SAMPLE_TEXTS // len(found)))
    unit_words = max(20, min(unit_words, SAMPLE_WORDS // (2 * per_lang * len(found))))
    every = documents.sparkSession.createDataFrame([(k, max(1, n // per_lang)) for k, n in sorted(found.items())], "lang string, every long")
    drawn = distinct.join(F.broadcast(every), "lang").filter(F.pmod("h", "every") == 0).drop("every")
    ranked = drawn.withColumn("_rn", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
    sample = rows.join(F.broadcast(ranked.filter(F.col("_rn") <= 2 * per_lang).drop("_rn")), ["lang", "h"]).select("lang", "text", "h")

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, array] = {}
        seen: set[tuple[str, int]] = set()  # of the sample: bounded
        for b in sliced(batches):
            out = []
            for lang, text, key in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if (lang, key) in seen:
                    continue
                seen.add((lang, key))
                words = LETTERS.findall(text.lower())
                if not words:
                    continue
                h = zlib.crc32(text.encode())
                start = h % len(words)
                spread = words[:: -(-len(words) // unit_words)]
                for part, (k, some) in enumerate(((h, spread), (h ^ 0xFFFF, words[start : start + 3 + h % 17]))):
                    ids, counts = counted(some, buckets, cache)
                    out.append((key, part, k, lang, ids.tolist(), counts.astype(np.int32).tolist(), [word_hash(w) for w in some]))
            for a in range(0, len(out), 256):
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out[a : a + 256], strict=True), kinds, strict=True)], names=["h", "part", "k", "lang", "ids", "counts", "words"])

    once = sample.mapInArrow(units, "h long, part int, k long, lang string, ids array<int>, counts array<int>, words array<long>").dropDuplicates(["lang", "h", "part"])
    got = sorted(((r.k, r.lang, len(r.ids), Unit(np.array(r.ids, np.int32), np.array(r.counts, np.float32), np.array(r.words, np.int64), r.lang)) for r in once.toLocalIterator()), key=lambda r: r[:3])
    return train([u for *_, u in got], buckets)


class _Words(dict):
    """Words to rows of their summed columns, their numbers of pieces, and whether they are known."""

    def __init__(self, model: Model):
        self.model, self.table = model, model.embedding
        self.known = memoryview(model.known)
        self.rows = np.zeros((1024, self.table.shape[1] + 2), np.float32)

    def __missing__(self, word: str) -> int:
        i = len(self)
        if i == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        ids = pieces(word, self.model.buckets)
        self.rows[i, :-2] = self.table[ids].sum(0)
        key = word_hash(word)
        at = bisect_left(self.known, key)
        self.rows[i, -2:] = len(ids), at < len(self.known) and self.known[at] == key
        self[word] = i
        return i


#: Words of a text that are added up at once.
STRETCH = 1 << 20


def _predictor(model: Model | None):
    """A function from a batch of texts to (languages, scores, shares of known words, accepted)."""
    words = _Words(model) if model else None

    def total(found: list[str]) -> np.ndarray:
        nonlocal words
        if len(words) > 300_000:
            words = _Words(model)
        ids = np.array([words[w] for w in found])
        return words.rows[ids].sum(0, dtype=np.float64)

    def run(texts: list[str | None]) -> tuple[list[str], list[float], list[float], list[bool]]:
        langs, scores, shares, accepted = [], [], [], []
        for t in texts:
            found = LETTERS.findall(t.lower()) if t and model else []
            if not found:
                langs.append(UNKNOWN)
                scores.append(0.0)
                shares.append(0.0)
                accepted.append(False)
                continue
            sums = sum(total(found[i : i + STRETCH]) for i in range(0, len(found), STRETCH))
            p = softmax(model.logits(sums[:-2]) / sums[-2] / model.temperature)
            best = int(p.argmax())
            langs.append(model.langs[best])
            scores.append(float(p[best]))
            shares.append(float(sums[-1] / len(found)))
            accepted.append(bool(p[best] >= model.reject_below and model.evidence(sums[-1], len(found)) >= model.least_evidence))
        return langs, scores, shares, accepted

    return run


def predict(documents: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score, known (share of known words), accepted of every whole text."""
    shared = documents.sparkSession.sparkContext.broadcast(model and model.sent())  # bounded by its buckets and SAMPLE_WORDS
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = _predictor(shared.value)
        for b in sliced(batches):
            langs, scores, shares, accepted = predictor(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(shares, pa.float64()), pa.array(accepted, pa.bool_())], names=["doc_id", "lang_pred", "score", "known", "accepted"])

    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, known double, accepted boolean")


def accepted_documents(documents: DataFrame, model: Model | None) -> DataFrame:
    """The documents whose prediction isn't rejected, with all their columns."""
    shared = documents.sparkSession.sparkContext.broadcast(model and model.sent())
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = _predictor(shared.value)
        for b in sliced(batches):
            yield b.filter(pa.array(predictor(b.column(at).to_pylist())[-1], pa.bool_()))

    return documents.mapInArrow(run, documents.schema)


def training_rows(remainder: int = 1, of: int = 3) -> Column:
    """Rows to learn from: crc32 of the id as text leaves another remainder."""
    return crc_of_id() % of != remainder


def identify(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, known, accepted."""
    out = predict(documents, fit(documents, training_rows()))
    return out.select("doc_id", (~training_rows()).alias("held_out"), "lang_pred", "score", "known", "accepted")
