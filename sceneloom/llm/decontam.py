"""Benchmark decontamination: BM25 over an inverted index of test items, searched with block-max WAND.

Items are cut into segments of up to SEGMENT words; a segment's impacts are its BM25 weights divided by their
sum, so that a passage that holds all of its words scores 1. Every document is cut into overlapping passages
of two segments' length, so that any segment lies whole within one, and every passage is a query: all segments
with a score of `theta` or more are retrieved. A segment's signature is its heaviest terms that together weigh
more than 1 - theta: without any of them no passage reaches theta. So for all passages of a batch at once, blocks
with a signature in the passage are looked up and their block maxima added up; a passage with a block over theta
goes on to block-max WAND, which finds the segments exactly.

A retrieved item is then verified, its question (all sentences but the last) and its answer (the last one) both:
a document leaks an item if it holds 0.8 of the item's word n-grams, and half of the question's and half of the
answer's. Of a part with fewer than 2 n words the n-grams are half as long as the part, so that one changed word
in a short answer doesn't hide it. A document with the question alone is no leak, nor is one with the answer alone.

The index is made in shards of about SHARD_WORDS words (an item is never cut in two, so a longer one is a shard of its
own), each broadcast by itself in one pass over the documents; its arrays are sparse and have a few numbers for each
word, whatever the number of items. Document frequencies and the average length are those of all items. Null or empty
items have no words and match nothing; null or empty texts match nothing; items with fewer than n words have one n-gram,
all their words. Ties don't matter, as all over the threshold are retrieved. Very long texts are searched 512 passages
at a time. Repeated item ids are one item for each text. Empty tables give no rows. Other columns are ignored
(leaks) or kept (clean_documents).
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced, words_of, written
from .ngram_join import WordHash, ngram_hashes

SEGMENT = 64
#: Segments in a block of the index.
BLOCK = 4
SHARD_WORDS = 2_000_000
K1, B = 1.2, 0.75
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of all sentences but the last, and of the last; a lone sentence is both."""
    parts = [w for w in map(words_of, _SENTENCE.split(text)) if w]
    if len(parts) < 2:
        return (parts or [[]])[0], (parts or [[]])[0]
    return [w for p in parts[:-1] for w in p], parts[-1]


def segments_of(text: str) -> list[list[str]]:
    words = words_of(text)
    return [words[i : i + SEGMENT] for i in range(0, len(words), SEGMENT)]


def gram_length(words: int, n: int) -> int:
    """Length of the n-grams of a question or an answer."""
    return min(n, max(1, words // 2))


def _grams(words: list[str], k: int, seen: WordHash) -> tuple[int, np.ndarray]:
    """k and the hashes of the k-grams of some words."""
    k = min(k, len(words))
    return k, np.unique(ngram_hashes(words, k, seen)) if k else np.empty(0, np.uint64)


@dataclass
class Shard:
    """An inverted index of some segments, and the items that they come from. Lists of many terms or blocks stand behind
    each other in one array; `_at` has where each begins."""

    terms: dict[str, int]
    item_of: np.ndarray  # of each segment, the place of its item in items
    posting_at: np.ndarray  # of each term, its segments (ascending) and impacts
    segments: np.ndarray
    impacts: np.ndarray
    most: np.ndarray  # of each term, the largest impact
    block_at: np.ndarray  # of each block, its terms (ascending) and their largest impact in it
    block_terms: np.ndarray
    block_most: np.ndarray
    signature_at: np.ndarray  # of each term, the blocks with a segment of whose signature it is
    signature_blocks: np.ndarray
    items: list[tuple[int | None, tuple, tuple, tuple]]  # id, (k, k-grams) of all, of question and of answer

    @property
    def n_blocks(self) -> int:
        return len(self.block_at) - 1


def _listed(keys: np.ndarray, n: int) -> np.ndarray:
    """Where each of n lists begins, of lists that stand behind each other with these ascending keys."""
    return np.searchsorted(keys, np.arange(n + 1)).astype(np.int64)


def build_shard(items: list[tuple[int | None, str]], df: dict[str, int], n_segments: int, average: float, n: int, theta: float) -> Shard:
    """items: (id, text); df: of each term, how many segments of all items hold it."""
    terms: dict[str, int] = {}
    item_of: list[int] = []
    rows: list[tuple[int, int, float, bool]] = []  # term, segment, impact, in its signature
    kept = []
    seen = WordHash()
    for item_id, text in items:
        words = words_of(text)
        if not words:
            continue
        q, a = question_and_answer(text)
        kept.append((item_id, _grams(words, n, seen), _grams(q, gram_length(len(q), n), seen), _grams(a, gram_length(len(a), n), seen)))
        for part in segments_of(text):
            tf = Counter(part)
            weight = {t: math.log(1 + (n_segments - df[t] + 0.5) / (df[t] + 0.5)) * c * (K1 + 1) / (c + K1 * (1 - B + B * len(part) / average)) for t, c in tf.items()}
            total, held = sum(weight.values()), 0.0
            for t in sorted(weight, key=lambda t: (-weight[t], t)):
                rows.append((terms.setdefault(t, len(terms)), len(item_of), weight[t] / total, held <= 1 - theta + 1e-5))
                held += weight[t] / total
            item_of.append(len(kept) - 1)
    term, seg, impact, signs = (np.array([r[i] for r in rows], kind) for i, kind in enumerate((np.int64, np.int64, np.float64, bool)))
    blocks = (len(item_of) + BLOCK - 1) // BLOCK
    by_term = np.lexsort((seg, term))
    most = np.zeros(len(terms))
    np.maximum.at(most, term, impact)
    cell, where = np.unique(seg // BLOCK * max(1, len(terms)) + term, return_inverse=True)
    block_most = np.zeros(len(cell))
    np.maximum.at(block_most, where, impact)
    signed = np.unique(term[signs] * max(1, blocks) + seg[signs] // BLOCK)
    return Shard(
        terms, np.array(item_of, np.int64), _listed(term[by_term], len(terms)), seg[by_term], impact[by_term], most, _listed(cell // max(1, len(terms)), blocks), cell % max(1, len(terms)), block_most,
        _listed(signed // max(1, blocks), len(terms)), signed % max(1, blocks), kept,
    )


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places begins[i] .. begins[i] + sizes[i] - 1 for each i, behind each other."""
    return np.repeat(begins - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())


def block_bounds(present: np.ndarray, cells: np.ndarray, shard: Shard) -> np.ndarray:
    """For cells (passage times the number of blocks plus block): the sum of the block's maxima over the passage's terms.

    present: of each passage and each term, whether it has it.
    """
    out = np.zeros(len(cells))
    for a in range(0, len(cells), 4096):
        passage, block = np.divmod(cells[a : a + 4096], shard.n_blocks)
        begins = shard.block_at[block]
        sizes = shard.block_at[block + 1] - begins
        at = _ranges(begins, sizes)
        weights = shard.block_most[at] * present[np.repeat(passage * len(shard.terms), sizes) + shard.block_terms[at]]
        out[a : a + 4096] = np.add.reduceat(weights, np.cumsum(sizes) - sizes)
    return out


def block_max_wand(query: list[int], shard: Shard, theta: float, blocks: list[int] | None = None) -> list[tuple[int, float]]:
    """All segments whose impacts for the query's terms (ascending) add up to theta or more, and their scores.

    blocks: those, ascending, whose block maxima for the query reach theta, where that is known already; lists
    are then moved from one of them to the next.
    """
    out: list[tuple[int, float]] = []
    limit = theta - 1e-6
    if not query:
        return out
    if blocks is None:
        present = np.zeros(len(shard.terms), bool)
        present[query] = True
        blocks = np.flatnonzero(block_bounds(present, np.arange(shard.n_blocks), shard) >= limit - 1e-4).tolist()
    if not blocks:
        return out
    bound_of = {b: dict(zip(shard.block_terms[(r := slice(shard.block_at[b], shard.block_at[b + 1]))].tolist(), shard.block_most[r].tolist(), strict=True)) for b in blocks}
    lists = {t: (shard.segments[(r := slice(shard.posting_at[t], shard.posting_at[t + 1]))].tolist(), shard.impacts[r].tolist()) for t in query}
    cursors = []  # segment, place in its list, term
    for t in query:
        segs = lists[t][0]
        at = bisect_left(segs, blocks[0] * BLOCK)
        if at < len(segs):
            cursors.append([segs[at], at, t])
    while cursors:
        cursors.sort()
        bound, pivot = 0.0, -1
        for i, c in enumerate(cursors):
            bound += shard.most[c[2]]
            if bound >= limit:
                pivot = i
                break
        if pivot < 0:
            return out
        seg = cursors[pivot][0]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == seg:
            pivot += 1
        at = bisect_left(blocks, seg // BLOCK)
        if at == len(blocks):
            return out
        if blocks[at] * BLOCK > seg:  # this block's maxima are too small: on to the next that may do
            aim = blocks[at] * BLOCK
        elif sum(bound_of[seg // BLOCK].get(c[2], 0.0) for c in cursors[: pivot + 1]) < limit:
            aim = (seg // BLOCK + 1) * BLOCK  # or to the next list that may add to this one
            if pivot + 1 < len(cursors):
                aim = max(seg + 1, min(aim, cursors[pivot + 1][0]))
        elif cursors[0][0] == seg:
            score = sum(lists[c[2]][1][c[1]] for c in cursors[: pivot + 1])
            if score >= limit:
                out.append((seg, score))
            aim = seg + 1
        else:
            aim = seg
        left = []
        for c in cursors:
            if c[0] < aim:
                segs = lists[c[2]][0]
                c[1] = bisect_left(segs, aim, c[1])
                if c[1] == len(segs):
                    continue
                c[0] = segs[c[1]]
            left.append(c)
        cursors = left
    return out


def search(words: list[str], shard: Shard, theta: float) -> list[tuple[int, float]]:
    """(item, score) for every item of which a passage of a text retrieves a segment."""
    get, width = shard.terms.get, len(shard.terms)
    signs = np.diff(shard.signature_at)
    best: dict[int, float] = {}
    ids = np.array([get(w, -1) for w in words], np.int64)
    span = max(1, min(512, (1 << 22) // width))  # passages at a time: a bit for each of their terms
    for start in range(0, max(1, len(ids) - SEGMENT), span * SEGMENT):
        some = ids[start : start + (span + 1) * SEGMENT]
        known = np.flatnonzero(some >= 0)
        cells, terms = known // SEGMENT, some[known]
        if not signs[terms].any():
            continue
        last = max(0, -(-len(some) // SEGMENT) - 2)  # a passage is a cell of SEGMENT words and the next one
        present = np.zeros((last + 1) * width, bool)
        present[np.minimum(cells, last) * width + terms] = True
        present[np.clip(cells - 1, 0, last) * width + terms] = True
        passage, term = np.divmod(np.flatnonzero(present), width)
        sizes = signs[term]
        met = np.zeros((last + 1) * shard.n_blocks, bool)
        met[np.repeat(passage * shard.n_blocks, sizes) + shard.signature_blocks[_ranges(shard.signature_at[term], sizes)]] = True
        candidates = np.flatnonzero(met)
        good = candidates[block_bounds(present, candidates, shard) >= theta - 1e-4]
        for p in np.unique(good // shard.n_blocks):
            blocks = (good[good // shard.n_blocks == p] % shard.n_blocks).tolist()
            for seg, score in block_max_wand(term[passage == p].tolist(), shard, theta, blocks):
                item = int(shard.item_of[seg])
                best[item] = max(best.get(item, 0.0), score)
    return list(best.items())


class _Held:
    """The k-grams of a document, for each k once."""

    def __init__(self, words: list[str], seen: WordHash):
        self.words, self.seen, self.grams = words, seen, {}

    def share(self, part: tuple[int, np.ndarray]) -> float:
        """The part of some k-grams that the document holds."""
        k, grams = part
        if not k or len(self.words) < k:
            return 0.0
        if k not in self.grams:
            self.grams[k] = np.unique(ngram_hashes(self.words, k, self.seen))
        return float(np.isin(grams, self.grams[k], assume_unique=True).mean())


def find(texts: list[str | None], shard: Shard, theta: float, overlap: float, part: float) -> list[tuple[int, int, float, float, float, float]]:
    """(text, item, score, overlap, question overlap, answer overlap) of verified items."""
    out = []
    seen = WordHash()
    for i, text in enumerate(texts):
        words = words_of(text)
        held = _Held(words, seen)
        for k, score in search(words, shard, theta) if words else ():
            o, q, a = (held.share(x) for x in shard.items[k][1:])
            if o >= overlap - 1e-9 and q >= part - 1e-9 and a >= part - 1e-9:
                out.append((i, k, score, o, q, a))
    return out


def index(benchmark: DataFrame, n: int = 5, theta: float = 0.6) -> Iterator[Shard]:
    """Shards of the index; each is collected by itself, and holds about SHARD_WORDS words."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text IS NOT NULL").distinct()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            rows = [(len(part), sorted(set(part))) for t in b.column(1).to_pylist() for part in segments_of(t)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.string()))], names=["words", "terms"])

    parts = items.mapInArrow(split, "words long, terms array<string>")
    total = parts.agg(F.count(F.lit(1)).alias("n"), F.avg("words").alias("average")).collect()[0]
    if not total.n:
        return
    shards = max(1, math.ceil(total.n * total.average / SHARD_WORDS))
    dealt = written(items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)).cast("int")), "items")
    counts = written(parts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")), "terms")
    for s in range(shards):
        own = sorted(((r.item_id, r.text) for r in dealt.filter(F.col("shard") == s).collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        if own:
            wanted = items.sparkSession.createDataFrame([(t,) for t in sorted({w for _, x in own for w in words_of(x)})] or [("",)], "term string")
            df = {r.term: r.df for r in counts.join(F.broadcast(wanted), "term").collect()}
            yield build_shard(own, df, total.n, total.average, n, theta)


LEAKS = "doc_id long, item_id long, score double, overlap double, question_overlap double, answer_overlap double"


def leaks(documents: DataFrame, benchmark: DataFrame, n: int = 5, overlap: float = 0.8, theta: float = 0.6, part: float = 0.5) -> DataFrame:
    """A row for each document and test item that it holds."""
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for shard in index(benchmark, n, theta):
        shared = spark.sparkContext.broadcast(shard)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in sliced(batches):
                ids = b.column(0).to_pylist()
                found = find(b.column(1).to_pylist(), shared.value, theta, overlap, part)
                cols = list(zip(*((ids[i], shared.value.items[k][0], s, o, q, a) for i, k, s, o, q, a in found), strict=True)) or [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if j < 2 else pa.float64()) for j, c in enumerate(cols)], names=["doc_id", "item_id", "score", "overlap", "question_overlap", "answer_overlap"])

        found = rows.mapInArrow(run, LEAKS)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], LEAKS) if out is None else out


def clean_documents(documents: DataFrame, benchmark: DataFrame, n: int = 5, overlap: float = 0.8, theta: float = 0.6, part: float = 0.5) -> DataFrame:
    """The documents that hold no test item, with all their columns."""
    out, at = documents, documents.columns.index("text")
    for shard in index(benchmark, n, theta):
        shared = documents.sparkSession.sparkContext.broadcast(shard)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in sliced(batches):
                keep = np.ones(b.num_rows, bool)
                for x in find(b.column(at).to_pylist(), shared.value, theta, overlap, part):
                    keep[x[0]] = False
                yield b.filter(pa.array(keep))

        out = out.mapInArrow(run, documents.schema)
    return out
