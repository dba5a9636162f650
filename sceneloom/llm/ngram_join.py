"""N-gram Jaccard self-join by MinHash bands.

Documents with equal texts are one class. Of each class one text goes on: its set of word n-grams is hashed to a
MinHash signature, whose bands are shuffled; texts that share a band are compared on their full n-gram sets.
Bands and rows are chosen for the recall wanted at the threshold.

No pair is ever a row. Each bucket of texts that share a band is compared inside one task, or, if its n-grams
are many, inside a task for each pair of its blocks, with matrix products; what leaves a task is a count of
links and a local root for each text. Buckets with the same members are compared once, and a pair counts in the
first of the buckets that it shares. So links are counted exactly, and their components found from the roots.

Null texts: each such row is a class of its own without links. Texts of fewer than n words have one n-gram, all
their words; texts without words have none and only equal texts as company. Repeated rows count as copies.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, join_classes, sliced, words_of, written

#: N-grams of a block of texts, about (8 bytes each); a task holds two blocks.
BLOCK_NGRAMS = 1 << 19
#: Texts of a block at most, about.
BLOCK_TEXTS = 1024


def choose_bands(threshold: float = 0.8, recall: float = 0.9999, most_hashes: int = 128) -> tuple[int, int]:
    """(bands, rows): the longest bands, so the fewest false candidates, that reach the recall with so many hashes."""
    best = None
    for rows in range(1, 13):
        p = threshold**rows
        bands = 1 if p >= 1 else max(1, math.ceil(math.log(1 - recall) / math.log(1 - p)))
        if bands * rows <= most_hashes or best is None:
            best = (bands, rows)
    return best


class WordHash(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngram_hashes(words: list[str], n: int, seen: WordHash) -> np.ndarray:
    """Hashes of the n-grams of a text, not yet distinct."""
    if not words:
        return np.empty(0, np.uint64)
    w = np.array([seen[x] for x in words], np.uint64)
    k = min(n, len(w))
    out = np.full(len(w) - k + 1, np.uint64(k), np.uint64)
    for i in range(k):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + w[i : len(w) - k + 1 + i])
    return out


def ngram_set(text: str, n: int, seen: WordHash) -> np.ndarray:
    return np.unique(ngram_hashes(words_of(text), n, seen))


def text_key(text: Column) -> Column:
    """128 bits that stand for a text; null for null."""
    return F.unhex(F.md5(text))


def _sketches(rows: DataFrame, n: int, bands: int, per_band: int) -> DataFrame:
    """doc_id, key, n_grams, bands (a hash of each band and its number)."""
    draws = np.random.RandomState(20240607)
    mult = (draws.randint(0, 1 << 31, bands * per_band).astype(np.uint32) << np.uint32(1)) | np.uint32(1)
    plus = draws.randint(0, 1 << 31, bands * per_band).astype(np.uint32)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = WordHash()
        for b in sliced(batches):
            hashes = [ngram_hashes(words_of(t), n, seen) for t in b.column(2).to_pylist()]
            sizes = [len(h) for h in hashes]
            counts = [len(np.unique(h)) for h in hashes]
            full = np.flatnonzero(np.array(sizes) > 0)
            found = np.zeros((len(full), bands), np.uint64)
            at = 0
            while at < len(full):  # texts of about 1 << 17 n-grams at once, so that arrays stay in cache
                to, total = at, 0
                while to < len(full) and (to == at or total + sizes[full[to]] <= 1 << 17):
                    total += sizes[full[to]]
                    to += 1
                some = [hashes[i] for i in full[at:to]]
                starts = np.concatenate(([0], np.cumsum([len(h) for h in some])[:-1]))
                x = (np.concatenate(some) >> np.uint64(32)).astype(np.uint32)
                for band in range(bands):
                    h = np.full(to - at, np.uint64(band + 1), np.uint64)
                    for k in range(band * per_band, (band + 1) * per_band):
                        h = _mixed(h * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(x * mult[k] + plus[k], starts).astype(np.uint64))
                    found[at:to, band] = h
                at = to
            offsets = np.zeros(len(hashes) + 1, np.int32)
            has = np.zeros(len(hashes), np.int32)
            has[full] = bands
            offsets[1:] = np.cumsum(has)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(counts, pa.int32()), lists], names=["doc_id", "key", "n_grams", "bands"])

    return rows.mapInArrow(sketch, "doc_id long, key binary, n_grams int, bands array<long>")


def _sets(rows: DataFrame, n: int) -> DataFrame:
    """key and the sorted n-gram hashes of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = WordHash()
        for b in sliced(batches):
            sets = [ngram_set(t, n, seen).view(np.int64) for t in b.column(1).to_pylist()]
            offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets) if sets else np.empty(0, np.int64)))], names=["key", "grams"])

    return rows.mapInArrow(run, "key binary, grams array<long>")


def _linked(sets: list[np.ndarray], pairs: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs (a matrix of those to look at) have a Jaccard measure of the threshold or more."""
    sizes = np.array([len(s) for s in sets], np.int64)
    pairs = pairs.copy()
    strips = [slice(a, a + 128) for a in range(0, len(sets), 128)]  # of rows, as a matrix of numbers is large
    for some in strips:
        mine = sizes[some, None]
        pairs[some] &= np.minimum(mine, sizes) >= threshold * np.maximum(mine, sizes) - 1e-9
    out = np.zeros_like(pairs)
    todo = int(pairs.sum())
    if not todo:
        return out
    if todo <= 4 * len(sets):
        kept: dict[int, set] = {}
        for i, j in zip(*np.nonzero(pairs), strict=True):
            for k in (i, j):
                if k not in kept:
                    kept[k] = set(sets[k].tolist())
            common = len(kept[i] & kept[j])
            out[i, j] = common >= threshold * (sizes[i] + sizes[j] - common) - 1e-9
        return out
    grams, where, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    shared = times[where] > 1  # a gram of one text alone adds nothing
    column = np.cumsum(times > 1) - 1
    common = np.zeros((len(sets), len(sets)), np.float32)
    rows, cols = owner[shared], column[where[shared]]
    order = np.argsort(cols, kind="stable")
    rows, cols = rows[order], cols[order]
    width = max(64, (1 << 23) // len(sets))
    last = int(cols[-1]) + 1 if len(cols) else 0
    for a in range(0, last, width):
        lo, hi = np.searchsorted(cols, (a, a + width))
        x = np.zeros((len(sets), min(width, last - a)), np.float32)
        x[rows[lo:hi], cols[lo:hi] - a] = 1
        common += x @ x.T
        del x
    for some in strips:
        pairs[some] &= common[some] >= threshold * (sizes[some, None] + sizes - common[some]) - 1e-6
    return pairs


def _compare(rows: DataFrame, threshold: float) -> DataFrame:
    """key, links, root of each text that has a link in a bucket; rows come sorted by bucket and blocks."""
    out_schema = pa.schema([("key", pa.binary()), ("links", pa.int64()), ("root", pa.binary())])

    def bucket(members: list[tuple], bh: int, across: bool) -> Iterator[tuple]:
        """members: (key, block side, own buckets, grams)"""
        n = len(members)
        if n < 2:
            return
        look = np.triu(np.ones((n, n), bool), 1)
        if across:  # of two blocks of a bucket, texts of one against the other's
            side = np.array([m[1] for m in members])
            look &= side[:, None] != side[None, :]
        earlier = sorted({x for m in members for x in m[2] if x < bh})
        if earlier:  # a pair belongs to the first bucket that both are in
            at = {x: i for i, x in enumerate(earlier)}
            held = np.zeros((n, len(earlier)), np.float32)
            for i, m in enumerate(members):
                for x in m[2]:
                    if x < bh:
                        held[i, at[x]] = 1
            look &= (held @ held.T) == 0
        if not look.any():
            return
        link = _linked([m[3] for m in members], look, threshold)
        link |= link.T
        counts = link.sum(1)
        root = np.arange(n)
        left = set(np.flatnonzero(counts).tolist())
        while left:  # components by breadth
            first = left.pop()
            wave = np.zeros(n, bool)
            wave[first] = True
            whole = wave.copy()
            while wave.any():
                wave = link[wave].any(0) & ~whole
                whole |= wave
            ids = np.flatnonzero(whole)
            root[ids] = min(ids, key=lambda i: members[i][0])
            left.difference_update(ids.tolist())
        for i in np.flatnonzero(counts):
            yield members[i][0], int(counts[i]), members[root[i]][0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stream():
            for b in batches:
                flat, ends = b.column(6).values.to_numpy(zero_copy_only=False), b.column(6).offsets.to_numpy()
                cols = [b.column(i).to_pylist() for i in range(6)]
                for i in range(b.num_rows):
                    yield cols[0][i], cols[1][i], cols[2][i], cols[3][i], cols[4][i], cols[5][i], flat[ends[i] : ends[i + 1]].copy()

        out: list[tuple] = []
        for (bh, lo, hi), own in itertools.groupby(stream(), key=lambda r: r[:3]):
            out += bucket([(r[4], r[3], r[5], r[6]) for r in own], bh, lo != hi)
            if len(out) > 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), out_schema, strict=True)], schema=out_schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), out_schema, strict=True)], schema=out_schema)

    return rows.select("bh", "lo", "hi", "block", "key", "own", "grams").mapInArrow(run, "key binary, links long, root binary")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """key, component: the least key that edges (key, root) connect it to.

    Each round takes the least label among neighbours and then the label's own label, so that long chains
    shrink by powers of two; every round is a written table.
    """
    both = written(edges.select("key", "root").union(edges.select(F.col("root"), F.col("key"))).distinct().toDF("src", "dst"), "cc-edges")
    labels = written(both.groupBy("src").agg(F.min("dst").alias("m")).select(F.col("src").alias("key"), F.least("src", "m").alias("label")), "cc-labels")
    for _ in range(most_rounds):
        offered = both.join(labels, both["dst"] == labels["key"]).groupBy("src").agg(F.min("label").alias("offer"))
        step = labels.join(offered, labels["key"] == offered["src"]).select("key", F.col("label").alias("was"), F.least("label", "offer").alias("label"))
        up = labels.select(F.col("key").alias("_k"), F.col("label").alias("_l"))
        new = written(step.join(up, step["label"] == up["_k"], "left").select("key", "was", F.least(F.col("label"), F.coalesce("_l", "label")).alias("label")), "cc-labels")
        labels = new.select("key", "label")
        if new.filter(F.col("was") != F.col("label")).isEmpty():
            return labels.withColumnRenamed("label", "component")
    raise RuntimeError(f"components didn't settle in {most_rounds} rounds")


def near_duplicates(documents: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.9999) -> DataFrame:
    """doc_id, key, class_id, copies, n_links, group_id: one row for each document.

    class_id: the least doc_id of an equal text; copies: documents with this text; n_links: other texts with a
    Jaccard measure of the threshold or more; group_id: the least doc_id among all texts that links connect.
    """
    spark = documents.sparkSession
    bands, per_band = choose_bands(threshold, recall)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text").cast("string")).alias("key"), F.col("text").cast("string").alias("text"))
    sketches = written(_sketches(rows, n, bands, per_band), "sketches")
    classes = written(
        sketches.filter("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("copies"), F.any_value(F.struct("n_grams", "bands")).alias("s"))
        .select("key", "class_id", "copies", "s.n_grams", "s.bands"), "classes",
    )
    in_bands = classes.filter("n_grams > 0").select("key", "n_grams", F.explode("bands").alias("bh"))
    buckets = in_bands.groupBy("bh").agg(
        F.count(F.lit(1)).alias("members"), F.sum("n_grams").alias("grams"), F.bit_xor(F.xxhash64("key")).alias("x"), F.min("key").alias("first")
    )
    # buckets with the same members are compared once
    blocks = F.greatest(F.ceil(F.col("grams") / BLOCK_NGRAMS), F.ceil(F.col("members") / BLOCK_TEXTS)).cast("int")
    alone = buckets.filter("members > 1").groupBy("members", "x", "first").agg(F.min("bh").alias("bh"), F.any_value("grams").alias("grams"))
    sized = written(alone.select("bh", "members", blocks.alias("blocks")), "bucket-sizes")
    in_buckets = written(join_classes(in_bands, sized, "bh", "members", ["key"]).filter("blocks IS NOT NULL").select("key", "bh", "blocks"), "buckets")

    wanted = written(in_buckets.groupBy("key").agg(F.sort_array(F.collect_set("bh")).alias("own")).join(classes.select("key", "class_id"), "key"), "wanted")
    side = wanted.select(F.col("key").alias("_k"), F.col("class_id").alias("_c"))
    if wanted.count() <= BROADCAST_ROWS:
        side = F.broadcast(side)
    texts = rows.join(side, (F.col("key") == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_c"))).select("key", "text")
    sets = _sets(texts, n).dropDuplicates(["key"])
    one = F.pmod(F.xxhash64("key", "bh"), F.col("blocks")).cast("int")
    spread = (
        in_buckets.join(wanted.select("key", "own"), "key").join(sets, "key").withColumn("block", one)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("bh", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "key", "own", "grams")
    )
    links = written(_compare(spread.repartition("bh", "lo", "hi").sortWithinPartitions("bh", "lo", "hi"), threshold), "links")
    counted = links.groupBy("key").agg(F.sum("links").alias("n_links"))
    labels = components(links.filter(F.col("key") != F.col("root")))
    groups = classes.select("key", "class_id").join(labels, "key")
    heads = groups.groupBy("component").agg(F.min("class_id").alias("group_id"))
    grouped = labels.join(heads, "component").select("key", "group_id")
    known = classes.select("key", "class_id", "copies").join(counted, "key", "left").join(grouped, "key", "left")
    # texts that stand alone need no join: what they are follows from their own row
    known = known.select("key", "class_id", "copies", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("group_id", "class_id").alias("group_id")).filter("copies > 1 OR n_links > 0")
    out = join_classes(sketches.select("doc_id", "key"), written(known, "known"), "key", "copies", ["doc_id"])
    own = F.col("copies").isNull()
    return out.select(
        "doc_id", "key", F.when(own, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("copies", F.lit(1)).alias("copies"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(own, F.col("doc_id")).otherwise(F.col("group_id")).alias("group_id"),
    )


def one_of_each_group(documents: DataFrame, n: int = 5, threshold: float = 0.8) -> DataFrame:
    """The documents without near duplicates: of each group the row with the least doc_id stays, of its repeats one.

    Rows with null text stay. All columns stay, whatever their names.
    """
    found = written(near_duplicates(documents, n, threshold), "near")
    lost = found.filter("key IS NOT NULL AND NOT doc_id <=> group_id").select("doc_id", "key").distinct()
    if lost.count() <= BROADCAST_ROWS:
        lost = F.broadcast(lost)
    rows = documents.select(F.col("doc_id").cast("long").alias("id"), text_key(F.col("text").cast("string")).alias("text_key"), F.struct(*[f"`{c}`" for c in documents.columns]).alias("row"))
    kept = rows.join(lost, F.col("id").eqNullSafe(lost["doc_id"]) & (F.col("text_key") == lost["key"]), "left_anti")
    repeated = found.filter("key IS NOT NULL AND doc_id <=> group_id").groupBy("doc_id", "key").count().filter("count > 1")
    if not repeated.isEmpty():
        apart = F.when(F.col("text_key").isNull(), F.monotonically_increasing_id())  # rows with null text don't repeat each other
        kept = kept.withColumn("apart", apart).dropDuplicates(["id", "text_key", "apart"])
    return kept.select("row.*")


#: DuckDB SQL of near_duplicates(), without the key: all n-grams of all texts, joined.
ORACLE = r"""
WITH RECURSIVE t AS MATERIALIZED (SELECT min(doc_id) AS c, count(*) AS copies, text, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS ws FROM documents WHERE text IS NOT NULL GROUP BY text),
g AS MATERIALIZED (SELECT DISTINCT c, hash(unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END)) AS gram FROM t),
n AS (SELECT c, count(*) AS n FROM g GROUP BY c),
p AS (SELECT a.c AS x, b.c AS y, count(*) AS m FROM g a JOIN g b ON a.gram = b.gram AND a.c <> b.c GROUP BY a.c, b.c),
l AS MATERIALIZED (SELECT x, y FROM p JOIN n a ON a.c = x JOIN n b ON b.c = y WHERE 5 * m >= 4 * (a.n + b.n - m)),
r(c, root) AS (SELECT c, c FROM t UNION SELECT l.y, r.root FROM r JOIN l ON r.c = l.x),
k AS (SELECT c, min(root) AS group_id FROM r GROUP BY c), d AS (SELECT x, count(*) AS n_links FROM l GROUP BY x)
SELECT doc_id, t.c AS class_id, copies, coalesce(n_links, 0) AS n_links, group_id FROM documents JOIN t USING (text) JOIN k ON k.c = t.c LEFT JOIN d ON d.x = t.c
UNION ALL SELECT doc_id, doc_id, 1, 0, doc_id FROM documents WHERE text IS NULL"""
