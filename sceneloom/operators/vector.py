"""Vector kernels: thresholded cosine pairs in blocks, centroids, representatives, neighbour dedup."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from ..functions.numeric import cosine, dot, norm
from ..session import written
from .graph import connected_components

#: Vectors of a block; a task multiplies two blocks.
BLOCK = 1024
#: Cells at most: their pivots are broadcast (8 bytes a component); and pivots that are chosen to lie apart.
MOST_CELLS, SPREAD = 1 << 16, 1024
#: Vectors farther from their pivot than so many times the angle of nine in ten of the cell stand in cells of their own.
STRAY = 2.0
#: Dimensions from which a product first looks at a part of them, and the share of a strip's pairs left by that from which it isn't
#: worth its while.
WIDE, IDLE = 32, 0.7
#: Where a vector would meet more blocks than SIDES, cells are packed into about so many blocks, of MOST_COMPONENTS numbers at most.
SIDES, MOST_COMPONENTS = 24, 1 << 21
#: Numbers of a home block at most, and tasks at least that home blocks are meant to keep busy; at most so many tasks.
HOME, HOMES, MOST_TASKS = 1 << 20, 12, 4096
#: Pairs from which a task's pairs shrink to their forest.
MOST_PAIRS = 1 << 20


def _drawn(rows: DataFrame, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Pivots at length 1, and a rotation that puts the directions in which they vary most first.

    Of four times as many vectors, those whose ids have the least hashes, each of the first SPREAD pivots is the one that is
    farthest from those before it, so that no cluster of the sample goes without; the others follow by their hashes.
    """
    some = np.array([r[0] for r in rows.orderBy(F.xxhash64("_id")).limit(4 * cells).select("_v").collect()], np.float64)
    some /= np.maximum(np.linalg.norm(some, axis=1, keepdims=True), 1e-300)
    chosen, near = [0], some @ some[0]
    while len(chosen) < min(cells, SPREAD, len(some)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, some @ some[chosen[-1]])
        near[chosen[-1]] = np.inf
    others = np.setdiff1d(np.arange(len(some)), chosen)[: max(0, cells - len(chosen))]
    return some[[*dict.fromkeys(chosen), *others.tolist()]], np.linalg.eigh(some.T @ some)[1][:, ::-1]


def _in_cells(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """rows with `_cell`, the place of the pivot nearest by angle, and `_angle` to it. Vectors of length 0 have no angle: they
    count as opposite."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)
    at = rows.columns.index("_v")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell, angle = np.zeros(b.num_rows, np.int32), np.zeros(b.num_rows)
            some_rows = max(1, (1 << 22) // len(shared.value))
            for lo in range(0, b.num_rows, some_rows):
                part = b.column(at).slice(lo, some_rows)
                x = part.flatten().to_numpy().reshape(len(part), -1).astype(np.float64)
                norms = np.linalg.norm(x, axis=1)
                cos = (x @ shared.value.T) / np.maximum(norms, 1e-300)[:, None]
                cell[lo : lo + len(x)] = cos.argmax(1)
                angle[lo : lo + len(x)] = np.where(norms > 0, np.arccos(np.clip(cos.max(1), -1, 1)), np.pi)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(angle)], names=[*b.schema.names, "_cell", "_angle"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return written(rows.mapInArrow(assign, f"{fields}, _cell int, _angle double"), "cells")


def near_cells(pivots: np.ndarray, radii: np.ndarray, threshold: float, some: slice = slice(None)) -> np.ndarray:
    """Which pairs of cells (of `some` with all) may hold vectors with a cosine of the threshold or more: two vectors are apart
    by the angle of their pivots less both their own angles at least. Cells without a bound have radius pi."""
    apart = np.arccos(np.clip(pivots[some] @ pivots.T, -1, 1)) - radii[some][:, None] - radii[None, :]
    return apart <= np.arccos(np.clip(threshold, -1, 1)) + 1e-6


class _Cells:
    """Vectors in cells around pivots: which cells meet, how many copies of vectors that takes, and a rotation for bounds."""

    def __init__(self, rows: DataFrame, n: int, threshold: float, block: int):
        spark = rows.sparkSession
        self.rows, self.n, self.threshold, self.block = rows, n, threshold, block
        cells = min(MOST_CELLS, max(math.ceil(n / block) if n < block * block else 0, math.ceil(math.sqrt(n))))
        pivots, self.rotation = _drawn(rows, cells)
        found = _in_cells(rows, pivots)
        angles = found.groupBy("_cell").agg(F.percentile_approx("_angle", 0.9).alias("most"), F.max("_angle").alias("max"))
        radius = F.when(F.col("max") <= STRAY * F.col("most"), F.col("max")).otherwise(STRAY * F.col("most")).alias("_radius")
        radii = written(angles.select("_cell", radius), "cell-radii")  # a row for each cell
        strays = len(pivots)
        self.placed = found.join(F.broadcast(radii), "_cell").withColumn("_cell", F.when(F.col("_angle") <= F.col("_radius"), F.col("_cell")).otherwise(strays))
        counts = {r._cell: r.n for r in self.placed.groupBy("_cell").agg(F.count(F.lit(1)).alias("n")).collect()}
        self.used = used = sorted(counts)
        self.rows_in = np.array([counts[c] for c in used])
        self.parts = np.array([max(1, math.ceil(counts[c] / block)) for c in used])
        firsts = np.concatenate(([0], np.cumsum(self.parts)[:-1]))
        bound = {r._cell: r._radius for r in radii.collect()} | {strays: math.pi}
        self.centres = np.concatenate([pivots, np.zeros((1, pivots.shape[1]))])[used]
        self.limits = np.array([bound[c] for c in used])
        shared = spark.sparkContext.broadcast((self.centres, self.limits, np.array(used), firsts, self.parts))

        def meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centres, radii, used, firsts, parts = shared.value
            for b in batches:
                for i in b.column(0).to_pylist():
                    near = np.flatnonzero(near_cells(centres, radii, threshold, slice(i, i + 1))[0])
                    others = pa.array([[{"f": int(firsts[j]), "n": int(parts[j])} for j in near]], pa.list_(pa.struct([("f", pa.int64()), ("n", pa.int64())])))
                    yield pa.RecordBatch.from_arrays([pa.array([int(used[i])], pa.int32()), pa.array([int(firsts[i])]), pa.array([int(parts[i])]), others, pa.array([int(parts[near].sum())])], names=["_cell", "_first", "_parts", "_near", "_blocks"])

        self.table = written(spark.range(len(used)).mapInArrow(meetings, "_cell int, _first long, _parts long, _near array<struct<f:long,n:long>>, _blocks long"), "cell-meetings")
        self.copies = sum(counts[r._cell] * r._blocks for r in self.table.select("_cell", "_blocks").collect())

    def part_little(self) -> bool:
        """Whether vectors meet more blocks than they may be copied to."""
        return self.copies > SIDES * self.n

    def dealt(self) -> DataFrame:
        """A row (_lo, _hi, _own) for each block that a vector meets.

        Where the cells part little, vectors would be copied to as many blocks as there are cells, which grow with the root of
        the rows. There cells are packed into few large blocks, so that the copies of a vector don't grow with the rows.
        """
        if self.part_little():
            return self._packed()
        table = F.broadcast(self.table) if len(self.used) <= BLOCK else self.table  # a million meetings at most
        own = F.col("_first") + F.pmod(F.xxhash64("_id"), F.col("_parts"))
        others = F.flatten(F.transform("_near", lambda x: F.sequence(x["f"], x["f"] + x["n"] - 1)))
        met = self.placed.join(table, "_cell").withColumn("_own", own).withColumn("_other", F.explode(others))
        return met.select(F.least("_own", "_other").alias("_lo"), F.greatest("_own", "_other").alias("_hi"), "_own", *self.rows.columns)

    def packed(self, size: int) -> tuple[DataFrame, np.ndarray, np.ndarray]:
        """The vectors with `_own`, a block of about `size`: cells (or parts of large ones), those along the direction in which
        the pivots vary most side by side; and the cell and the block of each such part."""
        along = np.argsort(self.centres @ self.rotation[:, 0], kind="stable")
        unit_cell = np.repeat(along, self.parts[along])
        before = np.cumsum(self.rows_in[unit_cell] / self.parts[unit_cell]) - 1
        unit_block = np.unique((before // size).astype(np.int64), return_inverse=True)[1]
        of_cell = np.split(unit_block[np.argsort(unit_cell, kind="stable")], np.cumsum(self.parts)[:-1])
        homes = self.rows.sparkSession.createDataFrame([(int(c), at.tolist()) for c, at in zip(self.used, of_cell, strict=True)], "_cell int, _blocks array<long>")  # a row for each cell
        own = F.element_at("_blocks", (F.pmod(F.xxhash64("_id"), F.size("_blocks").cast("long")) + 1).cast("int"))
        return self.placed.join(F.broadcast(homes), "_cell").select("_cell", own.alias("_own"), *self.rows.columns), unit_cell, unit_block

    def _packed(self) -> DataFrame:
        """dealt() with about SIDES blocks."""
        spark, threshold = self.rows.sparkSession, self.threshold
        size = max(self.block, min(math.ceil(self.n / SIDES), MOST_COMPONENTS // self.centres.shape[1]))
        owned, unit_cell, unit_block = self.packed(size)
        shared = spark.sparkContext.broadcast((self.centres, self.limits, unit_cell, unit_block))

        def meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centres, limits, unit_cell, unit_block = shared.value
            for b in batches:
                for i in b.column(0).to_pylist():
                    near = np.zeros(len(centres), bool)
                    for cell in np.unique(unit_cell[unit_block == i]).tolist():
                        near |= near_cells(centres, limits, threshold, slice(cell, cell + 1))[0]
                    yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([np.unique(unit_block[near[unit_cell]]).tolist()])], names=["_own", "_near"])

        table = written(spark.range(int(unit_block[-1]) + 1).mapInArrow(meetings, "_own long, _near array<long>"), "block-meetings")
        met = owned.join(F.broadcast(table), "_own").withColumn("_other", F.explode("_near"))
        return met.select(F.least("_own", "_other").alias("_lo"), F.greatest("_own", "_other").alias("_hi"), "_own", *self.rows.columns)


def forest(a: np.ndarray, b: np.ndarray, cos: np.ndarray) -> np.ndarray:
    """Places of the edges of a maximum spanning forest; of equal weights the edge with the lesser ends comes first."""
    order = np.lexsort((b, a, -cos))
    ids, ends = np.unique(np.concatenate([a[order], b[order]]), return_inverse=True)
    u, v, m = ends[: len(a)], ends[len(a) :], len(a)
    kept, root, left = np.zeros(m, bool), np.arange(len(ids)), np.arange(m)
    while True:
        ru, rv = root[u[left]], root[v[left]]
        apart = ru != rv
        left, ru, rv = left[apart], ru[apart], rv[apart]
        if not len(left):
            return order[kept]
        best = np.full(len(ids), m)
        best[rv[::-1]] = left[::-1]  # of equal places the last counts, which is the first edge
        other = np.full(len(ids), m)
        other[ru[::-1]] = left[::-1]
        best = np.minimum(best, other)
        tops = np.flatnonzero(best < m)
        edge = best[tops]
        kept[edge] = True
        to = root[u[edge]] + root[v[edge]] - tops
        parent = np.arange(len(ids))
        parent[tops] = to
        both = parent[to] == tops  # two components that chose the same edge
        parent[tops[both & (tops < to)]] = tops[both & (tops < to)]
        while not np.array_equal(parent, parent[parent]):
            parent = parent[parent]
        root = parent[root]


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For all ends of edges but the least of each component: that least end, and the end."""
    ids, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v, root = ends[: len(a)], ends[len(a) :], np.arange(len(ids))
    while len(u):
        ru, rv = root[u], root[v]
        apart = ru != rv
        u, v = u[apart], v[apart]
        np.minimum.at(root, np.maximum(ru, rv)[apart], np.minimum(ru, rv)[apart])
        while not np.array_equal(root, root[root]):
            root = root[root]
    rays = root != np.arange(len(ids))
    return ids[root[rays]], ids[rays]


class _Block:
    """Vectors of two blocks that meet: ids, unit vectors, and the columns in which pairs must differ, as numbers."""

    def __init__(self, batches: list[pa.RecordBatch]):
        t = pa.Table.from_batches(batches).combine_chunks()
        self.lo, self.hi = t["_lo"][0].as_py(), t["_hi"][0].as_py()
        self.ids = t["_id"].to_numpy()
        x = t["_v"].chunk(0).flatten().to_numpy().reshape(len(self.ids), -1).astype(np.float64)
        self.x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        self.short = self.x.astype(np.float32)
        self.apart = [t[c].chunk(0).dictionary_encode().indices.fill_null(-1).to_numpy() for c in t.column_names if c.startswith("_a")]
        own = t["_own"].to_numpy()
        self.left = np.flatnonzero(own == self.lo)
        self.right = self.left if self.lo == self.hi else np.flatnonzero(own == self.hi)

    def pairs(self, threshold: float, rotation: np.ndarray | None, tally: list[int]) -> Iterator[pa.RecordBatch]:
        """src, dst and cos over the threshold. With a rotation, a quarter of the dimensions is multiplied first, and the rest,
        by Cauchy and Schwarz, adds the product of what is left of both lengths at most; rows and columns in which no pair can
        reach the threshold go no further. Products are 32 bits wide; what comes within their error of the threshold or above is
        multiplied in 64; the bounds are left off once they spare a strip little. tally: gets the pairs that met and those
        multiplied in full."""
        few, error = self.x.shape[1] // 4, (self.x.shape[1] + 8) * 2.0**-23
        if rotation is not None:
            turned = self.x @ rotation[:, :few]
            rest = np.sqrt(np.maximum(0.0, 1.0 - (turned * turned).sum(1)))
        alone, bounded = self.lo == self.hi, rotation is not None
        for at in range(0, len(self.left), 256):
            some, against = self.left[at : at + 256], self.right[at:] if alone else self.right
            met = len(some) * len(against)
            tally[0] += met
            if bounded:
                may = turned[some] @ turned[against].T + rest[some][:, None] * rest[against][None, :] >= threshold - 1e-9
                some, against = some[may.any(1)], against[may.any(0)]
                bounded = len(some) * len(against) < IDLE * met
            tally[1] += len(some) * len(against)
            if not len(some):
                continue
            few_rows, wide = self.short[some], max(256, (1 << 20) // len(some))
            for lo in range(0, len(against), wide):
                others = against[lo : lo + wide]
                i, j = np.divmod(np.flatnonzero(few_rows @ self.short[others].T >= np.float32(threshold - error)), len(others))
                i, j = some[i], others[j]
                may = (i < j) & (self.ids[i] != self.ids[j]) if alone else np.ones(len(i), bool)
                for v in self.apart:
                    may &= v[i] != v[j]
                i, j = i[may], j[may]
                for k in range(0, len(i), 1 << 16):
                    a, b = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
                    cos = np.einsum("ij,ij->i", self.x[a], self.x[b])
                    over = cos >= threshold
                    a, b = self.ids[a[over]], self.ids[b[over]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(cos[over])], names=["src", "dst", "cos"])

    def forest(self, threshold: float, rotation: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        """Of the pairs those of a maximum spanning forest, so fewer than there are vectors."""
        held: list[np.ndarray] = []

        def shrunk() -> list[np.ndarray]:
            all_ = [np.concatenate(c) for c in zip(*held, strict=True)]
            keep = forest(*all_)
            return [c[keep] for c in all_]

        rows = 0
        for b in self.pairs(threshold, rotation, [0, 0]):
            held.append([c.to_numpy() for c in b.columns])
            rows += b.num_rows
            if rows > MOST_PAIRS:
                held = [shrunk()]
                rows = min(len(held[0][0]), MOST_PAIRS // 2)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in shrunk()], names=["src", "dst", "cos"])

    def stars(self, threshold: float, rotation: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        """The components of the pairs as edges from their least ends, so fewer than there are vectors."""
        src = dst = np.zeros(0, np.int64)
        held, rows = [(src, dst)], 0
        for b in self.pairs(threshold, rotation, [0, 0]):
            held.append((b.column(0).to_numpy(), b.column(1).to_numpy()))
            rows += b.num_rows
            if rows > MOST_PAIRS:
                held, rows = [stars(*[np.concatenate(c) for c in zip(*held, strict=True)])], 0
        src, dst = stars(*[np.concatenate(c) for c in zip(*held, strict=True)])
        yield pa.RecordBatch.from_arrays([pa.array(src), pa.array(dst)], names=["src", "dst"])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    """The blocks of sorted batches, one at a time."""
    held: list[pa.RecordBatch] = []
    now = None
    for b in batches:
        lo, hi = b.column(0).to_numpy(), b.column(1).to_numpy()
        ends = [*(np.flatnonzero((lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1).tolist(), b.num_rows]
        at = 0
        for end in ends:
            if end == at:
                continue
            if held and now != (lo[at], hi[at]):
                yield _Block(held)
                held = []
            now = (lo[at], hi[at])
            held.append(b.slice(at, end - at))
            at = end
    if held:
        yield _Block(held)


def _vectors(df: DataFrame, key: str, vector: str, threshold: float, apart: list[str]) -> DataFrame:
    """_id, _v and the columns in which pairs must differ, of vectors that may have a pair."""
    kind = df.select(vector).schema[0].dataType
    numbers = F.col(vector) if kind == ArrayType(FloatType(), kind.containsNull) else F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = df.select(F.col(key).cast("long").alias("_id"), numbers.alias("_v"), *[F.col(c).cast("string").alias(f"_a{i}") for i, c in enumerate(apart)])
    rows = rows.filter("_v IS NOT NULL")
    if threshold > 0:  # vectors of length 0 have a cosine of 0 to all
        rows = rows.filter(F.exists("_v", lambda x: x != 0))
    return rows


def _at_once(rows: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    return rows.select(zero.alias("_lo"), zero.alias("_hi"), zero.alias("_own"), *rows.columns).repartition(1)


def _met(dealt: DataFrame) -> DataFrame:
    return dealt.repartition("_lo", "_hi").sortWithinPartitions("_lo", "_hi")


def _usable(rotation: np.ndarray) -> np.ndarray | None:
    return rotation if len(rotation) >= WIDE else None


def _meeting(df: DataFrame, key: str, vector: str, threshold: float, apart: list[str], block: int) -> tuple[DataFrame, np.ndarray | None]:
    rows = _vectors(df, key, vector, threshold, apart)
    n = rows.count()
    if n <= block:
        return _at_once(rows), None
    cells = _Cells(rows, n, threshold, block)
    return _met(cells.dealt()), _usable(cells.rotation)


def _joined(met: DataFrame, threshold: float, rotation: np.ndarray | None) -> DataFrame:
    """The components of all pairs of the blocks that meet."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches):
            yield from g.stars(threshold, rotation)

    return connected_components(met.mapInArrow(multiply, "src long, dst long"))


def cosine_pairs(df: DataFrame, key: str, vector: str, threshold: float, apart: list[str] | None = None, block: int = BLOCK) -> DataFrame:
    """Src < dst and cos of all pairs with cos >= threshold that differ in each column of `apart`.

    Vectors are dealt into cells around pivots, and large cells into blocks; those that stray from their cell stand apart,
    so that one of them doesn't widen it. Only blocks of cells that may hold such a pair meet (none is lost: the bounds are
    exact), each two of them in one task as a matrix product, of which a first part of the dimensions rules out rows
    and columns; only pairs over the threshold become rows. How many blocks a vector is copied to follows from how many are
    near it; where vectors have no clusters at all, that is all of them (cosine_work() tells). As many vectors as a block
    has are multiplied at once.
    """
    met, rotation = _meeting(df, key, vector, threshold, apart or [], block)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches):
            yield from g.pairs(threshold, rotation, [0, 0])

    return met.mapInArrow(multiply, "src long, dst long, cos double")


def cosine_forest(df: DataFrame, key: str, vector: str, threshold: float, apart: list[str] | None = None, block: int = BLOCK) -> DataFrame:
    """Pairs of cosine_pairs() that hold the same components together at its threshold and every higher one.

    Each task hands on a maximum spanning forest of its pairs only; the forests of all tasks' pairs hold that of all pairs.
    So there are at most about SIDES edges for each vector, however many pairs there are.
    """
    met, rotation = _meeting(df, key, vector, threshold, apart or [], block)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches):
            yield from g.forest(threshold, rotation)

    return met.mapInArrow(multiply, "src long, dst long, cos double")


def cosine_components(df: DataFrame, key: str, vector: str, threshold: float, block: int = BLOCK) -> DataFrame:
    """Id, component (its least id) of all ends of cosine_pairs().

    Where cells part little, all vectors would meet. Two that are known to be linked, though, by whatever way, needn't: first
    vectors meet only within two blocks of bounded size, one of near cells and one drawn by hash. Then those that
    aren't in the largest component so far meet all others, and only pairs of different components count. So no
    component is missed, and the work grows with the vectors times those that the first blocks left out. If these are more
    than a quarter, all meet, as in cosine_forest().
    """
    rows = _vectors(df, key, vector, threshold, [])
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("_v"))).first()
    if n * (width or 0) <= HOME:
        return _joined(_at_once(rows), threshold, None)
    cells = _Cells(rows, n, threshold, block)
    rotation = _usable(cells.rotation)
    if not cells.part_little():
        return _joined(_met(cells.dealt()), threshold, rotation)
    size = min(math.ceil(n / HOMES), max(1, HOME // width))
    owned, _, unit_block = cells.packed(size)
    blocks = int(unit_block[-1]) + 1

    def met(dealt: DataFrame, meetings: int, number: Column) -> DataFrame:
        """Each meeting in a task, or a task's share of them."""
        tasks = min(meetings, MOST_TASKS)
        return dealt.repartitionById(tasks, F.pmod(number, F.lit(tasks)).cast("int")).sortWithinPartitions("_lo", "_hi")

    drawn = blocks + F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(blocks))
    twice = owned.select(F.explode(F.array("_own", drawn)).alias("_lo"), "_id", "_v").select("_lo", F.col("_lo").alias("_hi"), F.col("_lo").alias("_own"), "_id", "_v")
    part = _joined(met(twice, 2 * blocks, F.col("_lo")), threshold, rotation)
    largest = part.groupBy("component").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "component").first()
    known = part.select(F.col("id").alias("_i"), "component")
    labels = written(owned.join(known, F.col("_id") == F.col("_i"), "left").select("_own", "_id", "_v", F.coalesce("component", "_id").alias("_c"), F.col("_i").isNotNull().alias("_linked")), "labelled")
    outside = labels.filter(F.col("_c") != largest.component) if largest else labels
    left = outside.count()
    if 4 * left > n:
        return _joined(_met(cells.dealt()), threshold, rotation)
    if not left:
        return part
    sides = math.ceil(left / max(size, min(math.ceil(left / SIDES), MOST_COMPONENTS // width)))
    theirs = (-1 - F.pmod(F.xxhash64("_id"), F.lit(sides))).alias("_lo")
    every = lambda lo, hi, name: F.explode(F.sequence(F.lit(lo).cast("long"), F.lit(hi).cast("long"))).alias(name)
    one = outside.select(theirs, every(0, blocks - 1, "_hi"), "_v", "_c").withColumn("_own", F.col("_lo"))
    other = labels.select(every(-sides, -1, "_lo"), F.col("_own").alias("_hi"), "_v", "_c", "_own")
    both = one.unionByName(other).select("_lo", "_hi", "_own", F.col("_c").alias("_id"), "_v", F.col("_c").alias("_a0"))
    joined = _joined(met(both, sides * blocks, (-1 - F.col("_lo")) * blocks + F.col("_hi")), threshold, rotation).select(F.col("id").alias("_i"), "component")
    root = joined.filter(F.col("_i") == largest.component).first()
    inside = labels.filter(F.col("_c") == largest.component).select(F.col("_id").alias("id"), F.lit(root.component if root else largest.component).alias("component"))
    others = outside.join(joined, F.col("_c") == F.col("_i"), "left").filter("_linked OR component IS NOT NULL").select(F.col("_id").alias("id"), F.coalesce("component", "_c").alias("component"))
    return written(inside.unionByName(others).distinct(), "components")


def cosine_work(df: DataFrame, key: str, vector: str, threshold: float, block: int = BLOCK) -> DataFrame:
    """What cosine_pairs() does for its pairs: met, the pairs of vectors whose blocks meet, and multiplied, those of them
    that are multiplied in full; one row."""
    met, rotation = _meeting(df, key, vector, threshold, [], block)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = [0, 0]
        for g in _groups(batches):
            for _ in g.pairs(threshold, rotation, tally):
                pass
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in tally], names=["met", "multiplied"])

    return met.mapInArrow(count, "met long, multiplied long").agg(F.sum("met").alias("met"), F.sum("multiplied").alias("multiplied"))


def centroid(df: DataFrame, key: list[str], vector: str, name: str = "centroid", normalise: bool = True, eps: float = 1e-9) -> DataFrame:
    """The mean vector of each key (normalised), by element, with partial sums."""
    from ..functions.numeric import unit

    parts = df.select(*key, F.posexplode(vector).alias("_i", "_x")).groupBy(*key, "_i").agg(F.avg(F.col("_x").cast("double")).alias("_m"))
    whole = parts.groupBy(*key).agg(F.transform(F.sort_array(F.collect_list(F.struct("_i", "_m"))), lambda p: p["_m"]).alias(name))
    return whole.withColumn(name, unit(F.col(name), eps)) if normalise else whole


def representatives(df: DataFrame, cluster: str, item: str, vector: str, bad: Column, face: Column) -> DataFrame:
    """Of each cluster the member nearest the pool's centroid: usable frames if any, of these those with a
    face if any. cluster, representative, centrality (6 digits). Null clusters have none.

    What a pool takes is known from flags with a row for each cluster, so no cluster's vectors meet in one task."""
    rows = df.select(cluster, item, vector, F.coalesce(bad, F.lit(True)).alias("_bad"), F.coalesce(face, F.lit(False)).alias("_face"))
    flags = rows.groupBy(cluster).agg(F.min("_bad").alias("_all_bad"), F.max("_face").alias("_any_face"), F.max(F.col("_face") & ~F.col("_bad")).alias("_good_face"))
    known = rows.join(written(flags, "pool-flags"), cluster)
    usable = F.col("_all_bad") | ~F.col("_bad")
    among = F.when(F.col("_all_bad"), F.col("_any_face")).otherwise(F.col("_good_face"))
    pool = written(known.filter(usable & (F.col("_face") | ~among)).select(cluster, item, vector), "pool")
    near = pool.join(centroid(pool, [cluster], vector), cluster).withColumn("_c", dot(F.transform(F.col(vector), lambda x: x.cast("double")), F.col("centroid")))
    return near.groupBy(cluster).agg(F.max_by(item, F.struct("_c", -F.col(item))).alias("representative"), F.round(F.max("_c"), 6).alias("centrality"))


def mean_similarity(df: DataFrame, group: list[str], item: str, vector: str, name: str = "mean_cos") -> DataFrame:
    """The mean cosine of a member to the others of its group; null when alone.

    (sum of unit vectors · own - 1) / (n - 1): linear in the group, without pairs.
    """
    from ..functions.numeric import unit

    rows = df.withColumn("_u", unit(F.col(vector), 0.0))
    sums = rows.select(*group, F.posexplode("_u").alias("_i", "_x")).groupBy(*group, "_i").agg(F.sum("_x").alias("_s"), F.count(F.lit(1)).alias("_n"))
    whole = sums.groupBy(*group).agg(F.transform(F.sort_array(F.collect_list(F.struct("_i", "_s"))), lambda p: p["_s"]).alias("_sum"), F.max("_n").alias("_n"))
    out = rows.join(whole, group)
    return out.select(*group, item, F.when(F.col("_n") > 1, (dot(F.col("_u"), F.col("_sum")) - 1) / (F.col("_n") - 1)).alias(name))


def splits(df: DataFrame, key: list[str], order: str, vector: str, threshold: float) -> DataFrame:
    """Positions after which the next row is less similar than the threshold."""
    w = Window.partitionBy(*key).orderBy(order)
    after = F.lead(vector).over(w)
    return df.withColumn("_cos", F.when(after.isNotNull(), cosine(F.col(vector), after))).filter(F.col("_cos") < threshold).select(*key, order)


def neighbour_dedup(df: DataFrame, key: list[str], order: str, shot: str, vector: str, black: str, face: str, threshold: float = 0.75, most_rounds: int = 50) -> DataFrame:
    """Rows that survive. Neighbours of a shot with cos >= threshold and the same black flag form runs; of a run one
    survives (of those with a face, if any, the one nearest the others, to nine digits, the first of equal ones); rounds go on until nothing goes.

    Each round is a written table.
    """
    rows = written(df.select(*key, order, shot, vector, black, face), "dedup")
    n = rows.count()
    for _ in range(most_rounds):
        w = Window.partitionBy(*key).orderBy(order)
        before = lambda c: F.lag(c).over(w)
        tied = (before(shot) == F.col(shot)) & (before(black) == F.col(black)) & (cosine(before(vector), F.col(vector)) >= threshold)
        run = rows.withColumn("_new", F.when(F.coalesce(tied, F.lit(False)), 0).otherwise(1)).withColumn("_run", F.sum("_new").over(w))
        inside = Window.partitionBy(*key, "_run")
        pool = run.withColumn("_any", F.max(F.col(face).cast("int")).over(inside)).withColumn("_in", (F.col("_any") == 0) | F.col(face))
        means = mean_similarity(pool.filter("_in"), [*key, "_run"], order, vector, "_mean")
        best = means.groupBy(*key, "_run").agg(F.max_by(order, F.struct(F.round(F.coalesce("_mean", F.lit(0.0)), 9), -F.col(order))).alias("_best"))
        rows = written(run.join(best, [*key, "_run"]).filter(F.col(order) == F.col("_best")).select(*rows.columns), "dedup")
        left = rows.count()
        if left == n:
            return rows
        n = left
    raise RuntimeError(f"dedup didn't settle in {most_rounds} rounds")


def chain_closeness(df: DataFrame, key: list[str], order: str, vector: str, threshold: float = 0.95) -> DataFrame:
    """Adds cos_to_mean and close (cos to the normalised mean of the key over the threshold)."""
    means = centroid(df, key, vector, "_mean", eps=1e-10)
    near = df.join(means, key)
    cos = dot(F.transform(F.col(vector), lambda x: x.cast("double")), F.col("_mean")) / (norm(F.col(vector)) + 1e-10)
    return near.withColumn("cos_to_mean", cos).withColumn("close", F.col("cos_to_mean") > threshold).drop("_mean")
