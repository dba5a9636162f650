"""Centroid clustering with Elkan's bounds, in exact integers.

Vectors are turned into integers, floor(scale * x) of each component. Each vector carries an upper bound of the distance to
its centroid and a lower bound of that to every centroid; they are widened by how far the centroids moved, rounded away from
the truth, and kept in a written table from round to round. A centroid is looked at only if neither its lower bound nor half
its distance to the vector's centroid says that it is strictly farther, so that ties are never pruned; what is looked at is
compared in exact squared distances, ties to the smaller number. Sums, means and final distances are exact.

A vector is kept if it has exactly `dimensions` components, none null or not finite. Components beyond 2^27 (of either sign)
count as 2^27, so that squared distances fit into a long. The first centroids are the kept rows with the smallest hashes of
their id (a null id counts as the empty text), equal hashes by the vector; if fewer rows are kept than centroids are asked
for, all are. Repeated rows count each for itself, and two of them may start two centroids, of which the second stays empty.
A table without a kept vector gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: The largest integer a component may be, and that up to which doubles work out all sums of 64 products exactly.
MOST, EXACT = 1 << 27, 1 << 22
#: Vectors of a step in Python, and centroids and dimensions at most (their table is sent to every task).
STEP, MOST_CENTROIDS, MOST_DIMENSIONS = 4096, 1024, 4096


def _below(x: np.ndarray) -> np.ndarray:
    """Lower bounds as 32-bit floats: the next one below, not under 0."""
    return np.maximum(np.nextafter(np.asarray(x, np.float64).astype(np.float32), np.float32(-np.inf)), np.float32(0))


def _above(x: np.ndarray) -> np.ndarray:
    return np.nextafter(np.asarray(x, np.float64).astype(np.float32), np.float32(np.inf))


class Centroids:
    """Integer centroids, their distances from each other, and how far each moved since the round before."""

    def __init__(self, at: np.ndarray, before: np.ndarray | None = None, exact_doubles: bool = True):
        self.at = at.astype(np.int64)
        self.kind = np.float64 if exact_doubles else np.int64
        gaps = self.at[:, None, :] - self.at[None, :, :]
        self.half = _below(np.sqrt((gaps * gaps).sum(2).astype(np.float64)) * (0.5 - 1e-12))
        nearest = self.half + np.where(np.eye(len(at), dtype=bool), np.float32(np.inf), np.float32(0))
        self.nearest = nearest.min(1) if len(at) > 1 else np.full(len(at), np.float32(np.inf))
        moved = self.at - (self.at if before is None else before)
        self.moved = _above(np.sqrt((moved * moved).sum(1).astype(np.float64)) * (1 + 1e-12))

    def squares(self, x: np.ndarray, j: int | np.ndarray) -> np.ndarray:
        """Exact squared distances of rows to centroid j (one for all, or one for each row)."""
        d = x.astype(self.kind) - self.at[j].astype(self.kind)
        return np.einsum("ij,ij->i", d, d).astype(np.int64)


def first_assignment(x: np.ndarray, c: Centroids) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cluster, upper bound and lower bounds of rows of which nothing is known."""
    n, k = len(x), len(c.at)
    own, lower = np.zeros(n, np.int32), np.zeros((n, k), np.float32)
    best = c.squares(x, 0)
    upper = _above(np.sqrt(best))
    lower[:, 0] = _below(np.sqrt(best))
    for j in range(1, k):
        look = np.flatnonzero(upper >= c.half[own, j])  # else centroid j is strictly farther than the row's own
        if not len(look):
            continue
        squares = c.squares(x[look], j)
        lower[look, j] = _below(np.sqrt(squares))
        nearer = squares < best[look]  # ties stay with the smaller number
        rows = look[nearer]
        own[rows], best[rows], upper[rows] = j, squares[nearer], _above(np.sqrt(squares[nearer]))
    return own, upper, lower


def next_assignment(x: np.ndarray, own: np.ndarray, upper: np.ndarray, lower: np.ndarray, c: Centroids) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same after the centroids have moved."""
    own = own.copy()
    upper = _above(upper.astype(np.float64) + c.moved[own])
    lower = _below(lower.astype(np.float64) - c.moved[None, :])
    open_ = np.flatnonzero(upper >= c.nearest[own])  # the others' centroid is strictly the nearest
    if not len(open_):
        return own, upper, lower
    best = np.full(len(x), -1, np.int64)  # exact squares of rows, once they are worked out
    for j in range(len(c.at)):
        a, u = own[open_], upper[open_]
        look = open_[(a != j) & (u >= lower[open_, j]) & (u >= c.half[a, j])]
        if not len(look):
            continue
        fresh = look[best[look] < 0]
        if len(fresh):
            best[fresh] = c.squares(x[fresh], own[fresh])
            root = np.sqrt(best[fresh])
            upper[fresh], lower[fresh, own[fresh]] = _above(root), _below(root)
            look = look[(upper[look] >= lower[look, j]) & (upper[look] >= c.half[own[look], j])]
            if not len(look):
                continue
        squares = c.squares(x[look], j)
        lower[look, j] = _below(np.sqrt(squares))
        nearer = (squares < best[look]) | (squares == best[look]) & (j < own[look])
        rows = look[nearer]
        own[rows], best[rows], upper[rows] = j, squares[nearer], _above(np.sqrt(squares[nearer]))
    return own, upper, lower


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    """A list column without nulls as a matrix that may be written to."""
    return np.array(column.flatten().to_numpy(zero_copy_only=False), kind).reshape(len(column), width)


def kept_vectors(df: DataFrame, key: str, vector: str, dimensions: int, scale: float) -> DataFrame:
    """vec_id and v, the integers, of the rows that are kept."""
    x = F.transform(F.col(vector), lambda v: v.cast("double"))
    whole = (F.size(vector) == dimensions) & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    integer = lambda v: F.greatest(F.lit(float(-MOST)), F.least(F.lit(float(MOST)), F.floor(F.greatest(F.lit(-1e15), F.least(F.lit(1e15), v * F.lit(float(scale))))).cast("double"))).cast("int")
    return df.select(F.col(key).cast("long").alias("vec_id"), x.alias("x"), F.col(vector)).filter(F.col(vector).isNotNull() & whole).select("vec_id", F.transform("x", integer).alias("v"))


def means(assigned: DataFrame, dimensions: int, before: np.ndarray) -> np.ndarray:
    """Floor of the mean of each cluster's vectors; empty clusters stay. Rows for each cluster, whatever the table's size."""
    sums = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.sum(F.col("v")[i].cast("long")) for i in range(dimensions)]).alias("s"))
    out = before.copy()
    for r in sums.collect():
        out[r.cluster] = [s // r.n for s in r.s]
    return out


def cluster(df: DataFrame, key: str = "vec_id", vector: str = "embedding", clusters: int = 16, dimensions: int = 64, rounds: int = 3, scale: float = 64.0, seed: int = 1) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256 of every kept vector.

    `rounds` times vectors are assigned and centroids moved; then vectors are assigned once more. Each assignment is a pass
    that writes vectors with their bounds; nothing is shuffled but sums.
    """
    if not 1 <= clusters <= MOST_CENTROIDS or not 1 <= dimensions <= MOST_DIMENSIONS:
        raise ValueError(f"{clusters} centroids of {dimensions} dimensions")
    spark = df.sparkSession
    vectors = kept_vectors(df, key, vector, dimensions, scale)
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = np.array([r.v for r in vectors.select(named.alias("h"), "v").orderBy("h", "v").limit(clusters).collect()], np.int64).reshape(-1, dimensions)
    schema = "vec_id long, v array<int>, cluster int, upper float, lower array<float>"
    final = "vec_id long, cluster int, distance long"
    if not len(first):
        return spark.createDataFrame([], f"{final}, cluster_inertia long, inertia long, centroid_sha256 string")
    most = vectors.agg(F.max(F.greatest(F.array_max("v"), -F.array_min("v")))).first()[0]
    small = most * most * dimensions * 4 < 1 << 52 and most < EXACT

    def assign(at: np.ndarray, before: np.ndarray | None, last: bool):
        k = len(at)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            c = Centroids(at, before, small)
            for whole in batches:
                for lo in range(0, whole.num_rows, STEP):
                    b = whole.slice(lo, STEP)
                    x = _matrix(b.column(1), dimensions, np.int32)
                    if before is None:
                        own, upper, lower = first_assignment(x, c)
                    else:
                        own, upper, lower = next_assignment(x, b.column(2).to_numpy(), b.column(3).to_numpy(), _matrix(b.column(4), k, np.float32), c)
                    if last:
                        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(own), pa.array(c.squares(x, own))], names=["vec_id", "cluster", "distance"])
                        continue
                    ends = pa.array(np.arange(0, (len(x) + 1) * k, k, dtype=np.int32))
                    yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(own), pa.array(upper), pa.ListArray.from_arrays(ends, pa.array(lower.ravel()))], names=["vec_id", "v", "cluster", "upper", "lower"])

        return run

    at, before, state = first, None, vectors
    for _ in range(rounds):
        state = written(state.mapInArrow(assign(at, before, False), schema), "centroids")
        before, at = at, means(state, dimensions, at)
    out = written(state.mapInArrow(assign(at, before, True), final), "centroids")
    inertia = {r.cluster: r.s for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    longest, total = (1 << 63) - 1, sum(inertia.values())
    table = [(j, min(longest, int(inertia.get(j, 0))), min(longest, int(total)), sha256(",".join(map(str, at[j].tolist())).encode()).hexdigest()) for j in range(len(at))]
    found = spark.createDataFrame(table, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(found), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(clusters: int = 16, rounds: int = 3) -> str:
    """DuckDB SQL of the query: plain distances to all centroids in every round."""
    sql = f"""WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
x AS MATERIALIZED (SELECT r, unnest(range(64)) AS i, unnest(v) AS x FROM kept),
first AS (SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS INTEGER) AS c, v FROM kept ORDER BY sha256('1:' || vec_id), v LIMIT {clusters}),
c0 AS MATERIALIZED (SELECT c, unnest(range(64)) AS i, unnest(v) AS y FROM first)"""
    for n in range(rounds + 1):
        sql += f""",
d{n} AS (SELECT r, c, sum((x - y) * (x - y)) AS d FROM x JOIN c{n} USING (i) GROUP BY r, c),
a{n} AS MATERIALIZED (SELECT r, c, d FROM d{n} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)"""
        if n < rounds:
            sql += f""",
m{n} AS (SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM a{n} JOIN x USING (r) GROUP BY c, i),
c{n + 1} AS MATERIALIZED (SELECT c, i, CASE WHEN s IS NULL THEN y ELSE s // n - CASE WHEN s % n < 0 THEN 1 ELSE 0 END END AS y FROM c{n} LEFT JOIN m{n} USING (c, i))"""
    return (
        sql
        + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN (SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY c) USING (c)"""
    )
