"""Centroid clustering beside plain distances in Python's integers."""

import math
from hashlib import sha256

import numpy as np
import pytest

from sceneloom.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, cluster string, v int"


def plain(rows, k, dims, rounds, scale):
    """vec_id, cluster, distance, inertia of the cluster and of all, hash of the centroid: every distance, every round."""
    kept = []
    for i, x, *_ in rows:
        if x is not None and len(x) == dims and all(c is not None and math.isfinite(c) for c in x):
            kept.append((i, [max(-(1 << 27), min(1 << 27, math.floor(scale * c))) for c in x]))
    named = lambda i: sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    at = [v for _, v in sorted(kept, key=lambda r: (named(r[0]), r[1]))[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    own = []
    for n in range(rounds + 1):
        own = [min(range(len(at)), key=lambda c: (far(v, at[c]), c)) for _, v in kept]
        if n < rounds:
            for c in range(len(at)):
                if some := [v for (_, v), o in zip(kept, own, strict=True) if o == c]:
                    at[c] = [sum(x) // len(some) for x in zip(*some, strict=True)]
    d = [far(v, at[o]) for (_, v), o in zip(kept, own, strict=True)]
    of = {c: sum(x for x, o in zip(d, own, strict=True) if o == c) for c in range(len(at))}
    return sorted(((i, o, x, of[o], sum(d), sha256(",".join(map(str, at[o])).encode()).hexdigest()) for (i, _), o, x in zip(kept, own, d, strict=True)), key=str)


def result(spark, rows, **how):
    out = centroids.cluster(spark.createDataFrame(rows, SCHEMA), **how)
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_odd_rows(spark):
    """Nulls, NaN, infinite, short and long vectors go; null ids, repeated rows and huge components stay."""
    rows = [(i, [float(i % 3), -float(i % 2)], "c", 1) for i in range(20)] + [(1, [1.0, -1.0], "c", 1)] * 3
    rows += [(50, None, "c", 1), (51, [1.0], "c", 1), (52, [1.0, 2.0, 3.0], "c", 1), (53, [1.0, None], "c", 1), (54, [math.nan, 0.0], "c", 1), (55, [0.0, math.inf], "c", 1)]
    rows += [(None, [0.5, 0.25], None, None), (56, [1e300, -1e300], "c", 1), (57, [], "c", 1)]
    assert result(spark, rows, clusters=4, dimensions=2) == plain(rows, 4, 2, 3, 64.0)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(7, [0.5, 0.5], "c", 1), (7, [0.5, 0.5], "c", 1)]
    assert result(spark, rows, clusters=5, dimensions=2) == plain(rows, 5, 2, 3, 64.0)
    assert result(spark, [(1, None, "c", 1)], dimensions=2) == []
    assert result(spark, [], dimensions=2) == []
    with pytest.raises(ValueError):
        result(spark, rows, clusters=0)


@pytest.mark.parametrize("spread,scale", [(0.02, 64.0), (1.0, 64.0), (3.0, 1.0), (1e5, 64.0)])
def test_ties_and_sizes(spark, spread, scale):
    """Small integers tie all the time; large ones leave the range in which doubles are exact."""
    draws = np.random.RandomState(3)
    rows = [(i, (draws.randn(8) * spread).tolist(), "c", 1) for i in range(400)]
    assert result(spark, rows, clusters=9, dimensions=8, rounds=4, scale=scale) == plain(rows, 9, 8, 4, scale)


def test_bounds_hold_and_skip():
    """After every round bounds are on the safe side, and most centroids aren't looked at."""
    draws = np.random.RandomState(1)
    means = draws.randint(-300, 300, (12, 6))
    x = (means[draws.randint(0, 12, 3000)] + draws.randint(-9, 9, (3000, 6))).astype(np.int32)
    at = x[:12].astype(np.int64)
    looked = 0

    class Counting(centroids.Centroids):
        def squares(self, rows, j):
            nonlocal looked
            looked += len(rows)
            return super().squares(rows, j)

    own, upper, lower = centroids.first_assignment(x, Counting(at))
    for _ in range(4):
        true = np.sqrt(((x[:, None, :].astype(np.int64) - at[None]) ** 2).sum(2).astype(np.float64))
        assert (own == true.argmin(1)).all()
        assert (upper >= true[np.arange(len(x)), own]).all() and (lower <= true).all()
        before = at
        at = np.array([x[own == c].astype(np.int64).sum(0) // max(1, (own == c).sum()) if (own == c).any() else at[c] for c in range(12)])
        own, upper, lower = centroids.next_assignment(x, own, upper, lower, Counting(at, before))
    assert looked < 0.6 * 5 * 12 * len(x)
