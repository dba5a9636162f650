import math
import random

import numpy as np
from pyspark.sql import functions as F

from sceneloom.operators import graph, interval, relational, sequence, vector


def test_onion(spark):
    df = spark.createDataFrame([(1, "p1", 0, 9), (1, "p2", 4, 12)], "v int, p string, start int, end int")
    cuts = interval.onion_cuts(df, ["v"], "p")
    assert sorted(r.cut for r in cuts.collect()) == [0, 4, 13]
    segs = interval.segments_between(cuts, spark.createDataFrame([(1, 20)], "v int, total int"), ["v"]).orderBy("seg").collect()
    assert [(r.start, r.end) for r in segs] == [(0, 3), (4, 12), (13, 19)]


def test_onion_against_the_deletion_loop(spark):
    r = random.Random(4)
    rows = []
    for v in range(60):
        for p in range(r.randint(1, 6)):
            at = 0
            for _ in range(r.randint(1, 3)):
                s = at + r.randint(1, 8)
                e = s + r.randint(0, 9)
                rows.append((v, p, s, e))
                at = e + 1
    got = {}
    for x in interval.onion_cuts(spark.createDataFrame(rows, "v int, p int, start int, end int"), ["v"], "p").collect():
        got.setdefault(x.v, set()).add(x.cut)
    for v in range(60):
        own = [x[1:] for x in rows if x[0] == v]
        total = {p: sum(e - s + 1 for q, s, e in own if q == p) for p, _, _ in own}
        makers = {}
        for p, s, e in own:
            makers.setdefault(s, set()).add(p)
            makers.setdefault(e + 1, set()).add(p)
        alive = dict(makers)
        for p in sorted(total, key=lambda q: total[q]):
            for q, s, e in own:
                if q == p:
                    for c in [c for c in alive if s < c <= e and any(total[m] > total[p] for m in alive[c])]:
                        del alive[c]
        assert got[v] == set(alive)


def test_nearest(spark):
    pts = spark.createDataFrame([(1, i, t) for i, t in enumerate([120, 180, 150, 50, 900])], "v int, id int, t int")
    shots = spark.createDataFrame([(1, 0, 0, 100), (1, 1, 200, 300)], "v int, shot int, s int, e int")
    got = interval.nearest_interval(pts, shots, ["v"], "id", "t", "s", "e", "shot").orderBy("id").collect()
    assert [r.shot for r in got] == [0, 1, 0, 0, 1]


def test_as_of(spark):
    pts = spark.createDataFrame([(1, f) for f in (5, 10, 15, 30)], "v int, f int")
    ev = spark.createDataFrame([(1, 10, "a"), (1, 20, "b")], "v int, at int, d string")
    assert [r.value for r in interval.as_of(pts, ev, ["v"], "f", "at", "d").orderBy("f").collect()] == [None, None, "a", "b"]
    assert [r.value for r in interval.as_of(pts, ev, ["v"], "f", "at", "d", strict=False).orderBy("f").collect()] == [None, "a", "a", "b"]
    assert [r.value for r in interval.as_of(pts, ev, ["v"], "f", "at", "d", forward=True).orderBy("f").collect()] == ["a", "b", "b", None]


def test_overlaps_at_any_bucket_width(spark):
    r = random.Random(5)
    a = [(1, i, s, s + r.randint(0, 40)) for i, s in enumerate(r.randint(0, 300) for _ in range(60))]
    b = [(1, i, s, s + r.randint(0, 40)) for i, s in enumerate(r.randint(0, 300) for _ in range(60))]
    want = {(i, j) for _, i, s, e in a for _, j, t, u in b if s <= u and t <= e}
    da, db = spark.createDataFrame(a, "v int, i int, s int, e int"), spark.createDataFrame(b, "v int, j int, t int, u int")
    for width in (1, 7, 1000):
        got = [(x.i, x.j) for x in interval.overlapping(da, db, ["v"], ("s", "e"), ("t", "u"), width).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_cosine_pairs_in_any_blocks(spark):
    r = random.Random(6)
    rows = [(i, [r.gauss(0, 1) for _ in range(6)], i % 3) for i in range(70)]
    df = spark.createDataFrame(rows, "id long, v array<double>, g int")

    def cos(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))

    want = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and cos(a[1], b[1]) >= 0.5}
    for block in (1024, 16):
        assert {(x.src, x.dst) for x in vector.cosine_pairs(df, "id", "v", 0.5, block=block).collect()} == want
    assert vector.cosine_pairs(df.limit(0), "id", "v", 0.5).count() == 0
    apart = {(x.src, x.dst) for x in vector.cosine_pairs(df, "id", "v", 0.5, ["g"]).collect()}
    assert apart == {(a, b) for a, b in want if a % 3 != b % 3}


def test_far_cells_do_not_meet(spark):
    r = np.random.RandomState(1)
    centres = np.linalg.qr(r.normal(size=(12, 12)))[0]
    x = np.concatenate([centres[i % 12] + r.normal(0, 0.05, (1, 12)) for i in range(240)] + [np.zeros((1, 12))])
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    want = {(i, j) for i in range(241) for j in range(i + 1, 241) if unit[i] @ unit[j] >= 0.9}
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    assert {(p.src, p.dst) for p in vector.cosine_pairs(df, "id", "v", 0.9, block=20).collect()} == want
    pivots = unit[:36]
    cell = (unit[:240] @ pivots.T).argmax(1)
    angles = np.arccos(np.clip((unit[:240] * pivots[cell]).sum(1), -1, 1))
    radii = np.array([angles[cell == c].max(initial=0.0) for c in range(36)])
    near = vector.near_cells(pivots, radii, 0.9)
    assert near.mean() < 0.3 and all(near[cell[i], cell[j]] for i, j in want if j < 240)


def test_work_on_clustered_and_isotropic_vectors(spark):
    """Equal pairs in both; cells spare clustered vectors nearly all work, and bounds on a part of the dimensions spare it where
    cells can't but the vectors vary mostly along a few. A stray vector and one of length 0 don't widen a cell."""
    r = np.random.RandomState(4)
    n, d = 600, 40
    centres = np.linalg.qr(r.normal(size=(d, d)))[0]
    kinds = {
        "clustered": np.array([centres[i % 20] + r.normal(0, 0.02, d) for i in range(n)]),
        "isotropic": r.normal(size=(n, d)),
        "skewed": r.normal(size=(n, d)) @ (np.diag(np.r_[np.ones(6), np.full(d - 6, 0.05)]) @ np.linalg.qr(r.normal(size=(d, d)))[0]),
    }
    share = {}
    for kind, x in kinds.items():
        x[5], x[6] = r.normal(size=d), 0.0
        unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        i, j = np.nonzero(np.triu(unit @ unit.T >= 0.8, 1))
        df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "id long, v array<double>")
        assert {(p.src, p.dst) for p in vector.cosine_pairs(df, "id", "v", 0.8, block=30).collect()} == set(zip(i.tolist(), j.tolist(), strict=True)), kind
        w = vector.cosine_work(df, "id", "v", 0.8, block=30).first()
        share[kind] = (w.met / (n * n / 2), w.multiplied / max(1, w.met))
    assert share["clustered"][0] < 0.35
    assert share["isotropic"][0] > 0.9
    assert share["skewed"][1] < 0.9
    got = vector.cosine_pairs(spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0])], "id long, v array<double>"), "id", "v", 0.0)
    assert {(p.src, p.dst) for p in got.collect()} == {(1, 2), (1, 3), (2, 3)}


def isotropic(spark, n, width, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width))
    x[n // 2 : n // 2 + 40] = x[0] + rng.normal(size=(40, width)) * 0.01
    x /= np.linalg.norm(x, axis=1)[:, None]
    return x, spark.createDataFrame([(i, i % 3, v.tolist()) for i, v in enumerate(x)], "id long, l int, v array<float>")


def test_cosine_pairs_copy_vectors_to_few_blocks(spark):
    """Vectors without clusters meet all others, but in blocks that grow with them; no pair is lost."""
    x, df = isotropic(spark, 3000, 8, 3)
    met, _ = vector._meeting(df, "id", "v", 0.8, [], 30)
    assert met.count() <= 1.5 * vector.SIDES * len(x)
    x = x.astype(np.float32).astype(np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    cos = x @ x.T
    for apart in ([], ["l"]):
        got = {(r.src, r.dst): r.cos for r in vector.cosine_pairs(df, "id", "v", 0.8, apart, 30).collect()}
        want = {(i, j) for i, j in zip(*np.nonzero(np.triu(cos >= 0.8, 1)), strict=True) if not apart or i % 3 != j % 3}
        assert set(got) == want and all(abs(got[i, j] - cos[i, j]) < 1e-12 for i, j in want)


def test_cosine_forest(spark, monkeypatch):
    """Its edges are fewer than the pairs, yet have their spanning forest."""
    x, df = isotropic(spark, 1500, 8, 4)
    monkeypatch.setattr(vector, "MOST_PAIRS", 500)
    some = vector.cosine_forest(df, "id", "v", 0.6, ["l"], 30)
    pairs = vector.cosine_pairs(df, "id", "v", 0.6, ["l"], 30)
    assert some.count() < min(pairs.count(), 1.5 * vector.SIDES * len(x))
    assert sorted(graph.spanning_forest(some).collect()) == sorted(graph.spanning_forest(pairs).collect())
    assert sorted(graph.connected_components(some).collect()) == sorted(graph.connected_components(pairs).collect())


def test_cosine_components_of_vectors_without_clusters(spark, monkeypatch):
    """Those that the first blocks link needn't meet again; what they leave out meets all, and no component is missed."""
    x, df = isotropic(spark, 3000, 8, 5)
    pairs = vector.cosine_pairs(df, "id", "v", 0.8, block=30).cache()
    monkeypatch.setattr(vector, "HOME", 8 * 300)
    met, kept = [], vector._joined
    monkeypatch.setattr(vector, "_joined", lambda df, *rest: met.append(df.count()) or kept(df, *rest))
    for threshold, few in ((0.8, True), (0.97, False)):
        met.clear()
        got = sorted(vector.cosine_components(df, "id", "v", threshold, 30).collect())
        assert got == sorted(graph.connected_components(pairs.filter(f"cos >= {threshold}")).collect())
        assert not few or (len(met) == 2 and sum(met) < 6 * len(x))
    assert 10 < len({r.component for r in got})
    pairs.unpersist()
    near = spark.createDataFrame([(i, [1.0, i / 100]) for i in range(5)] + [(9, [-1.0, 0.0])], "id long, v array<double>")
    assert sorted(vector.cosine_components(near, "id", "v", 0.8).collect()) == [(i, 0) for i in range(5)]
    assert vector.cosine_components(near.limit(0), "id", "v", 0.8).count() == 0


def test_representatives_gather_no_cluster(spark):
    """Pools of good faces, of good frames without faces, of bad faces and of bad frames; unknown flags are bad and no face."""
    rows = [(1, 1, [1.0, 0.0], True, True), (1, 2, [0.0, 1.0], False, True), (1, 3, [1.0, 0.1], False, False), (2, 4, [1.0, 0.0], None, True), (2, 5, [0.0, 1.0], False, None)]
    rows += [(3, 6, [1.0, 0.0], True, False), (3, 7, [0.0, 1.0], True, True), (4, 8, [1.0, 0.0], True, False), (4, 9, [1.0, 0.0], None, None), (None, 10, [1.0, 0.0], False, True)]
    df = spark.createDataFrame(rows, "c long, i long, v array<double>, bad boolean, face boolean")
    got = vector.representatives(df, "c", "i", "v", F.col("bad"), F.col("face"))
    assert {(r.c, r.representative) for r in got.collect()} == {(1, 2), (2, 5), (3, 7), (4, 8)}
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_components_clusters_whispers(spark):
    edges = spark.createDataFrame([(0, 3, 0.95), (1, 2, 0.9), (2, 4, 0.92)], "src long, dst long, cos double")
    named = graph.named_clusters(graph.connected_components(edges)).collect()
    assert {(r.id, r.cluster) for r in named} == {(1, "c001"), (2, "c001"), (4, "c001"), (0, "c002"), (3, "c002")}
    comp = {r.id: r.component for r in graph.connected_components(edges).collect()}
    for r in graph.whispers(edges).collect():
        assert comp[r.label] == comp[r.id]
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)], "src long, dst long")
    assert {r.component for r in graph.connected_components(chain).collect()} == {0}
    alone = graph.persons(spark.createDataFrame([(5,)], "id long"), edges).collect()
    assert [r.person for r in alone] == [None]


def dedup_step_by_step(rows, thr):
    def cos(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))

    rows = sorted(rows)
    while True:
        out, i, gone = [], 0, False
        while i < len(rows):
            j = i
            while j + 1 < len(rows) and rows[j][1] == rows[j + 1][1] and rows[j][3] == rows[j + 1][3] and cos(rows[j][2], rows[j + 1][2]) >= thr:
                j += 1
            run = rows[i : j + 1]
            pool = [r for r in run if r[4]] or run
            mean = lambda r: sum(cos(r[2], o[2]) for o in pool if o is not r) / max(1, len(pool) - 1)  # noqa: B023, E731
            out.append(max(pool, key=lambda r: (round(mean(r), 12), -r[0])))
            gone |= len(run) > 1
            i = j + 1
        rows = out
        if not gone:
            return [r[0] for r in rows]


def test_neighbour_dedup(spark):
    r = random.Random(7)
    rows = [(f, f // 12, [r.gauss(1, 0.6) for _ in range(4)], r.random() < 0.1, r.random() < 0.4) for f in range(80)]
    df = spark.createDataFrame([(1, *x) for x in rows], "v int, f int, shot int, e array<double>, black boolean, face boolean")
    once = vector.neighbour_dedup(df, ["v"], "f", "shot", "e", "black", "face", 0.75)
    assert sorted(x.f for x in once.collect()) == dedup_step_by_step(rows, 0.75)
    again = vector.neighbour_dedup(once, ["v"], "f", "shot", "e", "black", "face", 0.75)
    assert again.count() == once.count()


def test_scenes(spark):
    left = spark.createDataFrame([(1, f, s) for f, s in [(0, 0), (2, 0), (5, 0), (6, 0), (9, 1), (12, 1)]], "v int, f int, shot int")
    black = spark.createDataFrame([(1, 3, 4), (1, 12, 13), (1, 40, 41)], "v int, start int, end int")
    shots = spark.createDataFrame([(1, 0, 0, 7), (1, 1, 8, 12), (1, 2, 13, 20)], "v int, shot int, start int, end int")
    got = relational.scenes(left, black, shots, ["v"], "f", "shot").orderBy("scene").collect()
    assert [(r.start, r.end, r.n_shots, r.key_frame, r.frames, r.black) for r in got] == [
        (0, 7, 1, 0, [0, 2], False), (3, 4, 1, 3, [], True), (0, 7, 1, 5, [5, 6], False), (8, 12, 1, 9, [9], False), (12, 13, 2, 12, [12], True)
    ]


def test_ranked(spark):
    rows = [(i * 7 % 101, i) for i in range(300)]
    got = {(r.a, r.b): r["rank"] for r in relational.ranked(spark.createDataFrame(rows, "a int, b int"), [F.col("a").desc(), F.col("b")]).collect()}
    assert got == {x: k + 1 for k, x in enumerate(sorted(rows, key=lambda x: (-x[0], x[1])))}


def whisper_step_by_step(edges):
    """The moves of each turn one after the other, each seeing those before it."""
    import struct

    import xxhash

    near = {}
    for a, b, w in edges:
        near.setdefault(a, {})[b] = near.setdefault(b, {})[a] = round(w * 1e9)
    labels = {i: i for i in near}

    def best(i):
        votes = {}
        for j, w in near[i].items():
            votes[labels[j]] = votes.get(labels[j], 0) + w
        return min(votes, key=lambda x: (-votes[x], x))

    def drew(i, turn):  # Spark's xxhash64 of two longs
        h = xxhash.xxh64_intdigest(struct.pack("<q", i), 42)
        h = xxhash.xxh64_intdigest(struct.pack("<q", turn), h)
        return (h - (1 << 64) if h >> 63 else h), i

    for turn in range(1000):
        changed = {i: drew(i, turn) for i in near if best(i) != labels[i]}
        if not changed:
            break
        for i in sorted(changed, key=changed.get, reverse=True):
            if all(changed[i] > changed[j] for j in near[i] if j in changed):
                labels[i] = best(i)
    least = {}
    for i, x in labels.items():
        least[x] = min(i, least.get(x, i))
    return {i: least[x] for i, x in labels.items()}


def test_whispers_settle(spark):
    """Pairs, paths, stars and cliques end in one label whatever their ids; 1,000 random graphs as the moves one by one."""
    r, edges, whole = random.Random(2), [], []
    for step in (1, 2, 128, 40503, 1 << 20):
        base = step * 100_000_000
        shapes = [[(0, 1)], [(i, i + 1) for i in range(20)], [(0, i) for i in range(1, 12)], [(a, b) for a in range(7) for b in range(a + 1, 7)], [(0, 1), (1, 2)]]
        for k, shape in enumerate(shapes):
            at = base + k * step * 1000
            edges += [(at + a * step, at + b * step, 0.5) for a, b in shape]
            whole.append({at + x * step for e in shape for x in e})
    for k in range(1000):
        at, n = -(k + 1) * 100_000, r.randint(2, 9)
        edges += [(at + a * 128, at + b * 128, r.choice([0.4, 0.5, 0.61])) for a in range(n) for b in range(a + 1, n) if r.random() < 0.45]
    got = {x.id: x.label for x in graph.whispers(spark.createDataFrame(edges, "src long, dst long, cos double")).collect()}
    assert got == whisper_step_by_step(edges)
    for ids in whole:
        assert {got[i] for i in ids} == {min(ids)}
    persons = graph.numbered_persons(spark.createDataFrame([(i,) for i in (7, 8, 9)], "id long"), spark.createDataFrame([(8, 8), (9, 8)], "id long, label long")).collect()
    assert {r.id: r.person for r in persons} == {7: 0, 8: 1, 9: 1}


def test_whispers_of_a_large_clique(spark):
    """A clique of 80 would take 80 turns, were only one of its ids to move at once; labels joined by a shuffle end the same."""
    edges = spark.createDataFrame([(a, b, 0.97 + (a * b % 17) / 1000) for a in range(80) for b in range(a + 1, 80)], "src long, dst long, cos double")
    assert {x.label for x in graph.whispers(edges, most_turns=40).collect()} == {0}


def whisper_jointly(edges):
    """Each turn's moves that no neighbour ahead can turn, one after the other; and the turns."""
    import struct

    import xxhash

    near = {}
    for a, b, w in edges:
        near.setdefault(a, {})[b] = near.setdefault(b, {})[a] = round(w * 1e9)
    labels = {i: i for i in near}

    def best(i):
        votes = {}
        for j, w in near[i].items():
            votes[labels[j]] = votes.get(labels[j], 0) + w
        return min(votes, key=lambda x: (-votes[x], x))

    def drew(i, turn):  # Spark's xxhash64 of two longs
        h = xxhash.xxh64_intdigest(struct.pack("<q", i), 42)
        h = xxhash.xxh64_intdigest(struct.pack("<q", turn), h)
        return (h - (1 << 64) if h >> 63 else h), i

    for turn in range(1000):
        would = {i: best(i) for i in near}
        changed = {i: drew(i, turn) for i in near if would[i] != labels[i]}
        if not changed:
            break
        moves = []
        for i in changed:
            most, least = {}, {}
            for j, w in near[i].items():
                ahead = j in changed and changed[j] > changed[i]
                for x in (labels[j], would[j]) if ahead else (labels[j],):
                    most[x] = most.get(x, 0) + (w + 1 if ahead else w)
                    least[x] = least.get(x, 0) + (0 if ahead else w)
            if all((most[x], -x) < (least[would[i]], -would[i]) for x in most if x != would[i]):
                moves.append(i)
        for i in sorted(moves, key=changed.get, reverse=True):
            assert best(i) == would[i]
            labels[i] = would[i]
    least = {}
    for i, x in labels.items():
        least[x] = min(i, least.get(x, i))
    return {i: least[x] for i, x in labels.items()}, turn


def test_whispers_with_many_neighbours(spark, monkeypatch):
    """Where ids have many neighbours, most move in each turn, each as if one after the other; broadcast or not, as longs or as
    structs."""
    r = random.Random(11)
    edges = [(a * 3, b * 3, 0.9 + r.random() / 10 if a // 10 == b // 10 else 0.35 + r.random() / 10) for a in range(600) for b in range(a + 1, 600) if a // 10 == b // 10 or r.random() < 0.1]
    expected, turns = whisper_jointly(edges)
    assert turns < 20 and 1 < len(set(expected.values())) < 600
    df = spark.createDataFrame(edges, "src long, dst long, cos double")
    assert {x.id: x.label for x in graph.whispers(df, most_turns=20).collect()} == expected
    monkeypatch.setattr(graph, "FEW", 10)
    assert {x.id: x.label for x in graph.whispers(df, most_turns=20).collect()} == expected
    apart = df.select(F.struct(F.lit(0.5).alias("t"), "src").alias("src"), F.struct(F.lit(0.5).alias("t"), F.col("dst").alias("src")).alias("dst"), "cos")
    got = {x.id.src: x.label.src for x in graph.whispers(apart, most_turns=30).collect()}
    near = {}
    for a, b, w in edges:
        near.setdefault(a, {})[b] = near.setdefault(b, {})[a] = round(w * 1e9)
    for i, others in near.items():  # no id would change
        votes = {}
        for j, w in others.items():
            votes[got[j]] = votes.get(got[j], 0) + w
        assert votes[got[i]] == max(votes.values())


def test_spanning_forest_and_sweep(spark):
    """The forest's weight is that of Kruskal's, and its components are those of all edges at every threshold."""
    r = random.Random(5)
    edges = [(a * 128, b * 128, r.choice([0.3, 0.4, 0.5, 0.6, 0.7])) for a in range(60) for b in range(a + 1, 60) if r.random() < 0.06] + [(0, 0, 0.9)]

    def components(some):
        root = {i * 128: i * 128 for i in range(70)}

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        total = 0.0
        for a, b, w in sorted(some, key=lambda e: (-e[2], e[0], e[1])):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
                total += w
        return {i: find(i) for i in root}, total

    df = spark.createDataFrame(edges, "src long, dst long, cos double")
    forest = [tuple(x) for x in graph.spanning_forest(df).collect()]
    assert round(sum(w for *_, w in forest), 6) == round(components(edges)[1], 6) and len(forest) == len(set(forest))
    ids = spark.createDataFrame([(i * 128,) for i in range(70)], "id long")
    thresholds = [0.35, 0.5, 0.65, 0.8]
    got = {x.thr: (x.persons, x.sizes) for x in graph.threshold_sweep(ids, df, thresholds).collect()}
    for t in thresholds:
        of = list(components([e for e in edges if e[2] >= t])[0].values())
        sizes = sorted((of.count(c) for c in set(of)), reverse=True)
        assert got[t] == (len(sizes), sizes[:6])
    by_whispers = {x.thr: x.persons for x in graph.threshold_sweep(ids, df, thresholds, "whispers").collect()}
    assert all(by_whispers[t] >= got[t][0] for t in thresholds) and by_whispers[0.8] == 70


def test_main_subject(spark):
    df = spark.createDataFrame([(1, i, float(h)) for i, h in enumerate([100, 110, 400, 420])] + [(2, 0, 10.0), (2, 1, 99.0)], "f int, b int, h double")
    got = relational.main_subject(df, ["f"], "b", "h").collect()
    assert sorted((r.f, r.h) for r in got) == [(1, 400.0), (1, 420.0), (2, 10.0), (2, 99.0)]


def test_lookups_fail_on_missing_rows(spark):
    import pytest

    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "x")], "k int, v string")
    with pytest.raises(Exception, match="no row for"):
        relational.lookup(a, b, ["k"], "v").collect()
    with pytest.raises(Exception, match="exactly one"):
        relational.exactly_one(a, b, ["k"], ["k"]).collect()


def test_same_results_with_one_partition_or_eight(spark):
    r = random.Random(8)
    df = spark.createDataFrame([(r.randint(0, 5), i, r.random() * 50) for i in range(400)], "v int, f int, x double")
    rows = df.withColumn("f", F.row_number().over(__import__("pyspark.sql", fromlist=["Window"]).Window.partitionBy("v").orderBy("f")))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    out = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        out.append(sorted(sequence.stable_regions(rows, ["v"], "f", "x", 3).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", old)
    assert out[0] == out[1]
