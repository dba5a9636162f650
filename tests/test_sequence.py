"""Hand-worked cases and step-by-step specifications of the sequence kernels and folds."""

import random

from pyspark.sql import functions as F

from sceneloom.operators import folds, sequence


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_cut_scores(spark):
    df = frame(spark, [("a", i, float(v)) for i, v in enumerate([0, 2, 32, 63, 65])], "v string, f int, x double")
    got = sequence.cut_scores(df, ["v"], "f", "x").orderBy("f").collect()
    assert [r.mafd for r in got] == [0, 2, 30, 31, 2] and [r.score for r in got] == [0, 2, 28, 1, 2]
    assert [r.cut for r in sequence.cuts(sequence.cut_scores(df, ["v"], "f", "x"), "f").collect()] == [1]


def test_clean_cuts_against_the_greedy_form(spark):
    r = random.Random(1)
    rows = [(v, c, 100) for v in range(40) for c in {r.randint(0, 105) for _ in range(r.randint(0, 60))}]
    got = {}
    for x in sequence.clean_cuts(frame(spark, rows, "v int, c int, total int"), ["v"], "c", "total").collect():
        got.setdefault(x.v, []).append(x.c)
    for v in range(40):
        kept = []
        for c in sorted(c for w, c, _ in rows if w == v and 1 < c < 100):
            if not kept or c - kept[-1] >= 2:
                kept.append(c)
        assert sorted(got.get(v, [])) == kept


def shots_step_by_step(total, cuts, dark):
    """One frame after the other; a cut at c arrives with frame c + 1, a dark run when it is over."""
    out, start = [], 0
    events = sorted([(c + 1, 1, c) for c in cuts] + [(e + 1, 0, (s, e)) for s, e in dark], key=lambda x: x[:2])
    for _, kind, what in events:
        if kind == 1:
            if what > start:
                out.append((start, what - 1))
                start = what
        else:
            s, e = what
            if s > start:
                out.append((start, s - 1))
            out.append((max(s, start), e))
            start = e + 1
    if start < total:
        out.append((start, total - 1))
    return out


def test_shots(spark):
    cases = [(100, [30, 60], []), (100, [39, 59], [(40, 59)]), (50, [], [(0, 9)]), (50, [10, 20], [(12, 30)])]
    frames = frame(spark, [(i, t) for i, (t, _, _) in enumerate(cases)], "v int, total int")
    cuts = frame(spark, [(i, c) for i, (_, cs, _) in enumerate(cases) for c in cs], "v int, cut int")
    dark = frame(spark, [(i, s, e) for i, (_, _, d) in enumerate(cases) for s, e in d], "v int, start int, end int")
    got = {}
    for r in sequence.shots(frames, cuts, dark, ["v"]).orderBy("v", "shot").collect():
        got.setdefault(r.v, []).append((r.start, r.end))
    assert got[0] == [(0, 29), (30, 59), (60, 99)]
    assert got[1] == [(0, 38), (39, 39), (40, 59), (60, 99)]
    for i, c in enumerate(cases):
        assert got[i] == shots_step_by_step(*c), c


def test_squash_labels_absorb(spark):
    rows = [(1, i, s, t, i + 1) for i, (s, t) in enumerate([("A", "x"), ("A", "x"), ("A", "x"), ("B", "y"), ("B", "y")])]
    df = frame(spark, rows, "v int, o int, spk string, txt string, e int")
    got = sequence.squash_runs(df, ["v"], ["o"], ["txt", "spk"], "e").orderBy("o").collect()
    assert [(r.spk, r.txt, r.e) for r in got] == [("A", "x", 3), ("B", "y", 4), ("B", "y", 5)]
    who = frame(spark, [(1, i, s) for i, s in enumerate([7, -1, 3, 7])], "v int, o int, spk int")
    assert [r.label for r in sequence.first_appearance_labels(who, ["v"], "o", "spk", -1).orderBy("o").collect()] == ["A", "?", "B", "A"]
    said = frame(spark, [(1, i, s, t, i) for i, (s, t) in enumerate([("A", "hello"), ("A", "ah"), ("A", "yes!"), ("B", "ok")])], "v int, o int, spk string, txt string, e int")
    assert [r.txt for r in sequence.absorb_short(said, ["v"], "o", ["spk"], "txt", "e").orderBy("o").collect()] == ["helloah", "yes!", "ok"]


def test_chunks_and_interpolation(spark):
    df = frame(spark, [(0, 200_000)], "s long, e long")
    assert [(r.chunk_start, r.chunk_end) for r in sequence.chunked(df, "s", "e", 90_000).orderBy("chunk").collect()] == [(0, 90_000), (90_000, 180_000), (180_000, 200_000)]
    parts = frame(spark, [(1000, 2000, ["abc", "defghij"])], "s long, e long, p array<string>")
    assert [(r.part_start, r.part_end) for r in sequence.interpolated(parts, "s", "e", "p").orderBy("part").collect()] == [(1000, 1300), (1300, 2000)]


def test_intervals_batches_chapters(spark):
    df = frame(spark, [(1, s) for s in (11, 1, 2, 6, 6)], "p int, s int")
    assert [(r.start, r.end) for r in sequence.intervals_of(df, ["p"], "s").orderBy("start").collect()] == [(1, 6), (11, 11)]
    flags = [1, 1, 0, 0, 0, 0, 0, 0, None, 0]
    rows = frame(spark, [(1, i, f == 1, f is None) for i, f in enumerate(flags)], "v int, o int, a boolean, black boolean")
    sizes = sequence.batches(rows, ["v"], "o", "a", F.col("black")).groupBy("batch").count().orderBy("batch").collect()
    assert [r["count"] for r in sizes] == [2, 5, 1, 1]
    marks = frame(spark, [(1, b, 30) for b in (3, 10, 12, 20)], "v int, b int, n int")
    merged = sequence.merge_small_chapters(sequence.chapters(marks, ["v"], "b", "n"), ["v"]).orderBy("chapter").collect()
    assert [(r.start, r.end) for r in merged] == [(0, 2), (3, 11), (12, 19), (20, 29)]


def test_unique_shots(spark):
    cases = {1: [True, True, True], 2: [True, False, True], 3: [False], 4: [True, True, False, False, True]}
    rows = frame(spark, [(k, i, c) for k, cs in cases.items() for i, c in enumerate(cs)], "p int, o int, close boolean")
    got = {r.p: (r.raw, r.uniq, r.kind) for r in sequence.unique_shots(rows, ["p"], "o", "close").collect()}
    assert got == {1: (3, 1, "merged"), 2: (3, 3, "valid"), 3: (1, 1, "short"), 4: (5, 4, "valid")}


def test_coalesce_and_pack_against_loops(spark):
    seg = frame(spark, [(1, i, 7, a, b) for i, (a, b) in enumerate([(0, 2000), (2100, 5900), (5950, 6500)])], "v int, o int, spk int, a long, b long")
    got = folds.coalesce_groups(seg, ["v"], ["o"], "a", "b", "spk", 6000).groupBy("grp").agg(F.min("a").alias("a"), F.max("b").alias("b")).orderBy("a").collect()
    assert [(r.a, r.b) for r in got] == [(0, 5900), (5950, 6500)]
    r = random.Random(2)
    rows = [(v, i, r.randint(0, 5000)) for v in range(10) for i in range(200)]
    want = {}
    for v in range(10):
        g, total, n = 0, 0, 0
        for _, i, c in [x for x in rows if x[0] == v]:
            if n and (total + c > 8192 or n >= 4):
                g, total, n = g + 1, 0, 0
            total, n = total + c, n + 1
            want[v, i] = g
    packed = folds.pack_budget(frame(spark, rows, "v int, o int, c int"), ["v"], ["o"], "c", 8192, 4).collect()
    assert {(x.v, x.o): x.grp for x in packed} == want


def test_candidate_pool(spark):
    r = random.Random(3)
    rows = [(1, i, round(r.random(), 3)) for i in range(300)]
    got = folds.candidate_pool(frame(spark, rows, "v int, f int, k double"), ["v"], "f", "k", 5, 8).collect()
    assert len(got) <= 8 and all(abs(a.f - b.f) > 0 for a in got for b in got if a is not b)


def test_refine():
    keep = lambda v, bonus, forced, n=3: folds.refine(v, bonus, forced, n).tolist()
    assert keep([[1.0, 0], [1.0, 0.01], [0, 1.0], [0.7, 0.7]], [2, 1, 0, 0], [False, False, False, True]) == [True, False, True, True]
    assert keep([[1.0]] * 3, [0] * 3, [False] * 3) == [True] * 3
    assert keep([[1.0]] * 5, [0] * 5, [i in (1, 2, 4) for i in range(5)]) == [False, True, True, False, True]
    assert keep([[1.0], [0.0], [1.0], [1.0]], [0, 0, 1, 0], [False] * 4) == [True, True, True, False]


def test_dark_runs_at_the_end(spark):
    df = frame(spark, [(1, i, v, 8) for i, v in enumerate([0, 0, 9, 0, 0, 9, 0, 0])], "v int, f int, x int, total int")
    runs = lambda least: sorted((r.start, r.end, r.end_excl, r.end_written) for r in sequence.dark_runs(df, ["v"], "f", F.col("x") < 5, least, "total").collect())
    assert runs(2) == [(0, 1, 2, 2), (3, 4, 5, 5)] and runs(1)[-1] == (6, 7, 8, 7)


def test_stable_regions_pick_the_indexed_order_statistic(spark):
    vals = [5.0] * 10 + [50.0] * 10 + [5.0] * 10
    df = frame(spark, [(1, i, v) for i, v in enumerate(vals)], "v int, f int, x double")
    got = [(r.start, r.end) for r in sequence.stable_regions(df, ["v"], "f", "x", 3).orderBy("start").collect()]
    assert got and all(e - s >= 2 for s, e in got) and all(e < 12 or s > 17 for s, e in got)
    flat = frame(spark, [(1, i, 1.0) for i in range(5)], "v int, f int, x double")
    assert [(r.start, r.end) for r in sequence.stable_regions(flat, ["v"], "f", "x", 3).collect()] == [(0, 1)]


def test_chains_with_few_embeddings(spark):
    rows = [(1, 0, True), (1, 1, None), (1, 2, None), (2, 0, True), (2, 1, True), (3, 0, None), (3, 1, True), (3, 2, True), (3, 3, False), (4, 0, True)]
    got = {r.c: (r.raw, r.uniq, r.kind) for r in sequence.unique_shots(frame(spark, rows, "c int, i int, close boolean"), ["c"], "i", "close").collect()}
    assert got == {1: (3, 3, "valid"), 2: (2, 1, "merged"), 3: (4, 3, "valid"), 4: (1, 1, "short")}


def test_key_frame_scores_to_the_last_digit(spark):
    """Values are weighted, then divided, as the SQL does: ties of nearly equal frames hang on it."""
    from sceneloom.functions import numeric

    rows = [(k % 97 + 0.17, k % 7 + 0.31, 96.0 - k % 5, 6.0 + k % 3 / 7) for k in range(1, 300)]
    df = spark.createDataFrame(rows, "s double, e double, ms double, me double")
    zero = F.lit(0.0)
    got = df.select("*", numeric.key_frame_score(zero, F.col("s"), F.col("e"), zero, zero, F.col("ms"), F.col("me")).alias("x")).collect()
    assert all(r.x == 0.25 * r.s / r.ms + 0.2 * r.e / r.me for r in got)
    assert any(r.x != 0.25 * (r.s / r.ms) + 0.2 * (r.e / r.me) for r in got)
