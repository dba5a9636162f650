import random
import re

from sceneloom.llm import mixing

DOCS = "doc_id long, text string, source string"


def corpus(sizes, seed=1):
    r = random.Random(seed)
    return [(i * 7 + hash(s or "") % 5, " ".join(["w"] * r.randint(0, 20)), s) for s, n in sizes.items() for i in range(n)]


def spec_targets(sizes):
    """Caps and sharing, step by step."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, free, out = float(sum(sizes.values())), set(names), {}
    while free:
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            out |= share
            break
        for s in over:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        free -= over
    return out


def test_targets_and_taken(spark):
    rows = corpus({"a": 5, "b": 900, "c": 30, None: 400, "é": 80, "z": 1})
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS size", "2 AS target", "3 AS _key")
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t))
    want = spec_targets(sizes)
    for s in sizes:
        own = [r for r in got if r.source == s]
        assert all(r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 * (1 + want[s]) for r in own)
        assert abs(sum(r.taken for r in own) - want[s]) <= 21
    assert all(r.taken in (0, r.size, 2 * r.size, 3 * r.size) for r in got)
    assert sorted(got, key=str) == sorted(mixing.mix(df).collect(), key=str)


def test_ranges_make_no_difference(spark, monkeypatch):
    df = spark.createDataFrame(corpus({"a": 300, "b": 40, "c": 9}), DOCS)
    one = sorted(mixing.mix(df).collect(), key=str)
    monkeypatch.setattr(mixing, "ROWS_PER_RANGE", 10)
    assert sorted(mixing.mix(df).collect(), key=str) == one


def test_documents_come_as_often_as_they_are_taken(spark):
    rows = [(i, t, s) for i, (_, t, s) in enumerate(corpus({"a": 60, "b": 200, None: 3}))]
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "7 AS _again", "'x' AS _s", "1 AS _whole", "2 AS _last", "3 AS whole", "4 AS last", "5 AS of", "6 AS row", "8 AS times", "9 AS key")
    times = {r.doc_id: r.times for r in mixing.mix(df).collect()}
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    seen = {}
    for r in out.collect():
        assert tuple(r)[3:] == (7, "x", 1, 2, 3, 4, 5, 6, 8, 9)
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    assert seen == {d: n for d, n in times.items() if n}


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (None, "two words", "a"), (3, "\x1c  x", "b"), (3, "\x1c  x", "b")]
    got = {(r.doc_id, r.source): (r.size, r.source_size) for r in mixing.mix(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {(1, "a"): (0, 2), (2, "a"): (0, 2), (None, "a"): (2, 2), (3, "b"): (2, 4)}
    assert mixing.mix(spark.createDataFrame([(1, None, "a"), (2, None, None)], DOCS)).filter("taken > 0").count() == 0
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0
    assert mixing.mixed_documents(spark.createDataFrame([], DOCS)).count() == 0


def test_rows_without_ids_are_taken_apart(spark):
    """Many rows with a null id are no single key: a cut may run between them."""
    rows = [(None, f"word w{i}", "a") for i in range(60)] + [(i, "x " * 40, "b") for i in range(30)]
    df = spark.createDataFrame(rows, DOCS)
    got = mixing.mix(df).filter("source = 'b'").agg({"taken": "sum"}).first()[0]
    assert abs(got - mixing.mix(df).filter("source = 'b'").first().target) <= 40
    kept = mixing.mixed_documents(df)
    assert kept.count() == mixing.mix(df).agg({"times": "sum"}).first()[0]
