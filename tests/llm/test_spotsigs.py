import hashlib
import re

from pyspark.sql import functions as F

from sceneloom.llm import spotsigs

DOCS = "doc_id long, text string"
A = "the cat sat on the mat and the dog ran to a house with no door in it today"


def chains(text):
    """Spot signatures as tuples, written apart from the expressions."""
    ws = [w for w in re.split(r"[^\w]+|_+", (text or "").lower()) if w]
    out = set()
    for i, w in enumerate(ws):
        if w in spotsigs.ANCHORS:
            after = [x for x in ws[i + 1 : i + 1 + spotsigs.SPAN] if x not in spotsigs.ANCHORS][: spotsigs.CHAIN]
            if len(after) == spotsigs.CHAIN:
                out.add((w, *after))
    return out or {(w,) for w in ws}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_against_plain_code(spark):
    rows = [(5, A), (3, A.replace("cat", "cow")), (9, "Der Hund und die Katze gehen in das Haus von Peter"), (1, None), (2, ""), (4, "solo"), (7, "x " * 30_000 + A), (8, A)]
    got = {r.doc_id: r for r in spotsigs.fingerprint_documents(spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS k", "2 AS th", "'z' AS head", "9 AS copies")).collect()}
    order = sorted(rows)
    assert len(got) == len(rows)
    for i, (d, t) in enumerate(order):
        t, n = t or "", order[(i + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + n[:half]
        r = got[d]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_edited - jaccard(chains(t), chains(edited))) < 1e-9
        assert abs(r.near_next - jaccard(chains(t), chains(n))) < 1e-9
        assert len(r.fingerprint) == 8 * len(chains(t)) and r.n_signatures == len(chains(t))
    assert got[5].fingerprint == got[8].fingerprint


def test_repeats_nulls_and_one_document(spark):
    rows = [(1, A), (1, A), (1, "other words"), (None, "nothing here"), (None, "nothing here")]
    got = spotsigs.fingerprint_documents(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(((r.doc_id, r.n_chars) for r in got), key=str) == sorted(((d, len(t)) for d, t in rows), key=str)
    (one,) = spotsigs.fingerprint_documents(spark.createDataFrame([(1, A)], DOCS)).collect()
    assert one.near_next == 1.0
    assert spotsigs.fingerprint_documents(spark.createDataFrame([], DOCS)).count() == 0


def test_pruned_likeness(spark):
    df = spark.createDataFrame([([1, 2, 3, 4], [1, 2, 3, 4, 5]), ([1], [1, 2, 3, 4]), ([], [1]), ([], [])], "a array<int>, b array<int>")
    got = [r[0] for r in df.select(spotsigs.likeness(F.col("a"), F.col("b"), 0.8)).collect()]
    assert got == [0.8, 0.0, 0.0, 1.0]


def test_no_python_in_the_plan(spark):
    plan = spotsigs.fingerprint_documents(spark.createDataFrame([(1, A), (2, A)], DOCS).cache())._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_search_against_all_pairs(spark):
    import random

    r = random.Random(9)
    vocab = [f"w{i}" for i in range(500)] + ["the", "of", "and", "to"] * 60
    rows = []
    for g in range(12):
        base = [r.choice(vocab) for _ in range(r.randint(20, 150))]
        for k in range(5):
            w = list(base)
            for _ in range(k):
                w[r.randrange(len(w))] = r.choice(vocab)
            rows.append((g * 10 + k, " ".join(w[: len(w) - 3 * (k == 4)])))
    rows += [(500, None), (501, ""), (0, rows[0][1])]
    docs = spark.createDataFrame(rows, DOCS)
    queries = docs.filter("doc_id % 20 = 0")
    for t in (0.5, 0.8):
        got = sorted((x.query_id, x.doc_id) for x in spotsigs.search(queries, docs, t).collect())
        want = sorted((a, b) for a, x in rows if a % 20 == 0 and x for b, y in rows if y and jaccard(chains(x), chains(y)) >= t - 1e-12)
        assert got == want


def test_nearest_against_all_pairs(spark, monkeypatch):
    import random

    monkeypatch.setattr(spotsigs, "COUNTERS", 64)  # counters that many signatures share change nothing
    r = random.Random(4)
    hot = [r.choice(["the", "of", "and"]) if i % 3 == 0 else f"h{i}" for i in range(60)]
    rows = []
    for i in range(150):
        w = list(hot) if i % 3 == 0 else [r.choice(["the", "of", f"v{r.randrange(90)}"]) for _ in range(r.randint(1, 80))]
        if i % 2:
            w[r.randrange(len(w))] = "other"
        rows.append((i * 5, " ".join(w)))
    rows += [rows[0], (7, rows[0][1]), (None, rows[0][1]), (1000, None), (1100, "")]
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS set_key", "2 AS sigs", "3 AS frequency")
    got = {x.query_id: (x.n_near, x.near_id, x.likeness) for x in spotsigs.nearest(df).collect()}
    for q, t in {(d, t) for d, t in rows if d is not None and d % 100 == 0}:
        near = {(jaccard(chains(t), chains(x)), -d) for d, x in rows if t and x and d not in (None, q)}
        near = [(s, d) for s, d in near if s >= 0.8 - 1e-12]
        best = max(near, default=None)
        assert got[q][:2] == (len(near), -best[1] if best else None) and (not best or abs(got[q][2] - best[0]) < 1e-9)
    assert set(got) == {d for d, _ in rows if d is not None and d % 100 == 0}
    assert not re.search("Python|Arrow|Pandas", spotsigs.nearest(df.cache())._jdf.queryExecution().toString())
    assert spotsigs.nearest(spark.createDataFrame([], DOCS)).count() == 0


def test_many_repeated_rows_are_dealt_over_tasks(spark):
    """Half of all rows repeat one id and text, a quarter have no id and one text: no task gets them together, and results
    are those of a table without repeats."""
    from pyspark.sql import functions as F

    rows = [(5, "the quick fox of the old house runs by night", "en")] * 3000 + [(None, "no id at all but the same old text", "en")] * 1500 + [(100 + i, f"the word{i} and other{i % 7} things of it all", "en") for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6)
    keyed = df.select(F.coalesce("doc_id", F.lit(spotsigs.NULL_ID)).alias("k"), F.xxhash64("text").alias("th"), "text")
    repeated, hot = spotsigs.repeats(keyed.groupBy("k", "th").agg(F.count(F.lit(1)).alias("copies")))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert repeated and hot.count() == 2
    tasks = [r["count"] for r in spotsigs.dealt(keyed, hot).repartition(int(before), "k", "th", "salt").groupBy(F.spark_partition_id()).count().collect()]
    assert max(tasks) < 0.6 * len(rows)
    got = sorted(map(tuple, spotsigs.fingerprint_documents(df).collect()), key=str)
    once = {r.doc_id: tuple(r) for r in spotsigs.fingerprint_documents(df.distinct()).collect()}
    assert got == sorted((once[i] for i, *_ in rows), key=str)
