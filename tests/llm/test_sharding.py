import zlib
from collections import Counter

from sceneloom.llm import sharding

DOCS = "doc_id long, text string"


def test_rows(spark):
    rows = [(i, f"text é {i % 50}") for i in range(3000)] + [(7, None), (8, ""), (None, "x"), (None, "x"), (9, "long " * 50_000)]
    got = sharding.shard_documents(spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS size", "2 AS shard", "3 AS slot")).collect()
    assert len(got) == len(rows)
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    for s in range(16):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(16)) and max(sizes.values()) < 1.5 * min(sizes.values())
    assert all(r.grown_shard in (r.shard, 16) for r in got) and any(r.grown_shard == 16 for r in got)
    assert all(len({r.shard for r in got if r.doc_id == d}) == 1 for d in (7, None))


def test_every_growth_moves_rows_only_into_the_new_shard(spark):
    df = spark.createDataFrame([(i, "t") for i in range(2000)], DOCS)
    before = {r.doc_id: r.shard for r in sharding.shard_documents(df, 16, False).collect()}
    for n in range(17, 20):
        after = {r.doc_id: r.shard for r in sharding.shard_documents(df, n, False).collect()}
        assert all(after[d] in (s, n - 1) for d, s in before.items())
        before = after


def test_a_changed_weight_moves_rows_only_within_what_changed(spark):
    from pyspark.sql import functions as F

    df = spark.range(4000).select(F.col("id").cast("string").alias("k"))
    a, b = sharding.tree(16), sharding.tree(16, {5: 0.0})
    rows = df.select(sharding.place(F.col("k"), a).alias("a"), sharding.place(F.col("k"), b).alias("b")).collect()
    moved = [(r.a, r.b) for r in rows if r.a != r.b]
    assert moved and all(r.b != 5 for r in rows)
    # region 1 (shards 4-7) lost weight: rows leave it, none move between other regions
    assert all(x // 4 == 1 for x, _ in moved)


def test_empty(spark):
    assert sharding.shard_documents(spark.createDataFrame([], DOCS)).count() == 0
