import corpus_pipeline
from sceneloom.llm import langid, mixing, ngram_join
from sceneloom.llm.common import table, written
from sceneloom.llm.decontam import leaks

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = table(spark, SF, "documents")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF).cache()
        out[name] = docs
        if name != "sharding":
            assert docs.columns == before.columns
    und = langid.identify(table(spark, SF, "documents")).filter("NOT accepted").count()
    assert out["language_id"].count() == table(spark, SF, "documents").count() - und
    assert ngram_join.near_duplicates(out["near_duplicates"]).filter("n_links > 0 OR copies > 1").count() == 0
    assert leaks(out["decontamination"], table(spark, SF, "benchmark")).count() == 0
    times = {r.doc_id: r.times for r in mixing.mix(out["decontamination"]).collect()}
    assert out["mixing"].count() == sum(times.values())
    assert out["sharding"].count() == out["mixing"].count()


def test_run_equals_its_stages(spark):
    docs = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), f"test-{name}")
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, docs.collect())) != []


def test_odd_rows_in_every_stage(spark):
    """Nulls in any column, empties, long texts, repeats and clashing columns: each stage's rows beside its rule."""
    docs = table(spark, SF, "documents")
    first = docs.filter("lang = 'en' AND length(text) > 300").orderBy("doc_id").first()
    odd = [
        (None, first.text[:280] + " and so on", None, None, 1), (900_001, None, "en", "src1", None), (900_002, "", None, "src1", 0), (900_003, first.text[50:] * 300, "en", None, 2),
        (first.doc_id, first.text, first.lang, first.source, first.n_chars), (900_004, first.text, "de", None, 7), (900_005, "123 456", "en", "src1", 7),
    ]
    clash = ["1 AS id", "2 AS key", "3 AS row", "4 AS times", "5 AS shared", "6 AS _last", "7 AS bh", "8 AS taken", "9 AS known"]
    docs = written(docs.union(spark.createDataFrame(odd, docs.schema)).selectExpr("*", *clash), "odd-documents")
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, SF), f"odd-{name}")
        rows[name] = docs.collect()
        if name != "sharding":
            assert docs.columns == before.columns
            assert {tuple(r)[5:] for r in rows[name]} == {tuple(range(1, 10))}
            assert {tuple(r) for r in rows[name]} <= {tuple(r) for r in before.collect()}
    ids = {name: [r.doc_id for r in out] for name, out in rows.items()}
    assert not {900_001, 900_002, 900_005} & set(ids["language_id"])
    assert {None, 900_003, 900_004} <= set(ids["language_id"]) and ids["language_id"].count(first.doc_id) == 2
    assert ids["near_duplicates"].count(first.doc_id) <= 1 and 900_004 not in ids["near_duplicates"]
    assert len(ids["sharding"]) == len(ids["mixing"]) and {r.slot for r in rows["sharding"] if r.shard == 3} == set(range(sum(r.shard == 3 for r in rows["sharding"])))


def test_empty_documents(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
