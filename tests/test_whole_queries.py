"""Queries take every row, frame and text."""

import pytest
from pyspark.sql import functions as F

from oracle_check import connect
from sceneloom.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["w30_numbering", "j6_nearest"])
def test_every_frame(spark, name):
    assert QUERIES[name](spark, SF).count() == connect(SF).execute("SELECT count(*) FROM events").fetchone()[0]


def test_numbers_of_three_digits(spark):
    from sceneloom.operators import sequence

    df = spark.range(120).select(F.lit(1).alias("v"), "id")
    assert [r.n for r in sequence.numbered(df, ["v"], ["id"], "n", 1).orderBy("id").collect()] == list(range(1, 121))


def test_every_wanted_frame(spark):
    wanted = {r.want % 11 for r in QUERIES["j26_nearest_unused"](spark, SF).collect()}
    assert wanted - {3}


def test_languages_of_whole_texts(spark, tmp_path):
    long = "latin words " * 50
    cases = {1: (long + "はい", "ja"), 2: (long + "안녕", "ko"), 3: ("abc " + "你好" * 20, "zh"), 4: (long, "en"), 7: ("你好 " + long, "en"), 8: ("123", "zh"), 10: (long + "カ 안", "ja")}
    spark.createDataFrame([(k, t) for k, (t, _) in cases.items()], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.guess for r in QUERIES["f2_lang"](spark, str(tmp_path)).collect()}
    assert got == {k: g for k, (_, g) in cases.items()}


def test_null_sources_stay(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (2, None), (3, "a"), (4, None)], "doc_id long, source string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    got = {r.doc_id: r.quality for r in QUERIES["j19_shared_persons"](spark, str(tmp_path)).collect()}
    assert got == {1: 1, 2: 0, 3: 1, 4: 0}
    once = {r.doc_id: r.has_face for r in QUERIES["x1_providers"](spark, str(tmp_path)).collect()}
    assert set(once) == {1, 2, 3, 4} and once[1] == once[3] and once[2] == once[4] and None not in once.values()
