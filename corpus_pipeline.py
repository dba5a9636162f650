"""The corpus pipeline: language ID, near duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are written as Parquet and read again
as the next stage's docs. All but the last return the columns of documents; more columns that docs has stay, whatever
their names. Repeated rows count each for itself unless a stage says otherwise, texts of any length are read whole, and an
empty table gives no rows in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sceneloom.llm import decontam, langid, mixing, ngram_join, sharding
from sceneloom.llm.common import table, work_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected (in none of the languages learnt, too unsure, or no letters) go.

    Null and empty texts have no letters and go. Rows with a null lang or source are judged by their text like others; a null
    doc_id counts as the empty text where rows to learn from are chosen. Repeated rows stay or go together.
    """
    return langid.accepted_documents(docs, langid.fit(docs, langid.training_rows()))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least doc_id stays (a null one is the largest), and of rows
    that repeat both its id and its text one.

    Rows with null text are in no group and stay; empty texts, and those without words, are near their equals alone. A
    document whose doc_id is null stays only if it has no near duplicate.
    """
    return ngram_join.one_of_each_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, its question and its answer, go.

    Null and empty texts hold none and stay; so do all documents where benchmark is empty. Null and empty items match
    nothing.
    """
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: not at all, once, twice or three times.

    A null source is a source of its own, the last. Null and empty texts have no words and go with the cut at their place.
    Rows of one doc_id are taken alike; those with a null one by their texts.
    """
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of each row; a document that the mix repeats has a slot each
    time, in the same shard.

    Null texts have no bytes; rows with a null doc_id are one key. Ties in a shard's order are equal rows.
    """
    return sharding.shard_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Language ID isn't expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
