"""Helpers that several training-data operators share.

Arrow batches are bounded by Spark itself (spark.sql.execution.arrow.maxBytesPerBatch, 64 MB): a batch holds long texts
one or few at a time. Python works on slices of them.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word: a run of letters and digits (Unicode), in lower case.
WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    """Lower-case words of a text; null has none."""
    return WORD.findall(text.lower()) if text else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`.

    Only where the session has none on one machine (as in tests), a temporary one is set; elsewhere that is an error, as
    executors don't see the driver's folders.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="sceneloom-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: later jobs neither recompute it nor depend on
    one executor's disk."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in slices of so many rows, which share their memory: what Python makes of a slice is small."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


#: Rows that may be broadcast (about 100 bytes each, so 20 MB).
BROADCAST_ROWS = 200_000


def join_classes(rows: DataFrame, classes: DataFrame, key: str, copies: str, spread: list[str], most: int | None = None) -> DataFrame:
    """rows LEFT JOIN classes on `key`, of which classes, a written table, has one row each and says in `copies` how many
    rows have it at most.

    Up to `most` classes are broadcast. Of more, only the hot ones are: those with so many copies that there can't be
    more than `most` of them. Rows of a hot class then join from where they stand; in the shuffle of the others they
    are dealt by a hash of the columns `spread`, so that no task gets a whole hot class. Null keys join nothing.
    """
    most = most or BROADCAST_ROWS
    n, total = classes.agg(F.count(F.lit(1)), F.sum(copies)).collect()[0]
    if n <= most:
        return rows.join(F.broadcast(classes), key, "left")
    values = [c for c in classes.columns if c != key]
    hot = F.col(copies) > -(-total // most)
    first = classes.filter(hot).select(F.col(key).alias("_hot_key"), F.struct(*values).alias("_hot"))
    rest = classes.filter(~hot).select(F.col(key).alias("_rest_key"), F.lit(0).cast("long").alias("_rest_salt"), F.struct(*values).alias("_rest"))
    found = rows.join(F.broadcast(first), F.col(key) == F.col("_hot_key"), "left")
    dealt = found.withColumn("_salt", F.when(F.col("_hot_key").isNull() & F.col(key).isNotNull(), F.lit(0).cast("long")).otherwise(1 + F.pmod(F.xxhash64(*spread), F.lit(1 << 40))))
    out = dealt.join(rest, (F.col(key) == F.col("_rest_key")) & (F.col("_salt") == F.col("_rest_salt")), "left")
    return out.select(*rows.columns, *[F.coalesce(F.col("_hot")[c], F.col("_rest")[c]).alias(c) for c in values])


def in_range_order(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """df as a written table, dealt by ranges of `order`; column `_pid` numbers the ranges."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in order]
    return written(df.repartitionByRange(n, *keys).withColumn("_pid", F.spark_partition_id()), name)


def with_position(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Adds `_pos`: the row's place from 0 within `group` by `order`.

    Ranges of `order` are ranked apart and shifted by the counts of the ranges before them,
    so that no group has to fit into one task.
    """
    ranged = in_range_order(df, order, name)
    keys = [F.col(c).asc_nulls_first() for c in order]
    counts = ranged.groupBy(*group, "_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_pid").alias("_gp"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    here = Window.partitionBy(*group, "_pid").orderBy(*keys)
    on = F.col("_pid") == F.col("_gp")
    for i, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    out = ranged.withColumn("_rn", F.row_number().over(here)).join(shift, on, "left")
    return out.withColumn("_pos", F.col("_rn") - 1 + F.col("_shift")).drop("_rn", "_shift", "_pid", "_gp", *[f"_g{i}" for i in range(len(group))])


def with_next(df: DataFrame, order: list[str], carry: list[str], name: str) -> DataFrame:
    """Adds `_next_<c>` for c in carry: the values of the following row by `order`, after the
    last row those of the first. The rows of a range are looked at apart; of each range only
    its first row is handed to the range before."""
    ranged = in_range_order(df, order, name)
    keys = [F.col(c).asc_nulls_first() for c in order]
    row = F.struct(*carry)
    here = Window.partitionBy("_pid").orderBy(*keys)
    firsts = ranged.withColumn("_rn", F.row_number().over(here)).filter("_rn = 1").select("_pid", row.alias("_first"))
    along = Window.orderBy("_pid")  # a row for each range
    links = firsts.select("_pid", F.coalesce(F.lead("_first").over(along), F.first("_first").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("_over"))
    out = ranged.withColumn("_lead", F.lead(row).over(here)).join(F.broadcast(links), "_pid")
    return out.select(*df.columns, *[F.coalesce(F.col("_lead"), F.col("_over"))[c].alias(f"_next_{c}") for c in carry])


def crc_of_id(column: str = "doc_id"):
    """crc32 of an id written as text; null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))
