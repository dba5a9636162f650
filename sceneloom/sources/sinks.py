"""Sinks: tables by video, nested JSON artefacts, transcripts, resumable appends, external commands."""

from __future__ import annotations

import io
import subprocess
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType

from ..functions.text import escape_html


def write_by_video(df: DataFrame, path: str, video: str = "video", mode: str = "overwrite") -> None:
    """A Parquet table with a folder for each video; Spark's committer makes it whole or not at all."""
    df.write.mode(mode).partitionBy(video).parquet(path)


def nested(df: DataFrame, key: list[str], order: list[str], name: str) -> DataFrame:
    """K4, K7, K8: one row for each key, its rows as an ordered array of structs."""
    rest = [c for c in df.columns if c not in key]
    packed = F.sort_array(F.collect_list(F.struct(*order, F.struct(*rest).alias("_row"))))
    return df.groupBy(*key).agg(F.transform(packed, lambda x: x["_row"]).alias(name))


def write_artifacts(df: DataFrame, path: str) -> None:
    """K1, K4, K5, K7, K8: JSON lines, one artefact each."""
    df.write.mode("overwrite").json(path)


def write_transcript(df: DataFrame, key: list[str], order: list[str], line: str, path: str) -> None:
    """K5: text files of lines in order, a folder for each key."""
    df.repartition(*key).sortWithinPartitions(*key, *order).select(*key, F.col(line).alias("value")).write.mode("overwrite").partitionBy(*key).text(path)


def write_reports(df: DataFrame, key: str, order: list[str], columns: list[str], path: str, title: Column, apart: bool = True) -> None:
    """K9: an HTML page for each key, its rows by `order` as a table of `columns`, all texts escaped.

    Rows are streamed by Spark's text writer from sorted partitions: no page has to fit into memory. Null values are empty.
    apart: each page is a file in a folder of its own, which takes some 20 ms of a task to write and to find again; else
    a task's pages stand in one file, one behind another, each after a line with its key in hexadecimal digits (- for null).
    """
    cells = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), escape_html(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit("</td>")) for c in columns], F.lit("</tr>"))
    w = Window.partitionBy(key).orderBy(*order)
    named = escape_html(F.coalesce(title, F.lit("")))
    head = F.concat(F.lit('<!DOCTYPE html><html><head><meta charset="utf-8"><title>'), named, F.lit("</title></head><body><h1>"), named, F.lit("</h1><table>\n"))
    if not apart:
        head = F.concat(F.coalesce(F.hex(F.col(key).cast("string").cast("binary")), F.lit("-")), F.lit("\n"), head)
    lines = df.withColumns({"_line": cells, "_head": F.when(F.row_number().over(w) == 1, head).otherwise(F.lit("")), "_last": F.lead(F.lit(1)).over(w).isNull()})
    whole = F.concat("_head", "_line", F.when(F.col("_last"), F.lit("\n</table></body></html>")).otherwise(F.lit("")))
    pages = lines.select(key, *order, whole.alias("value"))
    if not apart:  # the window has put each key into one task
        return pages.sortWithinPartitions(key, *order).select("value").write.mode("overwrite").text(path)
    pages = pages.repartition(key).sortWithinPartitions(key, *order)
    pages.select(key, "value").write.mode("overwrite").partitionBy(key).text(path)


def read_reports(spark: SparkSession, path: str, key: str, apart: bool = True) -> DataFrame:
    """K9: key and html of pages that write_reports() wrote; a key with more than one file is an error.

    Those of a task's file (not apart) have their keys as texts. `<` is escaped in texts, so a page ends where `</html>` stands;
    one that doesn't begin with its key is an error.
    """
    if not apart:
        pages = spark.read.option("lineSep", "</html>\n").text(path)
        first = F.substring_index("value", "\n", 1)
        whole = F.col("value").rlike("^(-|([0-9A-F]{2})*)\n<!DOCTYPE html>")
        html = F.concat(F.expr("substring(value, instr(value, '\n') + 1)"), F.lit("</html>\n"))
        named = F.when(first != "-", F.decode(F.unhex(F.when(first != "-", first)), "UTF-8")).alias(key)
        return pages.select(named, F.when(whole, html).otherwise(F.raise_error(F.lit("a page without its beginning")).cast("string")).alias("html"))
    pages = spark.read.text(path, wholetext=True)
    one = F.when(F.count(F.lit(1)) == 1, F.first("value")).otherwise(F.raise_error(F.lit("a page in several files")).cast("string"))
    return pages.groupBy(key).agg(one.alias("html"))


def matrix_files(df: DataFrame, key: list[str], item: str, vector: str, vectors: str = "embeddings", ids: str = "frame_ids") -> DataFrame:
    """Key and content, the vectors of a key as the bytes of an NPZ file, by item. A key's matrix is one value, so its
    rows meet in one task: keys must be of bounded size (a video, a part of a label)."""
    schema = StructType([*[df.schema[k] for k in key], StructField("content", BinaryType())])

    def pack(k: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(item)
        held = io.BytesIO()
        np.savez(held, **{vectors: np.array(rows[vector].tolist(), np.float32), ids: rows[item].to_numpy(np.int64)})
        return pd.DataFrame([(*k, held.getvalue())], columns=schema.names)

    return df.groupBy(*key).applyInPandas(pack, schema)


def append_new(df: DataFrame, path: str, on: list[str]) -> int:
    """K2, K6, ST7: appends the rows whose keys the table doesn't hold yet; returns how many there were."""
    spark = df.sparkSession
    try:
        old = spark.read.parquet(path).select(*on)
        new = df.join(old, on, "left_anti")
    except AnalysisException:  # there's no table yet
        new = df
    new = new.dropDuplicates(on).cache()
    try:
        n = new.count()
        if n:
            new.write.mode("append").parquet(path)
    finally:
        new.unpersist()
    return n


def or_empty(spark: SparkSession, path: str, schema: StructType, required: bool = False) -> DataFrame:
    """A table, or an empty one with its schema where an optional stage made none; a required one must exist."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        if required:
            raise
        return spark.createDataFrame([], schema)


def run_commands(df: DataFrame, command: Callable[[Row], list[str]], timeout: float = 600) -> DataFrame:
    """An external command for each row; its exit code as `code`. Rows are run where their partition is."""
    schema = StructType([*df.schema.fields, StructField("code", IntegerType())])
    fields = [f.name for f in df.schema.fields]

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            codes = [subprocess.run(command(Row(*fields)(*r)), capture_output=True, timeout=timeout, check=False).returncode for r in b.itertuples(index=False)]
            yield b.assign(code=codes).astype({"code": "int32"})

    return df.mapInPandas(run, schema)


def count_mismatches(expected: DataFrame, actual: DataFrame, on: list[str], n: str) -> DataFrame:
    """Keys whose count differs, or that are missing."""
    a = actual.select(*on, F.col(n).alias("actual"))
    return expected.select(*on, F.col(n).alias("expected")).join(a, on, "left").filter(~F.col("expected").eqNullSafe(F.col("actual")))
