"""Sources: video and subtitle listings, JSON artefacts, matrices, raw frames, pictures.

Everything goes through Spark's readers (binaryFile, text, json), so any file system that Spark knows will do.
"""

from __future__ import annotations

import io
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import srt_ms, stem

# What counts as a video, and codecs in order of preference.
VIDEO_ENDINGS = ("mp4", "mov", "mkv", "m4v")
CODEC_ORDER = ("h264", "hevc", "av1", "vp9", "vp8", "mpeg2", "vc1")
FRAME_BYTES = 224 * 224 * 3


def _listed(spark: SparkSession, path: str, glob: str, deep: bool) -> DataFrame:
    rows = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(deep).lower()).load(path)
    return rows.select("path", "length")


def list_videos(spark: SparkSession, path: str, deep: bool = False, endings: tuple[str, ...] = VIDEO_ENDINGS) -> DataFrame:
    """Path, length, folder, name of the videos below a folder, by path; endings in any case.

    Contents aren't read: only names and lengths are asked for.
    """
    glob = "*.{" + ",".join("".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in e) for e in endings) + "}"
    found = _listed(spark, path, glob, deep).select("path", "length", F.element_at(F.split("path", "/"), -2).alias("folder"), F.element_at(F.split("path", "/"), -1).alias("name"))
    if not deep:  # Spark goes into folders that are named like partitions
        found = found.filter(F.col("folder") == path.rstrip("/").rsplit("/", 1)[-1])
    return found.orderBy("path")


def first_in_folder(files: DataFrame) -> DataFrame:
    """The first file of each folder, by path."""
    return files.groupBy("folder").agg(F.min("path").alias("path"))


def subtitles_for(videos: DataFrame, subtitles: DataFrame) -> DataFrame:
    """Each video with the subtitle of the same folder and the same stem, whose case counts: `.srt`, then `.ass`, then
    those with such an ending in another case, by name."""
    folder = lambda c: F.regexp_replace(c, r"/[^/]*$", "")
    s = subtitles.select(F.col("path").alias("subtitle")).filter(F.lower("subtitle").rlike(r"\.(srt|ass)$"))
    v = videos.withColumns({"_f": folder(F.col("path")), "_k": stem(F.col("path"))})
    s = s.withColumns({"_f": folder(F.col("subtitle")), "_k": stem(F.col("subtitle"))})
    rank = F.struct(F.when(F.col("subtitle").endswith(".srt"), 0).when(F.col("subtitle").endswith(".ass"), 1).otherwise(2), "subtitle")
    best = v.join(s, ["_f", "_k"]).groupBy("path").agg(F.min_by("subtitle", rank).alias("subtitle"))
    return videos.join(best, "path", "left")


#: A block of an SRT text: number, times, and lines up to an empty one.
_SRT = r"(?m)^[ \t]*\d+[ \t]*\r?\n(\d+:\d+:\d+,\d+)\s*-->\s*(\d+:\d+:\d+,\d+)[^\n]*(?:\n|\z)((?:[ \t]*[^\s][^\n]*(?:\n|\z))*)"


def parse_srt(df: DataFrame, key: list[str], text: str) -> DataFrame:
    """Key, id, start_ms, end_ms, text, lang, speaker of a column of whole SRT texts.

    Lines of an entry are joined by a space; entries without text go; ids are dense.
    """
    part = lambda i: F.regexp_extract_all(F.regexp_replace(text, "^\uFEFF", ""), F.lit(_SRT), F.lit(i))
    joined = lambda body: F.array_join(F.filter(F.transform(F.split(body, r"\r?\n"), lambda x: F.trim(x)), lambda x: x != ""), " ")
    rows = df.select(*key, F.posexplode(F.arrays_zip(part(1).alias("a"), part(2).alias("b"), part(3).alias("c"))).alias("_i", "_e"))
    full = rows.select(*key, "_i", srt_ms(F.col("_e.a")).alias("start_ms"), srt_ms(F.col("_e.b")).alias("end_ms"), joined(F.col("_e.c")).alias("text")).filter("text <> ''")
    dense = (F.row_number().over(Window.partitionBy(*key).orderBy("_i")) - 1).cast("int")
    return full.select(*key, dense.alias("id"), "start_ms", "end_ms", "text", F.lit("none").alias("lang"), F.lit(-1).alias("speaker"))


def read_srt(spark: SparkSession, path: str) -> DataFrame:
    """All SRT files below a path."""
    texts = spark.read.option("pathGlobFilter", "*.[sS][rR][tT]").option("recursiveFileLookup", "true").text(path, wholetext=True).withColumn("path", F.col("_metadata.file_path"))
    return parse_srt(texts, ["path"], "value")


def read_artifacts(spark: SparkSession, path: str, schema: str, glob: str = "*.json") -> DataFrame:
    """JSON artefacts with a fixed schema and their file names; what doesn't parse is null."""
    rows = spark.read.schema(schema).option("multiLine", "true").option("pathGlobFilter", glob).option("mode", "PERMISSIVE").json(path)
    return rows.withColumn("file_name", F.col("_metadata.file_name"))


def feature_rows(artifact: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """D3: parallel arrays of a feature artefact as a row for each frame; shorter arrays end with nulls."""
    zipped = F.arrays_zip(*[F.col(c) for c in columns])
    return artifact.select(*key, F.posexplode(zipped).alias("frame", "_x")).select(*key, "frame", *[F.col(f"_x.{c}").alias(c) for c in columns])


def flag_rows(artifact: DataFrame, key: list[str], column: str, name: str) -> DataFrame:
    """A map from frame to value as rows; keys that aren't numbers go."""
    return artifact.select(*key, F.explode(column).alias("_k", name)).select(*key, F.col("_k").try_cast("int").alias("frame"), name).filter("frame IS NOT NULL")


def shots_from_text(df: DataFrame, key: list[str], text: str) -> DataFrame:
    """Shots of a JSON text that need not be well formed; those without id, start and end >= start go."""
    body = F.regexp_extract(text, r'(?s)"shots"[^\[]*\[(.*)', 1)
    objects = F.regexp_extract_all(body, F.lit(r"(?s)(\{(?:[^{}]|\{[^{}]*\})*\})"), F.lit(1))
    num = lambda name: F.regexp_extract("_o", rf'"{name}"\s*:\s*(-?\d+)', 1).try_cast("int")
    rows = df.select(*key, F.posexplode(objects).alias("ord", "_o")).select(*key, "ord", num("id").alias("id"), num("start").alias("start"), num("end").alias("end"))
    return rows.filter("id >= 0 AND start >= 0 AND end >= start")


def read_matrices(spark: SparkSession, path: str, vectors: str = "embeddings", ids: str = "frame_ids") -> DataFrame:
    """Path, frame, embedding of NPZ files; a matrix must be 2-D, finite, with a unique id for each row."""
    return matrices(spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(path), vectors, ids)


def matrices(stored: DataFrame, vectors: str = "embeddings", ids: str = "frame_ids") -> DataFrame:
    """The same of a table of path and content, as binaryFile gives it."""
    import numpy as np

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for file, content in zip(b["path"], b["content"], strict=True):
                with np.load(io.BytesIO(content)) as z:
                    m, k = z[vectors].astype(np.float32), z[ids].astype(np.int64)
                if m.ndim != 2 or len(m) != len(k) or not np.isfinite(m).all() or len(np.unique(k)) != len(k):
                    raise ValueError(f"{file}: not a matrix of finite rows with unique ids")
                yield pd.DataFrame({"path": file, "frame": k, "embedding": list(m)})

    return stored.select("path", "content").mapInPandas(load, "path string, frame long, embedding array<float>")


def frames_with_pixels(key_frames: DataFrame, files: DataFrame, on: list[str], black: Column | None = None) -> DataFrame:
    """Key frames with their raw pixels; a missing file counts as black (zeros of FRAME_BYTES, unless told)."""
    zeros = F.unhex(F.repeat(F.lit("00"), FRAME_BYTES)) if black is None else black
    return key_frames.join(files.select(*on, "content"), on, "left").withColumn("content", F.coalesce("content", zeros))


@F.pandas_udf(T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())]))
def jpeg_size(content: pd.Series) -> pd.DataFrame:
    """Width and height of a JPEG's frame header; null without one."""

    def size(data: bytes | None) -> tuple[int | None, int | None]:
        at = 2
        while data and at + 9 < len(data):
            if data[at] != 0xFF:
                at += 1
            elif data[at + 1] in (0xC0, 0xC1, 0xC2):
                h, w = struct.unpack(">HH", data[at + 5 : at + 9])
                return w, h
            elif data[at + 1] in (0xD8, 0x01) or 0xD0 <= data[at + 1] <= 0xD7:
                at += 2
            else:
                at += 2 + struct.unpack(">H", data[at + 2 : at + 4])[0]
        return None, None

    return pd.DataFrame([size(c) for c in content], columns=["width", "height"]).astype("Int32")


def best_track(tracks: DataFrame, key: list[str], codec: str, order: str) -> DataFrame:
    """Of a file's tracks the one with the preferred codec; unknown codecs go."""
    rank = F.array_position(F.array(*[F.lit(c) for c in CODEC_ORDER]), F.lower(codec))
    known = tracks.withColumn("_rank", rank).filter("_rank > 0")
    w = Window.partitionBy(*key).orderBy("_rank", order)
    return known.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rank", "_rn")


def known_codec(codec: Column) -> Column:
    """P22."""
    return F.coalesce(F.lower(codec).isin(*CODEC_ORDER), F.lit(False))
