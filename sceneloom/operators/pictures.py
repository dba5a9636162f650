"""Measures of raw frames and the column work on them: stencils over planes of bytes, locked columns, resampling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns of a bitmap's word.
WORD = 32


def _outlier(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Whether rows' values lie apart from those above and below, though these two agree."""
    return (np.abs(a - b) + np.abs(c - b)) // 2 - np.abs(a - c) > 4


def outliers(y: np.ndarray) -> int:
    """A3 TOUT: inner pixels that are outliers with both their neighbours, one row away, and two away where there are two."""
    h, w = y.shape
    if h < 3 or w < 3:
        return 0
    near = np.zeros((h, w), bool)
    near[1:-1] = _outlier(y[:-2], y[1:-1], y[2:])
    if h >= 5:
        near[2:-2] &= _outlier(y[:-4], y[2:-2], y[4:])
    return int((near[1:-1, :-2] & near[1:-1, 1:-1] & near[1:-1, 2:]).sum())


def repeated_rows(y: np.ndarray) -> int:
    """A3 VREP: rows that differ from the row four above by less than one for each pixel."""
    return int((np.abs(y[4:] - y[:-4]).sum(1) < y.shape[1]).sum()) if len(y) > 4 else 0


def out_of_range(y: np.ndarray, uv: np.ndarray) -> int:
    """A3 BRNG: pixels whose luma or either chroma (of 2 x 2 pixels) is outside the broadcast range."""
    u, v = (np.repeat(np.repeat(uv[:, i::2], 2, 0), 2, 1)[: y.shape[0], : y.shape[1]] for i in (0, 1))
    return int(((y < 16) | (y > 235) | (u < 16) | (u > 240) | (v < 16) | (v > 240)).sum())


def boxed(y: np.ndarray, size: int) -> np.ndarray:
    """A4: size x size means of boxes, whole numbers; by sums over all rectangles from the corner."""
    h, w = y.shape
    total = np.zeros((h + 1, w + 1), np.int64)
    total[1:, 1:] = y.cumsum(0).cumsum(1)
    at = np.arange(size)
    top, left = at * h // size, at * w // size
    bottom, right = np.maximum((at + 1) * h // size, top + 1), np.maximum((at + 1) * w // size, left + 1)
    sums = total[np.ix_(bottom, right)] - total[np.ix_(top, right)] - total[np.ix_(bottom, left)] + total[np.ix_(top, left)]
    return sums // ((bottom - top)[:, None] * (right - left)[None, :])


def laplacian(small: np.ndarray) -> tuple[int, int]:
    """A4: sum and sum of squares of the Laplacian over the inner pixels."""
    x = 4 * small[1:-1, 1:-1] - small[1:-1, :-2] - small[1:-1, 2:] - small[:-2, 1:-1] - small[2:, 1:-1]
    return int(x.sum()), int((x * x).sum())


def frame_measures(frames: DataFrame, key: list[str], content: str, width: int, height: int, size: int = 224) -> DataFrame:
    """A3, A4: key, tout, vrep, brng, box_sum, lap_sum, lap_squares of frames in NV12 (a plane of luma, then rows of u and
    v in turn); whole numbers, from which brightness() and sharpness() follow.

    A frame without content is black with neutral chroma; one of another length is an error. width and height are even.
    """
    if width % 2 or height % 2 or width < 2 or height < 2 or size < 3:
        raise ValueError(f"frames of {width} x {height}")
    fields = [frames.schema[k] for k in key]
    names = ["tout", "vrep", "brng", "box_sum", "lap_sum", "lap_squares"]
    bytes_, luma = width * height * 3 // 2, width * height

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for x in b.column(len(key)):
                data = x.as_py()
                if data is None:
                    data = bytes(luma) + b"\x80" * (bytes_ - luma)
                if len(data) != bytes_:
                    raise ValueError(f"a frame of {len(data)} bytes, not {bytes_}")
                plane = np.frombuffer(data, np.uint8).astype(np.int64)
                y, uv = plane[:luma].reshape(height, width), plane[luma:].reshape(height // 2, width)
                small = boxed(y, size)
                rows.append((outliers(y), repeated_rows(y), out_of_range(y, uv), int(small.sum()), *laplacian(small)))
            columns = zip(*rows, strict=True) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([*b.columns[: len(key)], *(pa.array(c, pa.int64()) for c in columns)], names=[*key, *names])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"{n} long" for n in names])
    return frames.select(*key, F.col(content).cast("binary").alias("_content")).mapInArrow(run, schema)


def sharpness(lap_sum: Column, lap_squares: Column, size: int = 224) -> Column:
    """A4: the Laplacian's variance."""
    n = float((size - 2) ** 2)
    return lap_squares / n - (lap_sum / n) * (lap_sum / n)


def brightness(box_sum: Column, size: int = 224) -> Column:
    """A4: mean brightness, from 0 to 1."""
    return box_sum / float(size * size * 255)


def locked_columns(boxes: DataFrame, key: list[str], x1: str, x2: str, width: str) -> DataFrame:
    """key, words, n_locked: the columns under any box of a frame, as bitmaps of WORD columns a word (the least bit is
    the leftmost column), united by a bitwise or. A frame's boxes are shuffled once, before they become words, and its words stay where they are. Boxes are [x1, x2), clipped to the frame;
    those without a width lock nothing. Frames with no locked column have no row.
    """
    lo, hi = F.greatest(F.col(x1), F.lit(0)).cast("int"), F.least(F.col(x2), F.col(width)).cast("int")
    spans = boxes.select(*key, lo.alias("_lo"), hi.alias("_hi")).filter("_hi > _lo").repartition(*key)
    words = spans.withColumn("_w", F.explode(F.sequence(F.floor(F.col("_lo") / WORD).cast("int"), F.floor((F.col("_hi") - 1) / WORD).cast("int"))))
    first = F.greatest(F.col("_lo") - F.col("_w") * WORD, F.lit(0))
    last = F.least(F.col("_hi") - F.col("_w") * WORD, F.lit(WORD))
    bits = F.call_function("shiftleft", F.call_function("shiftleft", F.lit(1).cast("long"), last - first) - 1, first)
    united = words.select(*key, "_w", bits.alias("_b")).groupBy(*key, "_w").agg(F.bit_or("_b").alias("_b"))
    packed = F.sort_array(F.collect_list(F.struct("_w", "_b")))  # a row for each word of a frame
    return united.groupBy(*key).agg(F.transform(packed, lambda x: F.struct(x["_w"].alias("word"), x["_b"].alias("bits"))).alias("words"), F.sum(F.bit_count("_b")).cast("int").alias("n_locked"))


def resampled(importance: np.ndarray, cold: float, locked: np.ndarray | None = None, kept_part: float | None = 0.25, least: int = 64) -> np.ndarray:
    """which source column each column of the narrowed frame shows.

    The `kept_part` most important columns weigh 1 and the others `cold` (without it a column weighs by its importance, `cold`
    at least); locked ones weigh 1. The new width is the sum of weights, and its columns lie evenly on their prefix sums.
    """
    x = np.asarray(importance, np.float64)
    if not len(x):
        return np.zeros(0, np.int32)
    w = np.where(x >= np.quantile(x, 1 - kept_part), 1.0, cold) if kept_part is not None else cold + (1 - cold) * x
    if locked is not None and len(locked):
        w[np.asarray(locked, np.int64)] = 1.0
    sums = np.cumsum(w)
    n = max(least, round(float(sums[-1])))
    targets = sums[-1] * np.arange(n) / max(1, n - 1)
    return np.minimum(np.searchsorted(sums, targets, side="right"), len(x) - 1).astype(np.int32)


def resampled_columns(df: DataFrame, key: list[str], importance: str, locked: str | None, cold: float = 0.5, kept_part: float | None = 0.25, least: int = 64) -> DataFrame:
    """key, columns (array of ints) from the importance of a frame's columns and the numbers of its locked ones.

    A null importance is an error, null lists are empty, locked numbers outside the frame are passed over.
    """
    fields = [df.schema[k] for k in key]
    rows = df.select(*key, F.transform(importance, lambda x: x.cast("double")).alias("_x"), (F.col(locked).cast("array<int>") if locked else F.lit(None).cast("array<int>")).alias("_l"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for x, some in zip(b.column(len(key)).to_pylist(), b.column(len(key) + 1).to_pylist(), strict=True):
                x = x or []
                if any(v is None for v in x):
                    raise ValueError("a column without importance")
                out.append(resampled(np.array(x), cold, np.array([c for c in some or [] if 0 <= c < len(x)]), kept_part, least).tolist())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(key)], pa.array(out, pa.list_(pa.int32()))], names=[*key, "columns"])

    return rows.mapInArrow(run, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["columns array<int>"]))
