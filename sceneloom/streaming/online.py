"""Online forms of the sequence kernels: keyed state in Structured Streaming.

Rows of a key must come in order across batches; within a batch they are sorted. Rate limits (maxFilesPerTrigger)
bound what a batch holds (ST1); a stream that ends early simply has fewer rows (ST5). Frames are never dropped
under load (ST4): a slow stream waits.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.folds import consider
from ..session import shared_folder

SCORES = "video long, frame int, mafd double, score double"


def stream_scores(frames: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """ST2, W1: mafd and score of each row of a stream, with the same results as the batch form."""

    def step(k, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        frame, before, mafd_before = state.get if state.exists else (0, None, 0.0)
        rows = pd.concat(list(batches)).sort_values(order)
        out = []
        for x in rows[value]:
            mafd = 0.0 if before is None else abs(x - before)
            score = 0.0 if before is None else min(max(min(mafd, abs(mafd - mafd_before)), 0.0), 100.0)
            out.append((k[0], frame, mafd, score))
            frame, before, mafd_before = frame + 1, x, mafd
        state.update((frame, before, mafd_before))
        yield pd.DataFrame(out, columns=["video", "frame", "mafd", "score"])

    return frames.groupBy(key).applyInPandasWithState(step, SCORES, "frame int, before double, mafd double", "append", GroupStateTimeout.NoTimeout)


SHOTS = "video long, shot int, start int, end int"


def stream_shots(frames: DataFrame, key: str, order: str, value: str, threshold: float, total: str) -> DataFrame:
    """ST3: a shot is sent when the cut behind it is seen, and the last one when the video's last frame is.

    total: the column with the number of frames that the video's header names (lowered by decoded_totals() where a video was
    cut off); where it is null the last shot stays open.
    """

    def step(k, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        frame, before, mafd_before, shot, start = state.get if state.exists else (0, None, 0.0, 0, 0)
        rows = pd.concat(list(batches)).sort_values(order)
        out = []
        for x, n in zip(rows[value], rows[total], strict=True):
            mafd = 0.0 if before is None else abs(x - before)
            score = 0.0 if before is None else min(max(min(mafd, abs(mafd - mafd_before)), 0.0), 100.0)
            cut = frame - 1
            if score >= threshold and cut > 0:
                out.append((k[0], shot, start, cut - 1))
                shot, start = shot + 1, cut
            if not pd.isna(n) and frame == n - 1:
                out.append((k[0], shot, start, frame))
                shot, start = shot + 1, frame + 1
            frame, before, mafd_before = frame + 1, x, mafd
        state.update((frame, before, mafd_before, shot, start))
        yield pd.DataFrame(out, columns=["video", "shot", "start", "end"])

    return frames.groupBy(key).applyInPandasWithState(step, SHOTS, "frame int, before double, mafd double, shot int, start int", "append", GroupStateTimeout.NoTimeout)


DARK_RUNS = "video long, start int, end int"


def stream_dark_runs(frames: DataFrame, key: str, order: str, value: str, dark_below: float, least: int, total: str) -> DataFrame:
    """ST2, W2: dark runs with the state that the analysis keeps, the first frame of an open run. A run is sent when it ends,
    or at the video's last frame, where it must be longer by one."""

    def step(k, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        frame, began = state.get if state.exists else (0, -1)
        rows = pd.concat(list(batches)).sort_values(order)
        out = []
        for x, n in zip(rows[value], rows[total], strict=True):
            if x < dark_below:
                began = frame if began < 0 else began
                if not pd.isna(n) and frame == n - 1:
                    if frame - began >= least:
                        out.append((k[0], began, frame))
                    began = -1
            elif began >= 0:
                if frame - began >= least:
                    out.append((k[0], began, frame - 1))
                began = -1
            frame += 1
        state.update((frame, began))
        yield pd.DataFrame(out, columns=["video", "start", "end"])

    return frames.groupBy(key).applyInPandasWithState(step, DARK_RUNS, "frame int, began int", "append", GroupStateTimeout.NoTimeout)


POOL = "video long, shot int, frame int, rank double, start int, end int"


def stream_pool(frames: DataFrame, key: str, order: str, value: str, penalty: str, threshold: float, total: str, near: int = 15, most: int = 32) -> DataFrame:
    """ST2, T4: the candidates of each shot, sent when the shot is over: when the cut behind it is seen, or the last frame;
    with the shot's start and end, as stream_shots() has them.

    A frame's rank is its change plus `penalty`, the lesser the better. It is a candidate of the shot that is open once its
    own change is known, so the frame at which a cut lies is the last candidate of the shot before. The state of a video is how
    far it has come, and a list of its best frames that never grows beyond `most`.
    """

    def step(k, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        frame, before, mafd_before, shot, start, held, ranks = state.get if state.exists else (0, None, 0.0, 0, 0, [], [])
        pool = [list(p) for p in zip(held, ranks, strict=True)]
        rows = pd.concat(list(batches)).sort_values(order)
        out: list[tuple] = []
        for x, extra, n in zip(rows[value].tolist(), rows[penalty].tolist(), rows[total].tolist(), strict=True):
            mafd = 0.0 if before is None else abs(x - before)
            score = 0.0 if before is None else min(max(min(mafd, abs(mafd - mafd_before)), 0.0), 100.0)
            if score >= threshold and frame > 1:  # the shot before is over
                out += [(k[0], shot, *p, start, frame - 2) for p in sorted(pool)]
                shot, start, pool = shot + 1, frame - 1, []
            consider(pool, frame, round(mafd + extra, 6), near, most)
            if not pd.isna(n) and frame == n - 1:
                out += [(k[0], shot, *p, start, frame) for p in sorted(pool)]
                shot, start, pool = shot + 1, frame + 1, []
            frame, before, mafd_before = frame + 1, x, mafd
        state.update((frame, before, mafd_before, shot, start, [p[0] for p in pool], [p[1] for p in pool]))
        if out:
            yield pd.DataFrame(out, columns=["video", "shot", "frame", "rank", "start", "end"])

    held = "frame int, before double, mafd double, shot int, start int, frames array<int>, ranks array<double>"
    return frames.groupBy(key).applyInPandasWithState(step, POOL, held, "append", GroupStateTimeout.NoTimeout)


def run_to_end(stream: DataFrame, name: str, base: str | None = None, listed: bool = False) -> DataFrame:
    """ST7: runs a stream over all that is there and returns its table.

    base: a folder for the table and the checkpoint. A second run with the same one takes what is new only, and adds to
    the table. Without it the run stands alone, in a new folder of the shared ones. listed: keeps the state in RocksDB, as
    list states of transformWithState need it; the session's own setting is put back once the stream has begun with its copy of it.
    """
    import uuid

    base = base or f"{shared_folder(stream.sparkSession)}/{name}-{uuid.uuid4().hex}"
    conf, provider = stream.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(provider)
    if listed:
        conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    writer = stream.writeStream.format("parquet").option("path", f"{base}/table").option("checkpointLocation", f"{base}/state").outputMode("append").trigger(availableNow=True)
    try:
        q = writer.start()
    finally:
        conf.set(provider, before)
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{base}/table")


def event_stream(spark: SparkSession, path: str) -> DataFrame:
    """ST1: a table as a file stream; path: a folder of files, or one file."""
    table = spark.read.parquet(path)
    folder, _, name = path.rstrip("/").rpartition("/")
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 8)
    if [f.rpartition("/")[2] for f in table.inputFiles()] == [name]:  # streams read folders
        return stream.option("pathGlobFilter", name).parquet(folder)
    return stream.parquet(path)
