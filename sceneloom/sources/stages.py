"""ST7: a chain of stages of which only the stale ones run.

A manifest holds, for each stage, what its inputs and outputs were when it last ended: of each file its path, length, time
and SHA-256. A stage is stale if it has no entry, if its own version has changed, if an output is gone or isn't the one that
it left, or if the content of an input has changed. A file whose length and time are as they were isn't read again; one
whose time alone has changed is read, and counts as unchanged if its content is. Stages run in the order of their inputs,
and what a stage writes anew is compared in the same way: if a rerun gives the same bytes, nothing behind it is stale.

Files are listed and hashed by Spark's tasks; the driver sees a row for each stage. A file is one value of binaryFile, so
files over 2 GB are an error. Manifests are written whole, a folder for each stage's run, so a run that stops half-way leaves
the last one in force.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRIES = "stage string, version string, kind string, file string, length long, time timestamp, sha string, run long"


@dataclass(frozen=True)
class Stage:
    """A name, folders or files that it reads and writes, and what it does. `version` tells apart what its code does."""

    name: str
    inputs: tuple[str, ...]
    outputs: tuple[str, ...]
    run: Callable[[SparkSession], None]
    version: str = "1"


def in_order(stages: list[Stage]) -> list[Stage]:
    """Each stage behind those whose outputs it reads, else as given; an error if they go in a circle or share an output."""
    makes = {o: s.name for s in stages for o in s.outputs}
    if len(makes) < sum(len(s.outputs) for s in stages) or len({s.name for s in stages}) < len(stages):
        raise ValueError("two stages have one name or output")
    out: list[Stage] = []
    left = list(stages)
    while left:
        done = {s.name for s in out}
        ready = next((s for s in left if all(makes.get(i, s.name) in done or i not in makes for i in s.inputs)), None)
        if ready is None:
            raise ValueError("stages go in a circle: " + ", ".join(s.name for s in left))
        out.append(ready)
        left.remove(ready)
    return out


def files_of(spark: SparkSession, paths: tuple[str, ...], known: DataFrame | None = None) -> DataFrame:
    """file, length, time, sha of all files under paths (none where a path doesn't exist). Files that stand in `known` with
    the same length and time aren't read; hidden files and markers don't count."""
    found = []
    for path in paths:
        try:
            found.append(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path))
        except AnalysisException:  # there's no such path
            continue
    if not found:
        return spark.createDataFrame([], "file string, length long, time timestamp, sha string")
    rows = reduce(DataFrame.union, found).filter(~F.col("path").rlike("/[_.][^/]*$"))
    listed = rows.select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("time"))
    hashed = lambda which: which.select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("time"), F.sha2("content", 256).alias("sha"))
    if known is None:
        return hashed(rows)
    same = listed.join(known.select("file", "length", "time", "sha").distinct(), ["file", "length", "time"])
    fresh = rows.join(same.select(F.col("file").alias("path")), "path", "left_anti")
    return same.select("file", "length", "time", "sha").union(hashed(fresh))


def _differs(now: DataFrame, then: DataFrame) -> bool:
    """Whether the files or their contents differ; times don't count."""
    a, b = now.select("file", "sha").distinct(), then.select("file", "sha").distinct()
    return not (a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty())


def run_stale(spark: SparkSession, stages: list[Stage], manifest: str) -> list[str]:
    """Runs the stale stages; returns their names in the order in which they ran."""
    ran = []
    for stage in in_order(stages):
        path = f"{manifest}/{stage.name}"
        try:
            every = spark.read.schema(ENTRIES).parquet(path)
            last = every.filter(F.col("run") == (every.agg(F.max("run")).first()[0] or 0))
        except AnalysisException:
            last = spark.createDataFrame([], ENTRIES)
        entry = last.select("version", "run").first()
        before = {kind: last.filter(F.col("kind") == kind) for kind in ("in", "out")}
        inputs = files_of(spark, stage.inputs, before["in"]).persist()
        try:
            stale = (
                entry is None or entry.version != stage.version or _differs(inputs, before["in"])
                or _differs(files_of(spark, stage.outputs, before["out"]), before["out"]) or before["out"].filter("file IS NOT NULL").isEmpty()
            )
            if not stale:
                continue
            stage.run(spark)
            ran.append(stage.name)
            kinds = {"in": inputs, "out": files_of(spark, stage.outputs)}
            number = (entry.run if entry else 0) + 1
            rows = [df.select(F.lit(stage.name).alias("stage"), F.lit(stage.version).alias("version"), F.lit(kind).alias("kind"), "file", "length", "time", "sha", F.lit(number).cast("long").alias("run")) for kind, df in kinds.items()]
            rows[0].union(rows[1]).coalesce(1).write.mode("append").parquet(path)
        finally:
            inputs.unpersist()
    return ran
