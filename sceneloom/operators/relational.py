"""Joins, filters and aggregations that the engine's stages are made of."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Languages that are believed, and hints for the others, in order.
LANGUAGES, HINTS = ("zh", "ja", "ko", "en"), ("ja", "zh", "en", "ko")


def lookup(df: DataFrame, side: DataFrame, on: list[str], value: str) -> DataFrame:
    """A join that must find its row; a missing one fails the query."""
    found = df.join(side.withColumn("_found", F.lit(True)), on, "left")
    return found.withColumn(value, F.when(F.col("_found"), F.col(value)).otherwise(F.raise_error(F.concat(F.lit("no row for "), F.to_json(F.struct(*on)))).cast(side.schema[value].dataType))).drop("_found")


def exactly_one(df: DataFrame, side: DataFrame, on: list[str], each: list[str]) -> DataFrame:
    """df's rows; each must have exactly one partner, or the query fails."""
    counts = side.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    ok = F.coalesce(F.col("_n"), F.lit(0)) == 1
    return df.join(counts, on, "left").filter(F.when(ok, True).otherwise(F.raise_error(F.concat(F.lit("not exactly one partner: "), F.to_json(F.struct(*each)))).cast("boolean"))).drop("_n")


def nearest_key(df: DataFrame, key: list[str], order: str, is_key: Column, name: str) -> DataFrame:
    """The order value of the last key row before, else of the first one behind."""
    w = Window.partitionBy(*key).orderBy(order)
    own = F.when(is_key, F.col(order))
    before = F.last(own, True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    behind = F.last(own, True).over(Window.partitionBy(*key).orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn(name, F.coalesce(before, behind))


def fill_from_key(df: DataFrame, cluster: str, order: str, value: str, is_key: Column, key_value: Column, last: bool = False, required: bool = False) -> DataFrame:
    """Rows without a value take that of their cluster's first (or last) key row that has one.

    required: a row without a value, whose cluster has none to give or that is in no cluster, is an error.
    """
    pick = F.max_by if last else F.min_by
    keys = df.filter(is_key & (F.trim(F.coalesce(key_value.cast("string"), F.lit(""))) != "")).groupBy(cluster).agg(pick(key_value, F.col(order)).alias("_key_value"))
    filled = F.coalesce(value, "_key_value")
    if required:
        missing = F.raise_error(F.concat(F.lit("no key value for cluster "), F.coalesce(F.col(cluster).cast("string"), F.lit("null"))))
        filled = F.when(filled.isNotNull(), filled).otherwise(missing.cast(df.schema[value].dataType))
    return df.join(keys, cluster, "left").withColumn(value, filled).drop("_key_value")


def first_source(sources: list[DataFrame], on: list[str], value: str) -> DataFrame:
    """Of several sources the value of the first that has one."""
    all_rows = reduce(DataFrame.unionByName, [s.select(*on, F.col(value), F.lit(i).alias("_i")) for i, s in enumerate(sources)])
    return all_rows.filter(F.col(value).isNotNull()).groupBy(*on).agg(F.min_by(value, "_i").alias(value))


def with_hints(df: DataFrame, key: str, lang: str, text: str, hear: Callable[[str, Column], Column]) -> DataFrame:
    """Adds `used`: the language, or for one outside the list the first hint whose answer isn't empty."""
    answers = [F.when(F.coalesce(F.char_length(hear(h, F.col(text))), F.lit(0)) > 0, F.lit(h)) for h in HINTS]
    return df.withColumn("used", F.when(F.col(lang).isin(*LANGUAGES), F.col(lang)).otherwise(F.coalesce(*answers)))


def block_ranges(blocks: DataFrame, scenes: DataFrame, key: list[str], first: str, last: str, scene: str, start: str, end: str) -> DataFrame:
    """Blocks with range_start and range_end, from the scenes that they begin and end with."""
    a = scenes.select(*key, F.col(scene).alias(first), F.col(start).alias("range_start"))
    b = scenes.select(*key, F.col(scene).alias(last), F.col(end).alias("range_end"))
    return blocks.join(a, [*key, first], "left").join(b, [*key, last], "left")


def bad_frame(sharpness: Column, luma: Column, blur: float = 100, under: float = 15, over: float = 245) -> Column:
    """Blurred, underexposed or overexposed; unknown frames are bad."""
    return F.coalesce((sharpness < blur) | (luma < under) | (luma > over), F.lit(True))


def default_key_frames(key_frames: Column, start: Column, end: Column) -> Column:
    """P5."""
    return F.when(F.coalesce(F.size(key_frames), F.lit(0)) > 0, key_frames).otherwise(F.array(F.floor((start + end) / 2).cast("int")))


def not_black(black: Column) -> Column:
    """A missing flag is false."""
    return ~F.coalesce(black, F.lit(False))


def good_faces(df: DataFrame, frame: list[str], score: str, area: str, frame_area: Column, least: float = 0.30) -> DataFrame:
    """Sure detections; the more of them in a frame, the larger they must be."""
    sure = df.filter(F.col(score) >= least).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*frame)))
    return sure.filter(F.col(area) >= frame_area * (0.001 + 0.002 * F.col("_n"))).drop("_n")


def speech_samples(start_ms: Column, end_ms: Column, rate: int = 16000) -> Column:
    """Samples between two times, each truncated."""
    at = lambda ms: (ms / 1000.0 * rate).cast("long")
    return at(end_ms) - at(start_ms)


def with_text(df: DataFrame, text: str) -> DataFrame:
    """P10: rows that say something."""
    return df.filter(~F.trim(F.col(text)).isin("", "None", "无"))


def valid_boundaries(boundaries: Column, n: Column) -> Column:
    """Distinct and sorted, within 1 .. n - 1."""
    return F.array_sort(F.array_distinct(F.filter(boundaries, lambda b: (b > 0) & (b < n))))


def key_marks(marks: Column) -> Column:
    """Marks of key frames."""
    return F.filter(marks, lambda m: m.rlike("_[^_]*key$"))


def conforms(frames: Column) -> Column:
    """P25: a list that isn't empty and whose entries are marks."""
    return F.coalesce((F.size(frames) > 0) & F.forall(frames, lambda m: m.rlike(r"^\w+_f\d+(?:_\w+)?")), F.lit(False))


def tall_enough(y1: Column, y2: Column, height: Column, ratio: float = 0.2) -> Column:
    """Boxes whose height is at least a part of the frame's; unknown ones aren't."""
    return F.coalesce((y2 - y1) >= height * ratio, F.lit(False))


def main_subject(df: DataFrame, frame: list[str], box: str, height: str, ratio: float = 1.4) -> DataFrame:
    """Of three boxes or more, those above the largest jump in height, if it is large enough."""
    w = Window.partitionBy(*frame).orderBy(height, box)
    jump = F.when(F.col(height) > 0, F.lead(height).over(w) / F.col(height))
    ranked = df.withColumns({"_k": F.row_number().over(w), "_jump": jump})
    cut = ranked.groupBy(*frame).agg(F.count(F.lit(1)).alias("_n"), F.max("_jump").alias("_best"), F.max_by("_k", F.when(F.col("_jump").isNotNull(), F.struct("_jump", -F.col("_k")))).alias("_cut"))
    keep = (F.col("_n") <= 2) | (F.coalesce(F.col("_best"), F.lit(0.0)) < ratio) | (F.col("_k") > F.col("_cut"))
    return ranked.join(cut, frame).filter(keep).drop("_k", "_jump", "_n", "_best", "_cut")


def ordered_list(df: DataFrame, key: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Values of a key in order."""
    return df.groupBy(*key).agg(F.transform(F.sort_array(F.collect_list(F.struct(*order, value))), lambda x: x[value]).alias(name))


def united_maps(df: DataFrame, key: list[str], order: list[str], column: str) -> DataFrame:
    """One map for each key; of a repeated entry the last in order counts."""
    entries = df.select(*key, *order, F.explode(column).alias("_k", "_v"))
    last = entries.groupBy(*key, "_k").agg(F.max_by("_v", F.struct(*order)).alias("_v"))
    return last.groupBy(*key).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("_k", "_v")))).alias(column))


def content_hash(content: Column) -> Column:
    """The first six hexadecimal digits of SHA-256."""
    return F.substring(F.sha2(content, 256), 1, 6)


def first_rows(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Of rows with the same key the first in order."""
    rest = [c for c in df.columns if c not in key]
    best = df.groupBy(*key).agg(F.min(F.struct(*order, *[c for c in rest if c not in order])).alias("_b"))
    return best.select(*key, *[F.col(f"_b.{c}").alias(c) for c in rest])


def top_n(df: DataFrame, key: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each key."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter(F.col("_rn") <= n).drop("_rn")


def histogram_stats(df: DataFrame, key: list[str], value: str) -> DataFrame:
    """A2: mean, low, high, 10 % and 90 % levels and entropy of a histogram."""
    h = df.groupBy(*key, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*key)
    h = h.withColumns({"_cum": F.sum("_n").over(whole.orderBy("_v")), "_t": F.sum("_n").over(whole)})
    p = F.col("_n") / F.col("_t")
    level = lambda percent: F.min(F.when(F.col("_cum") >= F.rint(F.col("_t") * percent / 100), F.col("_v")))
    return h.groupBy(*key).agg(
        (F.sum(F.col("_v") * F.col("_n")) / F.max("_t")).alias("mean"), F.min("_v").alias("low"), F.max("_v").alias("high"), level(10).alias("ylow"), level(90).alias("yhigh"), F.sum(-p * F.log2(p)).alias("entropy")
    )


def persons_of_scenes(intervals: DataFrame, key: list[str], person: str) -> DataFrame:
    """The persons of each scene that their intervals touch."""
    rows = intervals.select(*key, person, F.explode(F.sequence("start", "end")).alias("scene"))
    return rows.groupBy(*key, "scene").agg(F.sort_array(F.collect_list(person)).alias("persons"))


def scenes(survivors: DataFrame, black_runs: DataFrame, shots: DataFrame, key: list[str], order: str, shot: str) -> DataFrame:
    """Scenes of frames that survived, in time order: neighbours of a shot with no black run between them; each
    black run that touches a shot is a scene of its own. Survivors of a shot merge within it, so a scene's merged shots are
    that one.

    shots: (key, shot, start, end). Returns key, scene, start, end (of the shot, or of the black run), n_shots (of a black
    scene, the shots that it touches), key_frame, frames (survivors; of a black scene, those within it), black. Scenes stand
    by their first frame, black ones by their run's start.
    """
    from .interval import first_interval, overlapping

    touched = overlapping(black_runs.select(*key, F.col("start").alias("_s"), F.col("end").alias("_e")), shots.select(*key, shot, "start", "end"), key, ("_s", "_e"), ("start", "end"), 64)
    runs = touched.groupBy(*key, "_s", "_e").agg(F.countDistinct(shot).cast("int").alias("n_shots"))
    inside = first_interval(survivors.select(*key, order, shot), black_runs.select(*key, F.col("start").alias("_s"), F.col("end").alias("_e"), F.col("start").alias("_run")).withColumn("_o", F.col("_s")), key, order, order, "_s", "_e", "_o", "_run", 64)
    clear = inside.filter("_run IS NULL").drop("_run")
    marks = clear.select(*key, F.col(order).alias("_t"), shot, F.lit(0).alias("_black")).unionByName(black_runs.select(*key, F.col("start").alias("_t"), F.lit(None).cast(clear.schema[shot].dataType).alias(shot), F.lit(1).alias("_black")))
    w = Window.partitionBy(*key).orderBy("_t", F.col("_black").desc())
    counted = marks.withColumn("_passed", F.sum("_black").over(w)).filter("_black = 0")
    row, before = F.struct(shot, "_passed"), F.lag(F.struct(shot, "_passed")).over(Window.partitionBy(*key).orderBy("_t"))
    grouped = counted.withColumn("_new", F.when(before.isNull() | ~row.eqNullSafe(before), 1).otherwise(0)).withColumn("_g", F.sum("_new").over(Window.partitionBy(*key).orderBy("_t")))
    normal = grouped.groupBy(*key, "_g", shot).agg(F.min("_t").alias("key_frame"), F.sort_array(F.collect_list("_t")).alias("frames")).drop("_g").join(shots.select(*key, shot, "start", "end"), [*key, shot])
    normal = normal.select(*key, F.col("key_frame").alias("_at"), "start", "end", F.lit(1).alias("n_shots"), "key_frame", "frames", F.lit(False).alias("black"))
    kept = inside.filter("_run IS NOT NULL").groupBy(*key, F.col("_run").alias("_s")).agg(F.sort_array(F.collect_list(order)).alias("frames"))
    dark = runs.join(kept, [*key, "_s"], "left").select(*key, F.col("_s").alias("_at"), F.col("_s").alias("start"), F.col("_e").alias("end"), "n_shots", F.col("_s").alias("key_frame"), F.coalesce("frames", F.array().cast(normal.schema["frames"].dataType)).alias("frames"), F.lit(True).alias("black"))
    every = normal.unionByName(dark)
    return every.withColumn("scene", (F.row_number().over(Window.partitionBy(*key).orderBy("_at", "black")) - 1).cast("int")).select(*key, "scene", "start", "end", "n_shots", "key_frame", "frames", "black")


def ranked(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Numbers all rows from 1 by `order`: ranges of it are numbered apart and shifted by the counts of those before, so
    that no task sorts all rows. The only window without a key has a row for each range."""
    from ..session import written

    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(df.repartitionByRange(parts, *order).withColumn("_pid", F.spark_partition_id()), "ranked")
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    shifts = counts.select("_pid", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_shift"))
    own = ranged.withColumn("_rn", F.row_number().over(Window.partitionBy("_pid").orderBy(*order)))
    return own.join(F.broadcast(shifts), "_pid").withColumn(name, F.col("_rn") + F.col("_shift")).drop("_pid", "_rn", "_shift")


def decoded_totals(headers: DataFrame, frames: DataFrame, key: list[str], total: str, least: int = 2) -> DataFrame:
    """ST5: headers with `total` lowered to the frames that were decoded; a video with fewer than `least` is an error."""
    counts = frames.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    n = F.least(F.col(total), F.coalesce("_n", F.lit(0))).cast(headers.schema[total].dataType)
    checked = F.when(n >= least, n).otherwise(F.raise_error(F.concat(F.lit("too few frames of "), F.to_json(F.struct(*key)))).cast(headers.schema[total].dataType))
    return headers.join(counts, key, "left").withColumn(total, checked).drop("_n")
