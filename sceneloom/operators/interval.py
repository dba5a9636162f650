"""Interval kernels: point-in-range, overlap, nearest and as-of joins, clipping, onion cuts.

Range conditions get an integer bucket as an equi-key, so that the joins are hash or merge joins by (key, bucket)
and never nested loops. A bucket is `width` wide: an interval stands in each bucket that it touches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _bucket(c: Column, width: int) -> Column:
    return F.floor(c / width).cast("long")


def _until(key: list[str], last: int):
    """Rows by (_t, _kind) up to the current one, or the one before."""
    return Window.partitionBy(*key).orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, last)


def _behind(key: list[str]):
    """Rows behind the current one, nearest last: run backwards, as frames that reach to the end cost a pass for
    each row."""
    return Window.partitionBy(*key).orderBy(F.col("_t").desc(), F.col("_kind").desc()).rowsBetween(Window.unboundedPreceding, -1)


def in_buckets(intervals: DataFrame, start: str, end: str, width: int) -> DataFrame:
    return intervals.withColumn("_bucket", F.explode(F.sequence(_bucket(F.col(start), width), _bucket(F.col(end), width))))


def points_in_intervals(points: DataFrame, intervals: DataFrame, key: list[str], at: str, start: str, end: str, width: int = 1000) -> DataFrame:
    """All pairs of a point and an interval of the same key with start <= at <= end."""
    left = points.withColumn("_bucket", _bucket(F.col(at), width))
    right = in_buckets(intervals.filter(F.col(start) <= F.col(end)), start, end, width)
    return left.join(right, [*key, "_bucket"]).filter((F.col(at) >= F.col(start)) & (F.col(at) <= F.col(end))).drop("_bucket")


def first_interval(points: DataFrame, intervals: DataFrame, key: list[str], point_id: str, at: str, start: str, end: str, order: str, value: str, width: int = 1000) -> DataFrame:
    """Of the intervals that hold a point the value of the first by `order`; null without one."""
    found = points_in_intervals(points.select(*key, point_id, at), intervals.select(*key, start, end, order, value), key, at, start, end, width)
    best = found.groupBy(*key, point_id).agg(F.min_by(value, order).alias(value))
    return points.join(best, [*key, point_id], "left")


def nearest_interval(points: DataFrame, intervals: DataFrame, key: list[str], point_id: str, at: str, start: str, end: str, value: str) -> DataFrame:
    """The interval that holds a point, or else the one whose edge is nearest; first ones on ties.

    Intervals of a key must not overlap and stand in order of time (shots do), so that the nearest edge is that of
    the last interval that begins before the point or of the next one: two as-of lookups, no theta join.
    """
    ordered = intervals.withColumn("_v", F.struct(F.col(start).alias("s"), F.col(end).alias("e"), F.col(value).alias("v")))
    both = points.select(*key, F.col(at).alias("_t"), F.lit(1).alias("_kind"), F.col(point_id).alias("_id"), F.lit(None).cast(ordered.schema["_v"].dataType).alias("_v")).unionByName(
        ordered.select(*key, F.col(start).alias("_t"), F.lit(0).alias("_kind"), F.lit(None).cast(points.schema[point_id].dataType).alias("_id"), "_v")
    )
    near = both.withColumns({"_b": F.last("_v", True).over(_until(key, 0)), "_a": F.last("_v", True).over(_behind(key))}).filter("_kind = 1")
    dist = lambda v: F.least(F.abs(v["s"] - F.col("_t")), F.abs(v["e"] - F.col("_t")))
    before, after = F.col("_b"), F.col("_a")
    inside = before.isNotNull() & (before["e"] >= F.col("_t"))
    pick = F.when(inside, before["v"]).when(before.isNull(), after["v"]).when(after.isNull(), before["v"]).when(dist(before) <= dist(after), before["v"]).otherwise(after["v"])
    return points.join(near.select(*key, F.col("_id").alias(point_id), pick.alias(value)), [*key, point_id], "left")


def overlapping(a: DataFrame, b: DataFrame, key: list[str], a_span: tuple[str, str], b_span: tuple[str, str], width: int = 1000) -> DataFrame:
    """All pairs of intervals of a key that overlap (both ends inclusive), each once."""
    left, right = in_buckets(a, *a_span, width), in_buckets(b, *b_span, width)
    met = (F.col(a_span[0]) <= F.col(b_span[1])) & (F.col(b_span[0]) <= F.col(a_span[1]))
    # a pair meets first in the bucket where the later of the two begins
    once = F.col("_bucket") == _bucket(F.greatest(a_span[0], b_span[0]), width)
    return left.join(right, [*key, "_bucket"]).filter(met & once).drop("_bucket")


def as_of(points: DataFrame, events: DataFrame, key: list[str], at: str, event_at: str, value: str, strict: bool = True, forward: bool = False, name: str = "value") -> DataFrame:
    """For each point the value of the nearest event before it (strictly, by default), or after it."""
    kind = points.schema[at].dataType
    p = points.withColumns({"_t": F.col(at), "_kind": F.lit(0 if strict != forward else 1), "_v": F.lit(None).cast(f"struct<v:{events.schema[value].dataType.simpleString()}>")})
    e = events.select(*key, F.col(event_at).cast(kind).alias("_t"), F.lit(1 if strict != forward else 0).alias("_kind"), F.struct(F.col(value).alias("v")).alias("_v"))
    both = p.withColumn("_p", F.lit(True)).unionByName(e, allowMissingColumns=True)
    look = F.last("_v", True).over(_behind(key) if forward else _until(key, -1))
    return both.withColumn(name, look["v"]).filter("_p").drop("_t", "_kind", "_v", "_p")


def clipped(df: DataFrame, start: str, end: str, total: Column) -> DataFrame:
    """Intervals within [0, total); those outside go."""
    inside = df.filter((F.col(end) >= 0) & (F.col(start) < total))
    return inside.withColumns({start: F.greatest(F.col(start), F.lit(0)), end: F.least(F.col(end), total - 1)})


def onion_cuts(intervals: DataFrame, key: list[str], person: str, start: str = "start", end: str = "end") -> DataFrame:
    """Cuts at each interval's start and behind its end; a cut strictly inside (or at the end of) an interval goes
    if any of its makers is longer in total than that interval's person. key, cut."""
    totals = intervals.groupBy(*key, person).agg(F.sum(F.col(end) - F.col(start) + 1).alias("_total"))  # A12
    spans = intervals.select(*key, person, F.col(start).alias("s"), F.col(end).alias("e")).join(totals, [*key, person])
    made = spans.select(*key, F.col("s").alias("cut"), "_total").unionByName(spans.select(*key, (F.col("e") + 1).alias("cut"), "_total"))
    cuts = made.groupBy(*key, "cut").agg(F.max("_total").alias("_longest"))
    hit = points_in_intervals(cuts, spans.select(*key, (F.col("s") + 1).alias("_s"), F.col("e").alias("_e"), F.col("_total").alias("_own")), key, "cut", "_s", "_e", 64)
    gone = hit.filter(F.col("_longest") > F.col("_own")).select(*key, "cut").distinct()
    return cuts.select(*key, "cut").join(gone, [*key, "cut"], "left_anti")


def segments_between(cuts: DataFrame, totals: DataFrame, key: list[str], total: str = "total") -> DataFrame:
    """Segments between cuts, 0 and the total: key, seg, start, end."""
    points = cuts.join(totals, key).filter((F.col("cut") > 0) & (F.col("cut") < F.col(total))).select(*key, "cut", total)
    every = points.unionByName(totals.select(*key, F.lit(0).alias("cut"), total)).distinct()
    w = Window.partitionBy(*key).orderBy("cut")
    return every.select(*key, (F.row_number().over(w) - 1).cast("int").alias("seg"), F.col("cut").alias("start"), (F.coalesce(F.lead("cut").over(w), F.col(total)) - 1).alias("end"))


def nearest_unused(wanted: DataFrame, have: DataFrame, key: list[str], want: str, at: str) -> DataFrame:
    """For each wanted frame the nearest candidate; of those that share one only the first is kept."""
    w = wanted.select(*key, F.col(want).alias("_t"), F.lit(1).alias("_kind"))
    h = have.select(*key, F.col(at).alias("_t"), F.lit(0).alias("_kind"))
    own = F.when(F.col("_kind") == 0, F.col("_t"))
    at_or_before, after = F.last(own, True).over(_until(key, 0)), F.last(own, True).over(_behind(key))
    near = w.unionByName(h).withColumns({"_b": at_or_before, "_a": after}).filter("_kind = 1")
    pick = F.when(F.col("_b").isNull(), F.col("_a")).when(F.col("_a").isNull() | (F.col("_t") - F.col("_b") <= F.col("_a") - F.col("_t")), F.col("_b")).otherwise(F.col("_a"))
    found = near.withColumn(at, pick).filter(F.col(at).isNotNull())
    first = F.row_number().over(Window.partitionBy(*key, at).orderBy("_t"))
    return found.withColumn("_rn", first).filter("_rn = 1").select(*key, F.col("_t").alias(want), at)


def local_scenes(rows: DataFrame, videos: DataFrame, order: str, n: str, start: str, end: str) -> DataFrame:
    """Intervals of global scene numbers, cut at the borders of videos and counted from each video's start.

    videos: (order, n), one row for each video; rows of `rows` may span several.
    """
    from .sequence import offsets

    placed = offsets(videos.select(F.col(order), F.col(n)), order, n, "_off").withColumn("_last", F.col("_off") + F.col(n) - 1)
    width = 64
    hits = in_buckets(rows, start, end, width).join(in_buckets(placed.filter(F.col(n) > 0), "_off", "_last", width), "_bucket")
    hits = hits.filter((F.col(start) <= F.col("_last")) & (F.col(end) >= F.col("_off")) & (F.col("_bucket") == _bucket(F.greatest(start, "_off"), width)))
    return hits.withColumns({start: F.greatest(F.col(start), F.col("_off")) - F.col("_off"), end: F.least(F.col(end), F.col("_last")) - F.col("_off")}).drop("_bucket", "_off", "_last", n)
