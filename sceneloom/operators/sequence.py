"""Sequence kernels: window functions over rows that are ordered within a key.

Every function takes a DataFrame and the names of its key, order and value columns. Windows are partitioned by
the key (a video), never global. Ties in an order column must be broken by the caller's order columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import gaussian_weights


def _w(key: list[str], *order: str):
    return Window.partitionBy(*key).orderBy(*order)


def numbered(df: DataFrame, key: list[str], order: list[str], name: str = "ord", start: int = 0) -> DataFrame:
    """Dense numbers from `start` within the key."""
    return df.withColumn(name, (F.row_number().over(_w(key, *order)) - 1 + start).cast("int"))


def cut_scores(df: DataFrame, key: list[str], order: str, value: str) -> DataFrame:
    """Adds mafd (change since the row before) and score = clip(min(mafd, |mafd - mafd before|), 0, 100).

    The first row has both 0, so the second row's score is its mafd.
    """
    w = _w(key, order)
    first = df.withColumn("mafd", F.coalesce(F.abs(F.col(value) - F.lag(value).over(w)), F.lit(0.0)))
    jump = F.abs(F.col("mafd") - F.lag("mafd", 1, 0.0).over(w))
    return first.withColumn("score", F.when(F.lag(value).over(w).isNull(), 0.0).otherwise(F.least(F.greatest(F.least("mafd", jump), F.lit(0.0)), F.lit(100.0))))


def cuts(scores: DataFrame, order: str, threshold: float = 10.0) -> DataFrame:
    """A score over the threshold cuts before the frame, which is recorded as the frame before."""
    return scores.filter(F.col("score") >= threshold).withColumn("cut", F.col(order) - 1)


def clean_cuts(df: DataFrame, key: list[str], cut: str, total: str) -> DataFrame:
    """Drops cuts at the edges, and those next to the last kept one: of consecutive cuts every second stays."""
    inside = df.filter((F.col(cut) > 1) & (F.col(cut) < F.col(total))).dropDuplicates([*key, cut])
    run = inside.withColumn("_run", F.col(cut) - F.row_number().over(_w(key, cut)))
    return run.withColumn("_at", F.row_number().over(_w([*key, "_run"], cut)) - 1).filter(F.col("_at") % 2 == 0).drop("_run", "_at")


def islands(df: DataFrame, key: list[str], order: str, flag: Column | None = None, most: dict[str, str] | None = None) -> DataFrame:
    """Runs of consecutive integers in `order` (where the flag holds): key, start, end, n; and for each name of `most` the
    largest value of its column in the run."""
    rows = df if flag is None else df.filter(flag)
    run = rows.withColumn("_run", F.col(order) - F.row_number().over(_w(key, order)))
    return run.groupBy(*key, "_run").agg(F.min(order).alias("start"), F.max(order).alias("end"), F.count(F.lit(1)).cast("int").alias("n"), *[F.max(c).alias(name) for name, c in (most or {}).items()]).drop("_run")


def dark_runs(df: DataFrame, key: list[str], order: str, dark: Column, least: int, total: str | None = None) -> DataFrame:
    """Runs of dark frames with at least `least` frames; end is inclusive, end_excl exclusive.

    total: the column with the video's number of frames, the same in all its rows. With it, a run is measured as the frame-by-frame analysis does
    it: one that is still open at the video's end has its last frame for its end and must be longer by one; end_written is
    the end that the analysis writes, exclusive, but inclusive for such a run.
    """
    if total is None:
        return islands(df, key, order, dark).filter(F.col("n") >= least).withColumn("end_excl", F.col("end") + 1)
    runs = islands(df, key, order, dark, {"_total": total})
    is_last = F.col("end") == F.col("_total") - 1
    written = F.when(is_last, F.col("end")).otherwise(F.col("end") + 1)
    return runs.withColumns({"end_excl": F.col("end") + 1, "end_written": written}).filter(F.col("end_written") - F.col("start") >= least).drop("_total")


def shots(frames: DataFrame, cut_rows: DataFrame, dark: DataFrame, key: list[str], total: str = "total") -> DataFrame:
    """Shots from cuts and dark runs: key, shot, start, end.

    frames: (key, total); cut_rows: (key, cut), a cut begins a shot; dark: (key, start, end), both inclusive.
    A shot begins at 0, at each cut that isn't the last frame of a dark run, at each dark run without a cut
    strictly inside, and behind each dark run.
    """
    cut_rows = cut_rows.select(*key, F.col("cut").alias("b")).filter("b > 0")
    runs = dark.select(*key, F.col("start").alias("d0"), F.col("end").alias("d1"))
    ends = runs.select(*key, F.col("d1").alias("b"))
    from_cuts = cut_rows.join(ends, [*key, "b"], "left_anti")
    within = cut_rows.withColumnRenamed("b", "c")
    cut_inside = runs.join(within, key).filter((F.col("c") > F.col("d0")) & (F.col("c") < F.col("d1"))).select(*key, "d0", "d1").distinct()
    starts = runs.join(cut_inside, [*key, "d0", "d1"], "left_anti").select(*key, F.col("d0").alias("b"))
    behind = runs.select(*key, (F.col("d1") + 1).alias("b"))
    points = frames.select(*key, F.lit(0).alias("b")).unionByName(from_cuts).unionByName(starts).unionByName(behind).distinct()
    bounded = points.join(frames.select(*key, total), key).filter(F.col("b") < F.col(total))
    w = _w(key, "b")
    return bounded.select(*key, (F.row_number().over(w) - 1).alias("shot"), F.col("b").alias("start"), (F.coalesce(F.lead("b").over(w), F.col(total)) - 1).cast("int").alias("end"))


def forward_target(df: DataFrame, key: list[str], order: str, skip: Column, name: str = "target") -> DataFrame:
    """The order value of the next row that isn't skipped, the row itself included; null at the end."""
    # backwards, so that one pass does: frames that reach to the end are worked out anew for each row
    back = Window.partitionBy(*key).orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(F.when(~skip, F.col(order)), ignorenulls=True).over(back))


def runs_of_equal(df: DataFrame, key: list[str], order: list[str], same: list[str], name: str = "run") -> DataFrame:
    """Numbers runs of rows that agree in `same`."""
    w = _w(key, *order)
    row, before = F.struct(*same), F.lag(F.struct(*same)).over(w)
    changed = F.when(before.isNull() | ~row.eqNullSafe(before), 1).otherwise(0)
    return df.withColumn("_changed", changed).withColumn(name, F.sum("_changed").over(w).cast("int")).drop("_changed")


def squash_runs(df: DataFrame, key: list[str], order: list[str], same: list[str], end: str, least: int = 3) -> DataFrame:
    """A run of at least `least` equal rows becomes its first row with the last one's end; shorter runs stay."""
    run = runs_of_equal(df, key, order, same, "_run")
    whole = Window.partitionBy(*key, "_run")
    marked = run.withColumns(
        {
            "_n": F.count(F.lit(1)).over(whole),
            "_rn": F.row_number().over(_w([*key, "_run"], *order)),
            "_end": F.last(end).over(_w([*key, "_run"], *order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        }
    )
    kept = marked.filter((F.col("_n") < least) | (F.col("_rn") == 1))
    return kept.withColumn(end, F.when(F.col("_n") >= least, F.col("_end")).otherwise(F.col(end))).drop("_run", "_n", "_rn", "_end")


def first_appearance_labels(df: DataFrame, key: list[str], order: str, who: str, unknown=None, name: str = "label") -> DataFrame:
    """A, B, .. by first appearance, then `S<who>`; unknown speakers are `?`."""
    known = F.col(who).isNotNull() if unknown is None else F.col(who).isNotNull() & (F.col(who) != unknown)
    firsts = df.filter(known).groupBy(*key, who).agg(F.min(order).alias("_first"))
    ranked = firsts.withColumn("_rank", F.row_number().over(_w(key, "_first"))).withColumn(name, F.when(F.col("_rank") <= 26, F.chr(F.col("_rank") + 64)).otherwise(F.concat(F.lit("S"), F.col(who).cast("string"))))
    return df.join(ranked.drop("_first", "_rank"), [*key, who], "left").withColumn(name, F.coalesce(name, F.lit("?")))


def absorb_short(df: DataFrame, key: list[str], order: str, same: list[str], text: str, end: str, most: int = 2) -> DataFrame:
    """Rows of at most `most` characters with the same speaker and language as the row before join it."""
    w = _w(key, order)
    before = F.lag(F.struct(*same)).over(w)
    opens = before.isNull() | (F.char_length(text) > most) | ~F.struct(*same).eqNullSafe(before)
    grouped = df.withColumn("_opens", F.when(opens, 1).otherwise(0)).withColumn("_g", F.sum("_opens").over(w))
    parts = F.sort_array(F.collect_list(F.struct(order, text)))
    return grouped.groupBy(*key, "_g", *same).agg(F.min(order).alias(order), F.array_join(F.transform(parts, lambda p: p[text]), "").alias(text), F.max_by(end, order).alias(end)).drop("_g")


def chunked(df: DataFrame, start: str, end: str, width: int) -> DataFrame:
    """Spans cut into pieces of `width`; the last piece ends with the span."""
    n = F.greatest(F.ceil((F.col(end) - F.col(start)) / width).cast("int"), F.lit(1))
    pieces = df.withColumn("chunk", F.explode(F.sequence(F.lit(0), n - 1)))
    return pieces.withColumns({"chunk_start": F.col(start) + F.col("chunk") * width, "chunk_end": F.least(F.col(start) + (F.col("chunk") + 1) * width, F.col(end))})


def interpolated(df: DataFrame, start: str, end: str, parts: str) -> DataFrame:
    """A row for each part of an array of texts, with times by its place in characters, truncated."""
    total = F.aggregate(parts, F.lit(0), lambda s, p: s + F.char_length(p))
    before = lambda i: F.aggregate(F.slice(F.col(parts), 1, i), F.lit(0), lambda s, p: s + F.char_length(p))
    rows = df.withColumn("_total", total).select("*", F.posexplode(parts).alias("part", "part_text"))
    at = lambda n: F.col(start) + ((F.col(end) - F.col(start)) * n / F.col("_total")).cast("long")
    with_pos = rows.withColumns({"_a": before(F.col("part")), "_n": F.char_length("part_text")})
    return with_pos.withColumns({"part_start": at(F.col("_a")), "part_end": at(F.col("_a") + F.col("_n"))}).drop("_total", "_a", "_n")


def gaussian_smooth(df: DataFrame, key: list[str], order: str, value: str, sigma: float = 3.0, name: str = "smooth") -> DataFrame:
    """Weighted mean over 4 sigma on both sides; beyond the edges the edge's value counts."""
    w, whole = _w(key, order), _w(key, order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weights = gaussian_weights(sigma)
    r = len(weights) // 2
    rows = df.withColumns({"_head": F.first(value).over(whole), "_tail": F.last(value).over(whole)})
    terms = []
    for i, weight in enumerate(weights):
        k = i - r
        x = F.col(value) if k == 0 else F.coalesce(F.lead(value, k).over(w), F.col("_tail")) if k > 0 else F.coalesce(F.lag(value, -k).over(w), F.col("_head"))
        terms.append(x * weight)
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return rows.withColumn(name, total).drop("_head", "_tail")


def stable_regions(df: DataFrame, key: list[str], order: str, value: str, min_stable: int, percent: int = 35, merge_gap: int = 3) -> DataFrame:
    """Runs of smoothed values under the order statistic int(percent * n / 100), at least min_stable long,
    joined over gaps of at most merge_gap; without one, a window around the least value. key, start, end."""
    rows = numbered(df, key, [order], "_i")
    smooth = gaussian_smooth(rows, key, "_i", value, name="_s")
    ranked = smooth.withColumns({"_rank": F.row_number().over(_w(key, "_s", "_i")) - 1, "_n": F.count(F.lit(1)).over(Window.partitionBy(*key))})
    limits = ranked.filter(F.col("_rank") == F.floor(F.col("_n") * percent / 100)).select(*key, F.col("_s").alias("_limit"))
    runs = islands(ranked.join(limits, key), key, "_i", F.col("_s") < F.col("_limit")).filter(F.col("n") >= min_stable)
    gap = F.col("start") - F.lag("end").over(_w(key, "start"))
    joined = runs.withColumn("_new", F.when(gap <= merge_gap, 0).otherwise(1)).withColumn("_g", F.sum("_new").over(_w(key, "start")))
    regions = joined.groupBy(*key, "_g").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_g")
    half = max(1, min_stable // 2)
    least = rows.groupBy(*key).agg(F.min_by("_i", F.struct(value, "_i")).alias("_best"), F.count(F.lit(1)).alias("_n"))
    fallback = least.join(regions.select(*key).distinct(), key, "left_anti").select(
        *key, F.greatest(F.lit(0), F.col("_best") - half).cast("int").alias("start"), F.least(F.col("_n") - 1, F.col("_best") + half).cast("int").alias("end")
    )
    return regions.unionByName(fallback)


def most_key_frames(seconds: Column) -> Column:
    """W17."""
    return F.when(seconds < 2, 2).when(seconds < 30, 4).otherwise(8)


def kept_regions(regions: DataFrame, values: DataFrame, key: list[str], order: str, value: str, fps: float, still: float = 0.5) -> DataFrame:
    """The first regions in time, as many as the length allows; of a still shot only the one with the
    least value, or else the longest."""
    rows = numbered(values, key, [order], "_i")
    facts = rows.withColumns({"_rank": F.row_number().over(_w(key, value, "_i")) - 1, "_n": F.count(F.lit(1)).over(Window.partitionBy(*key))})
    facts = facts.groupBy(*key).agg(
        F.max("_n").alias("_n"), F.max(F.when(F.col("_rank") == F.floor(F.col("_n") / 2), F.col(value))).alias("_median"), F.max(F.when(F.col("_rank") == 0, F.col("_i"))).alias("_least")
    )
    cut = regions.join(facts, key).withColumn("_rn", F.row_number().over(_w(key, "start"))).filter(F.col("_rn") <= most_key_frames((F.col("_n") + 1) / fps))
    holds = (F.col("_least") >= F.col("start")) & (F.col("_least") <= F.col("end"))
    choice = F.row_number().over(Window.partitionBy(*key).orderBy(holds.cast("int").desc(), (F.col("end") - F.col("start")).desc(), "start"))
    return cut.withColumn("_choice", choice).filter((F.col("_median") >= still) | (F.col("_choice") == 1)).select(*key, "start", "end")


def key_frames(regions: DataFrame, values: DataFrame, key: list[str], order: str, value: str, centre: int = 15) -> DataFrame:
    """Of each region the best scored frame within `centre` of its least value; the best of a key is its
    representative. values carry sharpness, entropy, bright and tout."""
    from ..functions.numeric import key_frame_score

    rows = numbered(values, key, [order], "_i")
    r = regions.withColumnRenamed("start", "_from").withColumnRenamed("end", "_to")
    zone = rows.join(r, key).filter((F.col("_i") >= F.col("_from")) & (F.col("_i") <= F.col("_to")))
    region = Window.partitionBy(*key, "_from")
    zone = zone.withColumns({"_least": F.min_by("_i", F.struct(value, "_i")).over(region), "_most": F.greatest(F.max(value).over(region), F.lit(1e-9))})
    near = zone.filter(F.abs(F.col("_i") - F.col("_least")) <= centre)
    top = lambda c: F.when(F.max(c).over(region) < 1e-9, 1.0).otherwise(F.max(c).over(region))
    scored = near.withColumn("kf_score", key_frame_score(1 - F.least(value, "_most") / F.col("_most"), F.col("sharpness"), F.col("entropy"), F.col("bright"), F.col("tout"), top("sharpness"), top("entropy")))
    best = scored.withColumn("_rn", F.row_number().over(Window.partitionBy(*key, "_from").orderBy(F.col("kf_score").desc(), "_i"))).filter("_rn = 1")
    rep = F.row_number().over(Window.partitionBy(*key).orderBy(F.col("kf_score").desc(), order)) == 1
    return best.select(*key, F.col(order).alias("key_frame"), "kf_score", rep.alias("representative"))


def intervals_of(df: DataFrame, key: list[str], item: str, gap_max: int = 3) -> DataFrame:
    """Distinct items joined into intervals while they are at most gap_max + 1 apart: start, end, n."""
    rows = df.select(*key, item).distinct()
    apart = F.col(item) - F.lag(item).over(_w(key, item))
    grouped = rows.withColumn("_new", F.when(apart <= gap_max + 1, 0).otherwise(1)).withColumn("_g", F.sum("_new").over(_w(key, item)))
    return grouped.groupBy(*key, "_g").agg(F.min(item).alias("start"), F.max(item).alias("end"), F.count(F.lit(1)).cast("int").alias("n")).drop("_g")


def batches(df: DataFrame, key: list[str], order: str, same: str, breaks: Column, most: int = 5) -> DataFrame:
    """Numbers batches of at most `most` neighbouring rows that agree; breaking rows end a batch and go."""
    w = _w(key, order)
    rows = df.withColumn("_breaks", F.sum(F.when(breaks, 1).otherwise(0)).over(w)).filter(~breaks)
    run = runs_of_equal(rows, key, [order], ["_breaks", same], "_run")
    part = run.withColumn("_part", F.floor((F.row_number().over(_w([*key, "_run"], order)) - 1) / most))
    return part.withColumn("batch", (F.dense_rank().over(_w(key, "_run", "_part")) - 1).cast("int")).drop("_breaks", "_run", "_part")


def unique_shots(df: DataFrame, key: list[str], order: str, close: str) -> DataFrame:
    """N frames of a chain, how many differ, and its class (valid from 3, merged if all are one).

    `close` is null for frames without an embedding; with fewer than two that have one, all frames count as different.
    """
    w = _w(key, order)
    was = F.lag(close).over(w)
    rows = df.withColumn("_new", F.when(F.row_number().over(w) == 1, 0).when(F.col(close) & was, 0).otherwise(1))
    out = rows.groupBy(*key).agg(F.count(F.lit(1)).cast("int").alias("raw"), F.bool_and(close).alias("_all"), F.sum("_new").alias("_n"), F.count(close).alias("_known"))
    out = out.withColumn("uniq", F.when(F.col("_known") < 2, F.col("raw")).when(F.col("_all"), 1).otherwise(F.col("_n") + 1).cast("int"))
    kind = F.when((F.col("uniq") == 1) & (F.col("raw") > 1), "merged").when(F.col("uniq") >= 3, "valid").otherwise("short")
    return out.select(*key, "raw", "uniq", kind.alias("kind"))


def offsets(df: DataFrame, order: str, n: str, name: str = "offset", key: list[str] | None = None) -> DataFrame:
    """The sum of n over all rows before. A row is a video; without a key all of them stand in one order."""
    return df.withColumn(name, F.coalesce(F.sum(n).over(_w(key or [], order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def chapters(boundaries: DataFrame, key: list[str], boundary: str, total: str) -> DataFrame:
    """Chapters between boundaries: key, chapter, start, end, size."""
    points = boundaries.select(*key, F.col(boundary).alias("b"), total).filter((F.col("b") > 0) & (F.col("b") < F.col(total)))
    all_points = points.union(boundaries.select(*key, F.lit(0).alias("b"), total)).distinct()
    w = _w(key, "b")
    return all_points.select(*key, (F.row_number().over(w) - 1).cast("int").alias("chapter"), F.col("b").alias("start"), (F.coalesce(F.lead("b").over(w), F.col(total)) - 1).cast("int").alias("end")).withColumn("size", (F.col("end") - F.col("start") + 1).cast("int"))


def merge_small_chapters(rows: DataFrame, key: list[str], least: int = 5) -> DataFrame:
    """Chapters of fewer than `least` join the one before; a small first one stays. rows: chapters()."""
    kept = rows.filter((F.col("chapter") == 0) | (F.col("size") >= least))
    last = rows.groupBy(*key).agg(F.max("end").alias("_last"))
    w = _w(key, "start")
    out = kept.join(last, key).withColumn("end", F.coalesce(F.lead("start").over(w) - 1, F.col("_last")).cast("int"))
    return out.select(*key, (F.row_number().over(w) - 1).cast("int").alias("chapter"), "start", "end", (F.col("end") - F.col("start") + 1).cast("int").alias("size"))


def split_columns(df: DataFrame, key: list[str], order: list[str], n: int = 4) -> DataFrame:
    """N columns of nearly equal length, the first ones longer by one."""
    return df.withColumn("col_no", F.ntile(n).over(_w(key, *order)))


def continuity(df: DataFrame, key: list[str], order: str, persons: str) -> DataFrame:
    """Does a row share a person with the one before?"""
    return df.withColumn("linked", F.coalesce(F.arrays_overlap(F.col(persons), F.lag(persons).over(_w(key, order))), F.lit(False)))
