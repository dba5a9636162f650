"""Queries of the sequence kernels over events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import text as X
from ..operators import folds, sequence
from .base import FRAMES_SQL, frames, query, table

SCORE_SQL = """m AS (SELECT *, coalesce(abs(value - lag(value) OVER w), 0.0) AS mafd, lag(value) OVER w AS pv FROM fr WINDOW w AS (PARTITION BY video ORDER BY frame)),
sc AS (SELECT *, CASE WHEN pv IS NULL THEN 0.0 ELSE least(greatest(least(mafd, abs(mafd - lag(mafd, 1, 0.0) OVER (PARTITION BY video ORDER BY frame))), 0.0), 100.0) END AS score FROM m)"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.cut_scores(frames(spark, sf_dir), ["video"], "frame", "value")


@query("w1_cut_score", f"WITH {{fr}}, {SCORE_SQL} SELECT video, frame, round(mafd, 6) AS mafd, round(score, 6) AS score FROM sc")
def w1_cut_score(spark, sf_dir):
    return scored(spark, sf_dir).select("video", "frame", F.round("mafd", 6).alias("mafd"), F.round("score", 6).alias("score"))


@query("p1_cuts", f"WITH {{fr}}, {SCORE_SQL} SELECT video, frame - 1 AS cut FROM sc WHERE score >= 50")
def p1_cuts(spark, sf_dir):
    return sequence.cuts(scored(spark, sf_dir), "frame", 50).select("video", "cut")


CLEAN_SQL = f"""{SCORE_SQL}, c AS (SELECT video, frame - 1 AS cut, total FROM sc WHERE score >= 25 AND frame - 1 > 1 AND frame - 1 < total),
r AS (SELECT *, cut - row_number() OVER (PARTITION BY video ORDER BY cut) AS run FROM c),
k AS (SELECT *, row_number() OVER (PARTITION BY video, run ORDER BY cut) - 1 AS a FROM r)"""


@query("p2_cut_cleanup", f"WITH {{fr}}, {CLEAN_SQL} SELECT video, cut FROM k WHERE a % 2 = 0")
def p2_cut_cleanup(spark, sf_dir):
    return sequence.clean_cuts(sequence.cuts(scored(spark, sf_dir), "frame", 25), ["video"], "cut", "total").select("video", "cut")


RUNS_SQL = """dk AS (SELECT video, frame, frame - row_number() OVER (PARTITION BY video ORDER BY frame) AS run FROM fr WHERE value < 20),
runs AS (SELECT video, min(frame) AS "start", max(frame) AS "end", CAST(count(*) AS INTEGER) AS n FROM dk GROUP BY video, run HAVING count(*) >= {n})"""


def dark(spark, sf_dir, least=3):
    return sequence.dark_runs(frames(spark, sf_dir), ["video"], "frame", F.col("value") < 20, least)


@query(
    "w2_dark_runs",
    """WITH {fr}, dk AS (SELECT video, frame, total, frame - row_number() OVER (PARTITION BY video ORDER BY frame) AS run FROM fr WHERE value < 20),
r AS (SELECT video, min(frame) AS s, max(frame) AS e, max(frame) = max(total) - 1 AS last FROM dk GROUP BY video, run)
SELECT video, s AS "start", e AS "end", CAST(e - s + 1 AS INTEGER) AS n, e + 1 AS end_excl, CASE WHEN last THEN e ELSE e + 1 END AS end_written FROM r WHERE CASE WHEN last THEN e - s >= 2 ELSE e + 1 - s >= 2 END""",
)
def w2_dark_runs(spark, sf_dir):
    """A run that reaches the end of its video is measured without its last frame."""
    return sequence.dark_runs(frames(spark, sf_dir), ["video"], "frame", F.col("value") < 20, 2, "total")


@query("w4_islands", f'WITH {{fr}}, {RUNS_SQL.replace("{n}", "1")} SELECT * FROM runs')
def w4_islands(spark, sf_dir):
    return sequence.islands(frames(spark, sf_dir), ["video"], "frame", F.col("value") < 20)


@query(
    "w3_union_runs",
    f"""WITH {{fr}}, {RUNS_SQL.replace("{n}", "3")}, f AS (SELECT fr.video, fr.frame FROM fr JOIN runs ON fr.video = runs.video AND fr.frame BETWEEN runs."start" AND runs."end"
UNION SELECT video, frame FROM fr WHERE value < 1), g AS (SELECT *, frame - row_number() OVER (PARTITION BY video ORDER BY frame) AS run FROM f)
SELECT video, min(frame) AS "start", max(frame) AS "end", CAST(count(*) AS INTEGER) AS n FROM g GROUP BY video, run""",
)
def w3_union_runs(spark, sf_dir):
    """Frames of long dark runs and very dark frames, as runs."""
    runs = dark(spark, sf_dir).select("video", F.explode(F.sequence("start", "end")).alias("frame"))
    very = frames(spark, sf_dir).filter("value < 1").select("video", "frame")
    return sequence.islands(runs.union(very).distinct(), ["video"], "frame")


SHOTS_SQL = f"""{SCORE_SQL}, {RUNS_SQL.replace("{n}", "2")},
cu AS (SELECT video, frame - 1 AS cut FROM sc WHERE score >= 40), t AS (SELECT DISTINCT video, total FROM fr),
b AS (SELECT video, 0 AS b FROM t UNION SELECT video, cut FROM cu WHERE cut > 0 AND NOT EXISTS (SELECT 1 FROM runs r WHERE r.video = cu.video AND r."end" = cu.cut)
 UNION SELECT video, "start" FROM runs r WHERE NOT EXISTS (SELECT 1 FROM cu WHERE cu.video = r.video AND cu.cut > r."start" AND cu.cut < r."end") UNION SELECT video, "end" + 1 FROM runs),
shots AS (SELECT b.video, row_number() OVER w - 1 AS shot, b.b AS "start", coalesce(lead(b.b) OVER w, t.total) - 1 AS "end" FROM b JOIN t USING (video) WHERE b.b < t.total WINDOW w AS (PARTITION BY b.video ORDER BY b.b))"""


def shots(spark, sf_dir):
    fr = frames(spark, sf_dir)
    return sequence.shots(fr.select("video", "total").distinct(), sequence.cuts(scored(spark, sf_dir), "frame", 40).select("video", "cut"), dark(spark, sf_dir, 2), ["video"])


@query("w5_shots", f'WITH {{fr}}, {SHOTS_SQL} SELECT CAST(video AS BIGINT) AS video, CAST(shot AS INTEGER) AS shot, "start", CAST("end" AS INTEGER) AS "end" FROM shots')
def w5_shots(spark, sf_dir):
    return shots(spark, sf_dir)


@query("w6_forward_target", "WITH {fr} SELECT video, frame, min(CASE WHEN value >= 20 THEN frame END) OVER (PARTITION BY video ORDER BY frame ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS target FROM fr")
def w6_forward_target(spark, sf_dir):
    return sequence.forward_target(frames(spark, sf_dir), ["video"], "frame", F.col("value") < 20).select("video", "frame", "target")


RLE_SQL = """ch AS (SELECT *, CASE WHEN lag(kind) OVER w IS DISTINCT FROM kind THEN 1 ELSE 0 END AS c FROM fr WINDOW w AS (PARTITION BY video ORDER BY frame)),
g AS (SELECT *, sum(c) OVER (PARTITION BY video ORDER BY frame) AS run FROM ch)"""


@query(
    "w7_rle_squash",
    f"""WITH {{fr}}, {RLE_SQL}, s AS (SELECT *, count(*) OVER (PARTITION BY video, run) AS n, row_number() OVER (PARTITION BY video, run ORDER BY frame) AS rn, max(ms) OVER (PARTITION BY video, run) AS last_ms FROM g)
SELECT video, frame, kind, CASE WHEN n >= 3 THEN last_ms ELSE ms END AS end_ms FROM s WHERE n < 3 OR rn = 1""",
)
def w7_rle_squash(spark, sf_dir):
    rows = frames(spark, sf_dir).withColumn("end_ms", F.col("ms"))
    return sequence.squash_runs(rows, ["video"], ["frame"], ["kind"], "end_ms").select("video", "frame", "kind", "end_ms")


@query(
    "w8_first_labels",
    """WITH {fr}, f AS (SELECT video, kind, min(frame) AS first FROM fr WHERE kind <> 'view' GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY video ORDER BY first) AS k FROM f)
SELECT fr.video, fr.frame, coalesce(chr(CAST(64 + k AS INTEGER)), '?') AS label FROM fr LEFT JOIN r ON fr.video = r.video AND fr.kind = r.kind""",
)
def w8_first_labels(spark, sf_dir):
    return sequence.first_appearance_labels(frames(spark, sf_dir), ["video"], "frame", "kind", "view").select("video", "frame", "label")


@query(
    "w9_absorb",
    """WITH {fr}, t AS (SELECT *, CASE WHEN value < 50 THEN 'ah' ELSE 'word' || frame END AS txt FROM fr),
o AS (SELECT *, CASE WHEN length(txt) > 2 OR lag(kind) OVER w IS DISTINCT FROM kind THEN 1 ELSE 0 END AS c FROM t WINDOW w AS (PARTITION BY video ORDER BY frame)),
g AS (SELECT *, sum(c) OVER (PARTITION BY video ORDER BY frame) AS grp FROM o)
SELECT video, kind, min(frame) AS frame, string_agg(txt, '' ORDER BY frame) AS txt, max(ms) AS end_ms FROM g GROUP BY video, grp, kind""",
)
def w9_absorb(spark, sf_dir):
    rows = frames(spark, sf_dir).withColumns({"txt": F.when(F.col("value") < 50, "ah").otherwise(F.concat(F.lit("word"), F.col("frame").cast("string"))), "end_ms": F.col("ms")})
    return sequence.absorb_short(rows, ["video"], "frame", ["kind"], "txt", "end_ms")


def turns(spark, sf_dir):
    return frames(spark, sf_dir).select("video", "frame", "kind", F.col("ms").alias("start_ms"), (F.col("ms") + F.floor(F.col("value")).cast("long") * 1000).alias("end_ms"))


def _fold_sql(condition: str, extra: str = "") -> str:
    return f"""WITH RECURSIVE {FRAMES_SQL}, t AS (SELECT video, frame, kind, ms AS s, ms + CAST(floor(value) AS BIGINT) * 1000 AS e {extra} FROM fr),
f(video, frame, kind, gs, ge, grp) AS (SELECT video, frame, kind, s, e, 0 FROM t WHERE frame = 0 UNION ALL
SELECT t.video, t.frame, t.kind, CASE WHEN {condition} THEN f.gs ELSE t.s END, t.e, CASE WHEN {condition} THEN f.grp ELSE f.grp + 1 END
FROM f JOIN t ON t.video = f.video AND t.frame = f.frame + 1)
SELECT video, frame, CAST(grp AS INTEGER) AS grp FROM f"""


@query("w10_coalesce", _fold_sql("f.kind = t.kind AND t.e - f.gs <= 90000000"))
def w10_coalesce(spark, sf_dir):
    return folds.coalesce_groups(turns(spark, sf_dir), ["video"], ["frame"], "start_ms", "end_ms", "kind", 90_000_000).select("video", "frame", "grp")


@query("w11_turns", _fold_sql("f.kind = t.kind AND t.e - f.gs <= 900000000 AND t.s - f.ge < 20000000 AND f.gs // 864000000 = t.s // 864000000"))
def w11_turns(spark, sf_dir):
    """Same place: the same stretch of ten days, as a shot is for speech."""
    rows = turns(spark, sf_dir).withColumn("place", F.floor(F.col("start_ms") / 864000000).cast("long"))
    return folds.coalesce_groups(rows, ["video"], ["frame"], "start_ms", "end_ms", "kind", 900_000_000, 20_000_000, "place").select("video", "frame", "grp")


@query(
    "w12_chunks",
    """SELECT event_id, CAST(k AS INTEGER) AS chunk, k * 90 AS chunk_start, least((k + 1) * 90, v) AS chunk_end FROM (SELECT event_id, CAST(floor(value) AS BIGINT) AS v, unnest(range(0, greatest(CAST(ceil(floor(value) / 90) AS BIGINT), 1))) AS k FROM events)""",
)
def w12_chunks(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.lit(0).cast("long").alias("s"), F.floor("value").cast("long").alias("e"))
    return sequence.chunked(rows, "s", "e", 90).select("event_id", "chunk", "chunk_start", "chunk_end")


SENTENCES_SQL = r"""list_filter(list_transform(regexp_split_to_array(text, '[，,。！？!?…、；;：:（）()"《》<>【】\[\]]+'), lambda x: regexp_replace(x, '^[ \t\r\n\f\v]+|[ \t\r\n\f\v]+$', '', 'g')), lambda x: x <> '')"""


@query(
    "w13_interpolate",
    f"""WITH s AS (SELECT conv_id, turn, {SENTENCES_SQL} AS p FROM conversations), u AS (SELECT conv_id, turn, unnest(p) AS part_text, generate_subscripts(p, 1) - 1 AS part FROM s),
c AS (SELECT *, length(part_text) AS n, sum(length(part_text)) OVER (PARTITION BY conv_id, turn) AS total, sum(length(part_text)) OVER (PARTITION BY conv_id, turn ORDER BY part) AS cum FROM u)
SELECT conv_id, turn, CAST(part AS INTEGER) AS part, 1000 + CAST(trunc(9000 * (cum - n) / total) AS BIGINT) AS part_start, 1000 + CAST(trunc(9000 * cum / total) AS BIGINT) AS part_end FROM c""",
)
def w13_interpolate(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.lit(1000).cast("long").alias("s"), F.lit(10000).cast("long").alias("e"), X.split_sentences(F.col("text")).alias("parts"))
    return sequence.interpolated(rows, "s", "e", "parts").select("conv_id", "turn", "part", "part_start", "part_end")


_W = N.gaussian_weights()
_SMOOTH = " + ".join(
    f"{w!r} * " + ("value" if i == 12 else f"coalesce(lead(value, {i - 12}) OVER w, last_value(value) OVER z)" if i > 12 else f"coalesce(lag(value, {12 - i}) OVER w, first_value(value) OVER z)") for i, w in enumerate(_W)
)
SMOOTH_SQL = f"sm AS (SELECT *, {_SMOOTH} AS smooth FROM fr WINDOW w AS (PARTITION BY video ORDER BY frame), z AS (PARTITION BY video ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"


@query("w14_smooth", f"WITH {{fr}}, {SMOOTH_SQL} SELECT video, frame, round(smooth, 4) AS smooth FROM sm")
def w14_smooth(spark, sf_dir):
    return sequence.gaussian_smooth(frames(spark, sf_dir), ["video"], "frame", "value").select("video", "frame", F.round("smooth", 4).alias("smooth"))


REGIONS_SQL = f"""{SMOOTH_SQL}, rk AS (SELECT *, row_number() OVER (PARTITION BY video ORDER BY smooth, frame) - 1 AS rk FROM sm), li AS (SELECT video, smooth AS lim FROM rk WHERE rk = CAST(floor(total * 35 / 100) AS INTEGER)),
lo AS (SELECT sm.video, frame, frame - row_number() OVER (PARTITION BY sm.video ORDER BY frame) AS run FROM sm JOIN li ON sm.video = li.video WHERE smooth < lim),
rg AS (SELECT video, min(frame) AS s, max(frame) AS e FROM lo GROUP BY video, run HAVING count(*) >= 4),
rn AS (SELECT *, CASE WHEN s - lag(e) OVER (PARTITION BY video ORDER BY s) <= 3 THEN 0 ELSE 1 END AS nw FROM rg), rm AS (SELECT *, sum(nw) OVER (PARTITION BY video ORDER BY s) AS g FROM rn),
best AS (SELECT video, arg_min(frame, value) AS b, max(total) AS n FROM fr GROUP BY video),
reg AS (SELECT video, min(s) AS s, max(e) AS e FROM rm GROUP BY video, g UNION ALL SELECT video, greatest(0, b - 2), least(n - 1, b + 2) FROM best WHERE video NOT IN (SELECT video FROM rg))"""


@query("w15_stable_regions", f'WITH {{fr}}, {REGIONS_SQL} SELECT video, s AS "start", e AS "end" FROM reg')
def w15_stable_regions(spark, sf_dir):
    return sequence.stable_regions(frames(spark, sf_dir), ["video"], "frame", "value", 4)


def shot_features(spark, sf_dir):
    return frames(spark, sf_dir).withColumns({"sharpness": F.col("value") % 97, "entropy": F.col("value") % 7, "bright": N.brightness_score(F.col("value") / 500), "tout": (F.col("value") % 10) / 100})


KEPT_SQL = f"""{REGIONS_SQL}, st AS (SELECT *, row_number() OVER (PARTITION BY video ORDER BY value, frame) - 1 AS k FROM fr), fa AS (SELECT video, max(total) AS n, max(CASE WHEN k = total // 2 THEN value END) AS med, max(CASE WHEN k = 0 THEN frame END) AS least FROM st GROUP BY video),
cu AS (SELECT reg.*, med, least, row_number() OVER (PARTITION BY reg.video ORDER BY s) AS rn, CASE WHEN (n + 1) / 2.0 < 2 THEN 2 WHEN (n + 1) / 2.0 < 30 THEN 4 ELSE 8 END AS most FROM reg JOIN fa USING (video)),
cx AS (SELECT *, row_number() OVER (PARTITION BY video ORDER BY CASE WHEN least BETWEEN s AND e THEN 1 ELSE 0 END DESC, e - s DESC, s) AS ch FROM cu WHERE rn <= most),
kept AS (SELECT video, s, e FROM cx WHERE med >= 30 OR ch = 1)"""


@query("w18_kept_regions", f'WITH {{fr}}, {KEPT_SQL} SELECT video, s AS "start", e AS "end" FROM kept')
def w18_kept_regions(spark, sf_dir):
    """W17, W18."""
    fr = frames(spark, sf_dir)
    return sequence.kept_regions(sequence.stable_regions(fr, ["video"], "frame", "value", 4), fr, ["video"], "frame", "value", 2.0, 30.0)


@query(
    "w16_key_frames",
    f"""WITH {{fr}}, {KEPT_SQL}, ft AS (SELECT *, value % 97 AS sharp, value % 7 AS ent, greatest(0.0, least(1.0, 1 - abs(value / 500 - 0.5) * 3)) AS bri, (value % 10) / 100 AS tout FROM fr),
zo AS (SELECT ft.*, s, arg_min(frame, value) OVER z AS lf, greatest(max(value) OVER z, 1e-9) AS most FROM ft JOIN kept ON ft.video = kept.video AND frame BETWEEN s AND e WINDOW z AS (PARTITION BY ft.video, s)),
ne AS (SELECT *, max(sharp) OVER z AS ms_, max(ent) OVER z AS me_ FROM zo WHERE abs(frame - lf) <= 15 WINDOW z AS (PARTITION BY video, s)),
sc AS (SELECT *, (0.4 * (1 - least(value, most) / most) + 0.25 * sharp / CASE WHEN ms_ < 1e-9 THEN 1 ELSE ms_ END + 0.2 * ent / CASE WHEN me_ < 1e-9 THEN 1 ELSE me_ END + 0.15 * bri) * CASE WHEN tout > 0.05 THEN 1 - (tout - 0.05) / 0.95 ELSE 1 END AS kf FROM ne),
be AS (SELECT *, row_number() OVER (PARTITION BY video, s ORDER BY kf DESC, frame) AS rn FROM sc)
SELECT video, frame AS key_frame, round(kf, 6) AS kf_score, row_number() OVER (PARTITION BY video ORDER BY kf DESC, frame) = 1 AS representative FROM be WHERE rn = 1""",
)
def w16_key_frames(spark, sf_dir):
    """W16, W19, X10."""
    ft = shot_features(spark, sf_dir)
    regions = sequence.kept_regions(sequence.stable_regions(ft, ["video"], "frame", "value", 4), ft, ["video"], "frame", "value", 2.0, 30.0)
    return sequence.key_frames(regions, ft, ["video"], "frame", "value").withColumn("kf_score", F.round(F.col("kf_score") * 1e6) / 1e6)


DAYS_SQL = "dy AS (SELECT DISTINCT user_id AS video, event_type AS person, CAST(epoch_us(ts) // 86400000000 AS BIGINT) - (SELECT min(epoch_us(ts) // 86400000000) FROM events) AS scene FROM events)"
INTERVALS_SQL = f"""{DAYS_SQL}, ga AS (SELECT *, CASE WHEN scene - lag(scene) OVER w <= 2 THEN 0 ELSE 1 END AS nw FROM dy WINDOW w AS (PARTITION BY video, person ORDER BY scene)),
gg AS (SELECT *, sum(nw) OVER (PARTITION BY video, person ORDER BY scene) AS g FROM ga), iv AS (SELECT video, person, min(scene) AS "start", max(scene) AS "end", CAST(count(*) AS INTEGER) AS n FROM gg GROUP BY video, person, g)"""


def appearances(spark, sf_dir):
    fr = frames(spark, sf_dir).withColumn("scene", F.floor(F.col("ms") / 86400000).cast("long"))
    low = fr.agg(F.min("scene").alias("_low"))
    return fr.crossJoin(F.broadcast(low)).select("video", F.col("kind").alias("person"), (F.col("scene") - F.col("_low")).alias("scene"))


def person_intervals(spark, sf_dir):
    return sequence.intervals_of(appearances(spark, sf_dir), ["video", "person"], "scene", 1)


@query("w22_person_intervals", f"WITH {INTERVALS_SQL} SELECT * FROM iv")
def w22_person_intervals(spark, sf_dir):
    return person_intervals(spark, sf_dir)


@query("p8_long_enough", f"WITH {INTERVALS_SQL} SELECT video, person, CAST(sum(n) AS BIGINT) AS scenes, CAST(sum(\"end\" - \"start\" + 1) AS BIGINT) AS span FROM iv GROUP BY video, person HAVING sum(n) >= 3")
def p8_long_enough(spark, sf_dir):
    """Persons with three scenes or more, and the length of their intervals."""
    return person_intervals(spark, sf_dir).groupBy("video", "person").agg(F.sum("n").alias("scenes"), F.sum(F.col("end") - F.col("start") + 1).alias("span")).filter("scenes >= 3")


@query(
    "w23_batches",
    """WITH {fr}, b AS (SELECT *, sum(CASE WHEN value < 2 THEN 1 ELSE 0 END) OVER (PARTITION BY video ORDER BY frame) AS br, value >= 20 AS a FROM fr), k AS (SELECT * FROM b WHERE value >= 2),
c AS (SELECT *, CASE WHEN lag(a) OVER w IS DISTINCT FROM a OR lag(br) OVER w IS DISTINCT FROM br THEN 1 ELSE 0 END AS ch FROM k WINDOW w AS (PARTITION BY video ORDER BY frame)),
g AS (SELECT *, sum(ch) OVER (PARTITION BY video ORDER BY frame) AS run FROM c), p AS (SELECT *, (row_number() OVER (PARTITION BY video, run ORDER BY frame) - 1) // 5 AS part FROM g)
SELECT video, frame, CAST(dense_rank() OVER (PARTITION BY video ORDER BY run, part) - 1 AS INTEGER) AS batch FROM p""",
)
def w23_batches(spark, sf_dir):
    return sequence.batches(frames(spark, sf_dir).withColumn("a", F.col("value") >= 20), ["video"], "frame", "a", F.col("value") < 2).select("video", "frame", "batch")


@query("w25_continuity", "WITH {fr}, p AS (SELECT video, frame // 5 AS scene, list(DISTINCT kind) AS persons FROM fr WHERE value > 60 GROUP BY ALL) SELECT video, CAST(scene AS INTEGER) AS scene, coalesce(list_has_any(persons, lag(persons) OVER (PARTITION BY video ORDER BY scene)), false) AS linked FROM p")
def w25_continuity(spark, sf_dir):
    """W25, U6."""
    rows = frames(spark, sf_dir).filter("value > 60").groupBy("video", F.floor(F.col("frame") / 5).cast("int").alias("scene")).agg(F.collect_set("kind").alias("persons"))
    return sequence.continuity(rows, ["video"], "scene", "persons").select("video", "scene", "linked")


@query(
    "w26_unique_shots",
    """WITH {fr}, c AS (SELECT video, frame, value < 60 AS cl, lag(value < 60) OVER (PARTITION BY video ORDER BY frame) AS was FROM fr),
g AS (SELECT video, CAST(count(*) AS INTEGER) AS raw, bool_and(cl) AS al, sum(CASE WHEN was IS NULL OR (cl AND was) THEN 0 ELSE 1 END) AS n FROM c GROUP BY video), u AS (SELECT video, raw, CAST(CASE WHEN al AND raw > 1 THEN 1 ELSE n + 1 END AS INTEGER) AS uniq FROM g)
SELECT *, CASE WHEN uniq = 1 AND raw > 1 THEN 'merged' WHEN uniq >= 3 THEN 'valid' ELSE 'short' END AS kind FROM u""",
)
def w26_unique_shots(spark, sf_dir):
    """W26, P23."""
    return sequence.unique_shots(frames(spark, sf_dir).withColumn("close", F.col("value") < 60), ["video"], "frame", "close")


@query("w27_offsets", "SELECT o_custkey, o_orderkey, coalesce(sum(o_totalprice_c) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS \"offset\" FROM (SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS o_totalprice_c FROM orders)")
def w27_offsets(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").withColumn("n", F.floor("o_totalprice").cast("long"))
    return sequence.offsets(rows, "o_orderkey", "n", key=["o_custkey"]).select("o_custkey", "o_orderkey", "offset")


CHAPTERS_SQL = """bo AS (SELECT DISTINCT video, frame AS b, total FROM fr WHERE value > 110 AND frame > 0 UNION SELECT DISTINCT video, 0, total FROM fr),
ch AS (SELECT video, CAST(row_number() OVER w - 1 AS INTEGER) AS chapter, b AS "start", CAST(coalesce(lead(b) OVER w, total) - 1 AS INTEGER) AS "end", CAST(coalesce(lead(b) OVER w, total) - b AS INTEGER) AS size FROM bo WINDOW w AS (PARTITION BY video ORDER BY b))"""


def chapter_rows(spark, sf_dir):
    fr = frames(spark, sf_dir)
    marks = fr.filter("value > 110").select("video", F.col("frame").alias("b"), "total").union(fr.select("video", F.lit(0), "total").distinct())
    return sequence.chapters(marks, ["video"], "b", "total")


@query("a11_chapters", f"WITH {{fr}}, {CHAPTERS_SQL} SELECT * FROM ch")
def a11_chapters(spark, sf_dir):
    """A11, P12."""
    return chapter_rows(spark, sf_dir)


@query(
    "w28_min_chapters",
    f"""WITH {{fr}}, {CHAPTERS_SQL}, k AS (SELECT * FROM ch WHERE chapter = 0 OR size >= 5), e AS (SELECT video, max("end") AS l FROM ch GROUP BY video)
SELECT k.video, CAST(row_number() OVER w - 1 AS INTEGER) AS chapter, k."start", CAST(coalesce(lead(k."start") OVER w - 1, l) AS INTEGER) AS "end", CAST(coalesce(lead(k."start") OVER w - 1, l) - k."start" + 1 AS INTEGER) AS size FROM k JOIN e USING (video) WINDOW w AS (PARTITION BY k.video ORDER BY k."start")""",
)
def w28_min_chapters(spark, sf_dir):
    return sequence.merge_small_chapters(chapter_rows(spark, sf_dir), ["video"])


@query("a20_boundaries", f'WITH {{fr}}, {CHAPTERS_SQL} SELECT video, list("start" ORDER BY "start") FILTER (chapter > 0) AS boundaries FROM ch GROUP BY video HAVING count(*) > 1')
def a20_boundaries(spark, sf_dir):
    """The first scene of each chapter but the first."""
    rows = chapter_rows(spark, sf_dir).filter("chapter > 0")
    return rows.groupBy("video").agg(F.sort_array(F.collect_list("start")).alias("boundaries"))


@query("w29_columns", "SELECT c_nationkey, c_custkey, CAST(ntile(4) OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS INTEGER) AS col_no FROM customer")
def w29_columns(spark, sf_dir):
    return sequence.split_columns(table(spark, sf_dir, "customer"), ["c_nationkey"], ["c_custkey"]).select("c_nationkey", "c_custkey", "col_no")


@query("w30_numbering", "WITH {fr} SELECT video, frame, video || '_Scene' || printf('%02d', row_number() OVER (PARTITION BY video ORDER BY frame)) AS scene_id FROM fr")
def w30_numbering(spark, sf_dir):
    rows = sequence.numbered(frames(spark, sf_dir), ["video"], ["frame"], "n", 1)
    return rows.select("video", "frame", F.format_string("%d_Scene%02d", "video", "n").alias("scene_id"))


@query(
    "x9_pack",
    """WITH RECURSIVE t AS (SELECT source, doc_id, n_chars AS c, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents),
f(source, doc_id, i, s, n, grp) AS (SELECT source, doc_id, i, c, 1, 0 FROM t WHERE i = 1 UNION ALL
SELECT t.source, t.doc_id, t.i, CASE WHEN f.s + t.c > 8192 OR f.n >= 16 THEN t.c ELSE f.s + t.c END, CASE WHEN f.s + t.c > 8192 OR f.n >= 16 THEN 1 ELSE f.n + 1 END, CASE WHEN f.s + t.c > 8192 OR f.n >= 16 THEN f.grp + 1 ELSE f.grp END
FROM f JOIN t ON t.source = f.source AND t.i = f.i + 1) SELECT source, doc_id, CAST(grp AS INTEGER) AS grp FROM f""",
)
def x9_pack(spark, sf_dir):
    return folds.pack_budget(table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars"), ["source"], ["doc_id"], "n_chars").select("source", "doc_id", "grp")


@query(
    "t4_candidate_pool",
    f"""WITH RECURSIVE {{fr}}, {SCORE_SQL}, k AS (SELECT video, frame, CAST(round(mafd + greatest(0.0, (value % 10) / 100 - 0.05) * 8 + (1 - greatest(0.0, least(1.0, 1 - abs(value / 500 - 0.5) * 3))) * 0.5, 6) AS DOUBLE) AS r FROM sc),
f(video, frame, pool) AS (SELECT video, frame, [{{'a': frame, 'r': r}}] FROM k WHERE frame = 0 UNION ALL SELECT video, frame, CASE
  WHEN near > 0 THEN CASE WHEN r < pool[near].r THEN pool[:near - 1] || [new] || pool[near + 1:] ELSE pool END
  WHEN len(pool) < 8 THEN pool || [new]
  WHEN r < pool[worst].r THEN pool[:worst - 1] || [new] || pool[worst + 1:] ELSE pool END
 FROM (SELECT k.video, k.frame, f.pool, k.r, {{'a': k.frame, 'r': k.r}} AS new, coalesce(list_position(list_transform(f.pool, lambda p: abs(p.a - k.frame) <= 5), true), 0) AS near,
       list_position(list_transform(f.pool, lambda p: p.r), list_max(list_transform(f.pool, lambda p: p.r))) AS worst FROM f JOIN k ON k.video = f.video AND k.frame = f.frame + 1)),
e AS (SELECT video, unnest(pool) AS p FROM f QUALIFY row_number() OVER (PARTITION BY video ORDER BY frame DESC) = 1) SELECT video, p.a AS frame, p.r AS rank FROM e""",
)
def t4_candidate_pool(spark, sf_dir):
    """Candidates by motion, brightness and overexposure."""
    ft = sequence.cut_scores(shot_features(spark, sf_dir), ["video"], "frame", "value")
    return folds.candidate_pool(ft.withColumn("rank", F.round(N.candidate_rank(F.col("mafd"), F.col("tout"), F.col("bright")), 6)), ["video"], "frame", "rank", 5, 8)


@query("p26_candidate_rank", "WITH {fr} SELECT video, frame, round(value + greatest(0.0, (value % 10) / 100 - 0.05) * 8 + (1 - greatest(0.0, least(1.0, 1 - abs(value / 500 - 0.5) * 3))) * 0.5, 5) AS rank FROM fr")
def p26_candidate_rank(spark, sf_dir):
    """P26, F29."""
    return shot_features(spark, sf_dir).select("video", "frame", F.round(N.candidate_rank(F.col("value"), F.col("tout"), F.col("bright")), 5).alias("rank"))


@query(
    "j22_fan_out",
    """WITH {fr} SELECT fr.video, frame, d.n FROM fr JOIN (SELECT kind, CAST(count(DISTINCT video) AS BIGINT) AS n FROM fr GROUP BY kind) d USING (kind)""",
)
def j22_fan_out(spark, sf_dir):
    """Worked out once for each source, handed to every frame that it serves."""
    fr = frames(spark, sf_dir)
    once = fr.groupBy("kind").agg(F.countDistinct("video").alias("n"))
    return fr.join(once, "kind").select("video", "frame", "n")


@query("s20_first_prefix", "WITH {fr} SELECT video, min(kind || '_f' || frame) AS prefix, count(*) AS n FROM fr GROUP BY video")
def s20_first_prefix(spark, sf_dir):
    """The first name of each folder, in lexical order."""
    name = X.make_mark(F.col("kind"), F.col("frame"))
    return frames(spark, sf_dir).groupBy("video").agg(F.min(name).alias("prefix"), F.count(F.lit(1)).alias("n"))


