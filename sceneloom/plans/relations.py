"""Queries of the interval, vector, graph and relational kernels."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F



from ..functions import numeric as N
from ..operators import folds, graph, interval, relational, sequence, vector
from .base import frames, query, table
from .sequences import DAYS_SQL, INTERVALS_SQL, RUNS_SQL, SHOTS_SQL, dark, person_intervals, shots


@query("j9_overlap", f"WITH {{fr}}, {SHOTS_SQL} SELECT s.video, CAST(s.shot AS INTEGER) AS shot, r.\"start\" AS run_start FROM shots s JOIN runs r ON s.video = r.video AND s.\"start\" <= r.\"end\" AND r.\"start\" <= s.\"end\"")
def j9_overlap(spark, sf_dir):
    runs = dark(spark, sf_dir, 2).select("video", F.col("start").alias("run_start"), F.col("end").alias("run_end"))
    return interval.overlapping(shots(spark, sf_dir), runs, ["video"], ("start", "end"), ("run_start", "run_end"), 16).select("video", "shot", "run_start")


SPANS_SQL = """sp AS (SELECT user_id AS video, event_id AS span, epoch_us(ts) // 1000 AS s, epoch_us(ts) // 1000 + CAST(floor(value) AS BIGINT) * 100000 AS e, event_type AS speaker FROM events WHERE event_type = 'purchase'),
pt AS (SELECT user_id AS video, event_id, epoch_us(ts) // 1000 AS t FROM events WHERE event_type = 'view')"""


def spans_and_points(spark, sf_dir):
    fr = frames(spark, sf_dir)
    spans = fr.filter("kind = 'purchase'").select("video", F.col("event_id").alias("span"), F.col("ms").alias("s"), (F.col("ms") + F.floor("value").cast("long") * 100000).alias("e"))
    return spans, fr.filter("kind = 'view'").select("video", "event_id", F.col("ms").alias("t"))


@query("j5_interval_first", f"WITH {SPANS_SQL} SELECT pt.video, pt.event_id, pt.t, (SELECT min(span) FROM sp WHERE sp.video = pt.video AND pt.t BETWEEN sp.s AND sp.e) AS span FROM pt")
def j5_interval_first(spark, sf_dir):
    """The first span in file order that holds the point."""
    spans, points = spans_and_points(spark, sf_dir)
    spans = spans.withColumn("ord", F.col("span"))
    return interval.first_interval(points, spans, ["video"], "event_id", "t", "s", "e", "ord", "span", 10_000_000)


@query(
    "j6_nearest",
    f"""WITH {{fr}}, {SHOTS_SQL}, q AS (SELECT video, event_id, frame + 0.5 + (value % 7) AS t FROM fr)
SELECT q.video, q.event_id, CAST(arg_min(shot, CASE WHEN t BETWEEN "start" AND "end" THEN -1.0 ELSE least(abs("start" - t), abs("end" - t)) END + shot / 1e6) AS INTEGER) AS shot FROM q JOIN shots ON q.video = shots.video GROUP BY q.video, q.event_id""",
)
def j6_nearest(spark, sf_dir):
    """Among all shots; points behind the last one have a nearest too."""
    points = frames(spark, sf_dir).select("video", "event_id", (F.col("frame") + 0.5 + F.col("value") % 7).alias("t"))
    every = shots(spark, sf_dir).select("video", "shot", F.col("start").cast("double").alias("s"), F.col("end").cast("double").alias("e"))
    return interval.nearest_interval(points, every, ["video"], "event_id", "t", "s", "e", "shot").filter("shot IS NOT NULL").select("video", "event_id", "shot")


@query("j14_asof", "WITH {fr} SELECT f.video, f.frame, g.value AS seen FROM fr f ASOF LEFT JOIN (SELECT * FROM fr WHERE value > 100) g ON f.video = g.video AND f.frame > g.frame")
def j14_asof(spark, sf_dir):
    fr = frames(spark, sf_dir)
    return interval.as_of(fr.select("video", "frame"), fr.filter("value > 100").select("video", F.col("frame").alias("at"), "value"), ["video"], "frame", "at", "value", name="seen").select("video", "frame", "seen")


@query(
    "j15_nearest_key",
    """WITH {fr}, k AS (SELECT *, value > 100 AS is_key, frame // 10 AS seg FROM fr), n AS (SELECT *, coalesce(max(CASE WHEN is_key THEN frame END) OVER (PARTITION BY video, seg ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
min(CASE WHEN is_key THEN frame END) OVER (PARTITION BY video, seg ORDER BY frame ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)) AS key_frame FROM k) SELECT video, frame, key_frame FROM n WHERE NOT is_key""",
)
def j15_nearest_key(spark, sf_dir):
    """The last key frame before, else the first behind, within a segment."""
    fr = frames(spark, sf_dir).withColumn("seg", F.floor(F.col("frame") / 10))
    return relational.nearest_key(fr, ["video", "seg"], "frame", F.col("value") > 100, "key_frame").filter("value <= 100").select("video", "frame", "key_frame")


@query("j26_nearest_unused", """WITH {fr}, w AS (SELECT video, frame AS want FROM fr), h AS (SELECT video, frame AS c FROM fr WHERE value > 120),
p AS (SELECT w.video, want, arg_min(c, abs(c - want) + c / 1e6) AS c FROM w JOIN h ON w.video = h.video GROUP BY w.video, want) SELECT video, min(want) AS want, c AS cand FROM p GROUP BY video, c""")
def j26_nearest_unused(spark, sf_dir):
    """Every frame looks for a candidate."""
    fr = frames(spark, sf_dir)
    return interval.nearest_unused(fr.select("video", F.col("frame").alias("want")), fr.filter("value > 120").select("video", F.col("frame").alias("cand")), ["video"], "want", "cand")


@query("p13_clip", f"WITH {INTERVALS_SQL} SELECT video, person, greatest(\"start\", 0) AS \"start\", least(\"end\", 14) AS \"end\" FROM (SELECT video, person, \"start\" - 5 AS \"start\", \"end\" - 5 AS \"end\" FROM iv) WHERE \"end\" >= 0 AND \"start\" < 15")
def p13_clip(spark, sf_dir):
    rows = person_intervals(spark, sf_dir).select("video", "person", (F.col("start") - 5).alias("start"), (F.col("end") - 5).alias("end"))
    return interval.clipped(rows, "start", "end", F.lit(15).cast("long"))


ONION_SQL = f"""{INTERVALS_SQL}, tt AS (SELECT video, person, sum("end" - "start" + 1) AS total FROM iv GROUP BY ALL),
sp AS (SELECT iv.video, iv.person, "start" AS s, "end" AS e, total FROM iv JOIN tt ON iv.video = tt.video AND iv.person = tt.person), mk AS (SELECT video, s AS cut, total FROM sp UNION ALL SELECT video, e + 1, total FROM sp),
cu AS (SELECT video, cut, max(total) AS longest FROM mk GROUP BY ALL), oc AS (SELECT video, cut FROM cu WHERE NOT EXISTS (SELECT 1 FROM sp WHERE sp.video = cu.video AND sp.s < cu.cut AND cu.cut <= sp.e AND cu.longest > sp.total))"""


@query("g4_onion", f"WITH {ONION_SQL} SELECT video, cut FROM oc")
def g4_onion(spark, sf_dir):
    """G4, A12."""
    return interval.onion_cuts(person_intervals(spark, sf_dir), ["video"], "person")


@query("g5_proto_scenes", f"""WITH {ONION_SQL}, t AS (SELECT DISTINCT user_id AS video, CAST(40 AS BIGINT) AS total FROM events), b AS (SELECT oc.video, cut, total FROM oc JOIN t USING (video) WHERE cut > 0 AND cut < total UNION SELECT video, 0, total FROM t)
SELECT video, CAST(row_number() OVER w - 1 AS INTEGER) AS seg, cut AS "start", coalesce(lead(cut) OVER w, total) - 1 AS "end" FROM b WINDOW w AS (PARTITION BY video ORDER BY cut)""")
def g5_proto_scenes(spark, sf_dir):
    """G5, U4."""
    totals = frames(spark, sf_dir).select("video").distinct().withColumn("total", F.lit(40).cast("long"))
    return interval.segments_between(interval.onion_cuts(person_intervals(spark, sf_dir), ["video"], "person"), totals, ["video"]).withColumn("start", F.col("start").cast("long"))


@query("j10_proto_persons", f"""WITH {ONION_SQL}, t AS (SELECT DISTINCT user_id AS video, CAST(40 AS BIGINT) AS total FROM events), b AS (SELECT oc.video, cut, total FROM oc JOIN t USING (video) WHERE cut > 0 AND cut < total UNION SELECT video, 0, total FROM t),
g AS (SELECT video, CAST(row_number() OVER w - 1 AS INTEGER) AS seg, cut AS s, coalesce(lead(cut) OVER w, total) - 1 AS e FROM b WINDOW w AS (PARTITION BY video ORDER BY cut))
SELECT g.video, g.seg, list_sort(list(DISTINCT iv.person)) AS persons FROM g JOIN iv ON iv.video = g.video AND iv."start" <= g.e AND iv."end" >= g.s GROUP BY g.video, g.seg""")
def j10_proto_persons(spark, sf_dir):
    """The persons of each proto scene."""
    segs = g5_proto_scenes(spark, sf_dir).select("video", "seg", F.col("start").alias("s"), F.col("end").alias("e"))
    met = interval.overlapping(segs, person_intervals(spark, sf_dir), ["video"], ("s", "e"), ("start", "end"), 16)
    return met.groupBy("video", "seg").agg(F.sort_array(F.collect_set("person")).alias("persons"))


@query("a22_scene_persons", f"WITH {INTERVALS_SQL}, x AS (SELECT video, person, unnest(range(\"start\", \"end\" + 1)) AS scene FROM iv) SELECT video, scene, list_sort(list(person)) AS persons FROM x GROUP BY video, scene")
def a22_scene_persons(spark, sf_dir):
    """Intervals exploded to the persons of each scene."""
    return relational.persons_of_scenes(person_intervals(spark, sf_dir), ["video"], "person")


@query("j20_local_scenes", f"""WITH {INTERVALS_SQL}, v AS (SELECT DISTINCT video % 7 AS vid, 9 AS n FROM iv), o AS (SELECT vid, n, coalesce(sum(n) OVER (ORDER BY vid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM v)
SELECT iv.video, iv.person, o.vid, CAST(greatest("start", off) - off AS BIGINT) AS "start", CAST(least("end", off + o.n - 1) - off AS BIGINT) AS "end" FROM iv JOIN o ON iv."start" <= off + o.n - 1 AND iv."end" >= off""")
def j20_local_scenes(spark, sf_dir):
    """Global scene numbers to each video's own."""
    rows = person_intervals(spark, sf_dir)
    videos = rows.select((F.col("video") % 7).alias("vid")).distinct().withColumn("n", F.lit(9))
    return interval.local_scenes(rows, videos, "vid", "n", "start", "end").select("video", "person", "vid", "start", "end")


PAIRS_SQL = "pr AS (SELECT a.vec_id AS src, b.vec_id AS dst, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS cos, a.label AS la, b.label AS lb FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id)"


def pairs(spark, sf_dir, threshold=0.40, apart=None):
    return vector.cosine_pairs(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", threshold, apart)


def components(spark, sf_dir):
    return vector.cosine_components(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 0.40)


@query("j12_cos_pairs", f"WITH {PAIRS_SQL} SELECT src, dst, round(cos, 6) AS cos FROM pr WHERE cos >= 0.40")
def j12_cos_pairs(spark, sf_dir):
    return pairs(spark, sf_dir).withColumn("cos", F.round("cos", 6))


@query("j13_person_pairs", f"WITH {PAIRS_SQL} SELECT src, dst, round(cos, 6) AS cos FROM pr WHERE cos >= 0.35 AND la <> lb")
def j13_person_pairs(spark, sf_dir):
    """Pairs of the same frame don't count."""
    return pairs(spark, sf_dir, 0.35, ["label"]).withColumn("cos", F.round("cos", 6))


#: The thresholds of the sweep.
THRESHOLDS = [0.35, 0.40, 0.45, 0.50, 0.55, 0.60, 0.65]


def faces(spark, sf_dir):
    """Three vectors are the faces of a frame; those of one frame are never linked."""
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.floor(F.col("vec_id") / 3).alias("frame"))


def face_pairs(spark, sf_dir):
    return vector.cosine_pairs(faces(spark, sf_dir), "vec_id", "embedding", THRESHOLDS[0], ["frame"])


@query(
    "a18_threshold_sweep",
    f"""WITH RECURSIVE {PAIRS_SQL}, t AS (SELECT CAST(unnest({THRESHOLDS}) AS DOUBLE) AS thr), ed AS MATERIALIZED (SELECT thr, src AS a, dst AS b FROM pr JOIN t ON cos >= thr WHERE src // 3 <> dst // 3 UNION SELECT thr, dst, src FROM pr JOIN t ON cos >= thr WHERE src // 3 <> dst // 3),
re(thr, id, r) AS (SELECT thr, vec_id, vec_id FROM embeddings, t UNION SELECT re.thr, ed.b, re.r FROM re JOIN ed ON re.id = ed.a AND re.thr = ed.thr), co AS (SELECT thr, id, min(r) AS c FROM re GROUP BY thr, id), sz AS (SELECT thr, c, count(*) AS n FROM co GROUP BY thr, c)
SELECT thr, count(*) AS persons, list(n ORDER BY n DESC)[1:6] AS sizes FROM sz GROUP BY thr""",
)
def a18_threshold_sweep(spark, sf_dir):
    """Persons at each threshold, by components."""
    ids = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"))
    return graph.threshold_sweep(ids, vector.cosine_forest(faces(spark, sf_dir), "vec_id", "embedding", THRESHOLDS[0], ["frame"]), THRESHOLDS)


@query("a18_whispers_sweep")
def a18_whispers_sweep(spark, sf_dir):
    """The same by label propagation."""
    ids = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"))
    return graph.threshold_sweep(ids, face_pairs(spark, sf_dir), THRESHOLDS, "whispers")


COMPONENTS_SQL = f"""{PAIRS_SQL}, ed AS (SELECT src AS a, dst AS b FROM pr WHERE cos >= 0.40 UNION SELECT dst, src FROM pr WHERE cos >= 0.40), re(id, r) AS (SELECT DISTINCT a, a FROM ed UNION SELECT ed.b, re.r FROM re JOIN ed ON re.id = ed.a),
co AS (SELECT id, min(r) AS component FROM re GROUP BY id)"""


@query("g1_components", f"WITH RECURSIVE {COMPONENTS_SQL} SELECT * FROM co")
def g1_components(spark, sf_dir):
    return components(spark, sf_dir)


@query("t2_named_clusters", f"WITH RECURSIVE {COMPONENTS_SQL}, sz AS (SELECT component, count(*) AS n FROM co GROUP BY 1), rk AS (SELECT *, row_number() OVER (ORDER BY n DESC, component) AS k FROM sz) SELECT id, co.component, 'c' || lpad(CAST(k AS VARCHAR), 3, '0') AS cluster, CAST(n AS INTEGER) AS size FROM co JOIN rk USING (component)")
def t2_named_clusters(spark, sf_dir):
    return graph.named_clusters(g1_components(spark, sf_dir))


@query("g2_persons", f"WITH RECURSIVE {COMPONENTS_SQL} SELECT vec_id AS id, coalesce(component, vec_id) AS person FROM embeddings LEFT JOIN co ON vec_id = id")
def g2_persons(spark, sf_dir):
    """Singles are persons too."""
    return graph.persons(table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id")), None, components=lambda: components(spark, sf_dir))


@query("g3_whispers")
def g3_whispers(spark, sf_dir):
    """Persons numbered by first appearance; tests replay the moves step by step."""
    ids = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"))
    return graph.numbered_persons(ids, graph.whispers(face_pairs(spark, sf_dir)))


def members(spark, sf_dir):
    return g1_components(spark, sf_dir).join(table(spark, sf_dir, "embeddings"), F.col("id") == F.col("vec_id"))


@query(
    "a7_representatives",
    f"""WITH RECURSIVE {COMPONENTS_SQL}, mb AS (SELECT component, vec_id, embedding::DOUBLE[] AS e, label = 0 AS bad, vec_id % 2 = 0 AS face FROM co JOIN embeddings ON id = vec_id),
us AS (SELECT * FROM mb QUALIFY bool_and(bad) OVER (PARTITION BY component) OR NOT bad), po AS (SELECT * FROM us QUALIFY NOT bool_or(face) OVER (PARTITION BY component) OR face),
xs AS (SELECT component, i, avg(e[i]) AS m FROM po, range(1, 65) t(i) GROUP BY ALL), ce AS (SELECT component, list(m ORDER BY i) AS c FROM xs GROUP BY component), un AS (SELECT component, list_transform(c, lambda x: x / (sqrt(list_inner_product(c, c)) + 1e-9)) AS c FROM ce),
sc AS (SELECT po.component, vec_id, list_inner_product(e, c) AS s FROM po JOIN un USING (component)) SELECT component, arg_max(vec_id, s) AS representative, round(round(max(s), 6), 5) AS centrality FROM sc GROUP BY component""",
)
def a7_representatives(spark, sf_dir):
    """A7, T3, P4, J3."""
    out = vector.representatives(members(spark, sf_dir), "component", "vec_id", "embedding", F.col("label") == 0, F.col("vec_id") % 2 == 0)
    return out.withColumn("centrality", F.round("centrality", 5))


@query("a6_scene_mean", "WITH x AS (SELECT label, i, avg(embedding[i]::DOUBLE) AS m FROM embeddings, range(1, 65) t(i) GROUP BY ALL), c AS (SELECT label, list(m ORDER BY i) AS c FROM x GROUP BY label) SELECT label, list_transform(c, lambda x: round(x / (sqrt(list_inner_product(c, c)) + 1e-9), 5)) AS centroid FROM c")
def a6_scene_mean(spark, sf_dir):
    """A6, J11."""
    return vector.centroid(table(spark, sf_dir, "embeddings"), ["label"], "embedding").withColumn("centroid", F.transform("centroid", lambda x: F.round(x, 5)))


@query("a19_loo_mean", f"WITH {PAIRS_SQL}, b AS (SELECT src AS id, la AS l, lb AS m, cos FROM pr UNION ALL SELECT dst, lb, la, cos FROM pr) SELECT l AS label, id AS vec_id, round(avg(cos), 5) AS mean_cos FROM b WHERE l = m GROUP BY l, id")
def a19_loo_mean(spark, sf_dir):
    return vector.mean_similarity(table(spark, sf_dir, "embeddings"), ["label"], "vec_id", "embedding").filter("mean_cos IS NOT NULL").withColumn("mean_cos", F.round("mean_cos", 5))


@query("w31_splits", "WITH n AS (SELECT label, vec_id, list_cosine_similarity(embedding::DOUBLE[], (lead(embedding) OVER (PARTITION BY label ORDER BY vec_id))::DOUBLE[]) AS c FROM embeddings) SELECT label, vec_id FROM n WHERE c < 0.1")
def w31_splits(spark, sf_dir):
    return vector.splits(table(spark, sf_dir, "embeddings"), ["label"], "vec_id", "embedding", 0.1)


def key_frame_vectors(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings")
    return v.select(F.floor(F.col("vec_id") / 50).cast("int").alias("video"), F.col("vec_id").alias("frame"), F.floor(F.col("vec_id") / 8).cast("int").alias("shot"), "embedding", (F.col("vec_id") % 13 == 0).alias("black"), (F.col("vec_id") % 3 == 0).alias("face"))


DEDUP_SQL = """kv AS MATERIALIZED (SELECT CAST(vec_id // 50 AS INTEGER) AS video, vec_id AS frame, CAST(vec_id // 8 AS INTEGER) AS shot, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e, vec_id % 13 = 0 AS black, vec_id % 3 = 0 AS face FROM embeddings),
cs AS MATERIALIZED (SELECT a.frame AS fa, b.frame AS fb, list_cosine_similarity(a.e, b.e) AS cos FROM kv a JOIN kv b USING (video)),
rd(round, video, frame, shot, black, face) AS (SELECT 0, video, frame, shot, black, face FROM kv UNION ALL
SELECT round + 1, video, frame, shot, black, face FROM (
  WITH l AS (SELECT *, lag(frame) OVER w AS bf, lag(shot) OVER w AS bs, lag(black) OVER w AS bb FROM rd WINDOW w AS (PARTITION BY video ORDER BY frame)),
  t AS (SELECT l.*, CASE WHEN bs = shot AND bb = black AND cos >= 0.16 THEN 0 ELSE 1 END AS new FROM l LEFT JOIN cs ON fa = bf AND fb = frame),
  u AS (SELECT *, sum(new) OVER (PARTITION BY video ORDER BY frame) AS run FROM t),
  po AS (SELECT * FROM u QUALIFY NOT bool_or(face) OVER (PARTITION BY video, run) OR face),
  me AS (SELECT a.video, a.run, a.frame, round(coalesce(avg(cos), 0), 9) AS m FROM po a LEFT JOIN po b ON a.video = b.video AND a.run = b.run AND a.frame <> b.frame LEFT JOIN cs ON fa = a.frame AND fb = b.frame GROUP BY ALL),
  be AS (SELECT video, run, frame FROM me QUALIFY row_number() OVER (PARTITION BY video, run ORDER BY m DESC, frame) = 1)
  SELECT u.* FROM u JOIN be USING (video, run, frame)) WHERE round < 14),
sv AS (SELECT video, frame, shot FROM rd WHERE round = 14)"""


@query("w20_neighbour_dedup", f"WITH RECURSIVE {DEDUP_SQL} SELECT video, frame, shot FROM sv")
def w20_neighbour_dedup(spark, sf_dir):
    return vector.neighbour_dedup(key_frame_vectors(spark, sf_dir), ["video"], "frame", "shot", "embedding", "black", "face", 0.16).select("video", "frame", "shot")


@query(
    "w21_scenes",
    f"""WITH RECURSIVE {DEDUP_SQL}, bk AS (SELECT video, frame, frame - row_number() OVER (PARTITION BY video ORDER BY frame) AS run FROM kv WHERE black), br AS (SELECT video, min(frame) AS s, max(frame) AS e FROM bk GROUP BY video, run),
sh AS (SELECT video, shot, min(frame) AS a, max(frame) AS b FROM kv GROUP BY video, shot),
cl AS (SELECT sv.* FROM sv WHERE NOT EXISTS (SELECT 1 FROM br WHERE br.video = sv.video AND frame BETWEEN s AND e)),
ps AS (SELECT cl.*, (SELECT count(*) FROM br WHERE br.video = cl.video AND br.s < cl.frame) AS passed FROM cl),
nw AS (SELECT *, CASE WHEN lag(shot) OVER w = shot AND lag(passed) OVER w = passed THEN 0 ELSE 1 END AS new FROM ps WINDOW w AS (PARTITION BY video ORDER BY frame)),
gr AS (SELECT *, sum(new) OVER (PARTITION BY video ORDER BY frame) AS g FROM nw),
no AS (SELECT gr.video, min(frame) AS ft, a AS s, b AS e, 1 AS n_shots, list(frame ORDER BY frame) AS frames, false AS black FROM gr JOIN sh USING (video, shot) GROUP BY gr.video, g, shot, a, b),
da AS (SELECT br.video, br.s AS ft, br.s, br.e, (SELECT count(*) FROM sh WHERE sh.video = br.video AND a <= br.e AND b >= br.s) AS n_shots,
  coalesce((SELECT list(frame ORDER BY frame) FROM sv WHERE sv.video = br.video AND frame BETWEEN br.s AND br.e), CAST([] AS BIGINT[])) AS frames, true AS black FROM br)
SELECT video, CAST(row_number() OVER (PARTITION BY video ORDER BY ft, black) - 1 AS INTEGER) AS scene, s AS "start", e AS "end", CAST(n_shots AS INTEGER) AS n_shots, ft AS key_frame, frames, black FROM (SELECT * FROM no UNION ALL SELECT * FROM da)""",
)
def w21_scenes(spark, sf_dir):
    """Survivors of a shot, cut by black frames, as scenes in time order."""
    every = key_frame_vectors(spark, sf_dir)
    left = vector.neighbour_dedup(every, ["video"], "frame", "shot", "embedding", "black", "face", 0.16)
    blacks = sequence.islands(every, ["video"], "frame", F.col("black")).select("video", "start", "end")
    ranges = every.groupBy("video", "shot").agg(F.min("frame").alias("start"), F.max("frame").alias("end"))
    return relational.scenes(left, blacks, ranges, ["video"], "frame", "shot")


@query(
    "w24_skip",
    """WITH RECURSIVE r AS (SELECT vec_id // 5 AS batch, vec_id AS frame, embedding::DOUBLE[] AS e, vec_id % 17 = 0 AS must, row_number() OVER (PARTITION BY vec_id // 5 ORDER BY vec_id) AS i FROM embeddings),
f(batch, frame, i, ref, kept) AS (SELECT batch, frame, i, e, true FROM r WHERE i = 1 UNION ALL
SELECT r.batch, r.frame, r.i, CASE WHEN r.must OR list_cosine_similarity(f.ref, r.e) < 0.1 THEN r.e ELSE f.ref END, r.must OR list_cosine_similarity(f.ref, r.e) < 0.1 FROM f JOIN r ON r.batch = f.batch AND r.i = f.i + 1)
SELECT CAST(batch AS BIGINT) AS batch, frame, kept FROM f""",
)
def w24_skip(spark, sf_dir):
    rows = key_frame_vectors(spark, sf_dir).select(F.floor(F.col("frame") / 5).alias("batch"), "frame", "embedding", (F.col("frame") % 17 == 0).alias("always"))
    return folds.skip_similar(rows, ["batch"], ["frame"], "embedding", "always", 0.1).select("batch", "frame", "kept")


def _refine_sql(keep: int = 3, threshold: float = 0.15) -> str:
    """T5 as one common table expression for each place: the best that is unlike those who have theirs, or the best."""
    steps = [
        """r AS (SELECT vec_id // 5 AS batch, vec_id AS frame, embedding::DOUBLE[] AS e, CAST(vec_id % 3 = 0 AS INTEGER) + CAST(vec_id % 2 = 0 AS INTEGER) AS bonus, vec_id % 17 = 0 AS forced FROM embeddings),
c AS (SELECT a.batch, a.frame AS a, b.frame AS b, list_cosine_similarity(a.e, b.e) AS cos FROM r a JOIN r b ON a.batch = b.batch AND a.frame <> b.frame),
w AS (SELECT r.batch, frame, forced, any_value(bonus) + coalesce(avg(cos), 0) AS worth, count(*) OVER (PARTITION BY r.batch) AS n, sum(CAST(forced AS INTEGER)) OVER (PARTITION BY r.batch) AS nf FROM r LEFT JOIN c ON c.batch = r.batch AND c.a = frame GROUP BY r.batch, frame, forced),
s0 AS (SELECT batch, frame FROM w WHERE forced)"""
    ]
    for t in range(1, keep + 1):
        steps.append(f"""t{t} AS (SELECT batch, frame, worth, NOT EXISTS (SELECT 1 FROM s{t - 1} s JOIN c ON c.batch = s.batch AND c.b = s.frame WHERE s.batch = w.batch AND c.a = w.frame AND c.cos >= {threshold}) AS fresh
FROM w WHERE n > {keep} AND nf + {t} <= {keep} AND NOT EXISTS (SELECT 1 FROM s{t - 1} s WHERE s.batch = w.batch AND s.frame = w.frame)),
s{t} AS (SELECT * FROM s{t - 1} UNION ALL (SELECT batch, frame FROM t{t} QUALIFY row_number() OVER (PARTITION BY batch ORDER BY fresh DESC, worth DESC, frame) = 1))""")
    return f"WITH {', '.join(steps)} SELECT CAST(batch AS BIGINT) AS batch, frame, n <= {keep} OR EXISTS (SELECT 1 FROM s{keep} s WHERE s.batch = w.batch AND s.frame = w.frame) AS kept FROM w"


@query("t5_refine", _refine_sql())
def t5_refine(spark, sf_dir):
    rows = key_frame_vectors(spark, sf_dir).select(F.floor(F.col("frame") / 5).alias("batch"), "frame", "embedding", "face", (F.col("frame") % 2 == 0).alias("body"), (F.col("frame") % 17 == 0).alias("forced"))
    return folds.refine_batches(rows, ["batch"], "frame", "embedding", "face", "body", "forced", 3, 0.15)


@query(
    "f13_vectors",
    """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e, list_reverse(embedding::DOUBLE[]) AS r FROM embeddings)
SELECT vec_id, round(list_inner_product(e, r), 5) AS product, round(sqrt(list_inner_product(e, e)), 5) AS length, round(list_inner_product(e, r) / (sqrt(list_inner_product(e, e)) * sqrt(list_inner_product(r, r)) + 1e-10), 5) AS likeness, round(e[1] / (sqrt(list_inner_product(e, e)) + 1e-9), 5) AS first_of_unit FROM v""",
)
def f13_vectors(spark, sf_dir):
    """products, lengths and cosines in double."""
    e, r = F.col("embedding"), F.reverse("embedding")
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(N.dot(e, r), 5).alias("product"), F.round(N.norm(e), 5).alias("length"), F.round(N.cosine(e, r, 1e-10), 5).alias("likeness"), F.round(N.unit(e)[0], 5).alias("first_of_unit"))


@query("w26_chain_closeness", "WITH x AS (SELECT label, i, avg(embedding[i]::DOUBLE) AS m FROM embeddings, range(1, 65) t(i) GROUP BY ALL), c AS (SELECT label, list(m ORDER BY i) AS c FROM x GROUP BY label) SELECT label, vec_id, round(list_cosine_similarity(embedding::DOUBLE[], c), 5) AS cos_to_mean FROM embeddings JOIN c USING (label)")
def w26_chain_closeness(spark, sf_dir):
    return vector.chain_closeness(table(spark, sf_dir, "embeddings"), ["label"], "vec_id", "embedding", 0.3).select("label", "vec_id", F.round("cos_to_mean", 5).alias("cos_to_mean"))


@query("t11_avatar", "WITH x AS (SELECT label, i, avg(embedding[i]::DOUBLE) AS m FROM embeddings, range(1, 65) t(i) GROUP BY ALL), c AS (SELECT label, list(m ORDER BY i) AS c FROM x GROUP BY label) SELECT label, arg_max(vec_id, list_cosine_similarity(embedding::DOUBLE[], c)) AS avatar FROM embeddings JOIN c USING (label) GROUP BY label")
def t11_avatar(spark, sf_dir):
    """The member nearest its chain's mean."""
    near = vector.chain_closeness(table(spark, sf_dir, "embeddings"), ["label"], "vec_id", "embedding")
    return near.groupBy("label").agg(F.max_by("vec_id", F.struct("cos_to_mean", -F.col("vec_id"))).alias("avatar"))


# --- relational ----------------------------------------------------------------------------------


@query("j1_lookup", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def j1_lookup(spark, sf_dir):
    """A lookup that must find its row."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return relational.lookup(o, table(spark, sf_dir, "customer").select("c_custkey", "c_name"), ["c_custkey"], "c_name").select("o_orderkey", "c_name")


@query("j2_features", "SELECT d.doc_id, coalesce(l.quality, -1) AS quality, coalesce(l.toxic = 1, false) AS toxic FROM documents d LEFT JOIN labels l USING (doc_id)")
def j2_features(spark, sf_dir):
    """A missing row counts as a default."""
    d, flags = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels")
    return d.join(flags, "doc_id", "left").select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"), F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("toxic"))


@query("p4_bad_frames", "WITH {fr} SELECT video, frame, coalesce(value % 97 < 10 OR value < 15 OR value > 245, true) AS bad FROM fr")
def p4_bad_frames(spark, sf_dir):
    """Blurred, dark, bright or unknown frames."""
    return frames(spark, sf_dir).select("video", "frame", relational.bad_frame(F.col("value") % 97, F.col("value"), 10).alias("bad"))


@query("p5_default_key_frames", "WITH {fr}, k AS (SELECT video, frame // 10 AS shot, list(frame ORDER BY frame) FILTER (value > 100) AS kf, min(frame) AS s, max(frame) AS e FROM fr GROUP BY ALL) SELECT video, CAST(shot AS INTEGER) AS shot, coalesce(kf, [(s + e) // 2]) AS key_frames FROM k")
def p5_default_key_frames(spark, sf_dir):
    """A shot without key frames gets its middle one."""
    fr = frames(spark, sf_dir).groupBy("video", F.floor(F.col("frame") / 10).cast("int").alias("shot")).agg(F.sort_array(F.collect_list(F.when(F.col("value") > 100, F.col("frame")))).alias("kf"), F.min("frame").alias("s"), F.max("frame").alias("e"))
    return fr.select("video", "shot", relational.default_key_frames(F.col("kf"), F.col("s"), F.col("e")).alias("key_frames"))


@query("p7_face_quality", "WITH f AS (SELECT l_orderkey, l_linenumber, round(l_discount * 10, 4) AS score, CAST(l_quantity AS INTEGER) * CAST(l_quantity AS INTEGER) AS area FROM lineitem), g AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n FROM f WHERE score >= 0.30) SELECT l_orderkey, l_linenumber FROM g WHERE area >= 100000 * (CAST(0.001 AS DOUBLE) + CAST(0.002 AS DOUBLE) * n)")
def p7_face_quality(spark, sf_dir):
    """Sure detections that are large enough for how many share the frame."""
    q = F.col("l_quantity").cast("int")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(F.col("l_discount") * 10, 4).alias("score"), (q * q).alias("area"))
    return relational.good_faces(rows, ["l_orderkey"], "score", "area", F.lit(100000)).select("l_orderkey", "l_linenumber")


@query("p9_min_speech", "WITH {fr}, s AS (SELECT video, frame, ms AS a, ms + CAST(floor(value * 10) AS BIGINT) AS b FROM fr) SELECT video, frame FROM s WHERE CAST(trunc(b / 1000.0 * 16000) AS BIGINT) - CAST(trunc(a / 1000.0 * 16000) AS BIGINT) >= 4800")
def p9_min_speech(spark, sf_dir):
    rows = frames(spark, sf_dir).select("video", "frame", F.col("ms").alias("a"), (F.col("ms") + F.floor(F.col("value") * 10).cast("long")).alias("b"))
    return rows.filter(relational.speech_samples(F.col("a"), F.col("b")) >= 4800).select("video", "frame")


@query("p10_nonempty", "SELECT conv_id, turn FROM conversations WHERE trim(text) NOT IN ('', 'None', '无')")
def p10_nonempty(spark, sf_dir):
    return relational.with_text(table(spark, sf_dir, "conversations"), "text").select("conv_id", "turn")


@query("p11_whitelist", "SELECT doc_id, lang, CASE WHEN lang IN ('zh', 'ja', 'ko', 'en') THEN lang ELSE 'ja' END AS used FROM documents")
def p11_whitelist(spark, sf_dir):
    """Languages outside the list are heard again with hints, in order; the first non-empty answer counts."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return relational.with_hints(rows, "doc_id", "lang", "text", lambda hint, text: F.when(F.char_length(text) > 0, text)).select("doc_id", "lang", "used")


@query(
    "p17_main_subject",
    """WITH b AS (SELECT l_orderkey AS f, l_linenumber AS i, CAST(l_quantity AS DOUBLE) AS h FROM lineitem), r AS (SELECT *, row_number() OVER w AS k, lead(h) OVER w / h AS q, count(*) OVER (PARTITION BY f) AS n FROM b WINDOW w AS (PARTITION BY f ORDER BY h, i)),
c AS (SELECT f, max(n) AS n, max(q) AS best, arg_max(k, struct_pack(q := q, k := -k)) FILTER (q IS NOT NULL) AS cut FROM r GROUP BY f) SELECT r.f AS frame_id, r.i AS box FROM r JOIN c USING (f) WHERE c.n <= 2 OR best < 1.4 OR k > cut""",
)
def p17_main_subject(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("frame_id"), F.col("l_linenumber").alias("box"), F.col("l_quantity").cast("double").alias("h"))
    return relational.main_subject(rows, ["frame_id"], "box", "h").select("frame_id", "box")


@query("p20_resume", "SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def p20_resume(spark, sf_dir):
    """P20, J24, U7, ST7: units without a result."""
    return table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


@query("j23_semi", "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def j23_semi(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id"), "doc_id", "left_semi")


@query("p24_resume_merge", "SELECT d.doc_id, coalesce('q' || l.quality, 't' || m.toxic, 'n' || d.n_chars) AS result FROM documents d LEFT JOIN (SELECT * FROM labels WHERE doc_id % 2 = 0) l USING (doc_id) LEFT JOIN (SELECT * FROM labels WHERE doc_id % 2 = 1) m USING (doc_id)")
def p24_resume_merge(spark, sf_dir):
    """Results in three older forms; the first form that has one counts."""
    d, flags = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    first = flags.filter("doc_id % 2 = 0").select("doc_id", F.concat(F.lit("q"), F.col("quality").cast("string")).alias("result"))
    second = flags.filter("doc_id % 2 = 1").select("doc_id", F.concat(F.lit("t"), F.col("toxic").cast("string")).alias("result"))
    third = d.select("doc_id", F.concat(F.lit("n"), F.col("n_chars").cast("string")).alias("result"))
    return relational.first_source([first, second, third], ["doc_id"], "result")


@query("j18_assemble", "SELECT c_custkey, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS orders, list_sort(list(DISTINCT CAST(l_linenumber AS INTEGER)) FILTER (l_linenumber IS NOT NULL)) AS line_numbers FROM customer LEFT JOIN orders ON c_custkey = o_custkey LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY c_custkey")
def j18_assemble(spark, sf_dir):
    """A star of left joins, each side aggregated before."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").cast("int").alias("ln")).distinct()
    by_customer = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey")).join(lines, "o_orderkey", "left")
    agg = by_customer.groupBy("c_custkey").agg(F.countDistinct("o_orderkey").alias("orders"), F.sort_array(F.collect_set("ln")).alias("line_numbers"))
    out = table(spark, sf_dir, "customer").select("c_custkey").join(agg, "c_custkey", "left")
    return out.select("c_custkey", F.coalesce("orders", F.lit(0)).alias("orders"), F.when(F.size("line_numbers") > 0, F.col("line_numbers")).alias("line_numbers"))


@query("j16_cluster_fill", "WITH k AS (SELECT source, arg_min(n_chars, doc_id) AS said FROM documents WHERE doc_id % 5 = 0 GROUP BY source) SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN n_chars ELSE said END AS said FROM documents LEFT JOIN k USING (source)")
def j16_cluster_fill(spark, sf_dir):
    """Members without a description take that of their cluster's first key."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", F.when(F.col("doc_id") % 3 == 0, F.col("n_chars")).alias("said"), (F.col("doc_id") % 5 == 0).alias("is_key"), "n_chars")
    return relational.fill_from_key(rows, "source", "doc_id", "said", F.col("is_key"), F.col("n_chars")).select("doc_id", "said")


@query("j17_cluster_map", "WITH k AS (SELECT source, arg_max(n_chars, doc_id) AS said FROM documents WHERE doc_id % 5 = 0 GROUP BY source) SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN n_chars ELSE said END AS said FROM documents LEFT JOIN k USING (source)")
def j17_cluster_map(spark, sf_dir):
    """Within a video the last key counts."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", F.when(F.col("doc_id") % 3 == 0, F.col("n_chars")).alias("said"), (F.col("doc_id") % 5 == 0).alias("is_key"), "n_chars")
    return relational.fill_from_key(rows, "source", "doc_id", "said", F.col("is_key"), F.col("n_chars"), last=True).select("doc_id", "said")


@query("j21_block_ranges", "WITH {fr}, s AS (SELECT video, frame AS scene, ms AS a, ms + 10 AS b FROM fr), k AS (SELECT video, frame AS s0, frame + 2 AS s1 FROM fr WHERE frame % 10 = 0) SELECT k.video, s0, s1, x.a AS range_start, y.b AS range_end FROM k LEFT JOIN s x ON k.video = x.video AND s0 = x.scene LEFT JOIN s y ON k.video = y.video AND s1 = y.scene")
def j21_block_ranges(spark, sf_dir):
    """Frame ranges of blocks from their first and last scene."""
    fr = frames(spark, sf_dir)
    scenes = fr.select("video", F.col("frame").alias("scene"), F.col("ms").alias("a"), (F.col("ms") + 10).alias("b"))
    blocks = fr.filter("frame % 10 = 0").select("video", F.col("frame").alias("s0"), (F.col("frame") + 2).alias("s1"))
    return relational.block_ranges(blocks, scenes, ["video"], "s0", "s1", "scene", "a", "b")


@query("j19_shared_persons", "WITH r AS (SELECT doc_id, source, min(doc_id) OVER (PARTITION BY source) AS rep FROM documents), p AS (SELECT doc_id, quality FROM labels) SELECT r.doc_id, p.quality FROM r LEFT JOIN p ON p.doc_id = r.rep")
def j19_shared_persons(spark, sf_dir):
    """A member sees what its representative has."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "source")
    reps = rows.groupBy("source").agg(F.min("doc_id").alias("rep"))
    found = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("rep"), "quality")
    seen = reps.join(found, "rep", "left").select(F.col("source").alias("_source"), "quality")
    return rows.join(seen, F.col("source").eqNullSafe(F.col("_source"))).select("doc_id", "quality")  # no source is a group too


@query("j25_header_check", "SELECT count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey")
def j25_header_check(spark, sf_dir):
    """Every order has exactly one customer, or the query fails."""
    o, c = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("k")), table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    return relational.exactly_one(o, c, ["k"], ["o_orderkey"]).agg(F.count(F.lit(1)).alias("n"))


# --- aggregations --------------------------------------------------------------------------------


@query("a1_change", "WITH {fr}, d AS (SELECT video, abs(value - lag(value) OVER (PARTITION BY video ORDER BY frame)) AS d FROM fr) SELECT video, round(sum(d), 4) AS total_change FROM d GROUP BY video")
def a1_change(spark, sf_dir):
    """A1, on scalars."""
    w = Window.partitionBy("video").orderBy("frame")
    return frames(spark, sf_dir).withColumn("d", F.abs(F.col("value") - F.lag("value").over(w))).groupBy("video").agg(F.round(F.sum("d"), 4).alias("total_change"))


@query("a2_entropy", """WITH h AS (SELECT event_type AS kind, CAST(floor(value) AS BIGINT) % 256 AS v, count(*) AS n FROM events GROUP BY ALL), c AS (SELECT *, sum(n) OVER (PARTITION BY kind ORDER BY v) AS cum, sum(n) OVER (PARTITION BY kind) AS t FROM h)
SELECT kind, round(sum(v * n) / max(t), 6) AS mean, min(v) AS low, max(v) AS high, min(v) FILTER (cum >= round_even(t * 10 / 100, 0)) AS ylow, min(v) FILTER (cum >= round_even(t * 90 / 100, 0)) AS yhigh, round(sum(-(n / t) * log2(n / t)), 6) AS entropy FROM c GROUP BY kind""")
def a2_entropy(spark, sf_dir):
    rows = frames(spark, sf_dir).withColumn("v", F.floor("value") % 256)
    out = relational.histogram_stats(rows, ["kind"], "v")
    return out.select("kind", F.round("mean", 6).alias("mean"), "low", "high", "ylow", "yhigh", F.round("entropy", 6).alias("entropy"))


@query("a3_counts", "SELECT event_type AS kind, count(*) FILTER (value <= 37) AS dark, count(*) FILTER (value > 235 OR value < 16) AS out_of_range FROM events GROUP BY 1")
def a3_counts(spark, sf_dir):
    """A3, P3."""
    return frames(spark, sf_dir).groupBy("kind").agg(F.count_if(F.col("value") <= 37).alias("dark"), F.count_if((F.col("value") > 235) | (F.col("value") < 16)).alias("out_of_range"))


@query("a4_variance", "SELECT user_id AS video, round(sum(value * value) / count(*) - (sum(value) / count(*)) ** 2, 3) AS variance FROM events GROUP BY 1")
def a4_variance(spark, sf_dir):
    """A4: variance from partial sums and sums of squares."""
    n = F.count(F.lit(1))
    return frames(spark, sf_dir).groupBy("video").agg(F.round(F.sum(F.col("value") * F.col("value")) / n - F.pow(F.sum("value") / n, F.lit(2)), 3).alias("variance"))


@query("a8_distinct_persons", f"WITH {DAYS_SQL} SELECT video, scene, list_sort(list(DISTINCT person)) AS persons FROM dy GROUP BY video, scene")
def a8_distinct_persons(spark, sf_dir):
    from .sequences import appearances

    return appearances(spark, sf_dir).groupBy("video", "scene").agg(F.sort_array(F.collect_set("person")).alias("persons"))


@query("a9_scene_lines", "SELECT conv_id, list(role || '|' || text ORDER BY turn) AS lines FROM conversations GROUP BY conv_id")
def a9_scene_lines(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat_ws("|", "role", "text").alias("line"))
    return relational.ordered_list(rows, ["conv_id"], ["turn"], "line", "lines")


@query("a10_chain_sizes", f"WITH {INTERVALS_SQL}, c AS (SELECT video, person, count(*) AS k FROM iv GROUP BY ALL) SELECT video, list(k ORDER BY k DESC) AS sizes, CAST(sum(k) AS BIGINT) AS total FROM c GROUP BY video")
def a10_chain_sizes(spark, sf_dir):
    """A10, T6, T8."""
    c = person_intervals(spark, sf_dir).groupBy("video", "person").agg(F.count(F.lit(1)).alias("k"))
    return c.groupBy("video").agg(F.sort_array(F.collect_list("k"), False).alias("sizes"), F.sum("k").alias("total"))


@query("a13_speakers", "SELECT event_type AS kind, count(*) AS n FROM events GROUP BY 1")
def a13_speakers(spark, sf_dir):
    return frames(spark, sf_dir).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("a14_any_all", "SELECT user_id AS video, bool_or(value > 400) AS any_hot, bool_and(value > 1) AS all_lit FROM events GROUP BY 1")
def a14_any_all(spark, sf_dir):
    return frames(spark, sf_dir).groupBy("video").agg(F.bool_or(F.col("value") > 400).alias("any_hot"), F.bool_and(F.col("value") > 1).alias("all_lit"))


@query("a15_first_rows", "SELECT source, lang, min(doc_id) AS doc_id FROM documents GROUP BY ALL")
def a15_first_rows(spark, sf_dir):
    """Of rows with the same key the first one."""
    return relational.first_rows(table(spark, sf_dir, "documents").select("source", "lang", "doc_id"), ["source", "lang"], ["doc_id"])


@query("a16_union_maps", "WITH {fr}, m AS (SELECT video, kind, max(frame) AS f FROM fr GROUP BY ALL) SELECT video, list(kind || '=' || f ORDER BY kind) AS shot_frame FROM m GROUP BY video")
def a16_union_maps(spark, sf_dir):
    """Maps of a range united; of a repeated key the last entry counts."""
    maps = frames(spark, sf_dir).select("video", "frame", F.create_map("kind", "frame").alias("m"))
    united = relational.united_maps(maps, ["video"], ["frame"], "m")
    return united.select("video", F.transform(F.sort_array(F.map_entries("m")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))).alias("shot_frame"))


@query("a17_hash_dupes", "SELECT substr(sha256(text), 1, 6) AS h, count(*) AS n, min(doc_id) AS first_doc FROM documents GROUP BY 1 HAVING count(*) > 1")
def a17_hash_dupes(spark, sf_dir):
    """Content hashes as keys, and what shares one."""
    rows = table(spark, sf_dir, "documents").select("doc_id", relational.content_hash(F.col("text")).alias("h"))
    return rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc")).filter("n > 1")


@query("a21_scene_keys", "WITH {fr} SELECT video, list_sort(list_distinct(list(frame // 3 * 3))) AS keys FROM fr GROUP BY video")
def a21_scene_keys(spark, sf_dir):
    """A21, U2, U3."""
    kf = frames(spark, sf_dir).select("video", F.array((F.floor(F.col("frame") / 3) * 3).cast("int")).alias("kf"))
    return kf.groupBy("video").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("kf")))).alias("keys"))


@query("a23_project_index", "WITH v AS (SELECT source, lang, count(*) AS n_blocks FROM documents GROUP BY ALL) SELECT source, count(*) AS n_videos, CAST(sum(n_blocks) AS BIGINT) AS n_blocks_total, list(lang || ':' || n_blocks ORDER BY lang) AS videos FROM v GROUP BY source")
def a23_project_index(spark, sf_dir):
    """A project's videos with their blocks, and totals."""
    v = table(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n_blocks"))
    rows = v.withColumn("line", F.concat_ws(":", "lang", F.col("n_blocks").cast("string")))
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("n_videos"), F.sum("n_blocks").alias("n_blocks_total"), F.transform(F.sort_array(F.collect_list(F.struct("lang", "line"))), lambda x: x["line"]).alias("videos"))


@query("t6_top_n", "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3")
def t6_top_n(spark, sf_dir):
    """The feature is the limit."""
    return relational.top_n(table(spark, sf_dir, "orders"), ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 3).select("o_custkey", "o_orderkey")


@query("t1_scene_order", "WITH {fr} SELECT video, frame, row_number() OVER (PARTITION BY video ORDER BY coalesce(CASE WHEN value < 20 THEN frame - 1 END, frame), value < 20, frame) AS place FROM fr")
def t1_scene_order(spark, sf_dir):
    """Black scenes by their range's start, others by their first frame; others first on ties."""
    dark_start = F.when(F.col("value") < 20, F.col("frame") - 1)
    w = Window.partitionBy("video").orderBy(F.coalesce(dark_start, F.col("frame")), F.col("value") < 20, "frame")
    return frames(spark, sf_dir).select("video", "frame", F.row_number().over(w).cast("long").alias("place"))


@query("u1_set_union", f"WITH {{fr}}, {RUNS_SQL.replace('{n}', '3')} SELECT fr.video, fr.frame FROM fr JOIN runs ON fr.video = runs.video AND fr.frame BETWEEN \"start\" AND \"end\" UNION SELECT video, frame FROM fr WHERE value > 300")
def u1_set_union(spark, sf_dir):
    long_runs = dark(spark, sf_dir).select("video", F.explode(F.sequence("start", "end")).alias("frame"))
    return long_runs.union(frames(spark, sf_dir).filter("value > 300").select("video", "frame")).distinct()


@query("u5_bag_union", "SELECT doc_id AS id, 'd' AS origin FROM documents UNION ALL SELECT page_id, 'p' FROM pages UNION ALL SELECT item_id, 'b' FROM benchmark")
def u5_bag_union(spark, sf_dir):
    one = lambda name, c, tag: table(spark, sf_dir, name).select(F.col(c).alias("id"), F.lit(tag).alias("origin"))
    return one("documents", "doc_id", "d").unionAll(one("pages", "page_id", "p")).unionAll(one("benchmark", "item_id", "b"))


@query("s18_video_picker", "SELECT page_id, coalesce(nullif(regexp_extract(url, '([^/?#.]+)(\\.[^/]*)?$', 1), ''), CAST(page_id AS VARCHAR)) AS name FROM pages")
def s18_video_picker(spark, sf_dir):
    """The display name is the file's stem, or else the id."""
    name = F.regexp_extract("url", r"([^/?#.]+)(\.[^/]*)?$", 1)
    return table(spark, sf_dir, "pages").select("page_id", F.coalesce(F.when(name != "", name), F.col("page_id").cast("string")).alias("name"))


@query("s13_html_chains", "SELECT page_id, u.link FROM (SELECT page_id, unnest(list_transform(regexp_extract_all(html, 'href=\"(/[^\"]*)\"', 1), lambda x: x)) AS link FROM pages) u")
def s13_html_chains(spark, sf_dir):
    """Rows scraped from a report page by a pattern."""
    return table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="(/[^"]*)"'), F.lit(1))).alias("link"))


