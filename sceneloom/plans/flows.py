"""Queries of sources, sinks, providers, streams and the assembly flow."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import numeric as N
from ..operators import interval, relational
from ..session import shared_folder, written
from ..sources import files, providers, sinks
from ..streaming import online
from .base import ORACLE_SQL, frames, query, table
from .sequences import SCORE_SQL, SHOTS_SQL, shots


@query("st2_stream_cuts", ORACLE_SQL["w1_cut_score"])
def st2_stream_cuts(spark, sf_dir):
    """ST1, ST2: the batch query's rows, from a stream."""
    events = online.event_stream(spark, f"{sf_dir}/events.parquet")
    out = online.run_to_end(online.stream_scores(events.select(F.col("user_id").alias("video"), "event_id", "value"), "video", "event_id", "value"), "st2")
    return out.select("video", "frame", F.round("mafd", 6).alias("mafd"), F.round("score", 6).alias("score"))


def with_totals(events, spark, sf_dir):
    """A stream of events as frames, with the number of frames that each video's header names. Headers are a written table, which
    the batches of a stream read anew."""
    headers = written(table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("video")).agg(F.count(F.lit(1)).cast("int").alias("total")), "headers")
    return events.select(F.col("user_id").alias("video"), "event_id", "value").join(headers, "video")


@query(
    "st3_stream_shots",
    """WITH {fr}, m AS (SELECT *, coalesce(abs(value - lag(value) OVER w), 0.0) AS mafd, lag(value) OVER w AS pv FROM fr WINDOW w AS (PARTITION BY video ORDER BY frame)),
sc AS (SELECT *, CASE WHEN pv IS NULL THEN 0.0 ELSE least(greatest(least(mafd, abs(mafd - lag(mafd, 1, 0.0) OVER (PARTITION BY video ORDER BY frame))), 0.0), 100.0) END AS score FROM m),
c AS (SELECT video, 0 AS b, total FROM fr WHERE frame = 0 UNION SELECT video, frame - 1, total FROM sc WHERE score >= 40 AND frame - 1 > 0)
SELECT video, CAST(row_number() OVER w - 1 AS INTEGER) AS shot, CAST(b AS INTEGER) AS "start", CAST(lead(b, 1, total) OVER w - 1 AS INTEGER) AS "end" FROM c WINDOW w AS (PARTITION BY video ORDER BY b)""",
)
def st3_stream_shots(spark, sf_dir):
    events = online.event_stream(spark, f"{sf_dir}/events.parquet")
    return online.run_to_end(online.stream_shots(with_totals(events, spark, sf_dir), "video", "event_id", "value", 40.0, "total"), "st3")


@query(
    "st2_stream_dark_runs",
    """WITH {fr}, dk AS (SELECT video, frame, total, frame - row_number() OVER (PARTITION BY video ORDER BY frame) AS run FROM fr WHERE value < 20),
r AS (SELECT video, min(frame) AS s, max(frame) AS e, max(frame) = max(total) - 1 AS last FROM dk GROUP BY video, run)
SELECT video, s AS "start", e AS "end" FROM r WHERE CASE WHEN last THEN e - s >= 2 ELSE e + 1 - s >= 2 END""",
)
def st2_stream_dark_runs(spark, sf_dir):
    """ST2, W2: dark runs from a stream, whose state is an open run's first frame."""
    events = online.event_stream(spark, f"{sf_dir}/events.parquet")
    return online.run_to_end(online.stream_dark_runs(with_totals(events, spark, sf_dir), "video", "event_id", "value", 20.0, 2, "total"), "st2-dark")


@query(
    "st2_stream_pool",
    f"""WITH RECURSIVE {{fr}}, {SCORE_SQL}, k AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY video, shot ORDER BY frame) AS i FROM (SELECT video, frame,
  sum(CASE WHEN score >= 40 AND frame > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY video ORDER BY frame) AS shot,
  CAST(round(mafd + greatest(0.0, (value % 10) / 100 - 0.05) * 8 + (1 - greatest(0.0, least(1.0, 1 - abs(value / 500 - 0.5) * 3))) * 0.5, 6) AS DOUBLE) AS r FROM sc)),
f(video, shot, i, pool) AS (SELECT video, shot, i, [{{{{'a': frame, 'r': r}}}}] FROM k WHERE i = 1 UNION ALL SELECT video, shot, i, CASE
  WHEN near > 0 THEN CASE WHEN r < pool[near].r THEN pool[:near - 1] || [new] || pool[near + 1:] ELSE pool END
  WHEN len(pool) < 3 THEN pool || [new]
  WHEN r < pool[worst].r THEN pool[:worst - 1] || [new] || pool[worst + 1:] ELSE pool END
 FROM (SELECT k.video, k.shot, k.i, f.pool, k.r, {{{{'a': k.frame, 'r': k.r}}}} AS new, coalesce(list_position(list_transform(f.pool, lambda p: abs(p.a - k.frame) <= 2), true), 0) AS near,
       list_position(list_transform(f.pool, lambda p: p.r), list_max(list_transform(f.pool, lambda p: p.r))) AS worst FROM f JOIN k ON k.video = f.video AND k.shot = f.shot AND k.i = f.i + 1)),
e AS (SELECT video, shot, unnest(pool) AS p FROM f QUALIFY row_number() OVER (PARTITION BY video, shot ORDER BY i DESC) = 1),
c AS (SELECT video, 0 AS b, total FROM fr WHERE frame = 0 UNION SELECT video, frame - 1, total FROM sc WHERE score >= 40 AND frame - 1 > 0),
sh AS (SELECT video, row_number() OVER w - 1 AS shot, b AS s, lead(b, 1, total) OVER w - 1 AS e FROM c WINDOW w AS (PARTITION BY video ORDER BY b))
SELECT video, CAST(shot AS INTEGER) AS shot, CAST(s AS INTEGER) AS "start", CAST(sh.e AS INTEGER) AS "end", p.a AS frame, p.r AS rank FROM e JOIN sh USING (video, shot)""".replace("{{", "{").replace("}}", "}"),
)
def st2_stream_pool(spark, sf_dir):
    """ST2, T4: the candidates of each shot from a stream, with the shot."""
    events = with_totals(online.event_stream(spark, f"{sf_dir}/events.parquet"), spark, sf_dir)
    penalty = N.candidate_rank(F.lit(0.0), (F.col("value") % 10) / 100, N.brightness_score(F.col("value") / 500))
    pool = online.run_to_end(online.stream_pool(events.withColumn("penalty", penalty), "video", "event_id", "value", "penalty", 40.0, "total", 2, 3), "st2-pool")
    return pool.select("video", "shot", "start", "end", "frame", "rank")


@query("k1_artifacts", f'WITH {{fr}}, {SHOTS_SQL} SELECT CAST(video AS BIGINT) AS video, CAST(shot AS INTEGER) AS shot, "start", CAST("end" AS INTEGER) AS "end" FROM shots')
def k1_artifacts(spark, sf_dir):
    """Shots as nested JSON artefacts, written and read again."""
    path = f"{shared_folder(spark)}/artifacts-{uuid.uuid4().hex}"
    rows = shots(spark, sf_dir).select("video", "shot", F.struct("start", "end").alias("range"))
    sinks.write_artifacts(sinks.nested(rows, ["video"], ["shot"], "shots"), path)
    back = spark.read.schema("video long, shots array<struct<shot:int,range:struct<start:int,end:int>>>").json(path)
    return back.select("video", F.explode("shots").alias("s")).select("video", "s.shot", "s.range.start", "s.range.end")


@query("s19_tolerant_shots", f'WITH {{fr}}, {SHOTS_SQL} SELECT CAST(video AS BIGINT) AS video, CAST(shot AS INTEGER) AS id, "start", CAST("end" AS INTEGER) AS "end" FROM shots WHERE shot % 4 <> 3')
def s19_tolerant_shots(spark, sf_dir):
    """Malformed shots of a text go."""
    rows = shots(spark, sf_dir)
    text = F.when(F.col("shot") % 4 == 3, F.concat(F.lit('{"id": '), F.col("shot").cast("string"), F.lit(', "range": {"start": 9, "end": 3}}'))).otherwise(F.to_json(F.struct(F.col("shot").alias("id"), F.struct("start", "end").alias("range"))))
    whole = relational.ordered_list(rows.withColumn("o", text), ["video"], ["shot"], "o", "o").select("video", F.concat(F.lit('{"video": 1, "shots": ['), F.array_join("o", ", "), F.lit("], trailing")).alias("text"))
    return files.shots_from_text(whole, ["video"], "text").select("video", "id", "start", "end")


@query("s9_srt", "SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS id, 3600000 + turn * 1000 AS start_ms, 3600500 + turn * 1000 AS end_ms, 'line ' || turn || ' of ' || conv_id AS text FROM conversations WHERE turn % 5 <> 4")
def s9_srt(spark, sf_dir):
    """Subtitles written as texts and parsed; entries without text go."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    body = F.when(F.col("turn") % 5 == 4, "").otherwise(F.concat(F.lit("line "), F.col("turn").cast("string"), F.lit("\n of "), F.col("conv_id").cast("string"), F.lit("\n")))
    stamp = lambda ms: F.format_string("01:00:%02d," + ms, "turn")
    entry = F.concat((F.col("turn") + 1).cast("string"), F.lit("\n"), stamp("000"), F.lit(" --> "), stamp("500"), F.lit("\n"), body, F.lit("\n"))
    whole = relational.ordered_list(rows.withColumn("entry", entry), ["conv_id"], ["turn"], "entry", "e").select("conv_id", F.array_join("e", "").alias("srt"))
    return files.parse_srt(whole, ["conv_id"], "srt").select("conv_id", "id", "start_ms", "end_ms", "text")


@query("x1_providers")
def x1_providers(spark, sf_dir):
    """Inputs inferred once and handed out."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "source")
    return providers.once_per(rows, "face_present", "source", ["doc_id"])


@query("x8_answers")
def x8_answers(spark, sf_dir):
    """A language model's boundaries for each conversation, parsed."""
    from ..functions.text import parse_boundaries

    rows = table(spark, sf_dir, "conversations").select("conv_id").distinct()
    return providers.infer(rows, "llm", "conv_id", ["conv_id"]).select("conv_id", relational.valid_boundaries(parse_boundaries(F.col("answer")), F.lit(50)).alias("boundaries"))


@query(
    "e3_assembled",
    f"""WITH {{fr}}, {SHOTS_SQL}, d AS (SELECT video, frame, 'd' || frame AS txt FROM fr WHERE value > 150),
x AS (SELECT s.video, s.shot, s."start" AS s, s."end" AS e, list_sort(list(DISTINCT fr.kind)) AS persons, coalesce(list(fr.kind || '|' || fr.frame ORDER BY fr.frame) FILTER (fr.value > 100), []) AS lines FROM shots s JOIN fr ON fr.video = s.video AND fr.frame BETWEEN s."start" AND s."end" GROUP BY ALL)
SELECT CAST(x.video AS BIGINT) AS video, CAST(shot AS INTEGER) AS shot, persons, lines, d.txt AS picture FROM x ASOF LEFT JOIN d ON x.video = d.video AND x.s > d.frame""",
)
def e3_assembled(spark, sf_dir):
    """E3 (J14, J18, A9, A22): scenes with their persons, lines, and the last picture described before them."""
    fr, sh = frames(spark, sf_dir), shots(spark, sf_dir)
    inside = interval.points_in_intervals(fr.select("video", "frame", "kind", "value"), sh, ["video"], "frame", "start", "end", 16)
    said = F.when(F.col("value") > 100, F.struct("frame", F.concat_ws("|", "kind", F.col("frame").cast("string")).alias("line")))
    scenes = inside.groupBy("video", "shot").agg(F.sort_array(F.collect_set("kind")).alias("persons"), F.transform(F.sort_array(F.collect_list(said)), lambda x: x["line"]).alias("lines"), F.min("start").alias("start"))
    described = fr.filter("value > 150").select("video", F.col("frame").alias("at"), F.concat(F.lit("d"), F.col("frame").cast("string")).alias("txt"))
    return interval.as_of(scenes, described, ["video"], "start", "at", "txt", name="picture").select("video", "shot", "persons", "lines", "picture")


@query(
    "s10_subtitles",
    """SELECT doc_id, '/in/' || source || '/Clip' || doc_id || '.mp4' AS path, '/in/' || source || '/Clip' || doc_id || CASE doc_id % 6 WHEN 0 THEN '.srt' WHEN 1 THEN '.ass' WHEN 2 THEN '.ass' WHEN 3 THEN '.SRT' END AS subtitle FROM documents""",
)
def s10_subtitles(spark, sf_dir):
    """Subtitles of the same folder and stem; of several `.srt`, then `.ass`, then endings in another case."""
    i, clip = F.col("doc_id") % 6, F.concat(F.lit("/in/"), "source", F.lit("/Clip"), F.col("doc_id").cast("string"))
    videos = table(spark, sf_dir, "documents").select("doc_id", F.concat(clip, F.lit(".mp4")).alias("path"))
    names = F.when(i == 0, F.array(F.lit(".ass"), F.lit(".srt"))).when(i == 1, F.array(F.lit(".ass"))).when(i == 2, F.array(F.lit(".SRT"), F.lit(".ass"))).when(i == 3, F.array(F.lit(".SRT"), F.lit(".txt"))).otherwise(F.array(F.lit("b.srt")))
    found = table(spark, sf_dir, "documents").select(F.explode(F.transform(names, lambda e: F.concat(clip, e))).alias("path"))
    other = table(spark, sf_dir, "documents").filter("doc_id % 6 = 5").select(F.lower(clip).alias("path")).withColumn("path", F.concat("path", F.lit(".srt")))
    return files.subtitles_for(videos, found.union(other)).select("doc_id", "path", "subtitle")


@query("k5_transcripts", "SELECT role, conv_id || ' ' || turn || ' ' || replace(replace(text, chr(10), ' '), chr(13), ' ') AS line FROM conversations")
def k5_transcripts(spark, sf_dir):
    """K5: lines written as text files in order, a folder for each key, and read again."""
    path = f"{shared_folder(spark)}/transcripts-{uuid.uuid4().hex}"
    rows = table(spark, sf_dir, "conversations").withColumn("line", F.concat_ws(" ", F.col("conv_id").cast("string"), F.col("turn").cast("string"), F.translate("text", "\n\r", "  ")))
    sinks.write_transcript(rows.select("role", "conv_id", "turn", "line"), ["role"], ["conv_id", "turn"], "line", path)
    return spark.read.schema("value string, role string").text(path).select("role", F.col("value").alias("line"))


@query(
    "p22_best_track",
    """WITH t AS (SELECT p_size, p_partkey, ['H264', 'hevc', 'AV1', 'vp9', 'theora', 'vc1', NULL][p_partkey % 7 + 1] AS codec FROM part), k AS (SELECT *, list_position(['h264', 'hevc', 'av1', 'vp9', 'vp8', 'mpeg2', 'vc1'], lower(codec)) AS r FROM t)
SELECT p_size, p_partkey, codec FROM k WHERE r > 0 QUALIFY row_number() OVER (PARTITION BY p_size ORDER BY r, p_partkey) = 1""",
)
def p22_best_track(spark, sf_dir):
    """Of a file's tracks that with the preferred codec; unknown ones don't count."""
    codec = F.element_at(F.array(*[F.lit(c) for c in ("H264", "hevc", "AV1", "vp9", "theora", "vc1", None)]), (F.col("p_partkey") % 7 + 1).cast("int"))
    tracks = table(spark, sf_dir, "part").select("p_size", "p_partkey", codec.alias("codec"))
    return files.best_track(tracks.filter(files.known_codec(F.col("codec"))), ["p_size"], "codec", "p_partkey")


@query("s16_picture_sizes", "SELECT p_partkey, CASE WHEN p_partkey % 5 <> 4 THEN p_size * 32 END AS width, CASE WHEN p_partkey % 5 <> 4 THEN p_size + 1000 END AS height FROM part")
def s16_picture_sizes(spark, sf_dir):
    """Sizes from the frame headers of JPEG files, of which some have none."""
    number = lambda c: F.lpad(F.hex(c.cast("int")), 4, "0")
    head = F.concat(F.lit("FFD8FFE000104A46494600010100000100010000FFC2001108"), number(F.col("p_size") + 1000), number(F.col("p_size") * 32), F.lit("0301220002110103110100"))
    content = F.unhex(F.when(F.col("p_partkey") % 5 == 4, F.lit("FFD8FFD9")).otherwise(head))
    size = table(spark, sf_dir, "part").select("p_partkey", files.jpeg_size(content).alias("s"))
    return size.select("p_partkey", "s.width", "s.height")
