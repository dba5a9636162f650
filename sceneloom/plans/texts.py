"""Queries of the text and numeric functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import text as X
from ..operators import relational
from .base import frames, query, table
from .sequences import SENTENCES_SQL


@query("f1_sentences", f"SELECT doc_id, {SENTENCES_SQL} AS sentences FROM documents")
def f1_sentences(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.split_sentences(F.col("text")).alias("sentences"))


@query(
    "f2_lang",
    r"""WITH c AS (SELECT doc_id, length(text) - length(regexp_replace(text, '[\x{3040}-\x{30FF}]', '', 'g')) AS ja, length(text) - length(regexp_replace(text, '[\x{AC00}-\x{D7AF}]', '', 'g')) AS ko,
length(text) - length(regexp_replace(text, '[\x{4E00}-\x{9FFF}]', '', 'g')) AS han, length(text) - length(regexp_replace(text, '[A-Za-z]', '', 'g')) AS latin FROM documents)
SELECT doc_id, CASE WHEN ja > 0 THEN 'ja' WHEN ko > 0 THEN 'ko' WHEN han >= latin THEN 'zh' ELSE 'en' END AS guess FROM c""",
)
def f2_lang(spark, sf_dir):
    """F2 over the whole text of every document."""
    return table(spark, sf_dir, "documents").select("doc_id", X.guess_language(F.col("text")).alias("guess"))


@query(
    "f3_asr_parse",
    r"""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN CASE lang WHEN 'en' THEN 'en' WHEN 'fr' THEN 'fr' WHEN 'de' THEN 'de' ELSE 'es' END END AS asr_lang,
trim(regexp_replace(CASE WHEN doc_id % 3 = 2 THEN 'plain ' ELSE 'said ' END || text, '<\|[^|]+\|>', '', 'g'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS asr_text FROM documents""",
)
def f3_asr_parse(spark, sf_dir):
    """answers of a recogniser that hold the documents' whole texts, with a known language, an unknown one or none."""
    name = F.when(F.col("lang") == "en", "English").when(F.col("lang") == "fr", "French").when(F.col("lang") == "de", "German").otherwise("Spanish")
    i, t = F.col("doc_id") % 3, F.col("text")
    raw = F.when(i == 0, F.concat(F.lit("language "), name, F.lit("<asr_text>said "), t, F.lit("<|end|>"))).when(i == 1, F.concat(F.lit(" language Klingon<asr_text>said "), t, F.lit(" "))).otherwise(F.concat(F.lit("plain "), t))
    got = table(spark, sf_dir, "documents").select("doc_id", X.parse_asr(raw).alias("p"))
    return got.select("doc_id", F.col("p.lang").alias("asr_lang"), F.col("p.text").alias("asr_text"))


@query(
    "f4_marks",
    """WITH {fr} SELECT video, frame, CAST(video AS VARCHAR) || '_f' || frame || CASE WHEN frame % 3 = 0 THEN '' WHEN frame % 3 = 1 THEN '_c' || lpad(CAST(frame % 40 AS VARCHAR), 3, '0') || 'key' ELSE '_c' || lpad(CAST(frame % 40 AS VARCHAR), 3, '0') || '：' || video || '_f7_c' || lpad(CAST(frame % 40 AS VARCHAR), 3, '0') || 'key' END AS mark,
CAST(video AS VARCHAR) AS mark_video, frame AS mark_frame, CASE WHEN frame % 3 <> 0 THEN frame % 40 END AS cluster, frame % 3 = 1 AS is_key, CASE WHEN frame % 3 = 2 THEN 7 ELSE frame END AS rep_frame FROM fr""",
)
def f4_marks(spark, sf_dir):
    v, f = F.col("video").cast("string"), F.col("frame")
    c = f % 40
    key = X.make_mark(v, f, c, key=True)
    mark = F.when(f % 3 == 0, X.make_mark(v, f)).when(f % 3 == 1, key).otherwise(F.concat(X.make_mark(v, f, c), F.lit(X.COLON), X.make_mark(v, F.lit(7), c, key=True)))
    rows = frames(spark, sf_dir).select("video", "frame", mark.alias("mark")).withColumn("p", X.parse_mark(F.col("mark")))
    return rows.select("video", "frame", "mark", F.col("p.video").alias("mark_video"), F.col("p.frame").alias("mark_frame"), "p.cluster", "p.is_key", "p.rep_frame")


@query("f5_entries", "SELECT doc_id, ['1=' || doc_id || ' again', '2=b', '30=c' || n_chars] AS entries FROM documents")
def f5_entries(spark, sf_dir):
    text = F.concat(F.lit("1|first 2|b 30|c"), F.col("n_chars").cast("string"), F.lit("\n1|"), F.col("doc_id").cast("string"), F.lit(" again"))
    m = X.numbered_entries(text)
    rows = table(spark, sf_dir, "documents").select("doc_id", F.sort_array(F.map_entries(m)).alias("e"))
    return rows.select("doc_id", F.transform("e", lambda x: F.concat(x["key"].cast("string"), F.lit("="), x["value"])).alias("entries"))


_LINE = r"^[0-9a-f]+_f(\d+)(?:.*?[：:]\s*(.*))?$"


@query(
    "f6_description_lines",
    f"""WITH l AS (SELECT doc_id, lower(to_hex(n_chars)) || CASE WHEN source LIKE '%1%' THEN '_g' ELSE '_f' END || doc_id || CASE lang WHEN 'en' THEN ': ' WHEN 'de' THEN '：' WHEN 'es' THEN '_c001key： ' ELSE '' END || regexp_replace(text, '\\s+', ' ', 'g') AS line FROM documents)
SELECT doc_id, CASE WHEN regexp_matches(line, '{_LINE}') THEN CAST(regexp_extract(line, '{_LINE}', 1) AS INTEGER) END AS frame, CASE WHEN regexp_matches(line, '{_LINE}') THEN regexp_extract(line, '{_LINE}', 2) END AS said FROM l""",
)
def f6_description_lines(spark, sf_dir):
    """lines made of whole texts, marks and colons by what a row holds; the SQL parses them with the pattern itself."""
    mark = F.when(F.col("source").like("%1%"), "_g").otherwise("_f")
    colon = F.when(F.col("lang") == "en", ": ").when(F.col("lang") == "de", "：").when(F.col("lang") == "es", "_c001key： ").otherwise("")
    line = F.concat(F.lower(F.hex("n_chars")), mark, F.col("doc_id").cast("string"), colon, F.regexp_replace("text", r"\s+", " "))
    rows = table(spark, sf_dir, "documents").select("doc_id", X.description_line(line).alias("p"))
    return rows.select("doc_id", "p.frame", F.col("p.text").alias("said"))


@query("f7_split_once", "SELECT conv_id, turn, role AS head, text AS tail FROM conversations")
def f7_split_once(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", X.split_once(F.concat_ws("|", "role", "text"), "|").alias("p"))
    return rows.select("conv_id", "turn", "p.head", "p.tail")


@query(
    "f8_transcript",
    """WITH s AS (SELECT conv_id, turn, text, role, CASE WHEN turn % 4 = 0 THEN '无' ELSE role || ',x' END AS who, turn % 3 = 0 AS seen, turn % 2 = 1 AS heard FROM conversations)
SELECT conv_id, string_agg('Scene' || turn || ' [persons: ' || who || ']' || CASE WHEN seen THEN chr(10) || '  画面:' || chr(10) || '    F' || turn || ' a picture' || chr(10) || '    F' || (turn + 1) ELSE '' END
|| CASE WHEN heard THEN chr(10) || '  对白:' || chr(10) || '    ' || role || ': ' || text || chr(10) || '    a plain line' ELSE '' END || CASE WHEN seen OR heard THEN '' ELSE chr(10) || '  (None)' END, chr(10) || chr(10) ORDER BY turn) AS transcript FROM s GROUP BY conv_id""",
)
def f8_transcript(spark, sf_dir):
    """F8: conversations as videos, their turns as scenes with or without persons, pictures and lines."""
    turn, none = F.col("turn"), F.array().cast("array<string>")
    who = F.when(turn % 4 == 0, none).otherwise(F.array("role", F.lit("x")))
    seen = F.when(turn % 3 == 0, F.array(F.format_string("F%d a picture", turn), F.format_string("F%d", turn + 1))).otherwise(none)
    said = F.when(turn % 2 == 1, F.array(F.concat_ws("|", "role", "text"), F.lit("a plain line"))).otherwise(none)
    rows = table(spark, sf_dir, "conversations").withColumn("para", X.scene_text(turn, who, seen, said))
    return relational.ordered_list(rows, ["conv_id"], ["turn"], "para", "paras").select("conv_id", X.transcript(F.col("paras")).alias("transcript"))


@query("f9_prompt", "SELECT doc_id, '{{n}} scenes, at most ' || (n_chars // 100) || ', {\"a\": ' || doc_id || '}' AS prompt FROM documents".replace("{{n}}", "{'|| doc_id ||'}"))
def f9_prompt(spark, sf_dir):
    """Doubled braces aren't unescaped."""
    t = F.lit('{{n}} scenes, at most {n_max}, {"a": {n}}')
    out = X.fill_prompt(t, {"n": F.col("doc_id"), "n_max": F.floor(F.col("n_chars") / 100).cast("long")})
    return table(spark, sf_dir, "documents").select("doc_id", out.alias("prompt"))


@query("f10_escape", "SELECT page_id, replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;') AS escaped FROM pages")
def f10_escape(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.escape_html(F.col("html")).alias("escaped"))


@query("f10_stem", "SELECT doc_id, 'clip.' || doc_id AS stem FROM documents")
def f10_stem(spark, sf_dir):
    """Names without folders and endings; the hash of the name beside it is tested apart."""
    return table(spark, sf_dir, "documents").select("doc_id", X.stem(F.concat(F.lit("/in/a.b/clip."), F.col("doc_id").cast("string"), F.lit(".mp4"))).alias("stem"))


@query("f11_time", "WITH {fr} SELECT video, frame, CAST(trunc(frame / 23.976 * 1000) AS INTEGER) AS ms, CAST(trunc(CAST(trunc(frame / 23.976 * 1000) AS INTEGER) / 1000.0 * 23.976) AS INTEGER) AS back FROM (SELECT video, CAST(frame AS DOUBLE) AS frame FROM fr)")
def f11_time(spark, sf_dir):
    rows = frames(spark, sf_dir).select("video", F.col("frame").cast("double").alias("frame"), X.frame_to_ms(F.col("frame"), 23.976).alias("ms"))
    return rows.withColumn("back", X.ms_to_frame(F.col("ms"), 23.976))


@query("f12_clock", "SELECT event_id, (CAST(round_even(value, 0) AS BIGINT) // 60) || ':' || lpad(CAST(CAST(round_even(value, 0) AS BIGINT) % 60 AS VARCHAR), 2, '0') AS clock, 3600000 + CAST(floor(value) AS BIGINT) * 1000 + 7 AS ms FROM events")
def f12_clock(spark, sf_dir):
    s = F.floor("value").cast("long")
    stamp = F.format_string("01:%02d:%02d,007", F.floor(s / 60).cast("long"), s % 60)
    return table(spark, sf_dir, "events").select("event_id", X.clock(F.col("value")).alias("clock"), X.srt_ms(stamp).alias("ms"))


@query("f14_rounding", "SELECT event_id, round_even(CAST(CAST(value AS INTEGER) AS DOUBLE) / 2, 0) AS half_even, CAST(trunc(-value) AS INTEGER) AS truncated FROM events")
def f14_rounding(spark, sf_dir):
    half = F.rint("value").cast("int").cast("double") / 2
    return table(spark, sf_dir, "events").select("event_id", N.round_half_even(half).alias("half_even"), (-F.col("value")).cast("int").alias("truncated"))


@query("f15_overlap", "SELECT event_id, greatest(0.0, least(value, 120.0) - greatest(value / 2, 30.0)) AS overlap FROM events")
def f15_overlap(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", N.overlap_length(F.col("value") / 2, F.col("value"), F.lit(30.0), F.lit(120.0)).cast("double").alias("overlap"))


@query("f16_arrays", "WITH a AS (SELECT o_custkey, list(o_orderkey % 7 ORDER BY o_orderkey) AS x FROM orders GROUP BY 1) SELECT o_custkey, x[1:3] AS head, len(x) AS n, list_contains(x, 3) AS has3, list_sort(list_distinct(x)) AS uniq FROM a")
def f16_arrays(spark, sf_dir):
    rows = relational.ordered_list(table(spark, sf_dir, "orders").withColumn("m", F.col("o_orderkey") % 7), ["o_custkey"], ["o_orderkey"], "m", "x")
    return rows.select("o_custkey", F.slice("x", 1, 3).alias("head"), F.size("x").cast("long").alias("n"), F.array_contains("x", 3).alias("has3"), F.array_sort(F.array_distinct("x")).alias("uniq"))


@query(
    "f18_boundaries",
    r"""WITH w AS (SELECT conv_id, turn, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS ws, length(text) % 2 = 0 AS closed FROM conversations),
a AS (SELECT conv_id, turn, closed, '{"boundaries": [' || array_to_string(list_transform(ws, lambda x: CASE WHEN x LIKE '%s' THEN '"Scene' || len(x) || '"' WHEN x LIKE '%e%' THEN '"' || len(x) || ',' || (2 * len(x)) || '"' WHEN x LIKE '%.' THEN '"no"' ELSE CAST(3 * len(x) AS VARCHAR) END), ', ') || CASE WHEN closed THEN ']}' ELSE '}' END AS answer FROM w),
n AS (SELECT conv_id, turn, CASE WHEN closed THEN list_transform(regexp_extract_all(answer, '"Scene[0-9]+"|"[0-9]+,[0-9]+"|[0-9]+'), lambda x: CAST(regexp_extract(x, '([0-9]+)"?$', 1) AS INTEGER))
  ELSE list_transform(regexp_extract_all(answer, '"[0-9]+,[0-9]+"'), lambda x: CAST(regexp_extract(x, ',([0-9]+)', 1) AS INTEGER)) END AS found FROM a)
SELECT conv_id, turn, list_sort(list_distinct(found)) AS boundaries FROM n""",
)
def f18_boundaries(spark, sf_dir):
    """answers made of whole texts, a number in one of its forms for each word, every second array left open."""
    words = F.filter(F.split("text", r"\s+"), lambda x: x != "")
    n = lambda x: F.char_length(x).cast("string")
    item = lambda x: (
        F.when(x.endswith("s"), F.concat(F.lit('"Scene'), n(x), F.lit('"'))).when(x.contains("e"), F.concat(F.lit('"'), n(x), F.lit(","), (2 * F.char_length(x)).cast("string"), F.lit('"')))
        .when(x.endswith("."), F.lit('"no"')).otherwise((3 * F.char_length(x)).cast("string"))
    )
    end = F.when(F.char_length("text") % 2 == 0, "]}").otherwise("}")
    answer = F.concat(F.lit('{"boundaries": ['), F.array_join(F.transform(words, item), ", "), end)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", X.parse_boundaries(answer).alias("boundaries"))


@query("f19_json_object", "SELECT doc_id, CAST(n_chars AS BIGINT) AS n, lang AS emotion FROM documents")
def f19_json_object(spark, sf_dir):
    """A block's JSON out of an answer's prose."""
    answer = F.concat(F.lit("Sure: "), F.to_json(F.struct(F.col("n_chars").alias("n"), F.col("lang").alias("emotion"))), F.lit(" done"))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.from_json(X.json_object(answer), "n long, emotion string").alias("p"))
    return rows.select("doc_id", "p.n", "p.emotion")


@query("f20_scene_numbers", "SELECT doc_id, [CAST(doc_id AS INTEGER), CAST(n_chars AS INTEGER)] AS scenes FROM documents")
def f20_scene_numbers(spark, sf_dir):
    text = F.concat(F.lit("Scene"), F.col("doc_id").cast("string"), F.lit(" to Scene"), F.col("n_chars").cast("string"))
    return table(spark, sf_dir, "documents").select("doc_id", X.scene_numbers(text).alias("scenes"))


BOX_SQL = "bx AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) * 20 AS x1, l_linenumber * 90 AS y1, CAST(l_quantity AS INTEGER) * 30 + 40 AS x2, l_linenumber * 90 + CAST(l_quantity AS INTEGER) * 5 + 10 AS y2 FROM lineitem)"


def boxes(spark, sf_dir):
    q, n = F.col("l_quantity").cast("int"), F.col("l_linenumber").cast("int")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (q * 20).alias("x1"), (n * 90).alias("y1"), (q * 30 + 40).alias("x2"), (n * 90 + q * 5 + 10).alias("y2"))


@query(
    "f21_crop",
    f"""WITH {BOX_SQL}, c AS (SELECT *, CAST(x1 + x2 AS DOUBLE) / 2 AS cx, CAST(y1 + y2 AS DOUBLE) / 2 AS cy, CAST(greatest(x2 - x1, y2 - y1) AS DOUBLE) * CAST(1.3 AS DOUBLE) AS side FROM bx),
o AS (SELECT l_orderkey, l_linenumber, cx - side / 2 AS a0, cx - side / 2 + side AS a1, cy - side / 2 AS b0, cy - side / 2 + side AS b1 FROM c),
i AS (SELECT l_orderkey, l_linenumber, CASE WHEN a0 < 0 THEN 0 ELSE a0 END AS a0, CASE WHEN a0 < 0 THEN a1 - a0 ELSE a1 END AS a1, CASE WHEN b0 < 0 THEN 0 ELSE b0 END AS b0, CASE WHEN b0 < 0 THEN b1 - b0 ELSE b1 END AS b1 FROM o)
SELECT l_orderkey, l_linenumber, CAST(trunc(CASE WHEN a1 > 1920 THEN a0 - (a1 - 1920) ELSE a0 END) AS INTEGER) AS x1, CAST(trunc(CASE WHEN b1 > 1080 THEN b0 - (b1 - 1080) ELSE b0 END) AS INTEGER) AS y1,
       CAST(trunc(least(a1, 1920)) AS INTEGER) AS x2, CAST(trunc(least(b1, 1080)) AS INTEGER) AS y2 FROM i""",
)
def f21_crop(spark, sf_dir):
    c = N.square_crop(*[F.col(x) for x in ("x1", "y1", "x2", "y2")], F.lit(1920), F.lit(1080))
    return boxes(spark, sf_dir).withColumn("c", c).select("l_orderkey", "l_linenumber", "c.x1", "c.y1", "c.x2", "c.y2")


@query("p18_body_ratio", f"WITH {BOX_SQL} SELECT l_orderkey, l_linenumber, y2 - y1 AS tall FROM bx WHERE CAST(y2 - y1 AS DOUBLE) >= 1080 * CAST(0.2 AS DOUBLE)")
def p18_body_ratio(spark, sf_dir):
    """P18."""
    rows = boxes(spark, sf_dir).filter(relational.tall_enough(F.col("y1"), F.col("y2"), F.lit(1080)))
    return rows.select("l_orderkey", "l_linenumber", (F.col("y2") - F.col("y1")).alias("tall"))


@query(
    "f22_pad",
    f"""WITH {BOX_SQL}, p AS (SELECT *, CAST(greatest(x2 - x1, y2 - y1) AS DOUBLE) * CAST(0.35 AS DOUBLE) AS pad FROM bx WHERE x2 > x1 AND y2 > y1),
r AS (SELECT l_orderkey, l_linenumber, CAST(round_even(greatest(0, x1 - pad), 0) AS INTEGER) AS x1, CAST(round_even(greatest(0, y1 - pad), 0) AS INTEGER) AS y1, CAST(round_even(least(1920, x2 + pad), 0) AS INTEGER) AS x2, CAST(round_even(least(1080, y2 + pad), 0) AS INTEGER) AS y2 FROM p)
SELECT * FROM r WHERE x2 > x1 AND y2 > y1""",
)
def f22_pad(spark, sf_dir):
    p = N.padded_box(*[F.col(x) for x in ("x1", "y1", "x2", "y2")], F.lit(1920), F.lit(1080), 0.35)
    rows = boxes(spark, sf_dir).select("l_orderkey", "l_linenumber", p.alias("p")).filter("p IS NOT NULL")
    return rows.select("l_orderkey", "l_linenumber", "p.x1", "p.y1", "p.x2", "p.y2")


@query(
    "f25_tokens",
    """WITH s AS (SELECT p_partkey, p_size * 40 + 100 AS w, CASE WHEN p_partkey % 3 = 0 THEN 360 ELSE 1080 END AS h FROM part), t AS (SELECT p_partkey, greatest(1, CAST(round_even(CAST(w * 540 AS DOUBLE) / h, 0) AS INTEGER)) AS w FROM s)
SELECT p_partkey, w AS width, CAST(ceil(w / 32) * ceil(540 / 32) AS INTEGER) AS tokens FROM t""",
)
def f25_tokens(spark, sf_dir):
    """frames are scaled to a height of 540, small ones up."""
    w = N.scaled_width(F.col("p_size") * 40 + 100, F.when(F.col("p_partkey") % 3 == 0, 360).otherwise(1080))
    return table(spark, sf_dir, "part").select("p_partkey", w.alias("width"), N.visual_tokens(w, F.lit(540)).alias("tokens"))


@query("f28_lines", "SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN '' ELSE '[zh]' END || role || ': ' || text AS line FROM conversations")
def f28_lines(spark, sf_dir):
    lang = F.when(F.col("turn") % 2 == 0, "none").otherwise("zh")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", X.speaker_line(lang, F.col("role"), F.col("text")).alias("line"))


@query(
    "f30_work_size",
    """WITH s AS (SELECT p_partkey, CAST(p_size * 40 + 400 AS BIGINT) AS w, CASE WHEN p_partkey % 3 = 0 THEN 360 ELSE 1080 END AS h FROM part), t AS (SELECT p_partkey, CASE WHEN w >= h THEN w * 960 // h ELSE 960 END AS a, CASE WHEN w >= h THEN 960 ELSE h * 960 // w END AS b FROM s)
SELECT p_partkey, CAST(a + a % 2 AS INTEGER) AS work_w, CAST(b + b % 2 AS INTEGER) AS work_h FROM t""",
)
def f30_work_size(spark, sf_dir):
    h = F.when(F.col("p_partkey") % 3 == 0, 360).otherwise(1080)  # some smaller than the size wanted
    rows = table(spark, sf_dir, "part").select("p_partkey", N.work_size((F.col("p_size") * 40 + 400).cast("int"), h).alias("s"))
    return rows.select("p_partkey", F.col("s.w").alias("work_w"), F.col("s.h").alias("work_h"))


@query("p14_key_marks", "WITH {fr} SELECT video, list('v_f' || frame || '_key' ORDER BY frame) AS marks FROM fr WHERE frame % 2 = 0 GROUP BY video")
def p14_key_marks(spark, sf_dir):
    mark = F.when(F.col("frame") % 2 == 0, F.concat(F.lit("v_f"), F.col("frame").cast("string"), F.lit("_key"))).otherwise(F.concat(F.lit("v_f"), F.col("frame").cast("string")))
    rows = relational.ordered_list(frames(spark, sf_dir).withColumn("mark", mark), ["video"], ["frame"], "mark", "m")
    return rows.select("video", relational.key_marks(F.col("m")).alias("marks"))


@query("p21_boundary_edits", "SELECT o_custkey, list_sort(list_distinct(list_filter(list(CAST(o_orderkey % 50 AS INTEGER) - 5), lambda b: b > 0 AND b < 30))) AS boundaries FROM orders GROUP BY 1")
def p21_boundary_edits(spark, sf_dir):
    """P12, P21."""
    rows = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list((F.col("o_orderkey") % 50).cast("int") - 5).alias("b"))
    return rows.select("o_custkey", relational.valid_boundaries(F.col("b"), F.lit(30)).alias("boundaries"))


@query(
    "p25_conformance",
    r"""WITH m AS (SELECT page_id, list_transform(regexp_split_to_array(regexp_extract(url, '//(.*)$', 1), '[/.?&=#]'), lambda x: x || '_f' || len(x)) AS marks FROM pages)
SELECT page_id, len(marks) > 0 AND len(list_filter(marks, lambda x: NOT regexp_matches(x, '^[0-9A-Za-z_]+_f[0-9]+'))) = 0 AS ok FROM m""",
)
def p25_conformance(spark, sf_dir):
    """P25: the parts of an address as marks; empty ones and those with other characters don't conform."""
    parts = F.split(F.regexp_extract("url", r"//(.*)$", 1), r"[/.?&=#]")
    marks = F.transform(parts, lambda x: F.concat(x, F.lit("_f"), F.char_length(x).cast("string")))
    return table(spark, sf_dir, "pages").select("page_id", relational.conforms(marks).alias("ok"))


@query("p15_header", "SELECT doc_id, lang, source FROM documents")
def p15_header(spark, sf_dir):
    """The columns that later stages copy."""
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source")


@query("s4_fps", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 25.0 WHEN 1 THEN 24.0 WHEN 2 THEN 50.0 ELSE round(30000 / 1001, 6) END AS fps, CAST(round_even(p_size * CASE p_partkey % 4 WHEN 0 THEN 25.0 WHEN 1 THEN 24.0 WHEN 2 THEN 50.0 ELSE CAST(30000 AS DOUBLE) / 1001 END, 0) AS BIGINT) AS n_frames FROM part")
def s4_fps(spark, sf_dir):
    """The first usable rate; frames from the duration."""
    i = F.col("p_partkey") % 4
    fps = N.fps_of(F.when(i == 0, 25.0), F.when(i == 1, 24.0), F.when(i == 2, 0.02))
    return table(spark, sf_dir, "part").select("p_partkey", F.round(fps, 6).alias("fps"), F.rint(F.col("p_size") * fps).cast("long").alias("n_frames"))
