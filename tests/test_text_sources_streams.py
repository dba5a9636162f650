import io
import struct

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sceneloom.functions import numeric as N
from sceneloom.functions import text as X
from sceneloom.operators import relational
from sceneloom.sources import files, providers, sinks
from sceneloom.streaming import online

SF = "/root/testdata/sf0.001"


def value(spark, column):
    return spark.range(1).select(column.alias("x")).collect()[0].x


def test_sentences_and_languages(spark):
    assert value(spark, X.split_sentences(F.lit("はい。行こう！Oh no. i mean"))) == ["はい", "行こう", "Oh no. i mean"]
    for t, want in (("はい", "ja"), ("안녕", "ko"), ("你好", "zh"), ("hello", "en"), ("123", "zh"), ("", "zh"), ("你 a", "zh")):
        assert value(spark, X.guess_language(F.lit(t))) == want


def test_asr(spark):
    got = lambda t: tuple(value(spark, X.parse_asr(F.lit(t))))
    assert got("language Japanese<asr_text>はい。<|end|>") == ("ja", "はい。")
    assert got("language Klingon<asr_text>x") == (None, "x")
    assert got("  plain <|a|>text ") == (None, "plain text") and got(None) == (None, "")


def test_marks(spark):
    p = value(spark, X.parse_mark(F.lit("aa11bb_f40_c002：cc22dd_f7_c002key")))
    assert (p.video, p.frame, p.cluster, p.is_key, p.rep_video, p.rep_frame) == ("aa11bb", 40, 2, False, "cc22dd", 7)
    assert value(spark, X.is_cluster_key(F.lit("aa_f1_c002key"))) and not value(spark, X.is_cluster_key(F.lit("aa_f1_key")))
    assert [value(spark, X.segment_mark(F.lit(m))) for m in ("a_f1", "a_f1_c001key", "a_f2_c001：a_f1_c001key")] == ["a_f1_key", "a_f1_c001key", "a_f2_c001"]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ('x {"boundaries":[3,"Scene7","8,9","12"]} y', [3, 7, 9, 12]), ("none", []), ('{"boundaries": []}', []), ('{"boundaries": ["Scenex", "a,b", "1,2,3", " 5 "]}', [5]),
        ('{"boundaries": ["1,4" "2,6"]}', [4, 6]), ('{"boundaries":[1,2}', [1, 2] and []),
    ],
)
def test_boundaries(spark, text, want):
    assert value(spark, X.parse_boundaries(F.lit(text))) == want


def test_small_texts(spark):
    def fnv(s):
        h = 0x811C9DC5
        for b in s.encode():
            h = (h ^ b) * 0x01000193 & 0xFFFFFFFF
        return f"{h & 0xFFFFFF:06x}"

    for s in ("", "a", "héllo world"):
        assert value(spark, X.fnv1a_24(F.lit(s))) == fnv(s)
    assert value(spark, X.numbered_entries(F.lit("1|a b 2|c\n1|d"))) == {1: "d", 2: "c"}
    assert value(spark, X.fill_prompt(F.lit("{{n}} {n_max}"), {"n": F.lit(3), "n_max": F.lit(9)})) == "{3} 9"
    assert value(spark, X.stem(F.lit("/a/b.c/d.e.mp4"))) == "d.e" and value(spark, X.stem(F.lit(".hidden"))) == ".hidden"
    assert value(spark, X.frame_to_ms(F.lit(1001), 23.976)) == int(1001 / 23.976 * 1000)
    assert value(spark, X.json_object(F.lit('a {"b": {"c": 1}} d'))) == '{"b": {"c": 1}}'


def test_numbers(spark):
    assert abs(sum(N.gaussian_weights()) - 1) < 1e-12 and len(N.gaussian_weights()) == 25
    assert value(spark, N.round_half_even(F.lit(2.5))) == 2 and value(spark, N.brightness_score(F.lit(0.5))) == 1.0
    assert abs(value(spark, N.cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(1.0)))) - 0.5**0.5) < 1e-12


def test_listings_and_subtitles(spark, tmp_path):
    for n in ("b.MKV", "a.mp4", "a.SRT", "a.ass", "note.txt", "sub/c.mov", "B.srt"):
        p = tmp_path / n
        p.parent.mkdir(exist_ok=True)
        p.write_text("x")
    v = files.list_videos(spark, str(tmp_path))
    assert [r.name for r in v.collect()] == ["a.mp4", "b.MKV"]
    assert files.list_videos(spark, str(tmp_path), deep=True).count() == 3
    subs = spark.read.format("binaryFile").load(str(tmp_path / "*")).select("path")
    got = {r.name: (r.subtitle or "").rsplit("/", 1)[-1] for r in files.subtitles_for(v, subs).collect()}
    assert got == {"a.mp4": "a.ass", "b.MKV": ""}
    assert files.first_in_folder(files.list_videos(spark, str(tmp_path), True)).count() == 2


def test_srt(spark, tmp_path):
    (tmp_path / "x.srt").write_bytes("﻿1\r\n00:00:01,000 --> 00:00:02,500\r\nline one\r\n two\r\n\r\n2\r\n00:00:03,000 --> 00:00:04,000\r\n\r\n3\n01:00:05,000 --> 01:00:06,000\nlast".encode())
    got = files.read_srt(spark, str(tmp_path)).orderBy("id").collect()
    assert [(r.id, r.start_ms, r.end_ms, r.text, r.lang, r.speaker) for r in got] == [(0, 1000, 2500, "line one two", "none", -1), (1, 3605000, 3606000, "last", "none", -1)]


def test_artifacts(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"fps": 2.0, "mafd": [1.0, 2.0], "sharp": [5.0, 6.0, 7.0]}')
    (tmp_path / "b.json").write_text("{broken")
    art = files.read_artifacts(spark, str(tmp_path), "fps double, mafd array<double>, sharp array<double>")
    rows = files.feature_rows(art.filter("fps IS NOT NULL"), ["file_name"], ["mafd", "sharp"]).orderBy("frame").collect()
    assert [(r.frame, r.mafd, r.sharp) for r in rows] == [(0, 1.0, 5.0), (1, 2.0, 6.0), (2, None, 7.0)]
    flags = files.flag_rows(spark.createDataFrame([("v", {"3": True, "x": False})], "v string, m map<string,boolean>"), ["v"], "m", "face").collect()
    assert [(r.frame, r.face) for r in flags] == [(3, True)]


def test_matrices(spark, tmp_path):
    np.savez(tmp_path / "a.npz", embeddings=np.eye(3, dtype=np.float16), frame_ids=np.array([4, 9, 2]))
    got = files.read_matrices(spark, str(tmp_path)).orderBy("frame").collect()
    assert [(r.frame, r.embedding.index(1.0)) for r in got] == [(2, 2), (4, 0), (9, 1)]
    bad = io.BytesIO()
    np.savez(bad, embeddings=np.eye(2), frame_ids=np.array([1, 1]))
    (tmp_path / "b.npz").write_bytes(bad.getvalue())
    with pytest.raises(Exception, match="unique ids"):
        files.read_matrices(spark, str(tmp_path)).collect()


def test_pictures_and_pixels(spark):
    sof = b"\xff\xd8\xff\xe0" + struct.pack(">H", 4) + b"ab" + b"\xff\xc0" + struct.pack(">HBHH", 11, 8, 1080, 1920) + b"\x00" * 20
    df = spark.createDataFrame([(bytearray(sof),), (bytearray(b"\xff\xd8nothing here at all"),)], "content binary")
    got = [(r.s.width, r.s.height) for r in df.select(files.jpeg_size("content").alias("s")).collect()]
    assert got == [(1920, 1080), (None, None)]
    pix = files.frames_with_pixels(spark.createDataFrame([(1,), (2,)], "f int"), spark.createDataFrame([(1, bytearray(b"a"))], "f int, content binary"), ["f"]).orderBy("f").collect()
    assert bytes(pix[0].content) == b"a" and len(pix[1].content) == files.FRAME_BYTES and not any(pix[1].content)
    tracks = spark.createDataFrame([("m", 0, "VP9"), ("m", 1, "hevc"), ("m", 2, "odd")], "file string, t int, codec string")
    assert [r.t for r in files.best_track(tracks, ["file"], "codec", "t").collect()] == [1]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 0, 1), ("a", 1, 2), ("b", 0, 3)], "video string, o int, x int")
    path = str(tmp_path / "t")
    assert [sinks.append_new(df, path, ["video", "o"]) for _ in range(2)] == [3, 0]
    assert sinks.append_new(df.union(spark.createDataFrame([("c", 9, 9)], df.schema)), path, ["video", "o"]) == 1
    nest = sinks.nested(df, ["video"], ["o"], "rows").orderBy("video").collect()
    assert [x.x for x in nest[0].rows] == [1, 2]
    sinks.write_transcript(df.withColumn("line", F.col("x").cast("string")), ["video"], ["o"], "line", str(tmp_path / "txt"))
    assert [r.value for r in spark.read.text(str(tmp_path / "txt" / "video=a")).collect()] == ["1", "2"]
    assert sinks.or_empty(spark, str(tmp_path / "none"), df.schema).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        sinks.or_empty(spark, str(tmp_path / "none"), df.schema, required=True)
    codes = sinks.run_commands(df, lambda r: ["sh", "-c", f"exit {r.x}"]).collect()
    assert sorted(r.code for r in codes) == [1, 2, 3]
    assert sinks.count_mismatches(df, df.filter("x < 3").withColumn("x", F.when(F.col("x") == 2, 5).otherwise(F.col("x"))), ["video", "o"], "x").count() == 2
    sinks.write_by_video(df, str(tmp_path / "v"))
    assert spark.read.parquet(str(tmp_path / "v")).filter("video = 'a'").count() == 2


def test_providers(spark):
    df = spark.createDataFrame([(i, f"k{i % 3}") for i in range(12)], "id long, k string")
    for name in providers.REGISTRY:
        a, b = (sorted(map(str, providers.infer(df, name, "k", ["id"]).collect())) for _ in range(2))
        assert a == b
    once = providers.once_per(df, "vlm", "k", ["id"]).collect()
    assert len(once) == 12 and len({r.description for r in once}) == 3

    class Flaky:
        def __call__(self, xs):
            if len(xs) > 1 or xs[0] == "k1":
                raise RuntimeError("no")
            return [(f"ok {xs[0]}",)]

    providers.REGISTRY["flaky"] = providers.Provider("said string", Flaky)
    try:
        got = {r.k: r.said for r in providers.infer(df, "flaky", "k", ["k"]).collect()}
    finally:
        del providers.REGISTRY["flaky"]
    assert got == {"k0": "ok k0", "k1": None, "k2": "ok k2"}
    turns = spark.createDataFrame([(1, 0, "B"), (1, 1, "A"), (1, 2, "B")], "v int, o int, label string")
    assert [r.speaker for r in providers.speaker_numbers(turns, ["v"], "o", "label").orderBy("o").collect()] == [0, 1, 0]


def test_stream_equals_batch_over_several_batches(spark, tmp_path):
    from sceneloom.operators import sequence
    from sceneloom.plans.base import frames

    events = spark.read.parquet(f"{SF}/events.parquet").select(F.col("user_id").alias("video"), "event_id", "value").toPandas()
    for i, part in enumerate(np.array_split(events, 4)):
        pd.DataFrame(part).to_parquet(tmp_path / f"{i}.parquet", index=False)
        import os
        import time

        os.utime(tmp_path / f"{i}.parquet", (time.time() - 100 + i, time.time() - 100 + i))
    stream = spark.readStream.schema("video long, event_id long, value double").option("maxFilesPerTrigger", 1).parquet(str(tmp_path))
    got = online.run_to_end(online.stream_scores(stream, "video", "event_id", "value"), "test")
    want = sequence.cut_scores(frames(spark, SF), ["video"], "frame", "value").select("video", "frame", "mafd", "score")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_a_second_run_takes_what_is_new(spark, tmp_path):
    """ST7: the same folder for table and checkpoint."""
    source, base = tmp_path / "in", str(tmp_path / "base")
    frames = lambda n, at: spark.createDataFrame([(1, at + i, float(i % 7 * 40)) for i in range(n)], "video long, event_id long, value double").coalesce(1)
    read = lambda: spark.readStream.schema("video long, event_id long, value double").parquet(str(source))
    frames(20, 0).write.parquet(str(source))
    first = online.run_to_end(online.stream_scores(read(), "video", "event_id", "value"), "again", base).count()
    frames(5, 20).write.mode("append").parquet(str(source))
    table = online.run_to_end(online.stream_scores(read(), "video", "event_id", "value"), "again", base)
    assert first == 20 and sorted(r.frame for r in table.collect()) == list(range(25))
    assert online.run_to_end(online.stream_scores(read(), "video", "event_id", "value"), "again", base).count() == 25


def test_open_shots_and_runs_end_with_the_video(spark, tmp_path):
    values = [float(x) for x in (10, 10, 300, 10, 10, 10, 5, 5, 5)]
    rows = [(1, i, v, 9) for i, v in enumerate(values)] + [(2, i, v, None) for i, v in enumerate(values)] + [(3, 0, 1.0, 1)]
    for i, some in enumerate((rows[:4] + rows[9:12], rows[4:9] + rows[12:])):
        spark.createDataFrame(some, "video long, event_id long, value double, total int").coalesce(1).write.parquet(str(tmp_path / "in" / f"{i}"))
    read = lambda: spark.readStream.schema("video long, event_id long, value double, total int").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    shots = online.run_to_end(online.stream_shots(read(), "video", "event_id", "value", 40.0, "total"), "ends").collect()
    assert sorted((r.start, r.end) for r in shots if r.video == 1) == [(0, 0), (1, 8)]
    assert [(r.start, r.end) for r in shots if r.video == 2] == [(0, 0)] and [(r.start, r.end) for r in shots if r.video == 3] == [(0, 0)]
    runs = lambda least: sorted((r.start, r.end) for r in online.run_to_end(online.stream_dark_runs(read(), "video", "event_id", "value", 8.0, least, "total"), "dark").collect() if r.video == 1)
    assert runs(2) == [(6, 8)] and runs(3) == []


def test_too_few_frames_are_an_error(spark):
    headers = spark.createDataFrame([(1, 9), (2, 3)], "video int, total int")
    frames = spark.createDataFrame([(1, i) for i in range(5)] + [(2, i) for i in range(3)], "video int, frame int")
    assert {r.video: r.total for r in relational.decoded_totals(headers, frames, ["video"], "total").collect()} == {1: 5, 2: 3}
    with pytest.raises(Exception, match="too few frames"):
        relational.decoded_totals(headers, frames.filter("video = 1 OR frame = 0"), ["video"], "total").collect()


def test_transcripts_and_sizes_as_they_are_written(spark):
    none = F.array().cast("array<string>")
    said = F.array(F.lit("A|hi | there"), F.lit("plain"))
    assert value(spark, X.scene_text(F.lit(3), F.array(F.lit("p1"), F.lit("p2")), F.array(F.lit("F1: x"), F.lit("F2")), said)) == "Scene3 [persons: p1,p2]\n  画面:\n    F1: x\n    F2\n  对白:\n    A: hi | there\n    plain"
    assert value(spark, X.scene_text(F.lit(0), none, none, none)) == "Scene0 [persons: 无]\n  (None)"
    crop = lambda *b: tuple(value(spark, N.square_crop(*[F.lit(x) for x in b])))
    assert crop(10, 10, 24, 20, 100, 100)[:3:2] == (7, 26)
    assert crop(0, 0, 50, 20, 100, 100) == (0, 0, 65, 65) and crop(80, 40, 100, 60, 100, 100) == (74, 37, 100, 63)
    assert tuple(value(spark, N.work_size(F.lit(640), F.lit(360)))) == (1706, 960) and tuple(value(spark, N.work_size(F.lit(1080), F.lit(1921)))) == (960, 1708)


def test_fill_from_key_rules(spark):
    rows = [("c1", 0, None, True), ("c1", 1, "a", True), ("c1", 2, "b", True), ("c1", 3, None, False), ("c2", 4, " ", True), ("c2", 5, None, False)]
    df = spark.createDataFrame(rows, "c string, i int, v string, k boolean")
    got = {r.i: r.v for r in relational.fill_from_key(df, "c", "i", "v", F.col("k"), F.col("v")).collect()}
    assert got == {0: "a", 1: "a", 2: "b", 3: "a", 4: " ", 5: None}
    with pytest.raises(Exception, match="no key value for cluster c2"):
        relational.fill_from_key(df, "c", "i", "v", F.col("k"), F.col("v"), required=True).collect()


def test_streamed_pool_equals_batch_over_several_batches(spark, tmp_path):
    """T4 with a list in the state: the shots' candidates as the batch fold finds them, and an open shot stays in the state."""
    import random

    from pyspark.sql import Window

    from sceneloom.operators import folds, sequence

    r = random.Random(6)
    rows = [(v, i, float(r.choice([10, 12, 14, 90, 200]) + r.random()), r.random(), 120 if v != 3 else None) for v in range(4) for i in range(120)]
    schema = "video long, event_id long, value double, penalty double, total int"
    for part in range(6):
        spark.createDataFrame([x for x in rows if part * 20 <= x[1] < part * 20 + 20], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = online.run_to_end(online.stream_pool(stream, "video", "event_id", "value", "penalty", 40.0, "total", 3, 4), "pool", listed=True)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    scores = sequence.cut_scores(spark.createDataFrame(rows, schema), ["video"], "event_id", "value")
    shot = F.sum(F.when((F.col("score") >= 40) & (F.col("event_id") > 1), 1).otherwise(0)).over(Window.partitionBy("video").orderBy("event_id")).cast("int")
    ranked = scores.withColumns({"shot": shot, "rank": F.round(F.col("mafd") + F.col("penalty"), 6)})
    want = folds.candidate_pool(ranked, ["video", "shot"], "event_id", "rank", 3, 4)
    mine, batch = ({(x[0], x[1], x[2], round(x[3], 6)) for x in df.collect()} for df in (got, want))
    last = max(x[1] for x in batch if x[0] == 3)
    assert mine == {x for x in batch if x[:2] != (3, last)} and len(mine) > 100


def test_streamed_pool_has_its_shots_from_one_stream(spark, tmp_path, monkeypatch):
    """Starts and ends as the stream of shots has them, over several batches; the query runs one stream, and counts frames of
    the whole table once for all batches."""
    from sceneloom.plans import flows

    rows = [(v, i, float((i * 7 + v) % 5 * 60), 0.25, 60 if v else None) for v in range(3) for i in range(60)]
    schema = "video long, event_id long, value double, penalty double, total int"
    for part in range(3):
        spark.createDataFrame([x for x in rows if part * 20 <= x[1] < part * 20 + 20], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    pool = online.run_to_end(online.stream_pool(stream, "video", "event_id", "value", "penalty", 40.0, "total", 2, 3), "pool")
    shots = online.run_to_end(online.stream_shots(stream, "video", "event_id", "value", 40.0, "total"), "shots")
    found = {(x.video, x.shot, x.start, x.end) for x in pool.collect()}
    assert found == {(x.video, x.shot, x.start, x.end) for x in shots.collect()} and len(found) > 10
    runs, run_to_end, seen = [], online.run_to_end, []
    monkeypatch.setattr(online, "run_to_end", lambda s, *a, **k: runs.append(s) or run_to_end(s, *a, **k))
    monkeypatch.setattr(flows, "written", lambda df, name, w=flows.written: seen.append(name) or w(df, name))
    flows.st2_stream_pool(spark, "/root/testdata/sf0.001")
    assert len(runs) == 1 and seen == ["headers"]
