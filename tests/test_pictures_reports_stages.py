"""Frame measures beside loops over pixels, locked columns and resampling beside plain forms, pages, and stale stages."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sceneloom.operators import pictures
from sceneloom.sources import files, sinks, stages


def by_pixel(y, uv):
    h, w = y.shape
    tout = vrep = brng = 0
    for r in range(h):
        vrep += r >= 4 and sum(abs(int(y[r - 4, c]) - int(y[r, c])) for c in range(w)) < w
        for c in range(w):
            u, v = uv[r // 2, 2 * (c // 2)], uv[r // 2, 2 * (c // 2) + 1]
            brng += not (16 <= y[r, c] <= 235 and 16 <= u <= 240 and 16 <= v <= 240)
            if 1 <= r < h - 1 and 1 <= c < w - 1:
                hit = True
                for j in (1, 2) if 2 <= r < h - 2 else (1,):
                    for i in (-1, 0, 1):
                        a, b, d = int(y[r - j, c + i]), int(y[r, c + i]), int(y[r + j, c + i])
                        hit &= (abs(a - b) + abs(d - b)) // 2 - abs(a - d) > 4
                tout += hit
    return tout, vrep, brng


def boxes_by_pixel(y, size):
    h, w = y.shape
    out = np.zeros((size, size), int)
    for r in range(size):
        for c in range(size):
            top, left = r * h // size, c * w // size
            part = y[top : max((r + 1) * h // size, top + 1), left : max((c + 1) * w // size, left + 1)]
            out[r, c] = int(part.sum()) // part.size
    return out


@pytest.mark.parametrize("w,h,size", [(8, 8, 4), (20, 12, 8), (6, 4, 5), (2, 2, 3), (34, 30, 16)])
def test_frame_measures(spark, w, h, size):
    r = np.random.RandomState(w)
    rows, want = [], {}
    for k in range(6):
        y = r.randint(0, 256, (h, w), dtype=np.uint8) if k < 3 else np.tile(r.randint(0, 4, (1, w)) + 100, (h, 1)).astype(np.uint8)
        if k > 3:
            y[h // 2] = 200  # a line that stands out
        uv = r.randint(0, 256, (h // 2, w), dtype=np.uint8) if k % 2 else np.full((h // 2, w), 128, np.uint8)
        rows.append((k, y.tobytes() + uv.tobytes()))
        small = boxes_by_pixel(y.astype(int), size)
        lap = [4 * small[a, b] - small[a, b - 1] - small[a, b + 1] - small[a - 1, b] - small[a + 1, b] for a in range(1, size - 1) for b in range(1, size - 1)]
        want[k] = (*by_pixel(y, uv), int(small.sum()), float(np.var(lap)))
    df = spark.createDataFrame([*rows, (9, None)], "k int, content binary")
    got = pictures.frame_measures(df, ["k"], "content", w, h, size).withColumn("sharp", pictures.sharpness(F.col("lap_sum"), F.col("lap_squares"), size)).collect()
    for x in got:
        if x.k == 9:
            assert (x.tout, x.brng, x.box_sum, x.sharp) == (0, w * h, 0, 0.0) and x.vrep == max(0, h - 4)
            continue
        assert (x.tout, x.vrep, x.brng, x.box_sum) == want[x.k][:4] and abs(x.sharp - want[x.k][4]) < 1e-6
    with pytest.raises(Exception, match="bytes"):
        pictures.frame_measures(spark.createDataFrame([(1, b"abc")], "k int, content binary"), ["k"], "content", w, h, size).collect()
    with pytest.raises(ValueError):
        pictures.frame_measures(df, ["k"], "content", 7, 8)


def test_locked_columns(spark):
    r = random.Random(1)
    rows = [(f, x := r.randint(-40, 300), x + r.randint(-3, 90), 300) for f in range(40) for _ in range(r.randint(1, 5))] + [(99, 10, 10, 300), (98, 0, 300, 300)]
    got = {x.f: x for x in pictures.locked_columns(spark.createDataFrame(rows, "f int, a int, b int, w int"), ["f"], "a", "b", "w").collect()}
    want: dict = {}
    for f, a, b, w in rows:
        want.setdefault(f, set()).update(range(max(a, 0), min(b, w)))
    for f, columns in want.items():
        if not columns:
            assert f not in got
            continue
        mine = {x["word"] * pictures.WORD + i for x in got[f].words for i in range(pictures.WORD) if x["bits"] >> i & 1}
        assert mine == columns and got[f].n_locked == len(columns)


def test_resampled(spark):
    r = random.Random(3)
    for n in (1, 5, 200, 700):
        x = [r.random() for _ in range(n)]
        locked = [c for c in range(n) if r.random() < 0.1]
        w = [1.0 if c in locked or x[c] >= np.quantile(x, 0.75) else 0.5 for c in range(n)]
        total, sums = 0.0, []
        for v in w:
            total += v
            sums.append(total)
        m = max(64, round(total))
        want = [min(n - 1, sum(s <= total * k / max(1, m - 1) for s in sums)) for k in range(m)]
        assert pictures.resampled(np.array(x), 0.5, np.array(locked)).tolist() == want
    assert (np.diff(pictures.resampled(np.linspace(0, 1, 300), 0.3, kept_part=None)) >= 0).all()
    out = pictures.resampled_columns(spark.createDataFrame([(1, [1.0, 2.0], [1, 9]), (2, None, None)], "k int, x array<double>, l array<int>"), ["k"], "x", "l", least=3).orderBy("k").collect()
    assert out[0]["columns"] == [0, 1, 1] and out[1]["columns"] == []


def test_matrices_round_trip_and_errors(spark):
    df = spark.createDataFrame([(1, 5, [1.0, 2.0]), (1, 3, [0.5, 0.0]), (2, 9, [4.0, 4.0])], "v int, f long, e array<float>")
    stored = sinks.matrix_files(df, ["v"], "f", "e").select(F.col("v").cast("string").alias("path"), "content")
    assert sorted((x.path, x.frame, x.embedding) for x in files.matrices(stored).collect()) == [("1", 3, [0.5, 0.0]), ("1", 5, [1.0, 2.0]), ("2", 9, [4.0, 4.0])]
    for bad in ([(1, 5, [1.0]), (1, 5, [2.0])], [(1, 5, [float("nan")])]):
        stored = sinks.matrix_files(spark.createDataFrame(bad, "v int, f long, e array<float>"), ["v"], "f", "e").select(F.lit("x").alias("path"), "content")
        with pytest.raises(Exception, match="unique ids"):
            files.matrices(stored).collect()


def test_locked_columns_shuffle_once(spark):
    df = spark.createDataFrame([(f, x, x + 70, 540) for f in range(20) for x in (3, 200)], "f int, a int, b int, w int")
    plan = pictures.locked_columns(df, ["f"], "a", "b", "w")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, "<b> & \"q\""), (1, 1, None), (2, 1, "x")], "v int, k int, t string")
    sinks.write_reports(df, "v", ["k"], ["k", "t"], str(tmp_path / "r"), F.concat(F.lit("No. <"), F.col("v").cast("string")))
    got = {x.v: x.html for x in sinks.read_reports(spark, str(tmp_path / "r"), "v").collect()}
    assert set(got) == {1, 2} and "<title>No. &lt;1</title>" in got[1]
    assert got[1].index("<tr><td>1</td><td></td></tr>") < got[1].index("<tr><td>2</td><td>&lt;b&gt; &amp; &quot;q&quot;</td></tr>")
    assert got[1].endswith("</table></body></html>\n") and got[1].count("<table>") == 1


def test_reports_of_many_keys_are_few_files(spark, tmp_path):
    """The same pages as apart, whatever keys and texts hold."""
    texts = [None, "", "</html>\n", "\r\n</body></html>\n", "é \u2028 <!DOCTYPE html>"]
    df = spark.createDataFrame([(f"{v}\n</html>" if v % 2 else str(v), k, t) for v in range(60) for k, t in enumerate(texts)] + [(None, 0, "x")], "v string, k int, t string")
    sinks.write_reports(df, "v", ["k"], ["k", "t"], str(tmp_path / "few"), F.col("v"), apart=False)
    assert len(list((tmp_path / "few").glob("**/part-*"))) <= 4
    sinks.write_reports(df.filter("v IS NOT NULL").withColumn("n", F.substring_index("v", "\n", 1).cast("int")), "n", ["k"], ["k", "t"], str(tmp_path / "apart"), F.col("v"))
    got = {x.v: x.html for x in sinks.read_reports(spark, str(tmp_path / "few"), "v", apart=False).collect()}
    want = {x.n: x.html for x in sinks.read_reports(spark, str(tmp_path / "apart"), "n").collect()}
    assert len(got) == 61 and None in got
    assert {int(v.split("\n")[0]): html for v, html in got.items() if v is not None} == want


def test_report_query_writes_few_files(spark):
    from sceneloom.plans.queries import QUERIES

    pages = QUERIES["k9_reports"](spark, "/root/testdata/sf0.01")
    assert len(pages.inputFiles()) <= 4 < pages.count()


def test_only_stale_stages_run(spark, tmp_path):
    """A chain a -> b -> d and c -> d: one changed input runs its own stages alone; equal bytes end the chain."""
    p = lambda name: str(tmp_path / name)
    runs = []

    def put(name, values):
        (tmp_path / name).mkdir(exist_ok=True)
        (tmp_path / name / "x.txt").write_text("\n".join(values) + "\n")

    def stage(name, inputs, make, version="1"):
        def run(s):
            runs.append(name)
            lines = sorted(r.value for i in inputs for r in s.read.text(p(i)).collect())
            put(f"out-{name}", make(lines))

        return stages.Stage(name, tuple(p(i) for i in inputs), (p(f"out-{name}"),), run, version)

    def chain(version="1"):
        return [
            stage("d", ["out-b", "out-c"], lambda x: x),
            stage("b", ["out-a"], lambda x: [v[:1] for v in x]),
            stage("a", ["in1"], lambda x: [v.upper() for v in x], version),
            stage("c", ["in2"], lambda x: x),
        ]

    def go(version="1"):
        runs.clear()
        ran = stages.run_stale(spark, chain(version), p("manifest"))
        assert ran == runs
        return ran

    put("in1", ["one", "two"])
    put("in2", ["zzz"])
    assert sorted(go()) == ["a", "b", "c", "d"]
    assert go() == []
    put("in2", ["yyy"])
    assert go() == ["c", "d"]
    put("in1", ["one", "two"])  # written anew with the same content
    assert go() == []
    put("in1", ["one", "twist"])  # b's output stays as it was, so d doesn't run
    assert go() == ["a", "b"]
    assert go("2") == ["a"]  # other code, the same output
    (tmp_path / "out-c" / "x.txt").unlink()
    assert go("2") == ["c"]  # made again, as it was
    put("out-b", ["meddled"])
    assert go("2") == ["b"]
    put("in1", ["eins"])
    assert go("2") == ["a", "b", "d"] and go("2") == []
    with pytest.raises(ValueError, match="circle"):
        stages.in_order([stages.Stage("x", ("p",), ("q",), print), stages.Stage("y", ("q",), ("p",), print)])
    with pytest.raises(ValueError, match="one name"):
        stages.in_order([stages.Stage("x", ("p",), ("q",), print), stages.Stage("y", ("q",), ("q",), print)])


def test_a_stage_that_fails_is_stale_again(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.txt").write_text("a\n")
    fails = [True]

    def run(s):
        if fails[0]:
            raise RuntimeError("stopped")
        (tmp_path / "out").mkdir()
        (tmp_path / "out" / "y.txt").write_text("b\n")

    one = [stages.Stage("one", (str(tmp_path / "in"),), (str(tmp_path / "out"),), run)]
    with pytest.raises(RuntimeError):
        stages.run_stale(spark, one, str(tmp_path / "m"))
    fails[0] = False
    assert stages.run_stale(spark, one, str(tmp_path / "m")) == ["one"]
    assert stages.run_stale(spark, one, str(tmp_path / "m")) == []
