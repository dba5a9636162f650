"""Graph kernels: connected components, cluster names, label propagation. Every round is a written table."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .relational import ranked

#: whispers(): turns in which linked ids never move at once, where an id has as many neighbours at most, on average; ids up to
#: which labels are broadcast; and edges of a part.
ALONE, FEW, PART = 16, 1_000_000, 1 << 19


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", most_rounds: int = 60) -> DataFrame:
    """Id, component (its least id) of all ends of edges.

    In each round every end hooks to the least of itself and its neighbours, hooks are followed to their ends, and the edges
    shrink to those between different ends. Only the least ends of their neighbourhoods stay, half of them at most, so the
    rounds grow with the logarithm of the longest way.
    """
    one = edges.select(F.col(src).alias("a"), F.col(dst).alias("b"))
    left = written(one.union(one.select("b", "a")).distinct(), "edges")
    found = None
    for _ in range(most_rounds):
        to = written(left.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("to")), "hooks")
        while True:
            up = to.select(F.col("id").alias("_i"), F.col("to").alias("_t"))
            on = to.join(up, to["to"] == up["_i"]).select("id", F.col("to").alias("was"), F.col("_t").alias("to"))
            on = written(on, "hooks")
            to = on.select("id", "to")
            if on.filter("was <> to").isEmpty():
                break
        ends = to.select(F.col("id").alias("_i"), F.col("to").alias("_t"))
        found = to if found is None else written(found.join(ends, found["to"] == ends["_i"], "left").select("id", F.coalesce("_t", "to").alias("to")), "labels")
        near = left.join(ends, left["a"] == ends["_i"]).select(F.col("_t").alias("a"), "b")
        left = written(near.join(ends, near["b"] == ends["_i"]).select("a", F.col("_t").alias("b")).filter("a <> b").distinct(), "edges")
        if left.isEmpty():
            return found.select("id", F.col("to").alias("component"))
    raise RuntimeError(f"components didn't settle in {most_rounds} rounds")


def named_clusters(components: DataFrame) -> DataFrame:
    """Cluster names c001, c002, .. by size, then by least member: id, component, cluster, size."""
    sizes = components.groupBy("component").agg(F.count(F.lit(1)).cast("int").alias("size")).filter("size > 1")
    order = ranked(sizes, [F.col("size").desc(), F.col("component")])
    return components.join(order.withColumn("cluster", F.format_string("c%03d", "rank")).drop("rank"), "component").select("id", "component", "cluster", "size")


def persons(ids: DataFrame, edges: DataFrame | None, id_col: str = "id", components: Callable[[], DataFrame] | None = None) -> DataFrame:
    """Every id gets its component, singles too; a lone id in all gets none. components: gives those of the edges, instead of
    edges."""
    if ids.limit(2).count() < 2:
        return ids.select(F.col(id_col).alias("id"), F.lit(None).cast("long").alias("person"))
    comp = components() if components else connected_components(edges)
    return ids.select(F.col(id_col).alias("id")).join(comp, "id", "left").select("id", F.coalesce("component", "id").alias("person"))


def _numbered_edges(edges: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Both directions of edges src, dst, w as s, d, w, with numbers in place of ids, once each, with the largest w; parted by
    s and held, so that sums by s take no shuffle. And n, id, the numbers in the ids' order; and how many there are."""
    one = written(edges.filter("src <> dst"), "whisper-edges")
    ids = written(ranked(one.select(F.col("src").alias("id")).union(one.select("dst")).distinct(), [F.col("id")], "n").select(F.col("n").cast("long").alias("n"), "id"), "whisper-ids")
    count = ids.count()
    near = F.broadcast if count <= FEW else lambda df: df
    a, b = ids.select(F.col("n").alias("s"), F.col("id").alias("_a")), ids.select(F.col("n").alias("d"), F.col("id").alias("_b"))
    known = one.join(near(a), F.col("src") == F.col("_a")).join(near(b), F.col("dst") == F.col("_b")).select("s", "d", "w")
    parts = min(4096, max(edges.sparkSession.sparkContext.defaultParallelism, math.ceil(2 * one.count() / PART)))
    both = known.union(known.select("d", "s", "w")).repartition(parts, "s").groupBy("s", "d").agg(F.max("w").alias("w"))
    return both.persist(StorageLevel.MEMORY_AND_DISK), ids, count


def whispers(edges: DataFrame, most_turns: int = 1000) -> DataFrame:
    """Id, label (the least id of its group) of all ends of edges src, dst, cos.

    An id takes the label with the most weight among its neighbours, of equal ones the least. The original goes through
    the ids in a random order, each seeing what the ones before it did. Here all ids that would change draw a hash of id and
    turn, and those move whose choice stands whatever those of their neighbours do that would change, too, and drew more. So
    the moves of a turn, by falling draws, are a part of some sequential order. Weights are whole numbers of 1e-9, so that
    sums are exact: a move makes the weight of edges inside labels larger, or leaves it and makes a label smaller. So it
    ends, with no id that would change. Ids may be of any type that has an order.

    A choice stands if the votes for it, less those that may leave, outdo those for every other label with those that may
    come. Most neighbours come from and go to labels that don't matter to an id, so most ids move in a turn, however many
    neighbours they have. Where ids have at most ALONE neighbours on average, only those that drew more than all such
    neighbours move in the first ALONE turns. Labels are broadcast while there are at most FEW.
    """
    both, ids, count = _numbered_edges(edges.select("src", "dst", F.round(F.col("cos") * 1e9).cast("long").alias("w")))
    near = F.broadcast if count <= FEW else lambda df: df
    try:
        alone = ALONE if both.count() <= ALONE * count else 0
        labels = written(ids.select("n", "id", F.col("n").alias("label")), "whisper-labels")
        for turn in range(most_turns):
            seen = both.join(near(labels.select(F.col("n").alias("_n"), "label")), F.col("d") == F.col("_n"))
            votes = seen.groupBy("s", "label").agg(F.sum("w").alias("w"))
            best = votes.groupBy("s").agg(F.min(F.struct((-F.col("w")).alias("w"), "label"))["label"].alias("would"))
            drew = F.struct(F.xxhash64("id", F.lit(turn).cast("long")).alias("h"), "n").alias("drew")
            changed = written(best.join(near(labels), F.col("s") == F.col("n")).filter("would <> label").select("n", "would", drew), "whisper-moves")
            if changed.isEmpty():
                break
            own = changed.select(F.col("n").alias("_s"), "would", F.col("drew").alias("_own"))
            others = changed.select(F.col("n").alias("_d"), F.col("would").alias("_to"), F.col("drew").alias("_drew"))
            met = seen.join(near(own), F.col("s") == F.col("_s")).join(near(others), F.col("d") == F.col("_d"), "left").withColumn("_first", F.coalesce(F.col("_drew") > F.col("_own"), F.lit(False)))
            if turn < alone:
                stay = met.filter("_first").select("s").distinct()
            else:
                zero = F.lit(0).cast("long")
                stays = F.struct("label", F.col("w").alias("most"), F.col("w").alias("least"))
                may = lambda c: F.struct(F.col(c).alias("label"), (F.greatest("w", zero) + 1).alias("most"), F.least("w", zero).alias("least"))
                ways = met.select("s", "would", F.explode(F.when(F.col("_first"), F.array(may("label"), may("_to"))).otherwise(F.array(stays))).alias("x")).select("s", "would", "x.*")
                bounds = ways.groupBy("s", "would", "label").agg(F.sum("most").alias("most"), F.sum("least").alias("least"))
                sure = F.max(F.when(F.col("label") == F.col("would"), F.struct("least", (-F.col("label")).alias("l"))))
                rival = F.max(F.when(F.col("label") != F.col("would"), F.struct(F.col("most").alias("least"), (-F.col("label")).alias("l"))))
                stay = bounds.groupBy("s").agg(sure.alias("sure"), rival.alias("rival")).filter("rival > sure").select("s")
            moves = changed.join(stay, F.col("n") == F.col("s"), "left_anti").select(F.col("n").alias("_m"), "would")
            labels = written(labels.join(near(moves), F.col("n") == F.col("_m"), "left").select("n", "id", F.coalesce("would", "label").alias("label")), "whisper-labels")
        else:
            raise RuntimeError(f"labels didn't settle in {most_turns} turns")
    finally:
        both.unpersist()
    least = labels.groupBy(F.col("label").alias("_l")).agg(F.min(F.struct("n", "id"))["id"].alias("least"))
    return labels.join(least, labels["label"] == least["_l"]).select("id", F.col("least").alias("label"))


def numbered_persons(ids: DataFrame, labels: DataFrame) -> DataFrame:
    """Id, person: every id's group, numbered from 0 by first appearance; ids without edges are groups of their own."""
    own = ids.select("id").join(labels, "id", "left").select("id", F.coalesce("label", "id").alias("label"))
    order = ranked(own.select("label").distinct(), [F.col("label")])
    return own.join(order, "label").select("id", (F.col("rank") - 1).alias("person"))


def spanning_forest(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """A maximum spanning forest: those of the edges src, dst, cos that hold every component of cos >= t together, for
    all t at once. Of equal weights the edge with the lesser ends comes first.

    In each round every component takes its best edge to another (at least halving their number), and what is left between
    two components shrinks to its best edge.
    """
    edge = F.struct((-F.col("cos")).alias("w"), F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).alias("edge")
    left = edges.filter("src <> dst AND cos IS NOT NULL").select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"), edge)
    left = written(left.groupBy("a", "b").agg(F.min("edge").alias("edge")), "forest-edges")
    chosen = []
    for _ in range(most_rounds):
        both = left.union(left.select("b", "a", "edge"))
        best = both.groupBy("a").agg(F.min(F.struct("edge", "b")).alias("x")).select("a", "x.b", "x.edge")
        best = written(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "edge").distinct(), "forest")
        chosen.append(best.select("edge.src", "edge.dst", (-F.col("edge.w")).alias("cos")))
        if best.isEmpty():
            out = chosen[0]
            for more in chosen[1:]:
                out = out.union(more)
            return out
        root = connected_components(best, "a", "b")
        ends = left.join(root.select(F.col("id").alias("a"), F.col("component").alias("ra")), "a").join(root.select(F.col("id").alias("b"), F.col("component").alias("rb")), "b").filter("ra <> rb")
        left = written(ends.groupBy(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).agg(F.min("edge").alias("edge")), "forest-edges")
    raise RuntimeError(f"the forest isn't whole after {most_rounds} rounds")


def _at_thresholds(edges: DataFrame, thresholds: list[float]) -> DataFrame:
    """The edges of each threshold, with ends that tell it."""
    at = F.explode(F.filter(F.array(*[F.lit(float(t)) for t in thresholds]), lambda t: t <= F.col("cos"))).alias("thr")
    return edges.select("src", "dst", "cos", at).select(F.struct("thr", F.col("src").alias("id")).alias("src"), F.struct("thr", F.col("dst").alias("id")).alias("dst"), "cos")


def threshold_sweep(ids: DataFrame, edges: DataFrame, thresholds: list[float], method: str = "union", largest: int = 6) -> DataFrame:
    """Thr, persons, sizes (of the `largest` groups, falling) for each threshold.

    method `union`: components of all thresholds side by side, for which edges of vector.cosine_forest() do; `whispers`: G3 on the edges of all
    thresholds side by side. Ids without an edge are persons, too. Sizes are counted before they are sorted, so that no task
    gets a row for each group.
    """
    if method == "union":
        groups = connected_components(_at_thresholds(edges, thresholds)).select("id", F.col("component").alias("label"))
    elif method == "whispers":
        groups = whispers(_at_thresholds(edges, thresholds))
    else:
        raise ValueError(f"method {method}")
    sizes = written(groups.groupBy("label").agg(F.count(F.lit(1)).alias("size")).groupBy(F.col("label.thr").alias("thr"), "size").agg(F.count(F.lit(1)).alias("n")), "sweep")
    every = ids.sparkSession.createDataFrame([(float(t),) for t in thresholds], "thr double").crossJoin(ids.agg(F.count(F.lit(1)).alias("total")))  # one row
    singles = every.join(sizes.groupBy("thr").agg(F.sum(F.col("size") * F.col("n")).alias("inside")), "thr", "left").select("thr", F.lit(1).cast("long").alias("size"), (F.col("total") - F.coalesce("inside", F.lit(0))).alias("n"))
    by_size = F.sort_array(F.collect_list(F.struct("size", "n")), asc=False)
    few = F.slice(F.flatten(F.transform(by_size, lambda x: F.array_repeat(x["size"], F.least(x["n"], F.lit(largest)).cast("int")))), 1, largest)
    return sizes.unionByName(singles).filter("n > 0").groupBy("thr").agg(F.sum("n").alias("persons"), few.alias("sizes"))
