"""Mixing sources to target weights.

Sources, in order of code points with null last, weigh 5, 2, 1 in turn and share 100 % of all words. No
source's target exceeds `epochs` times its words; what is over is shared out by weight among the others until
none is above. A target is met by whole epochs of the source and a cut: documents get hash-random keys, are
sorted by key within their source in ranges of the key, distributed prefix sums of words run along them, and
the cut is where the sum is nearest to what the whole epochs leave. Documents are taken whole, so a source's
words miss the target by half a document's at most.

Size is the number of runs of anything but spaces and ASCII white space; a null text has none. Documents of
size 0 go with the cut at their place. Rows of null source are a source of their own. Rows that repeat a doc_id have
one key, stand side by side in the order and count each for itself; rows with a null doc_id have a key for each text, as
they may be many. An empty table gives no rows. Other columns are ignored (mix) or kept, whatever their names
(mixed_documents). Texts of any length are one size each. Sources are held to be few enough that a row for each can be
sorted in one task (millions; the windows of targets() see nothing else).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, written

# Weights of the sources, in turn.
WEIGHTS = (5, 2, 1)
EPOCHS = 3
#: Rows in a range of keys, about, and the most ranges (their sums are what prefix sums run along).
ROWS_PER_RANGE, MOST_RANGES = 400, 100_000


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """source, source_size, target, from (source, source_size): one row for each source.

    Sources that reach their cap first are those with the least cap for their weight. In that order, a source
    is capped if its weight's part of what the capped ones before it leave is at least its cap.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weigh = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.pmod(F.col("_i") - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = sizes.withColumn("_i", F.row_number().over(by_name)).withColumn("_w", weigh).withColumn("_cap", (F.col("source_size") * epochs).cast("long"))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), "_i")
    everything = Window.partitionBy(F.lit(0))
    rows = rows.withColumns(
        {
            "_total": F.sum("source_size").over(everything),
            "_before": F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "_left_w": F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        }
    ).withColumn("_capped", F.col("_w") * (F.col("_total") - F.col("_before")) >= F.col("_cap") * F.col("_left_w"))
    rows = rows.withColumns(
        {
            "_rest": F.col("_total") - F.coalesce(F.sum(F.when(F.col("_capped"), F.col("_cap"))).over(everything), F.lit(0)),
            "_rest_w": F.sum(F.when(~F.col("_capped"), F.col("_w"))).over(everything),
        }
    )
    target = F.when(F.col("_capped"), F.col("_cap").cast("double")).otherwise((F.col("_w") * F.col("_rest")).cast("double") / F.col("_rest_w"))
    return rows.select("source", "source_size", target.alias("target"))


def random_key(doc_id: Column, text: Column, seed: str) -> Column:
    """A hash-random key of 32 hexadecimal digits: of the id, or of the text where there is none."""
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce(text.cast("string"), F.lit("")))))))


def _placed(documents: DataFrame, seed: str, weights: tuple[int, ...], epochs: int) -> DataFrame:
    """Each document with its key, its source's size and target, whole epochs, and whether the cut takes it."""
    rows = written(
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text"), size_of(F.col("text").cast("string")).alias("size"))
        .withColumn("_key", random_key(F.col("doc_id"), F.col("text"), seed)).drop("text"), "mix-sizes",
    )
    ranges = min(MOST_RANGES, max(1, rows.count() // ROWS_PER_RANGE))
    # ranges of equal width: keys are uniform, so ranges of a source hold about as many rows
    ranged = rows.withColumn("_range", F.floor(F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") * F.lit(ranges) / F.lit(1 << 32)).cast("int"))
    sums = ranged.groupBy("source", "_range").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sums.withColumn("_shift", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    goal = targets(sums.groupBy("source").agg(F.sum("_sum").alias("source_size")), weights, epochs)
    known = shifts.join(goal.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).select(F.col("source").alias("_s"), F.col("_range").alias("_r"), "_shift", "source_size", "target")
    here = Window.partitionBy("source", "_range").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranged.withColumn("_in", F.sum("size").over(here)).join(known, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_range") == F.col("_r")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    middle = F.col("_shift") + F.col("_in") - F.col("size") / 2
    cut = (F.col("_whole") < epochs) & (middle <= F.col("target") - F.col("_whole") * F.col("source_size"))
    return placed.withColumn("_whole", F.least(whole, F.lit(epochs))).withColumn("_cut", cut)


def mix(documents: DataFrame, seed: str = "mix", weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, times (how often the mix takes the document)."""
    times = (F.col("_whole") + F.col("_cut").cast("int")).cast("int")
    return _placed(documents, seed, weights, epochs).select("doc_id", "source", "size", "source_size", "target", (F.col("size") * times).cast("long").alias("taken"), times.alias("times"))


def mixed_documents(documents: DataFrame, seed: str = "mix", weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """The documents as often as the mix takes them, with all their columns.

    A cut is a key: of a source, documents up to its key are taken once more. So the texts needn't be
    shuffled; what is joined is a row for each source. Rows that have one key are taken alike.
    """
    cuts = _placed(documents, seed, weights, epochs).groupBy("source").agg(F.max("_whole").alias("whole"), F.max(F.when(F.col("_cut"), F.col("_key"))).alias("last"))
    cuts = written(cuts.withColumnRenamed("source", "of"), "mix-cuts")
    side = F.broadcast(cuts) if cuts.count() <= BROADCAST_ROWS else cuts
    key = random_key(F.col("doc_id").cast("long"), F.col("text"), seed)
    rows = documents.select(F.col("source").cast("string").alias("from"), key.alias("key"), F.struct(*[f"`{c}`" for c in documents.columns]).alias("row"))
    taken = F.col("whole") + F.coalesce((F.col("key") <= F.col("last")).cast("int"), F.lit(0))
    joined = rows.join(side, F.col("from").eqNullSafe(F.col("of"))).withColumn("times", taken).filter("times > 0")
    return joined.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")


ORACLE = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null:' || md5(coalesce(text, '')))) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS i FROM s),
c AS (SELECT *, [5, 2, 1][(i - 1) % 3 + 1] AS w, 3 * source_size AS cap, sum(source_size) OVER () AS total FROM w),
o AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bef, sum(w) OVER (ORDER BY cap / w, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_w FROM c),
p AS (SELECT *, w * (total - bef) >= cap * left_w AS capped FROM o),
t AS (SELECT source, source_size, CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE CAST(w * (total - coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0)) AS DOUBLE) / sum(CASE WHEN NOT capped THEN w END) OVER () END AS target FROM p),
x AS (SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS whole,
      sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS after FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(size * least(3, whole + CASE WHEN after - size / 2 <= target - whole * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM x"""
