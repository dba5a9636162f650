"""Source divergence audit: how far each source of a language is from the others, and by which terms it differs.

Spark deals the counts of (lang, term) into shards; in each shard DuckDB adds them up in SQL, keeps the terms that occur in
enough documents of their language, and, once the totals are known, works out partial sums over the pairs of sources that
share a term and the best terms of each source. Spark merges the shards' sums and rankings.

A source that lacks a term still has a probability for it, the same for all terms it lacks. So the sum over all kept terms
of a pair is that of two sources without any, times the terms, corrected at the terms that either has: for one of them by
how often each count occurs in a source, for both by the shards' pairs. Nothing is worked out for terms that neither has.

Null text, lang and source are ''. Terms are runs of ASCII letters and of characters outside ASCII; A-Z alone are
lower-cased. A (lang, source) without terms, or with none that is kept, is a group like others. A language of one source has
no pairs; one without kept terms has pairs of value 0. Ties go by the item's UTF-8 bytes. Repeated rows are documents of
their own. An empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import join_classes, sliced, written

#: Documents in which a term must occur to be kept for a language; terms listed for each group.
LEAST_DOCS, TOP = 10, 10
#: Units of a probability.
UNIT = 1_000_000_000
#: Counts that a task holds before it hands them on, and rows of counts that a shard gets on average.
HELD, SHARD_ROWS = 300_000, 200_000

#: A-Z to a-z, other ASCII characters to a space.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))

COUNTS = "lang string, source string, term string, n long, docs long"


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (lang, source, term) of a task's documents, added up as far as they fit."""
    n: dict[tuple[str, str], Counter] = {}
    docs: dict[tuple[str, str], Counter] = {}
    held = 0

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), terms in n.items():
            keys, counts, own = list(terms), list(terms.values()), docs[lang, source]
            for at in range(0, len(keys), 20_000):
                some = keys[at : at + 20_000]
                columns = [pa.array([lang] * len(some)), pa.array([source] * len(some)), pa.array([k.decode() for k in some]), pa.array(counts[at : at + 20_000], pa.int64()), pa.array([own[k] for k in some], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])

    for b in sliced(batches):
        langs, sources = b.column(0).to_pylist(), b.column(1).to_pylist()
        for key, text in zip(zip(langs, sources, strict=True), b.column(2), strict=True):
            terms = text.as_py().encode().translate(_LETTERS).split()
            if not terms:
                continue
            if key not in n:
                n[key], docs[key] = Counter(), Counter()
            own = n[key]
            held -= len(own)
            own.update(terms)
            docs[key].update(set(terms))
            held += len(own)
            if held >= HELD:
                yield from out()
                n, docs, held = {}, {}, 0
    yield from out()


def _in_shard(batches: Iterator[pa.RecordBatch], takes: pa.Schema, sql: str, gives: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Runs DuckDB's SQL over one shard, the table `rows`, which it reads batch by batch; in memory, without files."""
    import duckdb

    rows = pa.RecordBatchReader.from_batches(takes, (b.cast(takes) for b in batches))
    with duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""}) as con:
        con.register("rows", rows)
        for b in con.execute(sql).to_arrow_reader(20_000):
            yield b.cast(gives)


def _arrow(fields: str) -> pa.Schema:
    return pa.schema([(f.split()[0], pa.string() if f.endswith("string") else pa.int64()) for f in fields.split(", ")])


def _shards(df: DataFrame) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // SHARD_ROWS))


def _text(c: str):
    return F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)


def kept_counts(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, source, term and n of the terms that their language keeps; a written table."""
    partial = written(docs.select(*map(_text, ("lang", "source", "text"))).mapInArrow(_count_terms, COUNTS), "term-counts")
    sql = f"""WITH c AS (SELECT lang, source, term, sum(n) AS n, sum(docs) AS docs FROM rows GROUP BY lang, source, term)
SELECT lang, source, term, CAST(n AS BIGINT) AS n FROM c QUALIFY sum(docs) OVER (PARTITION BY lang, term) >= {least_docs}"""
    gives = "lang string, source string, term string, n long"
    dealt = partial.repartition(_shards(partial), "lang", "term")
    return written(dealt.mapInArrow(lambda batches: _in_shard(batches, _arrow(COUNTS), sql, _arrow(gives)), gives), "kept-counts")


def _probability(count: str, total: str, terms: str):
    """1 + floor(UNIT * (count + 2) / (total + 2 * terms)); 1 where no term is kept."""
    return F.expr(f"CASE WHEN {terms} > 0 THEN 1 + (CAST({count} AS DECIMAL(20, 0)) + 2) * {UNIT} div (CAST({total} AS DECIMAL(20, 0)) + 2 * {terms}) ELSE 1L END")


def _apart(p: str, q: str):
    return F.expr(f"({p} - {q}) * ({p} - {q}) div ({p} + {q})")


def group_totals(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """g (lang and source), lang, source, n_terms, the N of the group and V and N of its language, and the probability p0 of
    a term that the group lacks; a written table with a row for each group."""
    groups = docs.select(_text("lang"), _text("source")).distinct()
    own = counts.groupBy("lang", "source").agg(F.sum("n").alias("n_group"), F.count(F.lit(1)).alias("n_terms"))
    terms = counts.select("lang", "term").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    whole = own.groupBy("lang").agg(F.sum("n_group").alias("n_lang"))
    out = groups.join(own, ["lang", "source"], "left").join(terms, "lang", "left").join(whole, "lang", "left")
    zeros = out.na.fill(0, ["n_group", "n_terms", "v", "n_lang"]).withColumn("p0", _probability("0", "n_group", "v"))
    return written(zeros.withColumn("g", F.struct("lang", "source")), "groups")


def shard_parts(counts: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """What the shards work out; a written table of kind, lang, source, item, value, p.

    `both`: the correction of a pair at terms that both sources have. `has`: in value, how many terms of a source have
    probability p. `term`: the best terms of a source in the shard.
    """
    takes, gives = "lang string, source string, term string, p long, p0 long, q long", "kind string, lang string, source string, item string, value long, p long"
    totals = join_classes(counts.withColumn("g", F.struct("lang", "source")), groups.drop("lang", "source"), "g", "n_terms", ["term"])
    langs = Window.partitionBy("lang", "term")
    rows = totals.repartition(_shards(counts), "lang", "term").withColumn("n_all", F.sum("n").over(langs))
    rows = rows.select("lang", "source", "term", _probability("n", "n_group", "v").alias("p"), "p0", _probability("n_all", "n_lang", "v").alias("q"))
    f = lambda p, q: f"(({p} - {q}) * ({p} - {q})) // ({p} + {q})"
    sql = f"""WITH r AS MATERIALIZED (SELECT * FROM rows),
t AS (SELECT lang, source, term, {f("p", "q")} AS value FROM r WHERE p > q QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY {f("p", "q")} DESC, term) <= {top})
SELECT 'both' AS kind, a.lang, a.source, b.source AS item, CAST(sum({f("a.p", "b.p")} - {f("a.p", "b.p0")} - {f("a.p0", "b.p")} + {f("a.p0", "b.p0")}) AS BIGINT) AS value, 0::BIGINT AS p
FROM r a JOIN r b ON a.lang = b.lang AND a.term = b.term AND a.source < b.source GROUP BY a.lang, a.source, b.source
UNION ALL SELECT 'has', lang, source, '', count(*), p FROM r GROUP BY lang, source, p
UNION ALL SELECT 'term', lang, source, term, value, 0 FROM t"""
    return written(rows.mapInArrow(lambda batches: _in_shard(batches, _arrow(takes), sql, _arrow(gives)), gives), "divergence")


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank: `pair` has every other source of the language, `term` the `top` terms that
    a source uses more than its language does."""
    counts = kept_counts(docs, least_docs)
    groups = group_totals(docs, counts)
    parts = shard_parts(counts, groups, top)
    one = groups.select("lang", "source", "p0", "v")
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    pairs = one.join(other, "lang").filter("source <> item")
    bare = pairs.select("lang", "source", "item", (F.col("v") * _apart("p0", "q0")).alias("value"))
    both = parts.filter("kind = 'both'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    has = parts.filter("kind = 'has'").groupBy("lang", "source", "p").agg(F.sum("value").alias("n"))
    mine = has.join(one.drop("v"), ["lang", "source"]).join(other, "lang").filter("source <> item")
    mine = mine.groupBy("lang", "source", "item").agg(F.sum(F.col("n") * (_apart("p", "q0") - _apart("p0", "q0"))).alias("value"))
    turned = lambda df: df.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    sums = bare.unionByName(both).unionByName(turned(both)).unionByName(mine).unionByName(turned(mine)).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    terms = ranked(parts.filter("kind = 'term'"), "term").filter(F.col("rank") <= top)
    return ranked(sums, "pair").unionByName(terms)


ORACLE = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x{{00}}-\\x{{40}}\\x{{5B}}-\\x{{60}}\\x{{7B}}-\\x{{7F}}]+') AS ts FROM documents),
w AS MATERIALIZED (SELECT r, lang, source, unnest(ts) AS term FROM d),
k AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= {LEAST_DOCS}),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY lang, source, term),
gt AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source),
p AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, CAST(1 + ({UNIT} * (coalesce(c.n, 0) + 2)) // (coalesce(gt.total, 0) + 2 * l.v) AS BIGINT) AS p
  FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term LEFT JOIN gt ON gt.lang = g.lang AND gt.source = g.source),
q AS (SELECT k.lang, k.term, CAST(1 + ({UNIT} * (k.n + 2)) // (l.total + 2 * l.v) AS BIGINT) AS q FROM k JOIN l USING (lang)),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL SELECT lang, source, 'term', item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM terms
QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) <= {TOP}"""
