"""Document fingerprints by spot signatures, in DataFrame functions alone.

A signature is an anchor (a very common word) with the chain of the two content words that follow it
within the next SPAN words. The set of a text's hashed signatures is its fingerprint; likeness is the
Jaccard measure of two sets. A text with no such chain takes its words as chains of one; a text without
words (null, empty) has the empty set, whose likeness is 1 to another empty set and 0 to any other.

search() finds near documents as the method has it: sets are partitioned by length, and only those that share a rare
signature are compared. fingerprint_documents() compares the two pairs that it is asked for. There a text's signatures are
worked out where it is the next one and again where it is its own: carrying them along would shuffle the texts twice.

Equal texts have equal fingerprints. Documents are ordered by (doc_id, hash of the text), nulls first.
Rows that repeat doc_id and text share their results, with the next different row as their next one; all
of them are returned, and many of one kind are dealt over many tasks. A lone document is its own next one. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import with_next, written

# Common words of English, French, German and Spanish that serve as anchors.
ANCHORS = (
    "the of and to a in is that it for was on with as be by are at this from"
    " de la le et les des un du une est que par qui dans"
    " der die und den von das mit ist im zu nicht ein"
    " el los se del las por con no su y"
).split()
#: Content words are looked for in so many words after an anchor.
SPAN = 6
#: Content words in a chain.
CHAIN = 2
#: Stands for a null doc_id in keys.
NULL_ID = -(1 << 63)


def _bound(value: Column, body) -> Column:
    """body of a lambda's variable that holds value, so that value is worked out once."""
    return F.transform(F.array(value), body)[0]


def signatures(text: Column) -> Column:
    """Sorted distinct 32-bit hashes of the spot signatures of a text."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def spots(ws: Column) -> Column:
        def chain(w: Column, i: Column) -> Column:
            after = F.filter(F.slice(ws, i + 2, F.lit(SPAN)), lambda x: ~x.isin(ANCHORS))
            return F.when(w.isin(ANCHORS), _bound(after, lambda a: F.when(F.size(a) >= CHAIN, F.hash(w, *[F.get(a, F.lit(k)) for k in range(CHAIN)]))))

        found = F.array_compact(F.transform(ws, chain))
        return _bound(found, lambda f: F.when(F.size(f) > 0, f).otherwise(F.transform(ws, lambda w: F.hash(w, F.lit(CHAIN)))))

    return F.sort_array(F.array_distinct(_bound(words, spots)))


def fingerprint(signature_set: Column) -> Column:
    """The set as a string: eight hexadecimal digits for each signature, in order."""
    return F.array_join(F.transform(signature_set, lambda h: F.lpad(F.hex(h.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), "")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard measure of two sets. Where their lengths alone keep it under `least`, it is 0 and nothing is compared."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    exact = common / (F.size(a) + F.size(b) - common)
    return F.when(large == 0, F.lit(1.0)).when((small == 0) | (small < large * F.lit(least)), F.lit(0.0)).otherwise(exact)


def repeats(order: DataFrame) -> tuple[bool, DataFrame | None]:
    """Whether rows repeat, and the keys of which so many do that a task would get more than a quarter of its share: k, th and
    `parts`, over how many tasks they are dealt. There are at most four such keys for each task."""
    tasks = int(order.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total, most = order.agg(F.sum("copies"), F.max("copies")).first()
    if (most or 1) == 1:
        return False, None
    parts = F.ceil(F.col("copies") * 4 * tasks / F.lit(total)).cast("long")
    return True, F.broadcast(written(order.select("k", "th", parts.alias("parts")).filter("parts > 1"), "spot-hot"))


def dealt(keyed: DataFrame, hot: DataFrame | None) -> DataFrame:
    """keyed with `salt`: rows of a hot key are dealt over its parts, all others have 0."""
    if hot is None:
        return keyed.withColumn("salt", F.lit(0).cast("long"))
    salt = F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("parts")), F.lit(0)).cast("long")
    return keyed.join(hot, ["k", "th"], "left").select(*keyed.columns, salt.alias("salt"))


def for_each_part(handed: DataFrame, hot: DataFrame | None) -> DataFrame:
    """One row of a key for each of its parts."""
    if hot is None:
        return handed.withColumn("salt", F.lit(0).cast("long"))
    return handed.join(hot, ["k", "th"], "left").select(*handed.columns, F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("parts") - 1, F.lit(0)))).alias("salt"))


def fingerprint_documents(documents: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_signatures.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many of the next document.

    Who follows whom is found on ids, lengths and hashes alone. Then whole texts are shuffled once, to a row that
    names the document before; what a document hands back to that one is the head it needs and its own set.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keyed = rows.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("k"), F.xxhash64("text").alias("th"), "text")
    slim = keyed.select("k", "th", F.char_length("text").cast("long").alias("n")).groupBy("k", "th").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("copies"))
    order = written(with_next(slim, ["k", "th"], ["k", "th"], "spot-order"), "spot-next")
    repeated, hot = repeats(order)
    # the same columns on both sides of the last join, so that one shuffle of the texts serves both
    keyed = dealt(keyed, hot)
    before = order.select(F.col("_next_k").alias("k"), F.col("_next_th").alias("th"), F.col("k").alias("to_k"), F.col("th").alias("to_th"), F.floor(F.col("n") / 2).cast("int").alias("half"))
    base = keyed.join(for_each_part(before, hot), ["k", "th", "salt"])
    if repeated:  # one of each part is enough: they hand the same back
        base = base.dropDuplicates(["k", "th", "salt"])
    handed = base.select(F.col("to_k").alias("k"), F.col("to_th").alias("th"), F.col("text").substr(F.lit(1), F.col("half")).alias("head"), signatures(F.col("text")).alias("next_sigs"))
    if repeated:
        handed = handed.dropDuplicates(["k", "th"])
    n = F.char_length("text")
    both = keyed.join(for_each_part(handed, hot), ["k", "th", "salt"])
    edited = both.select(
        F.when(F.col("k") != NULL_ID, F.col("k")).alias("doc_id"), n.cast("long").alias("n_chars"), signatures(F.col("text")).alias("sigs"), "next_sigs",
        F.concat(F.col("text").substr(F.lit(1), n - F.floor(n / 2).cast("int")), F.col("head")).alias("edited"),
    )
    sets = edited.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "sigs", "next_sigs", signatures(F.col("edited")).alias("edited_sigs"))
    return sets.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("sigs")).alias("fingerprint"), fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"), likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"), F.size("sigs").alias("n_signatures"),
    )


def length_class(n: Column, threshold: float) -> Column:
    """The partition of a set's length: lengths of one class differ by less than a factor of the threshold, so that
    sets with a likeness over it stand in the same class or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / F.lit(-math.log(threshold)) + 1e-9).cast("int")


#: Counters of how often signatures occur, each shared by those with its remainder: a bounded table.
COUNTERS = 1 << 16


def _sets(documents: DataFrame, name: str) -> DataFrame:
    """doc_id, sigs, set_key of each document with a signature; equal sets have equal keys."""
    sets = documents.select(F.col("doc_id").cast("long").alias("doc_id"), signatures(F.col("text").cast("string")).alias("sigs"))
    return written(sets.filter(F.size("sigs") > 0).withColumn("set_key", F.md5(F.array_join("sigs", ","))), name)


def _frequencies(sets: DataFrame) -> DataFrame:
    """One row: an array with how many distinct sets have a signature of each counter."""
    counts = sets.select(F.explode("sigs").alias("s")).groupBy(F.pmod("s", F.lit(COUNTERS)).cast("int").alias("at")).agg(F.count(F.lit(1)).alias("n"))
    every = sets.sparkSession.range(COUNTERS).select(F.col("id").cast("int").alias("at")).join(counts, "at", "left")
    return every.agg(F.transform(F.sort_array(F.collect_list(F.struct("at", F.coalesce("n", F.lit(0)).alias("n")))), lambda x: x["n"]).alias("frequency"))


def search(queries: DataFrame, documents: DataFrame, threshold: float = 0.8) -> DataFrame:
    """query_id, doc_id, likeness: for each query all documents with a likeness of the threshold or more.

    Sets are partitioned by length; in a partition a query meets the sets that share one of its first signatures,
    rarest first: of n, n - ceil(threshold * n) + 1 must hold one that both have. How rare they are is counted over all
    documents in a table of fixed size; that two signatures share a counter changes their order alone, which is the same
    for all sets. Equal sets are compared once, and sets whose lengths rule it out aren't. Queries are a stated set; texts
    without words match nothing. Repeated rows give repeated results.
    """
    q, d = _sets(queries, "spot-queries"), _sets(documents, "spot-documents")
    qs, ds = q.select("set_key", "sigs").dropDuplicates(["set_key"]), written(d.select("set_key", "sigs").dropDuplicates(["set_key"]), "spot-sets")
    frequency = written(_frequencies(ds), "spot-frequencies")

    def first(sets: DataFrame, key: str) -> DataFrame:
        """A row for each of a set's first signatures."""
        ranked = F.transform("sigs", lambda s: F.struct(F.get("frequency", F.pmod(s, F.lit(COUNTERS)).cast("int")).alias("n"), s.alias("s")))
        few = F.slice(F.sort_array(ranked), 1, F.size("sigs") - F.ceil(F.size("sigs") * F.lit(threshold) - 1e-9).cast("int") + 1)
        rows = sets.withColumn("frequency", frequency.scalar()).select(F.col("set_key").alias(key), F.size("sigs").alias(f"{key}_n"), few.alias("few"))
        return rows.select(key, f"{key}_n", F.explode("few.s").alias("sig"))

    own = length_class(F.col("q_n"), threshold)
    probes = first(qs, "q").withColumn("cls", F.explode(F.array(own - 1, own, own + 1)))
    index = first(ds, "d").withColumn("cls", length_class(F.col("d_n"), threshold))
    met = probes.join(index, ["cls", "sig"]).filter(F.least("q_n", "d_n") >= F.greatest("q_n", "d_n") * F.lit(threshold) - 1e-9).select("q", "d").distinct()
    both = met.join(qs.select(F.col("set_key").alias("q"), F.col("sigs").alias("q_sigs")), "q").join(ds.select(F.col("set_key").alias("d"), F.col("sigs").alias("d_sigs")), "d")
    near = both.select("q", "d", likeness(F.col("q_sigs"), F.col("d_sigs"), threshold).alias("likeness")).filter(F.col("likeness") >= threshold - 1e-12)
    by_query = q.select(F.col("doc_id").alias("query_id"), F.col("set_key").alias("q")).join(near, "q")
    return by_query.join(d.select("doc_id", F.col("set_key").alias("d")), "d").select("query_id", "doc_id", "likeness")


def nearest(documents: DataFrame, every: int = 100, threshold: float = 0.8) -> DataFrame:
    """query_id, n_near, near_id, likeness of each document whose id `every` divides: how many other ids are near, and the
    most alike of them, the least id of equal ones; null where there is none."""
    queries = documents.filter(F.col("doc_id") % every == 0)
    found = search(queries, documents, threshold).filter("query_id <> doc_id").distinct()
    best = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_near"), F.max_by("doc_id", F.struct("likeness", -F.col("doc_id"))).alias("near_id"), F.max("likeness").alias("likeness"))
    ids = queries.select(F.col("doc_id").cast("long").alias("query_id")).distinct()
    return ids.join(best, "query_id", "left").select("query_id", F.coalesce("n_near", F.lit(0)).alias("n_near"), "near_id", "likeness")
