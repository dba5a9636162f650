"""The divergence audit beside plain counting."""

import re
from collections import Counter, defaultdict

from sceneloom.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, value int, term string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, least, top):
    docs = [(r[2] or "", r[3] or "", TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1] or ""))) for r in rows]
    groups, seen, n = sorted({d[:2] for d in docs}), defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        seen[lang].update(set(terms))
        n[lang, source].update(terms)
    out = []
    for lang in sorted({g[0] for g in groups}):
        kept = [t for t, k in seen[lang].items() if k >= least]
        own = [s for x, s in groups if x == lang]
        whole = Counter()
        for s in own:
            whole.update({t: n[lang, s][t] for t in kept})

        def p(counts, kept=kept):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}

        ps, q = {s: p(n[lang, s]) for s in own}, p(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in own:
            pairs = [(u, sum(f(ps[s][t], ps[u][t]) for t in kept)) for u in own if u != s]
            terms = [(t, f(ps[s][t], q[t])) for t in kept if n[lang, s][t] and ps[s][t] > q[t]]
            for part, some in (("pair", pairs), ("term", terms)):
                ranked = sorted(some, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(ranked) if part == "pair" or i < top]
    return sorted(out)


def result(spark, rows, **how):
    return sorted(tuple(r) for r in divergence.audit(spark.createDataFrame(rows, SCHEMA), **how).collect())


def made(n):
    words = ["the", "Émile", "naïve", "a1b", "X", "日本", "ünd", "Zebra's", "x"]
    return [(i, " ".join(words[(i * k * k + k) % len(words)] for k in range(i % 13)), ["en", "fr", None][i % 3], [f"s{i % 4}", None, ""][i % 7 % 3], 1, "x") for i in range(n)]


def test_beside_plain_counting(spark):
    rows = made(200)
    assert result(spark, rows, least_docs=5, top=3) == plain(rows, 5, 3)


def test_odd_rows(spark):
    """Null and empty texts, langs of one source, langs without kept terms, repeated rows, a long text."""
    rows = made(30) * 2 + [(1, None, "xx", "a", 1, "x"), (2, "", "xx", "b", 1, "x"), (3, "only once", "xx", "c", 1, "x"), (4, "lone lone", "yy", "a", 1, "x"), (None, "THE the " * 50_000, "en", "s0", None, None)]
    assert result(spark, rows, least_docs=2) == plain(rows, 2, 10)
    assert {r[4] for r in result(spark, rows, least_docs=2) if r[0] == "xx"} == {0}


def test_empty(spark):
    assert result(spark, []) == []


def test_counts_handed_on_early(spark, monkeypatch):
    """A task that hands its counts on piece by piece gives the same."""
    import pyarrow as pa

    monkeypatch.setattr(divergence, "HELD", 3)
    rows = made(60)
    batch = pa.RecordBatch.from_arrays([pa.array([r[i] or "" for r in rows]) for i in (2, 3, 1)], names=["lang", "source", "text"])
    few, n = Counter(), 0
    for b in divergence._count_terms(iter([batch])):
        n += 1
        for lang, source, term, count, docs in zip(*(c.to_pylist() for c in b.columns), strict=True):
            few[lang, source, term] += count * 1000 + docs
    monkeypatch.setattr(divergence, "HELD", 300_000)
    (many,) = [Counter({k: v for b in divergence._count_terms(iter([batch])) for k, v in zip(zip(*(c.to_pylist() for c in b.columns[:3]), strict=True), (c * 1000 + d for c, d in zip(*(x.to_pylist() for x in b.columns[3:]), strict=True)), strict=True)})]
    assert few == many and n > 20
