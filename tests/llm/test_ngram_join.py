import itertools
import random

import pytest

from sceneloom.llm import common
from sceneloom.llm import ngram_join as J
from sceneloom.llm.common import words_of

DOCS = "doc_id long, text string"


def corpus(seed=2):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(3000)]
    say = lambda n: [r.choice(vocab) for _ in range(n)]
    rows = []
    shared = say(40)
    for g in range(25):
        base = say(r.randint(20, 120))
        for k in range(r.choice([1, 1, 2, 5, 9])):
            w = list(base)
            for _ in range(k):
                w[r.randrange(len(w))] = r.choice(vocab)
            rows.append(" ".join(w if g % 4 else w[:20] + shared + w[20:]))
    hot = say(150)
    rows += [" ".join(hot)] * 30
    for _ in range(120):  # a large group of near copies
        w = list(hot)
        for _ in range(r.randint(1, 3)):
            w[r.randrange(len(w))] = r.choice(vocab)
        rows.append(" ".join(w))
    r.shuffle(rows)
    return [(i * 3, t) for i, t in enumerate(rows)]


def brute(rows, n=5, threshold=0.8):
    texts = {}
    for d, t in rows:
        texts.setdefault(t, []).append(d)
    keys = list(texts)
    words = [words_of(t) for t in keys]
    sets = [{tuple(w[i : i + min(n, len(w))]) for i in range(max(1, len(w) - n + 1))} if w else set() for w in words]
    root = list(range(len(keys)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    links = [0] * len(keys)
    for a, b in itertools.combinations(range(len(keys)), 2):
        common = len(sets[a] & sets[b])
        if sets[a] and sets[b] and common / (len(sets[a]) + len(sets[b]) - common) >= threshold:
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    group = {}
    for i, k in enumerate(keys):
        group.setdefault(find(i), []).extend(texts[k])
    return {d: (min(texts[k]), len(texts[k]), links[i], min(group[find(i)])) for i, k in enumerate(keys) for d in texts[k]}


@pytest.mark.parametrize("block", [J.BLOCK_TEXTS, 16])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK_TEXTS", block)
    rows = corpus()
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS key", "'b' AS bands", "0 AS class_id")
    got = {r.doc_id: (r.class_id, r.copies, r.n_links, r.group_id) for r in J.near_duplicates(df).collect()}
    assert got == brute(rows)


def test_one_of_each_group_stays(spark):
    rows = corpus(4)
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "doc_id AS _k", "'en' AS lang")
    kept = J.one_of_each_group(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {g for *_, g in brute(rows).values()}


def test_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(J, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 5)
    rows = corpus(6)
    assert {r.doc_id for r in J.one_of_each_group(spark.createDataFrame(rows, DOCS)).collect()} == {g for *_, g in brute(rows).values()}


def test_odd_rows(spark):
    rows = [(1, None), (2, None), (3, ""), (4, ""), (5, "a b"), (6, "A, b!"), (7, "a b"), (None, "lonely words only here now"), (8, "x " * 50_000), (9, "a b"), (9, "a b")]
    got = sorted(((r.doc_id, r.class_id, r.copies, r.n_links, r.group_id) for r in J.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()), key=str)
    assert got == sorted(
        [(1, 1, 1, 0, 1), (2, 2, 1, 0, 2), (3, 3, 2, 0, 3), (4, 3, 2, 0, 3), (5, 5, 4, 1, 5), (6, 6, 1, 1, 5), (7, 5, 4, 1, 5), (None, None, 1, 0, None), (8, 8, 1, 0, 8), (9, 5, 4, 1, 5), (9, 5, 4, 1, 5)], key=str
    )
    kept = sorted((r.doc_id for r in J.one_of_each_group(spark.createDataFrame([*rows, (3, "")], DOCS)).collect()), key=str)
    assert kept == sorted([1, 2, 3, 5, None, 8], key=str)
    assert J.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_bands_reach_the_recall():
    for t, recall in ((0.8, 0.9999), (0.5, 0.99), (0.9, 0.999)):
        bands, rows = J.choose_bands(t, recall, 512)
        assert 1 - (1 - t**rows) ** bands >= recall


def test_components_of_a_long_chain(spark):
    edges = [(f"{i:05d}".encode(), f"{i + 1:05d}".encode()) for i in range(300)]
    got = J.components(spark.createDataFrame([(bytearray(a), bytearray(b)) for a, b in edges], "key binary, root binary")).collect()
    assert len(got) == 301 and {bytes(r.component) for r in got} == {b"00000"}


def test_word_hashes_have_64_bits():
    seen = J.WordHash()
    hashes = [seen[f"{a}{b}{c}{d}"] for a in "abcdefghij" for b in "klmnopqrst" for c in "uvwxyzabcd" for d in "efghijklmn"]
    assert len(set(hashes)) == len(hashes)
    assert len({(h >> 32) ^ (h & 0xFFFFFFFF) for h in hashes}) > 9_900  # the halves don't follow from each other
    assert max(hashes) > 1 << 63


def test_clashing_columns_and_repeats(spark):
    rows = [(1, "a b c"), (2, "a b c"), (2, "a b c"), (1, "a b c"), (3, None), (3, None)]
    df = spark.createDataFrame(rows, DOCS).selectExpr("doc_id AS _lost_id", "*", "text AS _lost_key", "1 AS id", "2 AS text_key", "3 AS row", "4 AS apart", "5 AS key")
    kept = J.one_of_each_group(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.row) for r in kept.collect()) == [(1, 3), (3, 3), (3, 3)]


@pytest.mark.parametrize("most", [1, 3, 100])
def test_join_classes(spark, tmp_path, most):
    rows = spark.createDataFrame([("hot", i) for i in range(40)] + [(f"k{i % 9}", 100 + i) for i in range(20)] + [(None, 7), ("alone", 8)], "k string, i long")
    path = str(tmp_path / "classes")
    rows.filter("k IS NOT NULL").groupBy("k").count().filter("count > 1").selectExpr("k", "count AS copies", "concat('v-', k) AS v").write.parquet(path)
    got = {r.i: (r.k, r.v) for r in common.join_classes(rows, spark.read.parquet(path), "k", "copies", ["i"], most).collect()}
    assert got == {r.i: (r.k, None if r.k in (None, "alone") else f"v-{r.k}") for r in rows.collect()}
