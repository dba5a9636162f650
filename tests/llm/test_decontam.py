import random

from sceneloom.llm import decontam as D

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def corpus(seed=3, items=60, docs=80):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["the", "of", "and"] * 40
    say = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    bench = [(i, say(r.randint(6, 150)) + ". " + say(r.randint(3, 20)) + ".") for i in range(items)]
    out = []
    for d in range(docs):
        text = say(r.randint(0, 400))
        if d % 3 == 0:
            leak = r.choice(bench)[1]
            text = text + "\n" + (leak.upper() if d % 2 else leak) + " " + say(30)
        out.append((d, text))
    return out, bench


def grams(words, k):
    return {" ".join(words[i : i + k]) for i in range(len(words) - k + 1)} if k else set()


def share(part, words, k):
    """The part of a part's k-grams that some words hold."""
    k = min(k, len(part))
    return len(grams(part, k) & grams(words, k)) / len(grams(part, k)) if k else 0.0


def brute(docs, bench, overlap=0.8, least=0.5, n=5):
    found = set()
    for i, t in bench:
        q, a = D.question_and_answer(t or "")
        for d, x in docs:
            w = D.words_of(x)
            if share(D.words_of(t), w, n) >= overlap and all(share(p, w, min(n, max(1, len(p) // 2))) >= least for p in (q, a)):
                found.add((d, i))
    return found


def test_against_brute_force(spark):
    docs, bench = corpus()
    got = D.leaks(spark.createDataFrame(docs, DOCS).selectExpr("*", "1 AS item_id", "'s' AS score"), spark.createDataFrame(bench, ITEMS))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == brute(docs, bench)


def test_many_shards_find_the_same(spark, monkeypatch):
    docs, bench = corpus(5)
    monkeypatch.setattr(D, "SHARD_WORDS", 1500)
    d = spark.createDataFrame(docs, DOCS)
    got = {(r.doc_id, r.item_id) for r in D.leaks(d, spark.createDataFrame(bench, ITEMS)).collect()}
    assert got == brute(docs, bench)
    kept = {r.doc_id for r in D.clean_documents(d, spark.createDataFrame(bench, ITEMS)).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in got}


def test_wand_equals_full_scoring():
    docs, bench = corpus(7)
    df, n, total = {}, 0, 0
    for _, t in bench:
        for p in D.segments_of(t):
            n, total = n + 1, total + len(p)
            for w in set(p):
                df[w] = df.get(w, 0) + 1
    shards = {theta: D.build_shard(bench, df, n, total / n, 5, theta) for theta in (0.05, 0.2, 0.6)}
    shard = shards[0.6]
    for _, text in docs:
        query = sorted({shard.terms[w] for w in D.words_of(text)[:128] if w in shard.terms})
        for theta in (0.05, 0.2, 0.6):
            full = {}
            for t in query:
                at = slice(shard.posting_at[t], shard.posting_at[t + 1])
                for seg, w in zip(shard.segments[at], shard.impacts[at], strict=True):
                    full[seg] = full.get(seg, 0.0) + w
            wanted = {s for s, x in full.items() if x >= theta - 1e-6}
            assert dict(D.block_max_wand(query, shard, theta)).keys() == wanted
            assert {k for k, _ in D.search(D.words_of(text)[:128], shards[theta], theta)} == {int(shard.item_of[s]) for s in wanted}


def test_nulls_empties_and_repeats(spark):
    docs = [(None, "alpha beta gamma delta epsilon zeta"), (1, None), (2, ""), (3, "alpha beta gamma delta epsilon zeta"), (3, "alpha beta gamma delta epsilon zeta"), (4, "two words")]
    bench = [(7, "Alpha beta gamma delta epsilon zeta"), (8, None), (9, ""), (None, "two words")]
    d, b = spark.createDataFrame(docs, DOCS), spark.createDataFrame(bench, ITEMS)
    assert sorted(((r.doc_id, r.item_id) for r in D.leaks(d, b).collect()), key=str) == sorted([(None, 7), (3, 7), (3, 7), (4, None)], key=str)
    assert sorted(r.doc_id for r in D.clean_documents(d, b).collect()) == [1, 2]
    none = spark.createDataFrame([], ITEMS)
    assert D.leaks(d, none).count() == 0
    assert D.clean_documents(d, none).count() == len(docs)
    assert D.leaks(spark.createDataFrame([], DOCS), b).count() == 0


def test_question_and_answer_are_both_verified(spark):
    question, answer = "which of the many rivers of this country runs through seven towns before it meets the cold sea", "the long grey one"
    bench = [(1, f"{question}? {answer}.")]
    docs = [(1, f"so it asks {question} and nothing else"), (2, f"it was {answer}, they said"), (3, f"{question}? {answer}."), (4, f"{question.replace('seven', 'eight')} -- {answer}"), (5, f"{question}? the long red one")]
    got = {r.doc_id: (r.question_overlap, r.answer_overlap) for r in D.leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(bench, ITEMS), overlap=0.6).collect()}
    assert set(got) == {3, 4} and got[3] == (1.0, 1.0)
    assert {r.doc_id for r in D.clean_documents(spark.createDataFrame(docs, DOCS), spark.createDataFrame(bench, ITEMS), overlap=0.6).collect()} == {1, 2, 5}


def test_retrieval_loses_no_edited_passage():
    """Passages edited as far as the verification takes them reach theta."""
    r = random.Random(11)
    _, bench = corpus(11, items=150, docs=0)
    df, n, total = {}, 0, 0
    for _, t in bench:
        for p in D.segments_of(t):
            n, total = n + 1, total + len(p)
            for w in set(p):
                df[w] = df.get(w, 0) + 1
    shard = D.build_shard(bench, df, n, total / n, 5, 0.6)
    verified = found = 0
    for i, t in bench:
        for edits in (1, 2, 3, 5, 8):
            words = D.words_of(t)
            for _ in range(edits):
                at = r.randrange(len(words))
                words[at : at + 1] = r.choice(([], ["other"], [words[at], "more"]))
            doc = [f"pad{r.randrange(99)}" for _ in range(r.randrange(200))] + words
            if share(D.words_of(t), doc, 5) >= 0.8:
                verified += 1
                found += any(bench[k][0] == i for k, _ in D.search(doc, shard, 0.6))
    assert verified > 100 and found == verified


def test_very_long_texts_are_searched_whole():
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    df = dict.fromkeys(D.words_of(item), 1)
    shard = D.build_shard([(1, item)], df, 1, 10, 5, 0.6)
    for before in (0, 63, 64, 512 * 64 - 5, 513 * 64 - 5, 200_000):
        assert [x[1] for x in D.find(["pad " * before + item + " pad" * 70_000], shard, 0.6, 0.8, 0.5)] == [0]
