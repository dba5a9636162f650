import random
import zlib

from sceneloom.llm import langid

DOCS = "doc_id long, text string, lang string"
WORDS = {"en": "the of and house river walking through light under water".split(), "de": "der die und haus fluss gehen durch licht unter wasser über".split(), "fr": "le la et maison rivière marche lumière sous l'eau été".split()}


def corpus(n=600):
    r = random.Random(3)
    rows = []
    for i in range(n):
        lang = r.choice(list(WORDS))
        rows.append((i, " ".join(r.choice(WORDS[lang]) for _ in range(r.randint(3, 60))), lang))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus()
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(rows, DOCS)).collect()}
    held = [(got[d].lang_pred, lang) for d, _, lang in rows if got[d].held_out]
    assert len(held) > 100 and sum(a == b for a, b in held) / len(held) > 0.98
    assert all(got[d].held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, *_ in rows)
    assert all(r.accepted for r in got.values())


def test_held_out_labels_are_not_learnt(spark):
    rows = corpus(200)
    wrong = [(d, t, "xx" if zlib.crc32(str(d).encode()) % 3 == 1 else lang) for d, t, lang in rows]
    got = [sorted(langid.identify(spark.createDataFrame(x, DOCS)).collect()) for x in (rows, wrong)]
    assert got[0] == got[1]


def test_rejection_and_odd_rows(spark):
    odd = [(1001, None, "en"), (1002, "", "en"), (1003, "12 !! 34", "en"), (1004, "日本語の文章です", None), (1005, "das haus " * 40_000, None), (None, "the river and the house", None)]
    df = spark.createDataFrame(corpus(300) + odd + [odd[4]], DOCS).selectExpr("*", "1 AS score", "'x' AS lang_pred")
    got = langid.identify(df).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 307
    assert all(by[i].lang_pred == "und" and by[i].score == 0 and not by[i].accepted for i in (1001, 1002, 1003))
    assert not by[1004].accepted and by[1004].lang_pred in WORDS
    assert by[1005].lang_pred == "de" and by[None].lang_pred == "en"
    kept = langid.accepted_documents(df, langid.fit(df, langid.training_rows()))
    assert kept.columns == df.columns and kept.count() == 303


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "the river", None)], DOCS)
    assert [r.lang_pred for r in langid.identify(df).collect()] == ["und"]
    assert langid.identify(spark.createDataFrame([], DOCS)).count() == 0


def test_wrong_labels_reject_no_clean_documents(spark):
    r = random.Random(5)
    rows = [(d, t, r.choice(list(WORDS)) if r.random() < 0.05 else lang) for d, t, lang in corpus(1500)]
    df = spark.createDataFrame(rows, DOCS)
    model = langid.fit(df, langid.training_rows())
    assert model.reject_below <= 0.5
    assert langid.accepted_documents(df, model).count() >= 0.99 * len(rows)
    assert not langid.predict(spark.createDataFrame([(1, OTHER["nl"] * 3, None)], DOCS), model).first().accepted


def test_copies_do_not_fill_or_empty_the_sample(spark, monkeypatch):
    rows = corpus(400)
    copies = [(10_000 + i, "the house of light under the river", "en") for i in range(1500)] + [(20_000 + i, f"der fluss {'und das haus' if i % 2 else 'durch licht'}", "xx") for i in range(300)]
    units = []
    monkeypatch.setattr(langid, "train", lambda got, buckets: units.extend(got))
    langid.fit(spark.createDataFrame(rows + copies, DOCS), langid.training_rows(), per_lang=20)
    for lang in ("en", "de", "fr"):
        assert 20 <= sum(u.lang == lang for u in units) <= 2 * 40
    assert sum(u.lang == "xx" for u in units) == 4  # two texts, whole and as a snippet


OTHER = {
    "nl": "de rivier loopt door het huis en het licht valt onder de brug in het koude water van de stad",
    "vi": "dòng sông chảy qua ngôi nhà và ánh sáng dưới nước rất lạnh ở thành phố này",
    "fi": "joki virtaa talon läpi ja valo laskeutuu sillan alle kylmään veteen kaupungissa",
}


def test_unseen_languages_and_noise_are_rejected(spark):
    r = random.Random(8)
    noise = [" ".join("".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 9))) for _ in range(40)) for _ in range(20)]
    shuffled = [" ".join("".join(r.sample(w, len(w))) for w in r.choices([x for ws in WORDS.values() for x in ws if len(x) > 4], k=30)) for _ in range(20)]
    model = langid.fit(spark.createDataFrame(corpus(900), DOCS), langid.training_rows())
    out = [(i, t, None) for i, t in enumerate([*OTHER.values(), *noise, *shuffled])]
    got = langid.predict(spark.createDataFrame(out, DOCS), model).collect()
    assert not any(x.accepted for x in got)
    mixed = [(1, "the river and the house " * 5 + "la rivière et la maison " * 5, None), (2, "der fluss", None), (3, "house", None)]
    assert all(x.accepted for x in langid.predict(spark.createDataFrame(mixed, DOCS), model).collect())
    assert set(model.facts["known_words_held_out"]) == {"noise", *WORDS} and max(model.facts["known_words_held_out"].values()) < model.facts["known_words"]


def test_scores_are_those_of_averaged_embeddings(spark):
    """predict() beside the definition: the softmax of the mean of all pieces' logits."""
    import numpy as np

    model = langid.fit(spark.createDataFrame(corpus(300), DOCS), langid.training_rows())
    texts = ["The river, and DAS Haus!", "l'eau", "qqq zzz", "the " * 5000]
    got = {r.doc_id: r for r in langid.predict(spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], DOCS), model).collect()}
    for i, t in enumerate(texts):
        words = langid.LETTERS.findall(t.lower())
        table = model.embedding @ model.weights
        rows = [table[k] for w in words for k in langid.pieces(w, model.buckets)]
        x = np.mean(rows, 0, dtype=np.float64) / model.temperature
        p = np.exp(x - x.max()) / np.exp(x - x.max()).sum()
        assert got[i].lang_pred == model.langs[int(p.argmax())] and abs(got[i].score - p.max()) < 1e-5
        assert abs(got[i].known - np.mean([langid.word_hash(w) in model.known for w in words])) < 1e-9


def test_stretches(spark, monkeypatch):
    df = spark.createDataFrame(corpus(300), DOCS)
    one = sorted(langid.identify(df).collect())
    monkeypatch.setattr(langid, "STRETCH", 7)
    assert [r[:3] for r in sorted(langid.identify(df).collect())] == [r[:3] for r in one]


def test_a_label_for_each_text(spark):
    """70,000 labels of one text each: the languages that have more are learnt, and the model keeps its size."""
    noise = [(100_000 + i, f"w{i}x word", f"label{i}") for i in range(70_000)]
    model = langid.fit(spark.createDataFrame(corpus(400) + noise, DOCS), langid.training_rows())
    assert model.langs == sorted(WORDS)
    got = langid.predict(spark.createDataFrame([(1, "der fluss und das haus", None)], DOCS), model).first()
    assert got.lang_pred == "de" and got.accepted


def test_three_hundred_languages(spark, monkeypatch):
    """More languages than dimensions: the sample as a whole is bounded, and predictions hold."""
    r = random.Random(4)
    letters = "bcdfghjklmnpqrstvwxz"
    words = {f"l{k:03}": ["".join(r.choice(letters[k % 20] + letters[k // 20] + "aeiou") for _ in range(6)) for _ in range(12)] for k in range(300)}
    rows = [(i, " ".join(r.choices(words[lang], k=20)), lang) for i, lang in enumerate(sorted(words) * 30)]
    units = []
    train = langid.train
    monkeypatch.setattr(langid, "train", lambda got, buckets: (units.extend(got), train(got, buckets))[1])
    monkeypatch.setattr(langid, "SAMPLE_TEXTS", 6000)
    monkeypatch.setattr(langid, "SAMPLE_WORDS", 240_000)
    got = langid.identify(spark.createDataFrame(rows, DOCS)).collect()
    assert len(units) <= 4 * 6000 and sum(len(u.words) for u in units) <= 2 * 240_000
    held = [(x.lang_pred, rows[x.doc_id][2]) for x in got if x.held_out]
    assert len(held) > 900
    assert sum(a == b for a, b in held) / len(held) > 0.5  # of 300, from 20 short texts each


def test_equal_with_fewer_or_more_languages_than_dimensions(monkeypatch):
    """Logits summed up word by word are those of summed embeddings."""
    import numpy as np

    r = np.random.RandomState(1)
    few = langid.Model(["a", "b"], 64, r.randn(64, 4).astype(np.float32), r.randn(4, 2).astype(np.float32), np.empty(0, np.int64))
    many = langid.Model([f"l{i}" for i in range(9)], 64, few.embedding, r.randn(4, 9).astype(np.float32), np.empty(0, np.int64))
    for m in (few, many):
        sent = m.sent()
        assert (sent.weights is None) == (m is few)
        assert np.allclose(sent.logits(sent.embedding[[3, 5, 5]].sum(0)), m.embedding[[3, 5, 5]].sum(0) @ m.weights, atol=1e-4)
