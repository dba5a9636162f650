"""Packing: every id once, windows within their size, little padding, and best fit as a plain search finds it."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from sceneloom.llm import packing

SCHEMA = "doc_id long, text string, start string, length int"


def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(rows, docs, window):
    """rows: as collected; docs: doc_id -> ids with the end id. Returns padding and tokens."""
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        assert 0 < r.length <= window and r.doc_tokens == len(docs[r.doc_id])
        ids = np.array(docs[r.doc_id][r.start : r.start + r.length], "<u4")
        assert len(ids) == r.length and zlib.crc32(ids.tobytes()) == r.ids_crc32
        pieces[r.doc_id].append((r.start, r.length))
        windows[r.sequence_id].append((r.offset, r.length, r.sequence_tokens))
    for k, ids in docs.items():
        at = 0
        for start, n in sorted(pieces[k]):
            assert start == at
            at += n
        assert at == len(ids)
    padding = 0
    for some in windows.values():
        at = 0
        for offset, n, total in sorted(some):
            assert offset == at
            at += n
        assert at == total <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding, sum(map(len, docs.values()))


@pytest.mark.parametrize("window", [64, 2048])
def test_documents(spark, window):
    lib = library()
    texts = [None, "", "a", " ", "one two  three\n\n four", "<|endoftext|> x<|endoftext|>", "long text of words, " * 4000, "no-space" * 900] + [f"Text {i} " * (i % 90) for i in range(300)]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)]
    out = packing.pack_documents(spark.createDataFrame(rows, SCHEMA).repartition(3), window).collect()
    docs = {i: [*lib.encode(t or "", add_special_tokens=False).ids, 1] for i, t, *_ in rows}
    padding, total = check(out, docs, window)
    assert padding <= packing.SLACK * total / (window - packing.SLACK)
    assert [r.doc_tokens for r in out if r.doc_id == 0] == [1]


def test_repeated_rows_null_ids_and_none(spark):
    df = spark.createDataFrame([(None, "x y", "x", 1), (5, "same", "x", 1), (5, "same", "x", 1)], SCHEMA)
    out = packing.pack_documents(df).collect()
    assert sorted((r.doc_id or 0, r.start) for r in out if r.start == 0) == [(0, 0), (5, 0), (5, 0)]
    assert sum(r.length for r in out) == sum(r.doc_tokens for r in out if r.start == 0)
    assert packing.pack_documents(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        packing.pack_documents(df, 100)


def test_ids_are_the_librarys(monkeypatch):
    lib, own, draws = library(), packing.tokens(), random.Random(1)
    parts = ["a", "é", " ", "  ", "\n", "\t", "\r\n", "\xa0", "　", " ", "'s", "'LL", "12", ".", "!?", "<|endoftext|>", "日本", "\x1c", "\x85", "​", "﻿", "😀", "́", "_", "<|", "end ", "\x00", "ß", "İ", "²", "Ⅷ"]
    for size in (1 << 18, 3):
        monkeypatch.setattr(packing, "SECTION", size)
        for _ in range(3000):
            text = "".join(draws.choice(parts) for _ in range(draws.randrange(14)))
            assert own.of(text).tolist() == lib.encode(text, add_special_tokens=False).ids, repr(text)


def test_long_runs_of_one_kind():
    lib, own = library(), packing.tokens()
    for text in (" " * 1_000_000 + "x", "\n" * 300_000 + "x", "a" * 200_000, "日本語" * 50_000, "!?" * 100_000, "0123456789" * 20_000):
        assert own.of(text).tolist() == lib.encode(text, add_special_tokens=False).ids


def test_best_fit_beside_a_plain_search():
    draws = random.Random(2)
    for window in (8, 64, 2048):
        for _ in range(40):
            lengths = [draws.choice([draws.randint(1, window), window // 2, window]) for _ in range(draws.randrange(60))]
            rooms, out = [], []
            for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
                fits = [(room, w) for w, room in enumerate(rooms) if room >= lengths[i]]
                if fits:
                    _, w = min(fits)
                else:
                    w = len(rooms)
                    rooms.append(window)
                    out.append([])
                rooms[w] -= lengths[i]
                out[w].append(i)
            assert packing.best_fit_decreasing(lengths, window) == out


def test_lengths_that_fit_badly():
    """All remainders just over half a window: they are cut, and nothing is padded."""
    windows = packing.pack([1100] * 500)
    totals = [sum(n for *_, n in w) for w in windows]
    assert sum(totals) == 550_000 and all(t & (t - 1) == 0 for t in totals) and sum(t < 2048 for t in totals) <= 11
    assert packing.pack([]) == []


def test_chunks_and_tasks_run_again():
    docs = [(i, np.full(i % 700 + 1, i, "<u4")) for i in range(2000)]
    rows = [r for some in packing.packed(docs, 1 << 40) for r in some]
    assert rows == [r for some in packing.packed(docs, 1 << 40) for r in some]
    assert min(r[5] for r in rows) == 1 << 40
