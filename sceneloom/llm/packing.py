"""Packing of tokenised documents into windows, best fit decreasing.

A document is cut into full windows; what remains of it is shorter than one. The remainders of a chunk of documents are
packed longest first, each into the open window with the least room that holds it: a segment tree whose leaves are the
amounts of room tells which. A window that stays emptier than `slack` is dissolved: its pieces are cut freely and fill
windows to the brim one after the other, and what is left at the end makes windows of powers of two. So no window of a
chunk has more padding than `slack`, whatever the lengths are, and documents are cut only where they don't fit.

Chunks are consecutive documents of a partition of the input, so nothing is shuffled, and no task holds more than a chunk. A
task that is run again reads the same rows in the same order and packs them alike. Windows are numbered apart in each
partition, as Spark numbers rows (monotonically_increasing_id). More or smaller input files make other windows.

Null and empty texts are the end id alone; a text of any length is tokenised in sections. Repeated rows, and rows with a
null id, are documents of their own. Of equal remainders that of the earlier row goes first; of windows with equal room the
one opened first is filled. An empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced

WINDOW = 2048
#: The id that ends a document.
END = 1
#: Padding of a window above which it is dissolved.
SLACK = 16
#: Documents of a chunk, and their tokens (4 bytes each), at which it ends.
CHUNK_DOCS, CHUNK_TOKENS = 20_000, 8_000_000
#: Characters of a text that are tokenised at a time.
SECTION = 1 << 18

# How byte-level vocabularies part a text into words, before any merge.
WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A place inside a text at which such words never join: a space between two letters, digits or underscores.
_CUT = re.compile(r"(?<=\w) (?=\w)")


class Tokens:
    """Ids of texts by a byte-level BPE file of the tokenizers library, as that library gives them.

    The merges are worked out by tiktoken, from the same file: it takes a fifth of the time. Strings of special tokens in a
    text are these tokens, as in the library. A probe is compared with the library when the file is read.
    """

    def __init__(self, vocabulary: str):
        import tiktoken

        with open(vocabulary, encoding="utf-8") as f:
            read = json.load(f)
        special = {t["content"]: t["id"] for t in read["added_tokens"]}
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        ranks = {bytes(map(byte_of.__getitem__, t)): i for t, i in read["model"]["vocab"].items() if t not in special}
        self.own = tiktoken.Encoding("own", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        probe = "It's  a\n\n probe_of 12 éñ日本\t" + "".join(special)
        self.library = Tokenizer.from_file(vocabulary)
        if self.library.encode(probe, add_special_tokens=False).ids != self._ids(probe):
            raise ValueError(f"{vocabulary}: not a byte-level vocabulary whose ids are in the order of its merges")

    def _ids(self, text: str) -> list[int]:
        try:
            return self.own.encode(text, allowed_special="all")
        except ValueError:  # white space of a million characters is more than its expressions take
            return self.library.encode(text, add_special_tokens=False).ids

    def of(self, text: str) -> np.ndarray:
        out, at = [], 0
        while at < len(text):
            cut = _CUT.search(text, at + SECTION) if len(text) - at > SECTION else None
            to = cut.start() if cut else len(text)
            out.append(np.array(self._ids(text[at:to]), "<u4"))
            at = to
        return np.concatenate(out) if out else np.zeros(0, "<u4")


_tokens: dict[str, Tokens] = {}


def tokens(vocabulary: str | None = None) -> Tokens:
    """The vocabulary's tokeniser; a Python worker makes it once. The default is byte_bpe_50k.json of public_tokenizers."""
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    if vocabulary not in _tokens:
        _tokens[vocabulary] = Tokens(vocabulary)
    return _tokens[vocabulary]


class OpenWindows:
    """Windows by their room. Leaf r of the segment tree tells whether a window with room r is open, an inner node whether
    one below it is."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.any = bytearray(2 * self.leaves)
        self.heaps: list[list[int]] = [[] for _ in range(window + 1)]  # by room

    def put(self, window: int, room: int) -> None:
        heappush(self.heaps[room], window)
        at = room + self.leaves
        while at and not self.any[at]:
            self.any[at] = 1
            at >>= 1

    def tightest(self, least: int) -> int:
        """The smallest room of an open window that is `least` or more; -1 if there is none."""
        at = least + self.leaves
        if self.any[at]:
            return least
        while at > 1:  # up to the first node with something to the right, then down its left side
            if not at & 1 and self.any[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.any[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return -1

    def take(self, room: int) -> int:
        """The window of that room that was opened first, no longer open."""
        window = heappop(self.heaps[room])
        if not self.heaps[room]:
            at = room + self.leaves
            self.any[at] = 0
            at >>= 1
            while at and not (self.any[2 * at] or self.any[2 * at + 1]):
                self.any[at] = 0
                at >>= 1
        return window


def best_fit_decreasing(lengths: list[int], window: int = WINDOW) -> list[list[int]]:
    """Which of the lengths (each from 1 to `window`) share a window, in the order in which they were put there."""
    open_, out, rooms = OpenWindows(window), [], []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        room = open_.tightest(n)
        if room < 0:
            out.append([i])
            rooms.append(window - n)
            at = len(out) - 1
        else:
            at = open_.take(room)
            out[at].append(i)
            rooms[at] = room - n
        if rooms[at]:
            open_.put(at, rooms[at])
    return out


def filled(lengths: list[int], window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """(which, start, length) of pieces that fill windows to the brim; at the end windows of powers of two, falling."""
    sizes, total = [], sum(lengths)
    sizes += [window] * (total // window)
    sizes += [1 << b for b in range((total % window).bit_length() - 1, -1, -1) if total % window >> b & 1]
    out: list[list[tuple[int, int, int]]] = []
    i = at = 0
    for size in sizes:
        pieces = []
        while size:
            n = min(size, lengths[i] - at)
            pieces.append((i, at, n))
            size, at = size - n, at + n
            if at == lengths[i]:
                i, at = i + 1, 0
        out.append(pieces)
    return out


def pack(lengths: list[int], window: int = WINDOW, slack: int = SLACK) -> list[list[tuple[int, int, int]]]:
    """Windows as lists of (which, start, length): best fit decreasing, with windows dissolved that have more padding than `slack`."""
    out, loose = [], []
    for members in best_fit_decreasing(lengths, window):
        if window - sum(lengths[i] for i in members) <= slack:
            out.append([(i, 0, lengths[i]) for i in members])
        else:
            loose += members
    loose.sort()
    return out + [[(loose[k], start, n) for k, start, n in pieces] for pieces in filled([lengths[i] for i in loose], window)]


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long"
_ARROW = pa.schema([(c.split()[0], pa.int64()) for c in SCHEMA.split(", ")])


def _chunks(documents: Iterable[tuple[int | None, np.ndarray]]) -> Iterator[list[tuple[int | None, np.ndarray]]]:
    some, held = [], 0
    for doc in documents:
        some.append(doc)
        held += len(doc[1])
        if len(some) == CHUNK_DOCS or held >= CHUNK_TOKENS:
            yield some
            some, held = [], 0
    if some:
        yield some


def packed(documents: Iterable[tuple[int | None, np.ndarray]], first: int, window: int = WINDOW, slack: int = SLACK) -> Iterator[list[tuple]]:
    """Rows of SCHEMA, chunk by chunk, from (doc_id, ids with the end id) of documents; windows are numbered from `first`."""
    for chunk in _chunks(documents):
        rows: list[tuple] = []
        rest: list[tuple[int, int]] = []
        for k, (doc_id, ids) in enumerate(chunk):
            whole = len(ids) // window * window
            for start in range(0, whole, window):
                rows.append((doc_id, start, window, zlib.crc32(ids[start : start + window].tobytes()), len(ids), first, 0, window))
                first += 1
            if whole < len(ids):
                rest.append((k, whole))
        for pieces in pack([len(chunk[k][1]) - whole for k, whole in rest], window, slack):
            offset, total = 0, sum(n for _, _, n in pieces)
            for i, start, n in pieces:
                k, whole = rest[i]
                doc_id, ids = chunk[k]
                rows.append((doc_id, whole + start, n, zlib.crc32(ids[whole + start : whole + start + n].tobytes()), len(ids), first, offset, total))
                offset += n
            first += 1
        yield rows


def pack_documents(docs: DataFrame, window: int = WINDOW, slack: int = SLACK, vocabulary: str | None = None) -> DataFrame:
    """A row for each piece of a document: SCHEMA. sequence_tokens counts the tokens of the piece's window.

    `window` is a power of two from 2 to 2^20; `vocabulary` is a file of the tokenizers library, the same on every machine.
    """
    if window < 2 or window > 1 << 20 or window & (window - 1):
        raise ValueError(f"window of {window} tokens")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end = tokens(vocabulary).of, np.array([END], "<u4")

        def documents() -> Iterator[tuple[int | None, np.ndarray]]:
            for b in sliced(batches):
                for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    yield doc_id, np.concatenate((ids_of(text.as_py()), end))

        for made in packed(documents(), TaskContext.get().partitionId() << 40, window, slack):
            for at in range(0, len(made), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*made[at : at + 10_000], strict=True)], schema=_ARROW)

    return rows.mapInArrow(run, SCHEMA)
