"""WARC archives: Spark writes monolithic gzip streams, a normaliser inflates each once, rewrites every
record as a gzip member of its own and writes a sidecar offset index; readers take each record at the offset
that the index says, and fail where index and archive disagree.

Files go through Spark's own writers and readers, so any file system that Spark knows will do. A file is one
row of Spark's binaryFile, so it may have 2 GB at most (crawls' files have about 1 GB). Members are bytes that go
through Spark's text writer as a string: it writes a string's bytes as they are, which a test holds it to.

A null html is an empty payload, a null url an empty one (CR and LF become spaces). Records whose
payloads have at least `min_bytes` bytes and are equal form a group: that with the smallest page_id is a
response, the others revisit it; rows that repeat both page_id and payload of a response are responses
too. A null page_id counts as larger than any other. An empty table gives no archives and no rows.
Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_classes, shared_folder, work_path, written

#: What ends a record.
END = "\r\n\r\n"
NO_PAGE = "none"


def _member(data: bytes, level: int = 6) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


#: A gzip member that holds nothing; it stands between the members of an archive.
EMPTY_MEMBER = _member(b"")


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: 160 bits are four times eight base32 digits of 40 bits."""
    hexed = F.sha1(payload)
    digits = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_record_types(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html, digest, n_bytes, record_type, refers_to."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), html.alias("html")).withColumns(
        {"digest": base32_sha1(F.col("html").cast("binary")), "n_bytes": F.octet_length("html").cast("long")}
    )
    slim = rows.select("page_id", "digest", "n_bytes").filter(F.col("n_bytes") >= min_bytes)
    firsts = written(slim.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "warc-firsts")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")) & (F.col("n_bytes") >= min_bytes)
    found = join_classes(rows, firsts, "digest", "n", ["page_id", "url"])
    return found.withColumns({"record_type": F.when(revisit, "revisit").otherwise("response"), "refers_to": F.when(revisit, F.col("first_id"))}).drop("first_id", "n")


def _record_text(date: str) -> Column:
    """A WARC record without its end; revisits hold the HTTP header alone."""
    uri = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit(NO_PAGE)), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n_bytes").cast("string"), F.lit(END))
    body = F.when(F.col("record_type") == "response", F.col("html")).otherwise("")
    refers = F.when(
        F.col("record_type") == "revisit",
        F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "), uri("refers_to")),
    ).otherwise("")
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.col("record_type"),
        F.lit("\r\nWARC-Record-ID: "), uri("page_id"),
        F.lit("\r\nWARC-Date: " + date),
        F.lit("\r\nWARC-Target-URI: "), F.translate(F.col("url"), "\r\n", "  "),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"), refers,
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), (F.octet_length(http) + F.octet_length(body)).cast("string"),
        F.lit(END), http, body,
    )


def write_monolithic(pages: DataFrame, path: str, min_bytes: int = 0, records_per_file: int = 2000, date: str = "1970-01-01T00:00:00Z") -> None:
    """WARC files, each one gzip stream, as crawlers without care write them."""
    rows = with_record_types(pages, min_bytes).select(_record_text(date).alias("value"))
    rows.write.option("compression", "gzip").option("lineSep", END).option("maxRecordsPerFile", records_per_file).text(path)


_LENGTH = re.compile(rb"\r\nContent-Length: *(\d+)", re.I)


class _Stored:
    """What zlib's object does, for a file that isn't compressed."""

    eof, unused_data = False, b""

    def decompress(self, data) -> bytes:
        return bytes(data)

    def flush(self) -> bytes:
        return b""


def split_stream(data: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """Records of a gzip stream (of one member or more) or of a plain file, inflated once, step by step."""
    z = zlib.decompressobj(31) if bytes(data[:2]) == b"\x1f\x8b" else _Stored()
    have = bytearray()
    view = memoryview(data)
    at = 0
    need = None
    while True:
        while need is None or len(have) < need:
            if need is None and (end := have.find(b"\r\n\r\n")) >= 0:
                m = _LENGTH.search(have, 0, end)
                if not m:
                    raise ValueError("a record has no Content-Length")
                need = end + 4 + int(m[1]) + 4
                continue
            if z.eof:
                rest = z.unused_data + bytes(view[at : at + step])
                at += step
                if not rest:
                    break
                z = zlib.decompressobj(31)
                have += z.decompress(rest)
            elif at < len(data):
                have += z.decompress(view[at : at + step])
                at += step
            else:
                have += z.flush()
                break
        if need is None and not have:
            return
        if need is None or len(have) < need:
            if z.eof and (z.unused_data or at < len(data)):
                continue
            raise ValueError("the stream ends within a record")
        yield bytes(have[:need])
        del have[:need]
        need = None


_HEADER = re.compile(r"^(WARC-Record-ID|WARC-Type|WARC-Payload-Digest|WARC-Refers-To|WARC-Target-URI): *(.*?)\r?$", re.M | re.I)


def headers_of(record: bytes) -> dict[str, str]:
    return {m[1].lower(): m[2] for m in _HEADER.finditer(record[: record.find(b"\r\n\r\n")].decode("utf-8", "replace"))}


def _archive_name(path: str) -> str:
    """A name for an archive: the file's name without its endings, and a hash of its whole path, as names may repeat."""
    stem = re.sub(r"[^A-Za-z0-9_-]+", "-", re.sub(r"(\.txt)?(\.warc)?(\.gz)?$", "", path.rsplit("/", 1)[-1]))
    return f"{stem}-{zlib.crc32(path.encode()):08x}"


def normalise(spark: SparkSession, source: str, target: str, level: int = 6, glob: str = "*") -> None:
    """Rewrites each file of `source` as target/kind=records/archive=<name>, a gzip member for each record, with
    target/kind=index/archive=<name>: gzipped lines `offset length record-id`.

    Every file in `source` and the folders below it whose name `glob` takes is read, but for those that Spark itself
    hides (`_` or `.` at the start). One that isn't a WARC file, compressed or not, is an error; so is a glob that takes
    none of the files there. Both files of an archive come from one pass. A file of `source` is held compressed, and
    of its records one at a time is held inflated.
    """
    load = lambda names: spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", names).load(source).select("path", "content")
    files = load(glob)
    if glob != "*" and files.select("path").isEmpty() and not load("*").select("path").isEmpty():
        raise ValueError(f"{glob!r} takes none of the files of {source}")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                archive, at, index, out, held = _archive_name(path), 0, [], [], 0
                for record in split_stream(content.as_buffer()):
                    member = _member(record, level)
                    record_id = headers_of(record).get("warc-record-id")
                    if not record_id:
                        raise ValueError(f"{path}: a record has no WARC-Record-ID")
                    index.append(f"{at} {len(member)} {record_id}\n")
                    out.append(("records", archive, at, member))
                    at += len(member) + len(EMPTY_MEMBER)
                    held += len(member)
                    if held > 1 << 22:
                        yield _rows(out)
                        out, held = [], 0
                out.append(("index", archive, 0, _member("".join(index).encode())))
                yield _rows(out)

    members = files.mapInArrow(rewrite, "kind string, archive string, at long, member binary")
    (
        members.sortWithinPartitions("kind", "archive", "at").select("kind", "archive", F.col("member").cast("string").alias("value"))
        .write.partitionBy("kind", "archive").option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(target)
    )


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds, archives, ats, members = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(archives, pa.string()), pa.array(ats, pa.int64()), pa.array(members, pa.binary())], names=["kind", "archive", "at", "member"])


def _files(spark: SparkSession, path: str, kind: str) -> DataFrame | None:
    """archive, content, length of the files that normalise() wrote."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{path}/kind={kind}")
    except AnalysisException:  # no such folder: the table was empty
        return None
    return files.select(F.regexp_extract("path", "/archive=([^/]+)/", 1).alias("archive"), "content", "length")


def _index_lines(content: bytes | None) -> list[tuple[int, int, str]]:
    """(offset, length, record id) of each line of an index file."""
    out = []
    for line in zlib.decompress(content, 31).decode().splitlines() if content else ():
        at, length, record_id = line.split(" ", 2)
        out.append((int(at), int(length), record_id))
    return out


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """archive, at, length, record_id of the sidecar index."""
    schema = "archive string, at long, length long, record_id string"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for archive, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ats, lengths, ids = zip(*_index_lines(content), strict=True) if _index_lines(content) else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array([archive] * len(ats), pa.string()), pa.array(ats, pa.int64()), pa.array(lengths, pa.int64()), pa.array(ids, pa.string())], names=["archive", "at", "length", "record_id"])

    files = _files(spark, path, "index")
    return spark.createDataFrame([], schema) if files is None else files.select("archive", "content").mapInArrow(read, schema)


def read_member(archive: bytes, at: int, length: int) -> bytes:
    """The record at an offset; a ValueError where no member of this length stands there."""
    z = zlib.decompressobj(31)
    try:
        record = z.decompress(memoryview(archive)[at : at + length]) + z.flush()
    except zlib.error as e:
        raise ValueError(f"no member at {at}: {e}") from e
    if not z.eof or z.unused_data:
        raise ValueError(f"no member of {length} bytes at {at}")
    return record


def _page(uri: str | None) -> int | None:
    """The page of a record id that write_monolithic() made; null for others."""
    m = re.fullmatch(r"<urn:page:(-?\d+)>", uri or "")
    return int(m[1]) if m else None


def _parsed(record: bytes, check: bool) -> tuple:
    """url, payload, its bytes and digest, record type, page that it refers to."""
    h = headers_of(record)
    head = record.find(b"\r\n\r\n") + 4
    kind, digest = h.get("warc-type", ""), h.get("warc-payload-digest")
    bare = digest.removeprefix("sha1:") if digest and digest.startswith("sha1:") else None
    if kind not in ("response", "revisit"):  # no HTTP message: the block is the payload
        payload = record[head:-4]
        return h.get("warc-target-uri"), payload, len(payload), bare, kind, None
    body = record.find(b"\r\n\r\n", head) + 4
    said = _LENGTH.search(record, head - 2, body)
    payload = record[body:-4] if kind == "response" else None
    n = int(said[1]) if said else len(payload or b"")
    if check and payload is not None and bare and (len(payload) != n or base64.b32encode(hashlib.sha1(payload).digest()).decode() != bare):
        raise ValueError(f"payload of {h.get('warc-record-id')} is damaged")
    return h.get("warc-target-uri"), payload, n, bare, kind, _page(h.get("warc-refers-to"))


#: Bytes of index files that may be broadcast.
BROADCAST_INDEX = 32 << 20


def read_archives(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """archive, at, length, record_id, page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to.

    Each record is read at its index line's offset. An archive without an index, a line without its archive, a line
    whose offset, length or record id doesn't hold, and bytes that no line names are errors. payload is null for
    revisits; their byte count is that of the HTTP header. A response's count and digest are those of its payload
    as read; check: they must agree with its headers. The index of an archive goes where the archive is: as a broadcast if
    the indexes are small, else in a shuffle whose build side they are.
    """
    schema = "archive string, at long, length long, record_id string, page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = [x.split()[0] for x in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for archive, content, lines in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                if lines is None:
                    raise ValueError(f"{archive} has no index")
                data, end, out, held = content.as_buffer() if content.is_valid else b"", 0, [], 0
                for at, length, record_id in _index_lines(lines):
                    if at != end or at + length > len(data):
                        raise ValueError(f"{archive}: the index has a record at {at}, the archive one at {end}")
                    record = read_member(data, at, length)
                    if headers_of(record).get("warc-record-id") != record_id:
                        raise ValueError(f"{archive}: the record at {at} isn't {record_id}")
                    out.append((archive, at, length, record_id, _page(record_id), *_parsed(record, check)))
                    held += len(record)
                    end = at + length + len(EMPTY_MEMBER)
                    if held > 1 << 22:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
                        out, held = [], 0
                if end < len(data):
                    raise ValueError(f"{archive}: no index line names what stands at {end}")
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    records, index = _files(spark, path, "records"), _files(spark, path, "index")
    if index is None and records is None:
        return spark.createDataFrame([], schema)
    if index is None:
        raise ValueError(f"{path} has no index")
    lines = index.select("archive", F.col("content").alias("lines"))
    if records is None:
        both = lines.select("archive", F.lit(None).cast("binary").alias("content"), "lines")
    else:
        small = (index.agg(F.sum("length")).collect()[0][0] or 0) <= BROADCAST_INDEX
        joined = records.select("archive", "content").join(F.broadcast(lines) if small else lines.hint("shuffle_hash"), "archive", "left")
        alone = lines.join(records.select("archive"), "archive", "left_anti")  # of empty files there is only an index
        both = joined.unionByName(alone.select("archive", F.lit(None).cast("binary").alias("content"), "lines"))
    return both.mapInArrow(read, schema)


def archive_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes the pages, normalises the archives and reads every record at its index's offset."""
    spark = pages.sparkSession
    shared_folder(spark)
    raw, path = work_path(spark, "warc-raw"), work_path(spark, "warc")
    write_monolithic(pages, raw, min_bytes)
    normalise(spark, raw, path)
    return read_archives(spark, path).select("archive", "at", "length", "record_id", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
