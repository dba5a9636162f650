import base64
import gzip
import hashlib
import zlib

import pytest

from sceneloom.llm import warc

PAGES = "page_id long, url string, html string"


def test_round_trip(spark):
    rows = [(1, "http://a/", "<p>é</p>"), (2, "b\r\nc", "<p>é</p>"), (3, None, None), (4, "d", ""), (5, "e", "x" * 400_000), (6, "f", "\r\n\r\nWARC/1.1\r\n"), (7, "g", "<p>é</p>"), (1, "http://a/", "<p>é</p>")]
    got = warc.archive_round_trip(spark.createDataFrame(rows, PAGES).selectExpr("*", "1 AS digest", "2 AS n_bytes")).collect()
    assert len(got) == len(rows)
    html = {i: (h or "").encode() for i, _, h in rows}
    first = {}
    for i, h in sorted(html.items()):
        first.setdefault(h, i)
    for r in got:
        h = html[r.page_id]
        assert r.payload_bytes == len(h)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(h).digest()).decode()
        is_first = first[h] == r.page_id
        assert (r.record_type, r.refers_to) == (("response", None) if is_first else ("revisit", first[h]))


def test_smaller_payloads_are_all_responses(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], PAGES)
    got = {r.page_id: r.record_type for r in warc.with_record_types(df, min_bytes=3).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_empty_table(spark):
    assert warc.archive_round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_null_ids(spark):
    df = spark.createDataFrame([(None, "u", "a"), (5, "u", "a"), (None, "u", "b")], PAGES)
    got = sorted(((r.page_id, r.record_type, r.refers_to) for r in warc.archive_round_trip(df).collect()), key=str)
    assert got == sorted([(5, "response", None), (None, "revisit", 5), (None, "response", None)], key=str)


def record(body: bytes) -> bytes:
    return b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Length: %d\r\n\r\n" % len(body) + body + b"\r\n\r\n"


@pytest.mark.parametrize("step", [1, 7, 1 << 20])
def test_streams_of_one_member_or_many_split_alike(step):
    records = [record(b"a" * n) for n in (0, 1, 5000)]
    whole, members = gzip.compress(b"".join(records)), b"".join(map(gzip.compress, records))
    assert list(warc.split_stream(whole, step)) == records
    assert list(warc.split_stream(members, step)) == records
    with pytest.raises((ValueError, zlib.error)):
        list(warc.split_stream(gzip.compress(b"".join(records)[:-9]), step))


def test_records_are_read_by_offset(spark, tmp_path):
    df = spark.createDataFrame([(i, f"u{i}", f"<p>{i}</p>") for i in range(40)], PAGES)
    raw, path = str(tmp_path / "raw"), str(tmp_path / "norm")
    warc.write_monolithic(df, raw)
    warc.normalise(spark, raw, path)
    files = {p.parent.name.removeprefix("archive="): p.read_bytes() for p in (tmp_path / "norm" / "kind=records").glob("archive=*/part-*")}
    index = warc.read_index(spark, path).collect()
    assert len(index) == 40
    for r in index:
        data = warc.read_member(files[r.archive], r.at, r.length)
        assert warc.headers_of(data)["warc-record-id"] == r.record_id
    for data in files.values():  # the whole is a gzip file that any reader takes
        assert gzip.decompress(data).count(b"WARC/1.1") > 0


def test_every_archive_is_read_whatever_its_name(spark, tmp_path):
    raw = tmp_path / "raw"
    (raw / "deeper").mkdir(parents=True)
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Length: 4\r\n\r\nsoft\r\n\r\n"
    http = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\nbody"
    page = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:2>\r\nWARC-Target-URI: http://a/\r\nContent-Length: %d\r\n\r\n" % len(http) + http + b"\r\n\r\n"
    (raw / "CC-MAIN-0001.warc.gz").write_bytes(gzip.compress(info + page))
    (raw / "deeper" / "CC-MAIN-0001.warc.gz").write_bytes(gzip.compress(info) + gzip.compress(page))
    (raw / "plain.warc").write_bytes(info + page)
    warc.normalise(spark, str(raw), str(tmp_path / "norm"))
    got = warc.read_archives(spark, str(tmp_path / "norm")).collect()
    assert sorted((r.record_type, bytes(r.payload), r.url) for r in got) == [("response", b"body", "http://a/")] * 3 + [("warcinfo", b"soft", None)] * 3
    assert len({r.archive for r in got}) == 3
    with pytest.raises(ValueError, match="takes none"):
        warc.normalise(spark, str(raw), str(tmp_path / "none"), glob="part-*")
    (raw / "notes.txt").write_text("this is not an archive")
    with pytest.raises(Exception, match="ends within a record"):
        warc.normalise(spark, str(raw), str(tmp_path / "bad"))


@pytest.mark.parametrize("fault", ["offset", "id", "missing line", "no index"])
def test_a_bad_index_is_an_error(spark, tmp_path, fault):
    df = spark.createDataFrame([(i, f"u{i}", f"<p>{i}</p>") for i in range(6)], PAGES).coalesce(1)
    warc.write_monolithic(df, str(tmp_path / "raw"))
    warc.normalise(spark, str(tmp_path / "raw"), str(tmp_path / "norm"))
    file = next(f for f in (tmp_path / "norm" / "kind=index").glob("archive=*/part-*") if len(gzip.decompress(f.read_bytes())) > 0)
    lines = gzip.decompress(file.read_bytes()).decode().splitlines()
    if fault == "offset":
        lines[2] = "1" + lines[2]
    elif fault == "id":
        lines[2] = lines[2].rsplit(":", 1)[0] + ":99>"
    else:
        del lines[-1]
    (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    if fault == "no index":
        file.unlink()
    else:
        file.write_bytes(gzip.compress("".join(x + "\n" for x in lines).encode()))
    with pytest.raises(Exception, match="index|isn't|no member"):
        warc.read_archives(spark, str(tmp_path / "norm")).count()


def test_hot_payloads_are_dealt(spark, monkeypatch):
    from sceneloom.llm import common

    monkeypatch.setattr(common, "BROADCAST_ROWS", 2)
    rows = [(i, "u", "hot") for i in range(50)] + [(100 + i, "u", f"p{i // 2}") for i in range(20)] + [(None, "u", "p0"), (200, "u", None), (201, "u", "")]
    got = {(r.page_id, r.html): (r.record_type, r.refers_to) for r in warc.with_record_types(spark.createDataFrame(rows, PAGES)).collect()}
    assert len(got) == len(rows)
    for i, _, h in rows:
        first = min(j for j, _, x in rows if (x or "") == (h or "") and j is not None)
        assert got[i, h or ""] == (("response", None) if i == first else ("revisit", first))
