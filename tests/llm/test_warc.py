import hashlib
import os

import pytest
import zstandard

from marketloom.llm import warc as w

BODY = "<html>" + "same words in every page " * 20


def made():
    rows = [(i, f"http://h/{i}", f"{BODY}{i % 7}") for i in range(60)]
    return rows + [(100, "u", None), (101, "u", ""), (102, None, "tiny"), (103, "u", "tiny"), (104, "u\r\nX: y", BODY), (104, "u", BODY), (105, "u", "é😀" * 40), (None, "u", BODY), (106, "u", "x" * 2_000_000), (107, "u", "\x00\r\n\r\n" * 40)]


def brute(rows):
    first = {}
    for p, _, html in rows:
        data = (html or "").encode()
        if p is not None and len(data) >= 100:
            first[data] = min(p, first.get(data, p))
    out, seen = [], set()
    for p, _, html in rows:
        data = (html or "").encode()
        fresh = len(data) < 100 or (p == first[data] and data not in seen)
        if len(data) >= 100 and p == first[data]:
            seen.add(data)
        out.append((p, len(data), hashlib.sha256(data).hexdigest(), "response" if fresh else "revisit", None if fresh else first[data]))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [3000, 1 << 23])
def test_round_trip(spark, size):
    pages = spark.createDataFrame([(*r, "x") for r in made()], "page_id long, url string, html string, payload string")
    archives = w.write_archives(w.record_types(pages), archive_bytes=size)
    got = w.read_archives(archives).collect()
    num = lambda x: None if x is None else int(x)
    assert sorted(((num(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, num(r.refers_to)) for r in got), key=str) == brute(made())
    for r in got:
        assert (r.record_type == "revisit" and not r.payload) or hashlib.sha256(r.payload).hexdigest() == r.payload_digest


def test_archive_layout():
    records = [w.warc_record(i, i, "u", (BODY + str(i)).encode(), "d", date="2024-01-02T03:04:05Z") for i in range(200)]
    data = w.build_archive(records)
    assert int.from_bytes(data[:4], "little") == w.DICTIONARY_MAGIC
    n = int.from_bytes(data[4:8], "little")
    assert n > 0 and list(w.read_archive(data)) == records
    frame = data[8 + n :]
    assert int.from_bytes(frame[:4], "little") == w.FRAME_MAGIC
    one = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + n])).decompressobj()
    assert one.decompress(frame) == records[0]
    plain = sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in records)
    assert len(frame) < plain


def test_records_as_another_reader_takes_them(spark):
    """The bytes parsed by the format's rules alone: fields, lengths, unique ids, revisits that refer to responses."""
    pages = spark.createDataFrame(made(), "page_id long, url string, html string")
    found = {}
    for row in w.write_archives(w.record_types(pages), archive_bytes=3000, date="2024-01-02T03:04:05Z").collect():
        for record in w.read_archive(bytes(row.bytes)):
            head, block = record.split(b"\r\n\r\n", 1)
            version, *lines = head.decode().split("\r\n")
            fields = dict(x.split(": ", 1) for x in lines)
            size = int(fields["Content-Length"])
            assert version == "WARC/1.1" and len(fields) == len(lines) and block[size:] == b"\r\n\r\n"
            assert fields["WARC-Date"] == "2024-01-02T03:04:05Z" and fields["Content-Type"] == "application/http;msgtype=response"
            http, body = block[:size].split(b"\r\n\r\n", 1)
            assert http.startswith(b"HTTP/1.1 200 OK\r\n") and fields["WARC-Record-ID"] not in found
            assert body == b"" or fields["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(body).hexdigest()
            found[fields["WARC-Record-ID"]] = fields
    assert len(found) == len(made())
    for f in found.values():
        if f["WARC-Type"] == "revisit":
            first = found[f["WARC-Refers-To"]]
            assert first["WARC-Type"] == "response" and first["WARC-Payload-Digest"] == f["WARC-Payload-Digest"]


def test_text_ids_and_urls_come_back(spark):
    rows = [("", "u", BODY), (None, None, "x"), ("a%0A\r\n b: c", "http://h/%41\r\nX: y", BODY), ("é", "", BODY)]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    got = w.read_archives(w.write_archives(w.record_types(pages))).collect()
    assert sorted(((r.page_id, r.url) for r in got), key=str) == sorted(((p, u) for p, u, _ in rows), key=str)
    assert {r.refers_to for r in got if r.record_type == "revisit"} == {""}


def test_few_records_have_an_empty_dictionary():
    data = w.build_archive([b"a", b"b"])
    assert data[4:8] == bytes(4) and list(w.read_archive(data)) == [b"a", b"b"]
    assert list(w.read_archive(w.build_archive([]))) == []


def test_damage_is_found():
    with pytest.raises(ValueError):
        list(w.read_archive(b"12345678"))
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(w.read_archive(w.build_archive([b"a" * 100])[:-3]))


def test_empty_table_and_files(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert w.read_archives(w.write_archives(w.record_types(pages))).collect() == []
    some = spark.createDataFrame(made()[:5], "page_id long, url string, html string")
    archives = w.write_archives(w.record_types(some))
    w.save_archives(archives, str(tmp_path))
    assert sum(len(list(w.read_archive((tmp_path / f).read_bytes()))) for f in os.listdir(tmp_path)) == 5
