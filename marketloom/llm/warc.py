"""Dictionary-compressed web archives: a WARC record per page, each its own Zstandard frame.

An archive is one byte string: a skippable frame that holds the archive's dictionary,
then one Zstandard frame per record, compressed with that dictionary, so that every
record can be read alone once the dictionary is known. Archives hold a bounded number
of payload bytes and are rows of a table in the shared folder; ``save_archives`` puts
them out as plain files where a mounted folder is at hand.
"""

from __future__ import annotations

import hashlib
import os
import struct
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime
from urllib.parse import quote, unquote

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import numbered, written

#: Fixed values of the formats: the dictionary frame's magic number, a data frame's, and the line end of records.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
CRLF = b"\r\n"

ARCHIVE_BYTES = 8 << 20
DICTIONARY_BYTES = 32 << 10
#: The dictionary of an archive is built from its own records, evenly spaced, up to so many bytes.
SAMPLE_BYTES = 1 << 20
LEVEL = 3
MIN_REVISIT_BYTES = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_types(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """pages (page_id, url, html) with payload_digest, payload_bytes, record_type and refers_to.

    Of equal payloads of min_bytes or more the smallest page_id is the response (of repeated
    rows with that page_id the one of least number; a null page_id only if no other has the
    payload); the rest revisit it. Null html is an empty payload. Payloads count as equal
    when their SHA-256 is. Sums per digest are formed before the shuffle. row_id and
    refers_to_row number the rows, so that rows of one page_id are told apart. Other columns
    of pages are left out.
    """
    payload = F.coalesce(F.col("row.html"), F.lit("")).cast("binary")
    rows = numbered(pages.select("page_id", "url", "html")).select("row_id", "row.page_id", "row.url", "row.html", F.sha2(payload, 256).alias("payload_digest"), F.length(payload).cast("long").alias("payload_bytes"))
    first = F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "row_id"))
    groups = rows.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest").agg(first.alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    revisit = F.col("first").isNotNull() & (F.col("first.row_id") != F.col("row_id"))
    return rows.join(groups, "payload_digest", "left").select(
        "row_id",
        F.when(revisit, F.col("first.row_id")).alias("refers_to_row"),
        "page_id",
        "url",
        "html",
        "payload_digest",
        "payload_bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first.page_id")).alias("refers_to"),
    )


def record_id(row_id: int, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{row_id} {digest}')}>"


def one_line(text: str) -> str:
    """Control characters and the percent sign in percent notation."""
    return "".join(quote(c) if c < " " or c in "%\x7f" else c for c in text)


def warc_record(row_id: int, page_id, url, payload: bytes, digest: str, refers_to=None, refers_to_row: int | None = None, *, date: str) -> bytes:
    """One WARC/1.1 record, a response, or a revisit of the record of refers_to_row.

    The block is an HTTP message whose body is the payload; a revisit's has a head only. A
    null page_id or url has no field; an empty one an empty field.
    """
    revisit = refers_to_row is not None
    body = b"" if revisit else payload
    http = CRLF.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: " + str(len(payload)).encode()]) + CRLF * 2
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(row_id, digest)), ("WARC-Date", date)]
    head += [(k, one_line(str(v))) for k, v in (("WARC-Page-ID", page_id), ("WARC-Target-URI", url)) if v is not None]
    head += [("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to_row, digest))]
        head += [("WARC-Refers-To-Page-ID", one_line(str(refers_to)))] if refers_to is not None else []
    head.append(("Content-Length", str(len(http) + len(body))))
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in head)]
    return CRLF.join(x.encode() for x in lines) + CRLF * 2 + http + body + CRLF * 2


def build_archive(records: list[bytes], *, level: int = LEVEL, dictionary_bytes: int = DICTIONARY_BYTES, sample_bytes: int = SAMPLE_BYTES) -> bytes:
    """The archive of some records. Too few or too small records for a dictionary: an empty dictionary frame."""
    total = sum(map(len, records))
    step = max(1, -(-total // sample_bytes))
    samples = records[::step]
    trained = b""
    if len(samples) >= 8 and sum(map(len, samples)) >= 8 * 1024:
        try:
            trained = zstandard.train_dictionary(min(dictionary_bytes, sum(map(len, samples)) // 8), samples, k=256, d=8, level=level).as_bytes()
        except zstandard.ZstdError:
            trained = b""
    dictionary = zstandard.ZstdCompressionDict(trained) if trained else None
    if dictionary is not None:
        dictionary.precompute_compress(level=level)
    one = zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_content_size=True)
    return struct.pack("<II", DICTIONARY_MAGIC, len(trained)) + trained + b"".join(one.compress(r) for r in records)


def read_archive(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, in order."""
    view = memoryview(archive)
    magic, size = struct.unpack_from("<II", view, 0)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no dictionary frame")
    trained = bytes(view[8 : 8 + size])
    one = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(trained) if trained else None)
    rest = view[8 + size :]
    while len(rest):
        frame = one.decompressobj()
        record = frame.decompress(rest)
        if not frame.eof:
            raise ValueError("cut-off frame")
        yield record
        rest = rest[len(rest) - len(frame.unused_data) :]


def _fields(head: bytes) -> dict:
    return dict(line.decode().partition(": ")[::2] for line in head.split(CRLF)[1:])


def parse_record(record: bytes) -> dict:
    """The fields of a record, its payload and the payload's length as the HTTP head has it."""
    head, _, rest = record.partition(CRLF * 2)
    fields = _fields(head)
    http, _, body = rest[: int(fields["Content-Length"])].partition(CRLF * 2)
    return fields | {"payload": body, "payload_bytes": int(_fields(http)["Content-Length"])}


ARCHIVE_SCHEMA = "archive string, n_records long, bytes binary"


def write_archives(typed: DataFrame, *, archive_bytes: int = ARCHIVE_BYTES, date: str | None = None) -> DataFrame:
    """Archives of the rows of record_types(), written to the shared folder: archive, n_records, bytes.

    date: the records' WARC-Date; without it, the time of this call.
    """
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def pack(frames):
        def out(records):
            data = build_archive(records)
            return {"archive": hashlib.sha256(data).hexdigest()[:32], "n_records": len(records), "bytes": data}

        records, size = [], 0
        for frame in frames:
            for row_id, page_id, url, html, digest, ref, of in zip(*(frame[c] for c in ("row_id", "page_id", "url", "html", "payload_digest", "refers_to", "refers_to_row")), strict=True):
                records.append(warc_record(row_id, page_id, url, (html or "").encode(), digest, ref, int(of) if of else None, date=date))
                size += len(records[-1])
                if size >= archive_bytes:
                    yield pd.DataFrame([out(records)])
                    records, size = [], 0
        if records:
            yield pd.DataFrame([out(records)])

    ids = [F.col(c).cast("string").alias(c) for c in ("page_id", "refers_to")]
    rows = typed.select("row_id", *ids, "url", "html", "payload_digest", F.col("refers_to_row").cast("string").alias("refers_to_row"))
    return written(rows.mapInPandas(pack, ARCHIVE_SCHEMA), "warc")


RECORD_SCHEMA = "page_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary"


def read_archives(archives: DataFrame) -> DataFrame:
    """Every record of the archives, in full: page_id and refers_to as text, the payload as bytes (empty in revisits)."""

    def parse(frames):
        for frame in frames:
            for data in frame["bytes"]:
                rows = []
                for f in map(parse_record, read_archive(data)):
                    said = f["WARC-Payload-Digest"].removeprefix("sha256:")
                    if f["WARC-Type"] == "response" and hashlib.sha256(f["payload"]).hexdigest() != said:
                        raise ValueError(f"digest of record {f['WARC-Record-ID']}")
                    page, url, of = (None if (v := f.get(k)) is None else unquote(v) for k in ("WARC-Page-ID", "WARC-Target-URI", "WARC-Refers-To-Page-ID"))
                    rows.append((page, url, f["WARC-Type"], of, f["payload_bytes"], said, f["payload"]))
                yield pd.DataFrame(rows, columns=[x.split()[0] for x in RECORD_SCHEMA.split(", ")])

    return archives.select("bytes").mapInPandas(parse, RECORD_SCHEMA)


def save_archives(archives: DataFrame, folder: str) -> None:
    """The archives as files ``<archive>.warc.zst`` in a folder that every executor has mounted."""

    def save(rows):
        for r in rows:
            path = os.path.join(folder, f"{r.archive}.warc.zst")
            with open(f"{path}.part", "wb") as f:
                f.write(r.bytes)
            os.replace(f"{path}.part", path)

    os.makedirs(folder, exist_ok=True)
    archives.foreachPartition(save)
