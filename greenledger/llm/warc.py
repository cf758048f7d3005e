"""WARC archives compressed record by record with a dictionary.

Each archive begins with a skippable Zstandard frame that holds a dictionary
built from its own first records; every record is then a frame of its own,
compressed with that dictionary. Equal payloads of some size are stored once, in
the record of the largest page id; the others become revisit records.

Archives are written by the tasks to the shared folder under names of their own,
and only those of finished tasks are listed in the written manifest: what a lost
executor leaves behind is never read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, prepare, scratch, staged

#: Fixed value: magic number of the skippable frame with the dictionary.
SKIPPABLE = 0x184D2A5D

#: Payloads from this size on are stored once.
REVISIT_FROM = 1000

#: Bytes of records that a dictionary is built from, of the dictionary, and of
#: an archive before the next one is begun.
SAMPLE_BYTES, DICTIONARY_BYTES, ARCHIVE_BYTES = 1 << 20, 16 << 10, 64 << 20

_DATE = "1970-01-01T00:00:00Z"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
_BREAK = b"\r\n"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = _DATE) -> bytes:
    """One WARC record: a response with its payload, or a revisit without it."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
            + str(len(payload)).encode() + _BREAK * 2)
    block = http + (payload if refers_to is None else b"")
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <{_urn(page_id)}>", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: <{_urn(refers_to)}>"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + _BREAK * 2


def _urn(page_id: int | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def _page(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on the records; too few or too alike ones serve as they are."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[-DICTIONARY_BYTES:].ljust(8, b" "))


class ArchiveWriter:
    """Writes records to one archive; the first ones wait for the dictionary."""

    def __init__(self, out) -> None:
        self.out, self.waiting, self.size, self.count, self.compress = out, [], 0, 0, None

    def add(self, rec: bytes) -> None:
        self.size += len(rec)
        self.count += 1
        if self.compress:
            self.out.write(self.compress(rec))
            return
        self.waiting.append(rec)
        if self.size >= SAMPLE_BYTES:
            self._begin()

    def _begin(self) -> None:
        trained = dictionary([x[:SAMPLE_BYTES // 8] for x in self.waiting])
        raw = trained.as_bytes()
        self.out.write(struct.pack("<II", SKIPPABLE, len(raw)) + raw)
        self.compress = zstandard.ZstdCompressor(dict_data=trained, level=3).compress
        for rec in self.waiting:
            self.out.write(self.compress(rec))
        self.waiting.clear()

    def close(self) -> None:
        if not self.compress:
            self._begin()
        self.out.close()


def read_archive(source):
    """(headers, http headers, payload) of each record of an open archive."""
    magic, size = struct.unpack("<II", source.read(8))
    if magic != SKIPPABLE:
        raise ValueError("the archive does not begin with a dictionary frame")
    known = zstandard.ZstdCompressionDict(source.read(size))
    plain = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=known)
                              .stream_reader(source, read_across_frames=True), 1 << 16)
    while line := plain.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError("a record does not begin where the last one ended")
        head = _headers(plain)
        block = plain.read(int(head["content-length"]))
        if len(block) != int(head["content-length"]) or plain.read(4) != _BREAK * 2:
            raise ValueError("a record is cut short")
        inner = io.BytesIO(block)
        inner.readline()
        http = _headers(inner)
        yield head, http, inner.read()


def _headers(lines) -> dict[str, str]:
    out = {}
    while (line := lines.readline()) not in (_BREAK, b""):
        name, _, value = line.decode().partition(":")
        out[name.lower()] = value.strip()
    return out


def place(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a folder and its path there. A cluster's folder must be in
    a store that pyarrow reads and writes (file, hdfs, s3, gs, abfs)."""
    return pyarrow.fs.FileSystem.from_uri(folder if "://" in folder else re.sub(r"^file:/*", "/", folder))


def revisits(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, payload, refers_to): the largest id with an equal payload, null
    for the page that keeps its own. Payloads are equal when their SHA-256 and
    length are; a payload that many pages share is dealt out by page id."""
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"),
                        F.encode(F.coalesce(pages[html_col], F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("size", F.octet_length("payload"))
    small = rows.filter(F.col("size") < REVISIT_FROM).select("page_id", "url", "payload",
                                                             F.lit(None).cast("long").alias("refers_to"))
    large = rows.filter(F.col("size") >= REVISIT_FROM).withColumn("same", F.sha2("payload", 256))
    kept = large.groupBy("same", "size").agg(F.max("page_id").alias("kept"))
    large = attach(large, kept, ["same", "size"], "page_id")
    return small.unionByName(large.select(
        "page_id", "url", "payload", F.when(~F.col("page_id").eqNullSafe(F.col("kept")), F.col("kept")).alias("refers_to")))


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write (page_id, url, payload, refers_to) to archives in ``folder``; gives the
    manifest (archive, records). Small partitions, as splits of skewed joins are,
    are written by one task, so that they share archives and dictionaries."""
    prepare(rows.sparkSession)
    rows = rows.coalesce(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches):
        fs, at = place(folder)
        writer, name = None, None
        done = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if writer is None:
                    name = f"pages-{uuid.uuid4().hex}.warc.zst"
                    writer = ArchiveWriter(fs.open_output_stream(f"{at}/{name}", compression=None))
                writer.add(record(*row))
                if writer.size >= ARCHIVE_BYTES:
                    writer.close()
                    done.append((name, writer.count))
                    writer = None
        if writer is not None:
            writer.close()
            done.append((name, writer.count))
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], pa.string()),
                                          pa.array([x for _, x in done], pa.int64())], ["archive", "records"])

    return staged(rows.select("page_id", "url", "payload", "refers_to")
                  .mapInArrow(run, "archive string, records long"), "manifest")


def read_archives(manifest: DataFrame, folder: str, *, payloads: bool = True) -> DataFrame:
    """Records of the archives in the manifest: (page_id, url, record_type,
    refers_to, payload_bytes, payload_digest, payload). A response's digest is
    computed anew and must be the recorded one, and an archive must have as many
    whole records as were written; a revisit has no payload."""
    prepare(manifest.sparkSession)
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def run(batches):
        fs, at = place(folder)
        for batch in batches:
            for archive, records in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows, size, count = [], 0, 0
                with fs.open_input_stream(f"{at}/{archive}", compression=None) as source:
                    for head, http, payload in read_archive(source):
                        recorded = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:"))
                        kind = head["warc-type"]
                        if kind == "response" and (hashlib.sha1(payload).digest() != recorded
                                                   or len(payload) != int(http["content-length"])):
                            raise ValueError(f"{archive}: the payload of {head['warc-record-id']} is damaged")
                        rows.append((_page(head["warc-record-id"]), head.get("warc-target-uri"), kind,
                                     _page(head.get("warc-refers-to")), int(http["content-length"]), recorded.hex(),
                                     payload if payloads and kind == "response" else None))
                        size += len(payload) if payloads else 0
                        count += 1
                        if len(rows) >= 2000 or size >= 8 << 20:
                            yield _batch(rows, names, kinds)
                            rows, size = [], 0
                if count != records:
                    raise ValueError(f"{archive} has {count} whole records of {records}")
                yield _batch(rows, names, kinds)

    return manifest.select("archive", "records").repartition("archive").mapInArrow(
        run, "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
             "payload_digest string, payload binary")


def _batch(rows, names, kinds):
    columns = zip(*rows, strict=True) if rows else ([] for _ in names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)


def archive_pages(pages: DataFrame, *, payloads: bool = False) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back, one
    row per page as :func:`read_archives`.

    Null html is an empty payload; a null url has no header and comes back null;
    control characters and spaces of a url come back percent-encoded. Rows that
    repeat the kept page's id are responses too; null ids come back null and
    refer to the largest id with their payload, if any has one. Other columns are
    ignored; no pages give no archives."""
    folder = scratch(pages.sparkSession, "warc")
    return read_archives(write_archives(revisits(pages), folder), folder, payloads=payloads)
