"""Web archives: a writer of WARC/1.1 files and a sequential reader.

A file holds one gzip member per record. The reader inflates it piece by piece, takes each block by its
declared length and verifies the digests, so its memory is bounded by the largest record and not by the file.
On Spark every task writes one file of its own, named afresh per attempt; only files of finished tasks are
listed, so a lost or repeated task leaves no record twice.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import new_folder

_PIECE = 1 << 16
#: Fixed values of the format.
_VERSION = b"WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "<urn:x-page:%s>"


class WarcError(ValueError):
    """A file that is cut short, wrongly framed or fails a digest."""


class Record(NamedTuple):
    headers: dict[str, str]  # names in lower case
    block: bytes

    @property
    def payload(self) -> bytes:
        """The block without its HTTP head."""
        return self.block.partition(b"\r\n\r\n")[2]

    def http_header(self, name: str) -> str | None:
        head = self.block.partition(b"\r\n\r\n")[0].decode("latin-1")
        for line in head.split("\r\n")[1:]:
            key, _, value = line.partition(":")
            if key.strip().lower() == name:
                return value.strip()
        return None


def digest_of(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member."""
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in headers)
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(b"%s\r\n%s\r\n%s\r\n\r\n" % (_VERSION, head, block)) + pack.flush()


def page_record(page_id, url: str | None, payload: bytes, digest: str, response_of, date: str) -> bytes:
    """A response with its payload, or a revisit (``response_of`` is the page it refers to) with the HTTP head only."""
    revisit = response_of is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:x-page:{page_id}"
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _ID % ("" if page_id is None else page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{digest_of(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if revisit:
        headers += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _ID % response_of)]
    return member([*headers, ("Content-Length", str(len(block)))], block)


class _Inflated:
    """The bytes of one gzip member after another, inflated piece by piece."""

    def __init__(self, stream: BinaryIO):
        self._stream, self._raw = stream, b""
        self._unpack, self._ready = None, bytearray()

    def next_member(self) -> bool:
        if self._ready:
            raise WarcError("a member holds more than its record")
        self._raw = self._raw or self._stream.read(_PIECE)
        self._unpack = zlib.decompressobj(31) if self._raw else None
        return self._unpack is not None

    def _more(self) -> bool:
        if self._unpack.eof:
            return False
        self._raw = self._raw or self._stream.read(_PIECE)
        if not self._raw:
            raise WarcError("the file ends inside a member")
        try:
            self._ready += self._unpack.decompress(self._raw, _PIECE)
        except zlib.error as e:
            raise WarcError(f"not a gzip member: {e}") from None
        self._raw = self._unpack.unused_data if self._unpack.eof else self._unpack.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes:
        seen = 0
        while (at := self._ready.find(mark, seen)) < 0:
            seen = max(0, len(self._ready) - len(mark) + 1)
            if not self._more():
                raise WarcError("a record has no end of its headers")
        return self.exactly(at + len(mark))[:-len(mark)]

    def exactly(self, n: int) -> bytes:
        while len(self._ready) < n:
            if not self._more():
                raise WarcError("a member ends before its declared length")
        out = bytes(self._ready[:n])
        del self._ready[:n]
        return out

    def finish(self) -> None:
        while self._more():
            if self._ready:
                raise WarcError("a member holds more than its record")


def records(stream: BinaryIO, verify: bool = True) -> Iterator[Record]:
    """The records of a file in their order. Raises ``WarcError`` where framing or, with ``verify``, a digest is wrong."""
    data = _Inflated(stream)
    while data.next_member():
        lines = data.until(b"\r\n\r\n").split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise WarcError(f"not a WARC record: {bytes(lines[0][:40])!r}")
        headers = {}
        for line in lines[1:]:
            name, colon, value = line.decode().partition(":")
            if not colon:
                raise WarcError(f"not a header: {line[:40]!r}")
            headers[name.strip().lower()] = value.strip()
        length = headers.get("content-length", "")
        if not length.isdigit():
            raise WarcError("a record without Content-Length")
        block = data.exactly(int(length))
        if data.exactly(4) != b"\r\n\r\n":
            raise WarcError("a block is longer than its declared length")
        data.finish()
        record = Record(headers, block)
        if verify:
            _verify(record)
        yield record


def _verify(record: Record) -> None:
    said = record.headers.get("warc-block-digest")
    if said and said != f"sha1:{digest_of(record.block)}":
        raise WarcError(f"block digest of {record.headers.get('warc-record-id')} does not match")
    said = record.headers.get("warc-payload-digest")
    if said and record.headers.get("warc-type") == "response" and said != f"sha1:{digest_of(record.payload)}":
        raise WarcError(f"payload digest of {record.headers.get('warc-record-id')} does not match")


def _file_at(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _write_files(batches: Iterable[pa.RecordBatch], folder: str, most: int, date: str) -> Iterator[pa.RecordBatch]:
    out, size, n = None, 0, 0

    def listed():
        return pa.record_batch([pa.array([name]), pa.array([n], pa.int64())], names=["path", "n_records"])

    for batch in batches:
        for at in range(batch.num_rows):
            page_id, url, payload, digest, response_of = (c[at].as_py() for c in batch.columns)
            if out is None:
                name, size, n = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                files, path = _file_at(name)
                files.create_dir(path.rpartition("/")[0], recursive=True)
                out = files.open_output_stream(path, compression=None)
            digest = base64.b32encode(digest).decode()
            data = page_record(page_id, url, payload or b"", digest, response_of, date)
            out.write(data)
            size, n = size + len(data), n + 1
            if size >= most:
                out.close()
                out = None
                yield listed()
    if out is not None:
        out.close()
        yield listed()


def write_pages(
    pages: DataFrame, folder: str, min_bytes: int = 0, file_bytes: int = 256 << 20, date: str = "2024-01-01T00:00:00Z"
) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) and return the files written (path, n_records).

    Of pages with equal payloads of at least ``min_bytes`` bytes the one with the largest id is a response and the
    others revisit it; smaller payloads are all responses. A null html is an empty payload, a null url becomes a urn.
    Rows that repeat the largest id of a payload are all responses. A page without an id revisits a response like any
    other; where a whole group has no ids, its pages are all responses. Other columns are not looked at.
    """
    spark = pages.sparkSession
    read = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.unhex(F.sha1("payload")))
    firsts = (
        read.filter(F.octet_length("payload") >= min_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("digest", "first_id")
    )
    revisits = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    joined = read.join(firsts, "digest", "left").select("page_id", "url", "payload", "digest", revisits.alias("response_of"))
    manifest = new_folder(spark, "warc-files")
    joined.mapInArrow(
        lambda batches: _write_files(batches, folder, file_bytes, date), "path string, n_records long"
    ).write.parquet(manifest)
    return spark.read.schema("path string, n_records long").parquet(manifest)


def _page_id(record_id: str | None):
    number = re.fullmatch(r"<urn:x-page:(-?\d+)>", record_id or "")
    return int(number[1]) if number else None


READ_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
_READ = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def _read_files(batches: Iterable[pa.RecordBatch], verify: bool, payloads: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri in batch.column(0).to_pylist():
            files, path = _file_at(uri)
            rows, held = [], 0
            with files.open_input_stream(path, compression=None) as stream:
                for record in records(stream, verify):
                    kind = record.headers.get("warc-type")
                    rows.append(
                        {
                            "page_id": _page_id(record.headers.get("warc-record-id")),
                            "url": record.headers.get("warc-target-uri"),
                            "payload_bytes": int(record.http_header("content-length") or len(record.payload)),
                            "payload_digest": record.headers.get("warc-payload-digest", "").removeprefix("sha1:"),
                            "record_type": kind,
                            "refers_to": _page_id(record.headers.get("warc-refers-to")),
                            "payload": record.payload if payloads and kind == "response" else None,
                        }
                    )
                    held += len(rows[-1]["payload"] or b"") + 200
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, _READ)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _READ)


def read_archives(files: DataFrame, verify: bool = True, payloads: bool = True) -> DataFrame:
    """The records of the files that ``files`` lists by ``path``: one row each, revisits without a payload.

    Files are dealt evenly to tasks; each is read from start to end by one.
    """
    spark = files.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return files.select("path").repartition(tasks).mapInArrow(lambda b: _read_files(b, verify, payloads), READ_SCHEMA)


def read_bytes(data: bytes, verify: bool = True) -> list[Record]:
    """The records of a file held in memory."""
    return list(records(io.BytesIO(data), verify))


def archive_pages(spark: SparkSession, pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` to fresh archives in the shared area and read them back."""
    return read_archives(write_pages(pages, new_folder(spark, "warc"), **options), payloads=False)
