"""WARC archives of pages, compressed with Zstandard: written by the tasks, read back one frame to a record.

An archive begins with a skippable frame that holds its dictionary, then has a frame for each record. A task trains the dictionary on the first
records of its archive (a bounded sample, SAMPLE_BYTES; any dictionary gives back the same bytes), and goes on to another archive when one has reached `Setup.target_bytes`.
Archives have names of their own for each attempt of a task; the manifest, which Spark commits, names those of the attempts that count.

Reading loads the dictionary from the leading frame, finds each frame's end by its block headers, decodes it alone and checks what the record says of itself: the version line,
the mandatory fields, the length of the block and of the payload in it, the closing line ends and the payload's digest. What doesn't hold is an error of that
record (`strict`: a failure), and so is a file that ends inside a frame. Memory is in proportion to the longest record, not to the archive.

Of the pages of one payload, that with the largest page_id is a response and the others are revisits that name it, without the payload. Equal payloads are told by SHA-256; the WARC digest is SHA-1.

Defined cases: a null html is an empty payload; pages that share the largest page_id of their payload (repeated rows) are all responses; a page without page_id is a response
if no page of its payload has one, else a revisit; a null url is left out of the record; line ends inside a url are percent-encoded, as they would
end its field; an empty table gives no archives and no rows; a page of any length is one record; only page_id, url and html are read, so other columns clash with nothing.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldus.llm import scratch

VERSION = b"WARC/1.1"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Frames of the format: the skippable one that holds a dictionary, an ordinary one, and what a dictionary begins with.
SKIPPABLE, FRAME, DICTIONARY = b"\x5d\x2a\x4d\x18", b"\x28\xb5\x2f\xfd", b"\x37\xa4\x30\xec"
#: Payload bytes that a dictionary is trained on, of how much of each page, and its size.
SAMPLE_BYTES, SAMPLE_PAGE, DICTIONARY_BYTES = 1 << 20, 1 << 14, 1 << 15
READ_BYTES = 1 << 18


@dataclass(frozen=True)
class Setup:
    """least: bytes of a payload from which on equal ones are revisits; date: the time stamp of all records, given from outside so that reruns write the same."""

    least: int = 0
    date: str = "2024-01-01T00:00:00Z"
    target_bytes: int = 64 << 20
    level: int = 3


class Malformed(ValueError):
    """A record or an archive that isn't what its headers say."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# Writing


def record_id(page_id: int | None) -> bytes:
    return b"<urn:x-page:%s>" % (b"none" if page_id is None else str(page_id).encode())


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """A response, or a revisit without its payload, as the bytes of its record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    fields = [(b"WARC-Type", b"revisit" if revisit else b"response"), (b"WARC-Record-ID", record_id(page_id)), (b"WARC-Date", date.encode())]
    if url is not None:
        fields.append((b"WARC-Target-URI", url.encode().replace(b"\r", b"%0D").replace(b"\n", b"%0A")))
    if revisit:
        fields += [(b"WARC-Profile", PROFILE), (b"WARC-Refers-To", record_id(refers_to))]
    fields += [(b"WARC-Payload-Digest", b"sha1:" + digest(payload).encode()), (b"Content-Type", b"application/http; msgtype=response"), (b"Content-Length", str(len(block)).encode())]
    return VERSION + b"\r\n" + b"".join(b"%s: %s\r\n" % f for f in fields) + b"\r\n" + block + b"\r\n\r\n"


class Archive:
    """One archive while it is written: the first records wait until the dictionary is trained on them."""

    def __init__(self, files: fs.FileSystem, path: str, setup: Setup):
        self.path, self.setup, self.out = path, setup, files.open_output_stream(path, compression=None)
        self.waiting: list[bytes] = []
        self.held = self.records = self.bytes = 0
        self.encoder: zstandard.ZstdCompressor | None = None

    def add(self, one: bytes) -> None:
        self.records += 1
        if self.encoder is None:
            self.waiting.append(one)
            self.held += len(one)
            if self.held >= min(SAMPLE_BYTES, 8 * self.setup.target_bytes):
                self._begin()
        else:
            self._write(self.encoder.compress(one))

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def _begin(self) -> None:
        try:
            trained = zstandard.train_dictionary(DICTIONARY_BYTES, [x[:SAMPLE_PAGE] for x in self.waiting])
        except zstandard.ZstdError:  # too few or too short records: an archive without a dictionary
            trained = None
        if trained is not None:
            own = trained.as_bytes()
            self._write(SKIPPABLE + len(own).to_bytes(4, "little") + own)
        self.encoder = zstandard.ZstdCompressor(level=self.setup.level, dict_data=trained, write_checksum=True, write_content_size=True)
        for one in self.waiting:
            self._write(self.encoder.compress(one))
        self.waiting = []

    def close(self) -> tuple[str, int, int]:
        if self.encoder is None:
            self._begin()
        self.out.close()
        return self.path, self.records, self.bytes


def decided(pages: DataFrame, setup: Setup = Setup()) -> DataFrame:
    """page_id, url, html and refers_to, and whether the page is a revisit, of every row of pages.

    The largest page_id of a payload comes from a grouped maximum, combined before it is sent; only payloads that several pages have are joined, and the join's frequent ones can be split.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("key", F.sha2(F.encode("html", "utf-8"), 256))
    shared = rows.where(F.octet_length("html") >= setup.least).groupBy("key").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    out = rows.join(shared, "key", "left").drop("key")
    revisit = F.col("last").isNotNull() & ~F.col("last").eqNullSafe(F.col("page_id"))
    return out.select("page_id", "url", "html", F.when(revisit, F.col("last")).alias("refers_to"), revisit.alias("revisit"))


def write(pages: DataFrame, folder: str, setup: Setup = Setup()) -> DataFrame:
    """Writes a record for every row of pages (page_id, url, html) into archives under folder, a URI that all executors can write to; the manifest (path, records, bytes) as a stored table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, at = fs.FileSystem.from_uri(folder)
        done, now = [], None
        for batch in batches:
            payloads = batch.column(2).cast(pa.binary() if pa.types.is_string(batch.column(2).type) else pa.large_binary())
            for i, url, html, refers_to, revisit in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), payloads, batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                if now is None:
                    files.create_dir(at, recursive=True)
                    now = Archive(files, f"{at}/{uuid.uuid4().hex}.warc.zst", setup)
                now.add(record(i, url, html.as_buffer().to_pybytes(), refers_to, revisit, setup.date))
                if now.bytes >= setup.target_bytes:
                    done.append(now.close())
                    now = None
        if now is not None:
            done.append(now.close())
        paths, records, size = zip(*done, strict=True) if done else ((), (), ())
        names = [f"{folder.rstrip('/')}/{p.rpartition('/')[2]}" for p in paths]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(records, pa.int64()), pa.array(size, pa.int64())], names=["path", "records", "bytes"])

    return scratch.stored(decided(pages, setup).mapInArrow(run, "path string, records long, bytes long"), "warc-manifest")


# Reading


class _Stream:
    """Exact reads from a file; a file that ends too early is malformed."""

    def __init__(self, source: BinaryIO):
        self.source, self.at = source, 0

    def take(self, n: int, may_end: bool = False) -> bytes:
        parts, left = [], n
        while left:
            part = self.source.read(left)
            if not part:
                if may_end and left == n:
                    return b""
                raise Malformed(f"the file ends inside a frame, at byte {self.at}")
            parts.append(part)
            left -= len(part)
            self.at += len(part)
        return b"".join(parts)


def frames(stream: _Stream) -> Iterator[tuple[int, bytes, bytes]]:
    """(place, kind, bytes) of each frame of a file; of a skippable frame its content alone."""
    while start := stream.take(4, may_end=True):
        place = stream.at - 4
        if start[1:] == SKIPPABLE[1:] and start[0] & 0xF0 == 0x50:
            yield place, start, stream.take(int.from_bytes(stream.take(4), "little"))
            continue
        if start != FRAME:
            raise Malformed(f"no frame at byte {place}")
        head = stream.take(1)
        single, checked = head[0] & 0x20, head[0] & 0x04
        # Window, dictionary's number and content's size: their lengths follow from the first byte.
        rest = (0 if single else 1) + (0, 1, 2, 4)[head[0] & 3] + (1 if single else 0, 2, 4, 8)[head[0] >> 6]
        parts = [start, head, stream.take(rest)]
        last = False
        while not last:
            block = stream.take(3)
            number = int.from_bytes(block, "little")
            last, kind, size = bool(number & 1), number >> 1 & 3, number >> 3
            if kind == 3:
                raise Malformed(f"a block of no kind in the frame at byte {place}")
            parts += [block, stream.take(1 if kind == 1 else size)]
        if checked:
            parts.append(stream.take(4))
        yield place, FRAME, b"".join(parts)


def decoded(source: BinaryIO) -> Iterator[tuple[int, bytes | None, str | None]]:
    """(place, record or None, error or None) of each record of an archive. A frame that can't be decoded is an error of its own; where no frame can be found, the archive ends with one."""
    trained, stream = None, _Stream(source)
    try:
        for k, (place, kind, data) in enumerate(frames(stream)):
            if kind != FRAME:
                if kind == SKIPPABLE and k == 0:
                    if data[:4] == FRAME:  # a dictionary may be compressed itself
                        data = zstandard.ZstdDecompressor().decompress(data)
                    if data[:4] != DICTIONARY:
                        raise Malformed("the leading frame holds no dictionary")
                    trained = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_FULLDICT)
                continue
            try:
                size = zstandard.get_frame_parameters(data).content_size
                # A frame without its size is decoded as a stream; it is whole, so its end is its own.
                whole = zstandard.ZstdDecompressor(dict_data=trained)
                yield place, whole.decompress(data) if size != zstandard.CONTENTSIZE_UNKNOWN else whole.decompressobj().decompress(data), None
            except zstandard.ZstdError as e:
                yield place, None, f"frame at byte {place}: {e}"
    except (Malformed, zstandard.ZstdError) as e:
        yield stream.at, None, str(e)


def fields(head: bytes, what: str) -> dict[bytes, bytes]:
    """The named fields of a block of header lines, names in lower case; a line that begins with a space goes on with the one before it."""
    out: dict[bytes, bytes] = {}
    name = b""
    for line in head.split(b"\r\n"):
        if line[:1] in (b" ", b"\t") and name:
            out[name] = (out[name] + b" " + line.strip()).strip()
            continue
        name, colon, value = line.partition(b":")
        name = name.strip().lower()
        if not colon or not name:
            raise Malformed(f"a line of {what} is no field: {line[:80]!r}")
        out[name] = value.strip()
    return out


def _number(text: bytes | None, what: str) -> int:
    if text is None or not text.isdigit():
        raise Malformed(f"{what} is no number: {text!r}")
    return int(text)


def _page(text: bytes | None, what: str) -> int | None:
    if text is None or not (text.startswith(b"<urn:x-page:") and text.endswith(b">")):
        raise Malformed(f"{what} names no page: {text!r}")
    name = text[len(b"<urn:x-page:") : -1]
    if name == b"none":
        return None
    try:
        return int(name)
    except ValueError as e:
        raise Malformed(f"{what} names no page: {text!r}") from e


@dataclass(frozen=True)
class Record:
    page_id: int | None
    url: str | None
    record_type: str
    refers_to: int | None
    payload_digest: str
    payload_bytes: int
    payload: bytes | None


def parsed(data: bytes) -> Record:
    """A record of this module's kinds, with all that it says of itself checked."""
    head, cut, rest = data.partition(b"\r\n\r\n")
    version, _, named = head.partition(b"\r\n")
    if version != VERSION or not cut:
        raise Malformed(f"not a record of {VERSION.decode()}: {data[:20]!r}")
    f = fields(named, "the header")
    for name in (b"warc-type", b"warc-record-id", b"warc-date", b"content-length", b"warc-payload-digest"):
        if name not in f:
            raise Malformed(f"without {name.decode()}")
    if len(f[b"warc-date"]) < 20 or not f[b"warc-date"].endswith(b"Z"):
        raise Malformed(f"no date: {f[b'warc-date']!r}")
    n = _number(f[b"content-length"], "Content-Length")
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise Malformed(f"the block should have {n} bytes and two line ends, and is {len(rest)} bytes with them")
    http, cut, payload = rest[:n].partition(b"\r\n\r\n")
    status, _, more = http.partition(b"\r\n")
    if not status.startswith(b"HTTP/") or not cut:
        raise Malformed(f"no HTTP response: {status[:40]!r}")
    size = _number(fields(more, "the response").get(b"content-length"), "the response's Content-Length")
    algorithm, _, own = f[b"warc-payload-digest"].partition(b":")
    if algorithm != b"sha1" or len(own) != 32 or own.strip(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"):
        raise Malformed(f"no digest: {f[b'warc-payload-digest']!r}")
    kind = f[b"warc-type"]
    if kind == b"response":
        if len(payload) != size:
            raise Malformed(f"the payload should have {size} bytes and has {len(payload)}")
        if digest(payload) != own.decode():
            raise Malformed(f"the payload's digest is {digest(payload)}, not {own.decode()}")
        refers_to = None
    elif kind == b"revisit":
        if f.get(b"warc-profile") != PROFILE:
            raise Malformed(f"a revisit of another profile: {f.get(b'warc-profile')!r}")
        if payload:
            raise Malformed("a revisit with a payload")
        refers_to, payload = _page(f.get(b"warc-refers-to"), "WARC-Refers-To"), None
    else:
        raise Malformed(f"a record of type {kind!r}")
    url = f.get(b"warc-target-uri")
    return Record(_page(f[b"warc-record-id"], "WARC-Record-ID"), None if url is None else url.decode("utf-8", "replace"), kind.decode(), refers_to, own.decode(), size, payload)


RECORDS = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary, path string, place long, error string"


def read(spark: SparkSession, manifest: DataFrame, strict: bool = True, payloads: bool = True) -> DataFrame:
    """The records (RECORDS) of the archives that manifest (path, records) names, an archive to a task at a time.

    strict: whatever is wrong with a record or an archive fails the job, and so does an archive of another number of records than the manifest says; else it is told in `error`.
    payloads: whether they are given back (they are checked in any case).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield from archive(path, n)

    def archive(path: str, n: int) -> Iterator[pa.RecordBatch]:
        files, at = fs.FileSystem.from_uri(path)
        rows, held, seen = [], 0, 0
        with files.open_input_stream(at, compression=None, buffer_size=READ_BYTES) as source:
            for place, data, error in decoded(source):
                one = None
                if data is not None:
                    seen += 1
                    try:
                        one = parsed(data)
                    except Malformed as e:
                        error = str(e)
                if error and strict:
                    raise Malformed(f"{path}, byte {place}: {error}")
                rows.append(row(one, path, place, error))
                held += len(data or b"")
                if held >= 4 << 20 or len(rows) >= 4096:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
        if seen != n and n is not None:
            error = f"{n} records in the manifest, {seen} in the archive"
            if strict:
                raise Malformed(f"{path}: {error}")
            rows.append(row(None, path, None, error))
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    def row(x: Record | None, path: str, place: int | None, error: str | None) -> dict:
        own = {} if x is None else {k: getattr(x, k) for k in schema.names[:6]} | {"payload": x.payload if payloads else None}
        return dict.fromkeys(schema.names) | own | {"path": path, "place": place, "error": error}

    whole, text = pa.int64(), pa.string()
    schema = pa.schema(list(zip(("page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload", "path", "place", "error"), (whole, text, text, whole, text, whole, pa.binary(), text, whole, text), strict=True)))
    # Rows are few and small, and each is a file's work.
    return manifest.select("path", "records").repartition(spark.sparkContext.defaultParallelism * 4, "path").mapInArrow(run, RECORDS)


def unresolved(records: DataFrame) -> DataFrame:
    """Revisits whose response isn't among the records, or has another payload."""
    held = records.where("record_type = 'response'").select(F.col("page_id").alias("refers_to"), "payload_digest", "payload_bytes").distinct()
    return records.where("record_type = 'revisit'").join(held, ["refers_to", "payload_digest", "payload_bytes"], "left_anti")


def round_trip(pages: DataFrame, setup: Setup = Setup()) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every row of pages, as its archives have them."""
    spark = pages.sparkSession
    manifest = write(pages, scratch.folder(spark, "warc"), setup)
    return read(spark, manifest, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def oracle() -> str:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    base32 = " || ".join(f"substr('{letters}', 1 + ((('0x' || substr(hex, {1 + 5 * i}, 5))::BIGINT >> {s}) & 31)::INTEGER, 1)" for i in range(8) for s in (15, 10, 5, 0))
    return f"""
WITH own AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS hex, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, {base32} AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to
FROM own"""
