"""WARC archives written from a table of pages and read back as a table of chunks.

Writing: payloads are cut into chunk rows ``(record, chunk number, bytes)`` before they leave the JVM, so a
task never holds more than some chunks; the writer streams them into gzip members, one per record, and starts a new
file at ``archive_bytes``. Equal payloads of at least ``revisit_bytes`` are stored once: the record with the largest
id is the response, the others are revisit records that refer to it. Files carry a name of their own for every attempt, and only
those named in the manifest count, which Spark commits: a lost executor leaves at most an unread file behind. The manifest
also has places where records begin, so that large files are read in parallel.

Reading: a task streams its part of a file, unpacks a bounded piece at a time, and gives a row per chunk with the
SHA-1 of the payload *up to and including that chunk*. The last chunk's digest is that of the payload, so no row is
ever put together again to check or use it.

Skew: the decision which record is the response is an aggregation by digest, joined back with salted keys, so payloads
that very many pages share spread over ``SALTS`` tasks.

Defined cases: null html is an empty payload (one chunk of no bytes); a null id is never referred to while another page
has the payload, and rows with null ids are alike; rows that repeat the largest id of a payload are all responses; a null or
odd url is written percent-encoded; an empty table gives no file and no row; other columns are not read.
"""

from __future__ import annotations

import hashlib
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.scratch import materialize, scratch_path
from lexmill.llm.texts import reach_package

CHUNK_BYTES = 1 << 16
ARCHIVE_BYTES = 1 << 28
#: Compressed bytes after which a reader may begin.
PART_BYTES = 1 << 23
REVISIT_BYTES = 1000
SALTS = 16
#: Rows and bytes of an Arrow batch that a reader hands on.
_BATCH_ROWS, _BATCH_BYTES = 2000, 4 << 20
#: The same for every run, so that archives of equal pages are equal.
WARC_DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared folder, and the folder in it."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def classify(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``page_id, url, payload, n, digest, winner``: ``winner`` is the page a revisit refers to, else null."""
    sized = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")).select(
        "*",
        F.octet_length("payload").cast("long").alias("n"),
        F.sha1("payload").alias("digest"),
        F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).alias("salt"),
    )
    groups = (
        sized.where(F.col("n") >= revisit_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("winner"), F.min("page_id").alias("least"), F.max(F.col("page_id").isNull()).alias("holes"))
        .where((F.col("winner") != F.col("least")) | (F.col("holes") & F.col("winner").isNotNull()))
        .select("digest", "winner", F.explode(F.array(*[F.lit(i).cast("long") for i in range(SALTS)])).alias("salt"))
    )
    joined = sized.join(groups, ["digest", "salt"], "left")
    # The join brings winners for equal digests only, and digests of shorter payloads are never in it.
    return joined.select(
        "page_id", "url", "payload", "n", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("winner")), F.col("winner")).alias("winner")
    )


def chunk_rows(classified: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows ``page_id, url, n, digest, winner, chunk_no, last, chunk``; a record's rows follow each other."""
    stored = F.when(F.col("winner").isNull(), F.col("n")).otherwise(F.lit(0))
    final = F.greatest(F.ceil(stored / chunk_bytes) - 1, F.lit(0)).cast("int")
    return classified.select("*", F.explode(F.sequence(F.lit(0), final)).alias("chunk_no"), final.alias("final")).select(
        "page_id",
        "url",
        "n",
        "digest",
        "winner",
        "chunk_no",
        (F.col("chunk_no") == F.col("final")).alias("last"),
        F.when(F.col("winner").isNull(), F.substring("payload", F.col("chunk_no") * chunk_bytes + 1, F.lit(chunk_bytes))).alias("chunk"),
    )


def _head(row: dict) -> bytes:
    """Header block of a record, and of the HTTP response in it."""
    url = urllib.parse.quote(row["url"] or "about:blank", safe="%/:=&?~#+!$,;'@()*[]")
    record = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{row['page_id']}")
    revisit = row["winner"] is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + b"Content-Length: %d\r\n\r\n" % row["n"]
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{record}>",
        f"WARC-Date: {WARC_DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{row['digest']}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + (0 if revisit else row['n'])}",
        f"X-Payload-Length: {row['n']}",
    ]
    if row["page_id"] is not None:
        lines.append(f"X-Page-Id: {row['page_id']}")
    if revisit:
        target = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{row['winner']}")
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:uuid:{target}>", f"X-Refers-To-Page: {row['winner']}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


class _Archive:
    """One file being written: a gzip member per record."""

    def __init__(self, store: pafs.FileSystem, path: str):
        self.path, self.out, self.size, self.parts, self.records = path, store.open_output_stream(path, compression=None), 0, [0], 0
        self.member = None

    def _put(self, data: bytes) -> None:
        if data:
            self.out.write(data)
            self.size += len(data)

    def begin(self, head: bytes) -> None:
        if self.size - self.parts[-1] >= PART_BYTES:
            self.parts.append(self.size)
        self.member = zlib.compressobj(6, zlib.DEFLATED, 31)
        self.records += 1
        self.add(head)

    def add(self, data: bytes) -> None:
        self._put(self.member.compress(data))

    def end(self) -> None:
        self.add(b"\r\n\r\n")
        self._put(self.member.flush())

    def close(self) -> list[tuple]:
        self.out.close()
        return [(self.path, a, b) for a, b in zip(self.parts, [*self.parts[1:], self.size])]


def _writer(folder: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        archive, done = None, []
        for batch in batches:
            chunks = batch.column("chunk")
            for i, row in enumerate(batch.drop_columns(["chunk"]).to_pylist()):
                if row["chunk_no"] == 0:
                    if archive is None:
                        store.create_dir(base, recursive=True)
                        archive = _Archive(store, f"{base}/{uuid.uuid4().hex}.warc.gz")
                    archive.begin(_head(row))
                if chunks[i].is_valid:
                    archive.add(chunks[i].as_buffer())
                if row["last"]:
                    archive.end()
                    if archive.size >= archive_bytes:
                        done += archive.close()
                        archive = None
        if archive is not None:
            done += archive.close()
        if done:
            path, low, high = zip(*done)
            yield pa.RecordBatch.from_arrays(
                [pa.array(path, pa.string()), pa.array(low, pa.int64()), pa.array(high, pa.int64())], names=["path", "low", "high"]
            )

    return run


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write the records of ``page_id, url, html`` below a shared folder; the manifest ``path, low, high``."""
    reach_package(pages.sparkSession)
    rows = chunk_rows(
        classify(pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))), chunk_bytes
    )
    return materialize(rows.mapInArrow(_writer(folder, archive_bytes), "path string, low long, high long"), "warc-manifest")


def _unpacked(source: pa.NativeFile, low: int, high: int, size: int) -> Iterator[tuple[bytes, bool]]:
    """Pieces of at most ``size`` unpacked bytes; true with the last piece of a member."""
    source.seek(low)
    left, member, packed, full = high - low, zlib.decompressobj(31), b"", False
    while True:
        if not packed and not full:
            packed = source.read(min(left, 1 << 18))
            left -= len(packed)
            if not packed:
                return
        data = member.decompress(packed, size)
        # A piece of full size may leave more behind, even if nothing packed is left.
        packed, full = member.unconsumed_tail, len(data) == size
        if member.eof:
            packed, member, full = member.unused_data, zlib.decompressobj(31), False
            yield data, True
        elif data:
            yield data, False


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode().split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def read_records(source: pa.NativeFile, low: int, high: int, chunk_bytes: int, payload: bool) -> Iterator[tuple]:
    """(header fields, chunk number, payload bytes so far, digest so far, last, chunk) from part of a file."""
    pending, fields, left, state = bytearray(), {}, 0, 0
    for data, ended in _unpacked(source, low, high, chunk_bytes):
        pending += data
        if state == 0 and (cut := pending.find(b"\r\n\r\n")) >= 0:
            fields = _fields(bytes(pending[:cut]))
            del pending[: cut + 4]
            left, state = int(fields["content-length"]), 1
        if state == 1 and (cut := pending.find(b"\r\n\r\n")) >= 0:
            del pending[: cut + 4]
            left -= cut + 4
            digest, number, so_far, state = hashlib.sha1(), 0, 0, 2
        if state == 2:
            while left > chunk_bytes and len(pending) >= chunk_bytes or len(pending) >= left:
                size = min(left, chunk_bytes)
                chunk = bytes(pending[:size])
                del pending[:size]
                left -= size
                so_far += size
                digest.update(chunk)
                yield fields, number, so_far, digest.hexdigest(), left == 0, chunk if payload else None
                number += 1
                if not left:
                    state = 3
                    break
        if ended:
            if state != 3 or bytes(pending) != b"\r\n\r\n":
                raise ValueError(f"record {fields.get('warc-record-id')} is damaged")
            pending, state = bytearray(), 0


RECORDS = (
    "page_id long, record_type string, refers_to long, url string, stated_bytes long, stated_digest string, "
    "chunk_no int, bytes_so_far long, digest_so_far string, last boolean, chunk binary"
)


def _reader(chunk_bytes: int, payload: bool, scheme: str):
    kinds = [
        pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(),
        pa.int32(), pa.int64(), pa.string(), pa.bool_(), pa.binary(),
    ]
    names = [f.split()[0] for f in RECORDS.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(scheme)
        rows, held = [], 0
        for batch in batches:
            for part in batch.to_pylist():
                with store.open_input_file(part["path"]) as source:
                    for f, number, so_far, digest, last, chunk in read_records(source, part["low"], part["high"], chunk_bytes, payload):
                        page, refers = f.get("x-page-id"), f.get("x-refers-to-page")
                        rows.append(
                            (
                                page and int(page), f["warc-type"], refers and int(refers), f["warc-target-uri"], int(f["x-payload-length"]),
                                f["warc-payload-digest"].removeprefix("sha1:"), number, so_far, digest, last, chunk,
                            )
                        )
                        held += len(chunk or b"")
                        if len(rows) >= _BATCH_ROWS or held >= _BATCH_BYTES:
                            yield batch_of(rows)
                            rows, held = [], 0
        if rows:
            yield batch_of(rows)

    return run


def read_chunks(manifest: DataFrame, folder: str, payload: bool = True, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunked record table of the archives in a manifest; without ``payload`` the chunks themselves are null."""
    n = manifest.count()
    parts = manifest.repartition(max(1, n), "path", "low")
    return parts.mapInArrow(_reader(chunk_bytes, payload, folder), RECORDS)


def whole_records(chunks: DataFrame) -> DataFrame:
    """One row per record from its last chunk, whose digest covers the payload. Fails if a response differs from
    what its header states."""
    last = chunks.where("last")
    intact = (F.col("record_type") == "revisit") | (
        (F.col("digest_so_far") == F.col("stated_digest")) & (F.col("bytes_so_far") == F.col("stated_bytes"))
    )
    return last.select(
        "page_id",
        F.col("stated_bytes").alias("payload_bytes"),
        F.when(intact, F.col("stated_digest")).otherwise(F.raise_error(F.lit("a payload differs from its digest"))).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def archived_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op5: write all pages, read the archives back."""
    folder = scratch_path(spark, "warc")
    manifest = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return whole_records(read_chunks(manifest, folder, payload=False))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
m AS (SELECT page_id, strlen(h) AS n, sha1(h) AS d, max(page_id) OVER (PARTITION BY h) AS w FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 1000 AND page_id <> w THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> w THEN w END AS refers_to
FROM m
"""
