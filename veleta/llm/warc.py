"""WARC archives as a chunked record table.

An archive is a table of rows (record_id, chunk_no, data): the data of a
record's rows in order are its WARC bytes as gzip members, header block first,
so that joined they are a .warc.gz record. Payloads are cut into chunks where
they are read, before any row is handed to Python, and each row carries the
SHA-1 of the payload up to its end, so that writer and reader hold one chunk and
one running digest, never a whole record, and a lost or damaged chunk shows at
once. The table is written to the shared folder and read back from there.

Of records with equal payloads of at least `least` bytes the one with the
largest page identifier is a response and the others are revisits of it.
Payload equality goes by SHA-256 and length; the groups are pre-aggregated, and
only groups of several rows are joined back: by broadcast where they are few
(`BROADCAST_GROUPS`), so that no payload is shuffled, by a shuffle beyond.

Records are named by a random UUID each; the page identifier is a field of its
own. All of them carry the date of writing, for the tables hold none of
fetching.

Defined results: null payload counts as empty; an empty payload has one header
row; null urls leave the target field out; repeated page identifiers each get
a record of their own, and all of them that carry the largest identifier are
responses; an empty table gives an empty archive; further columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterable, Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veleta.llm.shared import shared_folder, small_batches

#: Payload bytes in a chunk row.
CHUNK_BYTES = 64 << 10
#: Longest header block that a reader accepts.
HEADER_BYTES = 1 << 20
#: Payloads of fewer bytes are always stored.
LEAST_BYTES = 1000
#: Up to so many groups of equal payloads are broadcast (about 200 bytes each).
BROADCAST_GROUPS = 1 << 16
GZIP_LEVEL = 3
_END = b"\r\n\r\n"

CHUNK_FIELDS = "record_id string, chunk_no int, running_sha1 string, data binary"
_CHUNKS = pa.schema([("record_id", pa.string()), ("chunk_no", pa.int32()), ("running_sha1", pa.string()), ("data", pa.binary())])
RECORD_FIELDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
_RECORDS = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
)


def _batches(rows: Iterable[tuple], schema: pa.Schema, size_of, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += size_of(row)
        if size > most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def _clean(value: str) -> str:
    """A header value on one line."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def _member(data: bytes) -> bytes:
    """One gzip member."""
    return gzip.compress(data, compresslevel=GZIP_LEVEL, mtime=0)


def header(key: str, page_id, url, n: int, digest: str, revisit: bool, refers_to, refers_url, date: str) -> bytes:
    """WARC and HTTP header blocks of a record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + b"Content-Length: %d" % n + _END
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{key}>",
        f"WARC-Date: {date}",
        *([f"WARC-Target-URI: {_clean(url)}"] if url is not None else []),
        f"WARC-Payload-Digest: sha1:{digest}",
        *([f"X-Page-ID: {page_id}"] if page_id is not None else []),
        f"X-Payload-Length: {n}",
    ]
    if revisit:
        fields += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page: {refers_to}", f"WARC-Refers-To-Date: {date}"]
        fields += [f"WARC-Refers-To-Target-URI: {_clean(refers_url)}"] if refers_url is not None else []
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + (0 if revisit else n)}"]
    return "\r\n".join(fields).encode() + _END + http


class RecordWriter:
    """Makes the rows of records from their chunks, with a running digest."""

    def __init__(self, date: str):
        self.date, self.running = date, hashlib.sha1()

    def rows(self, key, page_id, url, n, digest, revisit, refers_to, refers_url, no, last, piece) -> Iterator[tuple]:
        """Rows for one chunk; before the first one goes the header, which is all of a revisit or of an empty payload."""
        if no == 0:
            self.running = hashlib.sha1()
            head = header(key, page_id, url, n, digest, revisit, refers_to, refers_url, self.date)
            yield key, 0, self.running.hexdigest(), _member(head if piece is not None else head + _END)
        if piece is not None:
            self.running.update(piece)
            if last and self.running.hexdigest() != digest:
                raise ValueError(f"the chunks of page {page_id} do not make its payload")
            yield key, no + 1, self.running.hexdigest(), _member(piece + _END if last else piece)


def write_rows(date: str):
    """mapInArrow function: chunk rows of records from `plan_chunks`, whose order it relies on."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = RecordWriter(date)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for at in range(0, batch.num_rows, 64):
                    for row in zip(*(c.to_pylist() for c in batch.slice(at, 64).columns)):
                        yield from writer.rows(*row)

        yield from _batches(rows(), _CHUNKS, lambda r: len(r[3]) + 100)

    return run


class RecordReader:
    """Reads one record from its chunks, with a running digest."""

    def __init__(self) -> None:
        self.head, self.fields, self.digest, self.seen, self.left, self.next_no = b"", None, hashlib.sha1(), 0, 0, 0

    def feed(self, chunk_no: int, running: str, data: bytes) -> None:
        if chunk_no != self.next_no:
            raise ValueError(f"chunk {self.next_no} is missing")
        self.next_no += 1
        data = gzip.decompress(data)
        if self.fields is None:
            self.head += data
            at = self.head.find(_END)
            body = self.head.find(_END, at + 4) if at >= 0 else -1
            if body < 0:
                if len(self.head) > HEADER_BYTES:
                    raise ValueError("no end of the header block")
                return
            lines = self.head[:at].decode().split("\r\n")
            self.fields = dict(x.split(": ", 1) for x in lines[1:])
            data, self.head = self.head[body + 4 :], b""
            self.left = int(self.fields["Content-Length"]) - (body - at)
        piece = memoryview(data)[: self.left]
        self.digest.update(piece)
        self.seen += len(piece)
        self.left -= len(piece)
        if self.digest.hexdigest() != running:
            raise ValueError(f"chunk {chunk_no} is damaged")

    def record(self) -> tuple:
        f = self.fields
        if f is None or self.left:
            raise ValueError("the record ends early")
        digest, revisit = f["WARC-Payload-Digest"].removeprefix("sha1:"), f["WARC-Type"] == "revisit"
        if not revisit and (self.digest.hexdigest() != digest or self.seen != int(f["X-Payload-Length"])):
            raise ValueError("payload and digest differ")
        number = lambda v: None if v is None else int(v)
        size = int(f["X-Payload-Length"]) if revisit else self.seen
        return number(f.get("X-Page-ID")), f.get("WARC-Target-URI"), size, digest, f["WARC-Type"], number(f.get("X-Refers-To-Page"))


def read_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of rows that are sorted by record and chunk number."""

    def rows() -> Iterator[tuple]:
        current, reader = None, None
        for batch in batches:
            key, no, running, data = (batch.column(i) for i in range(4))
            for i in range(batch.num_rows):
                if (k := key[i].as_py()) != current:
                    if reader:
                        yield reader.record()
                    current, reader = k, RecordReader()
                reader.feed(no[i].as_py(), running[i].as_py(), data[i].as_py())
        if reader:
            yield reader.record()

    yield from _batches(rows(), _RECORDS, lambda r: 200)


def plan_chunks(spark: SparkSession, pages: DataFrame, least: int = LEAST_BYTES, chunk: int = CHUNK_BYTES) -> DataFrame:
    """The chunks of every row of `pages` (page_id, url, html), each record's in order, one without data for records that have none.

    key, page_id, url, n, digest, revisit, refers_to, refers_url, no, last, piece.
    """
    page = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    own = lambda df: df.withColumns({"h": F.sha2("html", 256), "n": F.octet_length("html")})
    shared = (
        own(page).filter(F.col("n") >= least)
        .groupBy("h", "n")
        .agg(F.max("page_id").alias("keep"), F.max_by("url", "page_id").alias("keep_url"), F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1 and keep is not null")
        .drop("rows")
    )
    few = shared.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    rows = own(page).join(F.broadcast(shared) if few else shared, ["h", "n"], "left")
    revisit = F.col("keep").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep"))
    rows = rows.select(F.uuid().alias("key"), "page_id", "url", "n", F.sha1("html").alias("digest"), revisit.alias("revisit"), F.when(revisit, F.col("keep")).alias("refers_to"), F.when(revisit, F.col("keep_url")).alias("refers_url"), F.col("html").cast("binary").alias("body"))
    cuts = F.transform(F.sequence(F.lit(0), F.floor((F.greatest(F.col("n"), F.lit(1)) - 1) / chunk).cast("int")), lambda i: F.substr("body", i * chunk + 1, F.lit(chunk)))
    pieces = F.when(F.col("revisit") | (F.col("n") == 0), F.array(F.lit(None).cast("binary"))).otherwise(cuts)
    names = ["key", "page_id", "url", "n", "digest", "revisit", "refers_to", "refers_url"]
    made = rows.select(*names, F.posexplode(pieces).alias("no", "piece"))
    return made.select(*names, "no", ((F.col("no") + 1) * chunk >= F.col("n")).alias("last"), "piece")


def write_archive(spark: SparkSession, pages: DataFrame, path: str, least: int = LEAST_BYTES) -> None:
    """Write the chunked record table of `pages`."""
    small_batches(spark)
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    plan_chunks(spark, pages, least).mapInArrow(write_rows(date), CHUNK_FIELDS).write.mode("errorifexists").parquet(path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records of an archive, each streamed chunk by chunk."""
    chunks = spark.read.schema(CHUNK_FIELDS).parquet(path)
    dealt = chunks.repartition("record_id").sortWithinPartitions("record_id", "chunk_no")
    return dealt.mapInArrow(read_rows, RECORD_FIELDS)


def round_trip(spark: SparkSession, pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    path = shared_folder(spark, "warc")
    write_archive(spark, pages, path, least)
    return read_archive(spark, path)


ORACLE_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, '')))::BIGINT AS n FROM pages
), g AS (
  SELECT html, max(page_id) AS keep FROM p WHERE n >= 1000 GROUP BY html
)
SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN page_id <> keep THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> keep THEN keep END AS refers_to
FROM p LEFT JOIN g USING (html)
"""
