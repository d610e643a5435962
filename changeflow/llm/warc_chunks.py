"""WARC archives written and read through a table of chunks.

A payload travels as rows (record, chunk number, bytes) of bounded size. The writer streams a record's chunks into a
gzip member, the reader streams archives back into such rows, each with the SHA-1 of the payload up to and including it
(so a record's last chunk carries its digest), and neither ever holds a whole record. Of records with equal payloads one
is written as a response, the others as revisits that refer to it.

Archives are written by the executors through ``pyarrow.fs``, so the folder may be any that all of them reach. A task
names its files freshly and lists them only when it ends well; what a lost or repeated attempt left is never read.
"""

import hashlib
import uuid
import zlib
from base64 import b32encode
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.session import shared_dir

from .common import arrow, stored

CHUNK_BYTES = 1 << 18
ARCHIVE_BYTES = 1 << 26
MOST_READERS = 100_000
DATE = "2024-01-01T00:00:00Z"
RESPONSE, REVISIT = "response", "revisit"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ROW = "id string, copy long, url string, kind string, refers_id string, n_bytes long, sha1 string, n_chunks long, chunk_no long, bytes binary"
CHUNK_ROW = (
    "record_id string, id string, url string, kind string, refers_id string, n_bytes long, payload_digest string, "
    "chunk_no long, chunk_bytes long, digest_so_far string, is_last boolean, bytes binary"
)


def bare_digest(sha1_hex: str) -> str:
    return b32encode(bytes.fromhex(sha1_hex)).decode()


def _chunks_of(n_bytes: Column, size: int) -> Column:
    return F.greatest(F.ceil(n_bytes / F.lit(size)), F.lit(1)).cast("long")


def _chunk_rows(payload: Column, n_chunks: Column, size: int) -> Column:
    """A struct per chunk: its number and its bytes; one empty chunk for an empty payload."""
    piece = lambda k: F.substring(payload, (k * size + 1).cast("int"), F.lit(size))
    return F.transform(F.sequence(F.lit(0).cast("long"), n_chunks - 1), lambda k: F.struct(k.alias("chunk_no"), piece(k).alias("bytes")))


def records(pages: DataFrame, id_column: str, url: str, payload: str, chunk_bytes: int = CHUNK_BYTES, least_bytes: int = 0) -> tuple[DataFrame, DataFrame]:
    """Rows to write: the chunks of all responses, and one row per revisit.

    Payloads of at least ``least_bytes`` that are equal (by SHA-1 and length) are written once, for the smallest id;
    smaller ones every time. Chunks of equal payloads collapse before they are shuffled, so a payload that a third of
    all pages share moves once per task. NULL payloads are empty; a NULL id comes after all others.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    seen = pages.select(F.col(id_column).alias("id"), F.col(url).cast("string").alias("url"), body.alias("body"))
    seen = seen.withColumn("sha1", F.sha1("body")).withColumn("n_bytes", F.octet_length("body").cast("long"))
    n_chunks = _chunks_of(F.col("n_bytes"), chunk_bytes)
    shared = F.col("n_bytes") >= least_bytes

    exploded = seen.select("id", "url", "sha1", "n_bytes", n_chunks.alias("n_chunks"), F.explode(_chunk_rows(F.col("body"), n_chunks, chunk_bytes)).alias("chunk"))
    exploded = exploded.select("*", "chunk.chunk_no", "chunk.bytes").drop("chunk")
    # the url of the smallest id, as the smallest id comes first in the struct
    first_of = F.min(F.struct(F.col("id").isNull().alias("lacks"), "id", "url"))
    once = exploded.filter(shared).groupBy("sha1", "n_bytes", "n_chunks", "chunk_no").agg(first_of.alias("first"), F.first("bytes").alias("bytes"))
    once = once.select(F.col("first.id").alias("id"), F.lit(1).cast("long").alias("copy"), "first.url", "n_bytes", "sha1", "n_chunks", "chunk_no", "bytes")
    # records of one chunk are whole wherever they stand; only the chunks of longer ones must be brought together
    short, long = once.filter("n_chunks = 1"), once.filter("n_chunks > 1")
    responses = short.unionByName(long.repartition("sha1", "n_bytes").sortWithinPartitions("sha1", "n_bytes", "chunk_no"))
    if least_bytes > 0:
        copies = exploded.filter(~shared).withColumn("copy", F.monotonically_increasing_id() + 1)
        responses = responses.unionByName(copies.select(responses.columns))
    responses = responses.withColumn("kind", F.lit(RESPONSE)).withColumn("refers_id", F.lit(None).cast("string"))

    small = stored(seen.filter(shared).select("id", "url", "sha1", "n_bytes"), "payloads")
    copy = F.row_number().over(Window.partitionBy("id", "sha1", "n_bytes").orderBy("url")).cast("long")
    firsts = small.groupBy("sha1", "n_bytes").agg(F.min("id").alias("first_id"))
    ranked = small.withColumn("copy", copy).join(firsts, ["sha1", "n_bytes"])
    revisits = ranked.filter(~(F.col("id").eqNullSafe(F.col("first_id")) & (F.col("copy") == 1)))
    revisits = revisits.select(
        "id", "copy", "url", F.lit(REVISIT).alias("kind"), F.col("first_id").cast("string").alias("refers_id"), "n_bytes", "sha1",
        F.lit(1).cast("long").alias("n_chunks"), F.lit(0).cast("long").alias("chunk_no"), F.lit(None).cast("binary").alias("bytes"),
    )
    order = [c.split()[0] for c in RECORD_ROW.split(", ")]
    as_text = lambda df: df.withColumn("id", F.col("id").cast("string")).select(order)
    return as_text(responses), as_text(revisits)


def record_id(id_text: str | None, copy: int) -> str:
    return f"<urn:page:{'-' if id_text is None else '=' + quote(id_text, safe='')}:{copy}>"


def _id_of(record: str) -> str | None:
    name = record.strip("<>").split(":")[2]
    return None if name == "-" else unquote(name[1:])


def _header(row: dict) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['n_bytes']}\r\n\r\n".encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {row['kind']}",
        f"WARC-Record-ID: {record_id(row['id'], row['copy'])}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(row['url'] or '', safe=_URI)}",
        f"WARC-Payload-Digest: sha1:{bare_digest(row['sha1'])}",
        "Content-Type: application/http; msgtype=response",
    ]
    if row["kind"] == REVISIT:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(row['refers_id'], 1)}"]
    length = len(http) + (row["n_bytes"] if row["kind"] == RESPONSE else 0)
    return "\r\n".join([*lines, f"Content-Length: {length}", "", ""]).encode() + http


#: Characters that a target keeps; others (blanks and line ends above all) are written as their bytes in hexadecimal.
_URI = ":/?#[]@!$&'()*+,;=%-._~"


class _Archives:
    """Archives of one task: each record a gzip member, a new file when one is full."""

    def __init__(self, folder: str, most: int):
        self.folder, self.most = folder.rstrip("/"), most
        self.files, self.inner = fs.FileSystem.from_uri(self.folder)
        self.files.create_dir(self.inner, recursive=True)
        self.out, self.path, self.size, self.count = None, "", 0, 0

    def begin(self) -> None:
        if self.out is None:
            name = f"{uuid.uuid4().hex}.warc.gz"
            self.path, self.size, self.count = f"{self.folder}/{name}", 0, 0
            self.out = self.files.open_output_stream(f"{self.inner}/{name}", compression=None)
        self.member = zlib.compressobj(1, zlib.DEFLATED, 31)
        self.count += 1

    def write(self, data) -> None:
        packed = self.member.compress(data)
        self.size += len(packed)
        self.out.write(packed)

    def end(self) -> None:
        self.write(b"\r\n\r\n")
        packed = self.member.flush()
        self.size += len(packed)
        self.out.write(packed)

    def close(self) -> dict:
        self.out.close()
        self.out = None
        return {"path": self.path, "records": self.count, "size": self.size}


def write(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``rows`` (chunks of a record one after another) to archives; returns ``path, records, size``, stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives, listed, left = None, [], 0
        for batch in batches:
            for at in range(batch.num_rows):
                row = {n: batch.column(k)[at].as_py() for k, n in enumerate(batch.schema.names) if n != "bytes"}
                if archives is None:
                    archives = _Archives(folder, archive_bytes)
                if row["chunk_no"] == 0:
                    if left:
                        raise ValueError("a record's chunks are not all there")
                    archives.begin()
                    archives.write(_header(row))
                    left = row["n_chunks"]
                if left != row["n_chunks"] - row["chunk_no"]:
                    raise ValueError(f"chunk {row['chunk_no']} of {row['id']} is out of order")
                if row["kind"] == RESPONSE:
                    data = batch.column(batch.schema.get_field_index("bytes"))[at].as_buffer()
                    archives.write(data)
                left -= 1
                if not left:
                    archives.end()
                    if archives.size >= archives.most:
                        listed.append(archives.close())
        if left:
            raise ValueError("a record's chunks are not all there")
        if archives is not None and archives.out is not None:
            listed.append(archives.close())
        yield pa.RecordBatch.from_pylist(listed, schema=pa.schema([("path", pa.string()), ("records", pa.int64()), ("size", pa.int64())]))

    return stored(arrow(rows, run, "path string, records long, size long"), "archives")


class _Reader:
    """Bytes of an archive of gzip members, by line or by number, with a bounded buffer."""

    def __init__(self, stream, block: int = 1 << 18):
        self.stream, self.block = stream, block
        self.member, self.buffer, self.at = zlib.decompressobj(31), b"", 0

    def _fill(self) -> bool:
        while True:
            if self.member.eof:
                rest = self.member.unused_data
                self.member = zlib.decompressobj(31)
            else:
                rest = self.member.unconsumed_tail
            rest = rest or self.stream.read(self.block)
            if not rest:
                return False
            if data := self.member.decompress(rest, self.block):
                self.buffer, self.at = self.buffer[self.at :] + data, 0
                return True

    def line(self) -> bytes:
        while (end := self.buffer.find(b"\r\n", self.at)) < 0:
            if not self._fill():
                rest, self.at = self.buffer[self.at :], len(self.buffer)
                return rest
        out, self.at = self.buffer[self.at : end], end + 2
        return out

    def take(self, most: int) -> bytes:
        while self.at >= len(self.buffer):
            if not self._fill():
                return b""
        out = self.buffer[self.at : self.at + most]
        self.at += len(out)
        return out

    def exactly(self, size: int) -> bytes:
        parts = []
        while size:
            if not (part := self.take(size)):
                raise ValueError("the archive ends within a record")
            parts.append(part)
            size -= len(part)
        return b"".join(parts)

    def more(self) -> bool:
        return self.at < len(self.buffer) or self._fill()


def _read_records(reader: _Reader, chunk_bytes: int, with_bytes: bool) -> Iterator[dict]:
    while reader.more():
        if not reader.line().startswith(b"WARC/"):
            raise ValueError("not the start of a WARC record")
        fields = {}
        while line := reader.line():
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        left = int(fields["content-length"])
        n_bytes = 0
        while line := reader.line():
            left -= len(line) + 2
            if line.lower().startswith(b"content-length:"):
                n_bytes = int(line.split(b":")[1])
        left -= 2
        digest = hashlib.sha1()
        base = {
            "record_id": fields["warc-record-id"],
            "id": _id_of(fields["warc-record-id"]),
            "url": fields.get("warc-target-uri"),
            "kind": fields["warc-type"],
            "refers_id": _id_of(fields["warc-refers-to"]) if "warc-refers-to" in fields else None,
            "n_bytes": n_bytes,
            "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:"),
        }
        chunk_no = 0
        while left or not chunk_no:
            data = reader.exactly(min(left, chunk_bytes))
            left -= len(data)
            digest.update(data)
            so_far = b32encode(digest.copy().digest()).decode()
            yield base | {
                "chunk_no": chunk_no, "chunk_bytes": len(data), "digest_so_far": so_far, "is_last": not left, "bytes": data if with_bytes else None
            }
            chunk_no += 1
        if reader.exactly(4) != b"\r\n\r\n":
            raise ValueError("a record is longer than its header says")


def read(archives: DataFrame, chunk_bytes: int = CHUNK_BYTES, with_bytes: bool = True) -> DataFrame:
    """The records of the listed ``path`` archives as chunk rows; a revisit is one chunk without bytes.

    ``payload_digest`` is what the record's header says, ``digest_so_far`` what the bytes read up to here give.
    """
    # a given number of partitions is kept, where adaptive execution would read these few bytes of paths in one task
    listed = max(1, archives.count())
    spread = archives.select("path").repartition(min(listed, MOST_READERS), F.xxhash64("path"))
    schema = pa.schema(
        [(n, {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}[t]) for n, t in (x.split() for x in CHUNK_ROW.split(", "))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, inner = fs.FileSystem.from_uri(path)
                with files.open_input_stream(inner, compression=None) as stream:
                    rows, size = [], 0
                    for row in _read_records(_Reader(stream), chunk_bytes, with_bytes):
                        rows.append(row)
                        size += len(row["bytes"] or b"")
                        if len(rows) >= 1000 or size >= 1 << 23:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return arrow(spread, run, CHUNK_ROW)


def write_pages(
    pages: DataFrame, folder: str, id_column: str = "page_id", url: str = "url", payload: str = "html", chunk_bytes: int = CHUNK_BYTES, least_bytes: int = 0
) -> DataFrame:
    """Archives of ``pages`` in ``folder``; returns the list of them."""
    responses, revisits = records(pages, id_column, url, payload, chunk_bytes, least_bytes)
    return write(responses, folder).unionByName(write(revisits, folder))


def round_trip(pages: DataFrame, id_column: str = "page_id", **options) -> DataFrame:
    """Write ``pages`` and read the archives back: a row per page with what its record says.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to``; the digest of a response is that of the bytes read.
    """
    archives = write_pages(pages, shared_dir(pages.sparkSession, "warc"), id_column, **options)
    last = read(archives, with_bytes=False).filter("is_last")
    kind = pages.schema[id_column].dataType
    answered = F.col("kind") == RESPONSE
    return last.select(
        F.col("id").cast(kind).alias(id_column),
        F.col("n_bytes").alias("payload_bytes"),
        F.when(answered, F.col("digest_so_far")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.col("refers_id").cast(kind).alias("refers_to"),
    )
