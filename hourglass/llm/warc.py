"""Web archives: writing, normalising monolithic gzip files, and reading back by a sidecar index.

Crawlers often write an archive as one gzip stream, which can only be read from its start. The normaliser
inflates such a file once, as a stream, rewrites every record as a gzip member of its own, and writes a
sidecar index of the members' offsets, so that a record can be read alone. Archives roll at a size limit, so a
task holds one record and a buffer at a time.

Files go to the cluster's shared folder under names that hold the task attempt; the tables of file names are
written by Spark, so only files of attempts that succeeded are ever read.

Payloads of at least ``least_revisit`` bytes that several pages have are stored once, in a response record of
the page with the smallest id; the other pages get revisit records that refer to it. The smallest id of a
payload is a partial minimum, and the lookup a join that AQE can split.

Defined results: null html is an empty payload; rows that tie on the smallest id are all responses; a page
without an id is a response unless a page with an id has its payload; an empty table gives an empty table;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.storage import shared_folder, written
from hourglass.llm.text import slices

LEAST_REVISIT = 100
#: Bytes of records after which an archive is closed.
ARCHIVE_BYTES = 32 << 20
CHUNK = 1 << 18
_END = b"\r\n\r\n"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def typed(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          least_revisit: int = LEAST_REVISIT) -> DataFrame:
    """``page_id``, ``url``, ``payload``, its length and digest, and ``refers_to`` (null: a response)."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2("payload", 256)})
    first = (rows.filter(F.col("payload_bytes") >= least_revisit).groupBy(F.col("payload_digest").alias("first_digest"))
             .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1 AND first_id IS NOT NULL").drop("n"))
    # written, so that a payload that many pages share is a skewed join of two plain exchanges
    first = written(first, "first")
    refers = F.when(~F.col("first_id").eqNullSafe(F.col("page_id")), F.col("first_id"))
    return rows.join(first, F.col("payload_digest") == F.col("first_digest"), "left").withColumn(
        "refers_to", refers).drop("first_digest", "first_id")


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(page_id))}>"


def record(page_id: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """A WARC 1.1 record; page ids travel in extension fields, percent-encoded where a header cannot hold them."""
    kind = "response" if refers_to is None else "revisit"
    block = _HTTP % len(payload) + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Payload-Digest: sha256:{digest}", f"Payload-Length: {len(payload)}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if page_id is not None:
        head.append(f"Page-Id: {quote(page_id)}")
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c.isprintable() and c != " " else f"%{ord(c):02X}" for c in url))
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers_to)}", f"Refers-To-Page-Id: {quote(refers_to)}"]
    return "\r\n".join(head).encode() + _END + block + _END


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return dict(line.split(": ", 1) for line in lines[1:])


def records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records (fields, raw bytes) of a stream of inflated bytes."""
    buffer = bytearray()

    def fill(least: int) -> bool:
        while len(buffer) < least:
            more = next(chunks, None)
            if more is None:
                return False
            buffer.extend(more)
        return True

    while fill(1):
        seen = 0
        while (cut := buffer.find(_END, max(0, seen - 3))) < 0:
            seen = len(buffer)
            if not fill(seen + 1):
                raise ValueError("the archive ends inside a record's head")
        fields = parse_head(bytes(buffer[:cut]))
        size = cut + len(_END) + int(fields["Content-Length"]) + len(_END)
        if not fill(size):
            raise ValueError("the archive ends inside a record")
        raw = bytes(buffer[:size])
        del buffer[:size]
        yield fields, raw


def inflated(source) -> Iterator[bytes]:
    """Chunks of a gzip file of one or many members."""
    z = zlib.decompressobj(31)
    while data := source.read(CHUNK):
        while data:
            out = z.decompress(data, CHUNK << 2)
            if out:
                yield out
            if z.eof:
                data, z = z.unused_data, zlib.decompressobj(31)
            else:
                data = z.unconsumed_tail
    if out := z.flush():
        yield out


def _open(path: str):
    """(file system, path in it) for a URI or a plain path."""
    return fs.FileSystem.from_uri(path if ":" in path.split("/")[0] else f"file://{path}")


class Monolith:
    """One gzip stream over all records of an archive."""

    def __init__(self, path: str):
        store, inner = _open(path)
        store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        self.path, self.size, self.records = path, 0, 0
        self.out, self.z = store.open_output_stream(inner, compression=None), zlib.compressobj(6, zlib.DEFLATED, 31)

    def add(self, raw: bytes) -> None:
        self.out.write(self.z.compress(raw))
        self.size += len(raw)
        self.records += 1

    def close(self) -> tuple[str, int]:
        self.out.write(self.z.flush())
        self.out.close()
        return self.path, self.records


def write_archives(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Monolithic archives of :func:`typed` rows; a table of their paths and numbers of records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, done, archive = TaskContext.get(), [], None
        for batch in batches:
            for part in slices(batch):
                for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if archive is None:
                        archive = Monolith(f"{folder}/crawl-{context.partitionId():06d}-{context.taskAttemptId()}-{len(done)}.warc.gz")
                    archive.add(record(page_id, url, payload, digest, refers_to))
                    if archive.size >= archive_bytes:
                        done.append(archive.close())
                        archive = None
        if archive is not None:
            done.append(archive.close())
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())],
                                         names=["archive", "records"])

    picked = rows.select(F.col("page_id").cast("string"), "url", "payload", "payload_digest", F.col("refers_to").cast("string"))
    return written(picked.mapInArrow(run, "archive string, records long"), "archives")


def normalise_file(source: str, target: str) -> int:
    """Rewrite one archive with a member per record and write its index (JSON lines) beside it."""
    store, inner = _open(source)
    to_store, to_inner = _open(target)
    to_store.create_dir(to_inner.rsplit("/", 1)[0], recursive=True)
    offset = n = 0
    with (store.open_input_stream(inner, compression=None) as given, to_store.open_output_stream(to_inner, compression=None) as out,
          to_store.open_output_stream(f"{to_inner}.idx", compression=None) as index):
        for fields, raw in records(inflated(given)):
            z = zlib.compressobj(6, zlib.DEFLATED, 31)
            member = z.compress(raw) + z.flush()
            out.write(member)
            entry = {"offset": offset, "length": len(member), "type": fields["WARC-Type"], "id": fields["WARC-Record-ID"],
                     "uri": fields.get("WARC-Target-URI"), "digest": fields.get("WARC-Payload-Digest")}
            index.write(json.dumps(entry).encode() + b"\n")
            offset += len(member)
            n += 1
    return n


def _spread(archives: DataFrame) -> DataFrame:
    """Archives dealt evenly over tasks: each is work of up to ``ARCHIVE_BYTES``."""
    return archives.select("archive").repartition(
        int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("archive"))


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """A table of the rewritten archives; an archive's index has its name and ``.idx``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for source in batch.column(0).to_pylist():
                target = f"{folder}/{source.rsplit('/', 1)[1].removesuffix('.warc.gz')}-{attempt}.warc.gz"
                n = normalise_file(source, target)
                yield pa.RecordBatch.from_arrays([pa.array([target]), pa.array([n], pa.int64())], names=["archive", "records"])

    return written(_spread(archives).mapInArrow(run, "archive string, records long"), "normalised")


def read_index(archive: str) -> Iterator[dict]:
    store, inner = _open(archive)
    with store.open_input_stream(f"{inner}.idx", compression=None) as f:
        rest = b""
        while data := f.read(CHUNK):
            *lines, rest = (rest + data).split(b"\n")
            yield from map(json.loads, lines)


def read_member(source, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """(fields, payload) of the one record at an offset."""
    source.seek(offset)
    raw = zlib.decompress(source.read(length), 31)
    head, body = raw.split(_END, 1)
    fields = parse_head(head)
    block = body[:int(fields["Content-Length"])]
    return fields, block.split(_END, 1)[1]


def read_archives(archives: DataFrame) -> DataFrame:
    """Rows of normalised archives, record by record through the index. A response's payload is read and its
    digest compared with the record's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                store, inner = _open(archive)
                out: list[list] = [[] for _ in range(6)]
                with store.open_input_file(inner) as f:
                    for entry in read_index(archive):
                        fields, payload = read_member(f, entry["offset"], entry["length"])
                        size, digest = int(fields["Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha256:")
                        if fields["WARC-Type"] == "response" and (len(payload), hashlib.sha256(payload).hexdigest()) != (size, digest):
                            raise ValueError(f"{archive} at {entry['offset']}: the payload differs from its digest")
                        ids = [None if v is None else unquote(v) for v in map(fields.get, ("Page-Id", "Refers-To-Page-Id"))]
                        row = (ids[0], fields.get("WARC-Target-URI"), size, digest, fields["WARC-Type"], ids[1])
                        for c, v in zip(out, row, strict=True):
                            c.append(v)
                kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                    names=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return _spread(archives).mapInArrow(
        run, "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string")


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                       least_revisit: int = LEAST_REVISIT, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the pages as monolithic archives, normalise these, and read the records back."""
    folder = shared_folder(pages.sparkSession, "warc")
    raw = write_archives(typed(pages, id_col, url_col, html_col, least_revisit), f"{folder}/crawl", archive_bytes)
    rows = read_archives(normalise(raw, f"{folder}/normalised"))
    kind = pages.schema[id_col].dataType
    return rows.withColumns({"page_id": F.col("page_id").cast(kind), "refers_to": F.col("refers_to").cast(kind)})
