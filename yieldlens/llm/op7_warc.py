"""WARC archives as a chunked record table.

Writing: every task streams its pages into one WARC 1.1 file in the shared folder, one gzip member for each record,
the payload going through the compressor piece by piece.  Equal payloads of at least ``MIN_REVISIT`` bytes are stored
once: the page with the largest id is the response, the others are revisit records that refer to it.  A file's name
is new for each attempt and only the names that a finished task returns count, so a retried task leaves no
double records.

Reading: each archive is streamed into rows (record_id, chunk_no, ...) of at most ``CHUNK`` payload bytes; the digest
and length of a payload are carried from chunk to chunk, and the last chunk's row has those of the whole.  No step
holds a whole payload, whatever the record's size.

Cases: null html is an empty payload, null url an empty target; payloads below the limit are always responses; rows
that repeat both page_id and payload are equal, and all of them are responses if their id is the largest; a record id
repeats where its page_id does; a null
page_id orders below all others; an empty table writes no archive and reads back no rows; other columns are ignored.
"""

from __future__ import annotations

import datetime
import hashlib
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, shared_path
from .text import table

MIN_REVISIT = 1000
CHUNK = 64 * 1024
MAX_TASKS = 10_000
CRLF = b"\r\n"


def open_store(uri: str):
    """(file system, path) of a shared folder, for any store that pyarrow knows."""
    import re

    from pyarrow import fs

    if uri.startswith("/") or uri.startswith("file:"):
        return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", uri)
    return fs.FileSystem.from_uri(uri)


def plan_records(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, html, payload_digest, payload_bytes, record_type, refers_to.

    Only payload groups of several pages are joined back, on the digest; the group's largest id is combined on the
    map side, and the join's pages side may be split where one payload is very frequent."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), html.alias("html"),
                        F.sha1(html.cast("binary")).alias("payload_digest"),
                        F.octet_length(html).cast("long").alias("payload_bytes"))
    groups = (rows.where(F.col("payload_bytes") >= min_revisit).groupBy("payload_digest")
              .agg(F.max("page_id").alias("_top"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
              .select(F.col("payload_digest").alias("_digest"), "_top"))
    rows = rows.join(groups, F.col("payload_digest") == F.col("_digest"), "left")
    revisit = F.col("_digest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_top"))
    return rows.select("page_id", "url", "html", "payload_digest", "payload_bytes",
                       F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                       F.when(revisit, F.col("_top")).alias("refers_to"))


def record_id(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _write(folder: str, date: str):
    def run(batches):
        import pyarrow as pa

        store, root = open_store(folder)
        name, out, at = f"{root}/{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            rows = []
            html = batch.column("html")
            fields = {c: batch.column(c).to_pylist() for c in batch.schema.names if c != "html"}
            for i in range(batch.num_rows):
                if out is None:
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(name, compression=None)
                kind = fields["record_type"][i]
                payload = memoryview(html[i].as_buffer()) if kind == "response" else memoryview(b"")
                head = [f"WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(fields['page_id'][i])}",
                        f"WARC-Date: {date}",
                        f"WARC-Target-URI: {fields['url'][i].encode('ascii', 'backslashreplace').decode().replace(chr(13), ' ').replace(chr(10), ' ')}",
                        f"WARC-Payload-Digest: sha1:{fields['payload_digest'][i]}",
                        f"X-Payload-Length: {fields['payload_bytes'][i]}"]
                if kind == "revisit":
                    head += [f"WARC-Refers-To: {record_id(fields['refers_to'][i])}",
                             "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
                head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}", "", ""]
                gzip = zlib.compressobj(6, zlib.DEFLATED, 31)
                size = out.write(gzip.compress("\r\n".join(head).encode()))
                for a in range(0, len(payload), CHUNK):
                    size += out.write(gzip.compress(payload[a : a + CHUNK]))
                size += out.write(gzip.compress(CRLF * 2) + gzip.flush())
                rows.append((name, at, size))
                at += size
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                                              pa.array([r[2] for r in rows], pa.int64())], names=["archive", "offset", "length"])
        if out is not None:
            out.close()

    return run


def write_archives(pages: DataFrame, min_revisit: int = MIN_REVISIT, date: str | None = None) -> tuple[str, DataFrame]:
    """Write all pages as WARC records; returns the folder and its index (archive, offset, length).

    ``date`` is the records' time of capture in UTC (2026-01-31T12:00:00Z); pages state none, so the time of this call
    stands for it unless given."""
    date = date or datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    folder = shared_path(pages.sparkSession, "warc")
    index = plan_records(pages, min_revisit).mapInArrow(_write(folder, date), "archive string, offset long, length long")
    return folder, cut_lineage(index)


class Members:
    """Decompressed bytes of a file of gzip members, read in pieces: ``line`` and ``take`` hold one piece at most."""

    def __init__(self, stream):
        self.stream, self.inflate, self.raw, self.buffer = stream, zlib.decompressobj(31), b"", b""

    def more(self) -> bool:
        while True:
            if not self.raw:
                self.raw = self.stream.read(CHUNK)
                if not self.raw:
                    return False
            data = self.inflate.decompress(self.raw, CHUNK)
            if self.inflate.eof:
                self.raw, self.inflate = self.inflate.unused_data, zlib.decompressobj(31)
            else:
                self.raw = self.inflate.unconsumed_tail
            if data:
                self.buffer += data
                return True

    def line(self) -> bytes | None:
        while CRLF not in self.buffer:
            if not self.more():
                return None
        line, _, self.buffer = self.buffer.partition(CRLF)
        return line

    def take(self, most: int) -> bytes:
        if not self.buffer:
            self.more()
        data, self.buffer = self.buffer[:most], self.buffer[most:]
        return data


def records(stream):
    """(fields, chunk number, payload bytes so far, digest so far or of the whole, last, chunk) of an archive."""
    members = Members(stream)
    while (line := members.line()) is not None:
        if not line.startswith(b"WARC/"):
            continue
        fields = {}
        while line := members.line():
            name, _, value = line.decode().partition(": ")
            fields[name.lower()] = value
        left, total, digest, number = int(fields["content-length"]), 0, hashlib.sha1(), 0
        while True:
            chunk = members.take(min(left, CHUNK)) if left else b""
            if left and not chunk:
                raise EOFError(f"archive ends inside record {fields['warc-record-id']}")
            digest.update(chunk)
            total, left = total + len(chunk), left - len(chunk)
            yield fields, number, total, digest.hexdigest(), not left, chunk
            number += 1
            if not left:
                break


CHUNKS = ("record_id string, chunk_no long, last boolean, record_type string, target_uri string, refers_to string, "
          "stated_digest string, stated_bytes long, payload_bytes long, payload_digest string, chunk binary")


def _read(with_chunks: bool):
    def run(batches):
        import pyarrow as pa

        names = [c.split()[0] for c in CHUNKS.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(),
                 pa.int64(), pa.string(), pa.binary()]

        def packed(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)

        for batch in batches:
            for name in batch.column("archive").to_pylist():
                store, path = open_store(name)
                rows, held = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    for f, number, total, digest, last, chunk in records(stream):
                        rows.append((f["warc-record-id"], number, last, f["warc-type"], f["warc-target-uri"],
                                     f.get("warc-refers-to"), f["warc-payload-digest"].removeprefix("sha1:"),
                                     int(f["x-payload-length"]), total, digest, chunk if with_chunks else None))
                        held += len(chunk) if with_chunks else 64
                        if held > 16 * CHUNK:
                            yield packed(rows)
                            rows, held = [], 0
                if rows:
                    yield packed(rows)

    return run


def read_chunks(spark: SparkSession, index: DataFrame, with_chunks: bool = True) -> DataFrame:
    """The chunk table of all archives of an index: one row for each chunk of each record, about one task an archive."""
    names = cut_lineage(index.select("archive").distinct())
    names = names.repartition(max(1, min(names.count(), MAX_TASKS)), "archive")
    return names.mapInArrow(_read(with_chunks), CHUNKS)


def op7_warc(spark, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back from the archives; ``digest_ok`` compares the digest of the
    payload as read with the stated one (of a revisit's response, for revisits none was read: null)."""
    pages = table(spark, sf_dir, "pages")
    _, index = write_archives(pages)
    last = read_chunks(spark, index, with_chunks=False).where("last")
    page = lambda c: F.regexp_extract(c, "^<urn:page:(.*)>$", 1).cast(pages.schema["page_id"].dataType)
    response = F.col("record_type") == "response"
    return last.select(
        F.when(F.col("record_id") != "<urn:page:>", page(F.col("record_id"))).alias("page_id"),
        F.when(response, F.col("payload_bytes")).otherwise(F.col("stated_bytes")).alias("payload_bytes"),
        F.when(response, F.col("payload_digest")).otherwise(F.col("stated_digest")).alias("payload_digest"),
        "record_type", F.when(F.col("refers_to").isNotNull(), page(F.col("refers_to"))).alias("refers_to"),
        F.when(response, F.col("payload_digest") == F.col("stated_digest")).alias("digest_ok"))


SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS payload_digest,
         CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes FROM pages),
g AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top, count(*) OVER (PARTITION BY payload_digest) AS n FROM p),
m AS (SELECT *, payload_bytes >= 1000 AND n > 1 AND page_id IS DISTINCT FROM top AS again FROM g)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN top END AS refers_to, CASE WHEN NOT again THEN true END AS digest_ok
FROM m
"""
