"""WARC archives by way of a table of payload chunks.

A record is rows of (record, chunk number, bytes): a header row's facts on the first, the payload cut
into chunks over all of them. The writer streams the rows of a task into one archive, a record after
the other, and the reader streams archives back the same way; both carry a digest from chunk to chunk,
so neither holds more of a payload than a chunk.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import AtomicFile, file_system
from chatloom.session import scratch_dir

# The format's version, its revisit profile, and the HTTP head before a payload.
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
CHUNK = 1 << 14


def records(pages: DataFrame, least: int = 100) -> DataFrame:
    """Each page with its payload, digest and record type.

    Among payloads of at least ``least`` bytes that are equal, the smallest page_id is the response and
    the others revisit it (rows of that same page_id are responses too); smaller ones are responses.
    Null html is an empty payload; a null page_id is a response. Only digests meet in the shuffle that
    finds copies, and they are counted before it.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.coalesce(F.col("url"), F.lit("")).alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    ).withColumns({"payload_bytes": F.octet_length("payload").cast("bigint"), "payload_digest": F.sha2("payload", 256)})
    large = rows.filter(F.col("payload_bytes") >= least).groupBy("payload_digest")
    copies = large.agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    joined = rows.join(copies, "payload_digest", "left")
    refers = F.when((F.col("payload_bytes") >= least) & (F.col("page_id") != F.col("first")), F.col("first"))
    return joined.withColumn("refers_to", refers).drop("first")


def chunk_table(recs: DataFrame, size: int = CHUNK) -> DataFrame:
    """Rows (page_id, chunk, chunks, data) with the record's facts; revisits have one chunk, empty."""
    whole = F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(F.lit(b""))
    cut = recs.withColumn("payload", whole).withColumn(
        "chunks", F.greatest(F.lit(1), F.ceil(F.octet_length("payload") / size)).cast("int")
    )
    numbered = cut.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    data = F.substring(F.col("payload"), F.col("chunk") * size + 1, F.lit(size))
    return numbered.withColumn("data", data).drop("payload")


def record_head(page_id: int | None, url: str, n_bytes: int, digest: str, refers_to: int | None) -> bytes:
    """The header of a record up to its blank line, and the HTTP head of a response."""
    clean = "".join(c if 0x21 <= ord(c) < 0x7F else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url)
    revisit = refers_to is not None
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:page:{page_id}>",
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Target-URI": clean,
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Payload-Length": n_bytes,
    }
    if revisit:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<urn:page:{refers_to}>", "Content-Length": 0}
    else:
        fields |= {"Content-Type": "application/http; msgtype=response", "Content-Length": len(HTTP_HEAD) + n_bytes}
    head = VERSION + "".join(f"{k}: {v}\r\n" for k, v in fields.items()).encode() + b"\r\n"
    return head if revisit else head + HTTP_HEAD


def write_archives(chunks: DataFrame, folder: str) -> DataFrame:
    """Stream each task's chunk rows into one archive, a gzip member per record; the stored manifest
    lists file and number of records. Rows of a record must lie together in chunk order, as
    :func:`chunk_table` leaves them. An archive appears only when it is whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name = f"{folder}/archive-{context.partitionId():06d}.warc.gz"
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        count = 0
        with AtomicFile(name, context.taskAttemptId()) as stream:
            packer, digest = None, None
            for batch in _chain(first, batches):
                columns = [batch[c].to_pylist() for c in ("page_id", "url", "payload_bytes", "payload_digest", "refers_to", "chunk", "chunks")]
                for row, data in zip(zip(*columns), batch["data"]):
                    page_id, url, n_bytes, expected, refers_to, chunk, chunks = row
                    if chunk == 0:
                        packer, digest = zlib.compressobj(1, zlib.DEFLATED, 31), hashlib.sha256()
                        stream.write(packer.compress(record_head(page_id, url, n_bytes, expected, refers_to)))
                        count += 1
                    part = data.as_py()
                    digest.update(part)
                    stream.write(packer.compress(part))
                    if chunk == chunks - 1:
                        if refers_to is None and digest.hexdigest() != expected:
                            raise ValueError(f"payload of page {page_id} is not what its digest says")
                        stream.write(packer.compress(b"\r\n\r\n") + packer.flush())
        yield pa.record_batch([pa.array([name]), pa.array([count], pa.int64())], names=["file", "n_records"])

    order = ["page_id", "url", "payload_bytes", "payload_digest", "refers_to", "chunk", "chunks", "data"]
    manifest = chunks.select(*order).mapInArrow(run, "file string, n_records bigint")
    manifest.write.mode("overwrite").parquet(f"{folder}/manifest")
    return chunks.sparkSession.read.schema("file string, n_records bigint").parquet(f"{folder}/manifest")


def _chain(first, rest):
    yield first
    yield from rest


def read_records(stream: BinaryIO, size: int = CHUNK) -> Iterator[tuple[dict[str, str], Iterator[bytes]]]:
    """Header fields and payload chunks of each record; a record's chunks must be used up before the next."""
    data = io.BufferedReader(gzip.GzipFile(fileobj=stream), 1 << 16)
    while line := data.readline():
        if line != VERSION:
            raise ValueError(f"no record starts with {line[:40]!r}")
        fields = _fields(data)
        left = int(fields["content-length"])
        if fields["warc-type"] == "response":
            before = data.readline()
            left -= len(before)
            while before.strip():
                before = data.readline()
                left -= len(before)
        yield fields, _payload(data, left, size)
        if data.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {fields['warc-record-id']} is longer than it says")


def _fields(data: BinaryIO) -> dict[str, str]:
    fields = {}
    while line := data.readline().strip():
        name, _, value = line.partition(b":")
        fields[name.decode().lower()] = value.strip().decode()
    return fields


def _payload(data: BinaryIO, left: int, size: int) -> Iterator[bytes]:
    while left:
        part = data.read(min(size, left))
        if not part:
            raise ValueError("archive ends inside a record")
        left -= len(part)
        yield part


def read_archives(manifest: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every record.

    Length and digest of a response come from its payload as read; one that differs from its header
    is an error. Archives are read one per task.
    """

    def number(urn: str | None) -> int | None:
        text = (urn or "<urn:page:None>").removeprefix("<urn:page:").removesuffix(">")
        return None if text == "None" else int(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name in (x for b in batches for x in b["file"].to_pylist()):
            rows: list[tuple] = []
            fs, path = file_system(name)
            with fs.open_input_file(path) as stream:
                for fields, chunks in read_records(stream):
                    n_bytes, digest = 0, hashlib.sha256()
                    for part in chunks:
                        digest.update(part)
                        n_bytes += len(part)
                    said = fields["warc-payload-digest"].removeprefix("sha256:")
                    if fields["warc-type"] == "revisit":
                        n_bytes = int(fields["warc-payload-length"])
                    elif said != digest.hexdigest():
                        raise ValueError(f"{fields['warc-record-id']} differs from its digest")
                    refers_to = number(fields.get("warc-refers-to"))
                    rows.append((number(fields["warc-record-id"]), n_bytes, said, fields["warc-type"], refers_to))
                    if len(rows) == 5000:
                        yield batch_of(rows)
                        rows = []
            yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 5
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    schema = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    files = max(1, manifest.count())
    return manifest.select("file").repartition(files).mapInArrow(run, schema)


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Write the pages to archives in a fresh shared folder and read them back."""
    folder = scratch_dir(pages.sparkSession, "warc")
    return read_archives(write_archives(chunk_table(records(pages)), folder))
