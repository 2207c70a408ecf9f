"""Token ids in Arrow IPC files of equal-length sequences, with masks.

A file is a run of record batches with the columns ``ids`` (fixed-size list of 16- or 32-bit ids) and
``mask`` (fixed-size list of booleans, false on the padding of the last sequence). Sequence k of a file
lies at a known place, so a reader maps the file into memory and takes views, without copying or
parsing. A small index table says where each document lies.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm.common import AtomicFile, file_system, id_and_text
from chatloom.llm.encoding import encoder
from chatloom.session import scratch_dir

INDEX = "doc_id bigint, file string, place bigint, n_tokens bigint"


class SequenceWriter:
    """Cuts a stream of ids into sequences and writes them batch by batch."""

    def __init__(self, stream, width: int, wide: bool, per_batch: int = 64):
        self.width, self.per_batch = width, per_batch
        self.dtype = np.dtype("<u4" if wide else "<u2")
        item = pa.uint32() if wide else pa.uint16()
        self.schema = pa.schema([("ids", pa.list_(item, width)), ("mask", pa.list_(pa.bool_(), width))])
        self.file = pa.ipc.new_file(stream, self.schema)
        self.waiting, self.held, self.total = [], 0, 0

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids.astype(self.dtype))
        self.held += len(ids)
        self.total += len(ids)
        block = self.width * self.per_batch
        if self.held >= block:
            flat = np.concatenate(self.waiting)
            whole = len(flat) // block * block
            for at in range(0, whole, block):
                self._write(flat[at : at + block], block)
            self.waiting, self.held = [flat[whole:]], len(flat) - whole

    def _write(self, flat: np.ndarray, real: int) -> None:
        mask = np.arange(len(flat)) < real
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(flat), self.width),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), self.width),
        ]
        self.file.write_batch(pa.record_batch(columns, schema=self.schema))

    def close(self) -> None:
        if self.held:
            flat = np.concatenate(self.waiting)
            self._write(np.pad(flat, (0, -len(flat) % self.width)), len(flat))
        self.file.close()


class SequenceReader:
    """Random access to the ids of a file; views on the mapped file where they lie in one batch."""

    def __init__(self, uri: str):
        fs, path = file_system(uri)
        self.file = pa.ipc.open_file(fs.open_input_file(path))
        self.width = self.file.schema.field("ids").type.list_size
        self.block = self.file.get_batch(0).num_rows * self.width if self.file.num_record_batches else 1

    def batch(self, number: int, column: str = "ids") -> np.ndarray:
        values = self.file.get_batch(number).column(column).flatten()
        return values.to_numpy(zero_copy_only=column == "ids")

    def sequence(self, number: int, column: str = "ids") -> np.ndarray:
        block, row = divmod(number * self.width, self.block)
        return self.batch(block, column)[row : row + self.width]

    def parts(self, place: int, length: int) -> Iterator[np.ndarray]:
        """The ids from ``place`` on, batch by batch."""
        while length:
            number, at = divmod(place, self.block)
            part = self.batch(number)[at : at + length]
            yield part
            place, length = place + len(part), length - len(part)


def write_sequences(
    docs: DataFrame, path: str, folder: str, width: int = 2048, end_id: int = 0,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Write all documents in ascending id order under ``folder``; returns the stored index.

    The files are ranges of ids, so texts are shuffled once and each task writes its file as it
    encodes. Every document ends with ``end_id``; null and empty texts are just that; null ids come
    first; rows of equal id lie in the order of their texts. Empty ranges leave no file. A task
    writes under its own name and renames at the end, so it may run again anywhere.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, tokens = TaskContext.get(), encoder(path)
        name = f"{folder}/range-{context.partitionId():06d}.arrow"
        wide = tokens.library.get_vocab_size() > 1 << 16 or end_id >= 1 << 16
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        end = end_id.to_bytes(4, "little")
        with AtomicFile(name, context.taskAttemptId()) as stream:
            writer = SequenceWriter(stream, width, wide)
            for batch in _chain(first, batches):
                places, counts = [], []
                for text in batch["text"]:
                    ids = np.frombuffer(tokens.ids(text.as_py()) + end, "<u4")
                    places.append(writer.total)
                    counts.append(len(ids))
                    writer.add(ids)
                yield pa.record_batch(
                    [batch["doc_id"], pa.array([name] * len(counts), pa.string()),
                     pa.array(places, pa.int64()), pa.array(counts, pa.int64())],
                    names=["doc_id", "file", "place", "n_tokens"],
                )
            writer.close()

    rows = id_and_text(docs, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(run, INDEX).write.mode("overwrite").parquet(f"{folder}/index")
    return docs.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


def _chain(first, rest):
    yield first
    yield from rest


def read_documents(index: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files.

    ``start`` counts the ids of all documents before: files hold ascending ranges, so their totals,
    one row per file, are summed up and added to the place inside the file.
    """
    totals = index.groupBy("file").agg(F.sum("n_tokens").alias("ids"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, opened = None, None
        for batch in batches:
            sums = []
            columns = (batch[c].to_pylist() for c in ("file", "place", "n_tokens"))
            for name, place, n_tokens in zip(*columns):
                if name != opened:
                    reader, opened = SequenceReader(name), name
                crc = 0
                for part in reader.parts(place, n_tokens):
                    crc = zlib.crc32(part.astype("<u4"), crc)
                sums.append(crc)
            start = pa.compute.add(batch["base"], batch["place"])
            yield pa.record_batch(
                [batch["doc_id"], start, batch["n_tokens"], pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    placed = index.join(bases, "file").sortWithinPartitions("file", "place")
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return placed.select("doc_id", "file", "place", "n_tokens", "base").mapInArrow(run, schema)


def store_and_read(docs: DataFrame, path: str, width: int = 2048) -> DataFrame:
    """Write the documents to a fresh shared folder and read them back."""
    folder = scratch_dir(docs.sparkSession, "sequences")
    return read_documents(write_sequences(docs, path, folder, width))
