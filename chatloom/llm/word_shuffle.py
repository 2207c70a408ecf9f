"""Byte-level BPE by one global shuffle of distinct words.

Texts are split into pretokens with their positions, block by block: a block of documents lists each of its
pretokens once, the most frequent first, and holds the texts as places in that list. The lists of all blocks
are dealt out by pretoken, so each distinct one is encoded in one task, once; the ids go back to the blocks,
where the texts are put together by position. Decoding is the same with ids in place of pretokens: they
join the token-byte table.

A word met in every block is one entry per block, not one per occurrence, so frequent words make no hot
group. A list travels as one packed row per slice of the hash, and what a task holds is one block, or one
document where that is longer.
"""

from __future__ import annotations

import array
import base64
import heapq
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from typing import Any

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm.common import Memo, pack, pack_numbers, unpack, unpack_numbers
from chatloom.llm.encoding import _BYTE_PIECES, _LATIN, WHITE
from chatloom.session import scratch_dir

# Fixed value: white space as the pattern means it.
_PATTERN = regex.compile(
    public_tokenizers.PATTERN.replace("[^\\s", f"[^{WHITE}").replace("\\s", f"[{WHITE}]").replace("\\S", f"[^{WHITE}]")
)

# Characters of text, or ids, that a block holds unless one document has more; and how many parts its list has.
BLOCK_SIZE, SLICES = 32 << 20, 512
BLOCKS = "block bigint, slice int, items binary, places binary, doc_ids array<bigint>, counts array<int>"
FOUND = "home bigint, places binary, parts binary"


def pretokens(text: str) -> list[str]:
    """The matches of the pattern, in order."""
    return _BYTE_PIECES.findall(text) if _LATIN.fullmatch(text) else _PATTERN.findall(text)


class Block:
    """Documents of one task in a row, their distinct items and the items' numbers in the order of the texts."""

    def __init__(self):
        self.numbers: dict[str | int, int] = {}
        self.doc_ids, self.texts, self.size = [], [], 0

    def add(self, doc_id: int | None, items: Iterable[str | int], size: int) -> None:
        number = self.numbers.setdefault
        self.texts.append(array.array("I", [number(item, len(self.numbers)) for item in items]))
        self.doc_ids.append(doc_id)
        self.size += size

    def rows(self, block: int, slices: int) -> Iterator[pa.RecordBatch]:
        """One row with the documents, and one with each slice of the list."""
        sequence = np.frombuffer(b"".join(self.texts), np.uint32)
        items = [str(item).encode() for item in self.numbers]
        part = np.fromiter((zlib.crc32(item) % slices for item in items), np.int64, len(items))
        # Items of one count are ordered by slice, so that places in a slice follow each other.
        order = np.lexsort((part, -np.bincount(sequence, minlength=len(items))))
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        counts = list(map(len, self.texts))
        yield self._batch(block, None, None, pack_numbers(place[sequence]), self.doc_ids, counts)
        order = order[np.argsort(part[order], kind="stable")]
        for numbers in np.split(order, np.flatnonzero(np.diff(part[order])) + 1) if len(order) else []:
            listed, steps = pack([items[n] for n in numbers]), np.diff(place[numbers], prepend=np.uint32(0))
            yield self._batch(block, int(part[numbers[0]]), listed, pack_numbers(steps), None, None)

    def _batch(self, *row) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]
        names = [c.split()[0] for c in BLOCKS.split(", ")]
        return pa.record_batch([pa.array([value], kind) for value, kind in zip(row, kinds)], names=names)


def list_blocks(
    rows: DataFrame, split: Callable[[Any], Iterable], block_size: int = BLOCK_SIZE, slices: int = SLICES
) -> DataFrame:
    """Blocks of ``rows`` (doc_id and one column ``value``), stored once.

    ``split`` gives a value's items; a block ends where its values would be longer than ``block_size``.
    A block has one row with its documents (slice null) and one for each slice of its list. Null values
    have no items.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = TaskContext.get().partitionId() << 32, Block()
        for batch in batches:
            for doc_id, scalar in zip(batch["doc_id"].to_pylist(), batch["value"]):
                value = scalar.as_py()
                size = len(value or ()) + 64
                if block.doc_ids and block.size + size > block_size:
                    yield from block.rows(number, slices)
                    number, block = number + 1, Block()
                block.add(doc_id, split(value) if value else (), size)
        if block.doc_ids:
            yield from block.rows(number, slices)

    path = scratch_dir(rows.sparkSession, "blocks")
    rows.select("doc_id", "value").mapInArrow(run, BLOCKS).write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(BLOCKS).parquet(path)


def join_back(stored: DataFrame, found: DataFrame, finish: Callable[[list[bytes]], list[list[bytes]]], columns: list[str]) -> DataFrame:
    """The documents of stored blocks with every item replaced by its part.

    ``found`` has the parts of a block's items, packed, with the steps between their places in its list. ``finish`` makes one list
    of byte strings per column out of a block's parts; a document gets their concatenation in the
    order of its items. A column ``ids`` holds 32-bit numbers and becomes array<int>.
    """
    documents = stored.filter("slice is null").select("block", "places", "doc_ids", "counts")

    def assemble(key: tuple, texts: pa.Table, table: pa.Table) -> pa.Table:
        places = [np.cumsum(unpack_numbers(p.as_py()), dtype=np.int64) for p in table["places"]]
        parts: list[bytes] = [b""] * sum(map(len, places))
        for at, packed in zip(places, table["parts"]):
            for place, part in zip(at.tolist(), unpack(packed.as_py())):
                parts[place] = part
        tables, out = finish(parts), [[] for _ in columns]
        (sequence,), (counts,) = map(unpack_numbers, texts["places"].to_pylist()), texts["counts"].to_pylist()
        ends = np.cumsum(counts)
        for start, end in zip(ends - counts, ends):
            here = sequence[start:end].tolist()
            for column, values in zip(tables, out):
                values.append(b"".join(map(column.__getitem__, here)))
        done = [_number_lists(v) if c == "ids" else pa.array(v, pa.binary()) for c, v in zip(columns, out)]
        return pa.table([texts["doc_ids"].combine_chunks().flatten(), *done], names=["doc_id", *columns])

    schema = "doc_id bigint, " + ", ".join(f"{c} {'array<int>' if c == 'ids' else 'binary'}" for c in columns)
    return documents.groupBy("block").cogroup(found.groupBy("home")).applyInArrow(assemble, schema)


def _number_lists(values: list[bytes]) -> pa.Array:
    """Little-endian 32-bit numbers as lists."""
    ends = np.cumsum([0, *(len(v) // 4 for v in values)], dtype=np.int64)
    flat = pa.array(np.frombuffer(b"".join(values), np.int32))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)


class Ranks:
    """Byte-pair merges by the ranks of a tiktoken file: a token's rank is its id."""

    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}

    def encode(self, word: bytes) -> list[int]:
        """Ids of one pretoken: adjacent parts merge, lowest rank first and leftmost among equals.

        A heap holds the ranks of adjacent pairs; an entry whose parts have changed since is passed over. So a
        word of n bytes costs n log n steps, also one of a megabyte.
        """
        ranks = self.ranks
        if (whole := ranks.get(word)) is not None:
            return [whole]
        n = len(word)
        ends, before = list(range(1, n + 1)), list(range(-1, n - 1))  # a part is word[i:ends[i]]; 0 marks a merged one
        heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            middle = ends[i]
            if not middle or middle >= end or ends[middle] != end:
                continue
            ends[i], ends[middle] = end, 0
            if end < n:
                before[end] = i
                if (rank := ranks.get(word[i : ends[end]])) is not None:
                    heapq.heappush(heap, (rank, i, ends[end]))
            if (j := before[i]) >= 0 and (rank := ranks.get(word[j:end])) is not None:
                heapq.heappush(heap, (rank, j, end))
        return [ranks[word[i:e]] for i, e in enumerate(ends) if e]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


@lru_cache(maxsize=2)
def ranks_of(path: str) -> Ranks:
    """One table of ranks per worker and file."""
    return Ranks(path)


def token_bytes(spark: SparkSession, path: str) -> DataFrame:
    """The token-byte table: id and bytes of every token of the file, as long as the file."""
    rows = pa.table({"id": list(read_ranks(path).values()), "bytes": list(read_ranks(path))})
    return spark.createDataFrame(rows).select(F.col("id").cast("int").alias("id"), "bytes")


def encode_lists(stored: DataFrame, path: str, memo: int = 1_000_000) -> DataFrame:
    """The ids, as little-endian 32-bit numbers, of every item of the stored blocks' lists.

    A slice of the hash goes to one task, so a distinct word is encoded once; only in a slice with more than
    ``memo`` words some may be encoded again, so that the task's memory stays bounded.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = ranks_of(path).encode
        known = Memo(lambda word: array.array("I", encode(word)).tobytes(), memo)
        for batch in batches:
            parts = [pack([known[word] for word in unpack(items)]) for items in batch["items"].to_pylist()]
            yield pa.record_batch([batch["block"], batch["places"], pa.array(parts, pa.binary())], ["home", "places", "parts"])

    lists = stored.filter("slice is not null").select("slice", "block", "items", "places")
    return lists.repartition("slice").mapInArrow(run, FOUND)


def _listed(docs: DataFrame, id_col: str, value: Column) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), value.alias("value"))


def _blocks_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return list_blocks(_listed(docs, id_col, F.col(f"`{text_col}`")), pretokens)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array<int>) of every document.

    Null and empty texts have no ids, null doc_ids and repeated rows stay, other columns are ignored, an
    empty table gives an empty one.
    """
    stored = _blocks_of(docs, id_col, text_col)
    return join_back(stored, encode_lists(stored, path), lambda ids: [ids], ["ids"])


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and ``decoded`` (the bytes) of rows of ids; null and empty lists give no bytes.

    A block's distinct ids, at most as many as there are tokens, join the token-byte table. Ids that it
    lacks are an error, as they stand for nothing.
    """

    def ids_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, items, places in zip(*(batch[c].to_pylist() for c in ("block", "items", "places"))):
                ids = pa.array([int(item) for item in unpack(items)], pa.int32())
                at = pa.array(np.cumsum(unpack_numbers(places), dtype=np.int32))
                yield pa.record_batch([pa.array([block] * len(ids), pa.int64()), at, ids], ["home", "place", "id"])

    def packed(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        steps = pack_numbers(np.diff(table["place"].to_numpy(), prepend=0))
        row = {"home": [key[0].as_py()], "places": [steps], "parts": [pack(table["part"].to_pylist())]}
        return pa.table(row, pa.schema([("home", pa.int64()), ("places", pa.binary()), ("parts", pa.binary())]))

    stored = list_blocks(_listed(encoded, id_col, F.col(f"`{ids_col}`")), list)
    lists = stored.filter("slice is not null").select("block", "items", "places")
    ids = lists.mapInArrow(ids_of, "home bigint, place int, id int")
    known = ids.join(token_bytes(encoded.sparkSession, path), "id", "left")
    part = F.coalesce("bytes", F.raise_error(F.concat(F.lit("no token has the id "), F.col("id").cast("string"))))
    found = known.select("home", "place", part.cast("binary").alias("part")).groupBy("home").applyInArrow(packed, FOUND)
    return join_back(stored, found, lambda parts: [parts], ["decoded"])


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array<int>) and ``decoded``, the bytes that the ids stand for.

    The bytes of a document's ids are those of its words' ids in a row, so a block decodes each entry of
    its list once. The token-byte table is as long as the file that every task has read anyway, so here the
    ids meet it in the task; :func:`decode` joins it as a table.
    """

    def both(ids: list[bytes]) -> list[list[bytes]]:
        bytes_of = ranks_of(path).bytes_of.__getitem__
        return [ids, [b"".join(map(bytes_of, array.array("I", i))) for i in ids]]

    stored = _blocks_of(docs, id_col, text_col)
    return join_back(stored, encode_lists(stored, path), both, ["ids", "decoded"])


def digests(tripped: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the decimal ids and of the decoded bytes, of a round trip."""
    return tripped.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
