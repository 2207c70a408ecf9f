"""Packing token pieces into sequences: best fit first, then local search by swaps and moves.

Squared fill rewards bins that are nearly full and bins that are nearly empty over two half-full ones.
Each step of the search raises the sum of squared fills: a piece moves into a bin that has room, one
piece changes places with a smaller one, or two pieces change places with a smaller one. Bins that
come out empty are dropped.
"""

from __future__ import annotations

import bisect
import math
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import id_and_text
from chatloom.llm.encoding import encoder
from chatloom.session import scratch_dir

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indices into ``lengths``: longest first, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    rooms: list[int] = []  # sorted, with the bin of each room beside it
    owner: list[int] = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        k = bisect.bisect_left(rooms, lengths[i])
        if k == len(rooms):
            b, room = len(bins), capacity
            bins.append([])
        else:
            b, room = owner.pop(k), rooms.pop(k)
        bins[b].append(i)
        if left := room - lengths[i]:
            k = bisect.bisect_left(rooms, left)
            rooms.insert(k, left)
            owner.insert(k, b)
    return bins


def improve(bins: list[list[int]], lengths: list[int], capacity: int, donors: int = 20) -> list[list[int]]:
    """Local search over the underfull bins, while they could do with one bin less.

    The emptiest bins are the donors, one after the other. For each other bin, fullest first, the step
    that fills it most is made: move one piece, swap one for one, or swap two of the donor for one.
    Every step takes weight from the emptier to the fuller bin and so raises the sum of squares; the
    search ends when none of the first ``donors`` bins has a step left.
    """
    fill = [sum(lengths[i] for i in b) for b in bins]
    underfull = [k for k in range(len(bins)) if fill[k] < capacity]
    tried = 0
    while tried < donors:
        underfull = sorted((k for k in underfull if 0 < fill[k] < capacity), key=fill.__getitem__)
        spare = capacity * len(underfull) - sum(fill[k] for k in underfull)
        if spare < capacity or tried >= len(underfull) - 1:
            break
        donor, changed = underfull[tried], False
        for taker in reversed(underfull[tried + 1 :]):
            while step := _best_step(bins[donor], bins[taker], lengths, capacity - fill[taker]):
                out, back = step
                gain = sum(lengths[i] for i in out) - sum(lengths[i] for i in back)
                bins[donor] = [i for i in bins[donor] if i not in out] + back
                bins[taker] = [i for i in bins[taker] if i not in back] + out
                fill[donor] -= gain
                fill[taker] += gain
                changed = True
        tried = 0 if changed else tried + 1
    return [b for b in bins if b]


def _best_step(donor: list[int], taker: list[int], lengths: list[int], room: int) -> tuple[list, list] | None:
    """The step that moves most weight, at most ``room``, from donor to taker."""
    if not room:
        return None
    best, step = 0, None
    for n, i in enumerate(donor):
        if best < lengths[i] <= room:
            best, step = lengths[i], ([i], [])
        for j in taker:
            if best < lengths[i] - lengths[j] <= room:
                best, step = lengths[i] - lengths[j], ([i], [j])
        for k in donor[n + 1 :]:
            pair = lengths[i] + lengths[k]
            for j in taker:
                if best < pair - lengths[j] <= room:
                    best, step = pair - lengths[j], ([i, k], [j])
    return step


def cut_documents(
    docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The pieces of every document: its ids and ``end_id``, cut only where longer than ``capacity``.

    Null and empty texts are one piece with just ``end_id``. Ids stay in the task; only lengths and
    checksums (of little-endian 32-bit ids) leave it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end, width = encoder(path), end_id.to_bytes(4, "little"), 4 * capacity
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                ids = tokens.ids(text.as_py()) + end
                for piece, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.record_batch(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(run, PIECES)


def pack(pieces: DataFrame, capacity: int = 2048, group_size: int = 20_000) -> DataFrame:
    """Add sequence_id and offset to pieces (any table with a ``length`` of 1 to ``capacity``).

    Full pieces are sequences of their own. The others are dealt at random, by a hash of the whole
    row, over groups of about ``group_size``, and each group is packed by itself: the loss is at most
    a part of one sequence per group, and no task ever holds more than a group. Equal rows spread by
    their place in the input. An empty table gives an empty one.
    """
    spark = pieces.sparkSession
    path = scratch_dir(spark, "pieces")
    pieces.withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    stored = spark.read.parquet(path)
    partial = stored.filter(F.col("length") < capacity)
    groups = max(1, math.ceil(partial.count() / group_size))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "_row"]).reset_index(drop=True)
        lengths = pdf["length"].tolist()
        sequence, offset = [0] * len(pdf), [0] * len(pdf)
        base = int(pdf["_group"].iloc[0]) * 2 * group_size * 4
        for number, members in enumerate(improve(best_fit(lengths, capacity), lengths, capacity)):
            at = 0
            for i in members:
                sequence[i], offset[i] = base + number, at
                at += lengths[i]
        return pdf.drop(columns=["_row", "_group"]).assign(sequence_id=sequence, offset=offset)

    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in pieces.schema)}, sequence_id bigint, offset bigint"
    grouped = partial.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)))
    packed = grouped.groupBy("_group").applyInPandas(solve, schema)
    full = stored.filter(F.col("length") == capacity).select(
        *pieces.columns, (-1 - F.col("_row")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    return packed.unionByName(full)


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, group_size: int = 20_000) -> DataFrame:
    """One row per piece with doc_id, piece, start, length, ids_crc32, sequence_id and offset."""
    return pack(cut_documents(docs, path, capacity), capacity, group_size)
