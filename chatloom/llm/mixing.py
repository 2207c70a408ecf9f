"""Scoring texts by online logistic mixing of hashed-context bit predictors.

A text is its words, A-Z in lower case, with one blank between two and an end mark. Each byte is a path of
bits in a code tree that depends on the byte before, short for frequent bytes. For each bit, tables of
hashed contexts (the last 2, 3 and 4 bytes, and all of the word so far) give predictions from counts over the training texts; they
are mixed in the logistic domain with weights gated by the depth in the tree, and refined by an adaptive
map from the mixed prediction to what it was worth. Weights and map go on learning along each text, so a
text's score depends on nothing but the model and the text. Minus log2 of the probability over the
number of bytes is the text's bits per byte.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import crc_mod
from chatloom.llm.words import FACTOR, mix, pieces, word_hashes, word_prefixes
from chatloom.session import scratch_dir

ORDERS = (2, 3, 4)  # and last the bytes since the last blank
TABLE_BITS = (18, 20, 20, 22)
SLICE = 1 << 16
GATES, BUCKETS = 24, 33
END = 10  # no text has a line feed once its blanks are single
BLOCK = 1 << 14
RATE, LEARN = 0.02, 1 << 10
LANES, TOGETHER = 16, 1 << 16  # texts scored side by side; bytes looked up at once, and up to a block more
UNITS = 1 << 20
PARTS = 1 << 10  # units of all tasks meet by a part of their hashes
SIDE = np.uint64(40)  # the bit of a tail that says on which side of the corpus its text is
ROUNDS, RIDGE = 3, 1.0
# The adaptive map before it has seen anything: 24 bits a cell that were worth what the mixer said.
PRIOR = 24 * np.tile(1 / (1 + np.exp(12 - np.arange(BUCKETS) * (24 / (BUCKETS - 1)))), GATES)


@dataclass
class CodeTrees:
    """Huffman codes, one for each byte before: length and place of each byte's path of nodes and bits."""

    length: np.ndarray
    place: np.ndarray
    node: np.ndarray
    bit: np.ndarray
    gate: np.ndarray

    def paths(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of bytes, each as 256 times the byte before plus itself: where each one's steps end, whose each step is, and
        the places of all steps, in order."""
        return _runs(self.place.ravel()[pairs], self.length.ravel()[pairs])


def _runs(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of places one after the other: where each ends in the result, whose each place is, and all places."""
    ends = np.cumsum(lengths)
    whose = np.repeat(np.arange(len(lengths)), lengths)
    places = (starts - (ends - lengths))[whose]
    places += np.arange(len(places))
    return ends, whose, places


def code_trees(counts: np.ndarray) -> CodeTrees:
    """Codes from counts[before, byte]; every byte counts as seen at least once in 64."""
    length, place = np.zeros((256, 256), np.int64), np.zeros((256, 256), np.int64)
    nodes, bits, gates = [], [], []
    for before in range(256):
        heap = [(float(counts[before, s]) + 1 / 64, s, s) for s in range(256)]
        heapq.heapify(heap)
        parent, serial = {}, 256
        while len(heap) > 1:
            (wa, _, a), (wb, _, b) = heapq.heappop(heap), heapq.heappop(heap)
            parent[a], parent[b] = (serial, 0), (serial, 1)
            heapq.heappush(heap, (wa + wb, serial, serial))
            serial += 1
        for s in range(256):
            path, at = [], s
            while at in parent:
                at, bit = parent[at]
                path.append((at, bit))
            place[before, s], length[before, s] = len(nodes), len(path)
            for depth, (at, bit) in enumerate(reversed(path)):
                nodes.append(before * 512 + at)
                bits.append(bit)
                gates.append(min(depth, GATES - 1))
    return CodeTrees(length, place, np.array(nodes, np.uint32), np.array(bits, np.uint8), np.array(gates, np.int8))


def stream_of(text: str) -> Iterator[np.ndarray]:
    """The text's bytes in blocks, each with the five bytes before it (zeros at the start)."""
    before = np.zeros(5, np.uint8)
    rest = b""
    parts = [p.split() for p in pieces(text.encode().lower())]
    for number, words in enumerate(parts):
        rest += b" ".join(words) + (b" " if words else b"")
        final = number == len(parts) - 1
        if final:
            rest = rest[:-1] + b"\n" if rest else b"\n"
        keep = 0 if final else 1  # the last blank may have to become the end
        while len(rest) > keep + (0 if final else BLOCK):
            data = np.frombuffer(rest[:BLOCK], np.uint8)
            rest = rest[BLOCK:]
            yield np.concatenate([before, data])
            before = np.concatenate([before, data])[-5:]


def contexts(blocks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every byte of some blocks its tail (itself in the lowest eight bits, above it the four before) and a hash of
    its word so far; and where each block's bytes end. Small blocks are taken together, as calls cost more than bytes."""
    codes = np.concatenate(blocks)
    stops = np.cumsum([len(block) for block in blocks])
    starts = stops - [len(block) for block in blocks]
    own = np.ones(len(codes), bool)
    own[starts[:, None] + np.arange(5)] = False
    wide = codes.astype(np.uint64)
    tail = wide[5:].copy()
    for k in range(1, max(ORDERS) + 1):
        tail |= wide[5 - k : len(wide) - k] << np.uint64(8 * k)
    prefix = (word_prefixes(codes, starts)[own] >> np.uint64(32)).astype(np.uint32)
    return tail[own[5:]], prefix, stops - 5 * np.arange(1, len(blocks) + 1)


def slots(trees: CodeTrees, tail: np.ndarray, prefix: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """For every step of some bytes its place in each table, its bit and its gate; and where each byte's steps end."""
    ends, whose, steps = trees.paths((tail & np.uint64(0xFFFF)).astype(np.intp))
    node = trees.node[steps] * np.uint32(0x9E3779B1)
    context, out = np.zeros(len(tail), np.uint32), []

    def places(context: np.ndarray, bits: int) -> np.ndarray:
        mixed = context[whose]
        mixed ^= node
        mixed *= np.uint32(0x85EBCA6B)
        mixed ^= mixed >> np.uint32(13)
        mixed *= np.uint32(0xC2B2AE35)
        mixed >>= np.uint32(32 - bits)
        return mixed

    for k in range(1, max(ORDERS) + 1):
        byte = (tail >> np.uint64(8 * k)).astype(np.uint8)
        context = (context + byte + np.uint32(1)) * np.uint32(0x2C1B3C6D)
        context ^= context >> np.uint32(15)
        if k in ORDERS:
            out.append(places(context, TABLE_BITS[ORDERS.index(k)]))
    out.append(places(prefix, TABLE_BITS[-1]))
    return out, trees.bit[steps], trees.gate[steps], ends


class Units:
    """Numbers for bytes with equal tail and word so far, from 1, equal ones told by 64-bit hashes.

    Most bytes of a text stand where the same byte has stood before, so what they need is worked out once a
    unit. The number of units is bounded; what does not fit goes to a new object.
    """

    def __init__(self):
        self.keys = np.zeros(UNITS, np.uint64)
        self.tails = np.zeros(UNITS, np.uint64)
        self.prefixes = np.zeros(UNITS, np.uint32)
        self.heads = np.zeros(8 * UNITS, np.int32)  # the latest unit of a part of the hashes
        self.size = 1

    def numbers(self, tail: np.ndarray, prefix: np.ndarray) -> np.ndarray | None:
        """The number of each byte's unit; None if the new ones do not fit."""
        key = mix(tail * np.uint64(FACTOR) + prefix) | np.uint64(1)
        home = (key >> np.uint64(65 - len(self.heads).bit_length())).astype(np.intp)
        found = self.heads[home]
        new = np.flatnonzero(self.keys[found] != key)
        if len(new):
            fresh, first, which = np.unique(key[new], return_index=True, return_inverse=True)
            if self.size + len(fresh) > UNITS:
                return None
            part = slice(self.size, self.size + len(fresh))
            self.keys[part], self.tails[part], self.prefixes[part] = fresh, tail[new[first]], prefix[new[first]]
            found[new] = self.heads[home[new]] = self.size + which
            self.size = part.stop
        return found


class UnitCounts:
    """How often each unit was met. What no longer fits is handed on, as tails, prefixes and times."""

    def __init__(self):
        self.units, self.times = Units(), np.zeros(UNITS, np.uint32)
        self.waiting: list[np.ndarray] = []
        self.sides: list[int] = []
        self.size = 0

    def add(self, block: np.ndarray, side: int = 0) -> Iterator[tuple[np.ndarray, ...]]:
        self.waiting.append(block)
        self.sides.append(side)
        self.size += len(block)
        return self._count() if self.size > TOGETHER else iter(())

    def finish(self) -> Iterator[tuple[np.ndarray, ...]]:
        yield from self._count()
        yield from self._hand_on()

    def _count(self) -> Iterator[tuple[np.ndarray, ...]]:
        if not self.waiting:
            return
        tail, prefix, stops = contexts(self.waiting)
        tail |= np.repeat(np.array(self.sides, np.uint64) << SIDE, np.diff(stops, prepend=0))
        self.waiting, self.sides, self.size = [], [], 0
        numbers = self.units.numbers(tail, prefix)
        if numbers is None:
            yield from self._hand_on()
            numbers = self.units.numbers(tail, prefix)
        np.add.at(self.times, numbers, np.uint32(1))

    def _hand_on(self) -> Iterator[tuple[np.ndarray, ...]]:
        """What there is, then start anew."""
        units, part = self.units, slice(1, self.units.size)
        if units.size > 1:
            yield units.tails[part], units.prefixes[part], self.times[part]
        self.units, self.times = Units(), np.zeros(UNITS, np.uint32)


class BitCounts:
    """How often each place of the tables was met with a bit of 0, and with 1 (places times two, plus the bit).

    Bytes are counted by unit; a unit's steps are worked out when the units are full, and at the end.
    """

    def __init__(self, trees: CodeTrees):
        self.trees = trees
        self.tables = [np.zeros(2 << b, np.uint32) for b in TABLE_BITS]
        self.seen: UnitCounts | None = None

    def add(self, block: np.ndarray) -> None:
        self.seen = self.seen or UnitCounts()
        for units in self.seen.add(block):
            self.add_units(*units)

    def add_units(self, tails: np.ndarray, prefixes: np.ndarray, times: np.ndarray) -> None:
        """Count each unit's steps as often as the unit was met."""
        for part in _chunks(len(tails)):
            places, bit, _, ends = slots(self.trees, tails[part], prefixes[part])
            often = np.repeat(times[part], np.diff(ends, prepend=0))
            for table, p in zip(self.tables, places):
                np.add.at(table, (p * np.uint32(2) + bit).astype(np.intp), often)

    def finish(self) -> list[np.ndarray]:
        for units in self.seen.finish() if self.seen else ():
            self.add_units(*units)
        return self.tables


def _chunks(n: int, size: int = 1 << 15) -> Iterator[slice]:
    return (slice(at, min(at + size, n)) for at in range(0, n, size))


@dataclass
class MixState:
    """What goes on learning along a text, short ones too. Texts that are scored side by side have theirs in a row."""

    weights: np.ndarray = field(default_factory=lambda: np.full((GATES, len(TABLE_BITS)), 0.3, np.float32))
    hits: np.ndarray = field(default_factory=lambda: np.full(GATES * BUCKETS, 0.0))
    seen: np.ndarray = field(default_factory=lambda: np.full(GATES * BUCKETS, 0.0))

    def times(self, n: int) -> MixState:
        """This state for each of some texts."""
        return MixState(np.tile(self.weights, (n, 1)), np.tile(self.hits, n), np.tile(self.seen, n))

    def put(self, lane: int, one: MixState) -> None:
        """Let a lane's text start from a state."""
        for mine, its in zip(self._parts(), one._parts()):
            mine[lane * len(its) : (lane + 1) * len(its)] = its

    def without(self, lane: int) -> MixState:
        lanes = len(self.weights) // GATES
        cut = (np.delete(a.reshape(lanes, -1), lane, 0).reshape(-1, *a.shape[1:]) for a in self._parts())
        return MixState(*cut)

    def _parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.weights, self.hits, self.seen


@dataclass
class Lane:
    """A text on its way: the blocks to come, and the steps of the present one."""

    number: int
    blocks: Iterator[np.ndarray]
    inputs: np.ndarray
    bit: np.ndarray
    gate: np.ndarray
    at: int = 0


@dataclass
class Mixer:
    """Code trees, one table of stretched predictions per order, and the state each text starts from."""

    trees: CodeTrees
    tables: list[np.ndarray]
    start: MixState

    def log_probability(self, text: str, state: MixState | None = None, rate: float = RATE) -> tuple[float, int]:
        """log10 probability of a text and its bytes; ``state`` learns along, once every LEARN bits."""
        state = state or self.start.times(1)
        total, size = 0.0, 0
        for block in stream_of(text):
            size += len(block) - 5
            total += self._block(block, state, rate)
        return total / math.log(10), size

    def log_probabilities(self, texts: Iterable[str], rate: float = RATE) -> list[tuple[float, int]]:
        """What ``log_probability`` gives for each text, LANES of them side by side, each with a state of its own."""
        totals: list[float] = []
        sizes: list[int] = []
        waiting = self._waiting(texts, totals, sizes)
        lanes = list(itertools.islice(waiting, LANES))
        state = self.start.times(len(lanes))
        while lanes:
            parts = [slice(lane.at, lane.at + LEARN) for lane in lanes]
            inputs = np.concatenate([lane.inputs[:, part] for lane, part in zip(lanes, parts)], axis=1)
            bit = np.concatenate([lane.bit[part] for lane, part in zip(lanes, parts)])
            gate = np.concatenate([lane.gate[part] + i * GATES for i, (lane, part) in enumerate(zip(lanes, parts))])
            lengths = [len(lane.bit[part]) for lane, part in zip(lanes, parts)]
            losses = self._step(inputs, bit, gate, lengths, state, rate)
            for i in reversed(range(len(lanes))):
                lane = lanes[i]
                totals[lane.number] += float(losses[i])
                lane.at += LEARN
                if lane.at < len(lane.bit):
                    continue
                block = next(lane.blocks, None)
                if block is not None:
                    sizes[lane.number] += len(block) - 5
                    lanes[i] = Lane(lane.number, lane.blocks, *next(self._steps([block])))
                elif (text := next(waiting, None)) is not None:
                    lanes[i] = text
                    state.put(i, self.start)
                else:
                    del lanes[i]
                    state = state.without(i)
        return [(total / math.log(10), size) for total, size in zip(totals, sizes)]

    def _waiting(self, texts: Iterable[str], totals: list[float], sizes: list[int]) -> Iterator[Lane]:
        """The texts with the steps of their first blocks, looked up for several texts at once."""
        texts = iter(texts)
        while True:
            streams, firsts, held = [], [], 0
            while held < TOGETHER and (text := next(texts, None)) is not None:
                streams.append(stream_of(text))
                firsts.append(next(streams[-1]))
                held += len(firsts[-1])
            if not firsts:
                return
            for blocks, first, steps in zip(streams, firsts, self._steps(firsts)):
                totals.append(0.0)
                sizes.append(len(first) - 5)
                yield Lane(len(totals) - 1, blocks, *steps)

    def _steps(self, blocks: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each block the tables' predictions for its steps, the steps' bits and their gates."""
        tail, prefix, stops = contexts(blocks)
        places, bit, gate, ends = slots(self.trees, tail, prefix)
        inputs = np.empty((len(places), len(bit)), np.float32)
        for values, table, place in zip(inputs, self.tables, places):
            table.take(place.astype(np.intp), out=values, mode="clip")  # none is out of range; "raise" would copy once more
        at = 0
        for end in ends[stops - 1]:
            yield inputs[:, at:end], bit[at:end], gate[at:end].astype(np.intp)
            at = end

    def _block(self, block: np.ndarray, state: MixState, rate: float) -> float:
        inputs, bit, gate = next(self._steps([block]))
        parts = (slice(at, at + LEARN) for at in range(0, len(bit), LEARN))
        return sum(float(self._step(inputs[:, p], bit[p], gate[p], [len(bit[p])], state, rate)[0]) for p in parts)

    def _step(
        self, inputs: np.ndarray, bit: np.ndarray, gate: np.ndarray, lengths: list[int], state: MixState, rate: float
    ) -> np.ndarray:
        """Predict some bits of each lane from what it learned before them, then learn from them; the lanes' losses."""
        weights = state.weights.take(gate, axis=0)
        x = inputs[0] * weights[:, 0]
        for k in range(1, len(inputs)):
            x += inputs[k] * weights[:, k]
        np.clip(x, -12, 12, out=x)
        mixed = 1 / (1 + np.exp(-x))
        cell = gate * BUCKETS + ((x + 12) * np.float32((BUCKETS - 1) / 24) + np.float32(0.5)).astype(np.int32)
        worth = ((state.hits.reshape(-1, len(PRIOR)) + PRIOR) / (state.seen.reshape(-1, len(PRIOR)) + 24)).astype(np.float32)
        p = np.clip((mixed + worth.ravel()[cell]) / 2, 1e-6, 1 - 1e-6)
        loss = np.log(np.abs((1 - bit) - p)).astype(np.float64)  # of p where the bit is set, else of 1 - p
        uses = np.bincount(gate, minlength=len(state.weights))
        share = np.repeat(rate * np.minimum(1.0, np.array(lengths) / 500), GATES) / np.maximum(1, uses)
        error = bit - mixed
        for k, values in enumerate(inputs):
            state.weights[:, k] += (np.bincount(gate, error * values, minlength=len(share)) * share).astype(np.float32)
        state.hits += np.bincount(cell, bit, minlength=len(state.hits))
        state.seen += np.bincount(cell, minlength=len(state.seen))
        return np.add.reduceat(loss, np.cumsum([0, *lengths[:-1]]))


class Lessons:
    """What a mixer's weights make of units that its tables have not counted: for each gate the loss, how it changes with
    the weights (slope and bend), and for each cell of the map the bits met and those that were set."""

    SHAPES = ((GATES,), (GATES, len(TABLE_BITS)), (GATES, len(TABLE_BITS), len(TABLE_BITS)), (GATES, BUCKETS), (GATES, BUCKETS))

    def __init__(self, sums: np.ndarray | None = None):
        sizes = [math.prod(shape) for shape in self.SHAPES]
        self.sums = np.zeros(sum(sizes)) if sums is None else sums
        parts = np.split(self.sums, np.cumsum(sizes)[:-1])
        self.loss, self.slope, self.bend, self.hits, self.seen = (p.reshape(s) for p, s in zip(parts, self.SHAPES))

    def add(self, trees: CodeTrees, tables: list[np.ndarray], weights: np.ndarray, units: tuple[np.ndarray, ...]) -> None:
        tails, prefixes, times = units
        for part in _chunks(len(tails)):
            places, bit, gate, ends = slots(trees, tails[part], prefixes[part])
            often = np.repeat(times[part].astype(np.float64), np.diff(ends, prepend=0))
            gate = gate.astype(np.intp)
            inputs = [table.take(p.astype(np.intp), mode="clip") for table, p in zip(tables, places)]
            own = weights.take(gate, axis=0)
            x = np.clip(sum(values * own[:, k] for k, values in enumerate(inputs)), -12, 12)
            mixed = 1 / (1 + np.exp(-x))
            self.loss -= np.bincount(gate, often * np.log(np.abs((1 - bit) - mixed)), GATES)
            error, spread = often * (bit - mixed), often * (mixed * (1 - mixed))
            for k, values in enumerate(inputs):
                self.slope[:, k] += np.bincount(gate, error * values, GATES)
                bent = spread * values
                for j in range(k + 1):
                    self.bend[:, k, j] += np.bincount(gate, bent * inputs[j], GATES)
            cell = gate * BUCKETS + ((x + 12) * np.float32((BUCKETS - 1) / 24) + np.float32(0.5)).astype(np.int32)
            self.hits += np.bincount(cell, often * bit, GATES * BUCKETS).reshape(GATES, BUCKETS)
            self.seen += np.bincount(cell, often, GATES * BUCKETS).reshape(GATES, BUCKETS)


def learned_start(lessons: Callable[[np.ndarray], Lessons]) -> MixState:
    """Where texts start: weights by Newton's steps from 0.3 for all tables, of each gate the best that was met, and the
    map that belongs to them. ``lessons`` gives what some weights make of all training texts."""
    weights = np.full((GATES, len(TABLE_BITS)), 0.3)
    best, got = weights.copy(), Lessons()
    got.loss += np.inf
    for _ in range(ROUNDS):
        now = lessons(weights.astype(np.float32))
        now.loss += RIDGE / 2 * ((weights - 0.3) ** 2).sum(1)
        better = now.loss < got.loss
        best[better] = weights[better]
        for mine, its in zip((got.loss, got.slope, got.bend, got.hits, got.seen), (now.loss, now.slope, now.bend, now.hits, now.seen)):
            mine[better] = its[better]
        bend = got.bend + np.tril(got.bend, -1).transpose(0, 2, 1) + RIDGE * np.eye(len(TABLE_BITS))
        step = np.linalg.solve(bend, (got.slope - RIDGE * (best - 0.3))[..., None])[..., 0]
        weights = np.where(better[:, None], best + step, (best + weights) / 2)
    scale = np.minimum(1, 200 / np.maximum(got.seen, 1))  # leave the map open to what a text shows
    return MixState(best.astype(np.float32), (got.hits * scale).ravel(), (got.seen * scale).ravel())


# --- passes -----------------------------------------------------------------------------------------


def _packed(packer: zstandard.ZstdCompressor, tails: np.ndarray, prefixes: np.ndarray, times: np.ndarray) -> bytes:
    """Units in the order of their tails: what each tail adds, prefixes and times; the first and last by byte planes."""
    more = np.diff(tails.astype("<u8"), prepend=np.uint64(0))
    planes = (np.ascontiguousarray(a).view(np.uint8).reshape(len(tails), -1).T.tobytes() for a in (more, times.astype("<u4")))
    return packer.compress(b"".join([prefixes.astype("<u4").tobytes(), *planes]))


def _unpacked(unpacker: zstandard.ZstdDecompressor, blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tails, prefixes and times of packed units."""
    data = np.frombuffer(unpacker.decompress(blob), np.uint8).reshape(16, -1)
    more, times = (np.ascontiguousarray(planes.T).view(kind).ravel() for planes, kind in ((data[4:12], "<u8"), (data[12:], "<u4")))
    return np.cumsum(more), data[:4].ravel().view("<u4"), times


def _unit_pass(rows: DataFrame) -> DataFrame:
    """Unit counts of training rows (text, side), added up per task; rows (key, units). A key is a side and a part of the
    three-byte contexts, so that units with like tails lie together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, packer = UnitCounts(), zstandard.ZstdCompressor(level=1)

        def dealt(tails: np.ndarray, prefixes: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
            part = mix(tails >> np.uint64(16) & np.uint64(0xFFFFFF)) >> np.uint64(65 - PARTS.bit_length())
            part += (tails >> SIDE) * np.uint64(PARTS)
            order = np.argsort(part << np.uint64(48) | tails)
            found, starts = np.unique(part[order], return_index=True)
            blobs = [_packed(packer, tails[o], prefixes[o], times[o]) for o in np.split(order, starts[1:])]
            return pa.record_batch([pa.array(found.astype(np.int32)), pa.array(blobs, pa.binary())], ["key", "units"])

        for batch in batches:
            for side, text in zip(batch["side"].to_pylist(), batch["text"]):
                for block in stream_of(text.as_py()):
                    for full in counts.add(block, side):
                        yield dealt(*full)
        for rest in counts.finish():
            yield dealt(*rest)

    return rows.select("text", "side").mapInArrow(run, "key int, units binary")


def _merged(units: DataFrame) -> DataFrame:
    """Units that several tasks have met, once; rows (side, units). What a task holds of a key is bounded: a key of more
    units than that gives several rows, which may share units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, unpacker = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        key, held, size = None, [], 0

        def once() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            tails, prefixes, times = (np.concatenate(parts) for parts in zip(*held))
            order = np.lexsort((prefixes, tails))
            tails, prefixes = tails[order], prefixes[order]
            first = np.flatnonzero(np.concatenate([[True], (tails[1:] != tails[:-1]) | (prefixes[1:] != prefixes[:-1])]))
            sums = np.add.reduceat(times[order].astype(np.uint64), first)
            return tails[first], prefixes[first], np.minimum(sums, np.uint64(0xFFFFFFFF)).astype(np.uint32)

        def done(units: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            return pa.record_batch([pa.array([key // PARTS], pa.int32()), pa.array([_packed(packer, *units)], pa.binary())], ["side", "units"])

        for batch in batches:
            for k, blob in zip(batch["key"].to_pylist(), batch["units"]):
                if k != key and held:
                    yield done(once())
                    held, size = [], 0
                key = k
                held.append(_unpacked(unpacker, blob.as_py()))
                size += len(held[-1][0])
                if size > 2 * UNITS:
                    held = [once()]
                    size = len(held[0][0])
                    if size > UNITS:
                        yield done(held[0])
                        held, size = [], 0
        if held:
            yield done(once())

    return units.repartition("key").sortWithinPartitions("key").mapInArrow(run, "side int, units binary")


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, tuple[np.ndarray, ...]]]:
    """Side and units (tails, prefixes, times) of each stored row."""
    unpacker = zstandard.ZstdDecompressor()
    for batch in batches:
        for side, blob in zip(batch["side"].to_pylist(), batch["units"]):
            yield side, _unpacked(unpacker, blob.as_py())


def _word_pass(rows: DataFrame) -> DataFrame:
    """Word counts of texts, added up per task before they leave it; rows (h, c)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, chars, words, held = [], 0, [], 0

        def hashed() -> np.ndarray:
            """The words of the waiting texts, hashed in one call."""
            return word_hashes("\n".join(texts))

        def vocabulary() -> pa.RecordBatch:
            keys, times = np.unique(np.concatenate(words), return_counts=True)
            return pa.record_batch([pa.array(keys.view(np.int64)), pa.array(times, pa.int64())], ["h", "c"])

        for batch in batches:
            for scalar in batch["text"]:
                texts.append(scalar.as_py())
                chars += len(texts[-1])
                if chars > TOGETHER:
                    words.append(hashed())
                    held += len(words[-1])
                    texts, chars = [], 0
                if held > 3_000_000:
                    yield vocabulary()
                    words, held = [], 0
        words.append(hashed())
        yield vocabulary()

    return rows.select("text").mapInArrow(run, "h bigint, c bigint")


def _pairs(units: DataFrame) -> np.ndarray:
    """How often each byte follows each other one in the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(1 << 16)
        for _, (tails, _, times) in _each(batches):
            pairs += np.bincount((tails & np.uint64(0xFFFF)).astype(np.intp), times, len(pairs))
        at = np.flatnonzero(pairs)
        yield pa.record_batch([pa.array(at, pa.int32()), pa.array(pairs[at].astype(np.int64))], ["pair", "times"])

    pairs = np.zeros(1 << 16)
    for row in units.mapInArrow(run, "pair int, times bigint").groupBy("pair").agg(F.sum("times").alias("times")).collect():
        pairs[row["pair"]] = row["times"]
    return pairs.reshape(256, 256)


def _count_pass(units: DataFrame, trees: CodeTrees) -> DataFrame:
    """Bit counts of the units of each side, added up per task; rows (side, key, counts)."""
    shared = units.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides: dict[int, BitCounts] = {}
        for side, found in _each(batches):
            sides.setdefault(side, BitCounts(shared.value)).add_units(*found)
        packer = zstandard.ZstdCompressor(level=1)
        for side, counts in sides.items():
            for k, table in enumerate(counts.finish()):
                for at in range(0, len(table), SLICE):
                    if table[at : at + SLICE].any():
                        blob = packer.compress(table[at : at + SLICE].astype("<u4", copy=False).tobytes())
                        arrays = [pa.array([side], pa.int32()), pa.array([k << 16 | at // SLICE], pa.int32()), pa.array([blob], pa.binary())]
                        yield pa.record_batch(arrays, ["side", "key", "counts"])

    return units.mapInArrow(run, "side int, key int, counts binary")


def _start(units: DataFrame, trees: CodeTrees, sides: list[list[np.ndarray]]) -> MixState:
    """Where texts start, learned from all units, those of either side by the tables of the other, which have not counted
    them."""
    packer = zstandard.ZstdCompressor(level=1)
    packed = [[packer.compress(table.astype(np.float16).tobytes()) for table in tables] for tables in sides]
    shared = units.sparkSession.sparkContext.broadcast((trees, packed))

    def lessons(weights: np.ndarray) -> Lessons:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trees, packed = shared.value
            unpacker = zstandard.ZstdDecompressor()
            sides = [[np.frombuffer(unpacker.decompress(t), np.float16).astype(np.float32) for t in tables] for tables in packed]
            total = Lessons()
            for side, found in _each(batches):
                total.add(trees, sides[1 - side], weights, found)
            yield pa.record_batch([pa.array([total.sums], pa.list_(pa.float64()))], ["sums"])

        rows = units.mapInArrow(run, "sums array<double>").collect()
        return Lessons(sum((np.array(r["sums"]) for r in rows), Lessons().sums))

    start = learned_start(lessons)
    shared.destroy()
    return start


def _summed(slices: DataFrame) -> DataFrame:
    """Add up the tasks' counts slice by slice, one blob after the other; rows (side, key, stretched float16), of sides 0
    and 1 and, as side 2, of both together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker, key, total = zstandard.ZstdDecompressor(), None, None

        def done() -> pa.RecordBatch:
            n = np.concatenate([total, total.sum(0, keepdims=True)]).reshape(3, -1, 2)
            stretched = np.log((n[..., 1] + 0.3) / (n[..., 0] + 0.3)).astype(np.float16)
            arrays = [pa.array([0, 1, 2], pa.int32()), pa.array([key] * 3, pa.int32()), pa.array([t.tobytes() for t in stretched], pa.binary())]
            return pa.record_batch(arrays, ["side", "key", "table"])

        for batch in batches:
            for k, side, blob in zip(batch["key"].to_pylist(), batch["side"].to_pylist(), batch["counts"]):
                if k != key:
                    if key is not None:
                        yield done()
                    key, total = k, np.zeros((2, SLICE), np.int64)
                total[side] += np.frombuffer(unpacker.decompress(blob.as_py()), "<u4")
        if key is not None:
            yield done()

    return slices.repartition("key").sortWithinPartitions("key").mapInArrow(run, "side int, key int, table binary")


def _tables(summed: DataFrame) -> list[list[np.ndarray]]:
    """The tables of either side and of both on the driver: their size is fixed, whatever the corpus."""
    tables = [[np.zeros(1 << b, np.float32) for b in TABLE_BITS] for _ in range(3)]
    half = SLICE // 2
    for row in summed.toLocalIterator():
        k, at = row["key"] >> 16, row["key"] & 0xFFFF
        tables[row["side"]][k][at * half : (at + 1) * half] = np.frombuffer(row["table"], np.float16)
    return tables


def _frequent(vocabulary: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, and counts of the words at or above a power of two that at most ``most`` reach."""
    power = F.floor(F.log2("c")).cast("int").alias("power")
    sizes = {r["power"]: r["n"] for r in vocabulary.groupBy(power).agg(F.count(F.lit(1)).alias("n")).collect()}
    least, total = max(sizes, default=0) + 1, 0
    while least > 0 and total + sizes.get(least - 1, 0) <= most:
        least -= 1
        total += sizes.get(least, 0)
    got = vocabulary.filter(F.col("c") >= 2**least).toArrow()
    keys, counts = got["h"].to_numpy(), got["c"].to_numpy()
    order = np.argsort(keys)
    return keys[order], counts[order]


def score_texts(docs: DataFrame, folds: int = 5, held_out: int = 1, most_frequent: int = 400_000) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte.

    Training texts are those whose crc32 of the id modulo ``folds`` is not ``held_out`` (a null id is in
    training). Code trees, bit counts and starting weights come from all of them. Weights are learned from bits that
    the tables have not counted: a hash of the text deals the texts to two sides, and those of either are predicted by
    the counts of the other. Counts of the ``most_frequent`` words are broadcast; those of all others are
    joined. Null texts count as empty: one token, the end. Repeated rows stay, an empty table gives none.
    """
    spark = docs.sparkSession
    held = F.coalesce(crc_mod(F.col("doc_id"), folds) == held_out, F.lit(False)).alias("held_out")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), held)
    training = rows.filter(~F.col("held_out"))
    n_train = training.count()

    path = scratch_dir(spark, "vocabulary")
    _word_pass(training).groupBy("h").agg(F.sum("c").alias("c")).write.parquet(path)
    vocabulary = spark.read.parquet(path)
    path = scratch_dir(spark, "units")
    sided = training.withColumn("side", F.pmod(F.xxhash64("text", F.lit("side")), F.lit(2)).cast("int"))
    _merged(_unit_pass(sided)).write.parquet(path)
    units = spark.read.parquet(path)

    pairs = _pairs(units)
    trees = code_trees(pairs + pairs.sum(0) / max(1, pairs.sum()))
    *sides, tables = _tables(_summed(_count_pass(units, trees)))
    mixer = Mixer(trees, tables, _start(units, trees, sides))

    n_words, n_kinds = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    tokens, kinds = n_words + n_train, n_kinds + (1 if n_train else 0)
    below = tokens + 0.5 * (kinds + 1)
    shared = spark.sparkContext.broadcast((mixer, *_frequent(vocabulary, most_frequent)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, keys, counts = shared.value
        logs = np.log10((counts + 0.5) / below)
        end = math.log10((n_train + 0.5) / below)
        names = ["doc_id", "held_out", "n_tokens", "n_known", "base", "score", "n_bytes", "rare", "times"]
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        for batch in batches:
            out = []
            scores = mixer.log_probabilities(scalar.as_py() for scalar in batch["text"])
            for doc_id, held, scalar, (score, size) in zip(batch["doc_id"].to_pylist(), batch["held_out"].to_pylist(), batch["text"], scores):
                text = scalar.as_py()
                hashes = word_hashes(text).view(np.int64)
                at = np.minimum(np.searchsorted(keys, hashes), max(0, len(keys) - 1))
                known = keys[at] == hashes if len(keys) else np.zeros(len(hashes), bool)
                rare, times = np.unique(hashes[~known], return_counts=True)
                base = float(logs[at[known]].sum()) + end
                out.append((doc_id, held, len(hashes) + 1, int(known.sum()) + (n_train > 0), base, score, size, rare, times))
            columns = list(zip(*out)) or [()] * 9
            yield pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)

    schema = (
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double, n_bytes bigint, "
        "rare array<bigint>, times array<bigint>"
    )
    path = scratch_dir(spark, "scored")
    rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    stored = spark.read.parquet(path)
    rare = stored.select("row", F.inline(F.arrays_zip("rare", "times"))).join(vocabulary.withColumnRenamed("h", "rare"), "rare", "left")
    count = F.coalesce("c", F.lit(0))
    sums = rare.groupBy("row").agg(
        F.sum(F.col("times") * F.log10((count + 0.5) / F.lit(float(below)))).alias("more"),
        F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("known"),
    )
    zero = F.lit(0)
    return stored.drop("rare", "times").join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", zero)).alias("n_known"),
        F.lit(int(tokens)).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        "score",
        (-F.col("score") / math.log10(2) / F.col("n_bytes")).alias("bits_per_byte"),
    )
