"""Near-duplicates by Jaccard similarity of word shingles, exactly, with signature trees.

Documents of equal shingle sets form a class, and classes are joined. A pair that is similar enough has
a shingle in common among the first quarter of both sets (the prefix), in any order of shingles that is
the same for all; shingles that repeat often are put last in that order, so passages shared by many texts
rarely lead to candidates. Classes meet in blocks of one prefix shingle.

1. In each block every class has one pivot; it is paired with the few pivots that it meets in most blocks.
   Verified pairs already connect most groups of copies, with as many pairs as members, not as many as
   pairs of members.
2. In blocks that still hold classes of more than one component, a signature tree is built. A shared
   passage gives many blocks with the same classes; only one of those is taken. The tree's nodes
   hold the OR of the members' bitmaps, the range of set sizes, and whether all belong to one component.
   Two trees (or one with itself) are traversed together; pairs of nodes are dropped if they are of one
   component, if their sizes are too far apart, or if the most that their bitmaps let them have in common
   is too little. Pairs of members then meet by bitmaps in proportion to their sets, in the same task.
   First each block gives only the most similar pairs that would connect its components, fewer than it has
   members; once these are verified on the whole sets, all pairs that are still of different components follow.

So every pair is verified, impossible, or already connected: no link that matters is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm.common import id_and_text
from chatloom.llm.words import shingle_set
from chatloom.session import scratch_dir

SIG_BITS = 512
SIG_WORDS = SIG_BITS // 64
MAP_BITS = 22
MOST_WORDS = 256  # of a bitmap that goes with a class into its blocks


def prefix_size(n: int) -> int:
    """At least three quarters of n shingles are common, so at most a quarter can be missing."""
    return n // 4 + 1


def similar(common, n_a, n_b):
    """100 * intersection >= 75 * union."""
    return 100 * common >= 75 * (n_a + n_b - common)


def signature(shingles: np.ndarray) -> np.ndarray:
    bits = np.zeros(SIG_BITS, np.uint8)
    bits[(shingles >> np.uint64(7)) % np.uint64(SIG_BITS)] = 1
    return np.packbits(bits).view(np.uint64)


def wide_signature(shingles: np.ndarray) -> np.ndarray:
    """A bitmap of at least four bits for each shingle, its length a power of two, at least 512."""
    width = max(SIG_BITS, 1 << (4 * len(shingles) - 1).bit_length())
    bits = np.zeros(width, np.uint8)
    bits[shingles & np.uint64(width - 1)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def folded(wide: np.ndarray, words: int) -> np.ndarray:
    """The same bitmap with fewer words: bits that agree modulo the shorter length fall together."""
    return np.bitwise_or.reduce(wide.reshape(-1, words), axis=0)


def class_of(shingles: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64))


# --- bitmaps: a bounded summary of a set of hashes, broadcast whatever its size -----------------


def bitmap(hashes: DataFrame, column: str) -> np.ndarray:
    """2**22 bits, set where the top bits of a hash lead. A full bitmap costs time, never results."""
    top = F.shiftrightunsigned(F.col(column), 64 - MAP_BITS)
    words = hashes.select(top.alias("_top")).select(
        F.shiftright("_top", 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(_top & 63 as int))").alias("bit")
    )
    out = np.zeros(1 << (MAP_BITS - 6), np.int64)
    for row in words.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect():  # 65,536 rows at most
        out[row["word"]] = row["bits"]
    return out


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    top = hashes.view(np.uint64) >> np.uint64(64 - MAP_BITS)
    word = bits.view(np.uint64)[(top >> np.uint64(6)).astype(np.int64)]
    return (word >> (top & np.uint64(63))) & np.uint64(1) == 1


# --- passes over the texts -----------------------------------------------------------------------


def _pass(docs: DataFrame, schema: str, make: Callable[[Iterator[tuple[int, np.ndarray]]], Iterator[pa.RecordBatch]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sets() -> Iterator[tuple[int, np.ndarray]]:
            for batch in batches:
                for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                    yield doc_id, shingle_set(text.as_py())

        yield from make(sets())

    return docs.mapInArrow(run, schema)


def classes_of(docs: DataFrame, often: int = 2, block: int = 3_000_000) -> DataFrame:
    """doc_id, n, class and signature of every document; besides, rows with the shingles that ``often``
    or more different sets of a block of about ``block`` shingles share (columns repeated, times)."""

    def make(sets):
        docs, held, seen, size = [], [], set(), 0

        def flush():
            ids, ns, classes, sigs = zip(*docs) if docs else ((),) * 4
            everything = np.sort(np.concatenate([np.zeros(0, np.uint64), *held]))
            starts = np.flatnonzero(np.concatenate([[True], everything[1:] != everything[:-1]])[: len(everything)])
            times = np.diff(np.append(starts, len(everything)))
            shingles, hot = everything[starts], times >= often
            extra = [None] * len(ids)
            yield pa.record_batch(
                [pa.array([*ids, None], pa.int64()), pa.array([*ns, None], pa.int64()), pa.array([*classes, None], pa.int64()),
                 pa.array([*sigs, None], pa.binary()),
                 pa.array([*extra, shingles[hot].view(np.int64).tolist()], pa.list_(pa.int64())),
                 pa.array([*extra, times[hot].astype(np.int64).tolist()], pa.list_(pa.int64()))],
                names=["doc_id", "n", "class", "sig", "repeated", "times"],
            )

        for doc_id, shingles in sets:
            name = class_of(shingles) if len(shingles) else None
            docs.append((doc_id, len(shingles), name, signature(shingles).tobytes() if len(shingles) else None))
            if len(shingles) and name not in seen:
                seen.add(name)
                held.append(shingles)
                size += len(shingles)
            if size > block or len(docs) > 100_000:
                yield from flush()
                docs, held, seen, size = [], [], set(), 0
        yield from flush()

    return _pass(docs, "doc_id bigint, n bigint, class bigint, sig binary, repeated array<bigint>, times array<bigint>", make)


def prefixes(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """Rows (shingle, class): each class with the shingles of its prefix, common ones last in order."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def make(sets):
        seen: set[int] = set()
        parts, names, size = [], [], 0
        for _, shingles in sets:
            if not len(shingles) or (name := class_of(shingles)) in seen:
                continue
            if len(seen) > 500_000:
                seen.clear()
            seen.add(name)
            hot = in_bitmap(shared.value, shingles)
            first = np.concatenate([shingles[~hot], shingles[hot]])[: prefix_size(len(shingles))]
            parts.append(first)
            names.append((name, len(first)))
            size += len(first)
            if size > 500_000:
                yield batch_of(parts, names)
                parts, names, size = [], [], 0
        if parts:
            yield batch_of(parts, names)

    def batch_of(parts, names):
        who, counts = np.array([n for n, _ in names], np.int64), [c for _, c in names]
        return pa.record_batch([pa.array(np.concatenate(parts).view(np.int64)), pa.array(np.repeat(who, counts))], ["shingle", "class"])

    return _pass(docs, "shingle bigint, class bigint", make)


def sets_of(docs: DataFrame, wanted: np.ndarray, maps_only: bool = False) -> DataFrame:
    """Rows (class, copy, wide, shingles) of the documents whose id a bitmap names, and of few others.

    Rows of equal class may come more than once; ``copy`` tells them apart once the rows are stored. With ``maps_only``
    there are only (class, wide), the bitmap folded to at most ``MOST_WORDS`` words and without the set's size."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        rows, size = [], 0
        for batch in batches:
            texts = batch["text"].filter(pa.array(in_bitmap(shared.value, batch["key"].to_numpy())))
            for text in texts:
                shingles = shingle_set(text.as_py())
                if not len(shingles) or (name := class_of(shingles)) in seen:
                    continue
                seen.add(name)
                wide = wide_signature(shingles)
                if maps_only:
                    rows.append((name, folded(wide, min(len(wide), MOST_WORDS)).tobytes()))
                else:
                    rows.append((name, np.concatenate([[np.uint64(len(shingles))], wide]).tobytes(), shingles.tobytes()))
                size += len(shingles)
                if size > 1_000_000:
                    yield batch_of(rows)
                    rows, size = [], 0
        if rows:
            yield batch_of(rows)

    def batch_of(rows):
        kinds = (pa.int64(), pa.binary(), pa.binary())
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        return pa.record_batch(columns, ["class", "wide", "shingles"][: len(columns)])

    keyed = docs.select("text", id_key("doc_id").alias("key"))
    if maps_only:
        return keyed.mapInArrow(run, "class bigint, wide binary")
    sets = keyed.mapInArrow(run, "class bigint, wide binary, shingles binary")
    return sets.withColumn("copy", F.monotonically_increasing_id())


def id_key(column: str) -> Column:
    """A hash of an id; null, which is the first id only of classes without any, counts as 0."""
    return F.xxhash64(F.coalesce(column, F.lit(0).cast("bigint")))


# --- signature trees ------------------------------------------------------------------------------


def popcount(words: np.ndarray) -> np.ndarray:
    return np.bitwise_count(words).sum(-1, dtype=np.int64)


class SignatureTree:
    """Levels of nodes over members sorted by component and size; ``fan`` children each, the leaves first."""

    def __init__(self, component: np.ndarray, n: np.ndarray, sig: np.ndarray, fan: int = 16):
        self.order = np.lexsort((n, component))
        component, n, sig = component[self.order], n[self.order], sig[self.order]
        self.component, self.n, self.sig, self.fan = component, n, sig, fan
        self.extra = n - popcount(sig)  # shingles that share a bit with another one
        low, high, extra, first, last = n, n, self.extra, component, component
        self.levels = []
        while True:
            starts = np.arange(0, len(low), fan)
            sig = np.bitwise_or.reduceat(sig, starts, axis=0)
            low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
            extra = np.maximum.reduceat(extra, starts)
            first, last = np.minimum.reduceat(first, starts), np.maximum.reduceat(last, starts)
            self.levels.append((sig, low, high, extra, first, last))
            if len(low) == 1:
                break

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Members, by their place in the input, that may be similar and are not connected yet."""
        todo = [(len(self.levels) - 1, 0, 0)]
        while todo:
            level, a, b = todo.pop()
            if not self._may_meet(level, a, b):
                continue
            children_a = range(a * self.fan, (a + 1) * self.fan)
            children_b = range(b * self.fan, (b + 1) * self.fan)
            if level:
                limit = len(self.levels[level - 1][1])
                todo += [(level - 1, i, j) for i in children_a if i < limit for j in children_b if i <= j < limit]
            else:
                yield from self._leaf(slice(children_a.start, children_a.stop), slice(children_b.start, children_b.stop), a == b)

    def _may_meet(self, level: int, a: int, b: int) -> bool:
        sig, low, high, extra, first, last = self.levels[level]
        if first[a] == last[a] == first[b] == last[b]:
            return False
        if 4 * high[a] < 3 * low[b] or 4 * high[b] < 3 * low[a]:
            return False
        most = int(popcount(sig[a] & sig[b])) + min(extra[a], extra[b])
        return similar(most, low[a], low[b])

    def _leaf(self, a: slice, b: slice, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        n_a, n_b = self.n[a][:, None], self.n[b][None]
        most = popcount(self.sig[a][:, None] & self.sig[b][None]) + np.minimum(self.extra[a][:, None], self.extra[b][None])
        most = np.minimum(most, np.minimum(n_a, n_b))
        fits = similar(most, n_a, n_b) & (self.component[a][:, None] != self.component[b][None])
        if same:
            fits = np.triu(fits, 1)
        i, j = np.nonzero(fits)
        if len(i):
            yield self.order[a][i], self.order[b][j]


def wide_bounds(wide: list[np.ndarray], n: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The most that wide bitmaps let the members of each pair (i, j) have in common."""
    words = np.array([len(w) for w in wide])
    level, most = np.minimum(words[i], words[j]), np.zeros(len(i), np.int64)
    for width in np.unique(level):
        at = np.flatnonzero(level == width)
        who, place = np.unique(np.concatenate([i[at], j[at]]), return_inverse=True)
        maps = np.stack([folded(wide[k], width) for k in who])
        extra = n[who] - popcount(maps)
        x, y = place[: len(at)], place[len(at) :]
        step = max(1, (1 << 20) // width)  # pairs whose bitmaps are met at a time
        for k in range(0, len(at), step):
            part = slice(k, k + step)
            most[at[part]] = popcount(maps[x[part]] & maps[y[part]]) + np.minimum(extra[x[part]], extra[y[part]])
    return np.minimum(most, np.minimum(n[i], n[j]))


def forest(component: np.ndarray, i: np.ndarray, j: np.ndarray, parent: dict[int, int]) -> np.ndarray:
    """Places of the pairs (i, j) that, taken in order, join components which those before have not joined."""

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    kept = []
    for k, (a, b) in enumerate(zip(component[i].tolist(), component[j].tolist())):
        a, b = root(a), root(b)
        if a != b:
            parent[a] = b
            kept.append(k)
    return np.array(kept, np.int64)


def tree_pairs(members: DataFrame, page: int = 20_000, trees_only: bool = False) -> DataFrame:
    """Candidate pairs (a, b) of each block, from rows (shingle, size, class, component, n, sig).

    A block of more than ``page`` rows is dealt over pages, and each pair of pages is a group of its
    own, so a task holds two pages at most. If rows have ``wide`` too, bitmaps in proportion to the sets, pairs have
    to pass these before they leave the task. With ``trees_only`` a group gives only the pairs, the most similar ones
    first, that would connect its components if all were links: fewer than it has members."""
    pages = F.ceil(F.col("size") / page).cast("int")
    own = F.pmod(F.xxhash64("class"), pages).cast("int")
    spread = members.withColumns({"_own": own, "_other": F.explode(F.sequence(F.lit(0), pages - 1))})
    spread = spread.withColumns({"_low": F.least("_own", "_other"), "_high": F.greatest("_own", "_other")})
    keys = ["shingle", "_low", "_high"]
    extra = ["wide"] if "wide" in members.columns else []
    dealt = spread.repartition(*keys).sortWithinPartitions(*keys).select(*keys, "class", "component", "n", "sig", *extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            key = [held[k].to_numpy() for k in keys]
            change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
            if len(change):
                yield solve(held.slice(0, change[-1]), change[:-1])
                held = held.slice(change[-1])
        if held is not None and held.num_rows:
            yield solve(held, np.zeros(0, np.int64))

    def solve(rows: pa.Table, change: np.ndarray) -> pa.RecordBatch:
        name, component, n = (rows[c].to_numpy() for c in ("class", "component", "n"))
        sig = np.frombuffer(b"".join(rows["sig"].to_pylist()), np.uint64).reshape(-1, SIG_WORDS)
        wide = [np.frombuffer(w, np.uint64) for w in rows["wide"].to_pylist()] if extra else []
        out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for start, stop in zip([0, *change], [*change, rows.num_rows]):
            if stop - start < 2 or component[start:stop].min() == component[start:stop].max():
                continue
            part, parent = slice(start, stop), {}
            for i, j in gathered(SignatureTree(component[part], n[part], sig[part]).pairs()):
                if extra:
                    most = wide_bounds(wide[part], n[part], i, j)
                    fits = similar(most, n[part][i], n[part][j])
                    i, j, most = i[fits], j[fits], most[fits]
                    order = np.argsort(-most / (n[part][i] + n[part][j] - most), kind="stable")
                    i, j = i[order], j[order]
                if trees_only:
                    kept = forest(component[part], i, j, parent)
                    i, j = i[kept], j[kept]
                out_a.append(name[part][i])
                out_b.append(name[part][j])
        a, b = np.concatenate(out_a), np.concatenate(out_b)
        both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1) if len(a) else np.stack([a, b])
        return pa.record_batch([pa.array(both[0]), pa.array(both[1])], ["a", "b"])

    return dealt.mapInArrow(run, "a bigint, b bigint").dropDuplicates(["a", "b"])


def gathered(pairs: Iterator[tuple[np.ndarray, np.ndarray]], least: int = 100_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same pairs in longer arrays."""
    held, size = [], 0
    for pair in pairs:
        held.append(pair)
        size += len(pair[0])
        if size >= least:
            yield np.concatenate([i for i, _ in held]), np.concatenate([j for _, j in held])
            held, size = [], 0
    if held:
        yield np.concatenate([i for i, _ in held]), np.concatenate([j for _, j in held])


# --- verification and components -------------------------------------------------------------------


def promising(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Of pairs (a, b), those that sizes and signatures let be similar."""
    left, right = (
        classes.select(F.col("class").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}")) for x in "ab"
    )
    sized = pairs.join(left, "a").join(right, "b").filter("4 * n_a >= 3 * n_b and 4 * n_b >= 3 * n_a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = batch["n_a"].to_numpy(), batch["n_b"].to_numpy()
            sig_a, sig_b = (
                np.frombuffer(b"".join(batch[c].to_pylist()), np.uint64).reshape(-1, SIG_WORDS) for c in ("sig_a", "sig_b")
            )
            extra = np.minimum(n_a - popcount(sig_a), n_b - popcount(sig_b))
            fits = similar(np.minimum(popcount(sig_a & sig_b) + extra, np.minimum(n_a, n_b)), n_a, n_b)
            yield pa.record_batch([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(fits))

    return sized.select("a", "b", "n_a", "n_b", "sig_a", "sig_b").mapInArrow(run, "a bigint, b bigint")


def _paired(pairs: DataFrame, values: DataFrame, column: str, test: Callable[[np.ndarray, np.ndarray], bool]) -> DataFrame:
    """The pairs (a, b, copy_a, copy_b) whose values of a binary column pass a test."""
    x = values.select(F.col("copy").alias("copy_a"), F.col(column).alias("x"))
    y = values.select(F.col("copy").alias("copy_b"), F.col(column).alias("y"))
    both = pairs.join(x, "copy_a").join(y, "copy_b")
    keys = ["a", "b", "copy_a", "copy_b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits = [
                test(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64))
                for x, y in zip(batch["x"], batch["y"])
            ]
            yield batch.select(keys).filter(pa.array(fits, pa.bool_()))

    return both.select(*keys, "x", "y").mapInArrow(run, ", ".join(f"{k} bigint" for k in keys))


def _wide_test(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether wide bitmaps, each behind its set's size, let the sets be similar."""
    (n_x, x), (n_y, y) = (int(x[0]), x[1:]), (int(y[0]), y[1:])
    words = min(len(x), len(y))
    x, y = folded(x, words), folded(y, words)
    most = int(popcount(x & y)) + min(n_x - int(popcount(x)), n_y - int(popcount(y)))
    return bool(similar(min(most, n_x, n_y), n_x, n_y))


def _whole_test(x: np.ndarray, y: np.ndarray) -> bool:
    both = np.sort(np.concatenate([x, y]))
    return bool(similar(int((both[1:] == both[:-1]).sum()), len(x), len(y)))


def first_ids(names: DataFrame, classes: DataFrame) -> np.ndarray:
    """A bitmap of the smallest ids of the classes that ``names`` lists: their documents are read again."""
    return bitmap(classes.join(names, "class", "left_semi").select(id_key("first_id").alias("key")), "key")


def verified(docs: DataFrame, pairs: DataFrame, classes: DataFrame, label: str) -> DataFrame:
    """The stored pairs that are similar. Bitmaps in proportion to the sets leave few pairs that are
    not; for the rest the whole sets meet.

    Of each class the document with the smallest id is read again. Where that still gives several rows (repeated ids,
    or a bitmap that names too much), pairs choose one of them, so sets need no shuffle to be told apart."""
    spark = docs.sparkSession
    ends = pairs.select(F.explode(F.array("a", "b")).alias("class"))
    path = scratch_dir(spark, f"sets-{label}")
    sets_of(docs, first_ids(ends, classes)).write.parquet(path)
    sets = spark.read.parquet(path)
    chosen = sets.groupBy("class").agg(F.min("copy").alias("copy"))
    a, b = (chosen.select(F.col("class").alias(x), F.col("copy").alias(f"copy_{x}")) for x in "ab")
    path = scratch_dir(spark, f"close-{label}")
    _paired(pairs.join(a, "a").join(b, "b"), sets, "wide", _wide_test).write.parquet(path)
    close = spark.read.parquet(path)
    path = scratch_dir(spark, f"links-{label}")
    _paired(close, sets, "shingles", _whole_test).select("a", "b").write.parquet(path)
    return spark.read.parquet(path)


def components(links: DataFrame) -> DataFrame:
    """class and component (the smallest class that it is connected with) of all ends of links.

    Labels move along links and then along labels, so a chain shortens by half in every round; rounds
    are written tables."""
    spark = links.sparkSession
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = both.groupBy(F.col("a").alias("class")).agg(F.least(F.first("a"), F.min("b")).alias("component"))
    while True:
        path = scratch_dir(spark, "labels")
        near = both.join(labels.withColumnRenamed("class", "b"), "b").groupBy(F.col("a").alias("class")).agg(F.min("component").alias("near"))
        step = labels.join(near, "class").select("class", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        up = labels.select(F.col("class").alias("component"), F.col("component").alias("top"))
        step.join(up, "component", "left").select(
            "class", "old", F.least("component", F.coalesce("top", "component")).alias("component")
        ).write.parquet(path)
        step = spark.read.parquet(path)
        labels = step.select("class", "component")
        if step.filter("old != component").isEmpty():
            return labels


def star_pairs(met: DataFrame, pivots: int) -> DataFrame:
    """Pairs (a, b) of a pivot and a class: for each class the ``pivots`` that it meets in most blocks.

    The others are not lost: what they would link is still in blocks of several components, for the trees."""
    pairs = met.filter("class != pivot").groupBy("pivot", "class").agg(F.count(F.lit(1)).alias("blocks"))
    order = Window.partitionBy("class").orderBy(F.desc("blocks"), "pivot")
    return pairs.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= pivots).select(
        F.col("pivot").alias("a"), F.col("class").alias("b")
    )


def mixed_blocks(placed: DataFrame) -> DataFrame:
    """shingle and size of the blocks with more than one component, one for each different set of classes.

    ``placed`` has distinct rows (shingle, class, component). Sets are told apart by two 64-bit hashes
    over all classes, besides size and components, so that nothing is collected."""
    of_class = lambda seed: F.bit_xor(F.xxhash64("class", F.lit(seed)))
    blocks = placed.groupBy("shingle").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("size"),
        of_class(1).alias("one"), of_class(2).alias("two"),
    )
    same = blocks.filter("low < high").groupBy("size", "low", "high", "one", "two")
    return same.agg(F.min("shingle").alias("shingle")).select("shingle", "size")


def link_groups(docs: DataFrame, common_from: int = 6, pivots: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every document.

    Null and empty texts have no shingles and are linked with nothing: their component is their own id.
    Rows of one class share a component, so repeated rows do too. A null id never is a component's id
    unless all its documents lack one. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    texts = id_and_text(docs, id_col, text_col)
    path = scratch_dir(spark, "classes")
    classes_of(texts).write.parquet(path)
    stored = spark.read.parquet(path)
    members = stored.filter("repeated is null").select("doc_id", "n", "class", "sig")
    classes = members.filter("n > 0").groupBy("class").agg(F.first("n").alias("n"), F.first("sig").alias("sig"), F.min("doc_id").alias("first_id"))
    repeats = stored.filter("repeated is not null").select(F.inline(F.arrays_zip("repeated", "times")))
    often = repeats.groupBy("repeated").agg(F.sum("times").alias("times")).filter(F.col("times") >= common_from)

    path = scratch_dir(spark, "prefixes")
    prefixes(texts, bitmap(often, "repeated")).write.parquet(path)
    rows = spark.read.parquet(path)
    path = scratch_dir(spark, "blocks")
    block = Window.partitionBy("shingle")
    ends = {"pivot": F.min("class").over(block), "other": F.max("class").over(block)}
    rows.withColumns(ends).filter("pivot < other").drop("other").write.parquet(path)
    met = spark.read.parquet(path)
    path = scratch_dir(spark, "stars")
    promising(star_pairs(met, pivots), classes).write.parquet(path)
    links = verified(texts, spark.read.parquet(path), classes, "stars")
    labels = components(links)

    # First what connects the components of each block, if it is similar; then all that is left.
    at = met.select("shingle", "class").distinct()
    maps = None
    for label in ("trees", "rest"):
        known = classes.join(labels, "class", "left").select("class", "n", "sig", F.coalesce("component", "class").alias("component"))
        placed = at.join(known.select("class", "component"), "class")
        path = scratch_dir(spark, f"crossing-{label}")
        placed.join(mixed_blocks(placed), "shingle").write.parquet(path)
        at = spark.read.parquet(path)
        if at.isEmpty():
            break
        if maps is None:
            path = scratch_dir(spark, "maps")
            sets_of(texts, first_ids(at, classes), maps_only=True).dropDuplicates(["class"]).write.parquet(path)
            maps = spark.read.parquet(path)
        path = scratch_dir(spark, f"pairs-{label}")
        crossing = at.join(known.select("class", "n", "sig"), "class").join(maps, "class")
        tree_pairs(crossing, trees_only=label == "trees").write.parquet(path)
        pairs = spark.read.parquet(path)
        if pairs.isEmpty():
            break
        links = links.union(verified(texts, pairs, classes, label))
        labels = components(links)
        at = at.select("shingle", "class")

    named = classes.select("class", "first_id").join(labels, "class", "left").withColumn("component", F.coalesce("component", "class"))
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    of_class = named.join(smallest, "component").select("class", "component_id")
    out = members.join(of_class, "class", "left")
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is their component's, one of each id; rows without id stay.

    Rows of equal id are versions of one document: the one whose text comes first in byte order stays,
    a null text before all others, and among equal texts the one of the smallest row hash.
    """
    groups = link_groups(docs.filter("doc_id is not null").select("doc_id", "text"))
    kept = groups.filter("doc_id = component_id").select("doc_id").distinct()
    named = docs.filter("doc_id is not null").join(kept, "doc_id", "left_semi").select(*(f"`{c}`" for c in docs.columns))
    first = F.min_by(F.struct("*"), F.struct(F.col("text"), F.xxhash64("*")))
    one = named.groupBy("doc_id").agg(first.alias("_row")).select("_row.*")
    return one.unionByName(docs.filter("doc_id is null"))
