"""Phrases whose words stand together more often than their parts, counted with an FM-index per shard.

A shard is a run of one language's texts as numbers of its own word list, 0 where a piece of text ends. Its
FM-index holds, for the text and for the text read backwards, the words before each suffix in suffix
order. A phrase is an interval in both orders; the words before (or after) its occurrences stand next to
each other there, so one pass over an interval gives all its extensions with their counts and intervals.

Phrases grow by one word a round. After each round counts are summed across shards, and only phrases that are
frequent in all of them go back to their shards to grow, as no part of a frequent phrase is rarer than it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm.common import pack, pack_numbers, unpack, unpack_numbers
from chatloom.llm.words import pieces
from chatloom.session import scratch_dir

# What ends a piece, [.,;:!?\x0A-\x0D], and the language of rows without one.
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
UNDETERMINED = "und"

# No byte of UTF-8; stands for a piece's end while a text is split.
BREAK = b"\xff"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_SPLIT = bytes.maketrans(SEPARATORS + b"\t" + _UPPER, BREAK * len(SEPARATORS) + b" " + _UPPER.lower())

SHARDS = "shard bigint, lang string, n bigint, words binary, sequence binary"


def split_words(data: bytes) -> list[bytes]:
    """The words of a text in lower case, and a break wherever a piece ends."""
    return data.translate(_SPLIT).replace(BREAK, b" " + BREAK + b" ").split()


class _Numbers(dict):
    """Words numbered as they come; the break is 0."""

    def __init__(self):
        super().__init__({BREAK: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class _Shard:
    """The words of one language that a task has read since the last shard was full."""

    def __init__(self):
        self.numbers, self.parts, self.size = _Numbers(), [], 0

    def add(self, words: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def row(self, shard: int, lang: str) -> pa.RecordBatch:
        """The shard as one row: its words, the most frequent first, and the texts as their numbers, packed."""
        sequence = np.concatenate([*self.parts, np.zeros(1, np.int32)])
        counts = np.bincount(sequence, minlength=len(self.numbers))[1:]
        order = np.argsort(-counts, kind="stable")
        number = np.zeros(len(order) + 1, np.int64)
        number[order + 1] = np.arange(1, len(order) + 1)
        words = list(self.numbers)
        packed = pack([words[i + 1] for i in order]), pack_numbers(number[sequence])
        values = [shard, lang, int(counts.sum()), *packed]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary()]
        return pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds)], names=_names(SHARDS))


def _names(schema: str) -> list[str]:
    return [column.split()[0] for column in schema.split(", ")]


def store_shards(
    docs: DataFrame, shard_words: int = 1 << 20, lang_col: str = "lang", text_col: str = "text"
) -> DataFrame:
    """The texts as shards of one language each, stored once; null texts have no words.

    A shard has about ``shard_words`` words and ends where a piece of text ends, so no phrase is cut; only
    a longer piece without any end makes a longer shard. Of several languages in one task the largest
    open shard is closed whenever all together hold four times as many words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shards = TaskContext.get().partitionId() << 32, {}

        def closed(lang: str) -> pa.RecordBatch:
            nonlocal number
            number += 1
            return shards.pop(lang).row(number, lang)

        for batch in batches:
            for lang, scalar in zip(batch["lang"].to_pylist(), batch["text"]):
                for piece in pieces((scalar.as_py() or "").encode()):
                    words = split_words(piece)
                    shard = shards.setdefault(lang, _Shard())
                    if shard.size >= shard_words and BREAK in words:
                        end = words.index(BREAK)
                        shard.add(words[:end])
                        yield closed(lang)
                        shard, words = shards.setdefault(lang, _Shard()), words[end:]
                    shard.add(words)
                shards[lang].add([BREAK])
                if shards[lang].size >= shard_words:
                    yield closed(lang)
                elif sum(s.size for s in shards.values()) >= 4 * shard_words:
                    yield closed(max(shards, key=lambda k: shards[k].size))
        for lang in list(shards):
            yield closed(lang)

    path = scratch_dir(docs.sparkSession, "shards")
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(UNDETERMINED)).alias("lang")
    rows = docs.select(lang, F.col(f"`{text_col}`").alias("text")).filter("text is not null")
    rows.mapInArrow(run, SHARDS).write.option("compression", "none").parquet(path)
    return docs.sparkSession.read.schema(SHARDS).parquet(path)


def stable_order(key: np.ndarray) -> np.ndarray:
    """Places in ascending order of whole numbers, equal ones as they stand."""
    n = len(key)
    bits = max(n - 1, 1).bit_length()
    if n and int(key.max()).bit_length() + bits > 62:
        return np.argsort(key, kind="stable")
    return np.sort((key.astype(np.int64) << bits) | np.arange(n)) & ((1 << bits) - 1)


class Side:
    """One direction of the index: suffixes in the order of their first ``depth`` words."""

    def __init__(self, sequence: np.ndarray, depth: int):
        n, rank, width = len(sequence), sequence.astype(np.int64), 1
        order = stable_order(rank)
        while width < depth:  # each round doubles how many words the order goes by
            after = np.zeros(n, np.int64)
            after[: max(n - width, 0)] = rank[width:]
            key = rank * (int(rank.max(initial=0)) + 1) + after
            order = stable_order(key)
            rank[order] = np.concatenate([[0], np.cumsum(key[order[1:]] != key[order[:-1]])]) if n else order
            width *= 2
        self.before = sequence[order - 1].astype(np.int64)
        # Where the suffix that begins one word earlier stands in the order.
        self.step = np.empty(n, np.int64)
        self.step[stable_order(self.before)] = np.arange(n)


@dataclass
class Grams:
    """Phrases of a shard: a row of word numbers each, where their intervals start, and their counts."""

    words: np.ndarray
    forward: np.ndarray
    backward: np.ndarray
    count: np.ndarray

    def __getitem__(self, rows: np.ndarray) -> Grams:
        return Grams(self.words[rows], self.forward[rows], self.backward[rows], self.count[rows])


class ShardIndex:
    """Bidirectional FM-index of a shard for phrases of up to ``depth`` words."""

    def __init__(self, sequence: np.ndarray, depth: int):
        self.sequence, self.depth = sequence, depth
        self.kinds = int(sequence.max(initial=0)) + 1

    @cached_property
    def forward(self) -> Side:
        return Side(self.sequence, self.depth)

    @cached_property
    def backward(self) -> Side:
        return Side(self.sequence[::-1], self.depth)

    def single(self) -> Grams:
        """Every word of the shard; both orders start with the words' counts."""
        count = np.bincount(self.sequence, minlength=1)
        start = np.cumsum(count) - count
        return Grams(np.arange(1, self.kinds)[:, None], start[1:], start[1:], count[1:])

    def _extend(self, side: Side, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
        """All extensions of intervals: which interval, word, new start in this order, how far on in the
        other order's interval, count. Words are in ascending order within an interval; breaks are left out."""
        offset = np.cumsum(count) - count
        owner = np.repeat(np.arange(len(count)), count)
        place = np.arange(len(owner)) - offset[owner] + start[owner]
        key = owner * self.kinds + side.before[place]
        order = stable_order(key)
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        times = np.diff(np.concatenate([first, [len(key)]]))
        owner, word = key[first] // self.kinds, key[first] % self.kinds
        real = word > 0
        new, further = side.step[place[order[first]]], first - offset[owner]
        return owner[real], word[real], new[real], further[real], times[real]

    def left(self, grams: Grams) -> Grams:
        """The phrases with one more word before them."""
        owner, word, new, further, times = self._extend(self.forward, grams.forward, grams.count)
        return Grams(np.hstack([word[:, None], grams.words[owner]]), new, grams.backward[owner] + further, times)

    def right(self, grams: Grams) -> Grams:
        """The phrases with one more word after them."""
        owner, word, new, further, times = self._extend(self.backward, grams.backward, grams.count)
        return Grams(np.hstack([grams.words[owner], word[:, None]]), grams.forward[owner] + further, new, times)

    def grown(self, frequent: list[np.ndarray]) -> Grams:
        """The phrases of two words, or of one more for every round in ``frequent``.

        Each round has the numbers, in this same enumeration, of the phrases to go on with. A phrase
        comes up only if both its parts of one word less went on.
        """
        grams = self.left(self.single())
        for round_, chosen in enumerate(frequent):
            kept = grams[chosen]
            grams = self.left(kept) if round_ % 2 else self.right(kept)
            other = grams.words[:, :-1] if round_ % 2 else grams.words[:, 1:]
            grams = grams[_rows_in(other, kept.words, self.kinds)]
        return grams


def _rows_in(rows: np.ndarray, chosen: np.ndarray, kinds: int) -> np.ndarray:
    """Which of ``rows`` are among ``chosen``, both matrices of numbers below ``kinds``."""
    both = np.vstack([chosen, rows])
    code = both[:, 0]
    for column in both.T[1:]:
        code = np.unique(code * kinds + column, return_inverse=True)[1]
    return np.isin(code[len(chosen) :], code[: len(chosen)])


# A phrase goes by ``key``: its language, a tab (which no word holds), and its words with blanks between.
GROWN = "shard bigint, number int, key string, count bigint"


def grow(shards: DataFrame, rounds: int, batch_rows: int = 100_000) -> DataFrame:
    """The phrases of ``rounds`` + 1 words in each shard, with number and count there.

    ``shards`` has a column ``frequent_<i>`` (array<int>) for each round after the second: what may grow.
    """
    columns = [f"frequent_{i}" for i in range(2, rounds + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                sequence = unpack_numbers(batch["sequence"][row].as_py()).astype(np.int32)
                index = ShardIndex(sequence, rounds + 1)
                chosen = [np.sort(batch[c][row].values.to_numpy(zero_copy_only=False)) for c in columns]
                grams = index.grown(chosen) if rounds else index.single()
                words = pa.array(unpack(batch["words"][row].as_py()), pa.binary()).cast(pa.string())
                first = pc.binary_join_element_wise(batch["lang"][row], words, "\t")
                shard = batch["shard"][row].as_py()
                for at in range(0, len(grams.count), batch_rows):
                    part = grams[slice(at, at + batch_rows)]
                    texts = [(words if i else first).take(pa.array(c - 1)) for i, c in enumerate(part.words.T)]
                    many = len(part.count)
                    values = [
                        pa.array(np.full(many, shard)),
                        pa.array(np.arange(at, at + many, dtype=np.int32)),
                        pc.binary_join_element_wise(*texts, " "),
                        pa.array(part.count),
                    ]
                    yield pa.record_batch(values, names=_names(GROWN))

    return shards.select("shard", "lang", "words", "sequence", *columns).mapInArrow(run, GROWN)


@dataclass(frozen=True)
class Counts:
    """Stored counts over all shards: ``totals`` (lang, n), ``words`` and ``phrases`` (lang, phrase, f)."""

    totals: DataFrame
    words: DataFrame
    phrases: DataFrame


def count_phrases(
    docs: DataFrame,
    longest: int = 3,
    least: int = 10,
    shard_words: int = 1 << 20,
    lang_col: str = "lang",
    text_col: str = "text",
) -> Counts:
    """Exact counts of all words and phrases of 2 to ``longest`` words that occur ``least`` times in a language."""
    shards = store_shards(docs, shard_words, lang_col, text_col)
    totals = _stored(shards.groupBy("lang").agg(F.sum("n").alias("n")), "totals").filter("n > 0")

    # Rows are dealt out by phrase and sorted by a hash of it, as numbers sort faster than texts.
    levels, whole = [], Window.partitionBy("hash", "key")
    growing = shards
    for rounds in range(longest):
        grown = grow(growing, rounds)
        if rounds in (0, longest - 1):
            summed = grown.groupBy("key").agg(F.sum("count").alias("f"))
            levels.append(_stored(summed.filter(F.col("f") >= least), f"phrases-{rounds + 1}"))
            continue
        dealt = grown.repartition("key").withColumn("hash", F.xxhash64("key"))
        marked = dealt.withColumns({"f": F.sum("count").over(whole), "first": F.min("shard").over(whole)})
        marked = _stored(marked.filter(F.col("f") >= least).drop("count", "hash"), f"phrases-{rounds + 1}")
        levels.append(marked.filter("shard = first").select("key", "f"))
        # A shard's numbers are at most as many as its words.
        chosen = marked.groupBy("shard").agg(F.collect_list("number").alias(f"frequent_{rounds + 1}"))
        growing = growing.join(chosen, "shard")
    tab = F.length("key") - F.length(F.substring_index("key", "\t", -1))
    named = [
        level.select(
            F.expr("substring(key, 1, tab - 1)").alias("lang"), F.expr("substring(key, tab + 1)").alias("phrase"), "f"
        )
        for level in (level.withColumn("tab", tab) for level in levels)
    ]
    words, phrases = named[0], named[1]
    for level in named[2:]:
        phrases = phrases.unionByName(level)
    return Counts(totals, words, phrases)


def _stored(rows: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(rows.sparkSession, label)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _part(start: Column, length: Column) -> Column:
    return F.array_join(F.slice("words", start, length), " ")


def best_cuts(counts: Counts, scale: int = 1_000_000) -> DataFrame:
    """lang, phrase, a, k, l, r and score of every phrase at its lowest-scoring cut, of equal ones the first.

    The score is the floor of scale * a * a / (l * r), in decimals of 38 digits.
    """
    size = F.size("words")
    cuts = counts.phrases.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    cuts = cuts.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("head"), _part(F.col("k") + 1, size - F.col("k")).alias("tail")
    )
    known = counts.words.unionByName(counts.phrases)
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    wide = lambda name: f"cast({name} as decimal(20,0))"
    score = F.expr(f"(cast({scale} as decimal(10,0)) * {wide('a')} * {wide('a')}) div ({wide('l')} * {wide('r')})")
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "a", "best.k", "best.l", "best.r", "best.score")


def inside_longer(counts: Counts) -> DataFrame:
    """lang, phrase and the count of the most frequent longer phrase that holds it, for phrases so held."""
    longer = counts.phrases.withColumn("words", F.split("phrase", " ")).filter(F.size("words") > 2)
    size = F.size("words")
    parts = F.flatten(
        F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda j: F.transform(F.sequence(F.lit(1), size - j + 1), lambda i: _part(i, j)),
        )
    )
    return longer.select("lang", "f", F.explode(parts).alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def mine(
    docs: DataFrame,
    longest: int = 3,
    least: int = 10,
    top: int = 2000,
    share: int = 50,
    shard_words: int = 1 << 20,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """The first ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased from A to Z and cut into pieces at ``[.,;:!?\\x0A-\\x0D]``, pieces into words at blanks and
    tabs. Phrases of 2 to ``longest`` words that occur ``least`` times are scored at their weakest cut; one
    inside a longer phrase with at least ``share`` percent of its occurrences is left out. Order: score, a (both
    falling), phrase in byte order.

    Null texts and texts without words add nothing, a null language is ``und``, repeated rows count each
    time, other columns are ignored, an empty table gives an empty one.
    """
    counts = count_phrases(docs, longest, least, shard_words, lang_col, text_col)
    scored = best_cuts(counts).join(inside_longer(counts), ["lang", "phrase"], "left")
    kept = scored.filter(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
    falling = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The best of each piece of a language first, so that no task ranks a whole language.
    dealt = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*falling)
    first = kept.withColumn("rank", F.row_number().over(dealt)).filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*falling)))
    return (
        ranked.filter(F.col("rank") <= top)
        .join(counts.totals, "lang")
        .select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
