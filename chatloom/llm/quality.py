"""Quality of documents by weak supervision, in DataFrame functions only.

Rules vote for a document, against it or abstain. Expectation maximisation over the patterns of votes
estimates how often each rule is right when it votes, without labels. The
posterior probability of being good then takes the place of having to pass all rules.

Null texts count as empty: no words, so the base rule fails. Nothing in a text can raise an error.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import BLANK
from chatloom.session import scratch_dir

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RULES = ["prose", "symbols", "repeats", "word_length", "dup_lines", "letters", "variety", "capitals", "shouting"]


def _chars(pattern: str) -> Column:
    """How many characters of the text belong to a class."""
    return F.char_length("_text") - F.char_length(F.regexp_replace("_text", f"[{pattern}]+", ""))


def _covered(positions: Column, width: int) -> Column:
    """How many places windows of ``width`` at ascending ``positions`` cover together."""
    after = F.transform(positions, lambda p, i: F.coalesce(F.get(positions, i + 1), p + width))
    steps = F.zip_with(positions, after, lambda p, q: F.least(q - p, F.lit(width)))
    return F.aggregate(steps, F.lit(0), lambda total, step: total + step)


def with_features(docs: DataFrame, text_col: str = "text", width: int = 5) -> DataFrame:
    """Add one column ``_quality``, a struct of the counts that the base rule and the votes need.

    Words are hashed once and windows from the hashes. Only a text whose windows are not all
    different, which a hash set tells, has its windows sorted to find the repeated ones.
    """
    columns = docs.columns
    words = docs.withColumn("_text", F.coalesce(F.col(text_col), F.lit(""))).withColumn(
        "_words", F.array_remove(F.split("_text", f"{BLANK}+"), "")
    )
    hashed = words.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    at = lambda i, k: F.get(F.col("_hashes"), i + k)
    windows = F.when(
        F.size("_words") >= width,
        F.transform(
            F.slice("_hashes", F.lit(1), F.size("_hashes") - (width - 1)),
            lambda w, i: F.xxhash64(w, *(at(i, k) for k in range(1, width))),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    hashed = hashed.withColumn("_windows", windows)
    placed = F.sort_array(F.transform("_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    repeats = hashed.withColumn(
        "_placed",
        F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), placed).otherwise(F.slice(placed, 1, 0)),
    )
    same = lambda i: F.get(F.col("_placed"), i)["w"]
    repeated = F.filter(
        "_placed",
        lambda x, i: F.coalesce((same(i + 1) == x["w"]), F.lit(False))
        | ((i > 0) & F.coalesce(same(F.greatest(i - 1, F.lit(0))) == x["w"], F.lit(False))),
    )
    repeats = repeats.withColumn("_places", F.sort_array(F.transform(repeated, lambda x: x["i"])))
    lines = repeats.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda s: s.rlike("[^\\x20\\x09-\\x0D]")))
    features = {
        "n_words": F.size("_words"),
        "word_chars": F.char_length(F.array_join("_words", "")),
        "n_symbols": _chars("#*$%&|<>"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": _covered(F.col("_places"), width),
        "n_lines": F.size("_lines"),
        "n_letters": _chars(r"\p{L}"),
        "n_capitals": _chars(r"\p{Lu}"),
        "n_shouts": _chars("!?"),
        "n_kinds": F.size(F.array_distinct("_hashes")),
    }
    quality = F.struct(*(value.cast("bigint").alias(name) for name, value in features.items()))
    return lines.select(*(F.col(f"`{c}`") for c in columns), quality.alias("_quality"))


def base_failed(q: Column) -> Column:
    """Fewer than 10 words, or more than a fifth of the words in repeated windows."""
    return (q["n_words"] < 10) | (100 * q["n_repeat_words"] > 20 * q["n_words"])


def votes(q: Column) -> dict[str, Column]:
    """Each rule's vote: 1 for the document, -1 against it, 0 to abstain.

    That one failing is absent says little, so rules about failings only vote against; ``prose`` votes
    for texts with words of usual length, made of letters, mostly small ones.
    """

    def against(failing: Column) -> Column:
        return F.when(failing, F.lit(-1)).otherwise(F.lit(0))

    n, chars, letters = q["n_words"], q["word_chars"], q["n_letters"]
    prose = (2 * chars >= 7 * n) & (10 * chars <= 68 * n) & (100 * letters >= 85 * chars)
    prose = prose & (100 * q["n_capitals"] <= 20 * letters) & (100 * q["n_symbols"] <= 2 * chars)
    return {
        "prose": F.when(prose, F.lit(1)).otherwise(F.lit(0)),
        "symbols": against(100 * q["n_symbols"] > 4 * chars),
        "repeats": against(100 * q["n_repeat_words"] > 20 * n),
        "word_length": against((n >= 30) & ((2 * chars < 5 * n) | (10 * chars > 74 * n))),
        "dup_lines": against((q["n_dup_lines"] > 2) & (10 * q["n_dup_lines"] > 4 * q["n_lines"])),
        "letters": against((n >= 20) & (100 * letters < 68 * chars)),
        "variety": against((n >= 30) & (n < 2000) & (100 * q["n_kinds"] < 25 * n)),
        "capitals": against(100 * q["n_capitals"] > 40 * letters),
        "shouting": against(100 * q["n_shouts"] > 40 * n),
    }


@dataclass(frozen=True)
class VoteModel:
    """How often each rule is right when it votes, and the share of documents taken to be good."""

    accuracy: dict[str, float]
    balance: float

    def posterior(self, vote: dict[str, Column]) -> Column:
        """Probability of being good; abstaining rules add nothing to the log-odds."""
        odds = F.lit(math.log(self.balance / (1 - self.balance)))
        for rule, column in vote.items():
            odds = odds + column * math.log(self.accuracy[rule] / (1 - self.accuracy[rule]))
        return 1 / (1 + F.exp(-odds))


def fit(patterns: DataFrame, rounds: int = 15, start: float = 0.85, balance: float = 0.7) -> VoteModel:
    """EM over a table of vote patterns with their numbers ``n``.

    The patterns, at most 3 to the number of rules whatever the input, become one array, over which
    higher-order functions run all rounds: the expected share of a rule's votes that agree with the
    posterior is its next accuracy. Five votes at the start's accuracy are counted in, and accuracies
    stay in 0.6 to 0.98, so a rule that never votes and an empty table do no harm.
    """
    vote = F.array(*(F.col(r).cast("double") for r in RULES))
    table = patterns.agg(F.collect_list(F.struct(vote.alias("v"), F.col("n").cast("double").alias("n"))).alias("rows"))
    first = F.array(*[F.lit(start)] * len(RULES))
    prior = math.log(balance / (1 - balance))

    def total(array: Column, value) -> Column:
        return F.aggregate(array, F.lit(0.0), lambda t, x: t + value(x))

    def posterior(v: Column, accuracy: Column) -> Column:
        odds = total(F.zip_with(v, accuracy, lambda a, b: a * F.log(b / (1 - b))), lambda x: x)
        return 1 / (1 + F.exp(-(odds + prior)))

    def next_accuracy(accuracy: Column) -> Column:
        scored = F.transform("rows", lambda x: F.struct(x["v"].alias("v"), x["n"].alias("n"), posterior(x["v"], accuracy).alias("p")))

        def of_rule(rows: Column, j: Column) -> Column:
            right = lambda x: F.when(F.get(x["v"], j) > 0, x["p"]).when(F.get(x["v"], j) < 0, 1 - x["p"]).otherwise(0.0)
            agreed = total(rows, lambda x: x["n"] * right(x))
            cast = total(rows, lambda x: x["n"] * F.abs(F.get(x["v"], j)))
            return F.least(F.lit(0.98), F.greatest(F.lit(0.6), (agreed + 5 * start) / (cast + 5)))

        every = F.array(*map(F.lit, range(len(RULES))))
        return F.transform(F.array(scored), lambda rows: F.transform(every, lambda j: of_rule(rows, j)))[0]

    found = table.select(F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), first, lambda a, _: next_accuracy(a)))
    return VoteModel(dict(zip(RULES, found.first()[0])), balance)


def _patterns(featured: DataFrame) -> DataFrame:
    """Numbers of vote patterns, stored: a few thousand rows at most, whatever the input."""
    path = scratch_dir(featured.sparkSession, "votes")
    vote = votes(F.col("_quality"))
    counted = featured.select(*(c.alias(r) for r, c in vote.items())).groupBy(*RULES).agg(F.count(F.lit(1)).alias("n"))
    counted.coalesce(1).write.parquet(path)
    return featured.sparkSession.read.parquet(path)


def _verdict(q: Column, model: VoteModel, least: float) -> Column:
    return ~base_failed(q) & (model.posterior(votes(q)) >= least)


def score_quality(docs: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed, the posterior ``quality``, kept.

    The counts are stored once; votes, EM and verdicts read the stored table. Null ids stay null,
    repeated rows stay, an empty table gives none.
    """
    path = scratch_dir(docs.sparkSession, "quality")
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    with_features(slim).drop("text").write.parquet(path)
    stored = docs.sparkSession.read.parquet(path)
    model, q = fit(_patterns(stored)), F.col("_quality")
    return stored.select(
        "doc_id",
        *(q[c].alias(c) for c in BASE),
        base_failed(q).alias("base_failed"),
        model.posterior(votes(q)).alias("quality"),
        _verdict(q, model, least).alias("kept"),
    )


def keep_good(docs: DataFrame, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns, whatever these are called.

    Rows and counts are stored once, side by side: the votes are learned from the stored counts of all
    rows, and the verdict reads them too. Over counts that are not stored the optimizer would write
    their whole expressions into the filter, inside lambdas, and work them out for every element.
    """
    path = scratch_dir(docs.sparkSession, "quality")
    boxed = docs.select(F.struct("*").alias("row"), F.col(f"`{text_col}`").alias("text"))
    with_features(boxed).drop("text").write.parquet(path)
    stored = docs.sparkSession.read.parquet(path)
    model = fit(_patterns(stored.select("_quality")))
    return stored.filter(_verdict(F.col("_quality"), model, least)).select("row.*")
