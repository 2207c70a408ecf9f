"""Language identification by error-correcting output codes.

Each language has a codeword of bits. One binary classifier per bit, logistic regression on hashed
byte trigrams, predicts that bit. Decoding adds up the loss of all bits for every codeword, so unsure
classifiers count little, and takes the nearest; a small lead over the next one flags ambiguity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import crc_mod, unused

UNDETERMINED = "und"
BUCKETS = 4096


def features(text: str) -> np.ndarray:
    """Square roots of the shares of hashed byte trigrams; zeros for fewer than three bytes."""
    data = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)
    if len(data) < 3:
        return np.zeros(BUCKETS, np.float32)
    total = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(data) - 2, 1 << 20):  # long texts in pieces
        part = data[at : at + (1 << 20) + 2].astype(np.uint32)
        code = (part[:-2] * np.uint32(0x1E35A7BD) + part[1:-1] * np.uint32(0x2545F491) + part[2:] * np.uint32(0x9E3779B1))
        total += np.bincount((code * np.uint32(0x85EBCA6B)) >> np.uint32(20), minlength=BUCKETS)
    return np.sqrt(total / total.sum()).astype(np.float32)


def codewords(n: int, bits: int = 15, seed: int = 7) -> np.ndarray:
    """``n`` codewords of -1 and 1, far apart: of random ones, each next that is farthest from the rest."""
    rng = np.random.default_rng(seed)
    bits = max(bits, 3 * n.bit_length())
    chosen = [rng.choice([-1, 1], bits)]
    while len(chosen) < n:
        tries = rng.choice([-1, 1], (500, bits))
        distance = np.min([(tries != c).sum(1) for c in chosen], axis=0)
        chosen.append(tries[np.argmax(distance)])
    words = np.array(chosen[:n]).reshape(n, bits)
    if n > 1:  # a bit that is the same for all languages has nothing to learn
        constant = np.abs(words.sum(0)) == n
        words[rng.integers(n), constant] *= -1
    return words


@dataclass(frozen=True)
class LanguageModel:
    """Languages, their codewords, and one row of weights (the last one a bias) per bit."""

    languages: list[str]
    words: np.ndarray
    weights: np.ndarray

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of features the index of the nearest codeword, and all probabilities."""
        margins = np.clip(x @ self.weights[:, :-1].T + self.weights[:, -1], -30, 30)
        loss = np.log1p(np.exp(-margins[:, None, :] * self.words[None])).sum(2)
        share = np.exp(loss.min(1, keepdims=True) - loss)
        share /= share.sum(1, keepdims=True)
        return share.argmax(1), share


def fit_bits(x: np.ndarray, y: np.ndarray, words: np.ndarray, steps: int = 80, decay: float = 1e-5) -> np.ndarray:
    """Logistic regression of every bit of the codewords, by accelerated gradient descent."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    target = words[y].astype(np.float32)
    share = np.bincount(y, minlength=len(words)).astype(np.float32)
    weight = (1 / share[y] / max(1, (share > 0).sum()))[:, None]  # languages count alike
    w = ahead = np.zeros((words.shape[1], x.shape[1]), np.float32)
    for step in range(steps):
        error = -target / (1 + np.exp(np.clip(target * (x @ ahead.T), -30, 30))) * weight
        new = ahead - 4.0 * (error.T @ x + decay * ahead)
        ahead, w = new + step / (step + 3) * (new - w), new
    return w


def train(docs: DataFrame, learn: Column, per_language: int = 400, bits: int = 15, most_languages: int = 200) -> LanguageModel | None:
    """Fit on a bounded sample of the rows with ``learn``, a text and a lang.

    The sample holds about ``per_language`` rows of each language (rows whose hashed id falls to a
    share that follows from the language's count), of the ``most_languages`` most frequent languages.
    That bounds what reaches the driver, whatever the size of the table. None without such rows.
    """
    rows = docs.filter(learn & F.col("text").isNotNull() & F.col("lang").isNotNull())
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(most_languages)
    sizes = {r["lang"]: r["n"] for r in counts.collect()}
    if not sizes:
        return None
    every = F.lit(None).cast("bigint")
    for lang, n in sizes.items():
        every = F.when(F.col("lang") == lang, F.lit(max(1, n // per_language))).otherwise(every)
    sample = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), every) == 0).select("text", "lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t.as_py()).astype(np.float16).tobytes() for t in batch["text"]]
            yield pa.record_batch([batch["lang"], pa.array(rows, pa.binary())], ["lang", "x"])

    got = sample.mapInArrow(run, "lang string, x binary").toArrow()
    languages = sorted(set(got["lang"].to_pylist()))
    if not languages:
        return None
    x = np.array([np.frombuffer(b, np.float16) for b in got["x"].to_pylist()], np.float32)
    y = np.array([languages.index(v) for v in got["lang"].to_pylist()])
    order = np.lexsort((got["x"].to_pandas(), y))  # the same model in whatever order rows arrive
    words = codewords(len(languages), bits)
    return LanguageModel(languages, words, fit_bits(x[order], y[order], words))


def predict(docs: DataFrame, model: LanguageModel | None, lead: float = 0.2, name: str = "_lang") -> DataFrame:
    """``docs`` (every column kept as it is) with ``name``: struct of lang_pred, score, ambiguous.

    A text that is null or has no letter, or any text without a model, is ``und`` with score 0.
    ``ambiguous`` marks a lead over the next language below ``lead``.
    """
    spark_schema = docs.schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark_schema)
    at = [f.name for f in spark_schema].index("text")
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results = []
            for start in range(0, batch.num_rows, 256):
                texts = [t or "" for t in batch.column(at)[start : start + 256].to_pylist()]
                known = [model is not None and any(map(str.isalpha, t)) for t in texts]
                best = share = None
                if any(known):
                    best, share = model.decode(np.array([features(t) for t in texts]))
                for i, ok in enumerate(known):
                    if not ok:
                        results.append({"lang_pred": UNDETERMINED, "score": 0.0, "ambiguous": True})
                        continue
                    top = np.sort(share[i])[::-1]
                    gap = top[0] - (top[1] if len(top) > 1 else 0)
                    results.append(
                        {"lang_pred": model.languages[best[i]], "score": float(top[0]), "ambiguous": bool(gap < lead)}
                    )
            yield pa.record_batch([*batch.columns, pa.array(results, kind)], [*batch.schema.names, name])

    schema = f"{fields}, `{name}` struct<lang_pred: string, score: double, ambiguous: boolean>"
    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score and ambiguous of every document.

    Documents whose crc32 of the id modulo ``folds`` is ``held_out`` are not learned from; a null id
    is not held out. Predictions see the text alone.
    """
    held = F.coalesce(crc_mod(F.col("doc_id"), folds) == held_out, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang")
    model = train(rows, ~held)
    found = predict(rows.select("doc_id", "text"), model)
    return found.select("doc_id", held.alias("held_out"), "_lang.lang_pred", "_lang.score", "_lang.ambiguous")


def keep_identified(docs: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """The rows of ``docs`` with a language: neither undetermined nor ambiguous, with their own columns."""
    held = F.coalesce(crc_mod(F.col("doc_id"), folds) == held_out, F.lit(False))
    model = train(docs.select("doc_id", "text", "lang"), ~held)
    name = unused("_lang", docs.columns)
    found = predict(docs, model, name=name)
    rejected = (F.col(name)["lang_pred"] == UNDETERMINED) | F.col(name)["ambiguous"]
    return found.filter(~rejected).drop(name)
