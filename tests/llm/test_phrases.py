"""Collocations against brute force over all n-grams."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from chatloom.llm import phrases
from chatloom.llm.queries import LLM_QUERIES

from .conftest import ODD_TEXTS, SMALL


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(docs, longest=3, least=10, top=2000, share=50):
    """Rows of the result, from dictionaries of all n-grams."""
    f = defaultdict(Counter)
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            for m in range(1, longest + 1):
                f[lang or "und"].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    rows = []
    for lang, counts in f.items():
        n = sum(c for w, c in counts.items() if len(w) == 1)
        frequent = {w: c for w, c in counts.items() if len(w) > 1 and c >= least}
        held = Counter()
        for w, c in frequent.items():
            for j in range(2, len(w)):
                for i in range(len(w) - j + 1):
                    held[w[i : i + j]] = max(held[w[i : i + j]], c)
        scored = []
        for w, a in frequent.items():
            if 100 * held[w] >= share * a:
                continue
            cuts = [(1_000_000 * a * a // (counts[w[:k]] * counts[w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(w).encode(), counts[w[:k]], counts[w[k:]]))
        for rank, (score, a, phrase, l_, r) in enumerate(sorted(scored)[:top], 1):
            rows.append((lang, rank, phrase.decode(), -a, l_, r, n, -score))
    return sorted(rows)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed", range(4))
def test_index_enumerates_every_phrase_with_its_intervals(seed):
    rng = np.random.default_rng(seed)
    sequence = np.concatenate([rng.integers(0, 6, 400), [0]]).astype(np.int32)
    index = phrases.ShardIndex(sequence, 4)
    want = [Counter(), Counter(), Counter()]
    for m, counter in zip((2, 3, 4), want):
        counter.update(tuple(sequence[i : i + m].tolist()) for i in range(len(sequence) - m + 1) if 0 not in sequence[i : i + m])
    all_ = []
    for m, counter in enumerate(want):
        grams = index.grown(all_[:m])
        assert dict(zip(map(tuple, grams.words.tolist()), grams.count.tolist())) == counter
        all_.append(np.arange(len(grams.count)))
        for words, start, back, count in zip(grams.words, grams.forward, grams.backward, grams.count):
            for side, text, pattern, at in ((index.forward, sequence, words, start), (index.backward, sequence[::-1], words[::-1], back)):
                before = sorted(side.before[at : at + count].tolist())
                here = [i for i in range(len(text)) if text[i : i + len(pattern)].tolist() == pattern.tolist()]
                assert before == sorted(int(text[i - 1]) for i in here)


def test_only_frequent_phrases_grow():
    sequence = np.array([1, 2, 3, 0, 1, 2, 4, 0, 2, 3, 0], np.int32)
    index = phrases.ShardIndex(sequence, 3)
    pairs = index.grown([])
    chosen = np.flatnonzero([w in ([1, 2], [2, 3]) for w in pairs.words.tolist()])
    assert index.grown([chosen]).words.tolist() == [[1, 2, 3]]


def test_op11_equals_brute_force(spark, documents):
    docs = [(r.lang, r.text) for r in documents.collect()]
    assert rows_of(LLM_QUERIES["op11_fm_phrases"](spark, SMALL)) == brute(docs)


def test_op11_over_many_small_shards(spark):
    random_ = random.Random(8)
    words = ["new", "york", "city", "The", "the", "a", "b", "c", "é", "x\x1cy", "日本"]
    docs = [(random_.choice(["en", "de", None, "und"]), " ".join(random_.choices(words, k=30)) + random_.choice(".,\n\t ") * 2 + "New York City hall") for _ in range(300)]
    table = spark.createDataFrame(docs, "lang string, text string")
    for longest in (2, 3, 4):
        got = phrases.mine(table.repartition(5), longest=longest, least=4, top=50, shard_words=100)
        assert rows_of(got) == brute(docs, longest, 4, 50)


def test_op11_ties_and_large_numbers(spark):
    counts = phrases.Counts(
        spark.createDataFrame([("en", 10**12)], "lang string, n bigint"),
        spark.createDataFrame([("en", w, c) for w, c in (("a", 10**12), ("b", 9 * 10**11), ("c", 10**12))], "lang string, phrase string, f bigint"),
        spark.createDataFrame([("en", "a b", 8 * 10**11), ("en", "b c", 8 * 10**11), ("en", "a b c", 123456789012)], "lang string, phrase string, f bigint"),
    )
    rows = {r.phrase: r for r in phrases.best_cuts(counts).collect()}
    assert rows["a b"].score == 10**6 * 64 * 10**22 // (10**12 * 9 * 10**11)
    assert (rows["a b c"].k, rows["a b c"].score) == (1, 10**6 * 123456789012**2 // (10**12 * 8 * 10**11))


def test_op11_on_odd_rows(spark, odd, no_documents):
    docs = [(r.lang, r.text) for r in odd.collect()]
    assert rows_of(phrases.mine(odd, least=2)) == brute(docs, least=2)
    assert any(t and len(t) > 10_000 for t in ODD_TEXTS)
    assert phrases.mine(no_documents).count() == 0
    assert phrases.mine(odd.filter("text is null")).count() == 0
