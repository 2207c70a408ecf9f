"""Tokenizing operators against the tokenizers library."""

import hashlib
import random
import time
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from chatloom.llm import bpe, packing, token_counts, token_files
from chatloom.llm.bpe import TreeEncoder
from chatloom.llm.encoding import Encoder
from chatloom.llm.queries import LLM_QUERIES
from chatloom.llm.token_counts import PrefixCounter
from .conftest import SMALL

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


@lru_cache
def library_of(path):
    return Tokenizer.from_file(path)


def ids_of(path, text):
    return library_of(path).encode(text or "", add_special_tokens=False).ids


def random_texts(n, seed=3):
    rng = random.Random(seed)
    letters = "ab c'\ns\t<|>enéǅ1\x1c ́あ "
    blanks = ["a\n \nb", "a\t \t b", "a \n", "a\n ", " \n \n x  \n  y"]
    return blanks + ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(n)]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_ids_and_counts_are_the_librarys(path):
    library, encoder, counter = Tokenizer.from_file(path), Encoder(path), PrefixCounter(path)
    for text in random_texts(2000):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == want, repr(text)
        assert counter.count(text) == len(want), repr(text)


def test_words_with_marks_are_encoded_once():
    library, encoder, made = library_of(WORD), Encoder(WORD), []
    piece = encoder.piece
    encoder.piece = lambda text: made.append(text) or piece(text)
    text = "Word, word. (word) WORD's word!\n\tword\x1cword " * 3
    want = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.ids(text), "<u4").tolist() == want
    assert made.count("word") == 1
    assert not encoder.plain and "word," not in encoder.pieces


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_every_prefix_has_its_exact_count(path):
    library, counter = Tokenizer.from_file(path), PrefixCounter(path)
    for word in ["internationalization", "aaaaaaaaaaaa", "thonerestionhath", "12345"]:
        if path == WORD and word.isdigit():
            continue
        want = [len(library.encode(word[:k], add_special_tokens=False).ids) for k in range(1, len(word) + 1)]
        assert counter.prefixes(word).tolist() == want
    odd = ["we'll'reheat", "x  \n \n  word'sake", "a<|endoftext|>bcd<|endoftext|>", "日本語テキストabc日本", "éÉÀx'd", "'" * 9, "\n\n\n   "]
    for text in odd + random_texts(150, seed=5):
        counts = [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
        for budget in (0, 1, 3, 8):
            assert counter.fit(text, budget) == max(k for k, n in enumerate(counts) if n <= budget), repr(text)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_budget_of_a_long_unbroken_text_is_answered_from_stored_counts(path):
    counter, library = PrefixCounter(path), library_of(path)
    for letters in ("abcdefghij0123456789+/", "日本語文字"):
        text = "".join(random.Random(2).choices(letters, k=100_000 if letters.isascii() else 3_000))
        if path == WORD and not letters.isascii():
            continue
        n = counter.count(text)
        started = time.process_time()
        cut = counter.fit(text, 2048)
        assert n > 2048 and time.process_time() - started < 10
        size = lambda t: len(library.encode(t, add_special_tokens=False).ids)
        assert size(text[:cut]) <= 2048 and all(size(text[:e]) > 2048 for e in range(cut + 1, cut + 40))


def test_segment_tree_merges_like_the_library():
    library, tree = Tokenizer.from_file(BYTE), TreeEncoder(BYTE)
    for text in random_texts(2000, seed=7) + ["a" * 10_000, "ab" * 3000, "-" * 999]:
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(tree.ids(text), "<u4").tolist() == want, repr(text)
        assert tree.decode(want).decode("utf-8", "replace") == library.decode(want, skip_special_tokens=False)


def test_op1_op7_on_odd_rows(odd, no_documents):
    texts = {(r.doc_id, r.text) for r in odd.collect()}
    counts = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(odd, WORD).collect()}
    assert counts == {(i, len((t or "").encode()), n := len(ids_of(WORD, t)), n > 2048) for i, t in texts}
    trips = {tuple(r) for r in bpe.round_trip(odd, BYTE, step=3).collect()}

    def trip(i, text):
        ids = ids_of(BYTE, text)
        decoded = library_of(BYTE).decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), decoded)]
        return i, len(ids), *digests

    assert trips == {trip(i, t) for i, t in texts}
    assert bpe.decode_ids(bpe.encode_ids(odd, BYTE), BYTE).count() == odd.count()
    assert token_counts.token_counts(no_documents, WORD).count() == 0
    assert bpe.round_trip(no_documents, BYTE).count() == 0


def test_local_search_fills_bins():
    lengths = [6, 5, 5, 4, 4, 3, 3]  # 30 in three bins of 10; first fits as dealt below need four
    bins = packing.improve([[0, 5], [1, 3], [2, 4], [6]], lengths, 10)
    assert len(bins) == 3 and sorted(i for b in bins for i in b) == list(range(7))
    rng = random.Random(1)
    lengths = [rng.randrange(1, 2048) for _ in range(800)]
    start = [[i] for i in range(len(lengths))]
    bins = packing.improve(start, lengths, 2048)
    assert max(sum(lengths[i] for i in b) for b in bins) <= 2048
    assert sorted(i for b in bins for i in b) == list(range(800))
    assert len(packing.best_fit(lengths, 2048)) <= 1.04 * sum(lengths) / 2048 + 1


def check_packing(rows, docs, capacity=2048):
    for doc_id, text in docs:
        ids = np.array([*ids_of(WORD, text), 0], "<u4")
        mine = sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: r.piece)
        assert [r.piece for r in mine] == list(range(len(mine)))
        assert [r.start for r in mine] == list(range(0, len(ids), capacity))
        for r in mine:
            part = ids[r.start : r.start + r.length]
            assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_op2_packs_every_token(documents, odd, no_documents, spark):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    rows = LLM_QUERIES["op2_best_fit_packing"](spark, SMALL).collect()
    used = check_packing(rows, docs)
    assert used <= 1.01 * sum(r.length for r in rows) / 2048 + 1
    kept = odd.filter("doc_id is not null").dropDuplicates()
    rows = packing.pack_documents(kept, WORD, group_size=5).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in kept.collect()])
    assert packing.pack_documents(odd, WORD).count() >= odd.count()
    assert packing.pack_documents(no_documents, WORD).count() == 0


def test_op9_files_hold_all_ids(documents, odd, no_documents, spark):
    docs = sorted((r.doc_id, r.text) for r in documents.collect())
    rows = sorted(LLM_QUERIES["op9_token_files"](spark, SMALL).collect(), key=lambda r: r.doc_id)
    at = 0
    for (doc_id, text), r in zip(docs, rows, strict=True):
        ids = np.array([*ids_of(BYTE, text), 0], "<u4")
        assert tuple(r[c] for c in ("doc_id", "start", "n_tokens", "ids_crc32")) == (
            doc_id, at, len(ids), zlib.crc32(ids.tobytes()),
        )
        at += len(ids)
    back = token_files.store_and_read(odd, BYTE, width=16).collect()
    assert len(back) == odd.count()
    assert {(r.doc_id, r.n_tokens) for r in back} == {(r.doc_id, len(ids_of(BYTE, r.text)) + 1) for r in odd.collect()}
    assert token_files.store_and_read(no_documents, BYTE).count() == 0


def test_sequences_can_be_read_at_random(odd, tmp_path):
    index = token_files.write_sequences(odd, BYTE, str(tmp_path / "seq"), width=8)
    for name in {r.file for r in index.collect()}:
        reader = token_files.SequenceReader(name)
        total = sum(r.n_tokens for r in index.collect() if r.file == name)
        count = -(-total // 8)
        assert sum(int(reader.sequence(k, "mask").sum()) for k in range(count)) == total
        flat = np.concatenate([reader.sequence(k) for k in range(count)])[:total]
        assert np.concatenate(list(reader.parts(0, total))).tolist() == flat.tolist()
