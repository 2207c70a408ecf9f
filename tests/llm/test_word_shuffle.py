"""The distinct-word shuffle against the library's own encoding, and round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from chatloom.llm import word_shuffle
from chatloom.llm.queries import LLM_QUERIES

from .conftest import ODD_TEXTS, SMALL

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = word_shuffle.read_ranks(PATH)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def digest(library, text):
    ids = library.encode_ordinary(text or "")
    decoded = hashlib.sha256(library.decode_bytes(ids)).hexdigest()
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), decoded


def test_words_merge_like_the_library(library):
    ranks, random_ = word_shuffle.Ranks(PATH), random.Random(5)
    words = ["a" * n for n in range(1, 40)] + ["aaab" * 50, "é" * 33, "日本語" * 9, "\U0001f642" * 7]
    words += ["".join(random_.choices("abcdeéß日\U0001f642", k=random_.randrange(1, 60))) for _ in range(500)]
    for word in words:
        assert ranks.encode(word.encode()) == library._encode_single_piece(word)


def test_a_long_unbroken_word_is_no_quadratic_work(library):
    word = "".join(random.Random(1).choices("abcdefgh", k=200_000))
    assert word_shuffle.Ranks(PATH).encode(word.encode()) == library.encode_ordinary(word)


def test_texts_split_like_the_pattern():
    random_ = random.Random(3)
    texts = [t for t in ODD_TEXTS if t]
    texts += ["".join(random_.choices(" \n\t'sdé9.\x1c\x85", k=random_.randrange(1, 30))) for _ in range(3000)]
    for text in texts:
        assert word_shuffle.pretokens(text) == word_shuffle._PATTERN.findall(text)


def test_op13_equals_the_library(spark, library, documents):
    rows = LLM_QUERIES["op13_distinct_word_bpe"](spark, SMALL).collect()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows}
    assert len(rows) == documents.count() and got == {r.doc_id: digest(library, r.text) for r in documents.collect()}


def test_op13_on_odd_rows(library, odd, no_documents):
    texts = [(r.doc_id, r.text) for r in odd.collect()]
    rows = word_shuffle.digests(word_shuffle.round_trip(odd, PATH)).collect()
    assert sorted(map(repr, ((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows))) == sorted(
        repr((i, *digest(library, t))) for i, t in texts
    )
    encoded = word_shuffle.encode(odd, PATH)
    assert sorted(map(repr, ((r.doc_id, r.ids) for r in encoded.collect()))) == sorted(
        repr((i, library.encode_ordinary(t or ""))) for i, t in texts
    )
    decoded = word_shuffle.decode(encoded, PATH).collect()
    assert sorted(map(repr, ((r.doc_id, bytes(r.decoded).decode()) for r in decoded))) == sorted(repr((i, t or "")) for i, t in texts)
    assert word_shuffle.round_trip(no_documents, PATH).count() == 0 == word_shuffle.encode(no_documents, PATH).count()


def test_documents_spread_over_many_blocks(spark, library):
    docs = spark.createDataFrame([(i, f"word{i % 7} " * (i % 50)) for i in range(300)], "doc_id long, value string")
    stored = word_shuffle.list_blocks(docs.repartition(3), word_shuffle.pretokens, block_size=500)
    assert stored.select("block").distinct().count() > 30
    found = word_shuffle.encode_lists(stored, PATH, memo=3)
    rows = word_shuffle.join_back(stored, found, lambda ids: [ids], ["ids"]).collect()
    assert {r.doc_id: r.ids for r in rows} == {i: library.encode_ordinary(f"word{i % 7} " * (i % 50)) for i in range(300)}


def test_ids_of_no_token_are_refused(spark):
    rows = spark.createDataFrame([(1, [1, 999_999])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="no token has the id 999999"):
        word_shuffle.decode(rows, PATH).collect()


def test_packed_lists_come_back():
    for parts in ([], [b""], [b"", b"a", b"\x00" * 300], [b"%d" % i for i in range(1000)], [b"abcd", b"", b"12345678"]):
        assert word_shuffle.unpack(word_shuffle.pack(parts)) == parts
    for numbers in ([], [0], [2**32 - 1, 7, 256, 65536]):
        packed = word_shuffle.pack_numbers(np.array(numbers, dtype=np.uint32))
        assert word_shuffle.unpack_numbers(packed).tolist() == numbers
