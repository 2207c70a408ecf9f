"""BPE encoding by a segment tree over the ranks of adjacent pairs, and decoding.

The leaves of the tree hold rank and place of every adjacent pair, inner nodes the smaller of their
two. The root is the leftmost pair of lowest rank. Merging it changes at most three leaves, so each
merge costs a logarithmic number of steps, also in a pretoken of a million symbols.
"""

from __future__ import annotations

import array
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame

from chatloom.llm.common import id_and_text
from chatloom.llm.encoding import Encoder, byte_of_symbol

NO_PAIR = 1 << 62


class TreeEncoder(Encoder):
    """Encodes pretokens with the merges of a byte-level BPE file."""

    def __init__(self, path: str):
        super().__init__(path)
        model = self.spec["model"]
        self.vocab = vocab = model["vocab"]
        self.pairs = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.pairs[vocab[left], vocab[right]] = rank, vocab[left + right]
        to_byte = byte_of_symbol()
        self.bytes_of = {
            i: bytes(to_byte[c] for c in s) if all(c in to_byte for c in s) else s.encode()
            for s, i in vocab.items()
        } | {i: s.encode() for s, i in self.special.items()}
        self.decimal = {i: b"%d" % i for i in self.bytes_of}

    def piece(self, piece: str) -> bytes:
        return array.array("I", self.merge([self.vocab[c] for c in piece])).tobytes()

    def merge(self, symbols: list[int]) -> list[int]:
        """Merge adjacent pairs, lowest rank first and leftmost among equals, until none is left."""
        n, pairs = len(symbols), self.pairs
        if n < 2:
            return symbols
        width = 1 << (n - 1).bit_length()
        half = width if n > 2 else 1
        tree = [NO_PAIR] * (2 * half)
        for i in range(n - 1):
            if (found := pairs.get((symbols[i], symbols[i + 1]))) is not None:
                tree[half + i] = found[0] * width + i
        for k in range(half - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a < b else b
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(i: int, value: int) -> None:
            k = half + i
            tree[k] = value
            while k > 1:
                a, b = tree[k], tree[k ^ 1]
                k >>= 1
                low = a if a < b else b
                if tree[k] == low:
                    break
                tree[k] = low

        def pair(i: int, j: int) -> int:
            found = pairs.get((symbols[i], symbols[j]))
            return NO_PAIR if found is None else found[0] * width + i

        while (top := tree[1]) != NO_PAIR:
            i = top % width
            gone = after[i]
            symbols[i] = pairs[symbols[i], symbols[gone]][1]
            right = after[i] = after[gone]
            symbols[gone] = -1
            if right < n:
                before[right] = i
            if gone < n - 1:
                put(gone, NO_PAIR)
            put(i, pair(i, right) if right < n else NO_PAIR)
            if before[i] >= 0:
                put(before[i], pair(before[i], i))
        return [s for s in symbols if s >= 0]

    def decode(self, ids: array.array) -> bytes:
        """The bytes that ids stand for; special tokens stand for their strings."""
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def tree_encoder(path: str) -> TreeEncoder:
    return TreeEncoder(path)


def encode_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array<int>) of every document; null and empty texts have no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tree_encoder(path)
        for batch in batches:
            rows = [array.array("I", tokens.ids(t.as_py())).tolist() for t in batch["text"]]
            yield pa.record_batch([batch["doc_id"], pa.array(rows, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows of ids; bytes that are no UTF-8 become U+FFFD, null ids an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tree_encoder(path)
        for batch in batches:
            texts = [tokens.decode(r.as_py() or []).decode("utf-8", "replace") for r in batch["ids"]]
            yield pa.record_batch([batch["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def round_trip(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", step: int = 20_000
) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the decimal ids and of the decoded text.

    Ids go through the digests ``step`` chunks at a time, so a long text never lies in memory as a
    whole list of ids. Null and empty texts have no ids; repeated rows stay; other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tree_encoder(path)
        for batch in batches:
            counts, ids_digests, text_digests = [], [], []
            for scalar in batch["text"]:
                number, ids_digest, text_digest = 0, hashlib.sha256(), hashlib.sha256()
                parts = iter(tokens.parts(scalar.as_py()))
                while ids := array.array("I", b"".join(islice(parts, step))):
                    if number:
                        ids_digest.update(b",")
                    ids_digest.update(b",".join(map(tokens.decimal.__getitem__, ids)))
                    text_digest.update(tokens.decode(ids))
                    number += len(ids)
                counts.append(number)
                ids_digests.append(ids_digest.hexdigest())
                text_digests.append(text_digest.hexdigest())
            yield pa.record_batch(
                [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(ids_digests), pa.array(text_digests)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)
