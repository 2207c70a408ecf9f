"""Token ids of whole texts, as the tokenizers library gives them, by memos of short chunks.

Both kinds of tokenizer file let a text be cut at blanks: a token never reaches over the blank before a
word. So ids of a text are the ids of its chunks in a row, and most chunks have been met before.
"""

from __future__ import annotations

import array
import json
import re
from collections.abc import Iterable
from functools import lru_cache

from tokenizers import Tokenizer

from chatloom.llm.common import Memo

# The characters that the tokenizers' patterns take as white space.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_WORDS = re.compile(f"[^{WHITE}]+")
_RUNS = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
# A blank before more white space, or at the end, is part of a run that has to be seen as a whole.
BLANK_IN_RUN = re.compile(f" (?:[{WHITE}]|\\Z)")
_NOT_WHITE = re.compile("[\\x1c-\\x1f]")  # str.split() takes them for blanks, the patterns don't

# Letters and numbers up to U+024F, for which the patterns are written out here; texts
# with other characters go through the library's own splitter.
_LATIN = re.compile("[\\x00-\\u024f]*")
LETTERS = "A-Za-z\\xaa\\xb5\\xba\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u024f"
NUMBERS = "0-9\\xb2\\xb3\\xb9\\xbc-\\xbe"
SHORT_FORMS = "'s|'t|'re|'ve|'m|'ll|'d"
_WORD_PIECES = re.compile(f"[{LETTERS}]+|{SHORT_FORMS}|[{NUMBERS}]|[^{WHITE}{LETTERS}{NUMBERS}]+")
_BYTE_PIECES = re.compile(
    f"{SHORT_FORMS}| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{WHITE}{LETTERS}{NUMBERS}]+"
    f"|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
)


# Texts up to this length are split as a whole, longer ones chunk by chunk.
WHOLE = 1 << 20


def byte_of_symbol() -> dict[str, int]:
    """The byte-level alphabet: visible Latin-1 characters stand for themselves, the others follow."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


SYMBOLS = [symbol for symbol, _ in sorted(byte_of_symbol().items(), key=lambda item: item[1])]


def spelled(piece: str) -> str:
    """A piece in the byte-level alphabet, in which plain letters stand for themselves."""
    return piece if piece.isascii() and piece.isalpha() else "".join(map(SYMBOLS.__getitem__, piece.encode()))


class Encoder:
    """Cuts texts into chunks and sums up what a piece function says of their pretokens."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.spec = json.loads(self.library.to_str())
        self.special = {t["content"]: t["id"] for t in self.spec["added_tokens"]}
        self.drops_blanks = self.spec["normalizer"] is not None
        self.split = _WORD_PIECES if self.drops_blanks else _BYTE_PIECES
        # For words this memo does what plain did for chunks besides, so it has the room of both.
        self.pieces = Memo(lambda piece: self.piece(spelled(piece)), 600_000 if self.drops_blanks else 300_000)
        self.plain = Memo(self.chunk)
        self.spaced = Memo(lambda word: self.chunk(" " + word))

    def piece(self, piece: str):
        """What one pretoken, spelled in the byte-level alphabet, gives; here its ids as little-endian 32-bit numbers."""
        return array.array("I", [t.id for t in self.library.model.tokenize(piece)]).tobytes()

    def special_piece(self, token_id: int):
        return array.array("I", [token_id]).tobytes()

    def together(self, parts: Iterable):
        return b"".join(parts)

    def chunk(self, chunk: str):
        """A chunk's pretokens; strings of special tokens inside become those tokens."""
        for content, token_id in self.special.items():
            if content in chunk:
                left, right = chunk.split(content, 1)
                return self.together([self.chunk(left), self.special_piece(token_id), self.chunk(right)])
        if _LATIN.fullmatch(chunk):
            text = chunk.lower() if self.drops_blanks else chunk
            return self.together(map(self.pieces.__getitem__, self.split.findall(text)))
        normalizer = self.library.normalizer
        text = normalizer.normalize_str(chunk) if normalizer else chunk
        return self.together(self.piece(p) for p, _ in self.library.pre_tokenizer.pre_tokenize_str(text))

    def parts(self, text: str) -> Iterable:
        """What each chunk gives, in the order of the text."""
        if len(text) <= WHOLE and _LATIN.fullmatch(text) and not any(s in text for s in self.special):
            return map(self.pieces.__getitem__, self.split.findall(text.lower() if self.drops_blanks else text))
        if self.drops_blanks:
            words = _WORDS.findall(text) if _NOT_WHITE.search(text) else text.split()
            return map(self.plain.__getitem__, words)
        if BLANK_IN_RUN.search(text):
            return map(self.plain.__getitem__, _RUNS.findall(text))
        head, *words = text.split(" ")
        return self._after(head, words)

    def _after(self, head: str, words: list[str]) -> Iterable:
        if head:
            yield self.plain[head]
        yield from map(self.spaced.__getitem__, words)

    def ids(self, text: str) -> bytes:
        """All ids of a text as little-endian 32-bit numbers."""
        return b"".join(self.parts(text))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    return Encoder(path)
