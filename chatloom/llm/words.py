"""64-bit hashes of a text's words and word shingles, with numpy over whole texts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

# Blanks are [\x20\x09-\x0D].
BLANKS = b" \t\n\x0b\x0c\r"
IS_BLANK = np.zeros(256, bool)
IS_BLANK[list(BLANKS)] = True
BASE, FACTOR = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
BYTE_CODES = np.random.default_rng(2024).integers(1, 1 << 63, 256).astype(np.uint64) | np.uint64(1)
PIECE = 1 << 20


class _Powers:
    """Powers of BASE and of its inverse modulo 2**64, as far as texts have needed them."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            inverse = pow(BASE, -1, 1 << 64)
            self.up, self.down = (
                np.concatenate([[np.uint64(1)], np.full(n - 1, f, np.uint64)]).cumprod() for f in (BASE, inverse)
            )
        return self.up, self.down


_powers = _Powers()


def pieces(data: bytes, size: int = PIECE) -> Iterator[bytes]:
    """A long text cut at blanks, so that arrays stay small; a word longer than ``size`` stays whole."""
    at = 0
    while len(data) - at > size:
        cut = max(data.rfind(bytes([b]), at, at + size) for b in BLANKS)
        if cut <= at:
            later = [k for b in BLANKS if (k := data.find(bytes([b]), at + size)) >= 0]
            cut = min(later, default=len(data))
        yield data[at:cut]
        at = cut
    yield data[at:]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole number."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(FACTOR)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(BASE)
    return x ^ (x >> np.uint64(32))


def _hashes(data: bytes) -> np.ndarray:
    codes = np.frombuffer(data, np.uint8)
    blank = np.ones(len(codes) + 2, bool)
    blank[1:-1] = IS_BLANK[codes]
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers.upto(len(codes))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(BYTE_CODES[codes] * up[: len(codes)])])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_prefixes(codes: np.ndarray, breaks: Sequence[int] = (0,)) -> np.ndarray:
    """For every place in an array of bytes a hash of what stands between the last blank, or break, and it."""
    up, down = _powers.upto(len(codes))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(BYTE_CODES[codes] * up[: len(codes)])])
    places = np.arange(len(codes))
    starts = np.concatenate([[0], np.where(IS_BLANK[codes[:-1]], places[1:], 0)])
    starts[np.asarray(breaks)] = breaks
    starts = np.maximum.accumulate(starts)
    return mix((sums[:-1] - sums[starts]) * down[starts])


def word_hashes(text: str | bytes) -> np.ndarray:
    """A hash of every word, in order; words differ in more than the case of A to Z."""
    data = (text.encode() if isinstance(text, str) else text).lower()
    parts = [_hashes(p) for p in pieces(data)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def shingle_set(text: str | bytes, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the windows of ``width`` words; fewer words make one window of all."""
    words = word_hashes(text)
    if not len(words):
        return words
    width = min(width, len(words))
    windows = words[: len(words) - width + 1].copy()
    for k in range(1, width):
        windows *= np.uint64(FACTOR)
        windows += words[k : len(words) - width + 1 + k]
    windows = np.sort(mix(windows + np.uint64(width)))
    return windows[np.concatenate([[True], windows[1:] != windows[:-1]])]
