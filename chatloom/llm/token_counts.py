"""Token counts by dynamic programming over prefixes.

The encoding of a prefix ends in exactly one token; without it, what is left is the encoding of a
shorter prefix. So one pass from left to right, which stores the last token and the count of every
prefix, gives the exact count of all prefixes at once, and questions about truncation and budgets are
answered from stored counts.
"""

from __future__ import annotations

import array
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from chatloom.llm.common import Memo, id_and_text
from chatloom.llm.encoding import _LATIN, _RUNS, _WORDS, SYMBOLS, WHITE, Encoder

NEVER = 1 << 60
_BLANKS = re.compile(f"^[{WHITE}]+")


class PrefixCounter(Encoder):
    """Counts of pretokens, chunks and texts; :meth:`prefixes` holds all prefixes of a pretoken."""

    def __init__(self, path: str):
        super().__init__(path)
        model = self.spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        vocab = model["vocab"]
        self.halves, self.rank, self.pair_rank = {}, {}, {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b, whole = vocab[left], vocab[right], vocab[left + right]
            self.pair_rank[a, b] = rank
            self.halves[whole], self.rank[whole] = (a, b), rank
        self.stable = Memo(lambda pair: self.holds(*pair), limit=400_000)
        sound: dict[int, bool] = {}  # a token that merging never yields ends no prefix
        for token in sorted(vocab.values(), key=lambda t: self.rank.get(t, -1)):
            a, b = self.halves.get(token, (None, None))
            sound[token] = a is None or (sound[a] and sound[b] and self.holds(a, b, self.rank[token]))
        # Spelling: the token of these symbols inside a pretoken, the one at its end (or None).
        self.tokens: dict[str, tuple] = {}
        for spelling, token in vocab.items():
            if sound[token] and not self.suffix:
                self.tokens[spelling] = token, token
            elif sound[token]:
                ends, plain = spelling.endswith(self.suffix), spelling.removesuffix(self.suffix)
                inner, final = self.tokens.get(plain, (None, None))
                self.tokens[plain] = (inner, token) if ends else (token, final)
        self.longest = max(map(len, self.tokens))

    def holds(self, a: int, b: int, below: int = NEVER) -> bool:
        """Whether tokens a, b stay side by side when their symbols are merged; ``below`` leaves
        merges of that rank and above out.

        Undo the youngest merge at the border, again and again: at no time may the symbols that meet
        there have merged before the next merge took one of them. A merge on the left goes first.
        """
        left_until = right_until = below
        while True:
            rank = self.pair_rank.get((a, b), NEVER)
            if rank < left_until and (rank < right_until or rank == right_until < below):
                return False
            rank_a, rank_b = self.rank.get(a, -1), self.rank.get(b, -1)
            if rank_a < 0 and rank_b < 0:
                return True
            if rank_a > rank_b:
                a, left_until = self.halves[a][1], rank_a
            else:
                b, right_until = self.halves[b][0], rank_b

    def prefixes(self, piece: str) -> array.array:
        """Exact number of tokens of piece[:1], piece[:2] ... if the text ended there."""
        find, stable = self.tokens.get, self.stable
        last, count, cut = [0], [0], array.array("I")
        for end in range(1, len(piece) + 1):
            token = number = 0
            for start in range(max(0, end - self.longest), end):
                if (found := find(piece[start:end])) is None:
                    continue
                inner, final = found
                if not token and inner is not None and (not start or stable[last[start], inner]):
                    last.append(inner)
                    count.append(count[start] + 1)
                    token = 1
                if not number and final is not None and (not start or stable[last[start], final]):
                    number = count[start] + 1
                if token and number:
                    break
            else:
                raise ValueError(f"no token ends at {end} of {piece!r}")
            cut.append(number)
        return cut

    def piece(self, piece: str) -> int:
        return self.prefixes(piece)[-1] if piece else 0

    def special_piece(self, token_id: int) -> int:
        return 1

    def together(self, parts) -> int:
        return sum(parts)

    def count(self, text: str) -> int:
        return sum(self.parts(text))

    def fit(self, text: str, budget: int) -> int:
        """Characters in the longest prefix with at most ``budget`` tokens."""
        total = 0
        for run in (_WORDS if self.drops_blanks else _RUNS).finditer(text):
            n = self.plain[run[0]]
            if total + n > budget:
                return run.start() + self.fit_chunk(run[0], budget - total)
            total += n
        return len(text)

    def fit_chunk(self, chunk: str, budget: int) -> int:
        """The same within one chunk, from the stored counts of its pretokens' prefixes.

        Pretokens before the cut are as in the whole chunk, so only the one that the budget ends in is looked
        at. Texts whose letters change in number when normalized are tried cut by cut.
        """
        for content in self.special:
            if content in chunk:
                left, right = chunk.split(content, 1)
                rest = budget - self.chunk(left) - 1
                if rest >= 0:
                    return len(left) + len(content) + self.fit_chunk(right, rest)
                return self.fit_chunk(chunk[: len(left) + len(content) - 1], budget)
        spans = self.spans(chunk)
        if spans is None:
            return next(e for e in range(len(chunk), -1, -1) if self.chunk(chunk[:e]) <= budget)
        before, blank = 0, len(chunk) - len(_BLANKS.sub("", chunk))
        for start, end, piece in spans:
            counts = self.prefixes(piece)
            if before + counts[-1] > budget:
                cut = self._last_cut(chunk, start, end, counts, before, budget)
                return cut if cut > blank else self._blank_cut(chunk[:blank], budget)
            before += counts[-1]
        return len(chunk)

    def _blank_cut(self, blanks: str, budget: int) -> int:
        """The last cut in the white space a chunk starts with: what is left of it is one pretoken."""
        counts = self.prefixes("".join(map(SYMBOLS.__getitem__, blanks.encode()))) if blanks else ()
        sizes = accumulate(len(c.encode()) for c in blanks)
        return max((cut for cut, size in enumerate(sizes, 1) if counts[size - 1] <= budget), default=0)

    def spans(self, chunk: str) -> list[tuple[int, int, str]] | None:
        """Where the pretokens of a chunk stand, and their symbols; None if a place has no one place there."""
        if _LATIN.fullmatch(chunk):
            text = chunk.lower() if self.drops_blanks else chunk
            if len(text) != len(chunk):
                return None
            found = self.split.finditer(text)
            return [(*m.span(), "".join(map(SYMBOLS.__getitem__, m[0].encode()))) for m in found]
        if self.drops_blanks:
            return None
        return [(start, end, piece) for piece, (start, end) in self.library.pre_tokenizer.pre_tokenize_str(chunk)]

    def _last_cut(self, chunk: str, start: int, end: int, counts: array.array, before: int, budget: int) -> int:
        """The last place from ``start`` on, before ``end``, where the text can be cut."""
        sizes = list(accumulate(len(c.encode()) for c in chunk[start:end]))
        for cut in range(end - 1, start, -1):
            part = chunk[start:cut]
            if part[0] == "'" and end - start <= 3:  # what is left of a short form splits otherwise
                n = before + self.chunk(part)
            else:
                n = before + counts[sizes[cut - start - 1] - 1]
            if n <= budget:
                return cut
        return start


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def token_counts(
    docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and fit_chars of every document.

    ``fit_chars`` is how many characters of the text can be kept within ``limit`` tokens. Null and
    empty texts have 0 bytes and tokens; a null id stays null; repeated rows stay; other columns are
    left out. Texts are read batch by batch and a worker's memos are bounded.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(path)
        for batch in batches:
            texts = batch["text"]
            sizes, counts, fits = [], [], []
            for scalar in texts:
                text = scalar.as_py()
                sizes.append(len(text) if text.isascii() else len(text.encode()))
                counts.append(tokens.count(text))
                fits.append(tokens.fit(text, limit) if counts[-1] > limit else len(text))
            yield pa.record_batch(
                [
                    batch["doc_id"],
                    pa.array(sizes, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([n > limit for n in counts], pa.bool_()),
                    pa.array(fits, pa.int64()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"],
            )

    schema = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean, fit_chars bigint"
    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)
