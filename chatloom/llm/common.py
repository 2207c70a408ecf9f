"""What the operators share: columns as they need them, memos of bounded size, shared files."""

from __future__ import annotations

import array
from collections.abc import Callable, Hashable, Iterable
from typing import Any

import numpy as np
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: what separates words, [\x20\x09-\x0D]. bytes.split() without argument splits on the same.
BLANK = r"[\x20\x09-\x0D]"


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of an id's decimal text modulo ``n``: the fold a document belongs to."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(n)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (bigint) and the text, null as empty; other columns never reach a worker."""
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def unused(name: str, columns: Iterable[str]) -> str:
    """``name``, with as many underscores before it as no column of that name takes."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


class Memo(dict):
    """A dict that makes missing values and holds at most about ``limit``; long keys are not kept.

    When half of that is full it becomes the older half, from which values in use come back, and the
    one before is forgotten.
    """

    def __init__(self, make: Callable[[Any], Any], limit: int = 300_000, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest, self.older = make, limit, longest, {}

    def __missing__(self, key: Hashable) -> Any:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if not isinstance(key, (str, bytes)) or len(key) <= self.longest:
            if 2 * len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a shared folder and the path in it; local files are memory-mapped."""
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(use_mmap=True), uri
    return fs.FileSystem.from_uri(uri)


class AtomicFile:
    """Write under a task attempt's own name and rename at the end: retries and twins do no harm."""

    def __init__(self, uri: str, attempt: int):
        self.fs, self.path = file_system(uri)
        self.own = f"{self.path}.attempt-{attempt}"
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.stream = self.fs.open_output_stream(self.own)

    def __enter__(self):
        return self.stream

    def __exit__(self, kind, *_):
        self.stream.close()
        if kind is None:
            self.fs.move(self.own, self.path)
        else:
            self.fs.delete_file(self.own)


def _planes(numbers: np.ndarray) -> bytes:
    """The low bytes of 32-bit numbers, then the next: as most numbers are small, this compresses well."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def pack(parts: list[bytes], level: int = 9) -> bytes:
    """A list of byte strings, compressed: their number and lengths, then all of them. Lists of 32-bit
    numbers are stored by planes."""
    lengths, data = np.array(list(map(len, parts)), np.uint32), b"".join(parts)
    numbers = not (lengths % 4).any()
    head = array.array("I", [len(parts), numbers]).tobytes() + _planes(lengths)
    return zstandard.compress(head + (_planes(np.frombuffer(data, np.uint32)) if numbers else data), level)


def unpack(packed: bytes) -> list[bytes]:
    whole = zstandard.decompress(packed)
    n, numbers = array.array("I", whole[:8])
    data = whole[8 + 4 * n :]
    data = _from_planes(data).tobytes() if numbers else data
    ends = np.cumsum(_from_planes(whole[8 : 8 + 4 * n]), dtype=np.int64).tolist()
    return [data[i:j] for i, j in zip([0, *ends], ends)]


def pack_numbers(numbers: np.ndarray, level: int = 9) -> bytes:
    """32-bit numbers, compressed."""
    return zstandard.compress(_planes(numbers), level)


def unpack_numbers(packed: bytes) -> np.ndarray:
    return _from_planes(zstandard.decompress(packed))
