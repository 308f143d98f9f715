"""Helpers shared by the text operators: shared tables, batches of bounded size, words, columns."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tidemark import session

CHUNK_BYTES = 4 << 20
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SPACE = b" \t\n\x0b\x0c\r"


def read_documents(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch_name(df: DataFrame, wanted: str) -> str:
    """A column name that no column of the frame has, whatever its case."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


_scopes: list[list[str]] = []


@contextmanager
def scratch_scope() -> Iterator[list[str]]:
    """Collects the paths of scratch tables made inside, for who knows when they are not needed any more."""
    _scopes.append([])
    try:
        yield _scopes[-1]
    finally:
        _scopes.pop()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that all executors share."""
    path = session.fresh_path(spark, label)
    for scope in _scopes:
        scope.append(path)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read again: computed once, and safe from lost executors."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that this process wrote, wherever the shared folder lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is the empty text."""
    return [value or b"" for value in column.cast(pa.large_binary()).to_pylist()]


def text_sizes(column: pa.Array) -> list[int]:
    """Bytes of each text; null has none."""
    return pc.fill_null(pc.binary_length(column), 0).to_pylist()


def runs_of(sizes: list[int], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Cut a batch into runs of rows of at most `limit` bytes; a larger row is a run of its own."""
    begin, held = 0, 0
    for place, size in enumerate(sizes):
        if place > begin and held + size > limit:
            yield begin, place
            begin, held = place, 0
        held += size
    if begin < len(sizes):
        yield begin, len(sizes)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range (splitmix64's finalizer)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class HashArray:
    """Sorted hashes with a directory by their highest bits; `find` gives positions, or -1."""

    def __init__(self, codes: np.ndarray):
        hashes = mix(codes)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        bits = max(1, int(len(codes)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.starts = np.searchsorted(self.hashes, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)
        self.longest = int(np.diff(np.append(self.starts, len(codes))).max()) if len(codes) else 0

    def find(self, codes: np.ndarray) -> np.ndarray:
        found = np.full(len(codes), -1, dtype=np.int32)
        if len(self.hashes) == 0:
            return found
        hashes, left = mix(codes), np.arange(len(codes))
        at = self.starts[hashes >> self.shift]
        for _ in range(self.longest):
            here = self.hashes[np.minimum(at, len(self.hashes) - 1)]
            hit = here == hashes
            found[left[hit]] = at[hit]
            go = here < hashes
            go[at >= len(self.hashes) - 1] = False
            left, hashes, at = left[go], hashes[go], at[go] + 1
            if len(left) == 0:
                break
        return found


_powers = np.ones(1, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1


def _power_table(length: int) -> np.ndarray:
    global _powers
    if len(_powers) < length:
        size = max(1024, 1 << int(length).bit_length())
        _powers = np.full(size, _BASE, dtype=np.uint64)
        _powers[0] = 1
        _powers = np.multiply.accumulate(_powers)
    return _powers


_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACE)] = True
_FOLD = np.arange(256, dtype=np.uint64)
_FOLD[65:91] += 32
# A random-looking value per byte, so that words of different letters do not cancel out.
_BYTE_VALUE = mix(_FOLD + np.uint64(0x1234567))


# Everything but ASCII letters and the bytes of other characters parts words in this other reading.
NOT_LETTER = np.array([not (65 <= value <= 90 or 97 <= value <= 122 or value >= 128) for value in range(256)])


class Words:
    """Words of texts, A-Z lower-cased, split at ASCII space or other separators, by one pass over all bytes.

    `starts` and `ends` are places in the joined bytes, `bounds` holds for each text the index of its first word, with
    one index more for the end.
    """

    def __init__(self, texts: list[bytes], separator: np.ndarray = _IS_SPACE):
        joined = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
        space = separator[joined]
        before = np.concatenate([[True], space[:-1]])
        self.starts = np.flatnonzero(before & ~space)
        self.ends = np.flatnonzero(space & ~before)
        self.lengths = self.ends - self.starts
        sizes = np.array([len(text) + 1 for text in texts], dtype=np.int64)
        self.bounds = np.searchsorted(self.starts, np.concatenate([[0], np.cumsum(sizes)]))
        place = np.arange(len(joined), dtype=np.int64)
        edges = np.concatenate([[0], self.starts])
        place -= np.repeat(edges, np.diff(np.append(edges, len(joined))))
        values = _BYTE_VALUE[joined] * _power_table(int(place.max(initial=0)) + 1)[place]
        values[space] = 0
        # Sums of all bytes before, so that the sum of a word or of its first letters is a difference.
        self.sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(values, dtype=np.uint64)])

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        return mix(self.sums[self.ends] - self.sums[self.starts] + self.lengths.astype(np.uint64))

    def prefixes(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of the words of more than `size` bytes, and a hash of their first `size` bytes."""
        long = np.flatnonzero(self.lengths > size)
        first = self.starts[long]
        return long, mix(self.sums[first + size] - self.sums[first] + np.uint64(size << 32))


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of `width` words; all words as one run when there are fewer."""
    if len(words) == 0:
        return words
    width = min(width, len(words))
    total = np.zeros(len(words) - width + 1, dtype=np.uint64)
    for place in range(width):
        total = total * np.uint64(0xD6E8FEB86659FD93) + words[place : len(words) - width + 1 + place]
    return mix(total + np.uint64(width))
