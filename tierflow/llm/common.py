"""Helpers that the operators share: staging, row batches and vectorised word hashing."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space of every text contract here.
WHITE_SPACE = r"[\x20\x09-\x0D]"
_WHITE_BYTES = (0x20, *range(0x09, 0x0E))

# Rows are worked on in groups of about this many bytes, so that the arrays stay small.
GROUP_BYTES = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the session's shared checkpoint folder and read it back (see `storage.stage`)."""
    # imported here: executors get this module by value and need not have the library
    from tierflow import storage

    return storage.stage(df, f"llm-{label}")


def whole_text(text: str = "text") -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def groups_of_rows(sizes: list[int], limit: int = GROUP_BYTES) -> Iterator[slice]:
    """Slices of rows of about ``limit`` in all; a larger row is alone."""
    start = total = 0
    for row, size in enumerate(sizes):
        if row > start and total + size > limit:
            yield slice(start, row)
            start, total = row, 0
        total += size
    if start < len(sizes):
        yield slice(start, len(sizes))


def texts_in_groups(column: pa.Array, limit: int = GROUP_BYTES) -> Iterator[tuple[slice, list[str]]]:
    """The texts of a column, null as empty, in groups of about ``limit``; only one group is held as strings."""
    lengths = pc.fill_null(pc.utf8_length(column), 0).to_pylist()
    for rows in groups_of_rows(lengths, limit):
        yield rows, [t or "" for t in column.slice(rows.start, rows.stop - rows.start).to_pylist()]


# ---- hashing --------------------------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed 64-bit numbers that look random."""
    return mix(np.uint64(seed) + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


_LOWER = np.arange(256)
_LOWER[65:91] += 32
_BYTE_VALUES = _stream(1, 256)[_LOWER]
_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[list(_WHITE_BYTES)] = True
_IS_MARK = _IS_WHITE.copy()
_IS_MARK[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
_PLACE = _stream(2, 64) | np.uint64(1)


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            self.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _BASE)]), dtype=np.uint64)
            self.down = np.cumprod(
                np.concatenate([[np.uint64(1)], np.full(size - 1, inverse)]), dtype=np.uint64
            )
        return self.up, self.down


_POWERS = _Powers()


def word_hashes(texts: list[str], marks_part: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in a row, and where each text's words begin.

    Words are maximal runs without white space, A to Z in lower case; with ``marks_part`` ASCII punctuation
    parts words too. The second array has one entry more than there are texts. Equal words have equal hashes on
    every machine.
    """
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join([*parts, b""]), np.uint8)
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    inside = ~(_IS_MARK if marks_part else _IS_WHITE)[data]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    starts, ends = edges[::2], edges[1::2]  # the data end in white space, so every word has an end
    up, down = _POWERS.to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    text_starts = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])])
    return hashes, np.searchsorted(starts, text_starts)


def run_hashes(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """64-bit hashes of runs of 64-bit values; ``bounds`` has where each run begins, and where the last ends."""
    up, down = _POWERS.to(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    starts, ends = bounds[:-1], bounds[1:]
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each position on; order counts. Short inputs give none."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(width):
        total += words[j : j + n] * _PLACE[j]
    return mix(total)


def sequence_hash(words: np.ndarray) -> np.uint64:
    """Hash of a whole short sequence, apart from those of longer shingles."""
    return mix(np.atleast_1d((words * _PLACE[32 : 32 + len(words)]).sum(dtype=np.uint64)))[0]


def text_hash(text: str) -> int:
    """A signed 64-bit digest of a text."""
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)
