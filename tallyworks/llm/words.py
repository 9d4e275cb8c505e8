"""Words of texts, their hashes, and batches of bounded size, for code that runs inside Spark tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

# Texts that are worked on at once have about this many bytes, or are one long text.
BYTES_AT_ONCE = 1_500_000
# Entries of a cache that lives as long as a Python worker.
CACHE_ENTRIES = 300_000

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` has such a column."""
    while name in df.columns:
        name += "_"
    return name


def words_of(text: bytes) -> list[bytes]:
    """Runs of ``[^\\x20\\x09-\\x0D]`` in UTF-8: what ``bytes.split`` gives."""
    return text.split()


def slices(batch: pa.RecordBatch, column: str = "text", at_once: int = BYTES_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """``batch`` in pieces of at least one row and about ``at_once`` bytes of ``column``."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = (np.cumsum(sizes, dtype=np.int64) - sizes) // at_once
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def encoded(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The UTF-8 of each text; null counts as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


class WordHashes(dict):
    """64-bit hashes of words, by word; forgets all when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads each bit over all."""
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


def shingle_hashes(words: list[bytes], width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles.

    Fewer words make one shingle of the whole sequence; no words make none.
    """
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    own = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    span = min(width, n)
    out = own[: n - span + 1] + np.uint64(span)
    for j in range(1, span):
        out = mixed(out) + own[j : n - span + 1 + j]
    return np.unique(mixed(out))
