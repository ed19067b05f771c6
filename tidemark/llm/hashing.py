"""Fingerprints of words, of runs of words, and the places of rows."""

from __future__ import annotations

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import WordCache, digest16, pick, stored

BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, so they have an inverse modulo 2**64
_INVERSES = tuple(pow(b, -1, 1 << 64) for b in BASES)


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the number."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of the bases and of their inverses, as many as were needed so far."""

    def __init__(self):
        self.n = -1

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = max(n, 2 * self.n, 1024)
            grow = lambda b: np.cumprod(np.array([1] + [b] * self.n, np.uint64), dtype=np.uint64)
            self.up = np.stack([grow(b) for b in BASES], 1)
            self.down = np.stack([grow(b) for b in _INVERSES], 1)
        return self.up[:n], self.down[:n + 1]


_powers = _Powers()


class Words:
    """The words of a text as numbers; any run of them has a 128-bit fingerprint, which
    is the same wherever the run stands."""

    def __init__(self, words: list[bytes], cache: WordCache):
        self.n = len(words)
        hashes = np.frombuffer(b"".join(map(cache.__getitem__, words)), "<u8").reshape(-1, 2)
        up, self.down = _powers(self.n)
        self.sums = np.zeros((self.n + 1, 2), np.uint64)
        np.cumsum(hashes * up, axis=0, out=self.sums[1:])

    def runs(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Fingerprints of the runs [begin, end), a row of two numbers each."""
        plain = (self.sums[end] - self.sums[begin]) * self.down[begin]
        return mix(plain + (end - begin).astype(np.uint64)[:, None])

    def windows(self, size: int) -> np.ndarray:
        """Fingerprints of all runs of a size, first halves only."""
        if self.n < size:
            return np.zeros(0, np.uint64)
        count = self.n - size + 1
        plain = (self.sums[size:, 0] - self.sums[:count, 0]) * self.down[:count, 0]
        return mix(plain + np.uint64(size))


def word_cache() -> WordCache:
    return WordCache(digest16, 200_000)


def binary16(pairs: np.ndarray):
    """Rows of two numbers as an Arrow column of 16 bytes each."""
    import pyarrow as pa

    data = np.ascontiguousarray(pairs.astype("<u8", copy=False)).tobytes()
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(pairs), [None, pa.py_buffer(data)]).cast(pa.binary())


PLACE = ["_file", "_at"]


def filed(df: DataFrame) -> DataFrame:
    """The frame itself if it is a plain read of files, else a stored copy: only then do
    its rows have places that stay the same from one reading to the next."""
    plan = df._jdf.queryExecution().analyzed() if hasattr(df, "_jdf") else None
    while plan is not None and plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.child()
    if plan is not None and plan.nodeName() == "LogicalRelation":
        try:
            df.select("_metadata.row_index").schema
            return df
        except AnalysisException:  # a format without row numbers
            pass
    return stored(df, "rows")


def with_place(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns of a ``filed`` frame, with the file and the row in it that a row
    is read from, which tell rows apart whatever they hold."""
    return pick(df, **columns).select(
        F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"), *columns)
