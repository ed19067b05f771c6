"""What the operators share: input columns, stored steps, words, fingerprints, ranks.

Every operator first selects the columns that it needs under names of its own, so
further columns of the input never clash with them, whatever they are called.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.session import new_folder

WHITE = b" \t\n\x0b\x0c\r"  # bytes.split() and bytes.strip() use just these
CACHE_WORDS, CACHE_BYTES = 300_000, 24 << 20  # of a word cache; a full one starts again
LONG_WORD = 256  # longer words are not kept


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns only, under the given names."""
    at = {c: i for i, c in reversed(list(enumerate(df.columns)))}
    missing = [c for c in columns.values() if c not in at]
    if missing:
        raise ValueError(f"no columns {missing} among {df.columns}")
    plain = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"_c{at[c]}").alias(name) for name, c in columns.items()])


def only_rows(df: DataFrame, name: str, keep) -> DataFrame:
    """The rows that ``keep`` leaves, with all their columns as they came. ``keep`` takes
    and gives Arrow batches, in which the named column is called ``_text``."""
    if name not in df.columns:
        raise ValueError(f"no column {name!r} among {df.columns}")
    at = df.columns.index(name)
    plain = df.toDF(*["_text" if i == at else f"_c{i}" for i in range(len(df.columns))])
    return plain.mapInArrow(keep, plain.schema).toDF(*df.columns)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a step to the shared folder and read it again: later steps start from
    files, so a lost executor costs no earlier step, and a row keeps its place."""
    path = new_folder(df.sparkSession, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, key: str, order: list[str], name: str, ranges: int | None = None) -> DataFrame:
    """Add ``name``: 0, 1, 2 ... within each key, in the given order.

    A window over the key would put all its rows into one task. Instead rows are
    dealt by ranges of (key, order), numbered inside each range, and moved up by the
    rows of the ranges before, of which there is one count per range and key. The
    order must tell all rows apart.
    """
    ranged = df.repartitionByRange(ranges or shuffle_width(df.sparkSession), key, *order)
    ranged = stored(ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy(key, "_range").orderBy(*order)
    before = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy(key, "_range").agg(F.count(F.lit(1)).alias("_rows"))
        .select(key, "_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    return (
        ranged.withColumn("_local", F.row_number().over(inside).cast("long") - 1)
        .join(starts, [key, "_range"])
        .withColumn(name, F.col("_local") + F.col("_before"))
        .drop("_local", "_before", "_range")
    )


class WordCache(dict):
    """What a function gives for a word, kept for the words seen lately: so many words
    and so many bytes of them at most, none of them long."""

    def __init__(self, make, limit: int = CACHE_WORDS, most: int = CACHE_BYTES):
        super().__init__()
        self.make, self.limit, self.most, self.held = make, limit, most, 0

    def clear(self):
        super().clear()
        self.held = 0

    def __missing__(self, word):
        value = self.make(word)
        if len(word) <= LONG_WORD:
            if len(self) >= self.limit or self.held > self.most:
                self.clear()
            self.held += len(word)
            self[word] = value
        return value


@contextlib.contextmanager
def uncollected() -> Iterator[None]:
    """For steps that make very many strings and no cycles: without the search for cycles, which
    would walk through all of them again and again. What is no longer used goes at once even so."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def give_back() -> None:
    """Return freed memory to the machine."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def lean(call):
    """For functions over Arrow batches: worker processes outlive tasks, so what a task has used
    is given back at its end and doesn't add up with what the next stage needs."""
    @functools.wraps(call)
    def run(self, batches):
        try:
            yield from call(self, batches)
        finally:
            give_back()
    return run


def digest16(word: bytes) -> bytes:
    return hashlib.blake2b(word, digest_size=16).digest()


def texts(batch, name: str) -> list[bytes]:
    """A text column of an Arrow batch as UTF-8 bytes, null as empty."""
    import pyarrow as pa

    column = batch.column(name)
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if t is None else t for t in column.cast(kind).to_pylist()]


def slices(batches: Iterable, name: str, most: int = 8 << 20) -> Iterator:
    """Arrow batches cut so that each holds one row or at most so many text bytes."""
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False))
        begin, total = 0, 0
        for row, size in enumerate(sizes):
            if total and total + size > most:
                yield batch.slice(begin, row - begin)
                begin, total = row, 0
            total += int(size)
        yield batch.slice(begin)
