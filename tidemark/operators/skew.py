"""Windows that hold when one key owns a large share of the rows.

A window partitioned by a key puts all rows of that key into one task. So keys are
counted first, which combines before the shuffle and reads one column, and those
with more than ``HOT_ROWS`` rows are treated apart: their rows are cut into chunks of
equal size along the order, and what a chunk needs from its neighbours travels in
one extra boundary row. With no hot key the plan is the plain window.

Sizes: every key above ``HOT_ROWS`` is treated apart, so there is at most one per
5 million rows of the table: 200,000 in 1e12 rows. Whether their list is broadcast
is left to its size. There are as many chunks as shuffle partitions, and a key has at
most one boundary row for each. Only rows alike in all columns of the order stay
together.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F, types as T

from tidemark.session import new_folder

HOT_ROWS = 5_000_000


@dataclass(frozen=True)
class Heat:
    """The hot keys of a table, or None."""

    keys: DataFrame | None = None


CALM = Heat()


def find_hot(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> Heat:
    """Count rows per key and keep the keys above the limit.

    Best done on stored rows: on a derived frame the count computes what it derives
    from, so callers with a chain of operators find the keys once, at its start, and
    pass them along. A listed key stands for ``hot_rows`` rows, so the list is short and is
    fetched here, once; frames built from it then agree on it and can leave out what no hot
    key needs.
    """
    heavy = (
        df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > hot_rows).select(F.col(key).alias("_hot_key"))
    )
    rows = heavy.collect()
    return Heat(df.sparkSession.createDataFrame(rows, heavy.schema)) if rows else CALM


def resolve(df: DataFrame, key: str, hot: Heat | int) -> Heat:
    """Operators take either known hot keys or the number of rows that makes one."""
    return hot if isinstance(hot, Heat) else find_hot(df, key, hot)


def split_hot(df: DataFrame, key: str, heat: Heat) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary keys and rows of hot keys. NULL counts as a key."""
    listed = F.col(key).eqNullSafe(F.col("_hot_key"))
    return df.join(heat.keys, listed, "left_anti"), df.join(heat.keys, listed, "left_semi")


def _chunked(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Add ``_chunk``: equal shares of the rows along key and order, whatever the values.
    Stored, since the shares are drawn from a sample and all readers must agree on them."""
    spark = rows.sparkSession
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_folder(spark, "chunks")
    rows.repartitionByRange(shares, key, *order).withColumn("_chunk", F.spark_partition_id()).write.parquet(path)
    return spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("_chunk", T.IntegerType())])).parquet(path)


def _with_boundaries(
    df: DataFrame, key: str, rank: Column, only: Column | None, forward: bool
) -> DataFrame:
    """Add to every chunk one row of its neighbours, marked ``_carried``: going
    forward the row of greatest rank of all chunks before, otherwise the row of
    least rank of the chunk after. ``only`` limits which rows may be carried."""
    row = F.struct(*df.columns)
    if only is not None:
        rank = F.when(only, rank)
    along = Window.partitionBy(key).orderBy("_at")
    by_chunk = df.groupBy(key, F.col("_chunk").alias("_at"))
    if forward:
        edges = by_chunk.agg(F.max_by(row, rank).alias("_edge"), F.max(rank).alias("_edge_rank"))
        earlier = along.rowsBetween(Window.unboundedPreceding, -1)
        neighbour = F.max_by("_edge", "_edge_rank").over(earlier)
    else:
        edges = by_chunk.agg(F.min_by(row, rank).alias("_edge"))
        neighbour = F.lead("_edge").over(along)
    carried = edges.select("_at", neighbour.alias("_edge")).where(F.col("_edge").isNotNull())
    fields = [F.col("_at").alias("_chunk") if c == "_chunk" else F.col(f"_edge.{c}").alias(c) for c in df.columns]
    return df.withColumn("_carried", F.lit(False)).unionByName(
        carried.select(*fields, F.lit(True).alias("_carried"))
    )


def along_key(
    df: DataFrame, key: str, order: list[str], add: Callable[[WindowSpec], dict[str, Column]], *,
    hot: Heat | int, forward: bool = True, rank: list[str] | None = None, only: Column | None = None,
) -> DataFrame:
    """Add window columns over the rows of each key in order.

    ``add`` builds the columns from the window. ``forward`` is for columns that look
    back (lag, running values); those that look ahead (lead) need it False. ``rank``
    orders the rows that stand for a chunk, if other than ``order``.
    """
    heat = resolve(df, key, hot)
    if heat.keys is None:
        return df.withColumns(add(Window.partitionBy(key).orderBy(*order)))
    cold, warm = split_hot(df, key, heat)
    rows = _with_boundaries(
        _chunked(warm, key, order), key, F.struct(*(rank or order)), only, forward)
    # Carried rows come first when looking back and last when looking ahead.
    side = F.desc("_carried") if forward else F.asc("_carried")
    chunked = rows.withColumns(add(Window.partitionBy(key, "_chunk").orderBy(side, *order)))
    done = chunked.where(~F.col("_carried")).drop("_carried", "_chunk")
    return cold.withColumns(add(Window.partitionBy(key).orderBy(*order))).unionByName(done)


def with_key_value(df: DataFrame, key: str, hot: Heat | int, **aggregates: Column) -> DataFrame:
    """Add per-key aggregates to every row. Ordinary keys use one window; the few
    aggregates of hot keys are joined to their rows."""
    heat = resolve(df, key, hot)
    whole = Window.partitionBy(key)
    columns = {name: aggregate.over(whole) for name, aggregate in aggregates.items()}
    if heat.keys is None:
        return df.withColumns(columns)
    cold, warm = split_hot(df, key, heat)
    values = warm.groupBy(F.col(key).alias("_value_key")).agg(*[a.alias(n) for n, a in aggregates.items()])
    joined = warm.join(values, F.col(key).eqNullSafe(F.col("_value_key"))).drop("_value_key")
    return cold.withColumns(columns).unionByName(joined)


def left_join_many(left: DataFrame, right: DataFrame, key: str, hot: Heat | int) -> DataFrame:
    """Left join to a side that may repeat a key very often.

    An outer join cannot split the rows of one key on its optional side, an inner
    join can. So hot keys, which all have a match, are joined inner.
    """
    heat = resolve(right, key, hot)
    if heat.keys is None:
        return left.join(right, key, "left")
    cold_left, hot_left = split_hot(left, key, heat)
    cold_right, hot_right = split_hot(right, key, heat)
    joined = cold_left.join(cold_right, key, "left")
    return joined.unionByName(hot_left.join(hot_right, key))
