"""Change-data-capture upserts as order-free reductions.

A change log carries ``arrival_seq``, the order in which records arrived. Applying
records one at a time, each guarded by the time of the row already stored, equals
one of three reductions per key:

* customers: the whole row of the greatest (event time, arrival);
* orders: updatable columns of the greatest (event time, arrival), the others of
  the first arrival;
* subscriptions: the stored event time never moves, so every later arrival that is
  not older than the first one wins, the last of them finally.

All of them combine before the shuffle, so a key with any number of changes sends
one row per task. For subscriptions that takes two steps, as which changes count depends on the
first arrival: the first and the last arrival of each key are found first, and where the last
one is not older than the first it has won. Only keys whose last arrival came too late are
looked through again, for the last arrival that did not. State rows carry the first and last arrival they stand for
(``_first_seq``, ``_last_seq``), which closes the reductions: state plus new
changes reduces to the same state as the full log.

Rows that lie dealt by a function of their key, in a column that ``dealt`` names, are reduced
where they are, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.operators.skew import HOT_ROWS, Heat, along_key, with_key_value
from tidemark.schemas import SOURCES, Source
from tidemark.session import new_folder

LATEST = ("_last_seq", "_commit_no", "_ingested_at", "_moving")  # follow the last change applied


def as_changes(log: DataFrame) -> DataFrame:
    """A change log in the shape of state rows."""
    return log.withColumn("_first_seq", F.col("arrival_seq")).withColumnRenamed("arrival_seq", "_last_seq")


def _public(state: DataFrame, source: Source) -> DataFrame:
    return state.select(*source.columns)


def _newest(rows: DataFrame, key: list[str], *order) -> DataFrame:
    """First row per key in the given order. The rank limit runs before the shuffle."""
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def reduce_customers(rows: DataFrame, *dealt: str) -> DataFrame:
    s = SOURCES["customers"]
    return _newest(rows, [*dealt, s.key], F.desc(s.ts), F.desc("_last_seq"))


def reduce_orders(rows: DataFrame, *dealt: str) -> DataFrame:
    s = SOURCES["orders"]
    fixed = [c for c in rows.columns if c not in (*s.mutable, *dealt, s.key, *LATEST)]
    moving = [c for c in rows.columns if c not in (*fixed, *dealt, s.key)]
    reduced = rows.groupBy(*dealt, s.key).agg(
        F.min_by(F.struct(*fixed), "_first_seq").alias("_first"),
        F.max_by(F.struct(*moving), F.struct(s.ts, "_last_seq")).alias("_last"),
    )
    return reduced.select(*dealt, s.key, "_first.*", "_last.*").select(*rows.columns)


def unsettled_subscriptions(rows: DataFrame) -> DataFrame | None:
    """Keys whose last arrival is older than their first, with the time of the first
    (``_guard``); None if there are none. Stored, so a join with them knows their size."""
    s = SOURCES["subscriptions"]
    ends = rows.groupBy(s.key).agg(
        F.min_by(s.ts, "_first_seq").alias("_guard"), F.max_by(s.ts, "_last_seq").alias("_tail"))
    found, path = ends.where("_tail < _guard").select(F.col(s.key).alias("_open_key"), "_guard"), new_folder(rows.sparkSession, "unsettled")
    found.write.parquet(path)
    kept = rows.sparkSession.read.schema(found.schema).parquet(path)
    return None if kept.isEmpty() else kept


def reduce_subscriptions(rows: DataFrame, *dealt: str) -> DataFrame:
    s = SOURCES["subscriptions"]
    moving = [c for c in rows.columns if c in (*s.mutable, *LATEST)]
    fixed = [c for c in rows.columns if c not in (*moving, *dealt, s.key)]
    if dealt:  # the rows of a key lie together, so each sees the ends
        of_key = Window.partitionBy(*dealt, s.key)
        guarded = rows.withColumns({
            "_guard": F.min_by(s.ts, "_first_seq").over(of_key), "_tail": F.max_by(s.ts, "_last_seq").over(of_key)})
        too_late = F.col(s.key).isNotNull() & (F.col("_tail") < F.col("_guard")) & ~F.coalesce(F.col(s.ts) >= F.col("_guard"), F.lit(False))
        return guarded.groupBy(*dealt, s.key).agg(
            F.min_by(F.struct(*fixed), "_first_seq").alias("_first"),
            F.max_by(F.struct(*moving), F.when(~F.coalesce(too_late, F.lit(False)), F.col("_last_seq"))).alias("_last"),
        ).select(*dealt, s.key, "_first.*", "_last.*").select(*rows.columns)
    last = F.max_by(F.struct(*moving), "_last_seq").alias("_last")
    ends = rows.groupBy(s.key).agg(F.min_by(F.struct(*fixed), "_first_seq").alias("_first"), last)
    unsettled = unsettled_subscriptions(rows)
    if unsettled is not None:
        # One row per key on the right: adaptive execution can split the left.
        accepted = rows.join(unsettled, F.col(s.key) == F.col("_open_key")).where(F.col(s.ts) >= F.col("_guard"))
        winners = accepted.groupBy("_open_key").agg(last.alias("_won"))
        ends = ends.join(winners, F.col(s.key) == F.col("_open_key"), "left").withColumn("_last", F.coalesce("_won", "_last"))
    return ends.select(s.key, "_first.*", "_last.*").select(*rows.columns)


def reduce_events(rows: DataFrame, *dealt: str) -> DataFrame:
    return _newest(rows, [*dealt, SOURCES["events"].key], F.asc("_first_seq"))


REDUCERS = {
    "customers": reduce_customers,
    "orders": reduce_orders,
    "subscriptions": reduce_subscriptions,
    "events": reduce_events,
}


def upsert_customers(log: DataFrame) -> DataFrame:
    return _public(reduce_customers(as_changes(log)), SOURCES["customers"])


def upsert_orders(log: DataFrame) -> DataFrame:
    return _public(reduce_orders(as_changes(log)), SOURCES["orders"])


def upsert_subscriptions(log: DataFrame) -> DataFrame:
    return _public(reduce_subscriptions(as_changes(log)), SOURCES["subscriptions"])


def insert_events(log: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """First arrival of each event that is not stored yet."""
    s = SOURCES["events"]
    fresh = reduce_events(as_changes(log))
    if stored is not None:
        fresh = fresh.join(stored.select(s.key), s.key, "left_anti")
    return _public(fresh, s)


def live_rows(state: DataFrame) -> DataFrame:
    return state.where(~F.col("_is_deleted"))


def tombstones(state: DataFrame) -> DataFrame:
    return state.where(F.col("_is_deleted"))


def reject_stale(
    log: DataFrame, key: str, ts: str, hot: Heat | int = HOT_ROWS
) -> DataFrame:
    """Records the guard ignored: older than what was stored when they arrived.

    For sources whose stored time moves, that is the greatest time among all earlier
    arrivals of the key, so a chunk needs the newest record of all earlier chunks.
    Records that arrive together count from the oldest to the newest.
    """
    def stored(window):
        return {"stored_at": F.max(ts).over(window.rowsBetween(Window.unboundedPreceding, -1))}

    judged = along_key(
        log, key, ["arrival_seq", ts], stored, hot=hot,
        rank=[ts, "arrival_seq"])
    return judged.where(F.col(ts) < F.col("stored_at"))


def reject_stale_subscriptions(log: DataFrame, hot: Heat | int = HOT_ROWS) -> DataFrame:
    """Subscription records older than the first arrival of their key."""
    s = SOURCES["subscriptions"]
    judged = with_key_value(log, s.key, hot, stored_at=F.min_by(s.ts, "arrival_seq"))
    return judged.where(F.col(s.ts) < F.col("stored_at"))
