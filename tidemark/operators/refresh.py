"""History and marts that follow their sources at the cost of what changed.

``HistoryTable`` keeps the versions of customers. A batch of changes reads the buckets of its
own customers, works their versions out anew from the stored ones and the batch, and leaves all
other buckets alone. Stored versions carry what that takes: when the change arrived, which
decides between changes of one instant, and whether it was a deletion. So batches may be cut and
ordered in any way: late changes split a stored version, repeated ones change nothing.

``change_feed`` lists the rows that came and went between two commits of a table, from the
buckets whose files differ. ``refresh_mart`` applies it to a mart that is laid out by month: the months of
those rows are rewritten, without the keys of the feed and with what is derived from its new rows,
and the others keep their files. The mart's commit names the commit of the source that it stands for.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.operators import marts, staging
from tidemark.operators.quality import enforce_contract
from tidemark.operators.skew import HOT_ROWS, Heat
from tidemark.operators.state import BUCKETS, SEQ, ChangeTable, Head, Outcome, VersionedTable
from tidemark.schemas import CONTRACTS
from tidemark.session import new_folder

NO_MONTH = "none"  # of rows without a time


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class HistoryTable(VersionedTable):
    """Customer versions in hashed buckets, updated batch by batch."""

    HIDDEN = ("is_deleted", "arrival_seq")

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.asked = buckets
        contract = CONTRACTS["dim_customer"]
        schema = T.StructType([*contract.fields, T.StructField("is_deleted", T.BooleanType()), T.StructField("arrival_seq", SEQ)])
        super().__init__(spark, root, "dim_customer", schema, "bucket")

    def merge(self, changes: DataFrame, batch_id: str, *, hot: Heat | int = HOT_ROWS) -> Outcome:
        """Apply a batch of change records, which carry their ``arrival_seq``. A batch
        id that is already committed is left alone."""
        head = self.head(batch_id)
        if head.replayed:
            return Outcome(batch_id, 0, 0, replayed=True)
        if self.asked and head.buckets and self.asked != head.buckets:
            raise ValueError(f"{self.root} has {head.buckets} buckets, not {self.asked}")
        buckets = head.buckets or self.asked or BUCKETS
        bucket = F.pmod(F.xxhash64("customer_id"), F.lit(buckets)).cast("string")
        staged = staging.stg_customers(changes.withColumn("arrival_seq", F.col("arrival_seq").cast(SEQ)), "arrival_seq")
        batch = _kept(staged.withColumn("bucket", bucket), "history-batch")
        seen = batch.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()  # a line per bucket
        touched, offered = [r["bucket"] for r in seen], sum(r["n"] for r in seen)
        stored, customers = self.read(only=touched, head=head), batch.select("customer_id").distinct()
        # What is stored of the batch's customers, in the shape of staged changes.
        moved = stored.join(customers, "customer_id", "left_semi").withColumnRenamed("valid_from", "source_updated_at")
        needed = [c for c in moved.columns if c not in ("customer_sk", "valid_to", "is_current", "bucket")]
        again = marts.dim_customer_scd2(moved.select(*needed).unionByName(batch.select(*needed)), hot, keep=self.HIDDEN)
        others = stored.join(customers, "customer_id", "left_anti")
        rows = again.withColumn("bucket", bucket).select(*self.schema.fieldNames()).unionByName(others.select(*self.schema.fieldNames()))
        return self.replace(rows, batch_id, touched, head=head, offered=offered, count_applied=False, buckets=buckets)

    def current(self) -> DataFrame:
        """The dimension as its contract has it."""
        return self.read().select(*CONTRACTS["dim_customer"].fieldNames())


def differing_parts(old: Head, new: Head) -> list[str]:
    """Partition values whose files are not the same in both."""
    return sorted(p for p in {*old.parts, *new.parts} if old.parts.get(p) != new.parts.get(p))


def change_feed(table: ChangeTable, since: int, until: Head | None = None) -> DataFrame:
    """Rows of the table's state that went (``_change`` out) or came (in) after a commit.

    Only buckets whose files differ are read. An updated row goes and comes; one that was
    written again as it was does neither. States of mutable sources have one row per key: where
    nothing was before, all rows came, and else both sides of a key meet in a join, for which
    reduced states lie right already. Rows without a key, and those of other sources, meet in an aggregate.
    """
    old, new = table.head_at(since), until or table.head()
    parts, key, columns = differing_parts(old, new), table.source.key, table.source.columns

    if table.source.mutable and not old.parts:
        return table.state(new, parts).select(*columns, F.lit("in").alias("_change"))

    def side(head: Head, name: str, which: Column) -> DataFrame:
        rows = table.state(head, parts).where(which).select(F.col(key).alias("_key"), F.struct(*columns).alias("_row"))
        return rows.select("_key", *[F.col("_row").alias(n) if n == name else F.lit(None).cast(rows.schema["_row"].dataType).alias(n)
                                     for n in ("_out", "_in")])

    joined = F.col(key).isNotNull() if table.source.mutable else F.lit(False)
    both = (
        side(old, "_out", ~joined).unionByName(side(new, "_in", ~joined)).groupBy("_key")
        .agg(F.first("_out", ignorenulls=True).alias("_out"), F.first("_in", ignorenulls=True).alias("_in"))
    )
    if table.source.mutable:
        # The keys keep their names up to the join, so that an exchange for the reduction serves it too.
        was, now = (table.state(head, parts).where(joined).select(key, F.struct(*columns).alias(name)) for head, name in ((old, "_out"), (new, "_in")))
        both = was.join(now, key, "full").withColumnRenamed(key, "_key").unionByName(both)
    both = both.where(~F.col("_out").eqNullSafe(F.col("_in")))
    moves = F.explode(F.array(
        F.struct(F.lit("out").alias("_change"), F.col("_out").alias("_row")),
        F.struct(F.lit("in").alias("_change"), F.col("_in").alias("_row"))))
    return both.select(moves.alias("_move")).where("_move._row is not null").select("_move._row.*", "_move._change")


def month_of(ts: str) -> Column:
    return F.coalesce(F.date_format(ts, "yyyyMM"), F.lit(NO_MONTH))


def monthly_mart(spark: SparkSession, root: str, name: str) -> VersionedTable:
    return VersionedTable(spark, root, name, T.StructType(list(CONTRACTS[name].fields)), "month")


def stands_for(mart: VersionedTable) -> int:
    """The commit of its source that a mart was last refreshed from; 0 for a new one."""
    batch = mart.head().batch_id
    return int(batch.rsplit("@", 1)[1]) if batch else 0


def refresh_mart(
    table: ChangeTable, mart: VersionedTable, derive: Callable[[DataFrame], DataFrame], key: str, ts: str,
) -> list[str]:
    """Bring a monthly mart up to the source's newest commit; the months rewritten.

    ``derive`` makes rows of the mart from rows of the source, one from each, and keeps their
    ``key`` and the time ``ts`` that gives the month.
    """
    until = table.head()
    since, batch_id = stands_for(mart), f"{table.name}@{until.number}"
    if since == until.number:
        return []
    contract, names = CONTRACTS[mart.name], mart.schema.fieldNames()
    feed = change_feed(table, since, until)
    came = enforce_contract(derive(feed.where("_change = 'in'").drop("_change")), contract, mart.name)
    went = derive(feed.where("_change = 'out'").drop("_change")).select(*contract.fieldNames())
    moved = _kept(
        came.withColumn("_came", F.lit(True)).unionByName(went.withColumn("_came", F.lit(False)))
        .withColumn("month", month_of(ts)), "mart-feed")
    months = sorted(r["month"] for r in moved.select("month").distinct().collect())  # one line a month
    kept = mart.read(only=months).join(moved.select(key).distinct(), key, "left_anti")
    mart.replace(kept.select(*names).unionByName(moved.where("_came").select(*names)), batch_id, months, count_applied=False)
    return months


def backfill(
    sources: dict[str, tuple[ChangeTable, VersionedTable, Callable, str, str]], history: HistoryTable,
    corrections: dict[str, DataFrame], customers: DataFrame, batch_id: str,
) -> dict[str, list[str]]:
    """Apply corrected records of some days and carry them through the marts.

    ``sources`` names for each fact its source, its mart, and how ``refresh_mart`` derives it.
    What a correction touches follows from the rows it moves: the months of facts, and of the history
    the buckets of the customers. Per mart the parts that were rewritten; all others keep their files.
    """
    touched = {}
    for name, (table, mart, derive, key, ts) in sources.items():
        table.merge(corrections[name], batch_id)
        touched[mart.name] = refresh_mart(table, mart, derive, key, ts)
    before = history.head()
    history.merge(customers, batch_id)
    touched[history.name] = differing_parts(before, history.head())
    return touched
