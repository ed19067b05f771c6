"""Incremental extraction: marks, lookback, late data and the commit log."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions.dates import effective_mark, ntz
from tidemark.schemas import EPOCH, SOURCES


def since(df: DataFrame, ts: str, mark: datetime, *, inclusive: bool = False) -> DataFrame:
    """Rows after the mark. The comparison stays on the bare column so that it
    reaches the file scan."""
    bound = ntz(mark)
    return df.where(F.col(ts) >= bound if inclusive else F.col(ts) > bound)


def extract_incremental(df: DataFrame, ts: str, mark: datetime) -> DataFrame:
    return since(df, ts, mark)


def extract_lookback(df: DataFrame, ts: str, mark: datetime, lookback: timedelta) -> DataFrame:
    """Re-read the lookback before the mark too; its start is included."""
    return since(df, ts, effective_mark(mark, lookback), inclusive=True)


def extract_full(df: DataFrame, ts: str) -> DataFrame:
    return since(df, ts, EPOCH)


def first_batch(df: DataFrame, ts: str, key: str, n: int) -> DataFrame:
    """The n earliest rows. The key breaks ties, so the batch is the same each time."""
    return df.orderBy(ts, key).limit(n)


def batch_metadata(df: DataFrame, source: str, ts: str, start: datetime, op: str | None = "_source_op") -> DataFrame:
    """One row: counts by kind of change and the marks the batch spans.

    A record without a kind is an insert. An empty batch ends where it started.
    """
    kind = F.coalesce(F.col(op), F.lit("I")) if op else F.lit("I")
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(kind == "I").alias("inserts_count"),
        F.count_if(kind == "U").alias("updates_count"),
        F.count_if(kind == "D").alias("deletes_count"),
        F.coalesce(F.max(ts), ntz(start)).alias("end_watermark"),
    ).select(
        F.lit(source).alias("source_name"),
        ntz(start).alias("start_watermark"),
        "end_watermark", "row_count", "inserts_count", "updates_count", "deletes_count",
    )


def stamp_batch(df: DataFrame, batch_id: str, ingested_at: Column | None = None) -> DataFrame:
    """Name the batch on records that carry no batch of their own."""
    present = F.nullif(F.col("_batch_id"), F.lit("")) if "_batch_id" in df.columns else F.lit(None).cast("string")
    stamped = df.withColumn("_batch_id", F.coalesce(present, F.lit(batch_id)))
    return stamped if ingested_at is None else stamped.withColumn("_ingested_at", ingested_at)


def advance_watermark(df: DataFrame, ts: str, current: datetime) -> DataFrame:
    """The mark after this batch. It never moves back."""
    return df.agg(F.greatest(F.max(ts), ntz(current)).alias("watermark"))


def late_report(df: DataFrame, ts: str, mark: datetime, lookback: timedelta) -> DataFrame:
    """Classify rows against the committed mark."""
    back = ntz(effective_mark(mark, lookback))
    return df.withColumn(
        "arrival",
        F.when(F.col(ts) > ntz(mark), "ON_TIME").when(F.col(ts) >= back, "LATE_WITHIN_LOOKBACK").otherwise("TOO_LATE"),
    )


GROWTH = 1.02  # from one bin of lateness to the next: a lookback read from bins is at most 2 % and a second too long


def lateness_bins(batch: DataFrame, ts: str, mark: datetime | Column | str) -> DataFrame:
    """How late the rows of a batch came behind the mark they met, as counts in bins
    (``bin``, ``row_count``): 0 for rows after the mark, others by the logarithm of their seconds.

    The bins are a sketch that adds up: those of any batches together are their sums, in
    any order, so one small row set a batch is all that has to be kept. There are about 1,200
    bins for a lateness of 300 years.
    """
    behind = ntz(mark) if isinstance(mark, datetime) else F.col(mark) if isinstance(mark, str) else mark
    micros = F.unix_micros(behind.cast("timestamp")) - F.unix_micros(F.col(ts).cast("timestamp"))
    seconds = F.greatest(F.ceil(micros / 1_000_000), F.lit(1))
    late = F.ceil(F.log(seconds) / F.log(F.lit(GROWTH))).cast("int") + 1
    return batch.where(F.col(ts).isNotNull()).groupBy(F.when(micros < 0, F.lit(0)).otherwise(late).alias("bin")).agg(
        F.count(F.lit(1)).alias("row_count"))


def choose_lookback(bins: DataFrame, shares: list[float]) -> DataFrame:
    """For each wanted share of rows the least lookback, in seconds, whose bins hold it
    (``share``, ``lookback_seconds``, ``row_count``). On-time rows need none."""
    total = bins.groupBy("bin").agg(F.sum("row_count").alias("n"))  # a row per bin
    rising = Window.orderBy("bin")
    held = total.select("bin", F.sum("n").over(rising.rowsBetween(Window.unboundedPreceding, 0)).alias("held"),
                        F.sum("n").over(Window.partitionBy()).alias("row_count"))
    wanted = held.select("*", F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share")).where(F.col("held") >= F.col("share") * F.col("row_count"))
    bound = F.when(F.col("least") == 0, F.lit(0)).otherwise(F.ceil(F.pow(F.lit(GROWTH), F.col("least") - 1))).cast("long")
    return wanted.groupBy("share").agg(F.min("bin").alias("least"), F.max("row_count").alias("row_count")).select(
        "share", bound.alias("lookback_seconds"), "row_count")


def current_marks(commits: DataFrame) -> DataFrame:
    """One row per source from the append-only commit log.

    The mark and the success time come from the last success, so a failed run leaves
    both alone; status, batch and error come from the last run; counts add up.
    """
    ok = F.col("status") == "SUCCESS"
    return commits.groupBy("source").agg(
        F.coalesce(F.max_by("watermark", F.when(ok, F.col("commit_no"))), ntz(EPOCH)).alias("watermark"),
        F.coalesce(F.sum(F.when(ok, F.col("records"))), F.lit(0)).cast("long").alias("records"),
        F.max_by("batch_id", "commit_no").alias("batch_id"),
        F.max_by("status", "commit_no").alias("status"),
        F.max_by(F.struct("error_message"), "commit_no")["error_message"].alias("error_message"),
        F.max(F.when(ok, F.col("committed_at"))).alias("last_success_at"),
    )


def watermark_history(commits: DataFrame) -> DataFrame:
    """The mark and the total count in force after each commit. One source commits
    once per run, so a window per source stays small."""
    so_far = Window.partitionBy("source").orderBy("commit_no").rowsBetween(Window.unboundedPreceding, 0)
    ok = F.col("status") == "SUCCESS"
    return commits.select(
        "source", "commit_no", "batch_id", "status",
        F.coalesce(F.max(F.when(ok, F.col("watermark"))).over(so_far), ntz(EPOCH)).alias("watermark"),
        F.sum(F.when(ok, F.col("records")).otherwise(0)).over(so_far).cast("long").alias("records"),
    )


def read_watermarks(spark: SparkSession, commits: DataFrame) -> DataFrame:
    """Every known source with its mark; one that never committed starts at the epoch."""
    known = spark.createDataFrame([(name,) for name in SOURCES], "source string")
    marks = current_marks(commits)
    return known.join(marks, "source", "left").select(
        "source",
        F.coalesce("watermark", ntz(EPOCH)).alias("watermark"),
        F.coalesce("records", F.lit(0)).cast("long").alias("records"),
        "batch_id",
        F.coalesce("status", F.lit("NEVER_RUN")).alias("status"),
        "error_message", "last_success_at",
    )
