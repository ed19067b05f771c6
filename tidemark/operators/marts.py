"""The star schema: calendar, customer history and facts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.functions.dates import date_key, micro_text, open_end
from tidemark.operators.skew import HOT_ROWS, Heat, along_key, resolve, split_hot
from tidemark.schemas import CONTRACTS, DIM_DATE, TRACKED_ATTRIBUTES

CALENDAR_START, CALENDAR_END = date(2020, 1, 1), date(2030, 12, 31)


def date_spine(spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END) -> DataFrame:
    days = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("date_day"))


def describe_days(days: DataFrame) -> DataFrame:
    """Calendar attributes of a ``date_day`` column."""
    iso_day = F.extract(F.lit("dayofweek_iso"), F.col("date_day")).cast("int")
    return days.select(
        date_key("date_day").alias("date_key"),
        "date_day",
        F.year("date_day").alias("year"),
        F.quarter("date_day").alias("quarter"),
        F.month("date_day").alias("month"),
        F.date_format("date_day", "MMMM").alias("month_name"),
        F.weekofyear("date_day").alias("week_of_year"),
        F.dayofmonth("date_day").alias("day_of_month"),
        iso_day.alias("day_of_week"),
        F.date_format("date_day", "EEEE").alias("day_name"),
        iso_day.isin(6, 7).alias("is_weekend"),
    ).select(*DIM_DATE.fieldNames())


def dim_date(spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END) -> DataFrame:
    return describe_days(date_spine(spark, start, end))


def distinct_days(df: DataFrame, ts: str) -> DataFrame:
    """The days that occur in the data."""
    return df.select(F.to_date(ts).alias("date_day")).where("date_day is not null").distinct()


def dim_date_covering(df: DataFrame, ts: str) -> DataFrame:
    """A calendar from the first to the last day of the data."""
    bounds = df.agg(F.to_date(F.min(ts)).alias("lo"), F.to_date(F.max(ts)).alias("hi")).where("lo is not null")
    return describe_days(bounds.select(F.explode(F.expr("sequence(lo, hi, interval 1 day)")).alias("date_day")))


def dim_date_fiscal(days: DataFrame, first_month: int = 1) -> DataFrame:
    """Fiscal attributes; the fiscal year is named after the calendar year it ends in."""
    shifted = F.add_months("date_day", (13 - first_month) % 12)
    return days.select(
        date_key("date_day").alias("date_key"), "date_day",
        F.dayofyear("date_day").alias("day_of_year"),
        F.year(shifted).alias("fiscal_year"),
        F.quarter(shifted).alias("fiscal_quarter"),
    )


def latest_per_instant(changes: DataFrame, heat: Heat) -> DataFrame:
    """One row per customer and time: of several changes at one instant the last to
    arrive counts.

    For ordinary customers this shares the shuffle and the sort of the windows that
    follow; the changes of hot ones are ranked per instant, mostly before a shuffle.
    """
    def last(rows: DataFrame) -> DataFrame:
        along = Window.partitionBy("customer_id").orderBy("source_updated_at", "arrival_seq")
        # A NULL time is an instant like others, so what follows is told apart from its time.
        later = rows.withColumn("_later", F.lead(F.struct("source_updated_at")).over(along))
        same = F.col("_later").isNotNull() & F.col("_later.source_updated_at").eqNullSafe(F.col("source_updated_at"))
        return later.where(~same).drop("_later")

    def ranked(rows: DataFrame) -> DataFrame:
        instant = Window.partitionBy("customer_id", "source_updated_at").orderBy(F.desc("arrival_seq"))
        return rows.withColumn("_rank", F.row_number().over(instant)).where("_rank = 1").drop("_rank")

    if heat.keys is None:
        return last(changes)
    cold, warm = split_hot(changes, "customer_id", heat)
    return last(cold).unionByName(ranked(warm))


def dim_customer_scd2(stg: DataFrame, hot: Heat | int = HOT_ROWS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Customer versions. Each is valid until the next one; the last one stays open.

    A deleted customer's last version stays open too but is not current. Feed it the
    staged change log to keep history, or one row per customer for the present only.
    ``keep`` names further columns of the changes that the versions carry.
    """
    heat = resolve(stg, "customer_id", hot)
    if "arrival_seq" in stg.columns:
        stg = latest_per_instant(stg, heat)

    def following(window):
        return {"_next": F.lead("source_updated_at").over(window)}

    versions = along_key(
        stg, "customer_id", ["source_updated_at"], following, hot=heat,
        forward=False)
    return versions.select(
        F.md5(F.concat("customer_id", F.lit("|"), micro_text("source_updated_at"))).alias("customer_sk"),
        "customer_id", "first_name", "last_name", "email", "country_code", "plan_tier", "account_status",
        "acquisition_channel",
        F.col("source_updated_at").alias("valid_from"),
        F.coalesce("_next", open_end()).alias("valid_to"),
        (F.col("_next").isNull() & ~F.col("is_deleted")).alias("is_current"), *keep,
    )


def scd2_compact(
    stg: DataFrame, tracked: tuple[str, ...] = TRACKED_ATTRIBUTES, hot: Heat | int = HOT_ROWS
) -> DataFrame:
    """Customer versions that differ from the one before in a tracked attribute.

    A deletion also starts a version, so that the history ends where it should.
    """
    heat = resolve(stg, "customer_id", hot)
    if "arrival_seq" in stg.columns:
        stg = latest_per_instant(stg, heat).drop("arrival_seq")

    def previous(window):
        return {"_before": F.lag("_watched").over(window)}

    watched = stg.withColumn("_watched", F.struct(*tracked, "is_deleted"))
    marked = along_key(
        watched, "customer_id", ["source_updated_at"], previous, hot=heat)
    changed = marked.where(~F.col("_watched").eqNullSafe(F.col("_before"))).drop("_watched", "_before")
    return dim_customer_scd2(changed, heat)


def fact_orders(stg: DataFrame) -> DataFrame:
    return stg.withColumn("date_key", date_key("order_date")).select(*CONTRACTS["fact_orders"].fieldNames())


def fact_subscription_events(stg: DataFrame) -> DataFrame:
    return stg.withColumn("date_key", date_key("event_date")).select(
        *CONTRACTS["fact_subscription_events"].fieldNames()
    )
