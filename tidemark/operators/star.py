"""Point-in-time joins, transitions and analytics over the star schema."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DataType

from tidemark.functions.dates import month_key, ntz
from tidemark.operators.skew import (
    HOT_ROWS, Heat, along_key, resolve, split_hot, with_key_value,
)
from tidemark.schemas import INT, MONEY, TIER_RANK, UNKNOWN, UNKNOWN_SK
from tidemark.session import new_folder

REVENUE = "decimal(22,2)"


def _version_rows(dim: DataFrame, key: str, take: list[str]) -> DataFrame:
    return dim.select(
        key, F.col("valid_from").alias("_at"), F.lit(0).alias("_side"),
        F.struct("valid_to", *take).alias("_version"),
    )


def _valid(version: Column, ts: Column) -> Column:
    """The version, if it is still valid at the time."""
    end = version["valid_to"]
    return F.when(version.isNotNull() & (end.isNull() | (ts < end)), version)


def pit_join(
    facts: DataFrame, dim: DataFrame, ts: str, take: list[str], *,
    key: str = "customer_id", how: str = "inner", hot: Heat | int = HOT_ROWS,
) -> DataFrame:
    """Give each fact the dimension version valid at its time.

    Facts and versions are sorted together by key and time, and each fact looks back
    to the last version, so the work is linear where an equi join with a range
    condition compares every fact of a key with every version of it. Versions of one
    key must not overlap, which the history dimension guarantees. For hot keys only
    the distinct times are looked up, in chunks, and joined back to the facts.
    """
    known = facts.where(F.col(key).isNotNull())
    versions = _version_rows(dim, key, take)
    heat = resolve(known.select(key).unionByName(versions.select(key)), key, hot)
    # A version with no length precedes the one that replaced it.
    order = ["_at", "_side", "_version.valid_to"]
    no_version = F.lit(None).cast(versions.schema["_version"].dataType)

    def latest(window):
        return {"_version": F.last("_version", ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, 0))}

    def look_back(own_facts: DataFrame, own_versions: DataFrame) -> DataFrame:
        tagged = own_facts.select(
            key, F.col(ts).alias("_at"), F.lit(1).alias("_side"), no_version.alias("_version"),
            F.struct(*facts.columns).alias("_fact"))
        no_fact = F.lit(None).cast(tagged.schema["_fact"].dataType)
        together = tagged.unionByName(own_versions.withColumn("_fact", no_fact))
        found = together.withColumns(latest(Window.partitionBy(key).orderBy(*order))).where(F.col("_fact").isNotNull())
        return found.select("_fact.*", _valid(F.col("_version"), F.col("_at")).alias("_version"))

    if heat.keys is None:
        joined = look_back(known, versions)
    else:
        cold_facts, hot_facts = split_hot(known, key, heat)
        cold_versions, hot_versions = split_hot(versions, key, heat)
        probes = hot_facts.select(key, F.col(ts).alias("_at")).distinct()
        probes = probes.select(key, "_at", F.lit(1).alias("_side"), no_version.alias("_version"))
        found = along_key(
            probes.unionByName(hot_versions), key, order, latest, hot=heat,
            only=F.col("_side") == 0)
        found = found.where("_side = 1").select(
            F.col(key).alias("_key"), "_at", _valid(F.col("_version"), F.col("_at")).alias("_version"))
        # One row per key and time on the right, so adaptive execution can split the left.
        matched = hot_facts.join(found, (F.col(key) == F.col("_key")) & (F.col(ts) == F.col("_at")), "left")
        joined = look_back(cold_facts, cold_versions).unionByName(matched.drop("_key", "_at"))
    if how == "left":
        joined = joined.unionByName(facts.where(F.col(key).isNull()).withColumn("_version", no_version))
    else:
        joined = joined.where(F.col("_version").isNotNull())
    return joined.select(*facts.columns, *[F.col(f"_version.{c}").alias(c) for c in take])


@dataclass(frozen=True)
class Timeline:
    """Facts and versions stored for point-in-time joins that move no row.

    Both lie in one table, bucketed by key and sorted by time, so the join is a scan, a sort and
    a window without an exchange. (A union of two bucketed tables isn't relied on: where Spark keeps
    its buckets and reads it in columns, 4.1 pairs the wrong ones.) Rows of hot keys, which would
    make a bucket too large, lie in plain tables beside it and are joined as ``pit_join`` does it.
    With bucketed reads switched off the result is the same, by a shuffle.
    """

    spark: SparkSession
    table: str
    key: str
    ts: str
    buckets: int
    fact_columns: tuple[str, ...]
    take: tuple[str, ...]
    heat: Heat
    hot_path: str

    def joined(self) -> DataFrame:
        """Each fact with the version valid at its time; facts without one are left out."""
        window = Window.partitionBy(self.key).orderBy("_at", "_side", "_end").rowsBetween(Window.unboundedPreceding, 0)
        rows = self.spark.table(self.table)
        found = (
            rows.withColumn("_found", F.last("_version", ignorenulls=True).over(window)).where(F.col("_side") == 1)
            .select("_fact.*", _valid(F.col("_found"), F.col("_at")).alias("_found")).where(F.col("_found").isNotNull())
            .select(*self.fact_columns, *[F.col(f"_found.{c}").alias(c) for c in self.take])
        )
        if self.heat.keys is None:
            return found
        warm = self.spark.read.schema(rows.schema).parquet(self.hot_path)
        facts = warm.where("_side = 1").select("_fact.*")
        versions = warm.where("_side = 0").select(self.key, F.col("_at").alias("valid_from"), "_version.*")
        return found.unionByName(pit_join(facts, versions, self.ts, list(self.take), key=self.key, hot=self.heat))

    def add_facts(self, facts: DataFrame) -> None:
        """More facts, to the same buckets. Versions can't be added: a new one ends an old
        one, so they are stored anew."""
        like = self.spark.table(self.table)
        self.write(_fact_rows(facts.select(*self.fact_columns), self.key, self.ts, like.schema["_version"].dataType).select(*like.columns))

    def write(self, rows: DataFrame) -> None:
        cold = rows
        if self.heat.keys is not None:
            cold, warm = split_hot(rows, self.key, self.heat)
            warm.write.mode("append").parquet(self.hot_path)
        (cold.repartition(self.buckets, self.key).write.format("parquet").mode("append").bucketBy(self.buckets, self.key)
         .sortBy(self.key, "_at").option("path", f"{self.hot_path}-buckets").saveAsTable(self.table))


def _fact_rows(facts: DataFrame, key: str, ts: str, version: DataType) -> DataFrame:
    return facts.where(F.col(key).isNotNull()).select(
        key, F.col(ts).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast("timestamp_ntz").alias("_end"),
        F.lit(None).cast(version).alias("_version"), F.struct(*facts.columns).alias("_fact"))


def store_timeline(
    facts: DataFrame, dim: DataFrame, ts: str, take: list[str], buckets: int, *, key: str = "customer_id",
    hot: Heat | int = HOT_ROWS,
) -> Timeline:
    """Store facts and versions once, for as many joins as follow."""
    spark, name = facts.sparkSession, f"timeline_{uuid.uuid4().hex}"
    heat = resolve(facts.select(key).unionByName(dim.select(key)), key, hot)
    versions = _version_rows(dim, key, take)
    fact_rows = _fact_rows(facts, key, ts, versions.schema["_version"].dataType)
    versions = versions.select(
        key, "_at", "_side", F.col("_version.valid_to").alias("_end"), "_version",
        F.lit(None).cast(fact_rows.schema["_fact"].dataType).alias("_fact"))
    timeline = Timeline(spark, name, key, ts, buckets, tuple(facts.columns), tuple(take), heat, new_folder(spark, "timeline"))
    timeline.write(fact_rows.unionByName(versions))
    return timeline


def revenue_by_tier_pit(facts: DataFrame, dim: DataFrame, hot: Heat | int = HOT_ROWS) -> DataFrame:
    """Orders and net revenue by the tier the customer had at the time of the order."""
    needed = facts.select("customer_id", "order_timestamp", "net_amount_usd")
    return pit_join(needed, dim, "order_timestamp", ["plan_tier"], hot=hot).groupBy("plan_tier").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("net_amount_usd").cast(REVENUE).alias("net_revenue"),
    )


def revenue_by_tier_current(facts: DataFrame, dim: DataFrame) -> DataFrame:
    """Lifetime revenue by the tier the customer has now.

    Revenue is summed per customer first, so a customer with any number of orders
    enters the join as one row.
    """
    totals = facts.groupBy("customer_id").agg(F.sum("net_amount_usd").alias("spent"))
    current = dim.where("is_current").select("customer_id", F.col("plan_tier").alias("current_tier"))
    return totals.join(current, "customer_id").groupBy("current_tier").agg(
        F.sum("spent").cast(REVENUE).alias("lifetime_revenue")
    )


def with_first_seen(dim: DataFrame, hot: Heat | int = HOT_ROWS) -> DataFrame:
    """The dimension with the time from which its customer is known."""
    return with_key_value(dim, "customer_id", hot, first_seen_timestamp=F.min("valid_from"))


def with_unknown_member(dim: DataFrame) -> DataFrame:
    """The dimension plus the member that facts without a version belong to."""
    fixed = {
        "customer_sk": F.lit(UNKNOWN_SK), "customer_id": F.lit(UNKNOWN), "first_name": F.lit("Unassigned"),
        "last_name": F.lit("Customer"), "email": F.lit("unknown@example.com"), "country_code": F.lit("XX"),
        "plan_tier": F.lit(UNKNOWN), "account_status": F.lit(UNKNOWN), "acquisition_channel": F.lit(UNKNOWN),
        "valid_from": ntz("1970-01-01 00:00:00"), "valid_to": F.lit(None).cast("timestamp_ntz"),
        "is_current": F.lit(True), "first_seen_timestamp": ntz("1970-01-01 00:00:00"),
    }
    member = dim.sparkSession.range(1).select(*[fixed[c].alias(c) for c in dim.columns])
    return dim.unionByName(member)


def resolve_customer(facts: DataFrame, dim: DataFrame, ts: str, hot: Heat | int = HOT_ROWS) -> DataFrame:
    """Facts with the key and tier of their customer version, or of the unknown
    member. No fact is dropped."""
    joined = pit_join(facts, dim, ts, ["customer_sk", "plan_tier"], how="left", hot=hot)
    return joined.withColumns({
        "customer_sk": F.coalesce("customer_sk", F.lit(UNKNOWN_SK)),
        "plan_tier": F.coalesce("plan_tier", F.lit(UNKNOWN)),
    })


def fact_orders_sk(
    facts: DataFrame, dim: DataFrame, tax: Column | None = None, items: Column | None = None, hot: Heat | int = HOT_ROWS
) -> DataFrame:
    """Order facts keyed to the customer version at the time of the order."""
    tax_amount = (F.lit(0) if tax is None else tax).cast(MONEY)
    resolved = pit_join(facts, dim, "order_timestamp", ["customer_sk"], how="left", hot=hot)
    return resolved.select(
        "order_id", "order_timestamp",
        F.col("date_key").alias("order_date_key"),
        F.coalesce("customer_sk", F.lit(UNKNOWN_SK)).alias("customer_sk"),
        "customer_id", "order_status", "payment_method", "shipping_country",
        (F.lit(1) if items is None else items).cast(INT).alias("item_count"),
        "gross_amount_usd",
        F.col("discount_usd").alias("discount_amount_usd"),
        "net_amount_usd",
        tax_amount.alias("tax_amount_usd"),
        (F.col("net_amount_usd") + tax_amount).cast(MONEY).alias("total_amount_usd"),
    )


def _rank(tier: Column) -> Column:
    ranks = F.create_map(*[F.lit(x) for pair in TIER_RANK for x in pair])
    return ranks[tier]


def _with_previous(facts: DataFrame, columns: dict[str, str], hot: Heat | int) -> DataFrame:
    """Add columns of the previous event of the subscription (new name: old name)."""
    def previous(window):
        return {new: F.lag(old).over(window) for new, old in columns.items()}

    order = ["event_timestamp", "subscription_event_id"]
    return along_key(facts, "subscription_id", order, previous, hot=hot)


def tier_transitions(facts: DataFrame, hot: Heat | int = HOT_ROWS) -> DataFrame:
    """Tier and recurring revenue before and after every subscription event."""
    previous = {"previous_plan_tier": "plan_tier", "_mrr": "mrr_amount_usd"}
    before = F.coalesce("_mrr", F.lit(0)).cast(MONEY)
    return _with_previous(facts, previous, hot).select(
        "subscription_event_id", "subscription_id", "customer_id", "event_timestamp",
        "previous_plan_tier", F.col("plan_tier").alias("new_plan_tier"),
        before.alias("previous_mrr_usd"), F.col("mrr_amount_usd").alias("new_mrr_usd"),
        (F.col("mrr_amount_usd") - before).cast(MONEY).alias("mrr_delta_usd"),
    )


def _event_type() -> Column:
    ended = F.col("subscription_status").isin("CANCELLED", "EXPIRED")
    had_ended = F.col("_status").isin("CANCELLED", "EXPIRED")
    step = _rank(F.col("plan_tier")) - _rank(F.col("_tier"))
    return (
        F.when(F.col("_status").isNull(), "SIGNUP")
        .when(ended, "CHURN")
        .when(had_ended, "REACTIVATION")
        .when(step > 0, "UPGRADE")
        .when(step < 0, "DOWNGRADE")
        .otherwise("RENEWAL")
    )


def lifecycle_type(facts: DataFrame, hot: Heat | int = HOT_ROWS) -> DataFrame:
    """What each subscription event meant.

    No event before is a sign-up; a cancelled or expired status is churn; the next
    event after churn is a reactivation; otherwise the tier decides. A first event
    that is already cancelled counts as the sign-up it records.
    """
    previous = {"_tier": "plan_tier", "_status": "subscription_status"}
    return _with_previous(facts, previous, hot).select(
        "subscription_event_id", "subscription_id", "event_timestamp", "subscription_status",
        F.col("plan_tier").alias("new_plan_tier"), _event_type().alias("event_type"),
    )


def tenure_days(facts: DataFrame, hot: Heat | int = HOT_ROWS) -> DataFrame:
    """Days from the first event of the subscription to each event."""
    needed = facts.select("subscription_event_id", "subscription_id", "event_timestamp")
    first = with_key_value(needed, "subscription_id", hot, _first=F.min("event_timestamp"))
    return first.select(
        "subscription_event_id", "subscription_id", "event_timestamp",
        F.datediff("event_timestamp", "_first").alias("days_active_prior"),
    )


def fact_subscription_sk(
    facts: DataFrame, dim: DataFrame, hot: Heat | int = HOT_ROWS, hot_customers: Heat | int = HOT_ROWS
) -> DataFrame:
    """Subscription facts with customer key, transition, meaning and tenure."""
    heat = resolve(facts, "subscription_id", hot)
    owners = facts.select("customer_id").unionByName(dim.select("customer_id"))
    customers = resolve(owners, "customer_id", hot_customers)
    previous = {"_tier": "plan_tier", "_mrr": "mrr_amount_usd", "_status": "subscription_status"}
    before = F.coalesce("_mrr", F.lit(0)).cast(MONEY)
    # Both windows are over the subscription, so they share one shuffle.
    moved = with_key_value(
        _with_previous(facts, previous, heat), "subscription_id", heat, _first=F.min("event_timestamp"))
    shaped = moved.select(
        "subscription_event_id", "event_timestamp", F.col("date_key").alias("event_date_key"), "subscription_id",
        "customer_id", _event_type().alias("event_type"), F.col("_tier").alias("previous_plan_tier"),
        F.col("plan_tier").alias("new_plan_tier"), "billing_frequency", before.alias("previous_mrr_usd"),
        F.col("mrr_amount_usd").alias("new_mrr_usd"),
        (F.col("mrr_amount_usd") - before).cast(MONEY).alias("mrr_delta_usd"),
        F.datediff("event_timestamp", "_first").alias("days_active_prior"),
    )
    resolved = pit_join(shaped, dim, "event_timestamp", ["customer_sk"], how="left", hot=customers)
    return resolved.withColumn("customer_sk", F.coalesce("customer_sk", F.lit(UNKNOWN_SK)))


def role_playing_dates(orders: DataFrame, subscriptions: DataFrame, calendar: DataFrame) -> DataFrame:
    """Both facts rolled up to months through one calendar in two roles.

    Each fact is counted per day before it meets the calendar. Facts of days that the
    calendar lacks are counted under a year, quarter and month of NULL.
    """
    def per_month(facts: DataFrame, amount: str, role: str) -> DataFrame:
        daily = facts.groupBy("date_key").agg(
            F.count(F.lit(1)).alias("n"), F.sum(amount).alias("amount"))
        return (
            daily.join(calendar.select("date_key", "year", "quarter", "month"), "date_key", "left")
            .groupBy("year", "quarter", "month")
            .agg(F.sum("n").alias("row_count"), F.sum("amount").cast(REVENUE).alias("amount_usd"))
            .select(F.lit(role).alias("date_role"), "year", "quarter", "month", "row_count", "amount_usd")
        )

    return per_month(orders, "net_amount_usd", "order_date").unionByName(
        per_month(subscriptions, "mrr_amount_usd", "subscription_event_date"))


MONTH = "event_month"


def write_monthly(facts: DataFrame, ts: str, path: str) -> None:
    """Write facts in monthly directories. Rebalancing splits a heavy month over
    several tasks and keeps a light one in a single file."""
    dated = facts.withColumn(MONTH, month_key(ts)).hint("rebalance", MONTH)
    dated.write.mode("overwrite").partitionBy(MONTH).parquet(path)


def read_month_range(spark: SparkSession, path: str, ts: str, start: datetime, end: datetime) -> DataFrame:
    """Rows in [start, end). The month bounds follow from the times and prune directories."""
    months = F.col(MONTH).between(start.year * 100 + start.month, end.year * 100 + end.month)
    return spark.read.parquet(path).where(months & (F.col(ts) >= ntz(start)) & (F.col(ts) < ntz(end)))


def customer_timeline(facts: DataFrame, customer_id: str) -> DataFrame:
    """One customer's orders in time order."""
    return facts.where(F.col("customer_id") == customer_id).orderBy("order_timestamp", "order_id")


def customer_ltv(orders: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Order revenue and recurring revenue per customer. Each fact is summed first, so
    neither multiplies the other."""
    bought = orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("net_amount_usd").alias("order_revenue"))
    recurring = subscriptions.groupBy("customer_id").agg(F.sum("mrr_amount_usd").alias("mrr_revenue"))
    order_revenue = F.coalesce("order_revenue", F.lit(0)).cast(REVENUE)
    mrr_revenue = F.coalesce("mrr_revenue", F.lit(0)).cast(REVENUE)
    return bought.join(recurring, "customer_id", "full").select(
        "customer_id",
        F.coalesce("order_count", F.lit(0)).cast("long").alias("order_count"),
        order_revenue.alias("order_revenue"),
        mrr_revenue.alias("mrr_revenue"),
        (order_revenue + mrr_revenue).cast(REVENUE).alias("lifetime_value"),
    )


WORD = 63  # months in a mask of one long number


def active_months(orders: DataFrame) -> DataFrame:
    """One row per customer: the month of the first order (``_cohort``) and the offsets of all
    active months from it, in order (``_offsets``, with NULL last for orders without a date).

    Months are bits of a few long numbers, as many as the span of the data takes, which is read
    first (two dates). Masks combine before the only shuffle by customer, whatever the orders.
    """
    def month(day: str) -> Column:
        return (F.year(day) * 12 + F.month(day) - 1).cast("int")

    span = orders.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi")).select(month("lo"), month("hi")).first()
    low, high = (span[0], span[1]) if span[0] is not None else (0, 0)
    words = (high - low) // WORD + 1
    at = month("order_date") - low
    bit = F.expr(f"shiftleft(1L, (year(order_date) * 12 + month(order_date) - 1 - {low}) % {WORD})")
    masks = orders.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.array(*[F.bit_or(F.when(F.floor(at / WORD) == k, bit).otherwise(F.lit(0).cast("long"))) for k in range(words)]).alias("_words"),
        F.max(F.col("order_date").isNull()).alias("_undated"))
    months = F.sequence(F.lit(0), F.lit(high - low))
    word = lambda m: F.get("_words", F.floor(m / WORD).cast("int"))
    active = F.filter(months, lambda m: F.call_function("shiftright", word(m), (m % WORD).cast("int")).bitwiseAND(1) == 1)
    found = masks.withColumn("_active", active).withColumn("_since", F.get("_active", F.lit(0)))
    offsets = F.transform("_active", lambda m: m - F.col("_since"))
    undated = F.array(F.lit(None).cast("int"))
    return found.select(
        "customer_id", (F.col("_since") + low).alias("_cohort"),
        F.when(F.col("_undated"), F.concat(offsets, undated)).otherwise(offsets).alias("_offsets"))


def _month_number(months: Column) -> Column:
    return (F.floor(months / 12) * 100 + months % 12 + 1).cast("int")


def cohort_retention(orders: DataFrame) -> DataFrame:
    """Active customers by month of first order and months since."""
    active = active_months(orders).select("_cohort", F.explode("_offsets").alias("month_offset"))
    return active.groupBy(_month_number(F.col("_cohort")).alias("cohort_month"), "month_offset").agg(
        F.count(F.lit(1)).alias("active_customers"))


def cohort_streaks(orders: DataFrame) -> DataFrame:
    """Customers by month of first order who ordered in each of their first n months."""
    # Offsets rise, so one equals its place just as long as no month is missing.
    streak = F.size(F.filter("_offsets", lambda offset, place: offset == place))
    months = active_months(orders).where("_cohort is not null").select("_cohort", F.explode(F.sequence(F.lit(1), streak)).alias("first_months"))
    return months.groupBy(_month_number(F.col("_cohort")).alias("cohort_month"), "first_months").agg(
        F.count(F.lit(1)).alias("customers"))


def mrr_movement(facts: DataFrame, hot: Heat | int = HOT_ROWS) -> DataFrame:
    """Change in recurring revenue per month and kind of event."""
    previous = {"_tier": "plan_tier", "_mrr": "mrr_amount_usd", "_status": "subscription_status"}
    moved = _with_previous(facts, previous, hot)
    delta = F.col("mrr_amount_usd") - F.coalesce("_mrr", F.lit(0)).cast(MONEY)
    return moved.groupBy(month_key("event_timestamp").alias("month"), _event_type().alias("event_type")).agg(
        F.count(F.lit(1)).alias("event_count"), F.sum(delta).cast(REVENUE).alias("mrr_delta")
    )
