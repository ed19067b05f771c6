"""The registered queries: each operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import cache

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tidemark.functions.dates import ntz
from tidemark.functions.text import canonicalize
from tidemark.operators.skew import HOT_ROWS, Heat, find_hot
from tidemark.operators import cdc, content, incremental, marts, monitoring, profiling, quality, refresh, staging, star, state
from tidemark.plans import ingest, warehouse as build
from tidemark.schemas import (
    ACCOUNT_STATUSES, CONTRACTS, EPOCH, LONG, ORDER_STATUSES, PLAN_TIERS, SOURCES, SUBSCRIPTION_STATUSES,
)
from tidemark.session import configure, new_folder
from tidemark.sources import landing, upstream
from tidemark.sources.adapters import table
from tidemark.streaming import ingest as streams

ORDERS_MARK = datetime(1998, 6, 1)
EVENTS_MARK = datetime(2024, 1, 15)
LOOKBACK = timedelta(hours=36)
NOW = "2024-01-31 12:00:00"
BUCKETS = 8


class Tables:
    """Lazy frames over one data folder, from raw rows to marts."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir
        self.known: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name, self.known)

    def stg(self, source: str) -> DataFrame:
        return staging.STAGING[source](self(f"raw_{source}"))

    def hot_customers(self, *names: str) -> Heat:
        """Hot customers, counted on the stored column of the tables named."""
        return find_hot(quality.union_all([self(n).select("customer_id") for n in names]), "customer_id")

    def history(self, log: str = "customer_changes", hot: Heat | int = HOT_ROWS) -> DataFrame:
        return marts.dim_customer_scd2(staging.stg_customers(self(log), "arrival_seq"), hot)

    def present(self) -> DataFrame:
        return marts.dim_customer_scd2(self.stg("customers"))

    def orders(self, raw: str = "raw_orders") -> DataFrame:
        return marts.fact_orders(staging.stg_orders(self(raw)))

    def subscriptions(self) -> DataFrame:
        return marts.fact_subscription_events(self.stg("subscriptions"))

    def calendar(self) -> DataFrame:
        return marts.dim_date(self.spark)

    def order_calendar(self) -> DataFrame:
        return marts.dim_date_covering(self("raw_orders"), "order_timestamp")

    def all_tables(self) -> dict[str, DataFrame]:
        """Every layer, with the order chain fed from dirty input."""
        return {
            "raw_customers": self("raw_customers"), "raw_orders": self("dirty_orders"),
            "raw_subscriptions": self("raw_subscriptions"), "raw_events": self("raw_events"),
            "stg_customers": self.stg("customers"), "stg_orders": staging.stg_orders(self("dirty_orders")),
            "stg_subscriptions": self.stg("subscriptions"), "stg_events": self.stg("events"),
            "dim_date": self.calendar(), "dim_customer": self.present(),
            "fact_orders": self.orders("dirty_orders"), "fact_subscription_events": self.subscriptions(),
        }

    def baseline(self) -> DataFrame:
        """What the row counts should be, from sibling tables."""
        expected = {
            "raw_customers": self("customer"),
            "raw_orders": self("lineitem").select("l_orderkey").distinct(),
            "raw_subscriptions": self("events").where("event_type <> 'error'"),
            "raw_events": self("events").where("event_type not in ('error', 'view')"),
        }
        return monitoring.table_counts(expected).withColumnRenamed("row_count", "baseline")

    def folder(self, name: str) -> str:
        return new_folder(self.spark, name)


REGISTRY: dict[str, Callable[[Tables], DataFrame]] = {}


def query(build: Callable[[Tables], DataFrame]):
    REGISTRY[build.__name__] = build
    return build


@cache
def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build):
        return lambda spark, sf_dir: build(Tables(spark, sf_dir))

    return {name: bind(build) for name, build in REGISTRY.items()}


# -- sources ----------------------------------------------------------------


@query
def scan_landing(t: Tables) -> DataFrame:
    schema = T.StructType().add("event_id", LONG).add("ts", T.TimestampNTZType()).add("user_id", LONG).add(
        "event_type", T.StringType())
    return landing.scan_landing(t.spark, f"{t.sf_dir}/events.parquet", schema, "ts", EVENTS_MARK)


@query
def project_customers(t: Tables) -> DataFrame:
    return upstream.project_customers(t("up_customers"))


@query
def project_orders(t: Tables) -> DataFrame:
    return upstream.project_orders(
        t("up_orders"), t("up_payment_intents"), t("up_payment_methods"), t("up_addresses"))


@query
def project_subscriptions(t: Tables) -> DataFrame:
    return upstream.project_subscriptions(t("up_subscription_events"), t("up_subscriptions"))


@query
def project_events(t: Tables) -> DataFrame:
    return upstream.project_events(t("up_events"))


@query
def scan_csv_landing(t: Tables) -> DataFrame:
    path, orders = t.folder("csv"), t("raw_orders")
    landing.write_csv_landing(orders, path)
    return landing.scan_csv_landing(t.spark, path, orders.schema)


@query
def write_landing_by_day(t: Tables) -> DataFrame:
    path = t.folder("landing")
    landing.write_landing_by_day(t("raw_events"), "event_timestamp", path)
    return t.spark.read.parquet(path).select("event_id", "customer_id", F.col("dt").cast("date").alias("dt"))


# -- incremental extraction -------------------------------------------------


@query
def extract_incremental(t: Tables) -> DataFrame:
    return incremental.extract_incremental(t("raw_orders"), "source_updated_at", ORDERS_MARK)


@query
def extract_lookback(t: Tables) -> DataFrame:
    return incremental.extract_lookback(t("raw_orders"), "source_updated_at", ORDERS_MARK, LOOKBACK)


@query
def extract_full(t: Tables) -> DataFrame:
    return incremental.extract_full(t("raw_subscriptions"), "event_timestamp")


@query
def first_batch(t: Tables) -> DataFrame:
    return incremental.first_batch(t("raw_events"), "event_timestamp", "event_id", 5000)


@query
def batch_metadata(t: Tables) -> DataFrame:
    rows = []
    for source, name, mark in (
        ("customers", "customer_changes", EVENTS_MARK), ("orders", "order_changes", ORDERS_MARK),
        ("subscriptions", "subscription_changes", EVENTS_MARK), ("events", "raw_events", EVENTS_MARK),
    ):
        ts = SOURCES[source].ts
        op = None if source == "events" else "_source_op"
        rows.append(incremental.batch_metadata(incremental.since(t(name), ts, mark), source, ts, mark, op))
    return quality.union_all(rows)


@query
def stamp_batch(t: Tables) -> DataFrame:
    lost = F.when(F.col("_source_op") == "D", F.lit(None)).when(F.col("_source_op") == "I", F.lit(""))
    unnamed = t("customer_changes").withColumn(
        "_batch_id", F.when(F.col("_source_op") == "U", F.col("_batch_id")).otherwise(lost))
    stamped = incremental.stamp_batch(unnamed, "RUN-0A1B2C3D")
    return stamped.select("customer_id", "arrival_seq", "_source_op", "_batch_id")


@query
def advance_watermark(t: Tables) -> DataFrame:
    ahead = datetime(2030, 1, 1)
    orders, events = t("raw_orders"), t("raw_events")
    return quality.union_all([
        incremental.advance_watermark(orders, "source_updated_at", EPOCH).withColumn("run", F.lit("orders_first")),
        incremental.advance_watermark(orders, "source_updated_at", ahead).withColumn("run", F.lit("orders_behind")),
        incremental.advance_watermark(events, "event_timestamp", EVENTS_MARK).withColumn("run", F.lit("events_next")),
    ])


@query
def commit_watermark(t: Tables) -> DataFrame:
    return incremental.watermark_history(t("commit_log"))


@query
def read_watermark(t: Tables) -> DataFrame:
    return incremental.read_watermarks(t.spark, t("commit_log").where("source <> 'events'"))


@query
def record_failure(t: Tables) -> DataFrame:
    root, changes = t.folder("failing"), t("order_changes")
    ingest.run_source(t.spark, root, "orders", changes, "RUN-GOOD", buckets=BUCKETS)
    broken = changes.withColumn("order_status", F.raise_error(F.lit("source is unreadable")).cast("string"))
    try:
        done = ingest.run_all(t.spark, root, {"orders": broken}, "RUN-BAD", full_refresh=True, buckets=BUCKETS)
    except ingest.RunFailed as failed:
        done = failed.offered
    marks = incremental.current_marks(state.ChangeTable(t.spark, f"{root}/orders", "orders", BUCKETS).commits())
    return marks.select(
        "source", "watermark", "records", "batch_id", "status",
        F.col("error_message").contains("source is unreadable").alias("has_error"),
        F.lit(done["orders"]).cast("long").alias("failed_run_rows"))


@query
def run_source(t: Tables) -> DataFrame:
    root, changes = t.folder("run"), t("order_changes")
    early = changes.where(F.col("source_updated_at") <= ntz(ORDERS_MARK))
    ingest.run_source(t.spark, root, "orders", early, "RUN-1", buckets=BUCKETS)
    ingest.run_source(t.spark, root, "orders", changes, "RUN-2", lookback=LOOKBACK, buckets=BUCKETS)
    return state.ChangeTable(t.spark, f"{root}/orders", "orders", BUCKETS).current()


@query
def run_source_unnumbered(t: Tables) -> DataFrame:
    """Changes without arrival numbers, three of each key within a tenth of a second."""
    root = t.folder("run")
    step = F.expr("make_dt_interval(0, 0, 0, CAST(n * 0.04 AS DECIMAL(18,6)))")
    changes = t("raw_subscriptions").withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(2)))).withColumns({
        "status": F.concat(F.lit("S"), F.col("n")), "plan_tier": F.concat(F.lit("P"), F.col("n")),
        "event_timestamp": (F.col("event_timestamp") + step).cast("timestamp_ntz")})
    half = F.substring("subscription_event_id", -1, 1).isin("0", "2", "4", "6", "8")
    for run, part in (("RUN-1", changes.where(half & (F.col("n") == 0))), ("RUN-2", changes.where(~half | (F.col("n") > 0)))):
        ingest.run_source(t.spark, root, "subscriptions", part.drop("n"), run, full_refresh=True, buckets=BUCKETS)
    current = state.ChangeTable(t.spark, f"{root}/subscriptions", "subscriptions", BUCKETS).current()
    return current.select("subscription_event_id", "plan_tier", "status", "event_timestamp")


def change_logs(t: Tables) -> dict[str, DataFrame]:
    return {"customers": t("customer_changes"), "orders": t("order_changes"),
            "subscriptions": t("subscription_changes"), "events": t("event_arrivals")}


@query
def run_all(t: Tables) -> DataFrame:
    """All four sources from nothing to committed state and marks."""
    root, inputs = t.folder("all"), change_logs(t)
    ingest.run_all(t.spark, root, inputs, "RUN-1", buckets=BUCKETS)
    commits = [state.ChangeTable(t.spark, f"{root}/{n}", n, BUCKETS).commits() for n in inputs]
    stored = monitoring.table_counts(
        {n: state.ChangeTable(t.spark, f"{root}/{n}", n, BUCKETS).current() for n in inputs})
    marks = quality.union_all(commits).select("source", "status", "offered", "applied", "watermark")
    return marks.join(stored.withColumnRenamed("table_name", "source"), "source")


@query
def late_report(t: Tables) -> DataFrame:
    report = incremental.late_report(t("raw_events"), "event_timestamp", EVENTS_MARK, LOOKBACK)
    return report.select("event_id", "event_timestamp", "arrival")


@query
def choose_lookback(t: Tables) -> DataFrame:
    """Lookbacks from the lateness of four batches, and what they cover of the two that follow."""
    changes = t("customer_changes").select(F.floor(F.col("arrival_seq") / 10 ** 9).alias("batch"), "source_updated_at")
    before = Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, -1)
    marks = changes.groupBy("batch").agg(F.max("source_updated_at").alias("top")).select(
        "batch", F.max("top").over(before).alias("mark")).where("mark is not null")  # one row a batch
    met = changes.join(marks, "batch")
    bins = quality.union_all([incremental.lateness_bins(met.where(F.col("batch") == n), "source_updated_at", "mark") for n in (1, 2, 3, 4)])
    chosen = incremental.choose_lookback(bins, [0.5, 0.9, 0.99])
    seconds = (F.unix_micros(F.col("mark").cast("timestamp")) - F.unix_micros(F.col("source_updated_at").cast("timestamp"))) / 1_000_000
    later = met.where("batch > 4").select(seconds.alias("seconds"))
    return quality.union_all([  # one aggregate for each of the three lookbacks
        later.agg(F.count(F.lit(1)).alias("later_rows"), F.count_if(F.col("seconds") <= row["lookback_seconds"]).alias("covered_rows")).select(
            F.lit(row["share"]).alias("share"), F.lit(row["lookback_seconds"]).cast("long").alias("lookback_seconds"),
            F.lit(row["row_count"]).cast("long").alias("row_count"), "later_rows", "covered_rows")
        for row in chosen.collect()])


@query
def backfill_window(t: Tables) -> DataFrame:
    """All days are loaded, then three of them again with corrected paths."""
    events = t.stg("events").withColumn("dt", F.col("event_date").cast("string")).drop("event_date")
    days = state.VersionedTable(t.spark, t.folder("days"), "stg_events", events.schema, "dt")
    days.replace(events, "LOAD", None)
    corrected = events.withColumn("page_path", F.concat(F.lit("/corrected"), "page_path"))
    window = [str(date(2024, 1, 10) + timedelta(days=n)) for n in range(3)]
    state.replace_partitions(days, corrected, "BACKFILL", window)
    return days.read().select("event_id", "page_path", "event_timestamp", F.col("dt").cast("date").alias("dt"))


# -- change data capture ----------------------------------------------------


@query
def upsert_customers(t: Tables) -> DataFrame:
    return cdc.upsert_customers(t("customer_changes"))


@query
def upsert_orders(t: Tables) -> DataFrame:
    return cdc.upsert_orders(t("order_changes"))


@query
def upsert_subscriptions(t: Tables) -> DataFrame:
    return cdc.upsert_subscriptions(t("subscription_changes"))


@query
def insert_events(t: Tables) -> DataFrame:
    stored = t("raw_events").where(F.col("event_timestamp") <= ntz(EVENTS_MARK))
    return cdc.insert_events(t("event_arrivals"), stored)


@query
def apply_tombstones(t: Tables) -> DataFrame:
    merged = cdc.upsert_customers(t("customer_changes"))
    return merged.groupBy(F.when(F.col("_is_deleted"), "TOMBSTONE").otherwise("LIVE").alias("kind"), "_source_op").agg(
        F.count(F.lit(1)).alias("customers"), F.max("source_updated_at").alias("newest"))


@query
def reject_stale(t: Tables) -> DataFrame:
    rejected = cdc.reject_stale(t("customer_changes"), "customer_id", "source_updated_at")
    return rejected.select("customer_id", "arrival_seq", "source_updated_at", "stored_at")


@query
def reject_stale_subscriptions(t: Tables) -> DataFrame:
    return cdc.reject_stale_subscriptions(t("subscription_changes")).select(
        "subscription_event_id", "arrival_seq", "event_timestamp", "stored_at")


@query
def merge_into_target(t: Tables) -> DataFrame:
    """Four batches in order of arrival, one of them offered twice. The first three
    are a base with two additions, the last one rewrites."""
    target = state.ChangeTable(t.spark, t.folder("merge"), "subscriptions", BUCKETS, max_deltas=2)
    changes = t("subscription_changes")
    for seq in (1, 2, 2, 3, 4):
        target.merge(changes.where(F.col("arrival_seq") == seq), f"BATCH-{seq}")
    return target.current()


@query
def verify_idempotent(t: Tables) -> DataFrame:
    root, inputs = t.folder("twice"), change_logs(t)
    options = {"full_refresh": True, "buckets": BUCKETS}
    ingest.run_all(t.spark, root, inputs, "RUN-1", **options)
    targets = {n: state.ChangeTable(t.spark, f"{root}/{n}", n, BUCKETS) for n in inputs}
    return state.verify_idempotent(targets, lambda: ingest.run_all(t.spark, root, inputs, "RUN-2", **options))


@query
def state_differences(t: Tables) -> DataFrame:
    """Orders of a replica that lags, in other buckets: it lacks the last year and an update."""
    changes, tables = t("order_changes"), []
    behind = changes.where((F.col("arrival_seq") == 1) & (F.col("order_timestamp") < ntz("1998-01-01")))
    for name, buckets, batches in (
        ("replica", BUCKETS, [behind]), ("orders", 2 * BUCKETS, [changes.where(F.col("arrival_seq") == seq) for seq in (1, 2)]),
    ):
        table = state.ChangeTable(t.spark, t.folder(name), "orders", buckets)
        for no, batch in enumerate(batches):
            table.merge(batch, f"BATCH-{no}")
        tables.append((table, table.head()))
    return content.differing_keys(*tables)


# -- staging ----------------------------------------------------------------


@query
def stg_customers(t: Tables) -> DataFrame:
    return t.stg("customers")


@query
def stg_orders(t: Tables) -> DataFrame:
    return t.stg("orders")


@query
def stg_subscriptions(t: Tables) -> DataFrame:
    return t.stg("subscriptions")


@query
def stg_events(t: Tables) -> DataFrame:
    return t.stg("events")


DOMAINS = (
    ("customer_tier", "customer_changes", "plan_tier", PLAN_TIERS),
    ("account_status", "customer_changes", "account_status", ACCOUNT_STATUSES),
    ("order_status", "raw_orders", "order_status", ORDER_STATUSES),
    ("subscription_tier", "raw_subscriptions", "plan_tier", PLAN_TIERS),
    ("subscription_status", "raw_subscriptions", "status", SUBSCRIPTION_STATUSES),
)


@query
def canonicalize_values(t: Tables) -> DataFrame:
    return quality.union_all([
        t(source).groupBy(F.col(column).alias("raw_value"), canonicalize(column, domain).alias("mapped_value"))
        .agg(F.count(F.lit(1)).alias("row_count")).withColumn("field", F.lit(field))
        for field, source, column, domain in DOMAINS
    ])


REGISTRY["canonicalize"] = REGISTRY.pop("canonicalize_values")


@query
def unmapped_values(t: Tables) -> DataFrame:
    return quality.union_all([
        staging.unmapped_values(t(source), column, domain).withColumn("field", F.lit(field))
        for field, source, column, domain in DOMAINS
    ])


@query
def clamp_chronology(t: Tables) -> DataFrame:
    return staging.clamp_chronology(t("raw_subscriptions"))


# -- marts ------------------------------------------------------------------


@query
def dim_date(t: Tables) -> DataFrame:
    """The calendar with the events of each day."""
    daily = t("raw_events").groupBy(F.to_date("event_timestamp").alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    calendar = t.calendar()
    return calendar.join(daily, F.col("date_day") == F.col("_day"), "left").select(
        *calendar.columns, F.coalesce("_n", F.lit(0)).cast("long").alias("event_rows"))


@query
def dim_customer_scd2(t: Tables) -> DataFrame:
    return t.history()


@query
def dim_customer_present(t: Tables) -> DataFrame:
    return t.present()


@query
def fact_orders(t: Tables) -> DataFrame:
    return t.orders()


@query
def fact_subscription_events(t: Tables) -> DataFrame:
    return t.subscriptions()


@query
def scd2_compact(t: Tables) -> DataFrame:
    compact = marts.scd2_compact(staging.stg_customers(t("customer_changes"), "arrival_seq"))
    return compact.select(
        "customer_id", "plan_tier", "account_status", "country_code", "valid_from", "valid_to", "is_current")


@query
def materialize_mart(t: Tables) -> DataFrame:
    built = state.materialize_mart(
        t.spark, t.folder("mart"), "fact_orders", t.orders(), CONTRACTS["fact_orders"], "BUILD-1")
    return built.read().drop("slice")


@query
def dim_customer_incremental(t: Tables) -> DataFrame:
    """The history, from three batches in no order of arrival, one of them offered twice."""
    history, changes = refresh.HistoryTable(t.spark, t.folder("history"), BUCKETS), t("customer_changes")
    for part in (2, 0, 0, 1):
        history.merge(changes.where(F.col("arrival_seq") % 3 == part), f"BATCH-{part}")
    return history.current()


def order_facts(raw: DataFrame) -> DataFrame:
    return marts.fact_orders(staging.stg_orders(raw))


@query
def refresh_fact_orders(t: Tables) -> DataFrame:
    """The mart follows its source through new orders, updates, stale ones and ties."""
    source = state.ChangeTable(t.spark, t.folder("orders"), "orders", BUCKETS, max_deltas=2)
    mart = refresh.monthly_mart(t.spark, t.folder("mart"), "fact_orders")
    for seq in (1, 2, 3, 4):
        source.merge(t("order_changes").where(F.col("arrival_seq") == seq), f"BATCH-{seq}")
        refresh.refresh_mart(source, mart, order_facts, "order_id", "order_timestamp")
    return mart.read().drop("month")


def subscription_facts(raw: DataFrame) -> DataFrame:
    return marts.fact_subscription_events(staging.stg_subscriptions(raw))


def corrected(t: Tables) -> dict[str, DataFrame]:
    """Three days of each source once more: orders and subscriptions worth one more,
    customers on the free tier."""
    orders = t("raw_orders").where(F.col("order_timestamp").between(ntz("1997-03-04"), ntz("1997-03-06 23:59:59"))).withColumns({
        "order_amount_usd": (F.col("order_amount_usd") + 1).cast("decimal(12,2)"),
        "source_updated_at": (F.col("source_updated_at") + F.expr("interval 1 day")).cast("timestamp_ntz")})
    days = (ntz("2024-01-10"), ntz("2024-01-12 23:59:59"))
    subs = t("raw_subscriptions").where(F.col("event_timestamp").between(*days)).withColumn(
        "monthly_recurring_revenue", (F.col("monthly_recurring_revenue") + 1).cast("decimal(12,2)"))
    customers = t("customer_changes").where(F.col("source_updated_at").between(*days)).withColumns({
        "plan_tier": F.lit("free"), "arrival_seq": F.col("arrival_seq") + 10 ** 11})
    return {"orders": orders.withColumn("arrival_seq", F.lit(2).cast("long")),
            "subscriptions": subs.withColumn("arrival_seq", F.lit(2).cast("long")), "customers": customers}


@query
def backfill_marts(t: Tables) -> DataFrame:
    """The marts are built, then three days of every source are corrected; what is in them."""
    history = refresh.HistoryTable(t.spark, t.folder("history"), BUCKETS)
    history.merge(t("customer_changes"), "LOAD")
    sources = {}
    for name, fact, derive, key, ts in (
        ("orders", "fact_orders", order_facts, "order_id", "order_timestamp"),
        ("subscriptions", "fact_subscription_events", subscription_facts, "subscription_event_id", "event_timestamp"),
    ):
        source, mart = state.ChangeTable(t.spark, t.folder(name), name, BUCKETS), refresh.monthly_mart(t.spark, t.folder(fact), fact)
        source.merge(t(f"raw_{name}").withColumn("arrival_seq", F.lit(1).cast("long")), "LOAD")
        refresh.refresh_mart(source, mart, derive, key, ts)
        sources[name] = (source, mart, derive, key, ts)
    fixes = corrected(t)
    refresh.backfill(sources, history, fixes, fixes["customers"], "BACKFILL")
    amounts = {"fact_orders": "net_amount_usd", "fact_subscription_events": "mrr_amount_usd"}
    facts = [
        mart.read().groupBy("month").agg(F.count(F.lit(1)).alias("row_count"), F.sum(amounts[mart.name]).cast("decimal(22,2)").alias("amount"))
        .select(F.lit(mart.name).alias("mart"), F.col("month").alias("part"), "row_count", "amount")
        for _, mart, *_ in sources.values()
    ]
    versions = history.current().groupBy("plan_tier").agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit("dim_customer").alias("mart"), F.col("plan_tier").alias("part"), "row_count",
        F.lit(None).cast("decimal(22,2)").alias("amount"))
    return quality.union_all([*facts, versions])


@query
def change_feed(t: Tables) -> DataFrame:
    """What the second batch of order changes took away and brought."""
    source = state.ChangeTable(t.spark, t.folder("orders"), "orders", BUCKETS)
    for seq in (1, 2):
        source.merge(t("order_changes").where(F.col("arrival_seq") == seq), f"BATCH-{seq}")
    return refresh.change_feed(source, 1)


@query
def build_marts(t: Tables) -> DataFrame:
    """The four marts, stored, and what is in them."""
    raw = {s: t(f"raw_{s}") for s in SOURCES}
    built = build.build_marts(t.spark, t.folder("marts"), raw, "BUILD-1", t("customer_changes"))
    stored = build.warehouse(built, raw)
    days = {"dim_date": "date_key", "dim_customer": "int(date_format(valid_from, 'yyyyMMdd'))",
            "fact_orders": "date_key", "fact_subscription_events": "date_key"}
    return quality.union_all([
        stored[mart].selectExpr(f"{day} AS date_key").groupBy("date_key")
        .agg(F.count(F.lit(1)).alias("row_count")).withColumn("mart", F.lit(mart))
        for mart, day in days.items()
    ])


# -- star schema ------------------------------------------------------------


@query
def pit_join(t: Tables) -> DataFrame:
    hot = t.hot_customers("pit_orders", "profile_changes")
    dim = t.history("profile_changes", hot)
    return star.pit_join(t("pit_orders"), dim, "order_timestamp", ["customer_sk", "plan_tier"], hot=hot)


@query
def pit_join_bucketed(t: Tables) -> DataFrame:
    """The same join over stored buckets, without an exchange."""
    hot = t.hot_customers("pit_orders", "profile_changes")
    dim, take = t.history("profile_changes", hot), ["customer_sk", "plan_tier"]
    return star.store_timeline(t("pit_orders"), dim, "order_timestamp", take, BUCKETS, hot=hot).joined()


@query
def revenue_by_tier_pit(t: Tables) -> DataFrame:
    hot = t.hot_customers("pit_orders", "profile_changes")
    return star.revenue_by_tier_pit(t("pit_orders"), t.history("profile_changes", hot), hot)


@query
def revenue_by_tier_current(t: Tables) -> DataFrame:
    return star.revenue_by_tier_current(t("pit_orders"), t.history("profile_changes"))


@query
def dim_customer_members(t: Tables) -> DataFrame:
    """All members, the unknown one among them, with the time of their first version."""
    hot = t.hot_customers("customer_changes")
    return star.with_unknown_member(star.with_first_seen(t.history(hot=hot), hot)).select(
        "customer_sk", "customer_id", "plan_tier", "valid_from", "first_seen_timestamp", "is_current")


@query
def unknown_member(t: Tables) -> DataFrame:
    """Every fact finds a member; revenue per tier adds up to all revenue."""
    hot = t.hot_customers("pit_orders", "profile_changes")
    dim = t.history("profile_changes", hot)
    resolved = star.resolve_customer(t("pit_orders"), dim, "order_timestamp", hot)
    totals = resolved.groupBy("customer_sk").agg(
        F.count(F.lit(1)).alias("n"), F.sum("net_amount_usd").alias("spent"))
    members = star.with_unknown_member(dim).select("customer_sk", "plan_tier")
    return totals.join(members, "customer_sk").groupBy("plan_tier").agg(
        F.sum("n").alias("total_orders"), F.sum("spent").cast("decimal(22,2)").alias("net_revenue"))


@query
def fact_orders_sk(t: Tables) -> DataFrame:
    """All orders, with their own status, method, country and discount, tax by country and
    items by amount, against the history of the customers who placed them."""
    hot = t.hot_customers("raw_orders", "order_profiles")
    dim = marts.dim_customer_scd2(staging.stg_customers(t("order_profiles"), "arrival_seq"), hot)
    rate = F.when(F.col("shipping_country").isin("CHINA", "FRANCE", "GERMANY"), 0.19).otherwise(0.07).cast("decimal(4,2)")
    items = F.floor(F.col("gross_amount_usd") / 50000) + 1
    return star.fact_orders_sk(t.orders(), dim, F.col("net_amount_usd") * rate, items, hot)


@query
def fact_subscription_sk(t: Tables) -> DataFrame:
    hot = t.hot_customers("raw_subscriptions", "profile_changes")
    return star.fact_subscription_sk(t.subscriptions(), t.history("profile_changes", hot), hot_customers=hot)


@query
def tier_transitions(t: Tables) -> DataFrame:
    return star.tier_transitions(t.subscriptions())


@query
def lifecycle_type(t: Tables) -> DataFrame:
    return star.lifecycle_type(t.subscriptions())


@query
def tenure_days(t: Tables) -> DataFrame:
    return star.tenure_days(t.subscriptions())


@query
def dim_date_fiscal(t: Tables) -> DataFrame:
    return marts.dim_date_fiscal(marts.distinct_days(t("raw_orders"), "order_timestamp"), first_month=4)


@query
def role_playing_dates(t: Tables) -> DataFrame:
    both = t("raw_orders").select(F.col("order_timestamp").alias("ts")).union(t("raw_events").select("event_timestamp"))
    return star.role_playing_dates(t.orders(), t.subscriptions(), marts.dim_date_covering(both, "ts"))


@query
def role_playing_dates_mart(t: Tables) -> DataFrame:
    """The calendar of the marts begins long after most orders; none of them is lost."""
    return star.role_playing_dates(t.orders(), t.subscriptions(), t.calendar())


@query
def partition_facts_monthly(t: Tables) -> DataFrame:
    path = t.folder("monthly")
    star.write_monthly(t.orders(), "order_timestamp", path)
    return t.spark.read.parquet(path).groupBy("event_month").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("net_amount_usd").cast("decimal(22,2)").alias("net_revenue"))


@query
def read_month_range(t: Tables) -> DataFrame:
    path = t.folder("monthly")
    star.write_monthly(t.orders(), "order_timestamp", path)
    return star.read_month_range(
        t.spark, path, "order_timestamp", datetime(1997, 11, 15), datetime(1998, 2, 10, 12))


@query
def customer_timeline(t: Tables) -> DataFrame:
    return star.customer_timeline(t.orders(), "CUST-000007").select("order_id", "order_timestamp", "net_amount_usd")


@query
def customer_ltv(t: Tables) -> DataFrame:
    return star.customer_ltv(t.orders(), t.subscriptions())


@query
def cohort_retention(t: Tables) -> DataFrame:
    return star.cohort_retention(t.orders())


@query
def cohort_streaks(t: Tables) -> DataFrame:
    return star.cohort_streaks(t.orders())


@query
def mrr_movement(t: Tables) -> DataFrame:
    return star.mrr_movement(t.subscriptions())


# -- data quality, each check on input that breaks it -----------------------


@query
def dq_not_null(t: Tables) -> DataFrame:
    return quality.dq_not_null(t.all_tables())


@query
def dq_unique(t: Tables) -> DataFrame:
    return quality.dq_unique(t.all_tables())


@query
def dq_accepted_values(t: Tables) -> DataFrame:
    """Raw values against the domains of the cleaned columns."""
    customers, orders, subs = t("raw_customers"), t("raw_orders"), t("raw_subscriptions")
    renamed = subs.withColumnRenamed("status", "subscription_status")
    return quality.dq_accepted_values({
        "stg_customers": customers, "stg_orders": orders, "stg_subscriptions": renamed,
        "dim_customer": customers, "fact_orders": orders, "fact_subscription_events": renamed,
    })


@query
def dq_relationships(t: Tables) -> DataFrame:
    """Facts of both kinds against a calendar that ends too early and starts too late."""
    calendar = marts.dim_date(t.spark, date(1996, 1, 1), date(2024, 1, 20))
    orders = quality.orphans(t.orders(), "date_key", calendar, "date_key")
    subs = quality.orphans(t.subscriptions(), "date_key", calendar, "date_key")
    lost = (("fact_orders", orders, "order_id"), ("fact_subscription_events", subs, "subscription_event_id"))
    return quality.union_all([
        df.select(F.lit(name).alias("table_name"), F.col(key).alias("row_key"), "date_key") for name, df, key in lost])


@query
def dq_dim_customer_grain(t: Tables) -> DataFrame:
    dim = t.history()
    return quality.duplicates(dim.unionByName(dim.where("is_current")), "customer_id", "valid_from")


@query
def dq_scd_overlap(t: Tables) -> DataFrame:
    """Every version; of the closed ones some end a day too late."""
    stretched = F.when((F.year("valid_to") == 9999) | (F.col("plan_tier") == "FREE"), F.col("valid_to")).otherwise(
        F.col("valid_to") + F.expr("interval 1 day"))
    hot = t.hot_customers("customer_changes")
    moved = t.history(hot=hot).withColumn("valid_to", stretched)
    return quality.scd_overlap(moved, hot)


@query
def dq_single_current(t: Tables) -> DataFrame:
    return quality.single_current(t.history().withColumn("is_current", F.lit(True)))


@query
def dq_date_continuity(t: Tables) -> DataFrame:
    """A calendar of only those days that saw an event."""
    return quality.date_continuity(marts.describe_days(marts.distinct_days(t("raw_events"), "event_timestamp")))


@query
def dq_dim_date_grain(t: Tables) -> DataFrame:
    seen = marts.describe_days(marts.distinct_days(t("raw_events"), "event_timestamp"))
    return quality.duplicates(t.calendar().unionByName(seen), "date_day")


@query
def dq_fact_orders_grain(t: Tables) -> DataFrame:
    return quality.duplicates(t.orders("dirty_orders"), "order_id")


@query
def dq_orders_amounts(t: Tables) -> DataFrame:
    return quality.orders_amounts(t.orders("dirty_orders"))


@query
def dq_orders_customers(t: Tables) -> DataFrame:
    return quality.orders_customers(t.orders("dirty_orders"), t.present())


@query
def dq_sub_chronology(t: Tables) -> DataFrame:
    return quality.sub_chronology(t("raw_subscriptions"))


@query
def dq_sub_grain(t: Tables) -> DataFrame:
    facts = t.subscriptions()
    return quality.duplicates(facts.unionByName(facts.where("is_active")), "subscription_event_id")


@query
def dq_check_constraints(t: Tables) -> DataFrame:
    """Every constraint meets rows that break it."""
    history = t.history()
    is_free = F.col("plan_tier") == "FREE"
    empty = history.withColumn("valid_to", F.when(is_free, F.col("valid_from")).otherwise(F.col("valid_to")))
    days = marts.describe_days(marts.distinct_days(t("raw_orders"), "order_timestamp"))
    days = days.withColumns({
        "quarter": F.when(F.col("is_weekend"), F.lit(5)).otherwise(F.col("quarter")),
        "month": F.when(F.col("day_of_week") == 7, F.lit(0)).otherwise(F.col("month")),
    })
    gross = F.when(F.col("payment_method") == "PAYPAL", -F.col("gross_amount_usd")).otherwise(F.col("gross_amount_usd"))
    orders = t.orders().withColumn("gross_amount_usd", gross)
    moves = star.tier_transitions(t.subscriptions()).withColumn(
        "event_type", F.when(F.col("new_plan_tier") == "FREE", "GIFT").when(F.col("new_plan_tier") == "PRO", "RENEWAL"))
    off_by = F.when(F.col("previous_plan_tier").isNull(), 1).otherwise(0)
    moves = moves.withColumn("mrr_delta_usd", F.col("mrr_delta_usd") + off_by)
    return quality.check_constraints({
        "dim_customer": empty, "dim_date": days, "fact_orders": orders, "fact_subscription_events": moves})


@query
def enforce_contract(t: Tables) -> DataFrame:
    """What the contracts say about four broken marts."""
    days = marts.describe_days(marts.distinct_days(t("raw_events"), "event_timestamp"))
    subs = t.subscriptions()
    broken = {
        "dim_date": days.withColumnRenamed("month_name", "month_label"),
        "dim_customer": t.history().withColumn("note", F.lit("extra")),
        "fact_orders": t.orders("dirty_orders").withColumn("date_key", F.col("date_key").cast("string")),
        "fact_subscription_events": subs.withColumn(
            "billing_frequency", F.nullif(F.col("billing_frequency"), F.lit("ANNUAL"))),
    }
    return quality.union_all([quality.contract_report(df, CONTRACTS[name], name) for name, df in broken.items()])


@query
def source_freshness(t: Tables) -> DataFrame:
    return quality.source_freshness({
        "customers": t("customer_changes"), "orders": t("raw_orders"),
        "subscriptions": t("raw_subscriptions"), "events": t("raw_events")}, datetime.fromisoformat(NOW))


@query
def dq_suite(t: Tables) -> DataFrame:
    return quality.dq_suite(t.all_tables(), t.hot_customers("raw_customers"))


# -- monitoring and profiling -----------------------------------------------


@query
def mon_freshness(t: Tables) -> DataFrame:
    return monitoring.freshness(t("raw_events"), t.orders(), ntz(NOW))


@query
def mon_volume(t: Tables) -> DataFrame:
    return monitoring.volume(t.all_tables(), t.baseline())


@query
def mon_key_nulls(t: Tables) -> DataFrame:
    tables = t.all_tables()
    return monitoring.key_nulls(tables["dim_customer"], tables["fact_orders"], tables["fact_subscription_events"])


@query
def mon_duplicate_sk(t: Tables) -> DataFrame:
    dim = t.history()
    return monitoring.duplicate_sk(dim.unionByName(dim.where("is_current")))


@query
def mon_runtime(t: Tables) -> DataFrame:
    return monitoring.runtime(t("run_log"))


@query
def mon_checks(t: Tables) -> DataFrame:
    return monitoring.checks(t.all_tables(), t.baseline(), t("run_log"), ntz(NOW))


@query
def mon_summary(t: Tables) -> DataFrame:
    return monitoring.summary(mon_checks(t))


@query
def profile_table(t: Tables) -> DataFrame:
    return quality.union_all([
        profiling.profile_table(t("raw_customers"), "raw_customers", "customer_id", "source_updated_at"),
        profiling.profile_table(t("dirty_orders"), "raw_orders", "order_id", "order_timestamp"),
        profiling.profile_table(t("raw_subscriptions"), "raw_subscriptions", "subscription_id", "started_at"),
        profiling.profile_table(t("raw_events"), "raw_events", "event_id", "event_timestamp"),
    ])


@query
def reconcile_lake(t: Tables) -> DataFrame:
    landed = {"customers": t("customer"), "orders": t("orders"), "subscriptions": t("events"), "events": t("events")}
    raw = {"customers": t("raw_customers"), "orders": t("dirty_orders"), "subscriptions": t("raw_subscriptions"),
           "events": t("raw_events")}
    return profiling.reconcile_lake(landed, raw, t.baseline()).drop("landing_bytes")


@query
def footer_profile(t: Tables) -> DataFrame:
    """Rows and keys of the landed tables from their footers; bytes have no SQL to compare with."""
    files = {n: (f"{t.sf_dir}/{n}.parquet", key) for n, key in (
        ("customer", "c_custkey"), ("orders", "o_orderkey"), ("lineitem", "l_orderkey"), ("events", "event_id"))}
    return profiling.footer_profile(t.spark, files).drop("bytes")


@query
def table_counts(t: Tables) -> DataFrame:
    """The raw tables, and the table of marks."""
    tables = {f"raw_{s}": t(f"raw_{s}") for s in SOURCES}
    return monitoring.table_counts(tables | {"_pipeline_watermarks": incremental.read_watermarks(t.spark, t("commit_log"))})


# -- streaming --------------------------------------------------------------


@query
def stream_upsert(t: Tables) -> DataFrame:
    """Changes arrive as files in order of arrival, two per micro-batch."""
    files, target = t.folder("changes"), state.ChangeTable(t.spark, t.folder("stream"), "customers", BUCKETS)
    t("customer_changes").repartitionByRange(4, "arrival_seq").write.parquet(files)
    changes = streams.read_changes(t.spark, files, "customers", files_per_batch=2)
    streams.stream_upsert(changes, target, t.folder("checkpoint"))
    return target.current()


@query
def stream_insert_events(t: Tables) -> DataFrame:
    """Events arrive, the stream stops, all of them arrive again with others that are
    older than those seen, most by more than two days; it resumes. Then a stream that
    remembers none of it gets all of them once more."""
    files, checkpoint = t.folder("arrivals"), t.folder("checkpoint")
    table = state.ChangeTable(t.spark, t.folder("events"), "events", BUCKETS)
    arrivals = t("event_arrivals")
    early = (F.col("arrival_seq") == 1) & ((F.col("event_timestamp") > ntz(EVENTS_MARK)) | (F.xxhash64("event_id") % 3 != 0))
    for part in (arrivals.where(early), arrivals.where(~early)):
        part.write.mode("append").parquet(files)
        streams.stream_insert_events(streams.read_changes(t.spark, files, "events"), table, checkpoint)
    streams.stream_insert_events(streams.read_changes(t.spark, files, "events"), table, t.folder("checkpoint"))
    return table.current()
