"""Warehouse health: freshness, volume, correctness, runtime. One row per check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.dates import hours_between
from tidemark.operators.quality import union_all
from tidemark.schemas import (
    FRESH_PASS_HOURS, FRESH_WARN_HOURS, RUNTIME_PASS_SECONDS, RUNTIME_WARN_SECONDS,
    VOLUME_PASS_PERCENT, VOLUME_WARN_PERCENT,
)

MONITORED = (
    "raw_customers", "raw_orders", "raw_subscriptions", "raw_events",
    "dim_customer", "fact_orders", "fact_subscription_events",
)
BASELINE_OF = {"dim_customer": "raw_customers", "fact_orders": "raw_orders",
               "fact_subscription_events": "raw_subscriptions"}


def _graded(value: Column, good: float, fair: float) -> Column:
    return F.when(value <= good, "PASS").when(value <= fair, "WARN").otherwise("FAIL")


def _age_status(age: Column) -> Column:
    return F.when(age.isNull(), "FAIL").otherwise(_graded(age, FRESH_PASS_HOURS, FRESH_WARN_HOURS))


def _variance(actual: Column) -> Column:
    """Percent above or below the baseline; NULL where there is nothing to compare with."""
    return (actual - F.col("baseline")) * 100.0 / F.nullif(F.col("baseline"), F.lit(0))


def _volume_status(percent: Column) -> Column:
    return F.when(percent.isNull(), "FAIL").otherwise(_graded(F.abs(percent), VOLUME_PASS_PERCENT, VOLUME_WARN_PERCENT))


def freshness(events: DataFrame, orders: DataFrame, now: Column) -> DataFrame:
    """Age of the newest event at the logical time ``now``, with the newest order date."""
    newest = events.agg(F.max("event_timestamp").alias("max_event_ts"), F.max(now).alias("_now"))
    ordered = orders.agg(F.max("order_date").alias("max_order_date"))
    age = hours_between(F.col("_now"), F.col("max_event_ts"))
    both = newest.unionByName(ordered, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns]).select(
        "max_event_ts", "max_order_date", F.round(age, 2).alias("age_hours"),
        _age_status(age).alias("status"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all([
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Baselines from a manifest: {"tables": {"orders": {"target_rows": n}, ...}}."""
    schema = "tables map<string, struct<target_rows: bigint>>"
    found = spark.read.schema(schema).json(path, multiLine=True)
    return found.select(F.explode("tables")).select(
        F.concat(F.lit("raw_"), "key").alias("table_name"), F.col("value.target_rows").alias("baseline"))


def volume(tables: dict[str, DataFrame], baseline: DataFrame) -> DataFrame:
    """Row counts against baselines; a mart is measured by the source it comes from.

    Nothing expected, or no baseline at all, fails rather than dividing by zero.
    """
    counts = table_counts({n: tables[n] for n in MONITORED if n in tables})
    source = F.create_map(*[F.lit(x) for pair in BASELINE_OF.items() for x in pair])
    counts = counts.withColumn("_source", F.coalesce(source[F.col("table_name")], F.col("table_name")))
    expected = baseline.select(F.col("table_name").alias("_source"), "baseline")
    percent = _variance(F.col("row_count"))
    return counts.join(expected, "_source", "left").select(
        "table_name", F.col("row_count").alias("actual"), "baseline",
        F.round(percent, 2).alias("variance_percent"), _volume_status(percent).alias("status"))


def key_nulls(dim: DataFrame, orders: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Rows without a required key."""
    conditions = (
        ("dim_customer", dim, F.col("customer_id").isNull()),
        ("fact_orders", orders, F.col("order_id").isNull() | F.col("customer_id").isNull()),
        ("fact_subscription_events", subscriptions, F.col("subscription_id").isNull()),
    )
    return union_all([
        df.agg(F.count_if(condition).alias("null_keys")).select(F.lit(name).alias("table_name"), "null_keys")
        for name, df, condition in conditions
    ]).withColumn("status", F.when(F.col("null_keys") == 0, "PASS").otherwise("FAIL"))


def duplicate_sk(dim: DataFrame) -> DataFrame:
    """Rows beyond the first per surrogate key. Exact: keys are counted, then summed."""
    per_key = dim.groupBy("customer_sk").agg(F.count(F.lit(1)).alias("n"))
    # A NULL key is no key, so all its rows are surplus.
    surplus = F.when(F.col("customer_sk").isNull(), F.col("n")).otherwise(F.col("n") - 1)
    return per_key.agg(F.coalesce(F.sum(surplus), F.lit(0)).alias("duplicate_keys")).withColumn(
        "status", F.when(F.col("duplicate_keys") == 0, "PASS").otherwise("FAIL"))


def runtime(runs: DataFrame) -> DataFrame:
    """Grade the duration of runs."""
    seconds = (F.unix_seconds(F.col("finished_at").cast("timestamp"))
               - F.unix_seconds(F.col("started_at").cast("timestamp")))
    return runs.select(
        "run_id", seconds.alias("runtime_seconds"),
        F.when(seconds < RUNTIME_PASS_SECONDS, "PASS").when(seconds < RUNTIME_WARN_SECONDS, "WARN")
        .otherwise("FAIL").alias("status"))


#: What each pillar is held against, for the report.
THRESHOLDS = (
    ("Freshness", f"{FRESH_PASS_HOURS} h, {FRESH_WARN_HOURS} h"),
    ("Volume", f"{VOLUME_PASS_PERCENT} %, {VOLUME_WARN_PERCENT} %"),
    ("Correctness", "0"),
    ("Runtime", f"{RUNTIME_PASS_SECONDS} s, {RUNTIME_WARN_SECONDS} s"),
)
EXPLANATIONS = (("PASS", "within the first threshold"), ("WARN", "between the thresholds"), ("FAIL", "beyond the last threshold"))
REQUIRED_KEYS = (
    ("dim_customer", ("customer_id",)),
    ("fact_orders", ("order_id", "customer_id")),
    ("fact_subscription_events", ("subscription_id",)),
)


def _measured(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, rows without a required key and newest event of each table: one aggregate
    per table, so every table is read once."""
    required, sides = dict(REQUIRED_KEYS), []
    for name in MONITORED:
        if name in tables:
            absent = [F.col(c).isNull() for c in required.get(name, ())]
            nulls = F.count_if(reduce(Column.__or__, absent)) if absent else F.lit(None).cast("long")
            newest = F.max("event_timestamp") if name == "raw_events" else F.lit(None).cast("timestamp_ntz")
            sides.append(tables[name].agg(
                F.count(F.lit(1)).alias("actual"), nulls.alias("null_keys"), newest.alias("newest")
            ).withColumn("table_name", F.lit(name)))
    return union_all(sides)


def checks(tables: dict[str, DataFrame], baseline: DataFrame, runs: DataFrame, now: Column) -> DataFrame:
    """The 13 checks in one shape. The runtime check grades the slowest run."""
    def check(pillar: str, metric: Column, value: Column, status: Column) -> Column:
        return F.struct(
            F.lit(pillar).alias("pillar"), metric.alias("metric"), value.cast("string").alias("actual_value"),
            status.alias("status"))

    source = F.create_map(*[F.lit(x) for pair in BASELINE_OF.items() for x in pair])
    expected = baseline.select(F.col("table_name").alias("_source"), "baseline")
    found = _measured(tables).withColumn("_source", F.coalesce(source[F.col("table_name")], F.col("table_name")))
    found = found.join(expected, "_source", "left")
    percent, age = _variance(F.col("actual")), hours_between(now, F.col("newest"))
    none = F.lit(None)
    rows = found.select(F.explode(F.array(
        check("Volume", F.col("table_name"), F.col("actual"), _volume_status(percent)),
        F.when(F.col("null_keys").isNotNull(), check(
            "Correctness", F.concat("table_name", F.lit("_key_nulls")), F.col("null_keys"),
            F.when(F.col("null_keys") == 0, "PASS").otherwise("FAIL"))).otherwise(none),
        F.when(F.col("table_name") == "raw_events", check(
            "Freshness", F.lit("event_age_hours"), F.floor(F.round(age, 2)).cast("long"), _age_status(age))).otherwise(none),
    )).alias("c")).where("c is not null").select("c.*")
    duplicates = duplicate_sk(tables["dim_customer"]).select(check(
        "Correctness", F.lit("dim_customer_duplicate_keys"), F.col("duplicate_keys"), F.col("status")).alias("c")).select("c.*")
    slowest = runtime(runs.withColumns({
        "_s": F.col("finished_at") - F.col("started_at")}).agg(
            F.max_by(F.struct("run_id", "started_at", "finished_at"), "_s").alias("r")).select("r.*"))
    timed = slowest.select(check("Runtime", F.lit("slowest_run_seconds"), F.col("runtime_seconds"), F.col("status")).alias("c")).select("c.*")
    looked_up = lambda pairs, c: F.create_map(*[F.lit(x) for pair in pairs for x in pair])[F.col(c)]
    return union_all([rows, duplicates, timed]).select(
        "pillar", "metric", "actual_value", looked_up(THRESHOLDS, "pillar").alias("threshold"), "status",
        looked_up(EXPLANATIONS, "status").alias("explanation"))


def _rollup() -> list[Column]:
    failed = F.count_if(F.col("status") == "FAIL")
    warned = F.count_if(F.col("status") == "WARN")
    return [
        F.when(failed > 0, "FAIL").when(warned > 0, "WARN").otherwise("PASS").alias("overall_status"),
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("status") == "PASS").alias("passed_checks"),
        warned.alias("warning_checks"), failed.alias("failed_checks"),
    ]


def summary(results: DataFrame) -> DataFrame:
    """Overall status is that of the worst check."""
    return results.agg(*_rollup())


def save_summary(results: DataFrame, path: str) -> None:
    """The roll-up with its check rows, at most one per check, as one JSON document."""
    rows = F.collect_list(F.struct(*results.columns)).alias("checks")
    results.agg(*_rollup(), rows).coalesce(1).write.mode("overwrite").json(path)
