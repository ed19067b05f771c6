"""Data-quality checks. A check returns the rows that violate it; none means passed."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.functions.dates import hours_between, ntz
from tidemark.operators.marts import CALENDAR_END, CALENDAR_START, date_spine
from tidemark.operators.skew import HOT_ROWS, Heat, along_key
from tidemark.schemas import GENERIC_TESTS, LIFECYCLE_TYPES, SOURCES, TableTests


class ContractViolation(Exception):
    """A table does not match its contract."""


def _tally(df: DataFrame, conditions: dict[str, str], label: str) -> DataFrame:
    """Count the rows that meet each named SQL condition: one pass, one row per name."""
    pairs = ", ".join(
        f"named_struct('{label}', '{name}', 'violations', count_if({condition}))"
        for name, condition in conditions.items())
    return df.selectExpr(f"array({pairs}) AS _pairs").selectExpr("inline(_pairs)")


def _listed(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by halves, which keeps the plan shallow."""
    if len(frames) == 1:
        return frames[0]
    half = len(frames) // 2
    return union_all(frames[:half]).unionByName(union_all(frames[half:]))


# -- generic checks ---------------------------------------------------------


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs per column, all columns in one pass."""
    return _tally(df, {c: f"`{c}` IS NULL" for c in columns}, "column_name")


def duplicates(df: DataFrame, *columns: str) -> DataFrame:
    """Key values that occur more than once; NULL keys are another check's business."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    counted = df.where(present).groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.where("row_count > 1")


def unaccepted(df: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    """Values outside the list, with their counts."""
    counted = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.where(~F.col("value").isin(*values))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose reference does not exist. NULL references are not orphans."""
    known = parent.select(F.col(parent_column).alias("_known")).distinct()
    return child.where(F.col(column).isNotNull()).join(known, F.col(column) == F.col("_known"), "left_anti")


def dq_not_null(tables: dict[str, DataFrame]) -> DataFrame:
    """Every required column of every table, one pass per table."""
    return union_all([
        null_counts(df, list(GENERIC_TESTS[name].not_null))
        .select(F.lit(name).alias("table_name"), "column_name", "violations")
        for name, df in tables.items()
    ])


def dq_unique(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all([
        duplicates(df, column).select(
            F.lit(name).alias("table_name"), F.lit(column).alias("column_name"),
            F.col(column).cast("string").alias("value"), "row_count")
        for name, df in tables.items() for column in GENERIC_TESTS[name].unique
    ])


def dq_accepted_values(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all([
        unaccepted(df, column, values).select(
            F.lit(name).alias("table_name"), F.lit(column).alias("column_name"), "value", "row_count")
        for name, df in tables.items() for column, values in GENERIC_TESTS[name].accepted
    ])


# -- checks on one table ----------------------------------------------------


def scd_overlap(dim: DataFrame, hot: Heat | int = HOT_ROWS) -> DataFrame:
    """Versions that start before an earlier version of the customer has ended.

    Some version overlaps another exactly if such a version exists; the running end
    of all earlier versions finds it without pairing versions with each other. Beside each such
    version stands the earlier one that ends last (of several, that of the greatest key).
    """
    spans = dim.groupBy("customer_id", "customer_sk", "valid_from").agg(F.max("valid_to").alias("valid_to"))

    def ended(window):
        end = F.when(F.col("valid_to").isNotNull(), F.struct("valid_to", "customer_sk"))
        return {"_earlier": F.max(end).over(window.rowsBetween(Window.unboundedPreceding, -1))}

    judged = along_key(
        spans, "customer_id", ["valid_from"], ended, hot=hot,
        rank=["valid_to", "customer_sk"])
    overlapping = judged.where(F.col("valid_from") < F.col("_earlier.valid_to"))
    return overlapping.select(
        *spans.columns, F.col("_earlier.valid_to").alias("earlier_valid_to"), F.col("_earlier.customer_sk").alias("earlier_customer_sk"))


def single_current(dim: DataFrame) -> DataFrame:
    return duplicates(dim.where("is_current"), "customer_id").withColumnRenamed("row_count", "active_records_count")


def date_continuity(calendar: DataFrame, start: date = CALENDAR_START, end: date = CALENDAR_END) -> DataFrame:
    """Days the calendar lacks."""
    expected = date_spine(calendar.sparkSession, start, end).withColumnRenamed("date_day", "expected_date")
    days = calendar.select(F.col("date_day").alias("_day")).distinct()
    return expected.join(days, F.col("expected_date") == F.col("_day"), "left_anti")


BAD_AMOUNTS = "net_amount_usd < 0 OR discount_usd > gross_amount_usd OR gross_amount_usd < 0"
BAD_CHRONOLOGY = "cancelled_at < started_at"


def orders_amounts(facts: DataFrame) -> DataFrame:
    return facts.where(BAD_AMOUNTS).select("order_id", "gross_amount_usd", "discount_usd", "net_amount_usd")


def orders_customers(facts: DataFrame, dim: DataFrame) -> DataFrame:
    """Orders of customers the dimension does not know, orders without one included."""
    known = dim.select(F.col("customer_id").alias("_known")).distinct()
    return facts.select("order_id", "customer_id").join(known, F.col("customer_id") == F.col("_known"), "left_anti")


def sub_chronology(facts: DataFrame) -> DataFrame:
    return facts.where(BAD_CHRONOLOGY).select("subscription_event_id", "subscription_id", "started_at", "cancelled_at")


# Row conditions per table: name -> (key column, condition that must not be false).
CHECKS = {
    "dim_customer": ("customer_sk", {
        "validity_window": lambda: F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from")),
    }),
    "dim_date": ("date_key", {
        "quarter_range": lambda: F.col("quarter").between(1, 4),
        "month_range": lambda: F.col("month").between(1, 12),
    }),
    "fact_orders": ("order_id", {
        "gross_not_negative": lambda: F.col("gross_amount_usd") >= 0,
        "net_is_gross_less_discount":
            lambda: F.col("net_amount_usd") == F.col("gross_amount_usd") - F.col("discount_usd"),
    }),
    "fact_subscription_events": ("subscription_event_id", {
        "event_type_domain": lambda: F.col("event_type").isin(*LIFECYCLE_TYPES),
        "mrr_delta": lambda: F.col("mrr_delta_usd") == F.col("new_mrr_usd") - F.col("previous_mrr_usd"),
    }),
}


def check_constraints(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows that fail a named condition; an unknown result passes. One pass per table."""
    frames = []
    for name, df in tables.items():
        key, conditions = CHECKS[name]
        failed = F.array(*[F.when(~make(), F.lit(rule)) for rule, make in conditions.items()])
        frames.append(df.select(
            F.lit(name).alias("table_name"), F.col(key).cast("string").alias("row_key"),
            F.explode(F.array_compact(failed)).alias("constraint_name")))
    return union_all(frames)


# -- contracts --------------------------------------------------------------


def schema_problems(df: DataFrame, contract: T.StructType) -> list[tuple[str, str]]:
    """Columns that are missing, extra, of another type or out of order."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    want = {f.name: f.dataType.simpleString() for f in contract}
    problems = [(c, "MISSING") for c in want if c not in have]
    problems += [(c, "EXTRA") for c in have if c not in want]
    problems += [(c, f"TYPE {have[c]} INSTEAD OF {want[c]}") for c in want if c in have and have[c] != want[c]]
    if not problems and list(have) != list(want):
        problems = [(c, "POSITION") for c, w in zip(have, want) if c != w]
    return problems


def contract_report(df: DataFrame, contract: T.StructType, name: str) -> DataFrame:
    """All violations of a contract: of the schema, and NULLs in required columns."""
    spark = df.sparkSession
    schema = "table_name string, column_name string, problem string, row_count long"
    shape = spark.createDataFrame([(name, c, p, None) for c, p in schema_problems(df, contract)], schema)
    required = [f.name for f in contract if not f.nullable and f.name in df.columns]
    if not required:
        return shape
    nulls = null_counts(df, required).where("violations > 0")
    return shape.unionByName(nulls.select(
        F.lit(name).alias("table_name"), "column_name", F.lit("NULL VALUES").alias("problem"),
        F.col("violations").alias("row_count")))


def enforce_contract(df: DataFrame, contract: T.StructType, name: str) -> DataFrame:
    """The frame itself if its schema matches. A NULL in a required column stops the
    write that consumes it, so the data is not read twice to look for one."""
    problems = schema_problems(df, contract)
    if problems:
        raise ContractViolation(f"{name}: " + ", ".join(f"{c} {p}" for c, p in problems))

    def guarded(field: T.StructField) -> Column:
        column = F.col(field.name)
        if field.nullable:
            return column
        message = F.lit(f"{name}.{field.name} must not be NULL")
        return F.coalesce(column, F.raise_error(message).cast(field.dataType)).alias(field.name)

    return df.select(*[guarded(f) for f in contract])


# -- freshness and the suite ------------------------------------------------


def source_freshness(tables: dict[str, DataFrame], now: datetime | Column) -> DataFrame:
    """Age of the newest row per source against its limits."""
    clock = ntz(now) if isinstance(now, datetime) else now
    frames = []
    for name, df in tables.items():
        source = SOURCES[name]
        stamp = "_ingested_at" if "_ingested_at" in df.columns else source.ts
        warn, error = source.stale_hours
        newest = df.agg(F.max(stamp).alias("max_loaded_at"), F.max(clock).alias("_now"))
        age = hours_between(F.col("_now"), F.col("max_loaded_at"))
        frames.append(newest.select(
            F.lit(name).alias("source_name"), "max_loaded_at",
            F.round(age, 2).alias("age_hours"),
            F.when(age.isNull() | (age > error), "ERROR").when(age > warn, "WARN").otherwise("PASS").alias("status")))
    return union_all(frames)


def _one_pass(name: str, df: DataFrame, tests: TableTests, singular: dict[str, str]) -> DataFrame:
    """Every row-level test of a table in one aggregate."""
    counts = {f"not_null:{c}": f"`{c}` IS NULL" for c in tests.not_null}
    counts |= {f"accepted_values:{c}": f"`{c}` NOT IN ({_listed(v)})" for c, v in tests.accepted}
    counts |= {f"singular:{test}": condition for test, condition in singular.items()}
    return _tally(df, counts, "_test").selectExpr(
        f"'{name}' AS table_name", "split_part(_test, ':', 1) AS kind", "split_part(_test, ':', 2) AS test_name",
        "violations")


def _counted(name: str, kind: str, test: str, violations: DataFrame, of: Column | None = None) -> DataFrame:
    total = F.count(F.lit(1)) if of is None else F.coalesce(F.sum(of), F.lit(0))
    return violations.agg(total.cast("long").alias("violations")).select(
        F.lit(name).alias("table_name"), F.lit(kind).alias("kind"), F.lit(test).alias("test_name"), "violations")


def dq_suite(tables: dict[str, DataFrame], hot: Heat | int = HOT_ROWS) -> DataFrame:
    """All 103 tests, one row each: 93 generic and 10 singular.

    Counts are rows for NULLs, values, references and row conditions, and keys for
    uniqueness and grain.
    """
    dim, orders, subs = tables["dim_customer"], tables["fact_orders"], tables["fact_subscription_events"]
    calendar = tables["dim_date"]
    row_tests = {
        "fact_orders": {"positive_total": BAD_AMOUNTS},
        "fact_subscription_events": {"chronology": BAD_CHRONOLOGY},
    }
    frames = []
    for name, df in tables.items():
        tests = GENERIC_TESTS[name]
        frames.append(_one_pass(name, df, tests, row_tests.get(name, {})))
        frames += [_counted(name, "unique", c, duplicates(df, c)) for c in tests.unique]
        for c in tests.dates:
            # References are counted per value before they meet the calendar.
            per_day = df.groupBy(c).agg(F.count(F.lit(1)).alias("n"))
            frames.append(_counted(name, "relationships", c, orphans(per_day, c, calendar, "date_key"), F.col("n")))
    per_customer = orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    known = dim.select(F.col("customer_id").alias("_known")).distinct()
    lost = per_customer.join(known, F.col("customer_id") == F.col("_known"), "left_anti")
    frames += [
        _counted("dim_customer", "singular", "grain", duplicates(dim, "customer_id", "valid_from")),
        _counted("dim_customer", "singular", "no_overlap", scd_overlap(dim, hot)),
        _counted("dim_customer", "singular", "single_current", single_current(dim)),
        _counted("dim_date", "singular", "continuity", date_continuity(calendar)),
        _counted("dim_date", "singular", "grain", duplicates(calendar, "date_day")),
        _counted("fact_orders", "singular", "grain", duplicates(orders, "order_id")),
        _counted("fact_orders", "singular", "valid_customers", lost, F.col("n")),
        _counted("fact_subscription_events", "singular", "grain", duplicates(subs, "subscription_event_id")),
    ]
    return union_all(frames).withColumn("status", F.when(F.col("violations") == 0, "PASS").otherwise("FAIL"))


def suite_totals(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count(F.lit(1)).alias("tests"), F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") == "FAIL").alias("failed"))
