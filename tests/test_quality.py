"""Checks fire on broken input, stay silent on clean input, and monitors grade."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions.dates import ntz
from tidemark.operators import marts, monitoring, quality, staging, star
from tidemark.schemas import CONTRACTS, PLAN_TIERS


@pytest.fixture(scope="module")
def clean(tables):
    orders = tables.orders()
    lo, hi = orders.agg(F.min("order_date"), F.max("order_date")).first()
    return tables.all_tables() | {
        "raw_orders": tables("raw_orders"), "stg_orders": tables.stg("orders"), "fact_orders": orders,
        "dim_date": marts.dim_date(tables.spark, lo, date(2030, 12, 31)),
    }


def test_suite_on_clean_tables(clean):
    results = quality.dq_suite(clean).collect()
    kinds = {}
    for r in results:
        kinds[r.kind] = kinds.get(r.kind, 0) + 1
    assert kinds == {"unique": 13, "not_null": 69, "accepted_values": 9, "relationships": 2, "singular": 10}
    assert [r for r in results if r.status != "PASS"] == []


def test_suite_on_dirty_tables(tables):
    results = quality.dq_suite(tables.all_tables())
    failed = {(r.table_name, r.kind, r.test_name) for r in results.where("status = 'FAIL'").collect()}
    assert {
        ("raw_orders", "unique", "order_id"), ("raw_orders", "not_null", "customer_id"),
        ("fact_orders", "singular", "grain"), ("fact_orders", "singular", "positive_total"),
        ("fact_orders", "singular", "valid_customers"), ("fact_orders", "relationships", "date_key"),
    } <= failed
    totals = quality.suite_totals(results).first()
    assert (totals.tests, totals.failed) == (103, len(failed))


def test_single_checks_are_silent_on_clean_tables(clean):
    dim, orders, subs = clean["dim_customer"], clean["fact_orders"], clean["fact_subscription_events"]
    silent = [
        quality.dq_unique(clean), quality.dq_not_null(clean).where("violations > 0"),
        quality.dq_accepted_values(clean), quality.scd_overlap(dim), quality.single_current(dim),
        quality.orders_amounts(orders), quality.orders_customers(orders, dim), quality.sub_chronology(subs),
        quality.orphans(orders, "date_key", clean["dim_date"], "date_key"),
        quality.date_continuity(clean["dim_date"]),
    ]
    assert [df.count() for df in silent] == [0] * len(silent)


@pytest.mark.parametrize("break_it, problem", [
    (lambda df: df.drop("payment_method"), "payment_method MISSING"),
    (lambda df: df.withColumn("x", F.lit(1)), "x EXTRA"),
    (lambda df: df.withColumn("date_key", F.col("date_key").cast("long")), "date_key TYPE bigint INSTEAD OF int"),
    (lambda df: df.withColumnRenamed("order_id", "oid"), "order_id MISSING"),
    (lambda df: df.select(*reversed(df.columns)), "POSITION"),
])
def test_contract_stops(tables, break_it, problem):
    with pytest.raises(quality.ContractViolation, match=problem):
        quality.enforce_contract(break_it(tables.orders()), CONTRACTS["fact_orders"], "fact_orders")


def test_contract_stops_nulls_while_writing(tables):
    dirty = quality.enforce_contract(tables.orders("dirty_orders"), CONTRACTS["fact_orders"], "fact_orders")
    with pytest.raises(Exception, match="fact_orders.customer_id must not be NULL"):
        dirty.collect()


@pytest.mark.parametrize("name", CONTRACTS)
def test_contracts_hold(clean, name):
    assert quality.contract_report(clean[name], CONTRACTS[name], name).count() == 0


def test_constraints_hold_on_clean_tables(clean):
    moves = star.lifecycle_type(clean["fact_subscription_events"]).select("subscription_event_id", "event_type")
    deltas = star.tier_transitions(clean["fact_subscription_events"])
    both = deltas.join(moves, "subscription_event_id")
    tables = {n: clean[n] for n in ("dim_customer", "dim_date", "fact_orders")} | {"fact_subscription_events": both}
    assert quality.check_constraints(tables).count() == 0


def test_healthy_monitor(tables, clean):
    baseline = monitoring.table_counts({n: clean[n] for n in clean if n.startswith("raw_")}).withColumnRenamed(
        "row_count", "baseline")
    runs = tables("run_log").withColumn("finished_at", F.col("started_at"))
    newest = tables("raw_events").agg(F.max("event_timestamp")).first()[0]
    summary = monitoring.summary(monitoring.checks(clean, baseline, runs, ntz(newest))).first()
    assert summary.asDict() == {
        "overall_status": "PASS", "total_checks": 13, "passed_checks": 13, "warning_checks": 0, "failed_checks": 0}


def test_degraded_monitor_and_its_report(tables, tmp_path):
    checks = monitoring.checks(tables.all_tables(), tables.baseline(), tables("run_log"), ntz("2026-01-01 00:00:00"))
    failed = {r.pillar for r in checks.where("status = 'FAIL'").collect()}
    assert {"Freshness", "Volume", "Correctness"} <= failed
    monitoring.save_summary(checks, str(tmp_path / "report"))
    (text,) = [p.read_text() for p in (tmp_path / "report").glob("*.json")]
    report = json.loads(text)
    assert (report["overall_status"], len(report["checks"])) == ("FAIL", 13)


@pytest.mark.parametrize("rows, baseline, status", [
    (100, 100, "PASS"), (110, 100, "PASS"), (111, 100, "WARN"), (75, 100, "WARN"), (74, 100, "FAIL"), (5, 0, "FAIL")])
def test_volume_limits(spark, rows, baseline, status):
    expected = spark.createDataFrame([("raw_orders", baseline)], "table_name string, baseline long")
    assert monitoring.volume({"raw_orders": spark.range(rows)}, expected).first().status == status


@pytest.mark.parametrize("hours, status", [(24, "PASS"), (24.01, "WARN"), (48, "WARN"), (48.01, "FAIL")])
def test_freshness_limits(spark, hours, status):
    events = spark.createDataFrame([(datetime(2024, 1, 1),)], "event_timestamp timestamp_ntz")
    orders = spark.createDataFrame([(date(2024, 1, 1),)], "order_date date")
    now = ntz("2024-01-01 00:00:00") + F.make_dt_interval(secs=F.lit(hours * 3600))
    assert monitoring.freshness(events, orders, now).first().status == status


@pytest.mark.parametrize("seconds, status", [(599, "PASS"), (600, "WARN"), (1199, "WARN"), (1200, "FAIL")])
def test_runtime_limits(spark, seconds, status):
    runs = spark.sql(f"select 'r' as run_id, timestamp_ntz'2024-01-01 00:00:00' as started_at, "
                     f"timestamp_ntz'2024-01-01 00:00:00' + interval {seconds} second as finished_at")
    assert monitoring.runtime(runs).first().status == status


def test_manifest(spark, tmp_path):
    path = tmp_path / "manifest.json"
    path.write_text(json.dumps({"tables": {"orders": {"target_rows": 440}, "events": {"target_rows": 7}}}, indent=2))
    found = {r.table_name: r.baseline for r in monitoring.read_manifest(spark, str(path)).collect()}
    assert found == {"raw_orders": 440, "raw_events": 7}


@pytest.mark.parametrize("raw, mapped", [
    (" Professional ", "PRO"), ("pro", "PRO"), ("FREE", "FREE"), ("enterprise", "ENTERPRISE"), ("gold", "STARTER"),
    ("", "STARTER"), (None, "STARTER"), ("\tpro", "STARTER")])
def test_tiers(spark, raw, mapped):
    from tidemark.functions.text import canonicalize

    df = spark.createDataFrame([(raw,)], "x string")
    assert df.select(canonicalize("x", PLAN_TIERS)).first()[0] == mapped


def test_activity_follows_the_raw_status(spark, tables):
    one = tables("raw_subscriptions").limit(1).drop("status", "cancelled_at")
    status = spark.createDataFrame([("unknown",), ("active",), (None,)], "status string")
    raw = one.crossJoin(status).withColumn("cancelled_at", F.lit(None).cast("timestamp_ntz"))
    staged = staging.stg_subscriptions(raw.select(*tables("raw_subscriptions").columns)).collect()
    assert {(r.subscription_status, r.is_active) for r in staged} == {("ACTIVE", False), ("ACTIVE", True)}
