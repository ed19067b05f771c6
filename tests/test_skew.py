"""Treating keys as hot changes the plan, never the result."""

from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import cdc, marts, quality, skew, staging, star
from tidemark.schemas import TS

COOL, HOT = skew.CALM, 3


def ticks(spark, spec):
    """(key, offset in seconds, sequence) rows with a timestamp."""
    start = datetime(2024, 3, 1)
    data = [(k, start + timedelta(seconds=s), n) for k, s, n in spec]
    return spark.createDataFrame(data, "k string, ts timestamp_ntz, n long")


@pytest.fixture(scope="module")
def uneven(spark):
    """One key with many rows over many minutes, one NULL key, two small ones."""
    spec = [("big", (i * 37) % 4000, i) for i in range(200)]
    spec += [(None, i * 50, i) for i in range(30)] + [("a", 5, 1), ("b", 9, 1), ("b", 7, 2)]
    return ticks(spark, spec)


def test_find_hot_counts_null_as_a_key(uneven):
    heat = skew.find_hot(uneven, "k", 10)
    assert {r[0] for r in heat.keys.collect()} == {"big", None}
    assert skew.find_hot(uneven, "k", 1000) is skew.CALM


@pytest.mark.parametrize("forward", [True, False])
def test_neighbours(uneven, forward):
    def add(window):
        step = F.lag if forward else F.lead
        return {"near": step("n").over(window)}

    plain, split = (
        skew.along_key(uneven, "k", ["ts", "n"], add, hot=hot, forward=forward)
        for hot in (COOL, 2))
    assert plain.columns == split.columns
    assert rows(plain) == rows(split)


def test_running_value(uneven):
    def add(window):
        return {"top": F.max("n").over(window.rowsBetween(-1_000_000, -1))}

    plain, split = (
        skew.along_key(uneven, "k", ["ts", "n"], add, hot=hot, rank=["n"])
        for hot in (COOL, 2))
    assert rows(plain) == rows(split)


def test_key_value(uneven):
    plain, split = (skew.with_key_value(uneven, "k", hot, first=F.min("ts"), n_max=F.max("n")) for hot in (COOL, 2))
    assert rows(plain) == rows(split)


def test_rows_of_one_time_are_split(spark):
    same = ticks(spark, [("big", 0, i) for i in range(2000)])
    chunks = skew._chunked(same, "k", ["ts", "n"]).groupBy("_chunk").count().collect()
    assert len(chunks) >= 3 and max(r["count"] for r in chunks) < 1200

    def add(window):
        return {"near": F.lag("n").over(window)}

    plain, split = (skew.along_key(same, "k", ["ts", "n"], add, hot=hot) for hot in (COOL, 2))
    assert rows(plain) == rows(split)


@pytest.fixture(scope="module")
def history(tables):
    """The change log with several changes at one instant."""
    log = tables("customer_changes")
    again = log.withColumn("arrival_seq", F.col("arrival_seq") + 50_000_000_000).withColumn("plan_tier", F.lit("pro"))
    return staging.stg_customers(log.unionByName(again.where("plan_tier = 'pro' and _source_op = 'I'")), "arrival_seq")


@pytest.mark.parametrize("build", [marts.dim_customer_scd2, marts.scd2_compact])
@pytest.mark.parametrize("missing", [False, True])
def test_history(history, build, missing):
    if missing:  # a tenth of the times, several of them at one customer
        lost = F.pmod(F.xxhash64("customer_id", "arrival_seq"), F.lit(10)) == 0
        history = history.withColumn("source_updated_at", F.when(~lost, F.col("source_updated_at")))
    assert rows(build(history, hot=COOL)) == rows(build(history, hot=HOT))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot", [HOT, 40, 75])
def test_pit_join(tables, how, hot):
    dim = tables.history("profile_changes")
    facts = tables("pit_orders")
    facts = facts.unionByName(facts.where("net_amount_usd > 400")).unionByName(
        facts.where("net_amount_usd < 20").withColumn("customer_id", F.lit(None).cast("string")))
    take = ["customer_sk", "plan_tier"]
    plain = star.pit_join(facts, dim, "order_timestamp", take, how=how, hot=COOL)
    split = star.pit_join(facts, dim, "order_timestamp", take, how=how, hot=hot)
    assert rows(plain) == rows(split)
    if how == "left":
        assert plain.count() == facts.count()


def test_pit_join_equals_range_join(tables):
    dim, facts = tables.history("profile_changes"), tables("pit_orders")
    d = dim.select(F.col("customer_id").alias("c"), "valid_from", "valid_to", "customer_sk")
    on = (F.col("customer_id") == F.col("c")) & (F.col("order_timestamp") >= F.col("valid_from")) & (
        F.col("order_timestamp") < F.col("valid_to"))
    expected = facts.join(d, on).select("order_id", "customer_sk")
    found = star.pit_join(facts, dim, "order_timestamp", ["customer_sk"])
    assert rows(found.select("order_id", "customer_sk")) == rows(expected)


def test_pit_join_takes_open_end_as_null(tables):
    dim, facts = tables.history("profile_changes"), tables("pit_orders")
    null_end = dim.withColumn("valid_to", F.when(F.year("valid_to") < 9999, F.col("valid_to")))
    assert rows(star.pit_join(facts, dim, "order_timestamp", ["customer_sk"])) == rows(
        star.pit_join(facts, null_end, "order_timestamp", ["customer_sk"], hot=HOT))


def test_pit_join_respects_gaps(spark):
    dim = spark.createDataFrame(
        [("c", datetime(2024, 1, 1), datetime(2024, 1, 2), "v1"), ("c", datetime(2024, 1, 5), None, "v2")],
        "customer_id string, valid_from timestamp_ntz, valid_to timestamp_ntz, v string")
    facts = spark.createDataFrame(
        [(i, "c", datetime(2024, 1, d)) for i, d in enumerate((1, 2, 3, 5, 6))],
        "id int, customer_id string, at timestamp_ntz")
    for hot in (COOL, 1):
        found = star.pit_join(facts, dim, "at", ["v"], how="left", hot=hot)
        assert [r.v for r in found.orderBy("id").collect()] == ["v1", None, None, "v2", "v2"]


@pytest.mark.parametrize("build", [star.tier_transitions, star.lifecycle_type, star.tenure_days, star.mrr_movement])
def test_subscriptions(tables, build):
    facts = tables.subscriptions()
    assert rows(build(facts, hot=COOL)) == rows(build(facts, hot=HOT))


def test_subscription_facts(tables):
    facts, dim = tables.subscriptions(), tables.history("profile_changes")
    plain, split = (star.fact_subscription_sk(facts, dim, hot, hot) for hot in (COOL, HOT))
    assert rows(plain) == rows(split)
    assert plain.count() == facts.count()


def test_upserts(tables):
    log = tables("subscription_changes")
    assert rows(cdc.reject_stale_subscriptions(log, COOL)) == rows(cdc.reject_stale_subscriptions(log, 2))


@pytest.mark.parametrize("together", [False, True])
def test_reject_stale(tables, together):
    log = tables("customer_changes")
    if together:
        log = log.withColumn("arrival_seq", F.col("arrival_seq") % 2)
    plain = cdc.reject_stale(log, "customer_id", "source_updated_at", COOL)
    split = cdc.reject_stale(log, "customer_id", "source_updated_at", HOT)
    assert rows(plain) == rows(split)


def test_overlap(tables):
    dim = tables.history().withColumn(
        "valid_to", F.when(F.year("valid_to") < 9999, F.col("valid_to") + F.expr("interval 1 day")))
    dim = dim.where("valid_to is not null")
    plain, split = quality.scd_overlap(dim, COOL), quality.scd_overlap(dim, HOT)
    assert rows(plain) == rows(split)
    assert plain.count() > 0
    assert quality.scd_overlap(tables.history(), HOT).count() == 0


def test_order_projection(tables):
    from tidemark.sources.upstream import project_orders

    inputs = [tables(n) for n in ("up_orders", "up_payment_intents", "up_payment_methods", "up_addresses")]
    plain, split = project_orders(*inputs, hot=COOL), project_orders(*inputs, hot=1)
    assert skew.find_hot(inputs[1], "order_id", 1).keys is not None
    assert rows(plain) == rows(split)


def test_types_survive(uneven):
    assert uneven.schema["ts"].dataType == TS
