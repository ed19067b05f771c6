"""Incremental history, change feeds and monthly refreshes against full rebuilds."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_cdc import frame, random_log

from tidemark.functions.dates import ntz
from tidemark.operators import cdc, marts, refresh, skew, staging
from tidemark.operators.state import ChangeTable
from tidemark.plans.queries import order_facts
from tidemark.schemas import CONTRACTS

FACT = CONTRACTS["fact_orders"].fieldNames()


def rebuilt(changes):
    return marts.dim_customer_scd2(staging.stg_customers(changes, "arrival_seq"), skew.CALM)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_split_in_any_order_equals_the_rebuild(spark, tmp_path, seed):
    """Few instants, so changes meet at the same one and have to be told by arrival."""
    log, rng = random_log("customers", seed, n=250, keys=12), random.Random(seed)
    for record in log:
        record["source_updated_at"] = datetime(2024, 1, 1) + timedelta(minutes=rng.randrange(25))
    parts = [[] for _ in range(4)]
    for record in log:
        rng.choice(parts).append(record)
    table, so_far = refresh.HistoryTable(spark, str(tmp_path), 3), []
    for no, part in enumerate(parts):
        table.merge(frame(spark, "customers", part), f"B{no}", hot=60 if no % 2 else skew.HOT_ROWS)
        so_far += part
        if no in (0, 3):
            assert rows(table.current()) == rows(rebuilt(frame(spark, "customers", so_far)))
    again = table.merge(frame(spark, "customers", parts[1]), "B1")
    assert again.replayed
    table.merge(frame(spark, "customers", parts[1]), "again")
    assert rows(table.current()) == rows(rebuilt(frame(spark, "customers", log)))


def test_only_buckets_of_the_batch_are_written(spark, tables, tmp_path):
    table, changes = refresh.HistoryTable(spark, str(tmp_path), 8), tables("customer_changes")
    table.merge(changes.where("arrival_seq % 2 = 0"), "A")
    before = table.head().parts
    one = changes.select(F.max("customer_id")).first()[0]
    table.merge(changes.where((F.col("customer_id") == one) & (F.col("arrival_seq") % 2 == 1)), "B")
    after = table.head().parts
    assert sum(before.get(b) != after[b] for b in after) == 1
    expected = changes.where((F.col("arrival_seq") % 2 == 0) | (F.col("customer_id") == one))
    assert rows(table.current()) == rows(rebuilt(expected))
    assert table.merge(changes.where("false"), "C").offered == 0
    with pytest.raises(ValueError, match="8 buckets, not 4"):
        refresh.HistoryTable(spark, str(tmp_path), 4).merge(changes, "D")


@pytest.fixture
def followed(spark, tmp_path):
    source = ChangeTable(spark, str(tmp_path / "orders"), "orders", 4, max_deltas=2)
    return source, refresh.monthly_mart(spark, str(tmp_path / "mart"), "fact_orders")


def follow(followed):
    return refresh.refresh_mart(*followed, order_facts, "order_id", "order_timestamp")


def test_refresh_equals_rebuild_after_inserts_updates_and_backfill(spark, tables, followed):
    source, mart = followed
    changes = tables("order_changes")
    cut = changes.selectExpr("percentile_approx(order_timestamp, 0.9)").first()[0]
    early = changes.where((F.col("arrival_seq") == 1) & (F.col("order_timestamp") <= ntz(cut)))
    for no, batch in enumerate((early, changes.where(F.col("arrival_seq") <= 2), changes.where("arrival_seq = 4"))):
        source.merge(batch, f"B{no}")
        follow(followed)
        assert rows(mart.read(), *FACT) == rows(order_facts(source.current()), *FACT)
    assert follow(followed) == []  # nothing new: no commit
    # Three days are delivered again with corrected amounts.
    days = changes.where("arrival_seq = 1").where(F.col("order_timestamp").between(ntz("1997-03-04"), ntz("1997-03-06 23:59:59")))
    fixed = days.withColumns({"order_amount_usd": (F.col("order_amount_usd") + 1).cast("decimal(12,2)"),
                              "source_updated_at": ntz("2001-01-01"), "arrival_seq": F.lit(9).cast("long")})
    before = mart.head().parts
    source.merge(fixed, "FIX")
    assert follow(followed) == ["199703"]
    after = mart.head().parts
    assert {m for m in after if before[m] != after[m]} == {"199703"} and set(before) == set(after)
    assert rows(mart.read(), *FACT) == rows(order_facts(source.current()), *FACT)
    assert refresh.stands_for(mart) == source.head().number


def test_rows_that_move_to_another_month_or_stay_as_they_are(spark, tables, followed):
    source, mart = followed
    first = tables("order_changes").where("arrival_seq = 1")
    source.merge(first, "A")
    follow(followed)
    source.merge(first, "SAME")  # rewritten as they were
    feed = refresh.change_feed(source, 1)
    assert feed.count() == 0
    assert follow(followed) == [] and refresh.stands_for(mart) == 2
    assert rows(refresh.change_feed(source, 0).drop("_change")) == rows(cdc.upsert_orders(first))
    with pytest.raises(ValueError, match="no commit 7"):
        refresh.change_feed(source, 7)


def test_subscriptions_follow_their_source(spark, tables, tmp_path):
    source = ChangeTable(spark, str(tmp_path / "subs"), "subscriptions", 4)
    mart = refresh.monthly_mart(spark, str(tmp_path / "mart"), "fact_subscription_events")
    derive = lambda raw: marts.fact_subscription_events(staging.stg_subscriptions(raw))
    for seq in (1, 2, 3, 4):
        source.merge(tables("subscription_changes").where(F.col("arrival_seq") == seq), f"B{seq}")
        refresh.refresh_mart(source, mart, derive, "subscription_event_id", "event_timestamp")
    names = CONTRACTS["fact_subscription_events"].fieldNames()
    assert rows(mart.read(), *names) == rows(derive(cdc.upsert_subscriptions(tables("subscription_changes"))), *names)


def test_a_month_that_loses_its_rows_disappears(spark, tables, tmp_path):
    """Subscription times never move, order times neither; a derived time may."""
    source = ChangeTable(spark, str(tmp_path / "orders"), "orders", 2)
    mart = refresh.monthly_mart(spark, str(tmp_path / "mart"), "fact_orders")
    by_update = lambda raw: order_facts(raw.withColumn("order_timestamp", F.col("source_updated_at")))
    first = tables("order_changes").where("arrival_seq = 1").orderBy("order_id").limit(5)
    source.merge(first.withColumn("source_updated_at", ntz("1990-05-05")), "A")
    refresh.refresh_mart(source, mart, by_update, "order_id", "order_timestamp")
    assert list(mart.head().parts) == ["199005"]
    source.merge(first.withColumns({"source_updated_at": ntz("1991-06-06"), "arrival_seq": F.lit(2).cast("long")}), "B")
    assert refresh.refresh_mart(source, mart, by_update, "order_id", "order_timestamp") == ["199005", "199106"]
    assert list(mart.head().parts) == ["199106"] and mart.read().count() == 5


def test_backfill_touches_only_its_parts(spark, tables, tmp_path):
    from tidemark.plans import queries as q

    fixes = q.corrected(tables)
    history = refresh.HistoryTable(spark, str(tmp_path / "history"), 16)
    history.merge(tables("customer_changes"), "LOAD")
    source, mart = ChangeTable(spark, str(tmp_path / "orders"), "orders", 4), refresh.monthly_mart(spark, str(tmp_path / "mart"), "fact_orders")
    source.merge(tables("order_changes").where("arrival_seq = 1"), "LOAD")
    sources = {"orders": (source, mart, order_facts, "order_id", "order_timestamp")}
    refresh.refresh_mart(source, mart, order_facts, "order_id", "order_timestamp")
    one = fixes["customers"].where(F.col("customer_id") == fixes["customers"].select(F.min("customer_id")).first()[0])
    touched = refresh.backfill(sources, history, fixes, one, "BACKFILL")
    assert touched["fact_orders"] == ["199703"] and len(touched["dim_customer"]) == 1
    assert rows(mart.read(), *FACT) == rows(order_facts(source.current()), *FACT)
    assert rows(history.current()) == rows(rebuilt(tables("customer_changes").unionByName(one)))


def test_first_feed_moves_no_row_and_later_ones_join(spark, tables, tmp_path):
    source = ChangeTable(spark, str(tmp_path / "orders"), "orders", 4)
    changes = tables("order_changes")
    for seq in (1, 2):
        source.merge(changes.where(F.col("arrival_seq") == seq), f"B{seq}")
    plan = lambda feed: feed._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(refresh.change_feed(source, 0, source.head_at(1)))
    feed = refresh.change_feed(source, 1)
    assert "Join" in plan(feed)
    old, now = source.state(source.head_at(1), list(source.head().parts)), source.current()
    assert rows(feed.where("_change = 'in'").drop("_change")) == rows(now.exceptAll(old.select(*now.columns)))
    assert rows(feed.where("_change = 'out'").drop("_change")) == rows(old.select(*now.columns).exceptAll(now))


def test_feed_of_rows_without_a_key(spark, tables, tmp_path):
    source = ChangeTable(spark, str(tmp_path / "orders"), "orders", 4)
    raw = tables("raw_orders")
    some = spark.createDataFrame([(None, *r[1:]) if i == 0 else tuple(r) for i, r in enumerate(raw.limit(3).collect())], raw.schema)
    source.merge(some.withColumn("arrival_seq", F.lit(1)), "B1")
    later = some.where("order_id is null").withColumn("source_updated_at", F.expr("source_updated_at + interval 1 day")).withColumn("order_status", F.lit("paid"))
    source.merge(later.withColumn("arrival_seq", F.lit(2)), "B2")
    found = [(r.order_id, r.order_status, r["_change"]) for r in refresh.change_feed(source, 1).orderBy(F.desc("_change")).collect()]
    assert [(k, c) for k, _, c in found] == [(None, "out"), (None, "in")] and found[1][1] == "paid"
