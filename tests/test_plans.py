"""What the physical plans must and must not contain."""

import re

import pytest

import __spark_entry__ as entry


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = sorted(set(entry.queries()) - {
    "scan_csv_landing", "write_landing_by_day", "record_failure", "run_source", "run_all", "backfill_window",
    "merge_into_target", "verify_idempotent", "build_marts", "materialize_mart", "partition_facts_monthly", "read_month_range",
    "stream_upsert", "stream_insert_events", "dim_customer_incremental", "refresh_fact_orders", "change_feed",
    "pit_join_bucketed", "backfill_marts"})


#: Operators that may use Python are those of the language-model part, but for the native one.
PYTHON = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas", "FlatMapGroupsInArrow")


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    free = re.match(r"op\d+_|pipeline$", name) and not name.startswith("op2_")
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", *(() if free else PYTHON)):
        assert bad not in text


def test_newest_row_is_picked_before_the_shuffle(spark, tables):
    from tidemark.operators import cdc

    text = plan(cdc.upsert_customers(tables("customer_changes")))
    assert re.search(r"Final.*Exchange.*Partial", text, re.S) and text.count("Exchange") == 1


def test_orders_upsert_combines_before_its_only_shuffle(spark, tables):
    from tidemark.operators import cdc

    text = plan(cdc.upsert_orders(tables("order_changes")))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_min_by" in text


def test_subscriptions_upsert_combines_before_every_shuffle(spark, tables):
    """Each shuffle of the first step carries what a partial aggregate left; the second
    step meets only unsettled keys, a small stored table, and combines before its shuffle."""
    from tidemark.operators import cdc

    log = tables("subscription_changes")
    text = plan(cdc.upsert_subscriptions(log))
    assert "Window" not in text and "partial_min_by" in text and "partial_max_by" in text
    assert "BroadcastHashJoin" in text
    for exchange in re.finditer(r"Exchange hashpartitioning[^\n]*\n([^\n]*)", text):
        assert re.search(r"Sort|Aggregate", exchange.group(1)) and "partial" in text[exchange.end() - len(exchange.group(1)):][:4000]
    settled = plan(cdc.upsert_subscriptions(log.where("arrival_seq = 1")))
    assert settled.count("Exchange hashpartitioning") == 1 and "Join" not in settled


def test_history_shuffles_once(tables):
    assert plan(tables.history()).count("Exchange") == 1


def test_point_in_time_join_sorts_facts_once(tables):
    from tidemark.operators import star

    text = plan(star.pit_join(tables("pit_orders"), tables.history(), "order_timestamp", ["customer_sk"]))
    assert "Join" not in text and text.count("Exchange") == 2


def test_time_condition_reaches_the_scan(spark, sf_dir):
    text = plan(entry.queries()["scan_landing"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in text


def test_columns_are_pruned(spark, sf_dir):
    text = plan(entry.queries()["customer_ltv"](spark, sf_dir))
    assert "o_orderpriority" not in text and "props" not in text


@pytest.mark.parametrize("hot", [10 ** 9, 40])
def test_bucketed_point_in_time_join_moves_no_row(spark, tables, hot):
    """No exchange, planned or run; without bucketed reads one, and the same rows. Hot
    keys are joined apart, from plain tables. Facts may be added."""
    from conftest import rows

    from tidemark.operators import star

    facts, dim, take = tables("pit_orders"), tables.history("profile_changes"), ["customer_sk", "plan_tier"]
    expected, half = rows(star.pit_join(facts, dim, "order_timestamp", take)), "xxhash64(order_id) % 2 = 0"
    timeline = star.store_timeline(facts.where(half), dim, "order_timestamp", take, 4, hot=hot)
    timeline.add_facts(facts.where(f"not {half}"))
    joined = timeline.joined()
    if hot > 40:
        ran = joined._jdf.queryExecution()
        assert rows(joined) == expected and "Bucketed: true" in plan(joined)
        assert "Exchange" not in plan(joined) and "Join" not in plan(joined)
        joined.collect()
        assert "Exchange" not in ran.executedPlan().toString()
        spark.conf.set("spark.sql.sources.bucketing.enabled", "false")
        assert plan(timeline.joined()).count("Exchange") == 1
    else:
        assert timeline.heat.keys is not None
    try:
        assert rows(timeline.joined()) == expected and len(expected) > 100
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.enabled")


def test_counts_come_from_footers(spark, sf_dir):
    from tidemark.operators import profiling

    text = plan(profiling.footer_aggregates(profiling.footer_session(spark), f"{sf_dir}/orders.parquet", "o_orderkey"))
    assert re.search(r"PushedAggregation: \[COUNT\(\*\), COUNT\(o_orderkey\), MIN\(o_orderkey\), MAX\(o_orderkey\)", text)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_bytes_of_footer_profile(spark, tmp_path):
    from tidemark.operators import profiling

    path = tmp_path / "t"
    spark.range(1000).selectExpr("if(id % 10 = 0, null, id) as k").repartition(3).write.parquet(str(path))
    (row,) = profiling.footer_profile(spark, {"t": (str(path), "k")}).collect()
    files = list(path.glob("*.parquet"))
    assert (row.row_count, row.null_keys, row.min_key, row.max_key, row.files) == (1000, 100, 1, 999, len(files))
    assert row.bytes == sum(f.stat().st_size for f in files)
