"""The reductions against applying records one by one."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import cdc, skew, state
from tidemark.operators.state import ChangeTable, content_signature, verify_idempotent
from tidemark.plans import ingest, queries
from tidemark.schemas import SOURCES, T

UPSERTS = {
    "customers": cdc.upsert_customers, "orders": cdc.upsert_orders,
    "subscriptions": cdc.upsert_subscriptions, "events": cdc.insert_events,
}


def random_log(source, seed, n=400, keys=25):
    """Changes with ties, stale records and a key that owns a third of them."""
    rng, s = random.Random(seed), SOURCES[source]
    log = []
    for seq in range(n):
        record = {}
        for f in s.schema:
            kind = f.dataType
            if f.name == s.key:
                record[f.name] = "k0" if rng.random() < 0.33 else f"k{rng.randrange(keys)}"
            elif isinstance(kind, T.TimestampNTZType):
                record[f.name] = datetime(2024, 1, 1) + timedelta(minutes=rng.randrange(60))
            elif isinstance(kind, T.DecimalType):
                record[f.name] = Decimal(rng.randrange(10_000)) / 100
            elif isinstance(kind, T.BooleanType):
                record[f.name] = rng.random() < 0.2
            else:
                record[f.name] = None if f.nullable and rng.random() < 0.2 else f"v{rng.randrange(50)}"
        record["arrival_seq"] = seq
        log.append(record)
    return log


def apply_one_by_one(source, log, stored=None):
    """What a row store does with guarded inserts and updates, record by record."""
    s, stored = SOURCES[source], {} if stored is None else stored
    for record in sorted(log, key=lambda r: r["arrival_seq"]):
        row = {c: record[c] for c in s.columns}
        old = stored.get(row[s.key])
        if old is None:
            stored[row[s.key]] = row
        elif s.mutable and row[s.ts] >= old[s.ts]:
            old.update({c: row[c] for c in s.mutable})
    return stored


def frame(spark, source, log):
    schema = T.StructType(SOURCES[source].schema.fields + [T.StructField("arrival_seq", T.LongType())])
    shuffled = random.Random(1).sample(log, len(log))
    return spark.createDataFrame([tuple(r[c] for c in schema.fieldNames()) for r in shuffled], schema)


def as_rows(source, stored):
    columns = sorted(SOURCES[source].columns)
    return sorted((tuple(r[c] for c in columns) for r in stored.values()), key=repr)


@pytest.mark.parametrize("source", SOURCES)
@pytest.mark.parametrize("seed", [1, 2])
def test_reduction_equals_sequential(spark, source, seed):
    log = random_log(source, seed)
    assert rows(UPSERTS[source](frame(spark, source, log))) == as_rows(source, apply_one_by_one(source, log))


@pytest.mark.parametrize("seed", range(3, 9))
def test_subscriptions_in_any_split(spark, seed):
    """Reduced in random parts, then together, as tasks and batches do."""
    rng, log = random.Random(seed), random_log("subscriptions", seed, n=rng_size(seed), keys=6)
    parts = [[] for _ in range(rng.randrange(1, 6))]
    for record in log:
        rng.choice(parts).append(record)
    frames = [frame(spark, "subscriptions", p).repartition(3) for p in parts if p]
    whole = frames[0]
    for f in frames[1:]:
        whole = whole.unionByName(f)
    expected = as_rows("subscriptions", apply_one_by_one("subscriptions", log))
    assert rows(cdc.upsert_subscriptions(whole)) == expected


def rng_size(seed):
    return (1, 2, 10, 60, 300, 900)[seed % 6]


def test_subscriptions_that_all_end_too_late(spark):
    """Times only fall, so of each key the first arrival wins; equal times go to the last."""
    log = random_log("subscriptions", 4, n=120, keys=5)
    for i, record in enumerate(log):
        record["event_timestamp"] = datetime(2024, 1, 2) - timedelta(minutes=i // 2)
    changes = frame(spark, "subscriptions", log)
    assert cdc.unsettled_subscriptions(cdc.as_changes(changes)).count() == len({r["subscription_event_id"] for r in log})
    assert rows(cdc.upsert_subscriptions(changes)) == as_rows("subscriptions", apply_one_by_one("subscriptions", log))


@pytest.mark.parametrize("source", SOURCES)
@pytest.mark.parametrize("max_deltas", [0, 1])
def test_batches_equal_one_load(spark, tmp_path, source, max_deltas):
    """Cut at random points and offered one after the other, some of them twice."""
    log = random_log(source, 7)
    cuts = sorted(random.Random(source).sample(range(1, len(log)), 2))
    table, stored = ChangeTable(spark, str(tmp_path), source, 4, max_deltas), {}
    for no, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, len(log)])):
        batch = frame(spark, source, log[lo:hi])
        first = table.merge(batch, f"B{no}")
        apply_one_by_one(source, log[lo:hi], stored)
        assert (first.offered, first.replayed) == (hi - lo, False)
        assert rows(table.current()) == as_rows(source, stored)
    again = table.merge(batch, "B2")
    assert (again.applied, again.replayed) == (0, True)
    assert table.watermark() == max(r[SOURCES[source].ts] for r in log)
    assert table.change_log().count() == len(log)


def test_reoffered_rows_change_nothing(spark, tmp_path):
    tables, batches = {}, {}
    for source in ("orders", "events"):
        tables[source] = ChangeTable(spark, str(tmp_path / source), source, 4)
        batches[source] = frame(spark, source, random_log(source, 9, n=60))
        tables[source].merge(batches[source], "B0")

    def again():
        for source, table in tables.items():
            table.merge(batches[source], "B1")

    assert all(r.delta == 0 and r.same_content for r in verify_idempotent(tables, again).collect())


def unreadable(changes):
    return changes.withColumn("_batch_id", F.raise_error(F.lit("no connection")).cast("string"))


def test_a_failed_source_fails_the_run_after_the_others(spark, tmp_path):
    inputs = {source: frame(spark, source, random_log(source, 11, n=40)) for source in ("customers", "orders", "events")}
    broken = inputs | {"customers": unreadable(inputs["customers"]), "events": unreadable(inputs["events"])}
    with pytest.raises(ingest.RunFailed, match="(?s)source customers failed.*no connection.*source events failed") as failed:
        ingest.run_all(spark, str(tmp_path), broken, "R1", buckets=2)
    assert failed.value.offered == {"customers": 0, "orders": 40, "events": 0}
    assert set(failed.value.problems) == {"customers", "events"}
    found = {n: ChangeTable(spark, f"{tmp_path}/{n}", n, 2).commits().first()["status"] for n in inputs}
    assert found == {"customers": "FAILED", "orders": "SUCCESS", "events": "FAILED"}
    # What failed can be run again, and nothing new is no failure.
    assert ingest.run_all(spark, str(tmp_path), inputs, "R2", buckets=2) == {"customers": 40, "orders": 0, "events": 40}


@pytest.mark.parametrize("failing", ["RUN-1", "RUN-2"])
def test_a_failed_run_is_not_idempotent(spark, monkeypatch, failing):
    """Neither a first run nor a rerun that lost a source ends in equal counts and signatures."""
    inputs, run_source = {n: frame(spark, n, random_log(n, 12, n=40)) for n in ("orders", "events")}, ingest.run_source

    def failing_once(spark, root, source, changes, run_id, **options):
        lost = source == "orders" and run_id == failing
        return run_source(spark, root, source, unreadable(changes) if lost else changes, run_id, **options)

    monkeypatch.setattr(queries, "change_logs", lambda t: inputs)
    monkeypatch.setattr(ingest, "run_source", failing_once)
    with pytest.raises(ingest.RunFailed, match="(?s)source orders failed.*no connection"):
        queries.verify_idempotent(queries.Tables(spark, ""))


@pytest.mark.parametrize("source", SOURCES)
def test_merge_shuffles_rows_once(spark, tmp_path, monkeypatch, source):
    """For the reduction and for the files together, in a first load and in an addition."""
    plans, replace = [], ChangeTable.replace

    def noted(self, rows, *args, **options):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return replace(self, rows, *args, **options)

    monkeypatch.setattr(ChangeTable, "replace", noted)
    table, batch = ChangeTable(spark, str(tmp_path), source, 4), frame(spark, source, random_log(source, 3, n=40))
    for no in range(2):
        table.merge(batch, f"B{no}")
    assert [plan.count("Exchange") for plan in plans] == [1, 1]


@pytest.mark.parametrize("source", SOURCES)
def test_large_buckets_and_repeated_keys(spark, tmp_path, monkeypatch, source):
    """Buckets over several tasks, one key combined before the others are dealt; a rewrite with stored rows."""
    monkeypatch.setattr(state, "TASK_ROWS", 15)
    monkeypatch.setattr(state, "FEW_ROWS", 10)
    monkeypatch.setattr(state, "REPEATED", 25)
    log, stored = random_log(source, 11), {}
    table = ChangeTable(spark, str(tmp_path), source, 2, max_deltas=0)
    for no, (lo, hi) in enumerate([(0, 150), (150, 400)]):
        table.merge(frame(spark, source, log[lo:hi]), f"B{no}")
        apply_one_by_one(source, log[lo:hi], stored)
    assert rows(table.current()) == as_rows(source, stored)
    assert max(len(list(p.glob("*.parquet"))) for p in tmp_path.glob("data/v=1/bucket=*")) > 1


@pytest.mark.parametrize("source,column", [("orders", "order_status"), ("orders", "payment_method"), ("subscriptions", "status")])
def test_digests_tell_states_apart(spark, tmp_path, source, column):
    """One per key, the same however the state lies in files, and another where one value is."""
    log, signatures = random_log(source, 12, n=40), []
    other = [r | {column: "another"} for r in log]
    for name, batches in (("one", [log]), ("two", [log[:20], log]), ("other", [other])):
        table = ChangeTable(spark, str(tmp_path / name), source, 2)
        for no, batch in enumerate(batches):
            table.merge(frame(spark, source, batch), f"B{no}")
        signatures.append(content_signature(table.digests()).first())
    assert signatures[0] == signatures[1] and signatures[0].row_count == len({r[SOURCES[source].key] for r in log})
    assert signatures[0].content_hash != signatures[2].content_hash


def test_scenario_insert_update_stale_delete(spark, tmp_path):
    """Insert, upgrade, an older record that must be ignored, and a deletion."""
    t0 = datetime(2026, 3, 25, 12)
    steps = [(0, "FREE", "ACTIVE", "I", False), (2, "ENTERPRISE", "ACTIVE", "U", False),
             (1, "STARTER", "ACTIVE", "U", False), (5, "ENTERPRISE", "CHURNED", "D", True)]
    expected = ["FREE", "ENTERPRISE", "ENTERPRISE", "ENTERPRISE"]
    table, schema = ChangeTable(spark, str(tmp_path), "customers", 2, max_deltas=0), SOURCES["customers"].schema
    for seq, ((hours, tier, status, op, gone), tier_after) in enumerate(zip(steps, expected)):
        record = ("CUST-1", "A", "B", "a@b.c", "US", tier, status, "web", t0 + timedelta(hours=hours), op, gone, f"B{seq}")
        batch = spark.createDataFrame([record], schema).withColumn("arrival_seq", F.lit(seq).cast("long"))
        outcome = table.merge(batch, f"B{seq}")
        assert outcome.applied == (0 if seq == 2 else 1)
        (row,) = table.current().collect()
        assert row.plan_tier == tier_after
    assert (row._is_deleted, row._source_op, row.account_status) == (True, "D", "CHURNED")
    assert cdc.live_rows(table.current()).count() == 0
    assert cdc.tombstones(table.current()).count() == 1


def test_stale_records_are_the_ones_the_guard_ignored(spark):
    log = random_log("customers", 5)
    ignored, stored = [], {}
    for r in log:
        old = stored.get(r["customer_id"])
        if old is not None and r["source_updated_at"] < old:
            ignored.append((r["arrival_seq"],))
        else:
            stored[r["customer_id"]] = r["source_updated_at"]
    found = cdc.reject_stale(frame(spark, "customers", log), "customer_id", "source_updated_at", skew.CALM)
    assert rows(found, "arrival_seq") == sorted(ignored, key=repr)


def test_unknown_source(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown source"):
        ChangeTable(spark, str(tmp_path), "invoices")
