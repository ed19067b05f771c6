"""Commits, marks and partitions of versioned tables."""

from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions.dates import effective_mark, ntz
from tidemark.operators import cdc, incremental, marts, star, state
from tidemark.operators.quality import ContractViolation
from tidemark.plans import ingest
from tidemark.schemas import CONTRACTS, EPOCH, T
from tidemark.session import new_folder, shared_root
from tidemark.sources import landing
from tidemark.streaming import ingest as streams

SCHEMA = T.StructType().add("id", "long").add("dt", "string")


def fixed(df):
    """Its rows, once and for all."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def days(spark, n, shift=0):
    return spark.range(n).select((F.col("id") + shift).alias("id"), F.concat(F.lit("d"), F.col("id") % 3).alias("dt"))


def test_partitions_are_replaced_and_disappear(spark, tmp_path):
    table = state.VersionedTable(spark, str(tmp_path), "t", SCHEMA, "dt")
    assert table.read().count() == 0
    table.replace(days(spark, 9), "A", None)
    table.replace(days(spark, 9, 100).where("dt = 'd1'"), "B", ["d1", "d2"])
    assert rows(table.read()) == rows(
        days(spark, 9).where("dt = 'd0'").unionByName(days(spark, 9, 100).where("dt = 'd1'")))


def test_uncommitted_data_is_invisible(spark, tmp_path):
    table = state.VersionedTable(spark, str(tmp_path), "t", SCHEMA, "dt")
    table.replace(days(spark, 9), "A", None)
    before = rows(table.read())
    # A job that wrote its files and died before the commit.
    days(spark, 9, 500).write.partitionBy("dt").parquet(f"{tmp_path}/data/v=2")
    assert rows(table.read()) == before
    table.replace(days(spark, 3, 7), "B", None)
    assert rows(table.read()) == rows(days(spark, 3, 7))


def test_failure_keeps_table_and_mark(spark, tables, tmp_path):
    changes = tables("order_changes")
    ingest.run_source(spark, str(tmp_path), "orders", changes, "RUN-1", buckets=2)
    table = state.ChangeTable(spark, f"{tmp_path}/orders", "orders", 2)
    before, mark = rows(table.current()), table.watermark()
    broken = changes.withColumn("order_status", F.raise_error(F.lit("no connection")).cast("string"))
    with pytest.raises(Exception, match="no connection"):
        ingest.run_source(spark, str(tmp_path), "orders", broken, "RUN-2", full_refresh=True, buckets=2)
    assert (rows(table.current()), table.watermark()) == (before, mark)
    row = incremental.current_marks(table.commits()).first()
    assert row.status == "FAILED" and "no connection" in row.error_message
    assert row.watermark == mark and row.records == changes.count()
    # The failed run did not use up its id.
    assert not ingest.run_source(spark, str(tmp_path), "orders", changes, "RUN-2", full_refresh=True, buckets=2).replayed


def test_late_row_needs_the_lookback(spark, tables, tmp_path):
    changes = tables("order_changes").where("arrival_seq = 1")
    top = changes.agg(F.max("source_updated_at")).first()[0]
    late = changes.orderBy(F.desc("source_updated_at")).limit(1).withColumns({
        "order_id": F.lit("ORD-LATE"), "source_updated_at": ntz(top - timedelta(minutes=45))})
    ids = {}
    for lookback in (None, timedelta(hours=1)):
        root = str(tmp_path / str(bool(lookback)))
        ingest.run_source(spark, root, "orders", changes, "RUN-1", buckets=2)
        ingest.run_source(spark, root, "orders", changes.unionByName(late), "RUN-2", lookback=lookback, buckets=2)
        current = state.ChangeTable(spark, f"{root}/orders", "orders", 2).current()
        ids[bool(lookback)] = current.where("order_id = 'ORD-LATE'").count()
        assert current.count() == changes.count() + ids[bool(lookback)]
    assert ids == {False: 0, True: 1}


def test_effective_mark():
    hour = timedelta(hours=1)
    assert effective_mark(EPOCH, hour) == EPOCH
    assert effective_mark(EPOCH + timedelta(minutes=5), hour) == EPOCH
    assert effective_mark(datetime(2024, 1, 2), hour) == datetime(2024, 1, 1, 23)
    assert effective_mark(datetime(2024, 1, 2), None) == datetime(2024, 1, 2)


def test_mark_round_trip(spark, tables, tmp_path):
    table = state.ChangeTable(spark, str(tmp_path), "events", 2)
    batch = tables("event_arrivals").where("arrival_seq = 1").limit(150).withColumn(
        "event_timestamp", ntz("2026-03-25 12:00:00"))
    table.merge(batch, "BATCH-WM")
    row = incremental.current_marks(table.commits()).first()
    assert (row.watermark, row.batch_id, row.status, row.records) == (
        datetime(2026, 3, 25, 12), "BATCH-WM", "SUCCESS", 150)


def test_empty_batch(spark, tables, tmp_path):
    table = state.ChangeTable(spark, str(tmp_path), "customers", 2)
    assert table.merge(tables("customer_changes").where("false"), "B0").offered == 0
    assert table.watermark() == EPOCH and table.current().count() == 0


def test_missing_landing_path_is_empty(spark, tmp_path):
    schema = T.StructType().add("ts", T.TimestampNTZType())
    assert landing.scan_landing(spark, str(tmp_path / "none"), schema, "ts", EPOCH).count() == 0


def test_csv_keeps_quotes_blanks_and_nulls(spark, tmp_path):
    data = [('say "hi", twice', None, 1), ("  padded ", "", 2), ("line\\break", "x", None)]
    df = spark.createDataFrame(data, "a string, b string, n int")
    landing.write_csv_landing(df, str(tmp_path / "csv"))
    assert rows(landing.scan_csv_landing(spark, str(tmp_path / "csv"), df.schema)) == rows(df)
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.csv").write_text('a,b,n\n"x","y","not a number"\n')
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        landing.scan_csv_landing(spark, str(tmp_path / "bad"), df.schema).collect()


def test_mart_is_rebuilt_and_checked(spark, tables):
    root, contract = new_folder(spark, "mart"), CONTRACTS["fact_orders"]
    state.materialize_mart(spark, root, "fact_orders", tables.orders(), contract, "B1")
    smaller = tables.orders().where("order_status = 'COMPLETED'")
    built = state.materialize_mart(spark, root, "fact_orders", smaller, contract, "B2")
    assert rows(built.read().drop("slice")) == rows(smaller)
    with pytest.raises(ContractViolation, match="net_amount_usd MISSING"):
        state.materialize_mart(spark, root, "fact_orders", smaller.drop("net_amount_usd"), contract, "B3")
    with pytest.raises(Exception, match="customer_id must not be NULL"):
        state.materialize_mart(spark, root, "fact_orders", tables.orders("dirty_orders"), contract, "B4")
    assert rows(built.read().drop("slice")) == rows(smaller)


def test_shared_folder_comes_from_the_session(spark):
    assert new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_month_range_reads_only_its_months(spark, tables):
    path = new_folder(spark, "months")
    star.write_monthly(tables.orders(), "order_timestamp", path)
    df = star.read_month_range(spark, path, "order_timestamp", datetime(1997, 11, 15), datetime(1998, 2, 10))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_month" in plan and "199711" in plan
    assert df.select("event_month").distinct().count() <= 4


def test_calendar(spark):
    calendar = marts.dim_date(spark)
    assert calendar.count() == 4018
    day = {r.date_key: r for r in calendar.where("date_key in (20210101, 20240229, 20230101)").collect()}
    assert (day[20210101].week_of_year, day[20210101].day_of_week, day[20210101].day_name) == (53, 5, "Friday")
    assert (day[20240229].month_name, day[20240229].is_weekend) == ("February", False)
    assert day[20230101].is_weekend and day[20230101].day_of_week == 7
    assert [(f.name, f.dataType) for f in calendar.schema] == [(f.name, f.dataType) for f in CONTRACTS["dim_date"]]


def test_fiscal_year(spark):
    days = spark.sql("select explode(array(date'2024-03-31', date'2024-04-01', date'2024-12-31')) as date_day")
    fiscal = [(r.fiscal_year, r.fiscal_quarter) for r in marts.dim_date_fiscal(days, 4).orderBy("date_day").collect()]
    assert fiscal == [(2024, 4), (2025, 1), (2025, 3)]
    assert [r.fiscal_quarter for r in marts.dim_date_fiscal(days).orderBy("date_day").collect()] == [1, 2, 4]


def test_history_of_one_row_per_customer_is_that_row(tables):
    present = tables.present()
    assert present.count() == tables("raw_customers").count()
    assert present.where("year(valid_to) < 9999").count() == 0
    # A deleted customer's version stays open but is not current.
    assert present.where("not is_current").count() == tables("raw_customers").where("_is_deleted").count()


def test_history_intervals_are_contiguous(tables):
    dim = tables.history()
    nexts = dim.selectExpr("customer_id as c", "valid_from as f")
    closed = dim.where("year(valid_to) < 9999")
    on = (F.col("c") == F.col("customer_id")) & (F.col("f") == F.col("valid_to"))
    assert closed.join(nexts, on).count() == closed.count()
    assert dim.where("is_current").groupBy("customer_id").count().where("count > 1").count() == 0


def test_redelivered_micro_batches_change_nothing(spark, tables, tmp_path):
    files, table = str(tmp_path / "in"), state.ChangeTable(spark, str(tmp_path / "t"), "events", 2)
    tables("event_arrivals").repartition(2).write.parquet(files)
    for attempt in range(2):  # the second time with no memory of the first
        stream = streams.read_changes(spark, files, "events", files_per_batch=1)
        streams.stream_upsert(stream, table, str(tmp_path / f"checkpoint{attempt}"))
    assert rows(table.current(), "event_id") == rows(tables("raw_events"), "event_id")


def test_second_checkpoint_brings_other_rows(spark, tables, tmp_path):
    table, changes = state.ChangeTable(spark, str(tmp_path / "t"), "customers", 2), tables("customer_changes")
    first = F.pmod(F.xxhash64("customer_id"), F.lit(2)) == 0
    for no, part in enumerate((changes.where(first), changes.where(~first))):
        part.write.parquet(f"{tmp_path}/in{no}")
        stream = streams.read_changes(spark, f"{tmp_path}/in{no}", "customers")
        streams.stream_upsert(stream, table, f"{tmp_path}/checkpoint{no}")
    assert rows(table.current()) == rows(cdc.upsert_customers(changes))


def test_bucket_count_is_kept(spark, tables, tmp_path):
    changes, root = tables("customer_changes"), str(tmp_path)
    state.ChangeTable(spark, root, "customers", 8).merge(changes.where("arrival_seq % 2 = 0"), "A")
    with pytest.raises(ValueError, match="8 buckets, not 64"):
        state.ChangeTable(spark, root, "customers", 64).merge(changes, "B")
    table = state.ChangeTable(spark, root, "customers")
    table.merge(changes.where("arrival_seq % 2 = 1"), "C")
    expected = rows(cdc.upsert_customers(changes))
    assert rows(table.current()) == expected
    table.rebucket(3, "D")
    assert table.head().buckets == 3 and rows(table.current()) == expected
    assert rows(state.ChangeTable(spark, root, "customers", 3).current()) == expected


@pytest.mark.parametrize("source", ["customers", "events"])
def test_many_small_merges_keep_paths_bounded(spark, tables, tmp_path, monkeypatch, source):
    monkeypatch.setattr(state, "MAX_FILES", 3)
    log = tables("customer_changes" if source == "customers" else "event_arrivals")
    table = state.ChangeTable(spark, str(tmp_path), source, 2, max_deltas=3)
    part = F.pmod(F.xxhash64(table.source.key), F.lit(12))
    for no in range(12):
        table.merge(log.where(part == no), f"B{no}")
        assert all(len(v) <= 4 for v in table.head().parts.values())
    reduced = cdc.upsert_customers(log) if source == "customers" else cdc.insert_events(log)
    assert rows(table.current()) == rows(reduced)


def test_projection_needs_no_arrival_order(spark, tables, tmp_path):
    from tidemark.sources.upstream import project_orders

    changes = project_orders(*[tables(n) for n in ("up_orders", "up_payment_intents", "up_payment_methods", "up_addresses")])
    assert "arrival_seq" not in changes.columns
    at = datetime(2030, 5, 6, 7, 8, 9)
    assert ingest.run_source(spark, str(tmp_path), "orders", changes, "RUN-1", loaded_at=at).offered == changes.count()
    later = changes.withColumns({"source_updated_at": F.col("source_updated_at") + F.expr("interval 1 day"), "order_status": F.lit("refunded")})
    ingest.run_source(spark, str(tmp_path), "orders", later.limit(5), "RUN-2", full_refresh=True)
    current = state.ChangeTable(spark, f"{tmp_path}/orders", "orders").current(load_time=True)
    assert current.count() == changes.select("order_id").distinct().count()
    assert current.where("order_status = 'refunded'").count() == 5
    assert current.where(F.col("_ingested_at") == F.lit(str(at)).cast("timestamp_ntz")).count() == current.count() - 5


def test_unknown_member(tables):
    dim = star.with_unknown_member(tables.present())
    row = dim.where("customer_sk = '-1'").first()
    assert (row.customer_id, row.plan_tier, row.valid_to, row.is_current) == ("UNKNOWN", "UNKNOWN", None, True)


def test_event_older_than_any_lookback_is_inserted(spark, tables, tmp_path):
    files, table = str(tmp_path / "in"), state.ChangeTable(spark, str(tmp_path / "t"), "events", 2)
    events = tables("event_arrivals").where("arrival_seq = 1").orderBy("event_timestamp", "event_id").limit(60).transform(fixed)
    top = events.agg(F.max("event_timestamp")).first()[0]
    late = events.limit(1).withColumns({"event_id": F.lit("EVT-LATE"), "event_timestamp": ntz(top - timedelta(days=400))})
    for part in (events, late.unionByName(events.limit(5))):
        part.write.mode("append").parquet(files)
        streams.stream_insert_events(streams.read_changes(spark, files, "events"), table, str(tmp_path / "checkpoint"))
    assert rows(table.current(), "event_id") == rows(events.unionByName(late), "event_id")
    with pytest.raises(ValueError, match="insert-only"):
        streams.stream_insert_events(events, state.ChangeTable(spark, str(tmp_path / "o"), "orders"), "")


def reads_of(table, monkeypatch):
    """Which buckets a table's stored rows are read from, merge by merge."""
    asked, plain = [], table.read
    monkeypatch.setattr(table, "read", lambda only=None, head=None: asked.append(only) or plain(only=only, head=head))
    return asked


def test_recent_repetitions_need_no_stored_id(spark, tables, tmp_path, monkeypatch):
    files, table = str(tmp_path / "in"), state.ChangeTable(spark, str(tmp_path / "t"), "events", 2)
    events = tables("event_arrivals").where("arrival_seq = 1")
    parts = [F.pmod(F.xxhash64("event_id"), F.lit(3)) == n for n in range(3)]
    asked = reads_of(table, monkeypatch)

    def run(rows_, checkpoint="c", **options):
        rows_.write.mode("append").parquet(files)
        streams.stream_insert_events(streams.read_changes(spark, files, "events"), table, str(tmp_path / checkpoint), **options)

    run(events.where(parts[0]))
    run(events.where(parts[0] | parts[1]))  # repeated, and others of any age
    assert rows(table.current(), "event_id") == rows(events.where(parts[0] | parts[1]), "event_id")
    assert [only for only in asked if only is not None] == []
    offered = [r.offered for r in table.commits().orderBy("commit_no").collect() if r.offered]
    assert offered == [events.where(parts[0]).count(), events.where(parts[1]).count()]  # the state dropped the rest
    assert [p.name for p in (tmp_path / "c" / "sources").iterdir()] == ["0"]  # rows and ids come from one reading
    # Another job's commit is not in the state: what may be in it is compared with stored ids.
    table.merge(events.where(parts[2]), "by-hand")
    asked.clear()
    later = events.limit(1).withColumns({"event_id": F.lit("EVT-NEW"), "event_timestamp": ntz("2031-01-01")})
    run(later)
    assert asked == []  # newer than any commit
    run(events)
    assert asked != []
    run(events, checkpoint="other")  # a stream without memory
    assert rows(table.current(), "event_id") == rows(events.unionByName(later), "event_id")


def test_state_that_has_expired_is_made_up_for(spark, tables, tmp_path):
    """With a window of no length every id is forgotten, and found among the stored ones."""
    files, table = str(tmp_path / "in"), state.ChangeTable(spark, str(tmp_path / "t"), "events", 2)
    events = tables("event_arrivals").where("arrival_seq = 1")
    for _ in range(3):
        events.write.mode("append").parquet(files)
        stream = streams.read_changes(spark, files, "events")
        streams.stream_insert_events(stream, table, str(tmp_path / "c"), window=timedelta(0))
    assert rows(table.current(), "event_id") == rows(events, "event_id")


def test_redelivered_batch_of_a_remembering_stream(spark, tables, tmp_path, monkeypatch):
    """The job dies after the table's commit and before the stream's own."""
    files, table = str(tmp_path / "in"), state.ChangeTable(spark, str(tmp_path / "t"), "events", 2)
    events, merge = tables("event_arrivals").where("arrival_seq = 1"), state.ChangeTable.merge
    half = F.pmod(F.xxhash64("event_id"), F.lit(2)) == 0

    def run():
        streams.stream_insert_events(streams.read_changes(spark, files, "events"), table, str(tmp_path / "c"))

    def dies(self, *args, **options):
        merge(self, *args, **options)
        raise RuntimeError("lost")

    events.where(half).write.parquet(files)
    monkeypatch.setattr(state.ChangeTable, "merge", dies)
    with pytest.raises(Exception, match="lost"):
        run()
    monkeypatch.undo()
    run()  # the same batch again, and its state
    events.write.mode("append").parquet(files)
    run()
    assert rows(table.current(), "event_id") == rows(events, "event_id")
    offered = [r.offered for r in table.commits().orderBy("commit_no").collect() if r.offered]
    assert offered == [events.where(half).count(), events.where(~half).count()]


@pytest.mark.parametrize("year", [1950, 2024, 2200])
def test_arrival_without_numbers_follows_the_whole_time(spark, tables, tmp_path, year):
    first = tables("raw_subscriptions").limit(40).transform(fixed)
    at = datetime(year, 3, 4, 5, 6, 7)
    steps = [first.withColumns({"status": F.lit(f"S{n}"), "plan_tier": F.lit(f"P{n}"),
                                "event_timestamp": ntz(at + timedelta(microseconds=n))}) for n in (2, 0, 3, 1)]
    table = state.ChangeTable(spark, str(tmp_path), "subscriptions", 2)
    table.merge(steps[0].unionByName(steps[1]).unionByName(steps[2]).unionByName(steps[3]), "A")
    found = table.current().select("plan_tier", "status", "event_timestamp").distinct().collect()
    assert [tuple(r) for r in found] == [("P0", "S3", at)]
    later = [first.withColumns({"status": F.lit(f"T{n}"), "event_timestamp": ntz(at + timedelta(microseconds=n))}) for n in (9, 8)]
    table.merge(later[0].unionByName(later[1]), "B")
    assert {tuple(r) for r in table.current().select("status", "event_timestamp").collect()} == {("T9", at)}


def test_tables_with_long_numbers_are_read(spark, tables, tmp_path):
    changes = tables("order_changes")
    old = changes.withColumn("arrival_seq", F.col("arrival_seq").cast("long"))
    old.select("arrival_seq").write.parquet(str(tmp_path / "old"))
    read = spark.read.schema(T.StructType().add("arrival_seq", state.SEQ)).parquet(str(tmp_path / "old"))
    assert read.agg(F.max("arrival_seq")).first()[0] == 4
