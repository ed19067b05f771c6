"""Hash trees over states: equal ones whatever their files, and the keys that differ."""

from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import content
from tidemark.operators.state import ChangeTable


def at_head(table):
    return table, table.head()


def loaded(spark, path, buckets, *batches, **options):
    table = ChangeTable(spark, str(path), "orders", buckets, **options)
    for no, batch in enumerate(batches):
        table.merge(batch, f"B{no}")
    return table


def test_buckets_and_batches_do_not_matter(spark, tables, tmp_path):
    changes = tables("order_changes")
    one = loaded(spark, tmp_path / "a", 8, changes)
    other = loaded(spark, tmp_path / "b", 3, changes.where("arrival_seq = 1"), changes.where("arrival_seq > 1"), max_deltas=0)
    assert content.differing_keys(at_head(one), at_head(other)).count() == 0
    trees = content.stored_tree(*at_head(one)), content.stored_tree(*at_head(other))
    assert content.differing_leaves(*trees) == []
    total = rows(trees[0].where("width = 1"), "node", "row_count")
    assert total == [(0, one.current().count())]
    assert trees[0].groupBy("width").agg(F.sum("row_count").alias("n")).select("n").distinct().count() == 1


def test_one_changed_row_is_named_and_only_its_bucket_read(spark, tables, tmp_path):
    changes = tables("order_changes")
    table = loaded(spark, tmp_path, 8, changes)
    before, key = table.head(), changes.select(F.max("order_id")).first()[0]
    late = changes.where(F.col("order_id") == key).limit(1).withColumns({
        "order_amount_usd": F.lit(1).cast("decimal(12,2)"), "arrival_seq": F.lit(10 ** 6).cast("long"),
        "source_updated_at": F.lit("2099-01-01").cast("timestamp_ntz")})
    table.merge(late, "LATE")
    found = content.differing_keys((table, before), at_head(table))
    assert rows(found, "row_key", "difference") == [(str(key), "CHANGED")]
    assert len({part for file in found.inputFiles() for part in file.split("/") if part.startswith("bucket=")}) == 1
    assert table.head().parts != before.parts
    again = content.rerun_differences({"orders": table}, lambda: table.merge(late, "LATE"))
    assert again.count() == 0


def test_added_removed_and_changed(spark, tables, tmp_path):
    changes = tables("order_changes").where("arrival_seq = 1")
    ids = sorted(r[0] for r in changes.select("order_id").collect())
    middle = ids[len(ids) // 2]
    nulled = changes.withColumn("payment_method", F.when(F.col("order_id") != middle, F.col("payment_method")))
    one = loaded(spark, tmp_path / "a", 8, changes.where(F.col("order_id") >= middle))
    other = loaded(spark, tmp_path / "b", 6, nulled.where(F.col("order_id") <= middle))
    found = dict(rows(content.differing_keys(at_head(one), at_head(other)), "row_key", "difference"))
    assert found == {str(i): "ADDED" if i < middle else "REMOVED" if i > middle else "CHANGED" for i in ids}


def test_empty_states(spark, tables, tmp_path):
    empty = ChangeTable(spark, str(tmp_path / "a"), "orders", 8)
    assert content.differing_keys(at_head(empty), at_head(empty)).count() == 0
    some = loaded(spark, tmp_path / "b", 8, tables("order_changes").where("arrival_seq = 1"))
    found = content.differing_keys(at_head(empty), at_head(some))
    assert rows(found.groupBy("difference").count(), "difference", "count") == [("ADDED", some.current().count())]
