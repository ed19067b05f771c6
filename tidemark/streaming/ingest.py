"""The upserts as Structured Streaming jobs."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from queue import Queue

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.state import ChangeTable
from tidemark.schemas import SOURCES
from tidemark.session import new_folder

WINDOW = timedelta(days=2)  # of arrival, in which a stream remembers the events it has seen


def read_changes(spark: SparkSession, path: str, source: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream over the change files of a source."""
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in SOURCES[source].schema])
    reader = spark.readStream.schema(schema.add("arrival_seq", T.LongType()))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _run(changes: DataFrame, table: ChangeTable, checkpoint: str, name: str, window: timedelta | None = None) -> None:
    """Merge what is available, micro-batch by micro-batch, and stop."""
    started: Queue[str] = Queue(1)

    def apply(batch: DataFrame, batch_no: int) -> None:
        query_id = started.get()
        started.put(query_id)
        prefix = f"{name}-{query_id}-"
        batch_id = f"{prefix}{batch_no:012d}"
        head = table.head(batch_id)
        if window is None:
            table.merge(batch, batch_id, head=head)
        elif head.replayed:  # the stream's own state of this batch has to be written all the same
            batch.write.format("noop").mode("overwrite").save()
        else:
            now = datetime.now(timezone.utc).replace(tzinfo=None)
            table.merge(_of_new_ids(batch, table.source.key), batch_id, head=head, remembered=(prefix, now - window))

    query = (
        changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    started.put(query.id)
    query.awaitTermination()


def _of_new_ids(batch: DataFrame, key: str) -> DataFrame:
    """The events of a micro-batch whose ids the state has not seen before it. The batch
    is read once, so that its state is written once."""
    path = new_folder(batch.sparkSession, "micro-batch")
    batch.write.parquet(path)
    kept = batch.sparkSession.read.schema(batch.schema).parquet(path)
    return kept.where("not _is_new").drop("_is_new").join(kept.where("_is_new").select(key), key, "left_semi")


def stream_upsert(changes: DataFrame, table: ChangeTable, checkpoint: str, name: str = "stream") -> None:
    """Apply what is available, batch by batch, and stop. Works for every source.

    A micro-batch may be delivered again after a failure; its id is then already
    committed in the table, which leaves it alone. Ids carry the query's own, which is kept in
    its checkpoint: another checkpoint counts its batches anew, and they are others.
    What it offers again changes nothing, as reductions and stored keys see to that.
    """
    _run(changes, table, checkpoint, name)


def stream_insert_events(
    events: DataFrame, table: ChangeTable, checkpoint: str, name: str = "stream", *, window: timedelta = WINDOW,
) -> None:
    """Insert each event once, by its first arrival, however late it comes.

    The stream remembers in its state store which ids arrived within the ``window``. Rows and
    new ids leave it side by side, and a micro-batch keeps the rows of its new ids, so the first of
    several arrivals in one batch is found by their order. The watermark follows the time of arrival,
    not of the event, so no event is ever too late for it. What passes is new, or was stored before the
    window or by another job; the latter is possible only for events not newer than the mark of those
    commits, and only they are compared with stored ids. So a run whose repetitions are all recent
    reads no stored id. An event that arrives again is taken to carry the same event time. State holds
    the ids of two windows at most; on a cluster keep it in RocksDB
    (``spark.sql.streaming.stateStore.providerClass``).
    """
    if table.source.mutable:
        raise ValueError(f"{table.name} is not insert-only")
    new_ids = (
        events.select(table.source.key, F.current_timestamp().alias("_arrived"))
        .withWatermark("_arrived", f"{int(window.total_seconds())} seconds")
        .dropDuplicatesWithinWatermark([table.source.key]).select(table.source.key, F.lit(True).alias("_is_new"))
    )
    remembered = events.withColumn("_is_new", F.lit(False)).unionByName(new_ids, allowMissingColumns=True)
    _run(remembered, table, checkpoint, name, window)
