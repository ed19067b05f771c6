"""Tables that are replaced atomically, on plain Parquet.

Layout below the table's root::

    log/batch=<id>/            the change records of a batch, never rewritten
    data/v=<n>/<part>=<value>/ rows written by commit n
    commits/                   one small file per commit, written last

A commit names, for each partition value, the versions that make up the table.
Readers follow the newest commit, so a job that dies before its commit leaves
nothing visible, and a repeated batch id is recognised. One writer per table.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.operators import cdc
from tidemark.schemas import EPOCH, LONG, SOURCES, STR, TS, Source

COMMITS = T.StructType([
    T.StructField("source", STR, False),
    T.StructField("commit_no", LONG, False),
    T.StructField("batch_id", STR, False),
    T.StructField("status", STR, False),
    T.StructField("offered", LONG, False),
    T.StructField("applied", LONG, True),
    T.StructField("records", LONG, False),
    T.StructField("watermark", TS, True),
    T.StructField("error_message", STR, True),
    T.StructField("committed_at", TS, False),
    T.StructField("parts", T.MapType(STR, T.ArrayType(LONG)), False),
    T.StructField("buckets", LONG, True),
])

SEQ = T.DecimalType(38, 0)  # of arrivals; tables written with long numbers are read as such
BUCKETS = 64  # of a new table whose creator names none
MAX_DELTAS = 8  # additions to a bucket before it is rewritten
MAX_FILES = 32  # the same for insert-only tables
LEAVES = 512  # keys of a batch are counted by so many hashes, or by one per bucket
TASK_ROWS = 1_000_000  # a bucket with more is dealt to several tasks, each of which writes a file
FEW_ROWS = 100_000  # buckets with fewer together share a task
REPEATED = 4  # rows per key from which rows are combined before they are dealt
PACKED = {"compression": "zstd"}  # files are written once and kept


@dataclass(frozen=True)
class Outcome:
    """What a batch did: rows offered, rows that changed the table (None where that is
    left to the reader), and whether the batch had been committed before."""

    batch_id: str
    offered: int
    applied: int | None
    replayed: bool = False


@dataclass(frozen=True)
class Head:
    """Where a table stands: its newest commit and what it is made of."""

    number: int = 0
    parts: dict[str, list[int]] = field(default_factory=dict)
    watermark: datetime | None = None
    replayed: bool = False
    buckets: int | None = None
    batch_id: str = ""  # of the newest successful commit


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, name: str, schema: T.StructType, part: str):
        self.spark, self.root, self.name, self.part = spark, root.rstrip("/"), name, part
        stored = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
        self.schema = stored if part in stored.fieldNames() else stored.add(part, STR)

    # -- commit log ---------------------------------------------------------

    def commits(self) -> DataFrame:
        return self._commits() or self.spark.createDataFrame([], COMMITS)

    def _commits(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(COMMITS).parquet(f"{self.root}/commits")
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def head(self, batch_id: str = "") -> Head:
        """The newest commit, and whether ``batch_id`` is among the successful ones."""
        commits = self._commits()
        if commits is None:
            return Head()
        ok = F.col("status") == "SUCCESS"
        row = commits.agg(
            F.max("commit_no").alias("number"),
            F.max_by("watermark", F.when(ok, F.col("commit_no"))).alias("watermark"),
            F.count_if(ok & (F.col("batch_id") == batch_id)).alias("replays"),
            F.max_by("batch_id", F.when(ok, F.col("commit_no"))).alias("last_batch"),
        ).first()
        if row["number"] is None:
            return Head()
        # Of the parts only the newest commit's are read; statistics rule the other files out.
        newest = commits.where(F.col("commit_no") == row["number"]).select("parts", "buckets").first()
        return Head(
            row["number"], newest["parts"], row["watermark"], row["replays"] > 0, newest["buckets"], row["last_batch"] or "")

    def head_at(self, number: int) -> Head:
        """What the table was made of after a commit; nothing before the first one."""
        if number == 0:
            return Head()
        row = self.commits().where(F.col("commit_no") == number).select("parts", "buckets").first()
        if row is None:
            raise ValueError(f"{self.root} has no commit {number}")
        return Head(number, row["parts"], buckets=row["buckets"])

    def watermark(self, default: datetime = EPOCH) -> datetime:
        return self.head().watermark or default

    def _append_commit(
        self, head: Head, batch_id: str, status: str, parts: dict, *, offered: int = 0, applied: int | None = 0,
        watermark: datetime | None = None, error_message: str | None = None, committed_at: datetime | None = None,
        buckets: int | None = None,
    ) -> None:
        values = {
            "source": self.name, "commit_no": head.number + 1, "batch_id": batch_id, "status": status,
            "offered": offered, "applied": applied, "records": offered, "watermark": watermark,
            "error_message": error_message,
            "committed_at": committed_at or datetime.now(timezone.utc).replace(tzinfo=None),
            "buckets": buckets or head.buckets,
        }
        columns = [F.lit(str(v) if isinstance(v, datetime) else v).cast(COMMITS[n].dataType).alias(n)
                   for n, v in values.items()]
        parts_column = F.from_json(F.lit(json.dumps(parts)), COMMITS["parts"].dataType).alias("parts")
        row = self.spark.range(1).coalesce(1).select(*columns, parts_column)
        row.write.mode("append").parquet(f"{self.root}/commits")

    def record_failure(self, batch_id: str, error: str, committed_at: datetime | None = None) -> None:
        """A failed run changes neither the table nor its mark."""
        head = self.head()
        self._append_commit(
            head, batch_id, "FAILED", head.parts, error_message=error, committed_at=committed_at)

    # -- reading ------------------------------------------------------------

    def read(self, only: list[str] | None = None, head: Head | None = None) -> DataFrame:
        """The table as of the newest commit, or just the partitions named."""
        parts = (head or self.head()).parts
        wanted = parts if only is None else {p: parts[p] for p in only if p in parts}
        paths = [f"{self.root}/data/v={v}/{self.part}={p}" for p, versions in wanted.items() for v in versions]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.schema(self.schema).option("basePath", f"{self.root}/data")
        return reader.parquet(*paths).select(*self.schema.fieldNames())

    # -- writing ------------------------------------------------------------

    def replace(
        self, rows: DataFrame, batch_id: str, replaced: list[str] | None, *, head: Head | None = None,
        offered: int | None = None, watermark: datetime | None = None, count_applied: bool = True,
        spread: bool = True, committed_at: datetime | None = None, buckets: int | None = None,
    ) -> Outcome:
        """Commit ``rows``. They become the content of the ``replaced`` partitions (all
        of them if None), which disappear if they get no rows; to other partitions
        they are added. Files that stay are carried over by reference."""
        head = head or self.head()
        number, parts = head.number + 1, dict(head.parts)
        target = f"{self.root}/data/v={number}"
        # Rebalancing groups rows by partition value and splits the large groups.
        laid_out = rows.hint("rebalance", self.part) if spread else rows
        laid_out.write.mode("overwrite").options(**PACKED).partitionBy(self.part).parquet(target)
        written = self._written(target, number)
        for gone in list(parts) if replaced is None else replaced:
            parts.pop(gone, None)
        for value, _, _ in written:
            parts[value] = [*parts.get(value, []), number]
        total = sum(n for _, n, _ in written)
        applied = sum(c for _, _, c in written) if count_applied else None
        outcome = Outcome(batch_id, total if offered is None else offered, applied)
        self._append_commit(
            head, batch_id, "SUCCESS", parts, offered=outcome.offered, applied=outcome.applied,
            watermark=watermark, committed_at=committed_at, buckets=buckets)
        return outcome

    def _written(self, path: str, number: int) -> list[tuple[str, int, int]]:
        """Rows, and rows changed by this commit, per partition value: one short line each."""
        rows = self.spark.read.schema(self.schema).parquet(path)
        changed = F.col("_commit_no") == number if "_commit_no" in self.schema.fieldNames() else F.lit(True)
        counted = rows.groupBy(self.part).agg(F.count(F.lit(1)).alias("n"), F.count_if(changed).alias("c"))
        return [tuple(r) for r in counted.collect()]


class ChangeTable(VersionedTable):
    """The current state of one source. Keys are hashed into ``buckets`` partitions.

    The number of buckets is kept in the commits: it is chosen once, whoever opens the
    table with another number is refused, and ``rebucket`` changes it.

    A bucket takes up to ``max_deltas`` batches as additions, so that a batch costs
    what the batch is worth and not what the table is; readers reduce such buckets,
    and the next batch rewrites a full one. With 0 every batch rewrites the buckets it
    touches, and its outcome says how many rows it changed. Insert-only sources add
    after dropping keys that are stored already, and a bucket is rewritten after
    ``MAX_FILES`` additions. So a table never consists of more than so many paths per bucket.
    """

    def __init__(
        self, spark: SparkSession, root: str, source: str | Source, buckets: int | None = None,
        max_deltas: int = MAX_DELTAS,
    ):
        if isinstance(source, str):
            if source not in SOURCES:
                raise ValueError(f"unknown source: {source}")
            source = SOURCES[source]
        self.source, self.asked, self.max_deltas = source, buckets, max_deltas
        schema = T.StructType(source.schema.fields + [
            T.StructField("_ingested_at", TS),
            T.StructField("_first_seq", SEQ), T.StructField("_last_seq", SEQ), T.StructField("_commit_no", LONG),
        ])
        super().__init__(spark, root, source.name, schema, "bucket")

    def _buckets(self, head: Head) -> int:
        if self.asked and head.buckets and self.asked != head.buckets:
            raise ValueError(f"{self.root} has {head.buckets} buckets, not {self.asked}")
        return head.buckets or self.asked or BUCKETS

    def _bucketed(self, rows: DataFrame, buckets: int) -> DataFrame:
        bucket = F.pmod(F.xxhash64(self.source.key), F.lit(buckets)).cast("string")
        return rows.withColumn("bucket", bucket)

    def _state(self, head: Head, shape: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """One row per key with its sequence numbers. ``shape`` may put other columns in place of the
        source's, before rows are reduced."""
        def stored(only: list[str] | None = None) -> DataFrame:
            rows = self.read(only=only, head=head).drop("bucket")
            return shape(rows) if shape else rows

        grown = [b for b, versions in head.parts.items() if len(versions) > 1]
        if not grown or not self.source.mutable:
            return stored()
        settled = [b for b in head.parts if b not in set(grown)]
        reduced = cdc.REDUCERS[self.source.name](stored(grown))
        if not settled:
            return reduced
        return stored(settled).select(*reduced.columns).unionByName(reduced)

    def state(self, head: Head, parts: list[str]) -> DataFrame:
        """One row per key of the named buckets, as of a commit."""
        return self._state(replace(head, parts={p: head.parts[p] for p in parts if p in head.parts}))

    def current(self, load_time: bool = False) -> DataFrame:
        """One row per key; with ``load_time`` also when it was last applied."""
        head = self.head()
        self._buckets(head)
        return self._state(head).select(*self.source.columns, *(["_ingested_at"] if load_time else []))

    def digests(self) -> DataFrame:
        """One row per key, which stands for its whole row of ``current``: key and time, a hash of the
        columns that the first arrival settles and one of those that later ones may change. Such
        rows follow the same reduction, and only they are shuffled for it."""
        s, head = self.source, self.head()
        self._buckets(head)

        def hashed(columns: list[str]) -> Column:
            return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in columns]) if columns else F.lit(0).cast("long")

        values = [c for c in s.columns if c not in (s.key, s.ts)]

        def shape(rows: DataFrame) -> DataFrame:
            return rows.select(
                s.key, s.ts, hashed([c for c in values if c not in s.mutable]).alias("_fixed"),
                hashed([c for c in values if c in s.mutable]).alias("_moving"), "_first_seq", "_last_seq")

        return self._state(head, shape).select(s.key, s.ts, "_fixed", "_moving")

    def rebucket(self, buckets: int, batch_id: str) -> Outcome:
        """Rewrite the table in another number of buckets, as one commit."""
        head = self.head(batch_id)
        if head.replayed:
            return Outcome(batch_id, 0, 0, replayed=True)
        rows = self._bucketed(self._state(head), buckets)
        self.asked = buckets
        return self.replace(
            rows.select(*self.schema.fieldNames()), batch_id, None, head=head, offered=0, watermark=head.watermark,
            count_applied=False, buckets=buckets)

    def merge(
        self, batch: DataFrame, batch_id: str, *, head: Head | None = None, committed_at: datetime | None = None,
        loaded_at: datetime | None = None, remembered: tuple[str, datetime] | None = None,
    ) -> Outcome:
        """Apply one batch. A batch id that is already committed is left alone.

        Rows without ``arrival_seq`` take their order from the commit and their time.
        All rows get the time of loading, now unless ``loaded_at`` says otherwise.

        Rows of insert-only sources are compared with stored keys. ``remembered`` is for callers that
        have dropped themselves what commits of theirs hold: ids beginning with the first part,
        committed since the second. Then only rows not newer than the other commits are compared.
        """
        head = head or self.head(batch_id)
        if head.replayed:
            return Outcome(batch_id, 0, 0, replayed=True)
        buckets = self._buckets(head)
        # The log is the truth: the batch is read from its source once, into the log.
        log_path = f"{self.root}/log/batch={batch_id}"
        arrival = arrival_order(self.source, head.number + 1)
        if "arrival_seq" in batch.columns:
            arrival = F.coalesce(F.col("arrival_seq").cast(SEQ), arrival)
        loaded = F.lit(str(loaded_at or datetime.now(timezone.utc).replace(tzinfo=None))).cast(TS)
        batch.select(*self.source.columns, arrival.alias("arrival_seq"), loaded.alias("_ingested_at")).write.mode(
            "overwrite").options(**PACKED).parquet(log_path)
        logged = self.spark.read.schema(self._log_schema()).parquet(log_path).drop("_ingested_at")
        old = F.lit(True)
        if remembered is not None:
            mark_of_others = self._mark_of_others(*remembered)
            old = F.lit(mark_of_others is not None) & F.coalesce(F.col(self.source.ts) <= F.lit(str(mark_of_others)).try_cast(TS), F.lit(True))
        # One line per leaf, whatever the batch size.
        leaves = buckets * max(1, LEAVES // buckets)
        leaf = f"pmod(xxhash64(`{self.source.key}`), {leaves})"
        seen = logged.groupBy(F.expr(leaf).alias("leaf")).agg(
            F.count(F.lit(1)).alias("n"), F.approx_count_distinct(self.source.key, 0.1).alias("keys"),
            F.max(self.source.ts).alias("top"), F.max(old).alias("old")).collect()
        mark = max([r["top"] for r in seen if r["top"] is not None] + [head.watermark or EPOCH])
        touched, offered = list(dict.fromkeys(str(r["leaf"] % buckets) for r in seen)), sum(r["n"] for r in seen)
        # Where keys repeat much, a task sends one row of each; elsewhere that would only sort the rows once more.
        often = [r["leaf"] for r in seen if offered > FEW_ROWS and r["n"] > REPEATED * max(1, r["keys"])]
        repeating, sizes = f"{leaf} IN ({', '.join(map(str, often))})" if often else "false", Counter()
        for r in seen:
            sizes[r["leaf"] % buckets] += r["keys"] + 1 if r["leaf"] in set(often) else r["n"]

        def changes(log: DataFrame) -> DataFrame:
            stamped = cdc.as_changes(log).withColumns({"_ingested_at": loaded, "_commit_no": F.lit(head.number + 1).cast("long")})
            return self._bucketed(stamped, buckets)

        if self.source.mutable:
            due = [b for b in touched if len(head.parts.get(b, [])) > self.max_deltas or b not in head.parts]
            rows = self._merged(logged, changes, due, head, sizes, buckets, repeating)
        else:
            # Of stored files only the keys are read, but for buckets of many files.
            due = [b for b in touched if len(head.parts.get(b, [])) >= MAX_FILES]
            compared = {str(r["leaf"] % buckets) for r in seen if r["old"]}
            if often:
                first = cdc.reduce_events(cdc.as_changes(logged.where(repeating))).drop("_first_seq").withColumnRenamed("_last_seq", "arrival_seq")
                logged = first.unionByName(logged.where(f"NOT {repeating}"))
            rows = self._inserted(logged, changes, [b for b in compared if b in head.parts], old, head, sizes, buckets)
            if due:
                kept = self.read(only=due, head=head)
                rows = rows.unionByName(self._dealt(kept, buckets, self._stored_rows(due, head)).select(*rows.columns))
        return self.replace(
            rows.select(*self.schema.fieldNames()), batch_id, due, head=head, offered=offered, watermark=mark,
            count_applied=not self.source.mutable or len(due) == len(touched), committed_at=committed_at,
            spread=False, buckets=buckets)

    def _stored_rows(self, parts: list[str], head: Head) -> Counter:
        """Rows per bucket, which the footers of files tell."""
        counted = self.read(only=parts, head=head).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        return Counter({int(r["bucket"]): r["n"] for r in counted.collect()})

    def _dealt(self, rows: DataFrame, buckets: int, sizes: Counter) -> DataFrame:
        """Rows shuffled once both for their reduction and for their files: all rows of a key go to one
        task (``_slot``), a large bucket to tasks of its own and small buckets to one."""
        first, shares, slot, filled = [], [], 0, 0
        for bucket in range(buckets):
            n = sizes[bucket]
            if filled and filled + n > FEW_ROWS:
                slot, filled = slot + 1, 0
            shares.append(max(1, -(-n // TASK_ROWS)))
            first.append(slot)
            slot, filled = slot + shares[-1] - 1, filled + n
        number = f"xxhash64(`{self.source.key}`)"
        starts, counts = (f"array({', '.join(map(str, values))})[pmod({number}, {buckets})]" for values in (first, shares))
        dealt = rows.withColumn("_slot", F.expr(f"int({starts} + pmod({number} div {buckets}, {counts}))"))
        return dealt.repartitionById(slot + 1, "_slot")

    def _mark_of_others(self, prefix: str, since: datetime) -> datetime | None:
        """The mark that successful commits other than those of a caller had reached."""
        own = F.col("batch_id").startswith(prefix) & (F.col("committed_at") >= F.lit(str(since)).cast(TS))
        return self.commits().where((F.col("status") == "SUCCESS") & ~own).agg(F.max("watermark")).first()[0]

    def _merged(
        self, logged: DataFrame, changes: Callable[[DataFrame], DataFrame], due: list[str], head: Head,
        sizes: Counter, buckets: int, repeating: str,
    ) -> DataFrame:
        """New content of the buckets due for a rewrite, and additions to the others."""
        reducer, added = cdc.REDUCERS[self.source.name], None
        if self.source.name == "subscriptions" and len(due) < len({b for b in sizes if sizes[b]}):
            # Which subscription changes count depends on the stored first arrival, so additions stay as they are.
            bucket = f"pmod(xxhash64(`{self.source.key}`), {buckets})"
            is_due = f"{bucket} IN ({', '.join(due)})" if due else "false"
            added = changes(self._dealt(logged.where(f"NOT {is_due}"), buckets, sizes)).drop("_slot")
            if not due:
                return added
            logged = logged.where(is_due)
        stored = [b for b in due if b in head.parts]
        if not stored and repeating == "false":
            # What a commit has alike in all rows isn't shuffled.
            rows = reducer(changes(self._dealt(logged, buckets, sizes)), "_slot")
        else:
            both = changes(logged)
            if stored:
                both, sizes = self.read(only=stored, head=head).select(*both.columns).unionByName(both), sizes + self._stored_rows(stored, head)
            if repeating != "false":
                combined = self._bucketed(reducer(both.where(repeating).drop("bucket")), buckets)
                both = combined.select(*both.columns).unionByName(both.where(f"NOT {repeating}"))
            rows = reducer(self._dealt(both, buckets, sizes), "_slot")
        rows = rows.drop("_slot")
        return rows if added is None else rows.unionByName(added.select(*rows.columns))

    def _inserted(
        self, logged: DataFrame, changes: Callable[[DataFrame], DataFrame], compared: list[str], old: Column, head: Head,
        sizes: Counter, buckets: int,
    ) -> DataFrame:
        """First arrival of each key; old ones only where the key isn't stored in the buckets compared.
        Stored keys lie beside the arrivals, so the shuffle of these is the only one they are in."""
        if not compared:
            return cdc.reduce_events(changes(self._dealt(logged, buckets, sizes)), "_slot").drop("_slot")
        key = self.source.key
        stored = self.read(only=compared, head=head).select(key, F.lit(True).alias("_stored")).where(F.col(key).isNotNull())
        both = logged.withColumn("_stored", F.lit(False)).unionByName(stored, allowMissingColumns=True)
        rest = [c for c in logged.columns if c != key]
        met = self._dealt(both, buckets, sizes + self._stored_rows(compared, head)).groupBy("_slot", key).agg(
            F.min_by(F.struct(*rest), F.when(~F.col("_stored"), F.col("arrival_seq"))).alias("_first"),
            F.max("_stored").alias("_stored"))
        return changes(met.where("_first is not null").select(key, "_first.*", "_stored").where(~(old & F.col("_stored"))).drop("_stored"))

    def _log_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.dataType) for f in self.source.schema]).add("arrival_seq", SEQ).add("_ingested_at", TS)

    def change_log(self) -> DataFrame:
        """All committed change records, in a form the history dimension can use."""
        done = [r["batch_id"] for r in self.commits().where("status = 'SUCCESS'").select("batch_id").collect()]
        if not done:
            return self.spark.createDataFrame([], self._log_schema())
        return self.spark.read.schema(self._log_schema()).parquet(*[f"{self.root}/log/batch={b}" for b in done])


def arrival_order(source: Source, commit_no: int) -> Column:
    """The order in which rows of a commit count as arrived, for sources that have none
    of their own: by commit, within it by the whole event time, then by a hash of the row.
    Needs no sort, and is the same however often a commit is tried. The digits are, from
    the left: commit (8), microseconds of any time above the least (20), hash (10)."""
    micros = F.coalesce(F.unix_micros(F.col(source.ts).cast("timestamp")), F.lit(0))
    row = F.pmod(F.xxhash64(*source.columns), F.lit(10 ** 10))

    def part(value: Column, power: int) -> Column:  # as text: no sum or product of decimals loses a digit
        return F.lpad(value.cast("string"), power, "0")

    above = (micros.cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("decimal(20,0)")
    return F.concat(F.lit(str(commit_no)), part(above, 20), part(row, 10)).cast(SEQ)


def content_signature(df: DataFrame) -> DataFrame:
    """Row count and an order-free hash of the whole content."""
    row_hash = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in df.columns])
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(row_hash.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("content_hash"),
    )


def verify_idempotent(tables: dict[str, ChangeTable], rerun) -> DataFrame:
    """Run ``rerun()`` again and compare every table before and after."""
    before = {name: content_signature(t.digests()).first() for name, t in tables.items()}
    rerun()
    spark = next(iter(tables.values())).spark
    rows = []
    for name, t in tables.items():
        after = content_signature(t.digests()).first()
        same = before[name]["content_hash"] == after["content_hash"]
        rows.append((name, before[name]["row_count"], after["row_count"],
                     after["row_count"] - before[name]["row_count"], same))
    return spark.createDataFrame(
        rows, "table_name string, rows_before long, rows_after long, delta long, same_content boolean")


def replace_partitions(
    table: VersionedTable, rows: DataFrame, batch_id: str, values: list[str]
) -> Outcome:
    """Rewrite exactly the named partitions; all others keep their files."""
    return table.replace(rows.where(F.col(table.part).isin(values)), batch_id, values)


def materialize_mart(
    spark: SparkSession, root: str, name: str, mart: DataFrame, contract: T.StructType, batch_id: str
) -> VersionedTable:
    """Build the mart into a new version and switch readers over with the commit."""
    from tidemark.operators.quality import enforce_contract

    whole = VersionedTable(spark, root, name, T.StructType(list(contract.fields)), "slice")
    checked = enforce_contract(mart, contract, name)
    # There is one partition only, so rows are written where they are.
    whole.replace(checked.withColumn("slice", F.lit("all")), batch_id, None, spread=False)
    return whole
