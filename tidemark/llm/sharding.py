"""Operator 1: sharding by balanced label propagation.

Documents that hold one link (here: equal texts) are neighbours. All rows start in
shards of equal row counts, dealt by a hash of their place. Then rounds of joins move
linked rows to the shard where most of their neighbours are, of those that have room:
moves of one direction are matched by moves back, and the rest is admitted as far as
the shard's quota of rows goes, so no shard is ever above it. Unlinked rows cut no edge wherever
they are; they come last and fill every shard to its quota. So the law is ``rows``: counts
are at most one apart, whatever the links.

A link held by more rows than half a quota must be cut anyway; it is split by a hash
into parts of at most that size beforehand, and the parts move as wholes. Neighbours
are met through counts per link and shard, never in pairs, and counts combine before
they shuffle. The driver sees one number per two shards in each round.

Slots number the rows of a shard from 0 without gaps, by ranges (``common.numbered``).
Null texts count as empty: size 8, checksum 0, one link with empty texts. Equal and
null ids are rows like others. With fewer rows than shards some shards are empty; an
empty table gives no rows. The same stored table gives the same shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import numbered, stored, table
from tidemark.llm.hashing import PLACE, filed, with_place

SHARDS, ROUNDS = 24, 8


def quotas(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def admit(wanted: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """How many of the wanted moves between shards may go: as many as come back, and
    beyond that, shared evenly, what the target has room for."""
    admitted = {pair: min(n, wanted.get(pair[::-1], 0)) for pair, n in wanted.items()}
    for to, free in enumerate(room):
        more = {p: n - admitted[p] for p, n in wanted.items() if p[1] == to and n > admitted[p]}
        total = sum(more.values())
        for pair, n in more.items():
            admitted[pair] += n if total <= free else n * free // total
    return admitted


def _lookup(pairs: dict[tuple[int, int], int], value: int) -> Column:
    """The number of a pair of shards, by column ``pair``."""
    if not pairs:
        return F.lit(value)
    known = F.create_map(*[F.lit(x) for (a, b), n in pairs.items() for x in (f"{a}>{b}", n)])
    return F.coalesce(known[F.col("pair")], F.lit(value))


def propagated(state: DataFrame, quota: list[int], rounds: int = ROUNDS) -> DataFrame:
    """Move linked rows (``link``, ``part``, ``shard`` and their place) towards their
    neighbours. ``state`` is stored and within the quotas."""
    shards = len(quota)
    turn = lambda c: F.pmod(F.xxhash64("link", "part") + F.col(c), F.lit(shards))  # noqa: E731  another order for each link
    for _ in range(rounds):
        held = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
        room = [q - held.get(s, 0) for s, q in enumerate(quota)]
        open_to = [s for s, free in enumerate(room) if free > 0] or list(range(shards))
        counts = state.groupBy("link", "part", "shard").agg(F.count(F.lit(1)).alias("n"))
        best = counts.where(F.col("shard").isin(open_to)).groupBy("link", "part").agg(
            F.max(F.struct("n", turn("shard").alias("turn"), "shard")).alias("best"))
        aims = (
            counts.join(best, ["link", "part"])
            .where((F.col("shard") != F.col("best.shard")) & (F.col("n") <= F.col("best.n")))
            .select("link", "part", "shard", F.col("best.shard").alias("to"), F.col("best.n").alias("gain"))
        )
        aimed = stored(
            state.join(aims, ["link", "part", "shard"], "left")
            .withColumn("pair", F.concat_ws(">", "shard", "to")), "aimed")
        wanted = {
            (r["shard"], r["to"]): r["n"]
            for r in aimed.where("to is not null").groupBy("shard", "to").agg(F.count(F.lit(1)).alias("n")).collect()}
        admitted = admit(wanted, room)
        if not any(admitted.values()):
            break
        columns = state.columns
        whole = {p: n for p, n in admitted.items() if n == wanted[p]}
        partly = {p: n for p, n in admitted.items() if 0 < n < wanted[p]}
        goes = F.col("to").isNotNull() & (_lookup({p: 1 for p in whole}, 0) == 1)
        some = F.col("to").isNotNull() & (_lookup({p: 1 for p in partly}, 0) == 1)
        moved = aimed.where(~some).withColumn("shard", F.when(goes, F.col("to")).otherwise(F.col("shard"))).select(*columns)
        if partly:  # those of large groups first, a group together
            ranked = numbered(aimed.where(some).withColumn("gain", -F.col("gain")), "pair", ["gain", "link", "part", *PLACE], "rank")
            moved = moved.unionByName(ranked.withColumn(
                "shard", F.when(F.col("rank") < _lookup(partly, 0), F.col("to")).otherwise(F.col("shard"))).select(*columns))
        state = stored(moved, "state")
    return state


def sharded(docs: DataFrame, text: str = "text", id_col: str = "doc_id", *, shards: int = SHARDS,
            rounds: int = ROUNDS) -> DataFrame:
    """Per row its id, size, checksum of the text, shard and slot there."""
    body = F.coalesce(F.col("_text"), F.lit(""))
    rows = stored(
        with_place(filed(docs), doc_id=id_col, _text=text).select(
            *PLACE, "doc_id", (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
            F.unhex(F.md5(body)).alias("link")), "rows")
    scattered = rows.withColumn("all", F.lit(0)).withColumn("order", F.xxhash64(*PLACE))
    rows = stored(
        numbered(scattered, "all", ["order", *PLACE], "number")
        .withColumn("shard", (F.col("number") % shards).cast("int")).drop("all", "order", "number"), "dealt")
    quota = quotas(rows.count(), shards)
    most = max(1, quota[-1] // 2)
    # Stored: a join may split a hot link only if it wasn't dealt by it for an aggregate.
    links = stored(rows.groupBy("link").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "links")
    marked = stored(rows.join(links, "link", "left"), "marked")
    part = F.pmod(F.xxhash64(*PLACE, F.lit(1)), F.ceil(F.col("n") / most))
    linked = stored(marked.where("n is not null").select(*PLACE, "link", part.alias("part"), "shard"), "linked")
    linked = propagated(linked, quota, rounds)
    held = {r["shard"]: r["n"] for r in linked.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    ends, total = [], 0
    for s, q in enumerate(quota):
        total += q - held.get(s, 0)
        ends.append(total)
    single = numbered(
        marked.where("n is null").withColumn("all", F.lit(0)).withColumn("order", F.xxhash64(*PLACE, F.lit(2))),
        "all", ["order", *PLACE], "number")
    filled = F.size(F.filter(F.array(*[F.lit(e).cast("long") for e in ends]), lambda e: e <= F.col("number")))
    columns = [*PLACE, "doc_id", "size", "text_crc32"]
    placed = single.select(*columns, filled.alias("shard")).unionByName(
        marked.where("n is not null").select(*columns).join(linked.select(*PLACE, "shard"), PLACE))
    ordered = placed.withColumn("order", F.xxhash64(*PLACE, F.lit(3)))
    return numbered(ordered, "shard", ["order", *PLACE], "slot").select(*columns, "shard", "slot")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
