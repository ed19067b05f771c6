"""Operator 8: embedding near-duplicates by iterative quantisation.

Equal vectors form a class and go on as one. On a bounded sample of classes (``SAMPLE``,
chosen by fingerprint) rotations are learnt: centred and projected on its principal
axes, the sample is turned until its signs, a balanced binary code, lose least. The code
of every vector is cut into substrings, one Hamming table each, and vectors meet where they agree in
a substring. Codes are added, from other starting rotations, until enough tables stand:
vectors of the sample are turned by just the angle of the threshold, in random
directions, and all but ``1 - RECALL`` of these hardest pairs have to meet somewhere.
Substrings grow with the number of classes, so that a place of a table holds about ``CROWD``.

Where vectors meet they are compared on their original components, in double precision:
nothing below the threshold is linked. A pair that meets in several tables counts in the
first of them. Pairs are never written: a comparison adds to the links of its two
classes and keeps a spanning tree. A crowded place is cut into blocks, and each two
blocks meet in one task. Counting exact links in a crowd of near copies takes a number
of comparisons that grows with its square, in blocks of matrix products.

Vectors that are null, empty, zero, or hold null or non-finite components link with nothing. A vector
shorter than the longest goes on in zeros. Copies link with each other. Rows with
equal or null ids are rows like others; ``component_id`` is the least id, null only if all
are. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import lean, pick, shuffle_width, stored, table
from tidemark.llm.components import components

THRESHOLD, RECALL = 0.9, 0.97
SAMPLE, TURNS, CROWD = 4096, 30, 16
MOST_CODES = 64
BLOCK = 1024


class _Read:
    """Vectors as bytes of doubles, with a fingerprint; neither for those that can't link."""

    def __init__(self, width: int):
        self.width = width

    @lean
    def __call__(self, batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            keys, vectors = [], []
            for values in batch.column("_vector").to_pylist():
                key = data = None
                if values and None not in values:
                    v = np.zeros(self.width)
                    v[:len(values)] = values
                    if np.isfinite(v).all() and v.any():
                        data = (v + 0.0).tobytes()  # -0.0 is 0.0
                        key = hashlib.blake2b(data, digest_size=16).digest()
                keys.append(key)
                vectors.append(data)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(keys, pa.binary()), pa.array(vectors, pa.binary())],
                names=["vec_id", "key", "vector"])


def unit(vectors: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(vectors)).reshape(len(vectors), -1)
    x = x / np.abs(x).max(1, keepdims=True)  # neither too large nor too small to square
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def learn_rotation(x: np.ndarray, seed: int, turns: int = TURNS) -> tuple[np.ndarray, np.ndarray]:
    """Mean, and the projection whose signs are the code of what is left without it."""
    mean = x.mean(0)
    _, axes = np.linalg.eigh((x - mean).T @ (x - mean))
    axes = axes[:, ::-1][:, :min(64, x.shape[1])]
    flat = (x - mean) @ axes
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(flat.shape[1],) * 2))[0]
    for _ in range(turns):
        u, _, v = np.linalg.svd(np.where(flat @ turn >= 0, 1.0, -1.0).T @ flat)
        turn = (u @ v).T
    return mean, axes @ turn


@dataclass
class Tables:
    """Learnt codes and how they are cut: ``bits`` by table."""

    codes: list[tuple[np.ndarray, np.ndarray]]
    bits: int

    def places(self, x: np.ndarray) -> np.ndarray:
        """Per vector and table the number of its place, other for every table."""
        found = []
        for mean, turn in self.codes:
            signs = ((x - mean) @ turn >= 0).astype(np.int64)
            for begin in range(0, signs.shape[1] - self.bits + 1, self.bits):
                number = signs[:, begin:begin + self.bits] @ (1 << np.arange(self.bits))
                found.append(number | len(found) << 32)
        return np.stack(found, 1)


def learn(x: np.ndarray, classes: int, threshold: float = THRESHOLD, recall: float = RECALL) -> Tables:
    """Tables in which enough pairs at the threshold meet, for so many classes."""
    bits = max(1, min(round(math.log2(max(classes / CROWD, 2))), 20, x.shape[1]))
    rng = np.random.default_rng(1)
    away = rng.normal(size=x.shape)
    away -= (away * x).sum(1, keepdims=True) * x
    norm = np.linalg.norm(away, axis=1, keepdims=True)
    pairs = threshold * x + math.sqrt(1 - threshold ** 2) * np.divide(away, norm, out=np.zeros_like(away), where=norm > 0)
    tables = Tables([], bits)
    while len(tables.codes) < MOST_CODES:
        tables.codes.append(learn_rotation(x, len(tables.codes)))
        if (tables.places(x) == tables.places(pairs)).any(1).mean() >= recall:
            return tables
    while tables.bits > 1:  # no more codes: shorter substrings meet more often, in fuller places
        tables.bits -= 1
        if (tables.places(x) == tables.places(pairs)).any(1).mean() >= recall:
            return tables
    raise ValueError(f"{MOST_CODES} codes don't reach a recall of {recall}")


class _Place:
    def __init__(self, tables: Tables):
        self.tables = tables

    @lean
    def __call__(self, batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                places = self.tables.places(unit(batch.column("vector").to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("key", "vector", "copies")), pa.array(places.tolist(), pa.list_(pa.int64()))],
                    names=["key", "vector", "copies", "places"])


class _Compare:
    """Compare the classes at each place of a group; one row per class and place where it
    has links: the rows it is linked with here first, and the head of its tree here."""

    def __init__(self, threshold: float):
        self.threshold = threshold

    def __call__(self, rows):
        import pyarrow as pa

        crowds, out = {}, []
        for i, place in enumerate(rows.column("place").to_pylist()):
            crowds.setdefault(place, []).append(i)
        keys, vectors = rows.column("key").to_pylist(), rows.column("vector").to_pylist()
        copies, sides = np.array(rows.column("copies").to_pylist()), np.array(rows.column("side").to_pylist())
        across, places = rows.column("across").to_pylist(), rows.column("places").to_pylist()
        for place, crowd in crowds.items():
            if len(crowd) < 2:
                continue
            crowd.sort(key=lambda i: keys[i])
            x, at, side = unit([vectors[i] for i in crowd]), np.array([places[i] for i in crowd]), sides[crowd]
            near = x @ x.T >= self.threshold
            np.fill_diagonal(near, False)
            if across[crowd[0]]:
                near &= side[:, None] != side[None, :]
            a, b = np.nonzero(near)
            first = (at[a] == at[b]).argmax(1) == place >> 32
            links = np.bincount(a[first], copies[crowd][b[first]], len(crowd)).astype(np.int64)
            head = np.arange(len(crowd))
            while True:  # every class takes the least head that it sees
                seen = head.copy()
                np.minimum.at(seen, a, head[b])
                if (seen == head).all():
                    break
                head = seen
            out += [(keys[crowd[i]], int(links[i]), keys[crowd[head[i]]]) for i in np.unique(a).tolist()]
        found, links, heads = zip(*out) if out else ([], [], [])
        return pa.table({"key": pa.array(found, pa.binary()), "links": pa.array(links, pa.int64()), "head": pa.array(heads, pa.binary())})


def _compared(classes: DataFrame, tables: Tables, threshold: float) -> DataFrame:
    placed = stored(
        classes.select("key", "vector", "copies")
        .mapInArrow(_Place(tables), "key binary, vector binary, copies long, places array<long>"), "placed")
    spread = placed.select("*", F.explode("places").alias("place"))
    # Stored: a join may split a hot place only if it wasn't dealt by it for an aggregate.
    crowds = stored(
        placed.select(F.explode("places").alias("place")).groupBy("place").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        .select("place", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "crowds")
    lots = max(shuffle_width(classes.sparkSession), placed.count() * len(placed.first()["places"]) // (4 * BLOCK)) if not placed.isEmpty() else 1
    meeting = (
        spread.join(crowds, "place")
        .withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", "vector", "copies", "places", "place",
                F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("place"), F.lit(lots))).otherwise(F.xxhash64("place", F.lit(1))).alias("lot"),
                F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), (F.col("own") != F.col("other")).alias("across"))
    )
    compare = _Compare(threshold)
    return stored(
        meeting.groupBy("lot", "low", "high").applyInArrow(lambda rows: compare(rows), "key binary, links long, head binary"), "compared")


def near_duplicates(embeddings: DataFrame, vector: str = "embedding", id_col: str = "vec_id", *,
                    threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Per row its id, ``n_links``, ``component_id`` and ``kept``."""
    frame = pick(embeddings, vec_id=id_col, _vector=vector)
    kind = frame.schema["vec_id"].dataType.simpleString()
    width = frame.agg(F.max(F.size("_vector"))).first()[0] or 0
    rows = stored(frame.mapInArrow(_Read(max(width, 1)), f"vec_id {kind}, key binary, vector binary"), "vectors")
    classes = stored(
        rows.where("key is not null").groupBy("key")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"), F.first("vector").alias("vector")), "classes")
    n = classes.count()
    keyed = rows.select("vec_id", "key")
    if n < 2:
        links = classes.select("key", F.lit(0).cast("long").alias("links"), F.col("key").alias("root"))
    else:
        place = F.pmod(F.xxhash64("key"), F.lit(1 << 20)) / float(1 << 20)
        some = classes.where(place < min(1.0, SAMPLE / n)).select("key", "vector").collect() if n > SAMPLE else classes.select("key", "vector").collect()
        sample = unit([bytes(r["vector"]) for r in sorted(some, key=lambda r: bytes(r["key"]))] or [bytes(classes.first()["vector"])])
        compared = _compared(classes, learn(sample, n, threshold, recall), threshold)
        trees = components(compared.select(F.col("key").alias("a"), F.col("head").alias("b"))).withColumnRenamed("node", "key")
        links = (
            classes.select("key").join(compared.groupBy("key").agg(F.sum("links").alias("links")), "key", "left")
            .join(trees, "key", "left")
            .select("key", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "key").alias("root"))
        )
    grouped = classes.select("key", "copies", "first").join(links, "key")
    least = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    of_key = grouped.join(least, "root").select("key", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id")
    return (
        keyed.join(of_key, "key", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )


def op8_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


OP8_SQL = """
with recursive vectors as (
  select vec_id, cast(embedding as double[]) as v from embeddings
), links as (
  select a.vec_id as a, b.vec_id as b from vectors a join vectors b on a.vec_id <> b.vec_id
  where list_cosine_similarity(a.v, b.v) >= 0.9
), reached as (
  select vec_id as a, vec_id as b from vectors
  union select reached.a, links.b from reached join links on reached.b = links.a
)
select vec_id, (select count(*) from links where a = vec_id) as n_links, component_id, vec_id = component_id as kept
from (select a as vec_id, min(b) as component_id from reached group by a)
"""
