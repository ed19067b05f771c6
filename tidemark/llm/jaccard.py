"""Operator 10: n-gram Jaccard join by MinHash banding.

A document is the set of its five-word shingles. Documents of one set form a class and
go on as one. A class gets MinHash values, cut into bands; how many bands of how many
rows follows from the threshold and the wanted recall. Classes that share a band are
candidates: rows are shuffled by band hash, and every class is tied to the least one
of its band, so a band of any size costs its own number of rows. What hangs together
by these ties is fetched and verified: there, all pairs are compared on their full
sets of shingles. No pair is ever written; a comparison adds to the links of its two
classes, and a spanning tree of the links is kept. A large heap of candidates is cut
into blocks, and each two blocks meet in one task, so tasks stay bounded.

Links are found with the recall that the bands were chosen for at the threshold itself
(``RECALL``), more above it, and none below the threshold.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A text of fewer words than a shingle is one
shingle; one without words (also null, empty) has no set, links with nothing and is
kept. Copies link with each other. Rows are told apart by where they are stored, so
equal and null ids and repeated rows are rows like others; of a group the row of
least id stays, of equal ids the one stored first, null ids come last. ``class_id`` is
the least id of the group. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import lean, shuffle_width, slices, stored, table, texts
from tidemark.llm.components import components
from tidemark.llm.hashing import PLACE, Words, filed, mix, with_place, word_cache

SHINGLE = 5
THRESHOLD = 0.8
RECALL, HASHES = 0.999, 144
BLOCK_ROWS, BLOCK_SHINGLES = 1024, 2_000_000


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """Bands and rows per band: the most rows, so the fewest false candidates, for
    which so many hashes give the recall at the threshold."""
    best = None
    for rows in range(1, hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold ** rows)))
        if bands * rows <= hashes:
            best = bands, rows
    if best is None:
        raise ValueError("too few hashes for this recall")
    return best


def shingles(text: bytes, cache, size: int = SHINGLE) -> np.ndarray:
    """The set of a text, as sorted 64-bit fingerprints."""
    words = text.split()
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(Words(words, cache).windows(min(size, len(words))))


class _Sign:
    def __init__(self, bands: int, rows: int, size: int):
        self.bands, self.rows, self.size = bands, rows, size

    @lean
    def __call__(self, batches: Iterator) -> Iterator:
        import pyarrow as pa

        cache = word_cache()
        rng = np.random.default_rng(20)
        n = self.bands * self.rows
        times = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        plus = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for batch in slices(batches, "_text", 2 << 20):
            sets = [shingles(t, cache, self.size) for t in texts(batch, "_text")]
            full = [s for s in sets if len(s)]
            signed = iter(self.sign(full, times, plus).view(np.int64).tolist() if full else [])
            ids = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_file"), batch.column("_at"), batch.column("doc_id"), pa.array(ids, pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([next(signed) if len(s) else None for s in sets], pa.list_(pa.int64()))],
                names=["_file", "_at", "doc_id", "set_id", "n_shingles", "bands"])

    def sign(self, sets: list[np.ndarray], times: np.ndarray, plus: np.ndarray) -> np.ndarray:
        """Band hashes, a row for each set."""
        joined = np.concatenate(sets)
        starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
        out = np.zeros((len(sets), self.bands), np.uint64)
        for band in range(self.bands):
            key = np.full(len(sets), band + 1, np.uint64)
            for i in range(band * self.rows, (band + 1) * self.rows):
                key = mix(key ^ np.minimum.reduceat(joined * times[i] + plus[i], starts))
            out[:, band] = key
        return out


def signed(docs: DataFrame, text: str = "text", id_col: str = "doc_id", *, size: int = SHINGLE,
           bands: int, rows: int) -> DataFrame:
    frame = with_place(docs, doc_id=id_col, _text=text)
    kind = frame.schema["doc_id"].dataType.simpleString()
    return frame.mapInArrow(
        _Sign(bands, rows, size),
        f"_file long, _at long, doc_id {kind}, set_id binary, n_shingles long, bands array<long>")


def linked(sets: list[np.ndarray], first: int, threshold: float) -> np.ndarray:
    """Which pairs of sets reach the threshold: those within all sets, or, if ``first``
    is above 0, those between the first sets and the rest."""
    n, sizes = len(sets), np.array([len(s) for s in sets], float)
    a, b = (slice(0, first), slice(first, n)) if first else (slice(0, n), slice(0, n))
    numbers, inverse, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rows = np.repeat(np.arange(n), sizes.astype(int))
    shared = times[inverse] > 1
    columns, rows = inverse[shared], rows[shared]
    columns = (np.cumsum(times > 1) - 1)[columns]
    order = np.argsort(columns, kind="stable")
    columns, rows = columns[order], rows[order]
    common, step = np.zeros((len(sizes[a]), len(sizes[b]))), 4096
    width = int(columns[-1]) + 1 if len(columns) else 0
    for begin in range(0, width, step):
        lo, hi = np.searchsorted(columns, [begin, begin + step])
        has = np.zeros((n, step), np.float32)
        has[rows[lo:hi], columns[lo:hi] - begin] = 1
        common += has[a] @ has[b].T
    joint = sizes[a][:, None] + sizes[b][None, :] - common
    near = common / joint >= threshold
    out = np.zeros((n, n), bool)
    out[a, b] = near
    out |= out.T
    np.fill_diagonal(out, False)
    return out


class _Verify:
    """Compare the classes of a group; one row per class and heap in it: the documents
    that it links with here, and the head of its tree here."""

    def __init__(self, size: int, threshold: float):
        self.size, self.threshold = size, threshold

    def __call__(self, rows):
        import pyarrow as pa

        cache, heaps = word_cache(), {}
        columns = [rows.column(c).to_pylist() for c in ("root", "set_id", "copies", "side", "across")]
        for i, row in enumerate(zip(*columns)):
            heaps.setdefault(row[0], []).append((i, *row[1:]))
        found = texts(rows, "_text") if rows.num_rows else []
        out = []
        for heap in heaps.values():
            heap.sort(key=lambda r: (r[3], r[1]))
            across = heap[0][4]
            first = sum(r[3] == 0 for r in heap) if across else 0
            if len(heap) < 2 or across and first in (0, len(heap)):
                continue
            near = linked([shingles(found[r[0]], cache, self.size) for r in heap], first, self.threshold)
            copies = np.array([r[2] for r in heap])
            links = near @ copies
            head = np.arange(len(heap))
            while True:  # every class takes the least head that it sees
                seen = np.where(near, head[None, :], len(heap)).min(1)
                seen = np.minimum(seen, head)
                if (seen == head).all():
                    break
                head = seen
            out += [(heap[i][1], int(links[i]), heap[head[i]][1]) for i in np.flatnonzero(links).tolist()]
        ids, links, heads = zip(*out) if out else ([], [], [])
        return pa.table({"set_id": pa.array(ids, pa.binary()), "links": pa.array(links, pa.int64()), "head": pa.array(heads, pa.binary())})


def candidates(classes: DataFrame) -> DataFrame:
    """Heaps of classes that hang together by shared bands: ``node``, ``root``. A node is
    half the fingerprint of a class; should two classes share it, they only meet for
    verification."""
    banded = classes.select("node", F.explode("bands").alias("band"))
    # Stored: a join may split a hot band only if it wasn't dealt by it for an aggregate.
    crowded = stored(
        banded.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("most"))
        .where("least < most").select("band", "least"), "crowded")
    ties = banded.join(crowded, "band").select(F.col("node").alias("a"), F.col("least").alias("b"))
    return components(ties)


def near_copies(docs: DataFrame, text: str = "text", id_col: str = "doc_id", *, size: int = SHINGLE,
                threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES) -> DataFrame:
    """Per row its place (``_file``, ``_at``), id, number of shingles, ``class_id``,
    ``n_links`` (other rows at or above the threshold) and ``kept``."""
    spark, docs = docs.sparkSession, filed(docs)
    bands, per_band = choose_bands(threshold, recall, hashes)
    rows = stored(signed(docs, text, id_col, size=size, bands=bands, rows=per_band), "signed")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *PLACE)
    classes = stored(
        rows.where("set_id is not null").groupBy("set_id")
        .agg(F.count(F.lit(1)).alias("copies"), F.min(order).alias("first"),
             F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
        .withColumn("node", F.conv(F.substring(F.hex("set_id"), 1, 15), 16, 10).cast("long")), "classes")
    heaps = candidates(classes)
    wanted = stored(classes.drop("bands").join(heaps, "node"), "wanted")
    totals = wanted.agg(F.sum("n_shingles")).first()[0] or 0
    lots = max(shuffle_width(spark), math.ceil(totals / BLOCK_SHINGLES * 4))
    blocks = stored(
        wanted.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("s"))
        .where("n > 1")
        .select("root", F.ceil(F.greatest(F.col("n") / BLOCK_ROWS, F.col("s") / BLOCK_SHINGLES)).cast("int").alias("blocks")), "blocks")
    # Where a class goes: small heaps by lots of many, a large one to all pairs of its blocks.
    own = F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    placed = (
        wanted.join(blocks, "root")
        .select("set_id", "copies", "root", "blocks", F.col("first._file").alias("_file"), F.col("first._at").alias("_at"),
                own.alias("own"))
    )
    fetched = (
        with_place(docs, _text=text).join(placed.hint("merge"), PLACE)
        .select("set_id", "copies", "root", "blocks", "own", "_text", other)
        .select("set_id", "copies", "root", "_text",
                F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("root"), F.lit(lots))).otherwise(F.xxhash64("root", F.lit(1))).alias("lot"),
                F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), (F.col("own") != F.col("other")).alias("across"))
    )
    verify = _Verify(size, threshold)
    compared = stored(
        fetched.groupBy("lot", "low", "high")
        .applyInArrow(lambda rows: verify(rows), "set_id binary, links long, head binary"), "compared")
    trees = components(compared.select(F.col("set_id").alias("a"), F.col("head").alias("b")))
    links = compared.groupBy("set_id").agg(F.sum("links").alias("links"))
    grouped = (
        classes.select("set_id", "copies", "first").join(links, "set_id", "left")
        .join(trees.withColumnRenamed("node", "set_id"), "set_id", "left")
        .withColumn("root", F.coalesce("root", "set_id"))
    )
    best = grouped.groupBy("root").agg(F.min("first").alias("best"))
    of_set = grouped.join(best, "root").select(
        "set_id", F.col("best").alias("_best"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return (
        rows.drop("bands").join(of_set, "set_id", "left")
        .select(*PLACE, "doc_id", "n_shingles",
                F.when(F.col("_best").isNotNull(), F.col("_best.doc_id")).otherwise(F.col("doc_id")).alias("class_id"),
                F.coalesce("n_links", F.lit(0)).alias("n_links"),
                F.coalesce((F.col("_best._file") == F.col("_file")) & (F.col("_best._at") == F.col("_at")), F.lit(True)).alias("kept"))
    )


def one_of_each(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The documents with one of each group of near copies, all columns as they came."""
    names = docs.columns
    plain = filed(docs.toDF(*[f"_c{i}" for i in range(len(names))]))
    at = lambda c: f"_c{names.index(c)}"
    kept = stored(near_copies(plain, at(text), at(id_col)).where("kept").select(*PLACE), "kept")
    return with_place(plain, **{c: c for c in plain.columns}).join(kept.hint("merge"), PLACE, "left_semi").drop(*PLACE).toDF(*names)


def op10_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents")).drop(*PLACE)


OP10_SQL = r"""
with recursive split as (
  select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as words from documents
), shingles as (
  select distinct doc_id, array_to_string(words[p:p + least(5, len(words)) - 1], ' ') as said
  from (select doc_id, words, unnest(range(1, len(words) - least(5, len(words)) + 2)) as p from split where len(words) > 0)
), sizes as (
  select doc_id, count(*) as n from shingles group by doc_id
), links as (
  select a, b from (
    select x.doc_id as a, y.doc_id as b, count(*) as common
    from shingles x join shingles y on x.said = y.said and x.doc_id <> y.doc_id group by 1, 2)
  join sizes s on s.doc_id = a join sizes t on t.doc_id = b where common / (s.n + t.n - common) >= 0.8
), reached as (
  select doc_id as a, doc_id as b from documents
  union select reached.a, links.b from reached join links on reached.b = links.a
), classes as (
  select a as doc_id, min(b) as class_id from reached group by a
)
select c.doc_id, coalesce(n, 0) as n_shingles, class_id, (select count(*) from links where a = c.doc_id) as n_links,
  c.doc_id = class_id as kept
from classes c left join sizes s on s.doc_id = c.doc_id
"""
