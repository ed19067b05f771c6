"""Operator 11: ranked lexical search over bit-sliced Bloom signatures.

Terms are runs of ASCII letters, digits and any characters outside ASCII, of which only A to
Z are lower-cased. ``signatures`` is an index that knows no query. Documents with a like number of
keys form a block of a few hundred: a matrix of bits with a column for each document and a power of
two of rows, about ``WIDTH`` a key. Every term of a document is a key, and is one again for each
count in ``LEVELS`` that it reaches; each key sets ``HASHES`` bits of the document's column. The
conjunction of a key's rows is a slice, the bitmap of all documents that may have the term
so often: never one too few. So a weighted sum of slices, each with the gain in score from its
level to the next, is an upper bound for every document of the block.

A search takes three steps. The documents of the highest bounds are scored exactly, which
gives each item a threshold, its tenth score among these. Every document whose bound reaches the
threshold is then scored exactly from its whole text; all others are excluded by proof. The ten
best are the exact answer, whatever the signatures' errors, which only cost time. Scores
are whole numbers, and so are the bounds.

Items are taken in blocks of ``PAIRS`` pairs of item and term, so what reaches the driver and
the tasks is bounded however many there are; an item is never cut. Document frequencies of a
block's terms are counted over all documents, a row per term and task. Documents are told apart by
their place, and meet their candidates in a join that Spark may split or broadcast by size.

A null or empty text, or one without a term, is in no result and counts in no statistic. An item
without terms, or without a term that a document has, gives no rows. Rows of documents or items
with equal or null ids are rows like others; equal scores go by id (null first), then by place.
Long texts are read whole, in pieces cut between terms. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import WordCache, lean, pick, slices, stored, table, texts
from tidemark.llm.hashing import filed, mix, with_place

TERM, GAP = re.compile(rb"[0-9a-z\x80-\xff]+"), re.compile(rb"[^0-9A-Za-z\x80-\xff]")
BEST = 10
LEVELS = (1, 2, 3, 4, 6, 8, 12, 16, 32, 64)
HASHES, WIDTH = 3, 16
BLOCK_BITS, BLOCK_DOCS = 1 << 22, 4096
MOST_KEYS = 1 << 18  # documents of more keys have fuller columns and looser bounds
PAIRS = 100_000
PIECE = 4 << 20
CELLS = 1 << 21


def term_counts(text: bytes) -> Counter:
    counts, begin = Counter(), 0
    while begin < len(text):
        gap = GAP.search(text, begin + PIECE) if len(text) - begin > PIECE else None
        end = gap.end() if gap else len(text)
        counts.update(TERM.findall(text[begin:end].lower()))
        begin = end
    return counts


def _hash(term: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(term, digest_size=8).digest(), "little")


def _keys(hashes: np.ndarray, level: int) -> np.ndarray:
    """Keys of terms at the level of a number."""
    return mix(hashes + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (1 << 64) - 1))


def _bit_rows(keys: np.ndarray, rows: int) -> np.ndarray:
    """The rows of each key, one array for each hash."""
    step = (keys >> np.uint64(32)) | np.uint64(1)
    return np.stack([(keys + np.uint64(i) * step) & np.uint64(rows - 1) for i in range(HASHES)]).astype(np.int64)


class _Block:
    """A block that is being filled."""

    def __init__(self, rows: int):
        self.rows, self.docs = rows, max(8, min(BLOCK_DOCS, BLOCK_BITS // rows))
        self.bits, self.columns = np.zeros((rows, self.docs // 8), np.uint8), ([], [], [])

    def add(self, keys: np.ndarray, *row) -> bool:
        at = len(self.columns[0])
        self.bits[_bit_rows(keys, self.rows).ravel(), at >> 3] |= np.uint8(128 >> (at & 7))
        for column, value in zip(self.columns, row):
            column.append(value)
        return at + 1 == self.docs

    def batch(self):
        import pyarrow as pa

        used = (len(self.columns[0]) + 7) // 8
        bits = np.ascontiguousarray(self.bits[:, :used]).tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array([self.rows], pa.int32()), pa.array([bits], pa.binary()), *(pa.array([c], pa.list_(pa.int64())) for c in self.columns)],
            names=["rows", "bits", "files", "ats", "sizes"])


class _Index:
    @lean
    def __call__(self, batches: Iterator) -> Iterator:
        hashes, filling = WordCache(_hash), {}
        for batch in slices(batches, "_text"):
            places = (batch.column("_file").to_pylist(), batch.column("_at").to_pylist())
            for data, file, at in zip(texts(batch, "_text"), *places):
                counts = term_counts(data)
                if not counts:
                    continue
                often = np.fromiter(counts.values(), np.int64, len(counts))
                known = np.fromiter(map(hashes.__getitem__, counts), np.uint64, len(counts))
                keys = np.concatenate([_keys(known[often >= least], i) for i, least in enumerate(LEVELS) if i == 0 or least <= often.max()])
                rows = WIDTH << max(4, (min(len(keys), MOST_KEYS) - 1).bit_length())
                block = filling.get(rows)
                if block is None:
                    block = filling[rows] = _Block(rows)
                if block.add(keys, file, at, int(often.sum())):
                    yield filling.pop(rows).batch()
        for block in filling.values():
            yield block.batch()


def signatures(docs: DataFrame, text: str = "text") -> DataFrame:
    """The index of a ``filed`` frame: a row per block, with its bits and its documents."""
    return with_place(docs, _text=text).mapInArrow(
        _Index(), "rows int, bits binary, files array<long>, ats array<long>, sizes array<long>")


# -- queries ----------------------------------------------------------------


@dataclass
class Items:
    """A block of items: which terms they hold, how often, and what the terms weigh."""

    terms: list[bytes]
    counts: list[dict[int, int]]  # per item: number of a term, repeats
    ids: list
    documents: int = 0
    length: int = 0
    weights: np.ndarray | None = None

    def weigh(self, documents: int, length: int, found: dict[bytes, int]) -> None:
        self.documents, self.length = documents, length
        self.weights = np.array([
            math.floor(1000 * math.log((2 * documents + 2) / (2 * found[t] + 1))) if t in found else 0 for t in self.terms], np.int64)

    def spread(self, size: int) -> int:
        """What the length of a document adds under the fraction."""
        return 8 * (25 + 75 * size * self.documents // self.length)

    def score(self, item: int, often: Counter, size: int) -> int:
        spread, total = self.spread(size), 0
        for number, repeats in self.counts[item].items():
            tf = often.get(self.terms[number], 0)
            if tf:
                total += repeats * int(self.weights[number]) * (1_000_000_000 * tf // (1000 * tf + spread))
        return total


def _item_blocks(items: DataFrame) -> Iterator[Items]:
    """Items in blocks of at most ``PAIRS`` pairs, or one item."""
    terms, counts, ids, pairs = {}, [], [], 0
    for row in items.toLocalIterator():
        found = term_counts((row["_text"] or "").encode())
        if not found:
            continue
        if ids and pairs + len(found) > PAIRS:
            yield Items(list(terms), counts, ids)
            terms, counts, ids, pairs = {}, [], [], 0
        counts.append({terms.setdefault(t, len(terms)): n for t, n in found.items()})
        ids.append(row["item_id"])
        pairs += len(found)
    if ids:
        yield Items(list(terms), counts, ids)


class _Frequencies:
    """Documents of a task that hold each of the terms."""

    def __init__(self, terms: list[bytes]):
        self.terms = terms

    @lean
    def __call__(self, batches: Iterator) -> Iterator:
        import pyarrow as pa

        wanted, found = frozenset(self.terms), Counter()
        for batch in slices(batches, "_text"):
            for data in texts(batch, "_text"):
                found.update(wanted.intersection(term_counts(data) if len(data) > PIECE else TERM.findall(data.lower())))
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["term", "n"])


class _Bounds:
    """Upper bounds for all documents of each block. Without thresholds a task gives the
    highest of each item, with them all that reach the item's."""

    def __init__(self, items: Items, thresholds: list[int] | None = None):
        self.items, self.thresholds = items, thresholds

    def _upper(self, rows: int, bits: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """A row of bounds per item, a column per document."""
        items, docs, term, weights = self.items, len(sizes), self.term, self.weights
        upper, before = np.zeros((len(items.ids), docs), np.int64), np.zeros(docs, np.int64)
        spread = np.array([items.spread(s) for s in sizes.tolist()], np.int64)
        per_part = max(1, CELLS // max(docs, 1))
        for level, least in enumerate(LEVELS):
            if least > sizes.max():
                break
            most = sizes if level + 1 == len(LEVELS) else np.minimum(LEVELS[level + 1] - 1, sizes)
            value = 1_000_000_000 * most // (1000 * most + spread)
            gain, before = value - before, value
            at = _bit_rows(self.keys[level], rows)
            sliced = np.bitwise_and.reduce(bits[at], axis=0)
            kept = np.flatnonzero(sliced.any(1)[term])  # slices of no document add nothing
            owner = self.owner[kept]
            for begin in range(0, len(kept), per_part):
                part, whose = kept[begin:begin + per_part], owner[begin:begin + per_part]
                present = np.unpackbits(sliced[term[part]], axis=1, count=docs)
                first = np.flatnonzero(np.diff(whose, prepend=-1))
                upper[whose[first]] += np.add.reduceat(present * weights[part, None], first, axis=0) * gain
        return upper

    @lean
    def __call__(self, batches: Iterator) -> Iterator:
        import pyarrow as pa

        items = self.items
        hashes = np.array([_hash(t) for t in items.terms], np.uint64)
        self.keys = [_keys(hashes, i) for i in range(len(LEVELS))]
        self.term = np.array([n for c in items.counts for n in c], np.int64)
        self.owner = np.repeat(np.arange(len(items.ids)), [len(c) for c in items.counts])
        self.weights = np.array([r for c in items.counts for r in c.values()], np.int64) * items.weights[self.term]

        def batch(item, file, at, bound):
            return pa.RecordBatch.from_arrays(
                [pa.array(item.astype(np.int32)), pa.array(file), pa.array(at), pa.array(bound)], names=["item", "file", "at", "bound"])

        best = [np.zeros((len(items.ids), 0), np.int64) for _ in range(3)]
        for rows_batch in batches:
            for i in range(rows_batch.num_rows):
                rows, bits, files, ats, sizes = (rows_batch.column(c)[i] for c in range(5))
                rows, sizes = rows.as_py(), np.array(sizes.as_py(), np.int64)
                files, ats = np.array(files.as_py(), np.int64), np.array(ats.as_py(), np.int64)
                upper = self._upper(rows, np.frombuffer(bits.as_buffer(), np.uint8).reshape(rows, -1), sizes)
                if self.thresholds is not None:
                    item, doc = np.nonzero(upper >= np.maximum(np.array(self.thresholds), 1)[:, None])
                    yield batch(item, files[doc], ats[doc], upper[item, doc])
                    continue
                wide = [np.broadcast_to(v, upper.shape) for v in (files, ats)]
                best = [np.concatenate((b, v), 1) for b, v in zip(best, (upper, *wide))]
                if best[0].shape[1] > BEST:
                    top = np.argpartition(-best[0], BEST - 1, axis=1)[:, :BEST]
                    best = [np.take_along_axis(b, top, 1) for b in best]
        if self.thresholds is None:
            item, column = np.nonzero(best[0] > 0)
            yield batch(item, best[1][item, column], best[2][item, column], best[0][item, column])


class _Score:
    """Exact scores of the documents for the items that each is a candidate of."""

    def __init__(self, items: Items):
        self.items = items

    @lean
    def __call__(self, batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in slices(batches, "_text"):
            out = ([], [], [], [], [])
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "_file", "_at", "_items"))
            for data, doc_id, file, at, wanted in zip(texts(batch, "_text"), *columns):
                often = term_counts(data)
                size = sum(often.values())
                for item in wanted:
                    score = self.items.score(item, often, size)
                    if score > 0:
                        for column, value in zip(out, (item, doc_id, file, at, score)):
                            column.append(value)
            kinds = (pa.int32(), batch.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds)], names=["item", "doc_id", "_file", "_at", "score"])


def _scored(frame: DataFrame, candidates: DataFrame, items: Items) -> DataFrame:
    """The best of the candidates by exact score, with their rank."""
    wanted = candidates.groupBy("file", "at").agg(F.collect_list("item").alias("_items"))
    kind = frame.schema["doc_id"].dataType.simpleString()
    scores = (
        frame.join(wanted.select(F.col("file").alias("_file"), F.col("at").alias("_at"), "_items"), ["_file", "_at"])
        .mapInArrow(_Score(items), f"item int, doc_id {kind}, _file long, _at long, score long")
    )
    ranks = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id", "_file", "_at")
    return scores.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= BEST)


def search(docs: DataFrame, queries: DataFrame, text: str = "text", id_col: str = "doc_id", *,
           item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """Per item its ten best documents: ``item_id``, ``rank``, ``doc_id``, ``score``."""
    spark, docs = docs.sparkSession, filed(docs)
    frame, asked = with_place(docs, doc_id=id_col, _text=text), pick(queries, item_id=item_id, _text=item_text)
    kinds = (asked.schema["item_id"].dataType.simpleString(), frame.schema["doc_id"].dataType.simpleString())
    result = spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score long")
    index = stored(signatures(docs, text), "signatures")
    sizes = index.select(F.explode("sizes").alias("n")).agg(F.count(F.lit(1)), F.sum("n")).first()
    if not sizes[0]:
        return result
    for items in _item_blocks(asked):
        found = (
            frame.select("_text").mapInArrow(_Frequencies(items.terms), "term binary, n long")
            .groupBy("term").agg(F.sum("n").alias("n")).collect()  # a row per term of the block at most
        )
        items.weigh(sizes[0], sizes[1], {bytes(r["term"]): r["n"] for r in found})
        bounds = "item int, file long, at long, bound long"
        highest = Window.partitionBy("item").orderBy(F.desc("bound"), "file", "at")
        seeds = (
            index.mapInArrow(_Bounds(items), bounds)
            .withColumn("_rank", F.row_number().over(highest)).where(F.col("_rank") <= BEST)
        )
        thresholds = [0] * len(items.ids)
        for r in _scored(frame, stored(seeds, "seeds"), items).where(F.col("rank") == BEST).select("item", "score").collect():
            thresholds[r["item"]] = r["score"]
        candidates = stored(index.mapInArrow(_Bounds(items, thresholds), bounds), "candidates")
        best = stored(_scored(frame, candidates, items).select("item", "rank", "doc_id", "score"), "best")
        names = spark.createDataFrame(list(enumerate(items.ids)), f"item int, item_id {kinds[0]}")
        result = result.unionByName(best.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return result


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
with terms as (
  select doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from documents where text is not null
), tfs as (
  select doc_id, term, count(*) as tf from terms group by all
), sizes as (
  select doc_id, count(*) as n from terms group by doc_id
), totals as (
  select count(*) as docs, sum(n)::bigint as total from sizes
), weights as (
  select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w from tfs, totals group by term, docs
), spreads as (
  select doc_id, 25 + (75 * n * docs) // total as m from sizes, totals
), items as (
  select item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark where text is not null
), scores as (
  select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
  from items join weights using (term) join tfs using (term) join spreads using (doc_id) group by all
), ranked as (
  select *, row_number() over (partition by item_id order by score desc, doc_id)::int as rank from scores where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""
