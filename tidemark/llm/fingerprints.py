"""Operator 13: document fingerprints by a quartile bucket digest.

Every byte of a text begins a triplet: itself, the fourth and the ninth byte after it,
the text read as a ring. Triplets are hashed into ``BUCKETS`` buckets and counted. A bucket's
code says how many of the three quartiles of all counts its own count exceeds, so the code of
a text grows neither with its length nor with one passage. The fingerprint is the length on a
logarithmic scale (four hexadecimal digits) and the codes, two a digit.

Two fingerprints differ by the steps between their codes, a whole turn (0 against 3)
counting 6, and by ``LENGTH_STEP`` for each step of length, ``LENGTH_MOST`` at most. The
difference is bounded by ``BOUND``, what independent codes differ by on average, and
likeness is 1 less its share of that bound: 1 for equal fingerprints, about 0 for unrelated ones.

Each text also meets the next one in the order of ids. Rows are dealt by ranges of (id, hash
of the text, place) and read in order within a range, so a range of one id's rows is split
like others; the last row of a range meets the first of the next range in a join. Only
one text is held at a time, with the head of its neighbour, and texts are shuffled once.

A null text is like an empty one, of which all codes are 0. Equal texts have equal
fingerprints. Of rows with equal ids the order is that of a hash of the text, then of the place;
null ids come first. A single row is its own neighbour. Texts of any length are read whole,
counted in parts. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.llm.common import lean, pick, shuffle_width, slices, stored, table, texts
from tidemark.llm.hashing import filed, with_place

BUCKETS, SECOND, THIRD = 512, 4, 9
FACTOR, SHIFT = 2654435761, 20
LENGTH_STEP, LENGTH_MOST = 4, 128
BOUND = BUCKETS * 13 // 8
PART = 1 << 20  # bytes counted at a time
_STEPS = np.array([0, 1, 2, 6])
_DIGITS = np.frombuffer(b"0123456789abcdef", np.uint8)


def length_code(n: int) -> int:
    """Sixteen steps for each doubling of the length, 0 for an empty text."""
    if n == 0:
        return 0
    top = n.bit_length() - 1
    return 16 * top + ((n << 4) >> top) - 15


def counted(data: bytes) -> np.ndarray:
    """Triplets per bucket."""
    counts, n = np.zeros(BUCKETS, np.int64), len(data)
    for begin in range(0, n, PART):
        end = min(begin + PART, n)
        piece = data[begin:end + THIRD]
        while len(piece) < end - begin + THIRD:  # the text goes on with its beginning
            piece += data[:end - begin + THIRD - len(piece)]
        b = np.frombuffer(piece, np.uint8).astype(np.int64)
        size = end - begin
        keys = (b[:size] << 16) | (b[SECOND:SECOND + size] << 8) | b[THIRD:THIRD + size]
        counts += np.bincount((keys * FACTOR >> SHIFT) & (BUCKETS - 1), minlength=BUCKETS)
    return counts


def fingerprint(data: bytes) -> str:
    counts = counted(data)
    quartiles = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = (counts[:, None] > quartiles).sum(1)
    return f"{length_code(len(data)):04x}" + _DIGITS[codes[0::2] * 4 + codes[1::2]].tobytes().decode()


def difference(a: str, b: str) -> int:
    """From 0 for equal fingerprints to ``BOUND``."""
    def codes(f: str) -> np.ndarray:
        four = np.frombuffer(bytes.fromhex(f[4:]), np.uint8)
        return np.stack((four >> 6, four >> 4 & 3, four >> 2 & 3, four & 3)).astype(np.int8)

    lengths = min(abs(int(a[:4], 16) - int(b[:4], 16)) * LENGTH_STEP, LENGTH_MOST)
    return min(int(_STEPS[np.abs(codes(a) - codes(b))].sum()) + lengths, BOUND)


def likeness(a: str, b: str) -> float:
    return 1.0 - difference(a, b) / BOUND


def fingerprinted(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row its id and ``fingerprint``."""
    frame = pick(docs, doc_id=id_col, _text=text)

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in slices(batches, "_text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([fingerprint(t) for t in texts(batch, "_text")], pa.string())],
                names=["doc_id", "fingerprint"])

    kind = frame.schema["doc_id"].dataType.simpleString()
    return frame.mapInArrow(read, f"doc_id {kind}, fingerprint string")


def compared(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """The rows of a frame with the ``likeness`` of two fingerprints, null where one is."""
    names = pairs.columns
    plain = pairs.toDF(*[f"_c{i}" for i in range(len(names))])
    schema = T.StructType([*plain.schema.fields, T.StructField("_likeness", T.DoubleType())])

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            two = (batch.column(names.index(c)).to_pylist() for c in (a, b))
            found = pa.array([None if x is None or y is None else likeness(x, y) for x, y in zip(*two)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, "_likeness"])

    return plain.mapInArrow(read, schema).toDF(*names, "likeness")


def _edited(own: str, following: str) -> str:
    """The last quarter gives way to as much of the beginning of the next text."""
    quarter = len(own) // 4
    return own[:len(own) - quarter] + following[:quarter]


def _met(own: str, mark: str, following: str, next_mark: str) -> tuple:
    data = _edited(own, following).encode()
    edited = fingerprint(data)
    return len(own), hashlib.sha256(data).hexdigest(), mark, edited, likeness(mark, edited), likeness(mark, next_mark)


RESULT = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
WHOLE, FIRST, LAST = 0, 1, 2


class _InOrder:
    """Rows of a range in order, each with the next. The first and the last are also given as
    they are, to meet their neighbours in other ranges."""

    def __init__(self, schema):
        self.schema = schema

    def _batch(self, rows: list[tuple]):
        import pyarrow as pa

        columns = zip(*rows) if rows else [[]] * len(self.schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema)

    @lean
    def __call__(self, batches: Iterator) -> Iterator:
        before = part = None
        for batch in slices(batches, "_text"):
            out = []
            for part, key, data in zip(batch.column("_part").to_pylist(), batch.column("doc_id").to_pylist(), texts(batch, "_text")):
                now = (key, data.decode(), fingerprint(data))
                if before is None:
                    out.append((part, FIRST, *now[:2], None, None, now[2], None, None, None))
                else:
                    out.append((part, WHOLE, before[0], None, *_met(*before[1:], *now[1:])))
                before = now
            yield self._batch(out)
        if before is not None:
            yield self._batch([(part, LAST, *before[:2], None, None, before[2], None, None, None)])


class _Across:
    def __init__(self, schema):
        self.schema = schema

    @lean
    def __call__(self, batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for at in range(batch.num_rows):  # two whole texts a row
                key, *rest = (batch.column(i)[at].as_py() for i in range(5))
                row = (key, *_met(*rest))
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, self.schema)], schema=self.schema)


def edited_and_next(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row its fingerprint, that of the text edited by a quarter, and how like it are
    the edited text and the next row."""
    from pyspark.sql.pandas.types import to_arrow_schema

    frame = with_place(filed(docs), doc_id=id_col, _text=text)
    order = ["doc_id", "_tie", "_file", "_at"]
    ranged = (
        frame.withColumn("_tie", F.xxhash64("_text"))
        .repartitionByRange(shuffle_width(docs.sparkSession), *order)
        .withColumn("_part", F.spark_partition_id()).sortWithinPartitions(*order)
        .select("_part", "doc_id", "_text")
    )
    kind = frame.schema["doc_id"].dataType.simpleString()
    empty = docs.sparkSession.createDataFrame([], f"_part int, _kind int, doc_id {kind}, _text string, {RESULT}")
    found = stored(ranged.mapInArrow(_InOrder(to_arrow_schema(empty.schema)), empty.schema), "fingerprints")
    names = [c for c in empty.columns if c not in ("_part", "_kind", "_text")]
    # Which ranges have rows: one number each.
    parts = sorted(r["_part"] for r in found.where(F.col("_kind") == FIRST).select("_part").collect())
    turn = docs.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "_part int, _next int")
    lasts = found.where(F.col("_kind") == LAST).select("_part", "doc_id", "_text", "fingerprint").join(turn, "_part")
    firsts = found.where(F.col("_kind") == FIRST).select(
        F.col("_part").alias("_next"), F.col("_text").alias("_other"), F.col("fingerprint").alias("_mark"))
    schema = empty.select(*names).schema
    across = (
        lasts.join(firsts, "_next").select("doc_id", "_text", "fingerprint", "_other", "_mark")
        .mapInArrow(_Across(to_arrow_schema(schema)), schema)
    )
    return found.where(F.col("_kind") == WHOLE).select(*names).unionByName(across)


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_and_next(table(spark, sf_dir, "documents"))


OP13_SQL = f"""
with numbered as (
  select doc_id, coalesce(text, '') as t, row_number() over (order by doc_id) as k, count(*) over () as n from documents
), pairs as (
  select a.doc_id, a.k, a.k % a.n + 1 as following, length(a.t) as n_chars, a.t,
    left(a.t, length(a.t) - length(a.t) // 4) || left(b.t, length(a.t) // 4) as edited
  from numbered a join numbered b on b.k = a.k % a.n + 1
), hexed as (
  select k, part, regexp_extract_all(hex(encode(s)), '..') as b, strlen(s) as n
  from (select k, 0 as part, t as s from pairs union all select k, 1 as part, edited as s from pairs)
), numbers as (
  select k, part, n, list_transform(b, lambda x: 16 * (strpos('0123456789ABCDEF', x[1]) - 1) + strpos('0123456789ABCDEF', x[2]) - 1) as b from hexed
), placed as (
  select k, part, n, b, unnest(range(n)) as i from numbers
), hashed as (
  select k, part, (((b[i + 1] * 65536 + b[(i + {SECOND}) % n + 1] * 256 + b[(i + {THIRD}) % n + 1]) * {FACTOR}::bigint) >> {SHIFT}) & {BUCKETS - 1} as bucket
  from placed
), counts as (
  select k, part, bucket, count(*) as c from hashed group by all
), filled as (
  select t.k, t.part, list(coalesce(c.c, 0) order by t.bucket) as counts
  from (select k, part, unnest(range({BUCKETS})) as bucket from numbers) t left join counts c using (k, part, bucket) group by all
), coded as (
  select k, part, list_transform(counts, lambda c: (c > sorted[{BUCKETS // 4}])::int + (c > sorted[{BUCKETS // 2}])::int + (c > sorted[{3 * BUCKETS // 4}])::int) as codes
  from (select *, list_sort(counts) as sorted from filled)
), lengths as (
  select k, part, case when n = 0 then 0 else 16 * top + ((n << 4) >> top) - 15 end as len
  from (select *, length(bin(n)) - 1 as top from numbers)
), prints as (
  select k, part, codes, len,
    lpad(lower(to_hex(len)), 4, '0') || list_aggregate(list_transform(range({BUCKETS // 2}), lambda i: '0123456789abcdef'[codes[2 * i + 1] * 4 + codes[2 * i + 2] + 1]), 'string_agg', '') as mark
  from coded join lengths using (k, part)
), likened as (
  select o.k, o.mark, e.mark as edited_mark,
    1.0::double - least(list_sum(list_transform(range(1, {BUCKETS + 1}), lambda i: [0, 1, 2, 6][abs(o.codes[i] - e.codes[i]) + 1])) + least(abs(o.len - e.len) * {LENGTH_STEP}, {LENGTH_MOST}), {BOUND})::double / {BOUND} as near_edited,
    1.0::double - least(list_sum(list_transform(range(1, {BUCKETS + 1}), lambda i: [0, 1, 2, 6][abs(o.codes[i] - x.codes[i]) + 1])) + least(abs(o.len - x.len) * {LENGTH_STEP}, {LENGTH_MOST}), {BOUND})::double / {BOUND} as near_next
  from pairs p join prints o on o.k = p.k and o.part = 0 join prints e on e.k = p.k and e.part = 1
  join prints x on x.k = p.following and x.part = 0
)
select doc_id, n_chars, sha256(edited) as edited_sha256, mark as fingerprint, edited_mark as edited_fingerprint, near_edited, near_next
from pairs join likened using (k)
"""
