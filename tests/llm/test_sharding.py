import zlib
from collections import Counter, defaultdict

from tidemark.llm import sharding


def check(rows, texts, shards=sharding.SHARDS):
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in rows) == sorted(
        (k is None, k or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for k, t in texts)
    sizes = Counter(r.shard for r in rows)
    counts = [sizes[s] for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def spread(rows):
    """Shards by checksum of the text."""
    out = defaultdict(set)
    for r in rows:
        out[r.text_crc32].add(r.shard)
    return out


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = sharding.op1_sharding(spark, sf_dir).collect()
    check(rows, docs)
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
    sizes = Counter(t for _, t in docs)
    shards = spread(rows)
    small = [zlib.crc32(t.encode()) for t, n in sizes.items() if 1 < n <= 4]
    assert sum(len(shards[c]) > 1 for c in small) <= 0.1 * len(small)


def test_hot_group_and_copies(spark):
    docs = [(i, "hot" if i % 3 == 0 else f"pair {i // 6}" if i % 3 == 1 else f"own {i}") for i in range(1200)]
    rows = sharding.sharded(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), shards=6).collect()
    check(rows, docs, 6)
    shards = spread(rows)
    pairs = [s for c, s in shards.items() if c != zlib.crc32(b"hot")]
    assert sum(len(s) > 1 for s in pairs) <= 0.05 * len(pairs)
    hot = Counter(r.shard for r in rows if r.text_crc32 == zlib.crc32(b"hot"))
    assert max(hot.values()) >= 60


def test_all_rows_linked(spark):
    docs = [(i, f"group {i % 100}") for i in range(1000)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    before, after = (spread(sharding.sharded(df, shards=4, rounds=n).collect()) for n in (0, 8))
    check(sharding.sharded(df, shards=4).collect(), docs, 4)
    assert sum(map(len, after.values())) < 0.8 * sum(map(len, before.values()))


def test_admitted_moves_keep_quotas():
    wanted = {(0, 1): 10, (1, 0): 4, (2, 1): 6}
    admitted = sharding.admit(wanted, [0, 5, 3])
    assert admitted[1, 0] == 4 and admitted[0, 1] >= 4
    assert admitted[0, 1] + admitted[2, 1] - admitted[1, 0] <= 5


def test_odd_rows(spark):
    rows = [(1, None, 1, 2), (1, "", 3, 4), (None, "a", 5, 6), (2, "a", 7, 8), (2, "a", 7, 8), (3, "é" * 50_000, 9, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, size int, shard int")
    check(sharding.sharded(df).collect(), [r[:2] for r in rows])
    assert sharding.sharded(df.where("false")).count() == 0
