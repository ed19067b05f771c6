import random
import zlib

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import bpe, packing


def brute(positions, penalties, length):
    points, costs = [0, *positions], [0]
    for j in range(1, len(points)):
        costs.append(min(costs[i] + length - points[j] + points[i] for i in range(j) if points[j] - points[i] <= length)
                     + penalties[j - 1])
    return costs[-1]


def cost(cuts, positions, penalties, length):
    price, last, total = dict(zip(positions, penalties)), 0, 0
    for c in cuts:
        assert c - last <= length
        total, last = total + length - (c - last) + price[c], c
    return total


def test_cuts_are_the_cheapest():
    rng = random.Random(3)
    for _ in range(400):
        steps = [rng.randint(1, 9) for _ in range(rng.randint(1, 40))]
        positions = np.cumsum(steps).tolist()
        penalties = [rng.choice([0, 1, 5]) for _ in steps]
        cuts = packing.choose_cuts(positions, penalties, 12)
        assert cuts[-1] == positions[-1]
        assert cost(cuts, positions, penalties, 12) == brute(positions, penalties, 12)


def test_candidates_leave_no_wide_gap():
    kinds = np.zeros(500, np.uint8)
    kinds[[10, 300]] = 1
    kinds[499] = 2
    positions, penalties = packing.candidates(kinds)
    assert positions == sorted(set(positions)) and positions[-1] == 500 and penalties[-1] == 0
    assert max(np.diff([0, *positions])) <= packing.STRIDE


def check(out, texts):
    """Every id once, in order, sequences gapless; returns the share of padding."""
    library = Tokenizer.from_file(bpe.vocabulary_path())
    by_doc, by_sequence = {}, {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for key, pieces in by_doc.items():
        ids = [*library.encode(texts[key] or "", add_special_tokens=False).ids, 0]
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            at += r.length
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:at], "<u4").tobytes())
        assert at == len(ids)
    pad = total = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.LENGTH
        pad, total = pad + packing.padding(at), total + at
    return pad / max(total, 1)


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert check(packing.op3_packing(spark, sf_dir).collect(), texts) < 0.02


def test_blocks_and_long_texts(spark):
    rng = random.Random(4)
    texts = {i: " ".join(rng.choice(["one", "two.", "three\n", "four"]) for _ in range(n))
             for i, n in enumerate([0, 1, 5000, 20_000, 3, 700, 1023, 1024, 2048])}
    texts |= {100: None, 101: "x" * 9000}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    out = packing.digest(packing.packed(df, block=4096)).collect()
    assert check(out, texts) < 0.05
    order = {k: i for i, k in enumerate(texts)}
    places = [order[r.doc_id] for r in sorted(out, key=lambda r: (r.sequence_id, r.offset))]
    assert places == sorted(places)


def test_odd_rows(spark):
    rows = [(None, "a", 1), (None, "a", 2), (1, None, 3), (1, "b.", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int")
    out = packing.packed(df)
    assert out.agg(F.sum("length")).first()[0] == 2 + 2 + 1 + 3
    assert packing.packed(df.where("false")).count() == 0
