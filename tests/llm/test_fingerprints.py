import random

import pytest

from tidemark.llm import fingerprints
from tidemark.llm.fingerprints import BOUND, BUCKETS, compared, difference, edited_and_next, fingerprint, fingerprinted, likeness


def plain(data: bytes) -> str:
    """The definition, triplet by triplet."""
    counts, n = [0] * BUCKETS, len(data)
    for i in range(n):
        key = data[i] * 65536 + data[(i + 4) % n] * 256 + data[(i + 9) % n]
        counts[(key * 2654435761 >> 20) % BUCKETS] += 1
    quartiles = [sorted(counts)[k * BUCKETS // 4 - 1] for k in (1, 2, 3)]
    codes = [sum(c > q for q in quartiles) for c in counts]
    steps = sum(n >= 2 ** k * (1 + s / 16) for k in range(40) for s in range(16)) if n else 0
    return f"{steps:04x}" + "".join(f"{4 * a + b:x}" for a, b in zip(codes[::2], codes[1::2]))


def plain_difference(a, b):
    codes = [[v for c in f[4:] for v in divmod(int(c, 16), 4)] for f in (a, b)]
    steps = sum((0, 1, 2, 6)[abs(x - y)] for x, y in zip(*codes))
    return min(steps + min(4 * abs(int(a[:4], 16) - int(b[:4], 16)), 128), BOUND)


def some_texts(n, seed):
    rng = random.Random(seed)
    pool = ["word", "Ünder", "北京", "x", "longer-one", "\n", "🙂"]
    return ["".join(rng.choices(pool, k=rng.choice([0, 1, 2, 8, 60, 700]))) for _ in range(n)]


def test_definition(monkeypatch):
    monkeypatch.setattr(fingerprints, "PART", 37)
    marks = [fingerprint(t.encode()) for t in some_texts(30, 1)]
    assert marks == [plain(t.encode()) for t in some_texts(30, 1)]
    for a in marks:
        for b in marks:
            assert difference(a, b) == plain_difference(a, b) <= BOUND
            assert likeness(a, b) == likeness(b, a) and (likeness(a, b) == 1) == (a == b)


def expected(rows):
    out = []
    for (key, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        quarter = len(text) // 4
        edited = text[:len(text) - quarter] + following[:quarter]
        a, b, c = (fingerprint(t.encode()) for t in (text, edited, following))
        out.append((key, len(text), a, b, likeness(a, b), likeness(a, c)))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_chars", "fingerprint", "edited_fingerprint", "near_edited", "near_next").collect()), key=repr)


@pytest.mark.parametrize("n", [1, 2, 3, 150])
def test_neighbours_across_ranges(spark, n):
    rows = list(enumerate(some_texts(n, n)))
    df = spark.createDataFrame(random.Random(0).sample(rows, n), "doc_id long, text string").repartition(5)
    assert found(edited_and_next(df)) == expected(rows)


def test_one_id_owns_most_rows(spark):
    """Its rows lie in several ranges and still form one ring with the others."""
    rows = [(5, t) for t in some_texts(300, 9)] + [(i, "plain text " * i) for i in range(5)] + [(9, "the last of them")]
    out = edited_and_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_chars) for r in out) == sorted((k, len(t)) for k, t in rows)
    marks = {i: fingerprint(("plain text " * i).encode()) for i in range(5)}
    by_id = {r.doc_id: r for r in out if r.doc_id != 5}
    assert all(by_id[i].near_next == likeness(marks[i], marks[i + 1]) for i in range(4))
    assert by_id[9].near_next == likeness(by_id[9].fingerprint, marks[0])


def test_edits_are_nearer_than_other_texts(spark, sf_dir):
    out = fingerprints.op13_fingerprints(spark, sf_dir).where("n_chars >= 200").collect()
    assert sum(r.near_edited > r.near_next for r in out) >= 0.99 * len(out)
    high = sorted(r.near_edited for r in out)[len(out) // 20]
    assert sum(r.near_next >= high for r in out) <= 0.1 * len(out)


def test_odd_rows(spark):
    long = "".join(some_texts(1, 4)) + "y" * 3_000_000
    rows = [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "b"), (4, long)]
    df = spark.createDataFrame([(*r, "x", 2) for r in rows], "doc_id long, text string, fingerprint string, _part int")
    assert found(edited_and_next(df)) == expected([(None, "b"), (1, ""), (2, ""), (3, "a"), (3, "a"), (4, long)])
    marks = fingerprinted(df)
    assert sorted(r.fingerprint for r in marks.collect()) == sorted(plain((t or "").encode()) if t != long else fingerprint(long.encode()) for _, t in rows)
    for few in (edited_and_next(df.where("false")), fingerprinted(df.where("false"))):
        assert few.count() == 0


def test_compared(spark):
    a, b = fingerprint(b"some text of words"), fingerprint(b"some text of worlds")
    df = spark.createDataFrame([(a, b, 1), (a, a, 2), (None, b, 3)], "u string, v string, likeness int")
    assert [r[-1] for r in compared(df, "u", "v").collect()] == [likeness(a, b), 1.0, None]
