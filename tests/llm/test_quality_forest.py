import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import quality
from tidemark.llm.common import stored

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        if windows[w] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)]


def test_counts_of_random_texts():
    rng = np.random.default_rng(7)
    parts = ["a", "b", "cé", " ", " ", "\n", "\t", "#", "*|", "\x85", "\x1c", " ", "日本", "😀"]
    for _ in range(2000):
        text = "".join(rng.choice(parts, rng.integers(0, 40)))
        assert quality.measure(text.encode())[0] == plain(text), text


def test_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    out = quality.op5_quality(spark, sf_dir).collect()
    assert len(out) == len(docs)
    lost = caught = good = bad = 0
    for r in out:
        counts = plain(docs[r.doc_id])
        assert [r[c] for c in quality.COUNTS] == counts
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (r.base_failed and r.kept)
        if not r.base_failed and r.doc_id in labels:
            good, lost = good + labels[r.doc_id], lost + (labels[r.doc_id] and not r.kept)
            bad, caught = bad + (not labels[r.doc_id]), caught + (not labels[r.doc_id] and not r.kept)
    assert lost <= 0.02 * good and caught >= 0.5 * bad


def test_forest_finds_the_odd():
    rng = np.random.default_rng(8)
    rates = rng.normal(0, 1, (1000, 3))
    odd = rng.normal(9, 1, (50, 3))
    forest = quality.grow(rates)
    usual, strange = forest.score(rates), forest.score(odd)
    assert strange.min() > np.percentile(usual, 99)
    threshold = quality.calibrate(np.concatenate((usual, strange)), np.arange(1050) < 1000)
    assert (usual >= threshold).mean() <= quality.LOSS and (strange >= threshold).all()
    assert quality.grow(np.zeros((10, 3))) is None


def test_forest_finds_odd_combinations():
    """Two rates are tied to one another in all good rows; the odd ones only break the tie."""
    rng = np.random.default_rng(3)

    def tied(n):
        rates = rng.normal(0, 1, (n, 6))
        rates[:, 1] = rates[:, 0] + rng.normal(0, 0.05, n)
        return rates

    odd = rng.normal(0, 1, (200, 6))
    odd[:, 0] = rng.choice([-1.5, 1.5], 200)
    odd[:, 1] = -odd[:, 0]
    forest = quality.grow(tied(1000))
    assert (forest.score(odd) > np.percentile(forest.score(tied(1000)), 99.5)).mean() >= 0.6


def test_plain_forest_agrees():
    """Each row walked down each tree by itself."""
    rng = np.random.default_rng(5)
    forest = quality.grow(rng.normal(0, [1, 0, 3], (300, 3)), trees=20, per_tree=64)
    rows = np.concatenate((rng.normal(0, 2, (50, 3)), [[0, 0, 0], [1e9, -1e9, 0]]))
    for row, score in zip(rows, forest.score(rows, rows=7)):
        scaled = [(v - m) / d for v, m, d in zip(row, forest.mean, forest.deviation)]
        axes = scaled + [sum(v * c for v, c in zip(scaled, column)) for column in forest.components.T]
        total = 0.0
        for node in forest.roots:
            while forest.below[node] != node:
                node = forest.below[node] + int(axes[forest.axes[node]] >= forest.limits[node])
            total += forest.paths[node]
        assert np.isclose(score, 2 ** -(total / 20 / forest.usual), rtol=1e-9)
    assert forest.score(np.zeros((0, 3))).shape == (0,)


def test_leaves_hold_the_sample():
    """Rows of one tree's whole sample: paths are the depth and what the leaf's rows would take."""
    rng = np.random.default_rng(6)
    rates = rng.normal(0, 1, (40, 2))
    forest = quality.grow(rates, trees=1, per_tree=64)
    x, ends = forest.along(rates), {}
    for i, row in enumerate(x):
        node, depth = forest.roots[0], 0
        while forest.below[node] != node:
            node, depth = forest.below[node] + int(row[forest.axes[node]] >= forest.limits[node]), depth + 1
        ends.setdefault((int(node), depth), []).append(i)
    assert len(ends) > 3
    for (node, depth), some in ends.items():
        assert forest.paths[node] == depth + quality.average_path(np.array(len(some)))


def test_calibration_without_both_kinds():
    assert quality.calibrate(np.array([0.1, 0.9]), np.array([True, True])) == np.inf
    assert quality.calibrate(np.array([]), np.array([], bool)) == np.inf


def test_path_of_small_trees():
    assert quality.average_path(np.array([1, 2])).tolist() == [0, 1]


def test_odd_rows(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, None, 1, "a"), (1, "", 2, "b"), (None, text, 3, "c"), (4, text, 4, "d"), (4, text, 4, "d"), (5, text * 2000, 5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int, kept string")
    labels = spark.createDataFrame([(4, 1), (4, None), (None, 0), (9, 0)], "doc_id long, quality int")
    verdict = quality.fit(quality.measured(df), labels)
    out = sorted((r.doc_id or 0, r.n_words, r.kept) for r in quality.judged(quality.measured(df), verdict).collect())
    assert out == [(0, 60, True), (1, 0, False), (1, 0, False), (4, 60, True), (4, 60, True), (5, 60 + 1999 * 59, False)]
    kept = quality.only_good(df, verdict)
    assert kept.schema.simpleString() == df.schema.simpleString() and kept.count() == 3
    empty = df.where("false")
    assert quality.fit(quality.measured(empty), labels.where("false")).forest is None
    assert quality.judged(quality.measured(empty), verdict).count() == 0


def test_one_odd_statistic_is_enough(spark):
    rng = np.random.default_rng(9)
    vocabulary = ["".join(rng.choice(list("abcdefghijklmnoprstu"), rng.integers(2, 9))) for _ in range(3000)]
    weights = 1 / np.arange(20, 3020)
    words = lambda n: [str(w) for w in rng.choice(vocabulary, n, p=weights / weights.sum())]

    def lines(some):
        return "\n".join(" ".join(some[i:i + 9]) + "." for i in range(0, len(some), 9))

    def phrase():
        said = words(50)
        return lines(words(75) + said + words(75) + said)

    def repeated():
        short = [" ".join(words(1)) for _ in range(7)]
        return "\n".join([" ".join(words(150)), *(line for line in short for line in (line, " ".join(words(12)), line))])

    odd = {
        "dup_lines": lambda: repeated(), "repeat_words": phrase,
        "long words": lambda: lines(["".join(words(4)) for _ in range(80)]),
        "glued": lambda: lines(["".join(words(11)) for _ in range(80)]),
        "symbols": lambda: lines([w + "#" * (i % 3 == 0) for i, w in enumerate(words(120))]),
        "variety": lambda: " ".join(rng.choice(vocabulary[:25], 160)),
    }
    rows = [(i, lines(words(int(rng.integers(60, 300))))) for i in range(1200)]
    rows += [(i, lines([w + "#$|"[i % 3] * 3 for w in words(100)])) for i in range(1200, 1260)]
    labels = spark.createDataFrame([(i, int(i < 1200)) for i, _ in rows], "doc_id long, quality int")
    df = spark.createDataFrame(rows + [(2000 + 10 * k + j, make()) for k, make in enumerate(odd.values()) for j in range(10)], "doc_id long, text string")
    stats = stored(quality.measured(df), "stats")
    verdict = quality.fit(stats, labels)
    judged = {r.doc_id: r for r in quality.judged(stats, verdict).collect()}
    for k, name in enumerate(odd):
        some = [judged[2000 + 10 * k + j] for j in range(10)]
        assert not any(r.base_failed for r in some), name
        assert not any(r.kept for r in some), name
    assert not any(judged[i].kept for i in range(1200, 1260))
    assert sum(not judged[i].kept for i in range(1200)) <= quality.LOSS * 1200
    assert {r.doc_id for r in quality.only_good(df, verdict).collect()} == {i for i, r in judged.items() if r.kept}


def test_every_labelled_row_counts(spark):
    """Bad rows that a sample by place would have left out."""
    n = 30_000
    row = spark.range(n).withColumn("bad", F.col("id") >= n - 300)
    place = F.when(F.col("bad"), 0.9 + F.col("id") / (100 * n)).otherwise(0.5 * F.col("id") / n)
    rates = [F.rand(i) * 0.1 + F.when(F.col("bad"), 2.0).otherwise(0.0) for i in range(len(quality.RATES))]
    stats = stored(row.select(
        F.col("id").alias("doc_id"), place.alias("place"), F.lit(100).cast("long").alias("n_words"),
        *[F.lit(0).cast("long").alias(c) for c in quality.COUNTS[1:]], F.array(*rates).alias("rates")), "stats")
    verdict = quality.fit(stats, row.select(F.col("id").alias("doc_id"), (~F.col("bad")).cast("int").alias("quality")))
    kept = {r.doc_id for r in quality.judged(stats, verdict).where("kept").collect()}
    assert not any(i in kept for i in range(n - 300, n)) and len(kept) >= (1 - quality.LOSS) * (n - 300)


def test_every_good_row_grows(spark):
    """A row that is far from all others moves the mean and the tree that it is dealt to."""
    rows = [(i / 2000, [float(i % 7), float(i % 11), 0.0, 0.0, 0.0, 1.0]) for i in range(2000)]
    frame = spark.createDataFrame(rows, "place double, rates array<double>")
    forest = quality.grow_all(frame, trees=4, per_tree=16)
    rates = np.array([r for _, r in rows])
    assert np.allclose(forest.mean, rates.mean(0)) and np.allclose(forest.deviation, np.maximum(rates.std(0), quality.LEAST_DEVIATION))
    assert len(forest.roots) == 4 and forest.height == 4
    far = quality.grow_all(frame.unionByName(spark.createDataFrame([(0.5, [900.0] * 6)], frame.schema)), trees=4, per_tree=16)
    assert any(limit > 7 for limit in (far.limits * far.deviation[0])[np.isfinite(far.limits) & (far.axes == 0)])
    assert far.score(np.array([[900.0] * 6]))[0] > far.score(rates).max()


def test_weighted_calibration():
    rng = np.random.default_rng(4)
    for _ in range(50):
        scores, good, rows = rng.integers(0, 20, 30).astype(float), rng.random(30) < 0.6, rng.integers(1, 5, 30)
        assert quality.calibrate(scores, good, 0.2, rows) == quality.calibrate(np.repeat(scores, rows), np.repeat(good, rows), 0.2)
