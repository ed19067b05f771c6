"""Operator 5: quality rules and an isolation forest over their statistics.

Every text is measured once: words, repeated lines and phrases, symbols, other marks,
letters. Fixed rules reject texts with too few words or mostly repeated phrases
(``base_failed``). Rates of the rest then go through an isolation forest: trees of
random splits, grown on rows labelled good. A document's paths
from root to leaf are averaged over all trees; one unlike those rows is alone after few
splits, so its mean path is short and its score high. A split falls on any of the rates,
in deviations of the good rows, or on one of their principal components, each scaled to
its own deviation: a row that has common rates in an uncommon combination lies far out along
a component in which the good rows hardly differ. Splits also fall beside the
rows, up to ``MARGIN`` deviations away: a rate that is the same in all good rows can
then be odd too, and a rate far outside is odder than the last good one.

About every second good row, by a hash, grows the forest. The score above which a
document is dropped is read from the other good rows and the bad ones: the lowest that drops
at most ``LOSS`` of the good and more of the bad, and no larger share of the rows that grew the
forest. Labels show few of the ways to be bad, so the highest that still drops the labelled bad rows would let other odd documents pass.

Forest and threshold are fitted on all labelled rows, repeated rows once. Means, deviations and
components come from sums over all rows that grow the forest. Each of these rows is dealt to at
least one tree, to more while a tree would get fewer than ``PER_TREE``; a tree is a group of its own,
and its height is bounded, so that of large trees the leaves count their rows. For the threshold all
labelled rows are scored and counted by score, in ``STEPS`` steps. So the driver gets bounded
trees and counts, never rows. The forest only uses rates, so a long text isn't odd for being long.

Words are ``[^\\x20\\x09-\\x0D]+``. Results for odd input: null and empty texts have no
words, fail the base rules and are dropped. Without labelled rows of both kinds only
the base rules drop. Rows with equal or null ids
are rows like others; a null id has no label. Of several labels of one id the worst
counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import lean, only_rows, pick, slices, stored, table, texts

TREES, PER_TREE = 200, 256
STEPS = 1 << 16  # of scores from 0 to 1
UNITS = 1 << 20  # of a rate in exact sums
LOSS = 0.005
MARGIN, LEAST_DEVIATION = 3.0, 0.02
LEAST_COMPONENT = 0.1  # deviation of a principal component below which it counts as noise
SEED = 11

#: Symbols that count, the fewest words, and the repeated share in percent.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEATED = 50, 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATES = ("symbols", "letters", "variety", "dup_lines", "repeat_words", "word_length")
MARKS = b"!?.,;:()[]{}\"'/\\=+~^_@-"
DIGITS = b"0123456789"


def repeated_words(words: list[bytes]) -> int:
    """Words in 3-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    size = len(numbers)
    if size < 1 << 21:
        keys = (ids[:-2] * size + ids[1:-1]) * size + ids[2:]
    else:  # the pairs numbered first, so that keys stay below 2**63
        pairs = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)[1]
        keys = pairs[:-1] * size + ids[2:]
    order = np.argsort(keys, kind="stable")
    equal = np.diff(keys[order]) == 0
    twice = np.zeros(n - 2, bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    covered = np.zeros(n, bool)
    covered[:-2] |= twice
    covered[1:-1] |= twice
    covered[2:] |= twice
    return int(covered.sum())


def measure(text: bytes) -> tuple[list[int], list[float]]:
    """The counts and the rates of a text in UTF-8."""
    words = text.split()
    joined = b"".join(words)
    length = len(joined)
    without = lambda some: length - len(joined.translate(None, some))
    # Bytes that begin a character: all but 10xxxxxx.
    chars = length - without(bytes(range(0x80, 0xC0)))
    lines = [line for line in text.split(b"\n") if line.strip()]
    symbols, repeats = without(SYMBOLS), repeated_words(words)
    n, dup = len(words), len(lines) - len(set(lines))
    if not n:
        return [0, 0, 0, 0, 0], [0.0] * len(RATES)
    marks, digits = without(MARKS), without(DIGITS)
    return [n, chars, symbols, dup, repeats], [
        math.log1p(symbols / n), (chars - symbols - marks - digits) / chars,
        # Different words against what a text of this length could have at a steady rate.
        math.log1p(len(set(words))) / math.log1p(n),
        dup / len(lines), repeats / n, chars / n]


class _Measure:
    @lean
    def __call__(self, batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in slices(batches, "_text"):
            found = [measure(t) for t in texts(batch, "_text")]
            counts, rates = zip(*found)
            rest = [(n, c) for n, c in zip(batch.schema.names, batch.columns) if n != "_text"]
            yield pa.RecordBatch.from_arrays(
                [*(c for _, c in rest), *(pa.array(c, pa.int64()) for c in zip(*counts)), pa.array(list(rates), pa.list_(pa.float64()))],
                names=[*(n for n, _ in rest), *COUNTS, "rates"])


def measured(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row its id, a place in [0, 1) by a hash of id and text, counts and rates."""
    frame = pick(docs, doc_id=id_col, _text=text)
    frame = frame.withColumn("place", F.pmod(F.xxhash64("doc_id", "_text"), F.lit(1 << 20)) / float(1 << 20))
    kind = frame.schema["doc_id"].dataType.simpleString()
    return frame.select("doc_id", "place", "_text").mapInArrow(
        _Measure(), f"doc_id {kind}, place double, {', '.join(f'{c} long' for c in COUNTS)}, rates array<double>")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def average_path(n: np.ndarray) -> np.ndarray:
    """Mean path of a failed search in a random binary tree of n leaves."""
    n = np.asarray(n, float)
    below = np.maximum(n - 1, 1)
    return np.where(n > 2, 2 * (np.log(below) + np.euler_gamma) - 2 * below / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as flat arrays. A node splits on the axis ``axes`` at ``limits``; rows below go to
    the node ``below`` and others to the one after it. A leaf leads to itself and has the
    mean path of a row that ends there."""

    mean: np.ndarray
    deviation: np.ndarray
    components: np.ndarray
    axes: np.ndarray
    limits: np.ndarray
    below: np.ndarray
    paths: np.ndarray
    roots: np.ndarray
    height: int
    usual: float

    def along(self, rates: np.ndarray) -> np.ndarray:
        """Rows on all axes: rates and components in deviations."""
        scaled = (rates - self.mean) / self.deviation
        return np.hstack((scaled, scaled @ self.components))

    def score(self, rates: np.ndarray, rows: int = 2048) -> np.ndarray:
        """2 ** -(mean path / usual path): near 1 for odd rows, below 0.5 for common ones."""
        found = [np.zeros(0)]
        for begin in range(0, len(rates), rows):
            x = self.along(rates[begin:begin + rows])
            line, at = np.arange(len(x))[:, None], np.tile(self.roots, (len(x), 1))
            for _ in range(self.height):
                at = self.below[at] + (x[line, self.axes[at]] >= self.limits[at])
            found.append(2.0 ** (-self.paths[at].mean(1) / self.usual))
        return np.concatenate(found)


def component_axes(covariance: np.ndarray) -> np.ndarray:
    """Principal components of scaled rates, each over its own deviation."""
    spread, directions = np.linalg.eigh(np.atleast_2d(covariance))
    return directions / np.maximum(np.sqrt(np.maximum(spread, 0.0)), LEAST_COMPONENT)


def grow_tree(sample: np.ndarray, rng: np.random.Generator, height: int) -> tuple[list, list, list, list]:
    """A tree on rows along all axes: axes, limits, below and paths of its nodes, the root first."""
    axes, limits, below, paths = [], [], [], []

    def leaves(n: int) -> int:
        first = len(axes)
        axes.extend([0] * n)
        limits.extend([math.inf] * n)
        below.extend(range(first, first + n))
        paths.extend([0.0] * n)
        return first

    waiting = [(leaves(1), sample, 0, sample.min(0) - MARGIN, sample.max(0) + MARGIN)]
    while waiting:
        node, some, level, low, high = waiting.pop()
        if level == height or len(some) < 2:
            paths[node] = level + float(average_path(np.array(len(some))))
            continue
        axis = int(rng.integers(sample.shape[1]))
        values = some[:, axis]
        at = rng.uniform(max(values.min() - MARGIN, low[axis]), min(values.max() + MARGIN, high[axis]))
        first = leaves(2)
        axes[node], limits[node], below[node] = axis, at, first
        top, bottom = high.copy(), low.copy()
        top[axis] = bottom[axis] = at
        upper = values >= at
        waiting += [(first, some[~upper], level + 1, low, top), (first + 1, some[upper], level + 1, bottom, high)]
    return axes, limits, below, paths


def planted(mean: np.ndarray, deviation: np.ndarray, components: np.ndarray, trees: list, height: int, usual: float) -> Forest:
    """A forest of trees whose nodes are numbered from 0 each."""
    roots = np.cumsum([0, *(len(t[0]) for t in trees)])[:-1]
    axes, limits, paths = (np.concatenate([t[i] for t in trees]) for i in (0, 1, 3))
    below = np.concatenate([np.asarray(t[2]) + root for t, root in zip(trees, roots)])
    return Forest(
        mean, deviation, components, axes.astype(np.int32), limits, below.astype(np.int32), paths,
        roots.astype(np.int32), height, usual)


def grow(rates: np.ndarray, trees: int = TREES, per_tree: int = PER_TREE, seed: int = SEED) -> Forest | None:
    """A forest on rows of rates; None if there are fewer than two different rows."""
    if len(np.unique(rates, axis=0)) < 2:
        return None
    rng = np.random.default_rng(seed)
    mean, deviation = rates.mean(0), np.maximum(rates.std(0), LEAST_DEVIATION)
    scaled = (rates - mean) / deviation
    components = component_axes(np.cov(scaled.T))
    x = np.hstack((scaled, scaled @ components))
    size = min(per_tree, len(x))
    height = max(1, math.ceil(math.log2(size)))
    made = [grow_tree(x[rng.choice(len(x), size, replace=False)], rng, height) for _ in range(trees)]
    return planted(mean, deviation, components, made, height, float(average_path(np.array(size))))


def tree_of_group(mean: np.ndarray, deviation: np.ndarray, components: np.ndarray, height: int, usual: float):
    """A function that grows the tree of one group of dealt rows. Paths are in units of the
    forest's usual path, whatever number of rows the tree was dealt."""
    def grown(group):
        import pandas as pd

        rows = sorted((place, *rates) for place, rates in zip(group["place"], group["rates"]))  # the same tree whatever the order of arrival
        scaled = (np.array(rows, float)[:, 1:] - mean) / deviation
        number, own = int(group["tree"].iloc[0]), float(average_path(np.array(len(rows))))
        axes, limits, below, paths = grow_tree(
            np.hstack((scaled, scaled @ components)), np.random.default_rng((SEED, number)), height)
        if own:
            paths = [p * usual / own for p in paths]
        return pd.DataFrame({"tree": [number], "axes": [axes], "limits": [limits], "below": [below], "paths": [paths]})

    return grown


def grow_all(good: DataFrame, trees: int = TREES, per_tree: int = PER_TREE) -> Forest | None:
    """The same on a frame of ``rates`` and ``place``, each row of which grows at least one tree."""
    size = range(len(RATES))
    rate = [F.col("rates")[i] for i in size]
    whole = [F.round(r * UNITS).cast("decimal(19,0)") for r in rate]  # exact sums don't depend on the order
    pairs = [(i, j) for i in size for j in size[i:]]
    found = good.agg(
        F.count(F.lit(1)), F.max(F.array(*rate)) != F.min(F.array(*rate)),
        *[F.sum(w) for w in whole], *[F.sum((whole[i] * whole[j]).cast("decimal(38,0)")) for i, j in pairs]).first()
    n, differ = found[0], found[1]
    if not differ:
        return None
    sums, products = [int(v) for v in found[2:2 + len(RATES)]], [int(v) for v in found[2 + len(RATES):]]
    covariance = np.zeros((len(RATES), len(RATES)))
    for (i, j), product in zip(pairs, products):
        covariance[i, j] = covariance[j, i] = (n * product - sums[i] * sums[j]) / (n * n) / UNITS ** 2
    mean = np.array([v / n / UNITS for v in sums])
    deviation = np.maximum(np.sqrt(np.maximum(np.diag(covariance), 0.0)), LEAST_DEVIATION)
    components = component_axes(covariance / np.outer(deviation, deviation) * n / (n - 1))
    height, usual = max(1, math.ceil(math.log2(min(per_tree, n)))), float(average_path(np.array(min(per_tree, n))))
    copies = min(trees, math.ceil(trees * per_tree / n))
    first = F.xxhash64("place", "rates", F.lit(SEED + 1))
    dealt = good.select(
        "place", "rates", F.explode(F.array(*[F.pmod(first + k * (trees // copies), F.lit(trees)).cast("int") for k in range(copies)])).alias("tree"))
    made = dealt.groupBy("tree").applyInPandas(
        tree_of_group(mean, deviation, components, height, usual),
        "tree int, axes array<int>, limits array<double>, below array<int>, paths array<double>").collect()  # one bounded tree a line
    made.sort(key=lambda r: r["tree"])
    return planted(mean, deviation, components, [(r["axes"], r["limits"], r["below"], r["paths"]) for r in made], height, usual)


def in_steps(scores: np.ndarray) -> np.ndarray:
    """Scores as whole steps, rounded down."""
    return np.floor(scores * STEPS)


def calibrate(scores: np.ndarray, good: np.ndarray, loss: float = LOSS, rows: np.ndarray | None = None) -> float:
    """The lowest threshold that drops at most the given share of the good rows, and a
    larger one of the bad; infinite if there is none or one kind is missing. ``rows``, if
    given, says for how many rows each score stands."""
    if good.all() or not good.any():
        return math.inf
    order = np.argsort(-scores, kind="stable")
    ranked, kinds = scores[order], good[order]
    counts = np.ones(len(ranked), np.int64) if rows is None else rows[order]
    bads, goods = np.where(kinds, 0, counts), np.where(kinds, counts, 0)
    bad_gone, good_gone = np.cumsum(bads) / bads.sum(), np.cumsum(goods) / goods.sum()
    last = np.append(np.diff(ranked) != 0, True)  # equal scores go together
    allowed = np.flatnonzero(last & (good_gone <= loss) & (bad_gone > good_gone))
    if not len(allowed):
        return math.inf
    best = allowed[-1]
    below = ranked[best + 1] if best + 1 < len(ranked) else 0.0
    return float((ranked[best] + below) / 2)


@dataclass
class Verdict:
    forest: Forest | None
    threshold: float  # in steps

    def keeps(self, rates: np.ndarray) -> np.ndarray:
        if self.forest is None or not len(rates):
            return np.ones(len(rates), bool)
        return in_steps(self.forest.score(rates)) < self.threshold


class _Score:
    """The scores, in steps, of rows of rates."""

    def __init__(self, forest: Forest):
        self.forest = forest

    @lean
    def __call__(self, batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rates = np.array(batch.column("rates").to_pylist(), float).reshape(-1, len(RATES))
            steps = pa.array(in_steps(self.forest.score(rates)).astype(np.int32), pa.int32())
            yield pa.RecordBatch.from_arrays([steps, batch.column("good"), batch.column("grown")], names=["step", "good", "grown"])


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", quality: str = "quality") -> Verdict:
    """Forest and threshold from measured rows (best stored) and their labels. Rows that
    the base rules drop are left out, since the forest judges only the others."""
    known = (
        pick(labels, _key=id_col, _quality=quality).where(F.col("_quality").isNotNull())
        .groupBy("_key").agg(F.min("_quality").alias("_quality"))
    )
    passed = stats.where(~base_failed())
    marked = passed.join(known, passed["doc_id"] == known["_key"]).select("rates", "place", (F.col("_quality") > 0).alias("good")).distinct()
    # About every second good row grows the forest; the threshold comes from the others.
    half = F.pmod(F.xxhash64("place", "rates", F.lit(SEED)), F.lit(2)) == 0
    rows = stored(marked.withColumn("grown", F.col("good") & half), "labelled")
    forest = grow_all(rows.where("grown"))
    if not forest:
        return Verdict(None, math.inf)
    scored = rows.select("rates", "good", "grown").mapInArrow(_Score(forest), "step int, good boolean, grown boolean")
    counted = scored.groupBy("step", "good", "grown").agg(F.count(F.lit(1)).alias("n")).collect()  # some lines a step
    steps, n = np.array([r["step"] for r in counted], float), np.array([r["n"] for r in counted], np.int64)
    good, grown = (np.array([r[c] for r in counted], bool) for c in ("good", "grown"))
    # Neither half of the good rows may lose more than the stated share.
    return Verdict(forest, max(calibrate(steps[some], good[some], rows=n[some]) for some in (~grown, grown | ~good)))


class _Judge:
    """Adds ``kept`` to measured rows, or keeps whole rows by measuring their text."""

    def __init__(self, verdict: Verdict, whole: bool = False):
        self.verdict, self.whole = verdict, whole

    @lean
    def __call__(self, batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in slices(batches, "_text") if self.whole else batches:
            if self.whole:
                counts, rates = zip(*map(measure, texts(batch, "_text")))
                rates = np.array(rates, float)
                n, repeats = np.array([(c[0], c[4]) for c in counts]).T
                failed = (n < MIN_WORDS) | (100 * repeats > MAX_REPEATED * n)
                yield batch.filter(pa.array(~failed & self.verdict.keeps(rates), pa.bool_()))
                continue
            rates = np.array(batch.column("rates").to_pylist(), float).reshape(-1, len(RATES))
            failed = batch.column("base_failed").to_numpy(zero_copy_only=False).astype(bool)
            kept = pa.array(~failed & self.verdict.keeps(rates), pa.bool_())
            names = [n for n in batch.schema.names if n not in ("rates", "place")]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), kept], names=[*names, "kept"])


def judged(stats: DataFrame, verdict: Verdict) -> DataFrame:
    """Per row its id, counts, ``base_failed`` and ``kept``."""
    kind = stats.schema["doc_id"].dataType.simpleString()
    return stats.withColumn("base_failed", base_failed()).mapInArrow(
        _Judge(verdict), f"doc_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, base_failed boolean, kept boolean")


def only_good(docs: DataFrame, verdict: Verdict, text: str = "text") -> DataFrame:
    """The rows that pass, as they came."""
    return only_rows(docs, text, _Judge(verdict, True))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = stored(measured(table(spark, sf_dir, "documents")), "quality")
    return judged(stats, fit(stats, table(spark, sf_dir, "labels")))
