"""Operator 12: embedding whitening by QDWH spectral divide and conquer.

Entries become whole numbers, x = floor(64 c) + 1000000, and the rows to fit on are the
distinct x vectors. Their number, sums and covariance (centred before multiplying) are gathered as
partial sums per task and added up by Spark; only d sums and d x d entries reach the driver,
whatever the rows, for vectors of ``MOST_WIDE`` entries at most.

The covariance is taken apart by spectral divide and conquer. The polar factor of the covariance
less a shift is 1 on the directions above the shift and -1 on those below, so half of
it plus the identity projects onto the upper ones. QDWH finds the factor in a few steps of dynamically
weighted Halley iteration, by QR alone. An orthonormal basis of the range of the projector
and one of what it leaves cut the matrix into two blocks, which are taken apart likewise, the upper
first, until ``count`` components stand alone. The small matrix of whitening goes to the
tasks, which project all rows.

Rows are dropped whose vector is null or holds a null or non-finite entry, or one that doesn't
fit a whole number of 62 bits. A vector shorter than the longest goes on in zeros. Components
without variance (below the rounding of the largest) can't be whitened and aren't
returned, so equal vectors alone, or one row, give none. Rows with equal or null ids are rows like
others. ``deviation`` is exact, null where it doesn't fit. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import lean, pick, stored, table

COMPONENTS = 16
STEP, SHIFTED = 64, 1_000_000
MOST_WIDE = 4096
CELLS = 1 << 21  # numbers of a slice of rows
EPS = np.finfo(float).eps


# -- the decomposition ------------------------------------------------------


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a square matrix, by QDWH."""
    n = len(a)
    scale = np.linalg.norm(a)  # Frobenius: not less than the largest singular value
    if scale == 0:
        return np.eye(n)
    x, least = a / scale, EPS
    for _ in range(30):
        d = np.cbrt(4 * (1 - least ** 2) / least ** 4)
        root = np.sqrt(1 + d)
        wa = root + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - least ** 2) / (least ** 2 * root))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.concatenate((np.sqrt(wc) * x, np.eye(n))))
        after = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        least = min(1.0, least * (wa + wb * least ** 2) / (1 + wc * least ** 2))
        moved = np.linalg.norm(after - x)
        x = after
        if 1 - least < 1e-14 and moved < EPS ** (1 / 3):
            break
    return x


def cut(b: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the invariant subspaces above and below a shift; none if all eigenvalues
    of the symmetric matrix are equal to rounding."""
    n = len(b)
    mean = np.trace(b) / n
    spread = np.linalg.norm(b - mean * np.eye(n)) / np.sqrt(n)
    size = np.linalg.norm(b)
    if spread <= 4 * EPS * size:
        return None
    # Eigenvalues lie on both sides of their mean; other shifts help where one is hit.
    shifts = [np.median(np.diag(b))] + [mean + spread * t for t in (0, 0.05, -0.05, 0.11, -0.11, 0.23, -0.23, 0.5, -0.5)]
    best, bases = np.inf, None
    for shift in shifts:
        half = (polar(b - shift * np.eye(n)) + np.eye(n)) / 2
        rank = round(float(np.trace(half)))
        if not 0 < rank < n:
            continue
        # Range of the projector: its largest columns, one after the other, twice made orthogonal.
        rest, chosen = half.copy(), []
        for _ in range(rank):
            at = int((rest ** 2).sum(0).argmax())
            v = rest[:, at] / np.linalg.norm(rest[:, at])
            chosen.append(v)
            rest -= np.outer(v, v @ rest)
        upper, _ = np.linalg.qr(half @ (half @ np.stack(chosen, 1)))
        whole, _ = np.linalg.qr(np.concatenate((upper, np.eye(n)), 1))
        lower = whole[:, rank:n]
        off = np.linalg.norm(upper.T @ b @ lower)
        if off < best:
            best, bases = off, (upper, lower)
        if off <= 100 * EPS * size:
            break
    return bases


def components(v: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues and unit eigenvectors (as columns), falling."""
    found, waiting = [], [np.eye(len(v))]  # the uppermost block last
    while waiting and len(found) < count:
        basis = waiting.pop()
        block = basis.T @ v @ basis
        block = (block + block.T) / 2
        two = cut(block) if len(block) > 1 else None
        if two is None:
            found += [(float(block[i, i]), basis[:, i]) for i in range(len(block))]
        else:
            waiting += [basis @ two[1], basis @ two[0]]
    found.sort(key=lambda f: -f[0])  # blocks come in order; equal values to rounding
    found = found[:count]
    return np.array([e for e, _ in found]), np.stack([w / np.linalg.norm(w) for _, w in found], 1)


# -- rows -------------------------------------------------------------------


def _matrix(column, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries of a list column, zeros after the end of a list, and which rows are whole."""
    import pyarrow.compute as pc

    n = len(column)
    good = ~np.asarray(pc.is_null(column).to_numpy(zero_copy_only=False))
    values, owner = pc.list_flatten(column), np.asarray(pc.list_parent_indices(column))
    cells = np.zeros((n, width))
    if len(values):
        gaps = np.asarray(pc.is_null(values).to_numpy(zero_copy_only=False))
        numbers = np.where(gaps, np.nan, np.asarray(pc.fill_null(pc.cast(values, "double"), 0.0)))
        begins = np.searchsorted(owner, np.arange(n))
        cells[owner, np.arange(len(owner)) - begins[owner]] = numbers
    good &= np.isfinite(cells).all(1) & (np.abs(cells) < 2.0 ** 55).all(1)
    return cells, good


class _Read:
    """Ids and x of the rows that stay, x less 1000000 as bytes of whole numbers."""

    def __init__(self, width: int):
        self.width = width

    @lean
    def __call__(self, batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = max(1, CELLS // self.width)
            for begin in range(0, batch.num_rows, rows):
                part = batch.slice(begin, rows)
                cells, good = _matrix(part.column("_vector"), self.width)
                x = np.floor(cells[good] * STEP).astype("<i8")
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").filter(pa.array(good)), pa.array([r.tobytes() for r in x], pa.binary())],
                    names=["vec_id", "x"])


def _numbers(batch, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Slices of a batch with their x."""
    rows = max(1, CELLS // width)
    for begin in range(0, batch.num_rows, rows):
        cells = batch.column("x").slice(begin, rows).to_pylist()
        yield begin, np.frombuffer(b"".join(cells), "<i8").reshape(-1, width)


class _Sums:
    """Sums per dimension of a task's rows, exactly."""

    def __init__(self, width: int):
        self.width = width

    @lean
    def __call__(self, batches: Iterator) -> Iterator:
        import pyarrow as pa

        n, total = 0, [0] * self.width
        for batch in batches:
            for _, x in _numbers(batch, self.width):
                n += len(x)
                exact = x if np.abs(x).max(initial=0) < 1 << 40 else x.astype(object)
                total = [a + int(b) for a, b in zip(total, exact.sum(0))]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(-1, self.width), pa.int32()), pa.array([str(t) for t in [n, *total]], pa.string())],
                names=["i", "total"])


class _Products:
    """The sum over a task's rows of y y', y being the row less ``mean``, then by ``turn``."""

    def __init__(self, width: int, mean: np.ndarray, turn: np.ndarray | None = None):
        self.width, self.mean, self.turn = width, mean, turn

    @lean
    def __call__(self, batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = None
        for batch in batches:
            for _, x in _numbers(batch, self.width):
                y = x - self.mean
                y = y if self.turn is None else y @ self.turn
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "total"])


def _gathered(fit: DataFrame, products: _Products, size: int) -> np.ndarray:
    """d (d + 1) / 2 numbers on the driver, added up by Spark."""
    rows = fit.mapInArrow(products, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total")).collect()
    out = np.zeros((size, size))
    for i, j, total in rows:
        out[i, j] = out[j, i] = total
    return out


@dataclass
class Whitening:
    """What a fit found: over ``n`` rows with ``sums`` of x (less 1000000)."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def turn(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def fit(rows: DataFrame, width: int, count: int = COMPONENTS) -> Whitening | None:
    """Fit on the distinct ``x`` of the rows; None where nothing varies."""
    distinct = stored(rows.select("x").distinct(), "distinct")
    sums = (
        distinct.mapInArrow(_Sums(width), "i int, total string").groupBy("i")
        .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    )
    if not sums:
        return None
    total = {r["i"]: int(r["total"]) for r in sums}
    n, plain = total[-1], [total[i] for i in range(width)]
    mean = np.array([s / n for s in plain])
    v = _gathered(distinct, _Products(width, mean), width) / n
    trace = np.trace(v)
    if not trace > 0:
        return None
    values, vectors = components(v, min(count, width))
    able = values > width * EPS * values[0]
    if not able.any():
        return None
    found = Whitening(n, plain, values[able], vectors[:, able], values[able] / trace)
    # The mean of what is whitened is 0 to rounding: rows are centred before they are turned.
    again = _gathered(distinct, _Products(width, mean, found.turn), len(found.values)) / n
    found.identity_error = float(np.abs(again - np.eye(len(again))).max())
    return found


class _Project:
    """Exact deviation and whitened components of each row."""

    def __init__(self, width: int, found: Whitening):
        self.width, self.found = width, found

    @lean
    def __call__(self, batches: Iterator) -> Iterator:
        import pyarrow as pa

        n, sums, mean, turn = self.found.n, self.found.sums, self.found.mean, self.found.turn
        for batch in batches:
            for begin, x in _numbers(batch, self.width):
                far = max(int(np.abs(x).max(initial=0)), max(map(abs, sums)) // n + 1) * 2 * n
                exact = x if far * far * self.width < 1 << 63 else x.astype(object)
                apart = exact * n - np.array(sums, exact.dtype)
                deviation = [str(d) for d in (apart * apart).sum(1)]
                white = (x - mean) @ turn
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").slice(begin, len(x)), pa.array(deviation, pa.string()),
                     pa.array(list(white), pa.list_(pa.float64()))],
                    names=["vec_id", "deviation", "whitened"])


def whitened(embeddings: DataFrame, vector: str = "embedding", id_col: str = "vec_id", *, count: int = COMPONENTS) -> DataFrame:
    """Per row that stays and component: id, ``component``, ``n``, ``deviation`` (38 digits),
    ``whitened``, ``explained`` and ``identity_error``."""
    frame = pick(embeddings, vec_id=id_col, _vector=vector)
    kind = frame.schema["vec_id"].dataType.simpleString()
    width = frame.agg(F.max(F.size("_vector"))).first()[0] or 0
    if width > MOST_WIDE:
        raise ValueError(f"vectors of {width} entries; at most {MOST_WIDE} can be whitened")
    rows = stored(frame.mapInArrow(_Read(max(width, 1)), f"vec_id {kind}, x binary"), "x")
    found = fit(rows, max(width, 1), count) if width > 0 else None
    result = f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if found is None:
        return embeddings.sparkSession.createDataFrame([], result)
    shares = F.array(*[F.lit(float(e)) for e in found.explained])
    return (
        rows.mapInArrow(_Project(max(width, 1), found), f"vec_id {kind}, deviation string, whitened array<double>")
        .select("vec_id", "deviation", F.posexplode("whitened").alias("component", "whitened"))
        .select("vec_id", (F.col("component") + 1).alias("component"), F.lit(found.n).cast("long").alias("n"),
                F.expr("try_cast(deviation as decimal(38,0))").alias("deviation"), "whitened",
                F.get(shares, "component").alias("explained"), F.lit(found.identity_error).alias("identity_error"))
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation as bigint)"))
