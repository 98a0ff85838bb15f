"""Whitening of embeddings along their largest principal components, by matrix-free block Lanczos.

The covariance is never formed: a step sends a block of directions v to the tasks, each
adds up (x - m) ((x - m) v) over its rows, and the sums are added in two rounds. Blocks
are made orthogonal to all earlier ones, twice. A direction that vanishes so (the space
is invariant, or the spectrum has multiple values) is replaced by a fresh random one, and
the process goes on. As all products with the covariance are kept, the residuals of the
approximations are known exactly; the process ends when those of the components asked for
fall below TOLERANCE of the largest eigenvalue, or the space is whole. When the basis has
MOST_BLOCKS blocks it is condensed to its best half.

What the driver holds are directions: dimensions times MOST_BLOCKS * BLOCK numbers,
however many rows there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Components returned, and directions carried in one pass.
COMPONENTS, BLOCK = 8, 16
#: Blocks of a basis before it is condensed.
MOST_BLOCKS = 40
#: Residual of an eigenvector over the largest eigenvalue; passes without progress after which rounding is taken to be all that is left.
TOLERANCE, STALLED = 1e-14, 4
#: A new direction that keeps less than this of its length after orthogonalisation is a breakdown.
BREAKDOWN = 1e-10
#: Eigenvalues below this share of the largest are 0: there is nothing to be divided by.
NOTHING = 1e-12
SCALE, SHIFT = 1024.0, 100_000
#: Scaled entries beyond this don't count as finite: whole numbers of 64 bits must hold them and their sums.
LARGEST = float(1 << 40)
#: Rows of a task that are worked on at once: so many entries.
ENTRIES = 1 << 20
SEED = 20240


def vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and x = floor(1024 c) + 100000 of the usable rows of a batch, for each length of vector."""
    col = batch.column("v")
    if not len(col):
        return
    flat, size = col.flatten(), pc.fill_null(pc.list_value_length(col), 0).to_numpy()
    value = pc.fill_null(flat.cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False)
    start = np.concatenate(([0], np.cumsum(size)))  # null rows take no entries
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(value * SCALE)
        wrong = np.concatenate(([0], np.cumsum(~(np.abs(scaled) <= LARGEST))))
    good = (size > 0) & (wrong[start[1:]] == wrong[start[:-1]])
    for d in np.unique(size[good]):
        rows = np.flatnonzero(good & (size == d))
        step = max(1, ENTRIES // int(d))
        for a in range(0, len(rows), step):
            some = rows[a : a + step]
            yield some, scaled[start[some][:, None] + np.arange(d)].astype(np.int64) + SHIFT


def _arrays(rows: dict) -> pa.RecordBatch:
    keys = list(rows)
    return pa.record_batch([pa.array(keys, pa.int64()), pa.array([rows[k].tobytes() for k in keys], pa.binary())], names=["key", "data"])


def _added(kind):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, data in zip(batch.column("key").to_pylist(), batch.column("data").to_pylist()):
                one = np.frombuffer(data, kind)
                total[k] = total[k] + one if k in total else one.copy()
        if total:
            yield _arrays(total)

    return run


def gathered(rows: DataFrame, groups: int, task, kind=np.float64) -> dict[int, np.ndarray]:
    """Sums by key of the arrays that ``task`` makes of each partition: added in ``groups`` of tasks, then on the driver.

    An array is as long as the dimensions ask, not the rows.
    """
    parts = rows.mapInArrow(task, "key long, data binary")
    if groups > 2:
        parts = parts.repartition(groups).mapInArrow(_added(kind), "key long, data binary")
    total: dict[int, np.ndarray] = {}
    for r in parts.collect():
        one = np.frombuffer(r.data, kind)
        total[r.key] = total[r.key] + one if r.key in total else one.copy()
    return total


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By length of vector: the number of rows, then the sums of x over them."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for rows, x in vectors(batch):
            one = np.concatenate(([len(rows)], x.sum(axis=0)))
            total[x.shape[1]] = total[x.shape[1]] + one if x.shape[1] in total else one
    if total:
        yield _arrays(total)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """n * x - S as doubles, rounded once, and the exact sum of its squares for each row."""
    if int(np.abs(x - SHIFT).max(initial=0)) * n + int(np.abs(sums - n * SHIFT).max(initial=0)) < 1 << 62:
        d = n * (x - SHIFT) - (sums - n * SHIFT)  # the shift left out on both sides, so that products stay small
        most = int(np.abs(d).max(initial=0))
        if most * most * x.shape[1] < 1 << 62:
            return d.astype(np.float64), (d * d).sum(axis=1).tolist()
        # in two halves of 31 bits
        a = np.abs(d)
        hi, lo = a >> 31, a & ((1 << 31) - 1)
        if x.shape[1] < 1 << 16:
            parts = [sum_of(hi, hi), sum_of(hi, lo), sum_of(lo, lo)]
            return d.astype(np.float64), [(h << 62) + (m << 32) + q for h, m, q in zip(*parts)]
    d = n * (x.astype(object) - SHIFT) - (sums - n * SHIFT)
    return d.astype(np.float64), (d * d).sum(axis=1).tolist()


def sum_of(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Exact row sums of products of numbers below 2 ** 31."""
    p = a * b
    hi, lo = (p >> 31).sum(axis=1), (p & ((1 << 31) - 1)).sum(axis=1)
    return [(h << 31) + q for h, q in zip(hi.tolist(), lo.tolist())]


def _products(n: int, sums: np.ndarray, block: np.ndarray):
    """A task's share of the covariance times the block, n-fold."""
    d = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(block.shape)
        for batch in batches:
            for _, x in vectors(batch):
                if x.shape[1] == d:
                    z = deviations(x, n, sums)[0] / n
                    total += z.T @ (z @ block)
        yield _arrays({0: total})

    return run


def _squares(n: int, sums: np.ndarray):
    """A task's exact sum of deviations, in digits of 32 bits."""
    d = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            for _, x in vectors(batch):
                if x.shape[1] == d:
                    total += sum(deviations(x, n, sums)[1])
        yield _arrays({0: np.array([total >> 32 * j & 0xFFFFFFFF for j in range(6)], np.int64)})

    return run


def _moments(n: int, sums: np.ndarray, directions: np.ndarray):
    """A task's sums of projections and of their products."""
    d = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = directions.shape[1]
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for _, x in vectors(batch):
                if x.shape[1] == d:
                    w = deviations(x, n, sums)[0] / n @ directions
                    first += w.sum(axis=0)
                    second += w.T @ w
        yield _arrays({0: np.concatenate((first, second.ravel()))})

    return run


def orthogonal(block: np.ndarray, basis: np.ndarray, rng: np.random.Generator, scale: float) -> np.ndarray:
    """Directions of the block orthogonal to the basis and to each other; those that vanish start afresh at random.

    ``scale`` is the length that counts as whole. Fewer come back only when the space is full.
    """
    d, out = basis.shape[0], []
    for v in block.T:
        length = scale
        for _ in range(8):
            for _ in range(2):
                for q in (basis, np.stack(out, 1) if out else basis[:, :0]):
                    v = v - q @ (q.T @ v)
            norm = np.linalg.norm(v)
            if norm > BREAKDOWN * length:
                out.append(v / norm)
                break
            if basis.shape[1] + len(out) >= d:
                break
            v = rng.standard_normal(d)
            length = np.linalg.norm(v)
    return np.stack(out, 1) if out else basis[:, :0]


def lanczos(times, d: int, components: int, block: int = BLOCK, most: int = MOST_BLOCKS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix with eigenvectors, from its products with blocks (``times``)."""
    rng = np.random.default_rng(SEED)
    components, block = min(components, d), min(max(block, components), d)
    basis, image = np.zeros((d, 0)), np.zeros((d, 0))
    new = orthogonal(rng.standard_normal((d, block)), basis, rng, 1.0)
    best, stalled = math.inf, 0
    while True:
        product = times(new)
        basis, image = np.hstack((basis, new)), np.hstack((image, product))
        small = basis.T @ image
        value, vector = np.linalg.eigh((small + small.T) / 2)
        value, vector = value[::-1], vector[:, ::-1]
        k = min(components, len(value))
        found = basis @ vector[:, :k]
        top = max(value[0], 0.0)
        residual = np.linalg.norm(image @ vector[:, :k] - found * value[:k], axis=0).max(initial=0.0)
        best, stalled = (residual, 0) if residual < best / 2 else (best, stalled + 1)
        whole = basis.shape[1] >= d
        if whole or k == components and (residual <= TOLERANCE * top or stalled >= STALLED and best <= 1e4 * TOLERANCE * top):
            return value[:k], found
        if basis.shape[1] + block > block * most:
            keep = vector[:, : max(components, block * most // 2)]
            new = orthogonal(product, basis, rng, top or 1.0)
            basis, image = basis @ keep, image @ keep
            # the basis is orthogonal to what was thrown away, and so is the next block
            new = orthogonal(new, basis, rng, 1.0)
        else:
            new = orthogonal(product, basis, rng, top or 1.0)


def whitened(table: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each usable row and component.

    Rows with null vectors, or with null, NaN, infinite or huge (beyond 2**40 / 1024)
    entries, are left out; so are empty vectors, and vectors of another length than most
    rows have (at a tie, than the longest). Ids may be null or repeated: each row is one.
    Components without variance are left out, all of them if all rows are equal; an empty
    table gives no rows. ``deviation`` is a decimal, exact; null beyond 38 digits. Other columns are
    not read.
    """
    spark = table.sparkSession
    rows = table.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    kind = rows.schema["i"].dataType
    schema = f"vec_id {kind.simpleString()}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    only = rows.select("v")
    groups = math.isqrt(only.rdd.getNumPartitions())
    by_length = gathered(only, groups, _sums, np.int64)
    if not by_length:
        return spark.createDataFrame([], schema)
    d = max(by_length, key=lambda k: (by_length[k][0], k))
    n, sums = int(by_length[d][0]), by_length[d][1:]
    digits = gathered(only, groups, _squares(n, sums), np.int64)[0].tolist()
    total = sum(v << 32 * j for j, v in enumerate(digits))
    if not total:
        return spark.createDataFrame([], schema)
    value, direction = lanczos(lambda v: gathered(only, groups, _products(n, sums, v))[0].reshape(v.shape) / n, d, components)
    some = value > NOTHING * value[0]
    value, direction = value[some], direction[:, some] / np.sqrt(value[some])
    k = len(value)
    moments = gathered(only, groups, _moments(n, sums, direction))[0] / n
    covariance = moments[k:].reshape(k, k) - np.outer(moments[:k], moments[:k])
    error = float(np.abs(covariance - np.eye(k)).max())
    explained = value / (total / n**3)

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import decimal

        for batch in batches:
            for at, x in vectors(batch):
                if x.shape[1] != d:
                    continue
                z, square = deviations(x, n, sums)
                w, m = z / n @ direction, len(at)
                repeat = np.repeat(np.arange(m), k)
                yield pa.record_batch(
                    [
                        batch.column("i").take(pa.array(np.repeat(at, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                        pa.array([decimal.Decimal(v) if v < 10**38 else None for v in square], pa.decimal128(38, 0)).take(pa.array(repeat)), pa.array(w.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(out, schema)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deviations as whole numbers of 64 bits; null where they don't fit."""
    found = whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))
