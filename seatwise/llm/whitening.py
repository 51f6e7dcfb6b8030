"""Whitening of vectors by Chebyshev-filtered subspace iteration.

The covariance is only ever applied to a block of a few columns: each pass over
the rows adds up ``(x - mean)' ((x - mean) Q)`` part by part. A polynomial built
by Chebyshev's recurrence, one pass a degree, damps the spectrum below the block's
smallest Ritz value and lifts what lies above. Then the block is made orthonormal
(QR) and turned to its Ritz vectors, until the leading ones are certified: what
the covariance leaves of them beside their own direction is rounding only.

Sums are over rows, so the driver holds dimensions times block, never rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatwise.llm.common import stored

SCALE = 256
COMPONENTS = 4
#: Columns of the block; those beyond the wanted ones only speed up convergence.
BLOCK = 32
#: Degree of the filter, passes between two Rayleigh-Ritz steps.
DEGREE = 12
#: A component is certified by a residual of at most this share of the largest
#: eigenvalue, a few times what rounding leaves.
CERTAIN = 1e-14
#: Where rounding stops the residuals from falling this share must do.
SETTLED = 1e-12
MOST_CYCLES = 200
#: Rows turned into doubles at a time.
ROWS = 4096
MOST = 2**63 - 1


def quantised(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == math.inf))
    return vector.isNotNull() & ~bad


def _tables(batch: pa.RecordBatch, d: int) -> Iterator[np.ndarray]:
    """Whole numbers of some rows; every list has ``d`` of them."""
    for at in range(0, batch.num_rows, ROWS):
        lists = batch.column("x").slice(at, ROWS)
        yield lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), d)


def total(fit: DataFrame, d: int, shape: tuple[int, ...], of: Callable) -> np.ndarray:
    """The sum over all rows of the tables that ``of`` makes of some rows.

    Each task sends one row an entry at most; Spark adds them up by entry.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            for x in _tables(batch, d):
                part = of(x)
                out = part if out is None else out + part
        if out is not None:
            flat = np.ravel(out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(flat))), pa.array(flat)], ["at", "value"]
            )

    kind = "long" if of(np.zeros((0, d), np.int64)).dtype == np.int64 else "double"
    parts = fit.select("x").mapInArrow(run, f"at long, value {kind}")
    if kind == "long":
        parts = parts.withColumn("value", F.col("value").cast("decimal(38,0)"))
    sums = parts.groupBy("at").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(math.prod(shape), dtype=object if kind == "long" else np.float64)
    for r in sums:
        out[r["at"]] = int(r["value"]) if kind == "long" else r["value"]
    return out.reshape(shape)


def centred(mean: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    return lambda x: x.astype(np.float64) - mean


def applied(fit: DataFrame, n: int, mean: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The covariance of the rows times a block, in one pass."""
    less = centred(mean)

    def of(x: np.ndarray) -> np.ndarray:
        y = less(x)
        return y.T @ (y @ q)

    return total(fit, len(mean), q.shape, of) / n


def filtered(
    apply: Callable[[np.ndarray], np.ndarray], q: np.ndarray, low: float, cut: float, top: float
) -> np.ndarray:
    """Chebyshev's polynomial in the covariance, small from ``low`` to ``cut`` and
    scaled to be about one at ``top``."""
    half, middle = (cut - low) / 2, (cut + low) / 2
    first = sigma = half / (top - middle)
    before, now = q, (apply(q) - middle * q) * (sigma / half)
    for _ in range(DEGREE - 1):
        following = 1 / (2 / first - sigma)
        after = 2 * (following / half) * (apply(now) - middle * now) - sigma * following * before
        before, now, sigma = now, after, following
    return now


def ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values by falling size, their vectors, and the lengths of the residuals."""
    small = q.T @ vq
    values, turn = np.linalg.eigh((small + small.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    vectors = q @ turn
    return values, vectors, np.linalg.norm(vq @ turn - vectors * values, axis=0)


def leading(
    fit: DataFrame, n: int, mean: np.ndarray, wanted: int = COMPONENTS, block: int = BLOCK
) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of the covariance and their unit vectors.

    Eigenvalues that are zero to rounding are left out. Raises if the vectors are
    not certified after ``MOST_CYCLES`` cycles.
    """
    d = len(mean)
    apply = lambda q: applied(fit, n, mean, q)
    rng = np.random.default_rng(0)
    q = np.linalg.qr(rng.normal(size=(d, min(d, block))))[0]
    best = math.inf
    for cycle in range(MOST_CYCLES):
        values, vectors, away = ritz(q, apply(q))
        top = values[0] if len(values) else 0.0
        positive = min(wanted, int((values > 1e-13 * max(top, 0.0)).sum()))
        worst = away[:positive].max(initial=0.0) / top if top > 0 else 0.0
        settled = worst <= SETTLED and worst > best / 2
        if worst <= CERTAIN or settled or q.shape[1] == d and cycle:
            return values[:positive], vectors[:, :positive]
        best = min(best, worst)
        cut = max(values[-1], 1e-3 * top)
        lifted = filtered(apply, vectors, 0.0, cut, top) if cut < top else apply(vectors)
        q = np.linalg.qr(lifted)[0]
    raise RuntimeError(f"components not certified: residual {worst:.1e} of the largest eigenvalue")


def _projected(n: int, sums: list[int], vectors: np.ndarray, values: np.ndarray):
    """Whitened values of rows, and how far they lie from the mean, times n, squared."""
    d, mean = len(sums), np.array([s / n for s in sums])
    turn = vectors / np.sqrt(values)
    held = np.array(sums, dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.array(sums, dtype=np.int64) if max(map(abs, sums), default=0) < 2**62 else None
        for batch in batches:
            at = 0
            for x in _tables(batch, d):
                most = int(np.abs(x.astype(np.float64)).max(initial=0.0)) * n
                most += max(map(abs, sums), default=0)
                if whole is not None and most * most * max(d, 1) < 2**62:
                    away = ((n * x - whole) ** 2).sum(axis=1)
                else:
                    far = ((n * x.astype(object) - held) ** 2).sum(axis=1)
                    away = np.array([min(int(v), MOST) for v in far], dtype=np.int64)
                white = (x.astype(np.float64) - mean) @ turn
                k = white.shape[1]
                ids = batch.column("vec_id").slice(at, len(x))
                at += len(x)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(np.repeat(np.arange(len(x)), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.repeat(away, k)),
                        pa.array(white.ravel()),
                    ],
                    ["vec_id", "component", "deviation", "whitened"],
                )

    return run


PROJECTED = "vec_id long, component int, deviation long, whitened double"
SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)


def identity_error(fit: DataFrame, n: int, mean: np.ndarray, turn: np.ndarray) -> float:
    """Largest entry of the whitened rows' covariance less the identity."""
    less, d, k = centred(mean), len(mean), turn.shape[1]
    middle = total(fit, d, (k,), lambda x: (less(x) @ turn).sum(axis=0)) / n

    def of(x: np.ndarray) -> np.ndarray:
        white = less(x) @ turn - middle
        return white.T @ white

    return float(np.abs(total(fit, d, (k, k), of) / n - np.eye(k)).max(initial=0.0))


def whitened(vectors: DataFrame, wanted: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``.

    ``vectors`` has ``vec_id`` and ``embedding``; other columns are left aside
    whatever their names. Rows whose vector is null or holds null or non-finite
    components are left out. Each distinct vector, in whole numbers (components
    times ``scale``, rounded down), counts once for mean and covariance; every
    row, repeated or not, gives one row a component, also without an id. Shorter
    and empty vectors are filled up with zeros. Components without any spread are
    not returned, so equal vectors, one vector or none give no rows. Where
    eigenvalues are equal any turn of their vectors will do. Components beyond a
    long count as its largest or smallest value, and so does ``deviation``.
    """
    spark = vectors.sparkSession
    usable_rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v")
    ).where(usable(F.col("v")))
    d = usable_rows.agg(F.max(F.size("v"))).first()[0] or 0
    filled = F.concat(
        quantised(F.col("v"), scale), F.array_repeat(F.lit(0).cast("long"), d - F.size("v"))
    )
    rows = stored(usable_rows.select("vec_id", filled.alias("x")), "rows")
    fit = stored(rows.select("x").distinct(), "fit")
    n = fit.count()
    if not n or not d:
        return spark.createDataFrame([], SCHEMA)
    sums = _sums(fit, d)
    mean = np.array([s / n for s in sums])
    values, turned = leading(fit, n, mean, wanted)
    less = centred(mean)
    trace = float(total(fit, d, (1,), lambda x: np.array([(less(x) ** 2).sum()]))[0]) / n
    error = identity_error(fit, n, mean, turned / np.sqrt(values))
    shares = F.element_at(
        F.array(*(F.lit(float(e / trace)) for e in values), F.lit(0.0)), F.col("component")
    )
    found = rows.mapInArrow(_projected(n, sums, turned, values), PROJECTED)
    return found.select(
        "vec_id",
        "component",
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        shares.alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def _sums(fit: DataFrame, d: int) -> list[int]:
    """Exact sums, high and low halves of the numbers added apart in each task."""
    high = total(fit, d, (d,), lambda x: (x >> 32).sum(axis=0))
    low = total(fit, d, (d,), lambda x: (x & 0xFFFFFFFF).sum(axis=0))
    return [int(h) * 2**32 + int(v) for h, v in zip(high, low)]
