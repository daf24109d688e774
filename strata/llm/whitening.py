"""Embedding whitening by a covariance from squares alone (polarisation).

2 cov(a, b) = var(a + b) - var(a) - var(b): variances of every dimension and of
the sum of every pair of dimensions give the whole covariance matrix, and a sum
of squares of integers is exact.

1. Each entry c becomes the integer x = floor(64 c) + 1000000. The fit list is
   each distinct vector once (a grouping with partial aggregation, so a vector
   that fills a third of all rows is one row of it).
2. First pass: n and each dimension's sum S. Second pass: with d = x - m, m the
   integer nearest to S / n, the sums of d_a^2 and (d_a + d_b)^2. Every task adds
   up its own rows in 64-bit integers where they fit, else in Python's; one row
   per task and number goes on, as a decimal, to Spark's sum.
3. On the driver, for the dimensions alone: with y = n x - S = n d + r, r = n m - S,
   the sum of y^2 is n^2 sum(d^2) + 2 n r sum(d) + n r^2, in Python integers, and so
   for pairs. These are exact squares of exactly centred values; each covariance
   is one correctly rounded quotient, sum / (2 n^3). ``eigh`` gives components.
4. Third pass: rows are projected, sqrt-scaled, and the covariance of the result
   over the fit list is compared with the identity.

Vectors are read in Arrow batches; nothing but sums reaches the driver, about
dimensions^2 / 2 numbers.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import write_once

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
# x stays within +-2^40, so that sums of squares over 10^12 rows fit a decimal(38).
LARGEST = 1 << 40
_SUMS = "at long, total decimal(38,0)"


def fixed_point(vectors: DataFrame) -> DataFrame:
    """``vec_id, x`` of the rows with whole, finite vectors of the most common
    length (ties: the longest)."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    rows = rows.filter(F.col("v").isNotNull() & (F.size("v") > 0) & ~F.exists("v", bad))
    limit = F.lit(float(LARGEST))
    whole = F.transform("v", lambda c: F.least(F.greatest(F.floor(c * SCALE + 0.0).cast("double"), -limit), limit).cast("long") + SHIFT)
    rows = write_once(rows.select("vec_id", whole.alias("x")), "white-rows")
    sizes = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.col("count").desc(), F.col("dim").desc()).limit(1)
    found = sizes.collect()
    return rows.filter(F.size("x") == found[0]["dim"]) if found else rows


def _matrix(column: pa.Array) -> np.ndarray:
    """An Arrow array of equally long lists of longs, as rows."""
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def _exact(values: np.ndarray, largest: int) -> np.ndarray:
    """``values`` in a type in which sums of ``largest`` per row are exact."""
    return values if largest * max(1, len(values)) < 1 << 62 else values.astype(object)


def _sums_of(part: Callable[[np.ndarray], list[int]]):
    """A mapInArrow function: per task, the sums of ``part`` over its batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[int] | None = None
        for batch in batches:
            if batch.num_rows:
                own = part(_matrix(batch.column(0)))
                total = own if total is None else [a + b for a, b in zip(total, own)]
        if total is not None:
            numbers = pa.array([str(x) for x in total]).cast(pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int64()), numbers], ["at", "total"])

    return run


def _totals(fit: DataFrame, part: Callable[[np.ndarray], list[int]]) -> list[int]:
    rows = fit.select("x").mapInArrow(_sums_of(part), _SUMS).groupBy("at").agg(F.sum("total").alias("total"))
    return [int(r["total"]) for r in rows.orderBy("at").collect()]


def _counts(x: np.ndarray) -> list[int]:
    return [len(x), *(int(s) for s in _exact(x, LARGEST * 2).sum(axis=0))]


def _squares(middle: list[int]) -> Callable[[np.ndarray], list[int]]:
    """Sums of d and d^2 per dimension, then of (d_a + d_b)^2 for a < b."""
    m = np.array(middle, np.int64)

    def part(x: np.ndarray) -> list[int]:
        d = x - m
        d = _exact(d, (2 * int(np.abs(d).max(initial=0))) ** 2)
        out = [int(s) for s in d.sum(axis=0)] + [int(s) for s in (d * d).sum(axis=0)]
        for a in range(d.shape[1] - 1):
            both = d[:, a : a + 1] + d[:, a + 1 :]
            out.extend(int(s) for s in (both * both).sum(axis=0))
        return out

    return part


class Whitener:
    """What the fit list gives: ``n``, the sums, the covariance and its components."""

    def __init__(self, n: int, sums: list[int], middle: list[int], squares: list[int]):
        dim = len(sums)
        rest = [n * m - s for m, s in zip(middle, sums)]
        plain, own = squares[:dim], squares[dim : 2 * dim]

        def centred(sum_of_squares: int, sum_: int, r: int) -> int:
            return n * n * sum_of_squares + 2 * n * r * sum_ + n * r * r

        alone = [centred(own[a], plain[a], rest[a]) for a in range(dim)]
        self.covariance = np.empty((dim, dim))
        pairs = iter(squares[2 * dim :])
        for a in range(dim):
            self.covariance[a, a] = alone[a] / n**3
            for b in range(a + 1, dim):
                both = centred(next(pairs), plain[a] + plain[b], rest[a] + rest[b])
                self.covariance[a, b] = self.covariance[b, a] = (both - alone[a] - alone[b]) / (2 * n**3)
        self.n, self.middle, self.rest = n, middle, rest
        trace = sum(alone) / n**3
        values, vectors = np.linalg.eigh(self.covariance)
        values, vectors = values[::-1], vectors[:, ::-1]
        # A direction in which the fit list doesn't vary can't be scaled.
        kept = int((values[:COMPONENTS] > values[0] * dim * np.finfo(float).eps).sum()) if values[0] > 0 else 0
        self.values, vectors = values[:kept], vectors[:, :kept]
        largest = np.abs(vectors).argmax(axis=0)
        self.vectors = vectors * np.where(vectors[largest, np.arange(kept)] < 0, -1.0, 1.0)
        self.explained = self.values / trace if kept else self.values

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exactly."""
        d = x - np.array(self.middle, np.int64)
        largest = self.n * (int(np.abs(d).max(initial=0)) + 1)
        if largest < 1 << 62:
            return d * self.n + np.array(self.rest, np.int64)
        return d.astype(object) * self.n + np.array(self.rest, object)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        y = self.centred(x)
        y = (y / self.n).astype(np.float64)
        return y @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums over dimensions of (n x - S)^2; None beyond a long."""
        y = self.centred(x)
        if y.dtype != object and y.shape[1] * int(np.abs(y).max(initial=0)) ** 2 >= 1 << 63:
            y = y.astype(object)
        sums = [int(s) for s in (y * y).sum(axis=1)]
        return [s if s < 1 << 63 else None for s in sums]


def fit_whitener(fit: DataFrame) -> Whitener | None:
    """From distinct vectors ``x``; None without any."""
    counts = _totals(fit, _counts)
    if not counts:
        return None
    n, sums = counts[0], counts[1:]
    middle = [(2 * s + n) // (2 * n) for s in sums]
    return Whitener(n, sums, middle, _totals(fit, _squares(middle)))


def identity_error(fit: DataFrame, white: Whitener) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the
    identity. ``x - S / n`` is centred, and so is its projection."""
    k = len(white.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                w = white.whiten(_matrix(batch.column(0)))
                total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(range(k * k), pa.int64()), pa.array(total.ravel())], ["at", "total"])

    sums = fit.select("x").mapInArrow(run, "at long, total double").groupBy("at").agg(F.sum("total").alias("total"))
    found = np.array([r["total"] for r in sums.orderBy("at").collect()]).reshape(k, k)
    return float(np.abs(found / white.n - np.eye(k)).max())


_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(vectors: DataFrame) -> DataFrame:
    """Per row of ``vectors`` (``vec_id, embedding``) with a whole vector and per
    component, up to 16: ``vec_id, component, n, deviation, whitened, explained,
    identity_error``.

    Components are numbered from 1 by falling eigenvalue; the entry of largest
    absolute value of each is positive. ``identity_error`` is one value for all.

    Defined cases: vectors that are null, empty or hold a null or non-finite
    entry drop out, as do those of another length than most; repeated rows and
    rows with a null vec_id give their rows each; entries beyond 2^40 / 64 count
    as that; directions without variance (fewer distinct vectors than
    dimensions, or one vector only) have no component, and a fit list without
    any gives no rows; ``deviation`` is null beyond a long; extra columns aren't
    read; an empty table gives an empty result.
    """
    rows = fixed_point(vectors)
    fit = write_once(rows.select("x").distinct(), "white-fit")
    white = fit_whitener(fit)
    if white is None or not len(white.values):
        return rows.limit(0).mapInArrow(lambda batches: iter(()), _OUT)
    k = len(white.values)
    error = identity_error(fit, white)
    if not math.isfinite(error):
        raise ArithmeticError("the whitened covariance isn't finite")

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            size = len(x) * k
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(len(x)), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(size, white.n)),
                    pa.array(white.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), k))),
                    pa.array(white.whiten(x).ravel()),
                    pa.array(np.tile(white.explained, len(x))),
                    pa.array(np.full(size, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(project, _OUT)
