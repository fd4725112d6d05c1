"""Embedding whitening by pivoted Cholesky and one-sided Jacobi (operator 13).

* Components become integers, floor(scale * c) + offset, so that counts, sums and
  the scatter are exact whatever the order of the tasks.
* Each task adds up the integers' products centred by the rounded mean, at most
  2^53 at a time in one matrix product; a grouped sum per matrix entry follows.
  The rest of the mean is taken off in whole numbers, so every covariance is
  rounded once.
* The covariance (dims x dims, the only thing the driver holds) is factored by
  Cholesky with diagonal pivots, P'VP = LL'.  One-sided Jacobi rotates the
  columns of PL until they are orthogonal: their squared norms are the
  eigenvalues, the normalised columns the components.
* The rows are projected in tasks; the covariance of the projections, again a
  grouped sum, gives the error against the identity.

Defined results: vectors that are null, empty, or hold a null or non-finite
component take no part, nor those with a component beyond 2^52 / scale (it has
no exact integer), nor those of another length than most (of equally frequent
lengths the least counts); repeated rows each count and each come back; null ids
stay null; directions of no variance are no components, so equal rows alone give
no rows, as an empty table does; a deviation that does not fit a long is null;
columns other than the id and the vector are ignored.  Of equal eigenvalues the
order is that of the rotations, the same in every run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablepipe.llm.common import written

SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8
# Rows that a task multiplies at a time.
ROWS = 4096
EXACT = 1 << 53
SWEEPS = 60
EPS = np.finfo(np.float64).eps


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """The factor F (dims x rank, rows in the order of ``v``) with v = FF', largest
    remaining diagonal first; stops where what remains is rounding."""
    rest, n = np.array(v, np.float64), len(v)
    least = n * EPS * max(rest.diagonal().max(initial=0), 0)
    columns, free = [], np.ones(n, bool)
    for _ in range(n):
        diagonal = np.where(free, rest.diagonal(), -np.inf)
        pivot = int(diagonal.argmax())
        if diagonal[pivot] <= least:
            break
        column = np.where(free, rest[:, pivot], 0) / np.sqrt(diagonal[pivot])
        free[pivot] = False
        rest -= np.outer(column, column)
        columns.append(column)
    return np.stack(columns, axis=1) if columns else np.zeros((n, 0))


def jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit components in columns) of factor @ factor.T, falling.

    One-sided: pairs of columns are rotated until all are orthogonal; the pairs of
    a round are disjoint (a round-robin) and rotate together."""
    a = np.array(factor, np.float64)
    r = a.shape[1]
    seats = list(range(r + r % 2))
    for _ in range(SWEEPS):
        worst = 0.0
        for _ in range(len(seats) - 1):
            half = len(seats) // 2
            pairs = [(p, q) for p, q in zip(seats[:half], seats[: half - 1 : -1]) if p < r and q < r]
            seats = [seats[0], seats[-1], *seats[1:-1]]
            if not pairs:
                continue
            p, q = (np.array(x) for x in zip(*pairs))
            x, y = a[:, p], a[:, q]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            size = np.sqrt(xx) * np.sqrt(yy)
            off = np.divide(np.abs(xy), size, out=np.zeros_like(xy), where=size > 0)
            worst = max(worst, float(off.max()))
            turn = off > EPS
            zeta = np.divide(yy - xx, 2 * xy, out=np.zeros_like(xy), where=turn)
            t = np.where(turn, np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1, zeta)), 0.0)
            c = 1 / np.hypot(1, t)
            a[:, p], a[:, q] = c * x - c * t * y, c * t * x + c * y
        if worst <= 8 * EPS:
            break
    norms = np.sqrt((a * a).sum(axis=0))
    order = np.argsort(-norms, kind="stable")
    order = order[norms[order] > 0]
    return norms[order] ** 2, a[:, order] / norms[order]


def _usable(v: Column, scale: float) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float(1 << 52) / scale)))
    return v.isNotNull() & (F.size(v) > 0) & fine


def _integers(column: pa.Array, dim: int, scale: float, offset: int) -> np.ndarray:
    c = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return np.floor(scale * c).astype(np.int64) + offset


def _sums(rows: DataFrame, dim: int, scale: float, offset: int) -> dict:
    """n, and per dimension the exact sum, the least and the largest of the integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, low, high = 0, np.zeros(dim, object), np.full(dim, np.iinfo(np.int64).max), np.full(dim, np.iinfo(np.int64).min)
        for b in batches:
            for k in range(0, b.num_rows, ROWS):
                x = _integers(b.column(1).slice(k, ROWS), dim, scale, offset)
                n += len(x)
                top, bottom = x >> 32, x & 0xFFFFFFFF  # halves, as whole numbers of any size are added
                sums += top.sum(axis=0).astype(object) * (1 << 32) + bottom.sum(axis=0).astype(object)
                low, high = np.minimum(low, x.min(axis=0)), np.maximum(high, x.max(axis=0))
        if n:
            from decimal import Decimal

            yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(np.full(dim, n)), pa.array([Decimal(int(s)) for s in sums], pa.decimal128(38, 0)), pa.array(low), pa.array(high)], names=["i", "n", "s", "low", "high"])

    found = rows.mapInArrow(run, "i int, n long, s decimal(38,0), low long, high long").groupBy("i")
    got = found.agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("low").alias("low"), F.max("high").alias("high")).orderBy("i").collect()  # one row a dimension
    return {"n": int(got[0]["n"]), "s": [int(r["s"]) for r in got], "low": [r["low"] for r in got], "high": [r["high"] for r in got]}


def _products(rows: DataFrame, take, width: int, whole: bool) -> list:
    """The sums of products of the columns that ``take`` makes of a batch, as
    rows (i, j, v) with i <= j.  ``whole``: they are integers and stay exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper, total, seen = np.triu_indices(width), None, False
        for b in batches:
            for k in range(0, b.num_rows, ROWS):
                x = take(b.slice(k, ROWS))
                most = float(np.abs(x).max(initial=0))
                if not whole:
                    part = x.T @ x
                elif most * most < EXACT / ROWS:
                    part = np.rint(x.T @ x).astype(np.int64).astype(object)  # no step of it rounds
                else:
                    some = x.astype(np.int64).astype(object)
                    part = some.T @ some
                total, seen = part if total is None else total + part, True
        if seen:
            from decimal import Decimal

            values = total[upper]
            kept = pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0)) if whole else pa.array(values.astype(np.float64))
            part_id = pa.array(np.full(len(values), TaskContext.get().partitionId(), np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)), part_id, kept], names=["i", "j", "part", "v"])

    parts = rows.mapInArrow(run, f"i int, j int, part long, v {'decimal(38,0)' if whole else 'double'}")
    if whole:
        return parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()  # dims x dims
    # Doubles are added in the order of the partitions, so that a rerun gives the same sum.
    ordered = F.array_sort(F.collect_list(F.struct("part", "v")))
    return parts.groupBy("i", "j").agg(F.aggregate(ordered, F.lit(0.0), lambda a, x: a + x["v"]).alias("v")).collect()


def fit(rows: DataFrame, dim: int, scale: float = SCALE, offset: int = OFFSET) -> dict:
    """n, s, and the eigenvalues and components of the exact covariance of ``rows`` (id, v)."""
    found = _sums(rows, dim, scale, offset)
    n, s = found["n"], found["s"]
    middle = _rounded_mean(n, s)

    def centred(b: pa.RecordBatch) -> np.ndarray:
        return (_integers(b.column(1), dim, scale, offset) - middle).astype(np.float64)

    scatter = np.zeros((dim, dim), object)
    for r in _products(rows, centred, dim, True):
        scatter[r["i"], r["j"]] = scatter[r["j"], r["i"]] = int(r["v"])
    rest = np.array([t - n * int(m) for t, m in zip(s, middle)], object)
    exact = n * scatter - np.outer(rest, rest)
    covariance = np.array([[_ratio(x, n * n) for x in row] for row in exact])
    values, components = jacobi(pivoted_cholesky(covariance))
    return found | {"values": values, "components": components, "trace": float(np.trace(covariance))}


def _rounded_mean(n: int, s: list[int]) -> np.ndarray:
    return np.array([(2 * t + n) // (2 * n) for t in s], np.int64)


def _ratio(a: int, b: int) -> float:
    return int(a) / int(b)  # whole numbers of any size, rounded once


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: float = SCALE, offset: int = OFFSET) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row
    for each usable vector and component, up to ``components``."""
    spark = vectors.sparkSession
    kind = vectors.schema[id_col].dataType.simpleString()
    result = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = vectors.where(_usable(F.col(vector_col), scale)).select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    dims = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not dims:
        return spark.createDataFrame([], result)
    dim = dims[0]["d"]
    rows = rows.where(F.size("v") == dim)
    model = fit(rows, dim, scale, offset)
    n, s, e = model["n"], model["s"], model["values"][:components]
    if not len(e):
        return spark.createDataFrame([], result)
    axes = model["components"][:, : len(e)] / np.sqrt(e)
    middle, sums = _rounded_mean(n, s), np.array(s, object)
    rest = np.array([_ratio(t - n * int(m), n) for t, m in zip(s, middle)])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, ROWS):
                some = b.slice(k, ROWS)
                x = _integers(some.column(1), dim, scale, offset)
                off = (x - middle).astype(np.float64) - rest
                about = (off * off).sum(axis=1) * (float(n) * n)
                deviation: list = [None] * len(x)
                fits = np.flatnonzero(about < 1.01 * 2.0**63)  # the others leave a long
                if (about < 2.0**62).all() and n * (np.abs(x).max(initial=0) + 1.0) < 2.0**62:
                    wide = n * x - sums.astype(np.int64)
                    deviation = (wide * wide).sum(axis=1).tolist()
                elif len(fits):
                    wide = n * x[fits].astype(object) - sums
                    for j, d in zip(fits, (wide * wide).sum(axis=1)):
                        deviation[j] = int(d) if d < 1 << 63 else None
                w = np.zeros((len(x), len(e)))
                for d in range(dim):  # in this order for every row, so that a batch's shape changes no bit
                    w += off[:, d : d + 1] * axes[d]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * len(e), pa.int32()), pa.array(w.ravel()))
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(deviation, pa.int64()), lists], names=["vec_id", "deviation", "w"])

    white = written(rows.mapInArrow(project, f"vec_id {kind}, deviation long, w array<double>"), "whitened")

    def with_one(b: pa.RecordBatch) -> np.ndarray:
        w = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(e))
        return np.concatenate([w, np.ones((len(w), 1))], axis=1)  # the last column gives the sums

    moments = np.zeros((len(e) + 1, len(e) + 1))
    for r in _products(white, with_one, len(e) + 1, False):
        moments[r["i"], r["j"]] = moments[r["j"], r["i"]] = r["v"]
    mean = moments[-1, :-1] / n
    error = float(np.abs(moments[:-1, :-1] / n - np.outer(mean, mean) - np.eye(len(e))).max())
    out = white.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    share = F.element_at(F.array(*[F.lit(float(x / model["trace"])) for x in e]), F.col("at") + 1)
    return out.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", share.alias("explained"), F.lit(error).alias("identity_error"))
