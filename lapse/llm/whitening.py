"""Embedding whitening: blockwise QR, Householder bidiagonalisation, dqds, twisted factorisations.

Vectors are scaled to whole numbers, so counts, sums and squared deviations are
exact.  The fit list has every distinct vector once.  Its rows, centred first,
are never multiplied with each other: every task reduces its rows block by
block to one triangular R (a QR of the block under the R before it), the Rs are
merged by the same step in a tree of tasks, and the last R has the singular
values and right vectors of the whole centred list.  ``bidiagonal.directions``
finds them; the squared singular values over n are the variances.

Bounded: an R has dimension^2 numbers, whatever the row count; that and the
column sums are all that reaches the driver.

Defined cases: rows whose vector is null, empty or holds null, NaN or infinite
entries are dropped; of vectors of several lengths those of the commonest
length stay (the longer one of equally common ones); a null vec_id is kept;
repeated rows are fitted once and answered one by one; components without
variance (fewer distinct vectors than that, constant columns) are left out, so
a table with fewer than two distinct vectors gives no rows; a deviation beyond
a long is null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.llm.bidiagonal import directions
from lapse.llm.common import read_table
from lapse.session import materialize

COMPONENTS = 4
SCALE = 256
BLOCK = 2048                # rows that a QR takes at once
FAN_IN = 32                 # Rs that a task of the tree merges


def scaled(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, x) of the rows with a finite vector of the commonest length; x = floor(scale * entry)."""
    entry = lambda c: c.cast("double")
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(entry(c)) & (F.abs(entry(c)) < F.lit(float("inf"))))
    some = table.select("vec_id", "embedding").where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & finite)
    length = (some.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n"))
              .agg(F.max_by("d", F.struct("n", "d"))).scalar())
    return some.where(F.size("embedding") == length).select(
        "vec_id", F.transform("embedding", lambda c: F.floor(F.lit(float(scale)) * entry(c)).cast("long")).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten())
    return flat.reshape(len(column), -1)


def column_sums(fit: DataFrame) -> tuple[int, list[int]]:
    """(rows, exact sum of each dimension) of the fit list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, 0
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch["x"])
                n += len(x)
                wide = int(np.abs(x).max()) * len(x) >= 1 << 62 or int(x.min()) == -(1 << 63)
                total = total + (x.astype(object).sum(axis=0) if wide else x.sum(axis=0).astype(object))
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total), pa.int64()),
                 pa.array([str(v) for v in total])], ["at", "n", "total"])

    parts = fit.select("x").mapInArrow(run, "at int, n long, total string")
    rows = (parts.groupBy("at").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
            .orderBy("at").collect())           # a row for each dimension
    return (rows[0]["n"] if rows else 0), [int(r["total"]) for r in rows]


def _deviations(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """n * x - S, exactly; an object array if a long can't hold a sum of its squares."""
    widest = n * max(abs(int(x.min())), abs(int(x.max()))) + max(abs(int(v)) for v in total)
    if widest * widest * len(total) < 1 << 63:
        return n * x - total.astype(np.int64)
    return n * x.astype(object) - total


def _merged(blocks: Iterator[np.ndarray]) -> np.ndarray | None:
    """R of all blocks stacked, one block at a time."""
    r = None
    for block in blocks:
        r = np.linalg.qr(block if r is None else np.vstack((r, block)), mode="r")
    return r


def _as_batch(r: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    if r is not None:
        yield pa.RecordBatch.from_arrays([pa.array([r.astype("<f8").tobytes()]), pa.array([r.shape[1]], pa.int32())],
                                         ["r", "d"])


def triangular(fit: DataFrame, n: int, totals: list[int]) -> np.ndarray:
    """R of the centred fit list, merged in a tree."""
    total = np.array(totals, object)

    def centred(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                x = _matrix(batch["x"].slice(at, BLOCK))
                yield _deviations(x, n, total).astype(float) / n

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _as_batch(_merged(centred(batches)))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _as_batch(_merged(
            np.frombuffer(r, "<f8").reshape(-1, d) for batch in batches
            for r, d in zip(batch["r"].to_pylist(), batch["d"].to_pylist())))

    level = materialize(fit.select("x").mapInArrow(leaves, "r binary, d int"), "triangles")
    left = level.count()
    while left > FAN_IN:
        left = -(-left // FAN_IN)
        level = materialize(level.repartition(left).mapInArrow(merge, "r binary, d int"), "triangles")
    rest = level.collect()                      # at most FAN_IN of dimension^2 numbers
    return _merged(np.frombuffer(r["r"], "<f8").reshape(-1, r["d"]) for r in rest)


class Whitening:
    """Mean, directions and variances of a fit list."""

    def __init__(self, fit: DataFrame, components: int = COMPONENTS) -> None:
        self.n, totals = column_sums(fit)
        self.total = np.array(totals, object)
        self.variance, self.explained, self.axes = np.zeros(0), np.zeros(0), np.zeros((len(totals), 0))
        if self.n:
            r = triangular(fit, self.n, totals)
            square = np.zeros((r.shape[1], r.shape[1]))
            square[:len(r)] = r
            values, self.axes = directions(square, components)
            self.variance = values / self.n
            if len(values):
                self.explained = values / float((r * r).sum())

    def transform(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(n * x - S, whitened) of rows of whole numbers."""
        deviation = _deviations(x, self.n, self.total)
        return deviation, (deviation.astype(float) / self.n) @ (self.axes / np.sqrt(self.variance))


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity."""
    k = len(model.variance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(k + k * k)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                w = model.transform(_matrix(batch["x"].slice(at, BLOCK)))[1]
                found += np.concatenate((w.sum(axis=0), (w.T @ w).ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(found)), pa.int32()), pa.array(found)], ["at", "v"])

    rows = fit.select("x").mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    v = np.array([r["v"] for r in sorted(rows)])
    mean, square = v[:k] / model.n, v[k:].reshape(k, k) / model.n
    return float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max())


OUT = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                 ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])


def whiten(rows: DataFrame, model: Whitening, error: float) -> DataFrame:
    """A row for each row of ``rows`` (vec_id, x) and component."""
    k = len(model.variance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                deviation, w = model.transform(_matrix(part["x"]))
                square = [v if v < 1 << 63 else None for v in (deviation * deviation).sum(axis=1).tolist()]
                m = len(part)
                yield pa.RecordBatch.from_arrays(
                    [part["vec_id"].take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                     pa.array(np.full(m * k, model.n)), pa.array([v for v in square for _ in range(k)], pa.int64()),
                     pa.array(w.ravel()), pa.array(np.tile(model.explained, m)), pa.array(np.full(m * k, error))], schema=OUT)

    return rows.select(F.col("vec_id").cast("long"), "x").mapInArrow(
        run, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every embedding."""
    rows = scaled(read_table(spark, sf_dir, "embeddings"))
    fit = materialize(rows.select("x").distinct(), "fit_list")
    model = Whitening(fit)
    if not len(model.variance):
        return rows.select("vec_id").mapInArrow(lambda batches: iter(()), "vec_id long, component int, n long, deviation long, "
                                                "whitened double, explained double, identity_error double")
    return whiten(rows, model, identity_error(fit, model))
