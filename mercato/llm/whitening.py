"""Embedding whitening: projection on the leading principal components, scaled to unit variance.

Sums and the centred covariance are taken by the tasks, entry by entry, and added up by Spark; only matrices as wide as
a vector reach the driver, which finds the leading eigenvectors (``eigen``) and sends them back with the projection.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from mercato.llm.eigen import leading
from mercato.llm.vectors import matrix, scaled, usable
from mercato.session import materialise

SCALE = 256
MOST = 1 << 31  # scaled entries must stay below this in size
COMPONENTS = 4
LEAST_SHARE = 1e-12  # of the trace: a component with less is rounding, and has no unit variance to be scaled to


@dataclass
class Whitening:
    """Fitted on ``count`` vectors: exact ``sums`` per dimension, ``components`` as rows with their eigenvalues, the
    covariance's ``trace``, and the largest entry by which the whitened vectors' covariance misses the identity."""

    count: int
    sums: np.ndarray
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = 0.0

    def apply(self, rows: np.ndarray) -> np.ndarray:
        """Rows as integers -> a column per component."""
        return (rows - self.sums / self.count) @ (self.components / np.sqrt(self.values)[:, None]).T


def _summed(parts: DataFrame, count: int) -> np.ndarray:
    """Rows (row, part: array) of the tasks, added up by (row, place in the array): a matrix of ``count`` columns."""
    entries = (
        parts.select("row", F.posexplode("part").alias("column", "x"))
        .groupBy("row", "column").agg(F.sum("x").alias("x")).collect())  # as many as the matrix has, whatever the rows
    out = np.zeros((max((r["row"] for r in entries), default=-1) + 1, count), object if parts.schema["part"].dataType.elementType == LongType() else float)
    for r in entries:
        out[r["row"], r["column"]] = r["x"]
    return out


def _sums(fit: DataFrame) -> tuple[int, np.ndarray]:
    """Number of vectors, and their exact sum."""
    kind = StructType([StructField("row", LongType()), StructField("part", ArrayType(LongType()))])

    def add(batches):
        for batch in batches:
            x = matrix(batch.column(0))
            if len(x):
                total = np.append(x.sum(axis=0), len(x))  # below 2**31 each, and few in a batch
                yield pa.record_batch([pa.array([0], pa.int64()), pa.array([total.tolist()], pa.list_(pa.int64()))], names=kind.names)

    wide = fit.agg(F.max(F.size("x"))).collect()[0][0]
    if wide is None:
        return 0, np.zeros(0)
    total = _summed(fit.select("x").mapInArrow(add, kind), wide + 1)[0]
    return int(total[-1]), total[:-1].astype(np.int64)


def _centred(fit: DataFrame, wide: int, centre: np.ndarray, project=None) -> np.ndarray:
    """Sum over ``fit`` of (v - centre) (v - centre)', v a vector or what ``project`` makes of it. Each task adds up its
    own rows first."""
    kind = StructType([StructField("row", LongType()), StructField("part", ArrayType(DoubleType()))])

    def add(batches):
        total = np.zeros((wide, wide))
        for batch in batches:
            x = matrix(batch.column(0))
            if len(x):
                x = (project(x) if project else x) - centre
                total += x.T @ x
        yield pa.record_batch(
            [pa.array(np.arange(wide)), pa.array(total.tolist(), pa.list_(pa.float64()))], names=kind.names)

    return _summed(fit.select("x").mapInArrow(add, kind), wide)


def _means(fit: DataFrame, model: Whitening) -> np.ndarray:
    """Mean of the whitened vectors; zero but for rounding."""
    kind = StructType([StructField("row", LongType()), StructField("part", ArrayType(DoubleType()))])

    def add(batches):
        total = np.zeros(len(model.values))
        for batch in batches:
            x = matrix(batch.column(0))
            if len(x):
                total += model.apply(x).sum(axis=0)
        yield pa.record_batch([pa.array([0], pa.int64()), pa.array([total.tolist()], pa.list_(pa.float64()))], names=kind.names)

    return _summed(fit.select("x").mapInArrow(add, kind), len(model.values))[0] / model.count


def vectors(rows: DataFrame, vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """The usable rows of ``rows`` as ``row`` (a struct of all their columns) and ``x``, their scaled vectors; shorter
    ones are filled up with zeros to the longest."""
    kept = rows.filter(usable(F.col(vector_col))).select(F.struct("*").alias("row"), scaled(F.col(vector_col), scale, MOST).alias("x"))
    kept = materialise(kept, "vectors")
    wide = kept.agg(F.max(F.size("x"))).collect()[0][0] or 0
    return kept.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("bigint"), F.lit(wide) - F.size("x"))))


def fit(found: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Whitening fitted on each distinct vector ``x`` of ``found`` once; copies collapse before the shuffle.

    Fewer components than asked for where the vectors have fewer dimensions or vary in fewer directions; none for an
    empty table or a single distinct vector.
    """
    distinct = materialise(found.select("x").distinct(), "distinct-vectors")
    count, sums = _sums(distinct)
    wide = len(sums)
    if not count or not wide:
        return Whitening(count, sums, np.zeros(0), np.zeros((0, wide)), 0.0)
    covariance = _centred(distinct, wide, sums / count) / count
    trace = float(np.trace(covariance))
    values, rows = leading((covariance + covariance.T) / 2, components)
    real = values > LEAST_SHARE * trace
    model = Whitening(count, sums, values[real], rows[real], trace)
    if len(model.values):
        around = _centred(distinct, len(model.values), _means(distinct, model), model.apply) / count
        model.identity_error = float(np.abs(around - np.eye(len(model.values))).max())
    return model


def deviations(x: np.ndarray, count: int, sums: np.ndarray) -> list[int]:
    """Sum over dimensions of (count * x - sum)**2 of each row, exact."""
    away = x * count - sums if x.size and np.abs(x).max() * float(count) < 2 ** 62 else x.astype(object) * count - sums
    if away.dtype != object and (away.astype(float) ** 2).sum(axis=1).max(initial=0) >= 2 ** 62:
        away = away.astype(object)
    return [int(v) for v in (away ** 2).sum(axis=1)]


def transform(found: DataFrame, model: Whitening) -> DataFrame:
    """``found`` (see :func:`vectors`) with ``whitened`` (array<double>, an entry per component) and ``deviation`` (long; the
    squared distance from the mean, times the square of the number of fitted vectors; raises where a long is too short)."""
    out = StructType([*found.schema.fields, StructField("whitened", ArrayType(DoubleType())), StructField("deviation", LongType())])
    at = found.columns.index("x")

    def run(batches):
        for batch in batches:
            x = matrix(batch.column(at), len(model.sums))
            yield pa.record_batch([
                *batch.columns, pa.array(model.apply(x).tolist(), pa.list_(pa.float64())),
                pa.array(deviations(x, model.count, model.sums), pa.int64())], names=out.names)

    return found.mapInArrow(run, out)


def whiten(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE,
) -> DataFrame:
    """``id_col``, component (from 1), n, deviation, whitened, explained, identity_error of every usable row and component.

    Rows whose vector is null or holds null or non-finite entries are left out, null ids stay. Entries become
    floor(scale * c); ones of ``MOST`` or more raise. Shorter vectors are filled up with zeros. Repeated rows are all
    returned, and count once in the fit. No component, and so no row, comes from an empty table, empty vectors or a
    single distinct vector; where vectors vary in fewer directions than ``components``, there are only these. Equal
    eigenvalues share a space, in which some orthogonal directions are taken, the same for all rows. Other columns are
    not read, whatever their names.
    """
    found = vectors(rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")), "vector", scale)
    model = fit(found, components)
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.values]).cast("array<double>")
    return transform(found, model).select(
        F.col("row.id").alias("id"), "deviation",
        F.posexplode(F.arrays_zip(F.col("whitened"), explained.alias("explained"))).alias("at", "value")
    ).select(
        F.col("id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(model.count).cast("bigint").alias("n"), "deviation",
        F.col("value.whitened").alias("whitened"), F.col("value.explained").alias("explained"),
        F.lit(model.identity_error).alias("identity_error"))
