"""Rank-revealing least squares from a tree of QR factors (G1, G2, M2 without penalty).

``factor`` never forms XᵀX, whose condition is the square of X's.  Each partition turns its
Arrow batches into one small triangular factor R, and factors are stacked and factored again
in groups of ``FAN`` until few are left.  A factor has (p + 2)² numbers whatever the number of
rows, so a task holds at most ``FAN`` of them next to one Arrow batch, and the driver one for
every ``FAN``² partitions.

On the driver the columns of R are pivoted: the intercept first, then always the feature with
the largest part that the earlier ones don't explain, relative to its own spread (the first of
equal ones).  Features whose unexplained part is below ``TOL`` of their spread are *aliased*:
their coefficient is 0 and the rank is that of the others.  Predictions and leverages of rows
are products with p x p numbers in Arrow batches.

Rows with a NULL or non-finite feature or label take no part in the fit; their predictions are
null if a feature is missing.  Without rows the fit has rank 0 and predicts null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c

FAN = 64
TOL = 1e-9


def _numbers(batch: pa.RecordBatch) -> np.ndarray:
    """The batch as a matrix; missing values are NaN."""
    return np.column_stack([col.cast(pa.float64()).to_numpy(zero_copy_only=False) for col in batch.columns]) if batch.num_columns else np.zeros((batch.num_rows, 0))


def _packed(part: int, n: int, r: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"part": part, "n": n, "r": r.ravel().tolist()}],
                                      pa.schema([("part", pa.int64()), ("n", pa.int64()), ("r", pa.list_(pa.float64()))]))


def _factored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    r, n = None, 0
    for batch in batches:
        z = _numbers(batch)
        z = z[np.isfinite(z).all(1)]
        z = np.column_stack([np.ones(len(z)), z])
        n += len(z)
        r = np.linalg.qr(z if r is None else np.vstack([r, z]), mode="r")
    if n:
        yield _packed(TaskContext.get().partitionId(), n, r)


def _merged(table: pa.Table) -> pa.Table:
    width = table["width"][0].as_py()  # the factor of fewer rows than columns is not square
    r = np.linalg.qr(np.vstack([np.asarray(x).reshape(-1, width) for x in table["r"].to_pylist()]), mode="r")
    return pa.Table.from_batches([_packed(table["part"][0].as_py() // FAN, sum(table["n"].to_pylist()), r)])


@dataclass
class Factor:
    """R of [1, features, label] and what follows from it."""

    columns: list[str]
    n: int
    r: np.ndarray

    def __post_init__(self):
        self.kept, self.aliased = self._pivot()
        at = [0, *(j + 1 for j in self.kept)]
        self.inverse = _triangular_inverse(np.linalg.qr(self.r[:, at], mode="r")) if self.n else np.zeros((0, 0))

    def _pivot(self) -> tuple[list[int], list[int]]:
        p = len(self.columns)
        if not self.n:
            return [], list(range(p))
        work = self.r[:, : p + 1].copy()
        size = np.linalg.norm(work, axis=0)
        _project_out(work, 0)
        spread = np.linalg.norm(work, axis=0)
        # a constant column has no spread beyond the rounding of its size
        left = [j for j in range(p) if spread[j + 1] > 1e-13 * np.sqrt(self.n) * size[j + 1]]
        kept: list[int] = []
        while left:
            share = np.array([np.linalg.norm(work[:, j + 1]) / spread[j + 1] for j in left])
            if share.max() <= TOL:
                break
            best = left[int(np.argmax(share >= share.max() * (1 - 1e-9)))]
            kept.append(best)
            left.remove(best)
            _project_out(work, best + 1)
        kept.sort()
        return kept, [j for j in range(p) if j not in kept]

    @property
    def rank(self) -> int:
        """Independent features, the intercept not counted."""
        return len(self.kept)

    @property
    def solution(self) -> tuple[float, np.ndarray]:
        """Intercept and coefficients; 0 for aliased features."""
        beta = np.zeros(len(self.columns))
        if not self.n:
            return float("nan"), beta
        # with Z = QR: least squares of the label's column of R on the kept ones
        at = [0, *(j + 1 for j in self.kept)]
        q, upper = np.linalg.qr(self.r[:, at])
        w = _triangular_inverse(upper) @ (q.T @ self.r[:, -1])
        beta[self.kept] = w[1:]
        return float(w[0]), beta

    @property
    def residual_ss(self) -> float:
        """Σ (y - ŷ)², from the factor alone."""
        if not self.n:
            return 0.0
        q, _ = np.linalg.qr(self.r[:, [0, *(j + 1 for j in self.kept)]])
        y = self.r[:, -1]
        y = y - q @ (q.T @ y)
        y = y - q @ (q.T @ y)
        return float(y @ y)

    def leverage_root(self, intercept: bool = True) -> np.ndarray:
        """W with leverage = |W'z|², z the kept features (after a 1 if ``intercept``)."""
        if intercept:
            return self.inverse
        return _triangular_inverse(np.linalg.qr(self.r[:, [j + 1 for j in self.kept]], mode="r")) if self.kept else np.zeros((0, 0))


def _project_out(work: np.ndarray, j: int) -> None:
    """Remove column j's direction from all columns (twice, for orthogonality)."""
    norm = np.linalg.norm(work[:, j])
    if norm:
        q = work[:, j] / norm
        for _ in range(2):
            work -= np.outer(q, q @ work)
    work[:, j] = 0.0


def _triangular_inverse(r: np.ndarray) -> np.ndarray:
    scale = np.linalg.norm(r, axis=0)
    return np.linalg.solve(r / scale, np.eye(len(r))) / scale[:, None] if len(r) else r


def factor(df: DataFrame, columns, label: str) -> Factor:
    """One pass over the rows, and two small shuffles of triangular factors."""
    columns = list(columns)
    width = len(columns) + 2
    rows = df.select(*[c(x).cast("double").alias(f"x{i}") for i, x in enumerate(columns)], c(label).cast("double").alias("y"))
    parts = rows.mapInArrow(_factored, "part long, n long, r array<double>")
    for _ in range(2):
        parts = (parts.withColumn("width", F.lit(width)).groupBy((F.col("part") / FAN).cast("long").alias("group"))
                 .applyInArrow(_merged, "part long, n long, r array<double>"))
    found = parts.orderBy("part").collect()
    n = sum(x["n"] for x in found)
    r = np.linalg.qr(np.vstack([np.asarray(x["r"]).reshape(-1, width) for x in found]), mode="r") if found else np.zeros((0, width))
    return Factor(columns, n, r)


def _of_rows(fit: Factor, intercept: bool):
    """``(features) -> struct<predicted, leverage>`` over Arrow batches."""
    a, beta = fit.solution
    root = fit.leverage_root(intercept)
    kept = list(fit.kept)

    def values(*features: pa.Array) -> pa.Array:
        z = np.column_stack([x.to_numpy(zero_copy_only=False) for x in features])
        bad = ~np.isfinite(z).all(1) | (fit.n == 0)
        z[bad] = 0.0
        x = np.column_stack([np.ones(len(z)), z[:, kept]]) if intercept else z[:, kept]
        h = ((x @ root) ** 2).sum(1) if fit.n else np.zeros(len(z))
        return pa.StructArray.from_arrays([pa.array(a + z @ beta, mask=bad), pa.array(h, mask=bad)], names=["predicted", "leverage"])
    return F.arrow_udf(values, "predicted double, leverage double")


def with_fit(df: DataFrame, fit: Factor, intercept: bool = True) -> DataFrame:
    """Adds ``predicted`` and ``leverage`` (of the features with the intercept, or without)."""
    both: Column = _of_rows(fit, intercept)(*[c(x).cast("double") for x in fit.columns])
    return df.withColumn("_fit", both).withColumns({"predicted": F.col("_fit.predicted"), "leverage": F.col("_fit.leverage")}).drop("_fit")


def cooks_distance(df: DataFrame, columns, label: str) -> DataFrame:
    """G1 and G2 for any number of features, collinear ones among them: adds ``predicted,
    residual, leverage, cooks_d, influential``.  As in ``diagnose.cooks_distance`` the leverage
    is that of the features without the intercept, p their rank, mse = Σr²/(n - p),
    D = r²·h / (p·mse·(1 - h)²), influential when D > 4/n.  A row of leverage 1 is fitted
    exactly and has no distance (null); neither has any row if p = 0 or n <= p."""
    fit = factor(df, columns, label)
    p = fit.rank
    mse = fit.residual_ss / (fit.n - p) if fit.n > p else 0.0
    rows = with_fit(df, fit, intercept=False).withColumn("residual", F.col("predicted") - c(label))
    gap = 1 - F.col("leverage")
    spread = F.lit(float(p * mse)) * gap * gap
    d = F.when((gap > 1e-12) & (spread > 1e-300), F.col("residual") ** 2 * F.col("leverage") / F.nullif(spread, F.lit(0.0)))
    return rows.withColumn("cooks_d", d).withColumn("influential", F.coalesce(F.col("cooks_d") > F.lit(4.0 / max(fit.n, 1)), F.lit(False)))


def coefficients(df: DataFrame, columns, label: str) -> DataFrame:
    """The fit as rows ``feature, coefficient, aliased``; the intercept first."""
    fit = factor(df, columns, label)
    a, beta = fit.solution
    rows = [("(intercept)", a if fit.n else None, False)] + [(x, float(b), j in fit.aliased) for j, (x, b) in enumerate(zip(fit.columns, beta))]
    return df.sparkSession.createDataFrame(rows, "feature string, coefficient double, aliased boolean")
