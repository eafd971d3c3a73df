"""Least squares from QR factors against NumPy: collinear, constant, shifted and missing values."""

import numpy as np
import pytest

from pricelens.plans import qr as QR

NAMES = [f"x {i}" for i in range(12)]


def _frame(spark, x, y, parts=7):
    rows = [(int(i), *[None if np.isnan(v) else float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"`x {i}` double" for i in range(x.shape[1])) + ", y double").repartition(parts)


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, 12)) * np.logspace(-3, 3, 12) + np.linspace(0, 1e5, 12)
    x[:, 7] = x[:, 2]                       # a duplicated column
    y = x @ rng.normal(size=12) + rng.normal(size=500)
    return x, y, _frame(spark, x, y).cache()


def test_duplicated_column_against_numpy(data):
    x, y, df = data
    fit = QR.factor(df, NAMES, "y")
    assert (fit.n, fit.rank, fit.aliased) == (500, 11, [7])
    a, beta = fit.solution
    own = np.delete(x, 7, 1)
    z = np.column_stack([np.ones(500), own - own.mean(0)])
    want = np.linalg.lstsq(z, y, rcond=None)[0]
    assert beta[7] == 0 and np.allclose(np.delete(beta, 7), want[1:], rtol=1e-6, atol=1e-9)
    assert fit.residual_ss == pytest.approx(((y - z @ want) ** 2).sum(), rel=1e-8)
    got = {r["id"]: r for r in QR.with_fit(df, fit).collect()}
    hat = np.einsum("ij,ij->i", z @ np.linalg.pinv(z.T @ z), z)
    assert np.allclose([got[i]["predicted"] for i in range(500)], z @ want, rtol=1e-9)
    assert np.allclose([got[i]["leverage"] for i in range(500)], hat, atol=1e-7)


def test_cooks_distance_against_numpy(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 4)) + 2
    x[:, 3] = 2 * x[:, 0] - x[:, 1]         # a linear combination
    y = x[:, 0] + rng.normal(size=200)
    y[3] += 30
    got = {r["id"]: r for r in QR.cooks_distance(_frame(spark, x, y), NAMES[:4], "y").collect()}
    own = x[:, :3]
    z = np.column_stack([np.ones(200), own])
    r = z @ np.linalg.lstsq(z, y, rcond=None)[0] - y
    h = np.einsum("ij,ij->i", own @ np.linalg.inv(own.T @ own), own)
    d = r**2 * h / (3 * (r @ r / 197) * (1 - h) ** 2)
    assert np.allclose([got[i]["cooks_d"] for i in range(200)], d, rtol=1e-7)
    assert np.allclose([got[i]["residual"] for i in range(200)], r, atol=1e-9)
    assert [got[i]["influential"] for i in range(200)] == list(d > 4 / 200) and got[3]["influential"]


def test_large_means_keep_their_digits(spark):
    """The normal equations lose these: the spread is 1e-9 of the mean, its square below rounding."""
    rng = np.random.default_rng(7)
    u = rng.normal(size=(300, 2))
    x = 1e6 + 1e-3 * u
    df = _frame(spark, x, u @ [3.0, -2.0])
    fit = QR.factor(df, NAMES[:2], "y")
    assert fit.rank == 2 and np.allclose(fit.solution[1], [3e3, -2e3], rtol=1e-5)


def test_missing_constant_short_and_empty(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(60, 4))
    x[:, 1] = 0.1                            # constant: aliased to the intercept
    x[:, 2] = 0.0
    x[5, 0] = np.nan
    y = 4 * x[:, 0] + 1
    y[5] = 1e9                               # its feature is missing: no part in the fit
    y[6] = np.inf
    df = _frame(spark, x, y, 80)             # most partitions hold fewer rows than columns
    fit = QR.factor(df, NAMES[:4], "y")
    assert (fit.n, fit.kept) == (58, [0, 3]) and np.allclose(fit.solution[1], [4, 0, 0, 0], atol=1e-9) and fit.solution[0] == pytest.approx(1)
    got = {r["id"]: r["predicted"] for r in QR.with_fit(df, fit).collect()}
    assert got[5] is None and got[6] == pytest.approx(4 * x[6, 0] + 1)
    none = df.where("id < 0")
    assert QR.factor(none, NAMES[:4], "y").rank == 0 and QR.cooks_distance(none, NAMES[:4], "y").count() == 0
    two = df.where("id < 2")                 # more features than rows: rank 1, fitted exactly
    fit = QR.factor(two, NAMES[:4], "y")
    assert fit.rank == 1 and fit.residual_ss == pytest.approx(0, abs=1e-18)
    assert [r["coefficient"] for r in QR.coefficients(none, NAMES[:1], "y").collect()] == [None, 0.0]
