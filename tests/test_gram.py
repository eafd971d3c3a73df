"""Moments, their solvers, prepared folds and durable studies."""

import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from pricelens.catalog import _training
from pricelens.plans import gram as GR
from pricelens.plans import pipeline as PL
from pricelens.plans import study as ST
from pricelens.plans.models import LinearFamily
from pricelens.spec import TEST_SALES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 5)) * [1, 10, 0.1, 5, 2] + [0, 1e3, 3, -2, 0]
    y = x @ [2.0, 0.3, -4.0, 0.0, 1.0] + rng.normal(size=400) + 7
    data = [(int(i), int(i % 4), *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(data, "id long, fold int, a double, b double, `c d` double, d double, e double, y double").repartition(5).cache()


NAMES = ["a", "b", "c d", "d", "e"]


def test_moments_of_folds(rows):
    x, y, df = rows
    table = GR.moments(df, NAMES, "y", F.col("fold"))
    assert sorted(table) == ["0", "1", "2", "3"]
    total = table["0"] + table["1"] + table["2"] + table["3"]
    train = total - table["2"]
    own = np.arange(400) % 4 != 2
    z = np.column_stack([x, y])[own]
    assert train.n == own.sum() and np.allclose(train.means, z.mean(0), rtol=1e-12)
    assert np.allclose(train.covariance, np.cov(z.T, bias=True), rtol=1e-8, atol=1e-8)
    scaled = train.affine(np.array([1, 2, 3, 4, 5, 0.0]), np.array([2, 3, 4, 5, 6, 1.0]))
    assert np.allclose(scaled.covariance, np.cov(((z - [1, 2, 3, 4, 5, 0]) / [2, 3, 4, 5, 6, 1]).T, bias=True), rtol=1e-7, atol=1e-8)
    w, b = np.array([1.0, 0.2, 0.0, -1.0, 3.0]), 0.5
    assert train.squared_error(w, b) == pytest.approx(np.mean((x[own] @ w + b - y[own]) ** 2), rel=1e-9)


@pytest.mark.parametrize("family,params", [("Ridge", {"alpha": 1.5}), ("Lasso", {"alpha": 0.4}), ("ElasticNet", {"alpha": 0.3, "l1_ratio": 0.6}), ("LinearSVR", {"C": 0.01})])
def test_every_fold_equals_the_direct_fit(rows, family, params):
    _, _, df = rows
    table = GR.moments(df, NAMES, "y", F.col("fold"))
    found = GR.folds_solved(table, [(family, params)])
    data = VectorAssembler(inputCols=NAMES, outputCol="features").transform(df)
    for r in found:
        direct = LinearFamily(family, params, "features", "y").fit(data.where(F.col("fold") != int(r["fold"])))
        e = direct.transform(data.where(F.col("fold") == int(r["fold"]))).agg(F.sqrt(F.avg((F.col("prediction") - F.col("y")) ** 2))).first()[0]
        assert r["val_rmse"] == pytest.approx(e, rel=1e-6)
        assert np.allclose(r["coefficients"], direct.coefficients.toArray(), rtol=1e-4, atol=1e-5)


def test_collinear_and_constant_columns(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 3))
    df = spark.createDataFrame([(float(a), float(b), float(a), 1.0, float(a + 2 * b)) for a, b, _ in x], "a double, b double, a2 double, one double, y double")
    m = GR.moments(df, ["a", "b", "a2", "one"], "y")[""]
    for family, params in (("Ridge", {"alpha": 1e-9}), ("Lasso", {"alpha": 1e-9})):
        w, b = GR.solve(family, params, m)
        assert m.squared_error(w, b) < 1e-12


def test_missing_values_and_empty_tables(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0), (float("nan"), 5.0), (4.0, None)], "x double, y double")
    m = GR.moments(df, ["x"], "y", fill={"x": 7.0})[""]
    assert m.n == 3 and np.allclose(m.means, [5.0, 10 / 3])
    assert GR.moments(df.where("false"), ["x"], "y") == {}


@pytest.mark.parametrize("family", ["Ridge", "DecisionTreeRegressor"])
def test_prepared_folds_equal_single_trials(spark, family):
    table = _training(spark, SF).where(F.col("fold") != 0)
    rng = random.Random(9)
    choices = [ch for ch in (PL.sample_choice(family, rng) for _ in range(30)) if ch.selection in ("ANOVA", "MutualInformation") and not ch.drop_correlated][:2]
    many = PL.evaluate(table, choices, TEST_SALES, 2, rare_tol=0.04)
    for ch, res in zip(choices, many):
        one = PL.cross_validate(table, ch, TEST_SALES, 2, rare_tol=0.04)
        for m in ST.METRICS:
            assert res[m] == pytest.approx(one[m], rel=1e-6), (ch, m)


def test_studies_go_on_and_agree(spark, tmp_path):
    table = _training(spark, SF).where(F.col("fold") != 0)
    path = str(tmp_path / "trials")
    whole = PL.tune(table, "Lasso", 4, TEST_SALES, inner_folds=2, rare_tol=0.04, study=ST.Study(spark, path, "a"), batch=2, workers=1)
    ran = []
    evaluate = PL.evaluate
    try:  # a driver lost after the first batch
        PL.evaluate = lambda *a, **k: ran.append(len(a[1])) or (evaluate(*a, **k) if len(ran) < 2 else (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            PL.tune(table, "Lasso", 4, TEST_SALES, inner_folds=2, rare_tol=0.04, study=ST.Study(spark, path, "b"), batch=2)
        PL.evaluate = lambda *a, **k: ran.append(len(a[1])) or evaluate(*a, **k)
        again = PL.tune(table, "Lasso", 4, TEST_SALES, inner_folds=2, rare_tol=0.04, study=ST.Study(spark, path, "b"), batch=2)
    finally:
        PL.evaluate = evaluate
    assert ran == [2, 2, 2]  # the last call ran only what was left
    assert [t["params"] for t in again] == [t["params"] for t in whole]
    assert [t["value"] for t in again] == pytest.approx([t["value"] for t in whole], rel=1e-9)


def test_families_share_folds_and_errors_keep_their_kind(monkeypatch):
    calls = []

    def evaluate(train, choices, *a):
        calls.append(list(choices))
        return [ValueError("draw") if k == 1 else {m: float(k) for m in ST.METRICS} for k in range(len(choices))]
    monkeypatch.setattr(PL, "evaluate", evaluate)
    drawn = [ch for f in ("Ridge", "Lasso") for ch in PL.draws(f, 3)]
    shared = PL.SharedFolds(None, drawn, TEST_SALES)
    ridge, lasso = (PL.tune(None, f, 3, TEST_SALES, shared=shared) for f in ("Ridge", "Lasso"))
    assert calls == [drawn]
    assert [(t["value"], t["state"]) for t in ridge + lasso] == [(0.0, "COMPLETE"), (None, "FAIL"), *[(float(k), "COMPLETE") for k in range(2, 6)]]
    assert [t["value"] for t in PL.tune(None, "Ridge", 3, TEST_SALES)] == [0.0, None, 2.0] and calls[1:] == [drawn[:3]]

    def broken(*a):
        raise ValueError("no draw's own")
    monkeypatch.setattr(PL, "evaluate", broken)
    with pytest.raises(RuntimeError):
        PL.tune(None, "Ridge", 3, TEST_SALES)
