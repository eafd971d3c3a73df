import tempfile
import threading

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from pricelens.catalog import clean_table
from pricelens.plans import pipeline as PL
from pricelens.spec import TEST_SALES

SF = "/root/testdata/sf0.001"


def test_folds_disjoint_and_stable(spark):
    t = PL.prepare_training_table(clean_table(spark, SF), TEST_SALES)
    a = {r["row_id"]: r["fold"] for r in t.select("row_id", "fold").collect()}
    b = {r["row_id"]: r["fold"] for r in PL.assign_folds(t.drop("fold"), 5).select("row_id", "fold").collect()}
    assert a == b and set(a.values()) == set(range(5))
    assert len(a) == t.count()


def test_contiguous_blocks_match_ntile(spark):
    df = spark.range(0, 100).select((F.col("id") * 7 % 100).alias("k"))
    out = sorted((r["k"], r["block"]) for r in PL.contiguous_folds(df, 3, ["k"]).collect())
    expect = [(k, 1 if k < 34 else (2 if k < 67 else 3)) for k in range(100)]
    assert out == expect


@pytest.mark.parametrize("few", [10_000, 2])
def test_contiguous_blocks_of_odd_rows_without_a_join(spark, monkeypatch, few):
    monkeypatch.setattr(PL, "FEW", few)
    rng = np.random.default_rng(3)
    rows = [(None if a == 0 else "abc"[a % 3], float("nan") if b == 4 else None if b == 3 else float(b), int(d))
            for a, b, d in zip(rng.integers(0, 6, 200), rng.integers(0, 5, 200), rng.integers(0, 3, 200))]
    df = spark.createDataFrame(rows, "a string, b double, d int").repartition(5)
    place = lambda r: tuple((0, 0) if v is None else (2, 0) if v != v else (1, v) for v in r)
    keys = sorted(map(place, rows))
    for k in (3, 7):
        q, more = divmod(200, k)
        ends = np.cumsum([q + (i < more) for i in range(k)])
        found = PL.contiguous_folds(df, k, ["a", "b", "d"])
        assert found.columns == ["a", "b", "d", "block"]
        assert all(r["block"] == 1 + np.searchsorted(ends, keys.index(place(r[:3])), side="right") for r in found.collect())
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan
    assert PL.contiguous_folds(df.where("false"), 3, ["a", "b", "d"]).count() == 0


def test_nested_samples_nest(spark):
    t = PL.prepare_training_table(clean_table(spark, SF), TEST_SALES)
    d = PL.nested_samples(t, [0.3, 0.6, 1.0]).collect()
    assert all((not r["in_0"]) or r["in_1"] for r in d)
    assert all(r["in_2"] for r in d)


def test_pipeline_fit_save_load_score(spark):
    t = PL.prepare_training_table(clean_table(spark, SF), TEST_SALES)
    ch = PL.Choice("DecisionTreeRegressor", {"ccp_alpha": 60.0}, selection="ANOVA", number=30)
    model = PL.refit(t, ch, TEST_SALES, rare_tol=0.04)
    path = tempfile.mkdtemp(prefix="pipe-")
    PL.save_pipeline_model(model, path)
    loaded = PL.load_pipeline_model(spark, path)
    p1 = [r["prediction"] for r in model.transform(t).orderBy("row_id").collect()]
    p2 = [r["prediction"] for r in loaded.transform(t).orderBy("row_id").collect()]
    assert np.allclose(p1, p2)


def test_linear_pipeline_runs(spark):
    t = PL.prepare_training_table(clean_table(spark, SF), TEST_SALES)
    ch = PL.Choice("Ridge", {"alpha": 1.0}, outlier="capped", scaling="Combine", selection="MutualInformation",
                   drop_correlated=True, number=5)
    res = PL.cross_validate(t, ch, TEST_SALES, folds=2, rare_tol=0.04)
    assert res["val_rmse"] > 0 and np.isfinite(res["val_rmse"])


def test_inner_folds_are_fitted_at_once(spark, monkeypatch):
    meet, fit = threading.Barrier(3), PL.fit_pipeline

    def together(*a):
        meet.wait(60)  # broken if one fold waits for another's end
        return fit(*a)
    monkeypatch.setattr(PL, "fit_pipeline", together)
    monkeypatch.setattr(PL, "build_pipeline", lambda *a: PL.Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"), DecisionTreeRegressor(labelCol="SP")]))
    df = spark.range(90).selectExpr("id AS row_id", "cast(id % 9 as double) AS x", "cast(id % 9 * 2 as double) AS SP")
    res = PL.cross_validate(df, PL.Choice("DecisionTreeRegressor", {}), PL.SALES, 3)
    assert len(res) == 6 and res["val_rmse"] == pytest.approx(0.0)
