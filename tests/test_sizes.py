"""The registered queries run their operators at full size."""

import math

import pytest

from pricelens import catalog
from pricelens.operators import features as FE
from pricelens.operators import profile as PR
from pricelens.operators import selection as SE
from pricelens.plans import diagnose as DG
from pricelens.plans import explain as EX
from pricelens.plans import models as MD
from pricelens.plans import pipeline as PL

SF = "/root/testdata/sf0.001"


class Stop(Exception):
    pass


@pytest.fixture
def trials(monkeypatch, spark):
    """Inner CV replaced: the number of inner folds of every trial."""
    seen = []

    def cross_validate(train, ch, spec, folds=3, seed=0, rare_tol=0.0):
        seen.append(folds)
        return {f"{s}_{m}": float(len(seen)) for s in ("train", "val") for m in ("rmse", "mae", "median_ae")}

    class Model:
        def transform(self, df):
            return df

    monkeypatch.setattr(PL, "cross_validate", cross_validate)
    monkeypatch.setattr(PL, "refit", lambda *a: Model())
    monkeypatch.setattr(PL, "_metrics", lambda *a: {"rmse": 1.0, "mae": 1.0, "median_ae": 1.0})
    return seen


def test_search_and_nested_cv(spark, trials):
    assert catalog.hyperparameter_search(spark, SF).count() == 20 and trials == [3] * 20
    trials.clear()
    catalog.nested_cv_leaderboard(spark, SF)
    assert trials == [3] * (13 * 5 * 20)


def test_final_model(spark, trials, monkeypatch):
    def stop(*a):
        raise Stop
    monkeypatch.setattr(PL, "save_pipeline_model", stop)
    with pytest.raises(Stop):
        catalog.final_model_scoring(spark, SF)
    assert trials == [3] * 20


def _recorded(monkeypatch, owner, name):
    calls = []

    def record(*a, **kw):
        calls.append((a, kw))
        raise Stop
    monkeypatch.setattr(owner, name, record)
    return calls


def test_learning_curve(spark, monkeypatch):
    calls = _recorded(monkeypatch, DG, "learning_curve")
    with pytest.raises(Stop):
        catalog.learning_curve(spark, SF)
    args, kw = calls[0]
    assert len(args[2]) == 10 and args[2][0] == 0.3 and args[2][-1] == pytest.approx(1.0) and not kw


def test_trees_and_stages(spark, monkeypatch):
    calls = _recorded(monkeypatch, SE, "tree_importances")
    with pytest.raises(Stop):
        catalog.tree_importance(spark, SF)
    assert calls[0][1].get("trees", 100) == 100
    calls = _recorded(monkeypatch, EX, "model_trees")
    with pytest.raises(Stop):
        catalog.tree_shap(spark, SF)
    model = calls[0][0][1]
    assert model.getNumTrees == 50 and model.getMaxDepth() == 10
    made = []

    def fit(self, df):
        made.append(self.n_estimators)
        raise Stop
    monkeypatch.setattr(MD.AdaBoostR2, "fit", fit)
    with pytest.raises(Stop):
        catalog.adaboost_stage_shap(spark, SF)
    assert made == [50]


def test_one_hot_has_all_nominals_and_no_limit(spark):
    t = catalog.clean_table(spark, SF)
    want = {f"{n}_{r[0]}" for n in catalog.NOMINAL for r in t.select(n).distinct().collect()}
    assert want <= set(catalog.one_hot_nominals(spark, SF).columns)
    many = spark.range(1200).selectExpr("cast(id as string) AS c")
    assert len(FE.OneHotEncoder(["c"]).fit(many).categories["c"]) == 1200


def test_kernel_density_reaches_over_gaps(spark):
    xs = [0.0] * 5000 + [1.0] * 5 + [60.0]
    n, mean = len(xs), sum(xs) / len(xs)
    h = math.sqrt(sum((x - mean) ** 2 for x in xs) / (n - 1)) * n ** -0.2
    got = PR.kernel_density(spark.createDataFrame([(x,) for x in xs], "v double"), ["v"], grid=31).collect()
    assert len(got) == 31
    for r in got:
        want = sum(math.exp(-0.5 * ((r["x"] - x) / h) ** 2) for x in xs) / (n * h * math.sqrt(2 * math.pi))
        assert r["density"] == pytest.approx(want, rel=1e-9, abs=0)
