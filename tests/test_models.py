import itertools
import math
import os
import tempfile

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from pricelens.plans import explain as EX
from pricelens.plans import models as MD


def _brute_shapley(tree, x, M):
    """Exact path-dependent Shapley values by enumerating feature subsets."""
    def expect(node, S):
        if tree["left"][node] < 0:
            return tree["value"][node]
        f = tree["feature"][node]
        l, r = tree["left"][node], tree["right"][node]
        if f in S:
            return expect(l if x[f] <= tree["threshold"][node] else r, S)
        c = tree["cover"]
        return (c[l] * expect(l, S) + c[r] * expect(r, S)) / c[node]

    phi = np.zeros(M)
    for i in range(M):
        others = [j for j in range(M) if j != i]
        for k in range(len(others) + 1):
            for S in itertools.combinations(others, k):
                w = math.factorial(k) * math.factorial(M - k - 1) / math.factorial(M)
                phi[i] += w * (expect(0, set(S) | {i}) - expect(0, set(S)))
    return phi


def test_tree_shap_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    X = rng.normal(size=(400, 3))
    y = 3 * (X[:, 0] > 0) + 2 * X[:, 1] * (X[:, 2] > 0.5) + rng.normal(scale=0.1, size=400)
    df = spark.createDataFrame([(float(a), float(b), float(c), float(t)) for (a, b, c), t in zip(X, y)],
                               "a double, b double, c double, y double")
    d = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    model = DecisionTreeRegressor(labelCol="y", maxDepth=3).fit(d)
    trees = EX.model_trees(spark, model)
    out = EX.tree_shap(model.transform(d), trees, keep=["a", "b", "c", "prediction"]).collect()
    t = trees[0][1]
    for r in out[:25]:
        x = [r["a"], r["b"], r["c"]]
        assert np.allclose(r["phi"], _brute_shapley(t, x, 3), atol=1e-9)
        assert r["base"] + sum(r["phi"]) == pytest.approx(r["prediction"], rel=1e-9, abs=1e-9)


def test_ridge_penalty_conversion(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(60, 2))
    y = X @ np.array([2.0, -1.0]) + 0.5 + rng.normal(scale=0.3, size=60)
    alpha = 5.0
    Xc, yc = X - X.mean(0), y - y.mean()
    beta = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(2), Xc.T @ yc)
    df = spark.createDataFrame([(float(a), float(b), float(t)) for (a, b), t in zip(X, y)], "a double, b double, SP double")
    d = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    m = MD.LinearFamily("Ridge", {"alpha": alpha}).fit(d)
    assert np.allclose(m.coefficients.toArray(), beta, atol=1e-6)


def test_adaboost_weighted_median(spark):
    rng = np.random.default_rng(9)
    X = rng.uniform(size=(300, 2))
    y = 10 * X[:, 0] + rng.normal(scale=0.2, size=300)
    df = spark.createDataFrame([(float(a), float(b), float(t)) for (a, b), t in zip(X, y)], "a double, b double, SP double")
    d = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    m = MD.AdaBoostR2(0.5, "square", n_estimators=4).fit(d)
    out = m.transform(d).collect()
    preds = np.array([[t.transform(d).collect()[i]["prediction"] for t in m.trees] for i in range(3)])
    for i in range(3):
        order = np.argsort(preds[i])
        cdf = np.cumsum(np.array(m.weights)[order])
        med = preds[i][order][np.argmax(cdf >= 0.5 * cdf[-1])]
        assert out[i]["prediction"] == pytest.approx(med)
    path = tempfile.mkdtemp(prefix="ada-")
    m.save(os.path.join(path, "m"))
    again = MD.AdaBoostR2Model.load(os.path.join(path, "m"))
    assert [r["prediction"] for r in again.transform(d).collect()[:5]] == [r["prediction"] for r in out[:5]]


def test_search_space_draws_are_in_range():
    import random
    rng = random.Random(1)
    for fam in MD.FAMILIES:
        for _ in range(20):
            p = MD.sample_model_params(fam, rng)
            if "alpha" in p:
                low, high = (0.1, 100) if fam == "XGBRegressor" else (1e-6, 2)
                assert low <= p["alpha"] <= high
            if "learning_rate" in p:
                assert 0.01 <= p["learning_rate"] <= 1


def test_huber_matches_its_objective(spark):
    import numpy as np
    from pyspark.ml.feature import VectorAssembler

    from pricelens.plans.models import LinearFamily
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 2))
    y = 3 * x[:, 0] - 2 * x[:, 1] + 1 + rng.normal(scale=0.3, size=300)
    y[:20] += 15
    alpha, eps = 30.0, 1.35
    df = spark.createDataFrame([(float(a), float(b), float(t)) for (a, b), t in zip(x, y)], "a double, b double, SP double")
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    m = LinearFamily("HuberRegressor", {"alpha": alpha, "epsilon": eps}).fit(df)

    def objective(w, c, s):
        r = np.abs(y - x @ w - c) / s
        return float((s + s * np.where(r < eps, r * r, 2 * eps * r - eps * eps)).sum() + alpha * (w @ w))

    w, c, s = np.array(m.coefficients.toArray()), m.intercept, m.scale
    here = objective(w, c, s)
    for step in (1e-2, 3e-2):
        for k in range(2):
            for sign in (-1, 1):
                e = np.zeros(2)
                e[k] = sign * step
                assert objective(w + e, c, s) > here - 1e-6


def test_cooks_distance_at_leverage_one(spark):
    from pricelens.plans.diagnose import cooks_distance
    rows = [(1.0, 0.0, 2.0), (2.0, 0.0, 3.9), (3.0, 0.0, 6.1), (4.0, 0.0, 8.2), (0.0, 5.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    out = {r["b"]: r for r in cooks_distance(df, ["a", "b"], "y").collect() if r["b"] > 0}
    assert out[5.0]["leverage"] > 1 - 1e-9 and out[5.0]["influential"] in (True, False)


def test_linear_tree_shap_on_deep_trees_with_repeated_features():
    """Trees of depth 7 over 4 features, rows alike in all outcomes among them."""
    from pricelens.plans import explain as EX
    rng = np.random.default_rng(0)
    data = np.round(rng.normal(size=(600, 4)), 1)

    def grown(rows, depth, t):
        node = len(t["left"])
        for k, v in (("left", -1), ("right", -1), ("feature", -1), ("threshold", 0.0), ("value", rng.normal()), ("cover", float(len(rows)))):
            t[k].append(v)
        f = int(rng.integers(4))
        cut = np.median(data[rows, f]) if depth < 7 else np.inf
        left = data[rows, f] <= cut
        if depth < 7 and left.any() and not left.all():
            t["feature"][node], t["threshold"][node] = f, cut
            t["left"][node] = grown(rows[left], depth + 1, t)
            t["right"][node] = grown(rows[~left], depth + 1, t)
        return node

    for _ in range(3):
        t = {k: [] for k in ("left", "right", "feature", "threshold", "value", "cover")}
        grown(np.arange(600), 0, t)
        t = {k: np.array(v) for k, v in t.items()}
        phi = np.zeros((12, 4))
        rows = np.vstack([data[:10], data[:2]])
        EX.tree_shap_batch(rows, t, phi, 0.5)
        for x, p in zip(rows, phi):
            assert np.allclose(p, 0.5 * np.array(_brute_shapley(t, x, 4)), atol=1e-9)


def test_adaboost_stage_reads_its_copies_from_one_kept_table(spark, monkeypatch):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(float(a), float(b), float(5 * a + b)) for a, b in rng.uniform(size=(200, 2))], "a double, b double, SP double")
    plans, fit = [], MD.DecisionTreeRegressor.fit

    def seen(self, data):
        plans.append(data._jdf.queryExecution().executedPlan().toString())
        return fit(self, data)
    monkeypatch.setattr(MD.DecisionTreeRegressor, "fit", seen)
    MD.AdaBoostR2(0.5, "linear", n_estimators=3).fit(VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df))
    for plan in plans:  # the Python step lies below the kept table, so the tree's passes don't repeat it
        assert "MapInArrow" not in plan and plan.index("InMemoryRelation") < plan.index("ArrowEvalPython")


def test_deep_tree_keeps_nodes_beside_rows_and_is_the_same(spark):
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(float(a), float(b), float(np.sin(9 * a) + b)) for a, b in rng.uniform(size=(500, 2))], "a double, b double, SP double")
    d = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    tree = MD.make_regressor("DecisionTreeRegressor", {"ccp_alpha": 0.0})
    assert tree.getCacheNodeIds()
    plain = DecisionTreeRegressor(labelCol="SP", maxDepth=MD.MAX_DEPTH, seed=MD.SEED).fit(d)
    assert tree.fit(d).toDebugString.split("\n")[1:] == plain.toDebugString.split("\n")[1:]


def _grown_tree(rng, features, depth, rows=400):
    """A tree on random values, with repeated features and thresholds, and the values."""
    data = np.round(rng.normal(size=(rows, features)), 1)
    t = {k: [] for k in ("left", "right", "feature", "threshold", "value", "cover")}

    def grown(own, level):
        node = len(t["left"])
        for k, v in (("left", -1), ("right", -1), ("feature", -1), ("threshold", 0.0), ("value", rng.normal()), ("cover", float(len(own)))):
            t[k].append(v)
        f = int(rng.integers(features))
        cut = rng.choice(data[own, f])
        left = data[own, f] <= cut
        if level and not left.all():
            t["feature"][node], t["threshold"][node] = f, cut
            t["left"][node], t["right"][node] = grown(own[left], level - 1), grown(own[~left], level - 1)
        return node

    grown(np.arange(rows), depth)
    return {k: np.array(v) for k, v in t.items()}, data


@pytest.mark.parametrize("features,depth,states", [(4, 7, 512), (7, 9, 512), (7, 9, 128), (3, 3, 512), (8, 10, 64)])
def test_leaf_tables_give_what_the_walk_gives(monkeypatch, features, depth, states):
    from pricelens.plans import explain as EX
    monkeypatch.setattr(EX, "STATES", states)
    rng = np.random.default_rng(features * depth)
    t, data = _grown_tree(rng, features, depth)
    rows = np.vstack([data[:60], rng.normal(size=(40, features)) * 2, np.full((1, features), np.nan)])
    walked, read = np.zeros_like(rows), np.zeros_like(rows)
    EX.tree_shap_batch(rows, t, walked, 0.5)
    EX.leaf_tables(t).add(rows, read, 0.5)
    assert np.allclose(read, walked, atol=1e-10) and np.abs(walked).max() > 0.01


def test_trees_of_one_leaf_or_wide_paths_have_no_tables(spark, monkeypatch):
    from pricelens.plans import explain as EX
    rng = np.random.default_rng(5)
    t, data = _grown_tree(rng, 4, 6)
    lone = {k: v[:1] * 0 - (k in ("left", "right", "feature")) for k, v in t.items()}
    assert EX.leaf_tables(lone) is None
    rows = [(i, Vectors.dense(x)) for i, x in enumerate(data[:50])]
    df = spark.createDataFrame(rows, ["n", "features"])
    trees = [(0.5, t), (0.5, lone)]
    monkeypatch.setattr(EX, "EXPLAINED", 7)
    read = {r["n"]: r["phi"] for r in EX.tree_shap(df, trees, keep=["n"]).collect()}
    want = np.zeros((50, 4))
    EX.tree_shap_batch(data[:50], t, want, 0.5)
    assert len(read) == 50 and all(np.allclose(read[i], want[i], atol=1e-10) for i in range(50))
