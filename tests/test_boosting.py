"""Histogram boosting and weighted resampling against brute force."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from pricelens.plans import boosting as BO
from pricelens.plans import models as MD


def data(n=300, seed=2):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 12, n), rng.integers(0, 5, n), rng.normal(size=n).round(1)]).astype(float)
    return x, 3 * x[:, 0] + np.where(x[:, 1] > 2, 10, 0) * x[:, 2] + rng.normal(size=n)


def frame(spark, x, y):
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, SP double").repartition(4)
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).cache()


def slow(x, y, how):
    """One tree and the rest, by trying every split of every leaf on the raw values."""
    shrunk = lambda g: np.sign(g) * max(abs(g) - how["l1"], 0)
    worth = lambda g, n: shrunk(g) ** 2 / (n + how["l2"])
    pred = np.full(len(y), y.mean())
    for _ in range(how["rounds"]):
        g = pred - y
        leaves = [(np.arange(len(y)), 0)]

        def best(rows, depth):
            top = None
            if depth == how["max_depth"]:
                return None
            for f in range(x.shape[1]):
                for t in np.unique(x[rows, f])[:-1]:
                    left = x[rows, f] <= t
                    nl, nr = left.sum(), (~left).sum()
                    if min(nl, nr) < max(how["min_child_rows"], how["min_child_weight"]):
                        continue
                    gain = how["factor"] * (worth(g[rows][left].sum(), nl) + worth(g[rows][~left].sum(), nr) - worth(g[rows].sum(), len(rows)))
                    if gain > how["gamma"] and (top is None or gain > top[0] + 1e-9):
                        top = (gain, f, t)
            return top

        while how["max_leaves"] is None or len(leaves) < how["max_leaves"]:
            options = [(best(rows, d), k) for k, (rows, d) in enumerate(leaves)]
            options = [(b, k) for b, k in options if b is not None]
            if not options:
                break
            (_, f, t), k = max(options, key=lambda o: o[0][0])
            rows, d = leaves.pop(k)
            left = x[rows, f] <= t
            leaves += [(rows[left], d + 1), (rows[~left], d + 1)]
        for rows, _ in leaves:
            pred[rows] -= shrunk(g[rows].sum()) / (len(rows) + how["l2"]) * how["learning_rate"]
    return pred


BASE = dict(rounds=4, learning_rate=0.3, max_depth=3, max_leaves=None, l1=0.0, l2=0.0, gamma=0.0, factor=1.0, min_child_weight=0.0, min_child_rows=1)


@pytest.mark.parametrize("how", [{}, {"l2": 20.0}, {"l1": 30.0}, {"gamma": 150.0}, {"min_child_rows": 40}, {"min_child_weight": 55.5}, {"max_leaves": 5, "max_depth": 6}, {"factor": 0.5, "gamma": 100.0}])
def test_every_parameter_acts_as_in_a_brute_force_tree(spark, how):
    x, y = data()
    how = {**BASE, **how}
    df = frame(spark, x, y)
    model = BO.HistBooster(**how, bins=256).fit(df)
    got = {tuple(r[:4]): r["prediction"] for r in model.transform(df).select("a", "b", "c", "SP", "prediction").collect()}
    want = slow(x, y, how)
    assert all(got[(*xi, yi)] == pytest.approx(w, abs=1e-6) for xi, yi, w in zip(x, y, want))
    if how != BASE:
        assert not np.allclose(want, slow(x, y, BASE))


def test_rows_and_columns_are_drawn_and_reruns_agree(spark):
    x, y = data()
    df = frame(spark, x, y)
    how = dict(rounds=5, max_depth=3, subsample=0.6, subsample_every=2, columns=0.4)
    one, two = (BO.HistBooster(**how).fit(df) for _ in range(2))
    assert [vars(t) for t in one.trees] == [vars(t) for t in two.trees]
    assert {f for t in one.trees for f in t.feature if f >= 0} <= {0, 1, 2} and all(len({f for f in t.feature if f >= 0}) <= 1 for t in one.trees)
    assert 0.5 < BO._drawn(np.arange(20000), 0.6, 7).mean() < 0.7
    rows = BO._drawn(np.arange(100), 0.5, 3)
    assert (rows == BO._drawn(np.arange(100), 0.5, 3)).all() and (rows != BO._drawn(np.arange(100), 0.5, 4)).any()


def test_symmetric_trees_split_a_level_once(spark):
    x, y = data()
    df = frame(spark, x, y)
    calm = BO.HistBooster(rounds=3, max_depth=3, l2=3.0, symmetric=True).fit(df)
    for t in calm.trees:
        level = [0]
        while level:
            inner = [n for n in level if t.feature[n] >= 0]
            assert len({(t.feature[n], t.bin[n]) for n in inner}) <= 1
            level = [k for n in inner for k in (t.left[n], t.right[n])]
    # the first split is the one of the greatest sum over the root
    g = y.mean() - y
    gains = {(f, t): -g[x[:, f] <= t].sum() ** 2 / -((x[:, f] <= t).sum() + 3) + g[x[:, f] > t].sum() ** 2 / ((x[:, f] > t).sum() + 3) for f in range(3) for t in np.unique(x[:, f])[:-1]}
    f, t = max(gains, key=gains.get)
    assert (calm.trees[0].feature[0], calm.trees[0].threshold[0]) == (f, t)
    noisy = BO.HistBooster(rounds=3, max_depth=3, l2=3.0, symmetric=True, random_strength=1e6).fit(df)
    assert [t.feature for t in noisy.trees] != [t.feature for t in calm.trees]
    assert [t.value for t in BO.HistBooster(rounds=3, max_depth=3, l2=9.0, symmetric=True).fit(df).trees] != [t.value for t in calm.trees]


def test_odd_tables(spark, tmp_path):
    x, y = data(40)
    df = frame(spark, x, y)
    assert BO.HistBooster(rounds=2).fit(df.where("false")).trees == []
    flat = frame(spark, x * 0, y)
    model = BO.HistBooster(rounds=2).fit(flat)
    assert model.trees == [] and model.start == pytest.approx(y.mean())
    model = BO.HistBooster(rounds=3).fit(df)
    model.save(str(tmp_path / "m"))
    again = BO.HistBoosterModel.load(str(tmp_path / "m"))
    assert np.array_equal(again.predict(x), model.predict(x))
    assert np.isfinite(model.predict(np.array([[np.nan, 1, 2], [1e300, -1e300, 0]]))).all()


def test_copies_follow_the_weights(spark):
    rng = np.random.default_rng(0)
    w = rng.exponential(size=500)
    w[::7] = 0
    df = spark.createDataFrame([(int(i), float(v)) for i, v in enumerate(w)], "k long, _w double").repartition(6)
    from pricelens.session import cut_lineage
    df = cut_lineage(df.withColumn("_part", F.spark_partition_id()))
    total = float(w.sum())
    mean = np.zeros(500)
    for s in range(40):
        got = {r["k"]: r["_copies"] for r in MD.systematic_copies(df, total, 500, (s + 0.5) / 40).collect()}
        assert sum(got.values()) == 500
        copies = np.array([got[i] for i in range(500)])
        assert (np.abs(copies - w / total * 500) < 1 + 1e-9).all() and not copies[::7].any()
        mean += copies / 40
    assert np.allclose(mean, w / total * 500, atol=0.05)
    again = {r["k"]: r["_copies"] for r in MD.systematic_copies(df, total, 500, 39.5 / 40).collect()}
    assert again == got


def test_rows_are_held_in_blocks():
    import pyarrow as pa
    rng = np.random.default_rng(3)
    x = rng.normal(size=(50, 2))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(50)), pa.array(list(x)), pa.array(x[:, 0])], names=["row", "x", "y"])
    edges = [np.array([-0.5, 0.5]), np.array([0.0])]
    blocks = list(BO._binned(iter([batch, batch.slice(0, 7)]), edges, 0.5))
    assert [b.num_rows for b in blocks] == [1, 1]
    both = pa.Table.from_batches(blocks).combine_chunks().to_batches()[0]
    bins = BO._matrix(both, 2)
    assert bins.shape == (57, 2) and (bins[:50, 0] == np.searchsorted(edges[0], x[:, 0])).all()
    tree = BO.Tree()
    root = tree.add()
    tree.feature[root], tree.bin[root], tree.left[root], tree.right[root] = 1, 0, tree.add(), tree.add()
    tree.value[1:] = [1.0, 2.0]
    after, = BO._updated(iter([both]), 2, tree)
    assert [len(v.as_buffer()) // 8 for v in after.column("f")] == [50, 7]
    assert (BO._joined(after, "f", np.float64)[:50] == np.where(x[:, 1] <= 0, 1.5, 2.5)).all()
    sums, = BO._squares(iter([after]))
    f = BO._joined(after, "f", np.float64) - np.append(x[:, 0], x[:7, 0])
    assert sums.column("n")[0].as_py() == 57 and sums.column("s")[0].as_py() == pytest.approx(float(f @ f))


def test_a_level_is_one_job(spark):
    x, y = data()
    df = frame(spark, x, y)
    sc = spark.sparkContext
    sc.setJobGroup("boosted", "")
    model = BO.HistBooster(rounds=6, max_depth=2).fit(df)
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(model.trees) == 6
    assert len(sc.statusTracker().getJobIdsForGroup("boosted")) <= 6 * 2 + 8
