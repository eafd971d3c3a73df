import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.operators import features as FE


def test_target_encoding_values(spark):
    df = spark.createDataFrame(list(zip("aabba", [1.0, 5.0, 2.0, 9.0, 11.0])), "c string, y double")
    m = FE.TargetEncoder(["c"], "y", drop_invariant=False).fit(df)
    out = m.transform(df).select("c").distinct().collect()
    vals = sorted(round(r["c"], 4) for r in out)
    assert vals == [5.5333, 5.65]
    unseen = spark.createDataFrame([("z", 0.0)], "c string, y double")
    assert m.transform(unseen).first()["c"] == pytest.approx(28 / 5)


def test_group_stats_single_row_and_unseen(spark):
    df = spark.createDataFrame([("A", "X", 1.0), ("A", "Y", 3.0), ("B", "X", 5.0)], "Brand string, MC string, v double")
    m = FE.GroupStatFeatures(["v"], groups=(("Brand", "Brand"),)).fit(df)
    rows = {r["Brand"]: r for r in m.transform(df.union(spark.createDataFrame([("C", "X", 0.0)], df.schema))).collect()}
    assert rows["A"]["v_mean_Brand"] == 2.0 and rows["A"]["v_median_Brand"] == 2.0
    assert rows["B"]["v_std_Brand"] is None
    assert rows["C"]["v_mean_Brand"] is None
    assert rows["A"]["Brand_MC_nunique"] == 2


def test_rare_labels_both_branches(spark):
    rows = []
    for i in range(12):
        rows += [(f"c{i}", "k%d" % (i % 4))] * (2 if i < 2 else 10)
    df = spark.createDataFrame(rows, "a string, b string")
    m = FE.RareLabelEncoder(["a", "b"], tol=0.05).fit(df)
    out = m.transform(df.union(spark.createDataFrame([("new", "k9")], df.schema)))
    a_vals = {r["a"] for r in out.select("a").distinct().collect()}
    assert "c0" not in a_vals and "Rare" in a_vals and "c5" in a_vals
    b_vals = {r["b"] for r in out.select("b").distinct().collect()}
    assert b_vals == {"k0", "k1", "k2", "k3", "Rare"}


def test_scalers(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (10.0, 5.0)], "x double, k double")
    st = FE.Scaler("standard").fit(df).transform(df).collect()
    mean, sd = 4.0, math.sqrt(((1 - 4) ** 2 + 4 + 1 + 36) / 4)
    assert st[0]["x"] == pytest.approx((1 - mean) / sd) and st[0]["k"] == 0.0
    mm = FE.Scaler("minmax").fit(df).transform(df).collect()
    assert [r["x"] for r in mm] == pytest.approx([0, 1 / 9, 2 / 9, 1]) and mm[0]["k"] == 0.0
    rb = FE.Scaler("robust").fit(df).transform(df).collect()
    # median 2.5, q1 1.75, q3 4.75
    assert rb[0]["x"] == pytest.approx((1 - 2.5) / 3.0)


def test_outlier_cap_iqr(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]], "x double")
    m = FE.OutlierCapper(["x"], method="iqr").fit(df)
    assert max(r["x"] for r in m.transform(df).collect()) == pytest.approx(4 + 1.5 * 2)


def test_cyclical_and_onehot(spark):
    df = spark.createDataFrame([(3, "a"), (6, "b"), (12, "a")], "m int, c string")
    cy = FE.CyclicalEncoder(["m"]).fit(df).transform(df).collect()
    assert cy[1]["m_sin"] == pytest.approx(0.0, abs=1e-12) and cy[1]["m_cos"] == pytest.approx(-1.0)
    oh = FE.OneHotEncoder(["c"]).fit(df)
    out = oh.transform(spark.createDataFrame([(1, "a"), (1, "zz")], df.schema)).collect()
    assert (out[0]["c_a"], out[0]["c_b"], out[1]["c_a"], out[1]["c_b"]) == (1, 0, 0, 0)


def test_gaussian_transformer_makes_lognormal_gaussian(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(float(v),) for v in rng.lognormal(0, 1, 800)], "x double")
    m = FE.GaussianTransformer(["x"]).fit(df)
    assert m.chosen.get("x") in FE.TRANSFORMS
    g, non, _ = FE.gaussian_split(m.transform(df), ["x"])
    assert g == ["x"]


def test_quantile_normal_matches_numpy(spark):
    import numpy as np
    from statistics import NormalDist
    rng = np.random.default_rng(2)
    v = np.round(rng.gamma(2.0, size=1500), 3)
    df = spark.createDataFrame([(float(x),) for x in v], "x double")
    out = np.array([r["x"] for r in FE.quantile_normal_model(df, ["x"]).transform(df).collect()])
    q = np.percentile(v, np.linspace(0, 100, 1000))
    ref = np.linspace(0, 1, 1000)
    r = 0.5 * (np.interp(v, q, ref) - np.interp(-v, -q[::-1], -ref[::-1]))
    r = np.where(v + 1e-7 > q[-1], 1.0, r)
    r = np.where(v - 1e-7 < q[0], 0.0, r)
    lo = NormalDist().inv_cdf(1e-7 - np.spacing(1))
    z = np.array([NormalDist().inv_cdf(p) if 0 < p < 1 else (lo if p <= 0 else -lo) for p in r])
    z = np.clip(z, lo, -lo)
    assert np.max(np.abs(out - z)) < 1e-6


@pytest.mark.parametrize("method", ["standard", "minmax", "robust", "combine"])
def test_scalers_pass_empty_columns_through(spark, method):
    df = spark.createDataFrame([(float(i % 7), None) for i in range(40)], "x double, nothing double")
    rows = FE.Scaler(method, columns=["x", "nothing"]).fit(df).transform(df).collect()
    assert all(r["nothing"] is None for r in rows) and len({r["x"] for r in rows}) == 7


def test_normal_quantiles():
    import statistics
    import numpy as np
    from pricelens.functions.normal import ndtri_array
    p = np.array([1e-300, 1e-12, 0.01, 0.07, 0.075, 0.3, 0.5, 0.9, 0.93, 0.999999])
    assert np.allclose(ndtri_array(p), [statistics.NormalDist().inv_cdf(v) for v in p], rtol=1e-12)


def _sorted_statistic(v):
    """A² of values put in order by themselves."""
    log_ndtr = np.vectorize(lambda z: math.log(0.5 * math.erfc(-z / math.sqrt(2))))
    w = (np.sort(v) - v.mean()) / v.std(ddof=1)
    i = np.arange(1, len(v) + 1)
    return -len(v) - np.mean((2 * i - 1) * log_ndtr(w) + (2 * len(v) + 1 - 2 * i) * log_ndtr(-w))


@pytest.mark.parametrize("signs", ["positive", "negative", "both", "nonpositive", "nonnegative"])
def test_candidates_are_tested_on_the_order_of_the_raw_values(spark, monkeypatch, signs):
    """One table is put in order (two, if squares of both signs cross), and every
    candidate's statistic is that of its own sorted values."""
    rng = np.random.default_rng(5)
    v = np.round(rng.lognormal(0, 0.6, 400), 2) + 0.01
    v = {"positive": v, "negative": -v, "both": np.where(rng.random(400) < 0.5, v, -v),
         "nonpositive": np.append(-v, [0.0, 0.0]), "nonnegative": np.append(v, [0.0, 0.0])}[signs]
    ordered, tested, count, test = [], {}, FE.ordered_counts, FE.anderson_from_ordered
    monkeypatch.setattr(FE, "ordered_counts", lambda *a, **kw: ordered.append(a) or count(*a, **kw))

    def spy(oc, keys, *a):
        rows = test(oc, keys, *a)
        tested.update({r["transform"]: r for r in rows.collect()} if "transform" in keys else {})
        return rows
    monkeypatch.setattr(FE, "anderson_from_ordered", spy)
    FE.GaussianTransformer(["x"]).fit(spark.createDataFrame([(float(x),) for x in v], "x double"))
    assert len(ordered) == (2 if signs == "both" else 1)
    if signs in ("positive", "negative", "both"):
        assert tested["reciprocal"]["statistic"] == pytest.approx(_sorted_statistic(1 / v), rel=1e-6)
    assert tested["square"]["statistic"] == pytest.approx(_sorted_statistic(v * v), rel=1e-6)
    if signs == "positive":
        assert tested["logarithmic"]["statistic"] == pytest.approx(_sorted_statistic(np.log(v)), rel=1e-6)
    else:
        assert "logarithmic" not in tested or tested["logarithmic"]["counted"] < len(v)


def test_mutual_information_counts_once(spark):
    from pricelens.operators import selection as SE
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.normal(size=400), rng.integers(0, 3, 400), np.full(400, 2.0)])
    y = x[:, 0] + x[:, 1]
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, SP double")
    found = SE.mutual_information(df, ["a", "b", "c"], "SP")
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()  # the rows aren't read again for the margins
    got = {r["feature"]: r["mi"] for r in found.collect()}

    def bins(v):
        return np.minimum((v - v.min()) / (np.ptp(v) or 1) * 10, 9).astype(int)
    for i, f in enumerate("abc"):
        p = np.histogram2d(bins(x[:, i]), bins(y), bins=[np.arange(11), np.arange(11)])[0] / 400
        q = p.sum(1, keepdims=True) * p.sum(0, keepdims=True)
        assert got[f] == pytest.approx((p[p > 0] * np.log(p[p > 0] / q[p > 0])).sum(), abs=1e-9)
