import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pricelens.functions import normal as NO
from pricelens.functions import stats as ST
from pricelens.functions.ordered import average_rank_table, exact_quantiles, ordered_counts


def _ad_reference(x):
    """Anderson-Darling A² for normality, plain Python (sample std)."""
    x = sorted(x)
    n = len(x)
    m = sum(x) / n
    s = math.sqrt(sum((v - m) ** 2 for v in x) / (n - 1))
    cdf = [0.5 * math.erfc(-(v - m) / s / math.sqrt(2)) for v in x]
    tot = sum((2 * i + 1) * (math.log(cdf[i]) + math.log(1 - cdf[n - 1 - i])) for i in range(n))
    return -n - tot / n


def test_normal_functions(spark):
    zs = [-9.0, -3.0, -1.0, 0.0, 0.5, 2.0, 7.0]
    ps = [1e-9, 0.001, 0.02, 0.3, 0.5, 0.9, 0.99, 0.999999]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    got = df.select(NO.log_ndtr(F.col("z")).alias("l")).collect()
    for z, r in zip(zs, got):
        exact = math.log(0.5 * math.erfc(-z / math.sqrt(2)))
        assert abs(r["l"] - exact) <= 1e-6 * max(1.0, abs(exact))
    dp = spark.createDataFrame([(p,) for p in ps], "p double").select(NO.ndtri(F.col("p")).alias("z")).collect()
    from statistics import NormalDist
    for p, r in zip(ps, dp):
        assert abs(r["z"] - NormalDist().inv_cdf(p)) < 1e-7 * max(1, abs(r["z"]))


@pytest.mark.parametrize("dist", ["normal", "exponential"])
def test_anderson_darling(spark, dist):
    rng = random.Random(1)
    x = [rng.gauss(10, 2) if dist == "normal" else rng.expovariate(1.0) for _ in range(500)]
    df = spark.createDataFrame([("c", v) for v in x] + [("t", v) for v in x + x[:20]],
                               "column string, value double")
    res = ST.anderson_darling(df)
    assert abs(res["c"][0] - _ad_reference(x)) < 1e-4
    assert abs(res["t"][0] - _ad_reference(x + x[:20])) < 1e-4  # with ties
    assert ST.is_gaussian(*res["c"]) == (dist == "normal")


def test_quantiles_and_ranks_match_numpy(spark):
    rng = np.random.default_rng(3)
    g = rng.integers(0, 3, 2000)
    v = np.round(rng.normal(size=2000), 1)  # many ties
    pdf = pd.DataFrame({"g": g.astype(int), "value": v})
    df = spark.createDataFrame(pdf)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    q = {(r["g"], r["p"]): r["q"] for r in exact_quantiles(df, ["g"], "value", probs, partitions=5).collect()}
    for k in range(3):
        ref = np.percentile(v[g == k], [p * 100 for p in probs])
        for p, rv in zip(probs, ref):
            assert abs(q[(k, p)] - rv) < 1e-9
    oc = ordered_counts(df, ["g"], "value", partitions=7)
    ranks = {(r["g"], r["value"]): r["rank"] for r in average_rank_table(oc, ["g"], "value").collect()}
    for k in range(3):
        sub = pdf[pdf.g == k]
        pr = sub["value"].rank(method="average")
        for val, rk in zip(sub["value"], pr):
            assert ranks[(k, val)] == pytest.approx(rk)
    q2 = {(r["g"], r["p"]): r["q"] for r in exact_quantiles(
        df, ["g"], "value", probs, ordered=ordered_counts(df, ["g"], "value", partitions=5)).collect()}
    assert all(abs(q2[k] - q[k]) < 1e-12 for k in q)


def test_grid_quantiles(spark):
    rng = np.random.default_rng(5)
    v = np.round(rng.exponential(size=3000), 2)
    df = spark.createDataFrame([("c", float(x)) for x in v], "column string, value double")
    oc = ordered_counts(df, ["column"], "value", partitions=6)
    got = sorted((r["j"], r["q"]) for r in ST.grid_quantiles(oc, ["column"], 1000).collect())
    ref = np.percentile(v, np.linspace(0, 100, 1000))
    assert len(got) == 1000
    assert max(abs(a[1] - b) for a, b in zip(got, ref)) < 1e-9
    small = spark.createDataFrame([("c", 4.0), ("c", 1.0), ("c", 1.0)], "column string, value double")
    got = sorted(r["q"] for r in ST.grid_quantiles(ordered_counts(small, ["column"], "value"), ["column"]).collect())
    assert got == [1.0, 1.0, 4.0]


def test_skewness_bias_corrected(spark):
    from pricelens.operators.profile import skewness
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 4, 7.5, 20]], "x double")
    assert skewness(df, ["x"]).first()["skewness"] == pytest.approx(1.71275, abs=1e-5)


def test_yeo_johnson_lambda(spark):
    rng = np.random.default_rng(11)
    x = rng.lognormal(1.0, 0.6, 3000)

    def yj(v, lam):
        return ((v + 1) ** lam - 1) / lam if abs(lam) > 1e-12 else np.log1p(v)

    def llf(lam):
        y = yj(x, lam)
        return -len(x) / 2 * np.log(y.var()) + (lam - 1) * np.sum(np.sign(x) * np.log1p(np.abs(x)))

    grid = np.linspace(-3, 3, 60001)
    best = grid[np.argmax([llf(l) for l in grid])]
    df = spark.createDataFrame([("c", float(v)) for v in x], "column string, value double")
    counts = df.groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))
    lam = ST.yeo_johnson_lambda(counts)["c"]
    assert abs(lam - best) < 2e-3


def test_yeo_johnson_lambda_beyond_the_first_grid(spark):
    rng = np.random.default_rng(3)
    x = 10.0 - rng.exponential(0.5, 2000)  # its best lambda lies far above 3
    x = x[x > 0]
    grid = np.linspace(0.0, 40.0, 40001)
    slog = np.log1p(x).sum()
    best = grid[np.argmax([-len(x) / 2 * np.log((((x + 1) ** lam - 1) / lam if lam else np.log1p(x)).var()) + (lam - 1) * slog for lam in grid])]
    assert best > 3.5
    df = spark.createDataFrame([("c", float(v)) for v in x], "column string, value double")
    lam = ST.yeo_johnson_lambda(df.groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt")))["c"]
    assert abs(lam - best) < 2e-2


def test_ordered_counts_has_no_single_task_over_the_rows(spark):
    df = spark.range(5000).select(F.lit("k").alias("g"), (F.col("id") % 700).cast("double").alias("value"))
    oc = ordered_counts(df, [], "value", partitions=6)
    rows = oc.collect()
    assert len(rows) == 700 and all(r["total"] == 5000 for r in rows)
    plan = oc._jdf.queryExecution().executedPlan().toString()
    # the one window without keys is over a row for each range partition
    for part in plan.split("SinglePartition")[1:]:
        assert "_ptot" in part


def test_column_moments(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    x, y = rng.normal(1e6, 1.0, 3000), rng.normal(size=3000)
    rows = [(float(a), 0.1, None if i % 3 else float(a + b), math.nan if i % 5 == 0 else float(b), float(b)) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "a double, same double, part double, nan double, y double").repartition(7)
    df = df.withColumn("nothing", F.lit(None).cast("double")).withColumn("i", F.lit(2))
    cols = ["a", "same", "part", "nan", "nothing", "i", "y"]
    got = dict(zip(cols, ST.column_moments(df, [F.col(n) for n in cols], "nan")))
    assert got["a"]["mean"] == pytest.approx(x.mean(), rel=1e-14) and got["a"]["sd"] == pytest.approx(x.std(), rel=1e-9)
    assert got["a"]["r"] == pytest.approx(np.corrcoef(x, y)[0, 1], rel=1e-8) and got["y"]["r"] == pytest.approx(1.0)
    assert got["same"]["sd"] == 0.0 and got["i"]["sd"] == 0.0 and got["nothing"]["mean"] is None
    third, kept = np.arange(3000) % 3 == 0, np.arange(3000) % 5 != 0
    assert got["part"]["n"] == 1000 and got["part"]["rows"] == 3000
    assert got["part"]["r"] == pytest.approx(np.corrcoef((x + y)[third], y[third])[0, 1], rel=1e-8)
    assert got["nan"]["n"] == kept.sum() and got["nan"]["sd"] == pytest.approx(y[kept].std())
    assert math.isnan(ST.column_moments(df, [F.col("nan")])[0]["mean"])
    assert ST.column_moments(df, [F.col("nan")], "nonfinite", spread=False)[0]["mean"] == pytest.approx(y[kept].mean())
