"""Exact quantiles from brackets: only values near them are ordered."""

import numpy as np
import pytest

from pricelens.functions import ordered as O
from pricelens.plans import baselines as BL


@pytest.fixture
def ordered_rows(monkeypatch):
    """The number of rows of every table that is put in order."""
    seen, real = [], O.ordered_counts

    def spy(df, *a, **kw):
        seen.append(df.count())
        return real(df, *a, **kw)
    monkeypatch.setattr(O, "ordered_counts", spy)
    return seen


def _groups(spark):
    rng = np.random.default_rng(1)
    groups = {"normal": rng.normal(size=20000), "zeros": np.zeros(500), "one": np.array([1.0]), "two": np.array([1.0, 5.0]),
              "ties": rng.integers(0, 3, size=9000).astype(float), "half": np.concatenate([np.zeros(7000), rng.exponential(size=7001)])}
    rows = [(k, float(x)) for k, v in groups.items() for x in v] + [(k, None) for k in groups] + [("none", None)]
    return groups, spark.createDataFrame(rows, "k string, value double").repartition(5).cache()


@pytest.mark.parametrize("probs", [[0.5], [0.0, 0.001, 0.25, 0.75, 1.0]])
def test_bracketed_quantiles_are_exact_and_order_few_values(spark, ordered_rows, probs):
    groups, df = _groups(spark)
    got = {(r["k"], r["p"]): r["q"] for r in O.exact_quantiles(df, ["k"], "value", probs).collect()}
    assert set(got) == {(k, p) for k in groups for p in probs}
    for (k, p), q in got.items():
        assert q == pytest.approx(np.quantile(groups[k], p), rel=1e-12, abs=1e-12)
    assert len(ordered_rows) == 1 and ordered_rows[0] < 0.1 * sum(map(len, groups.values()))


def test_a_missed_bracket_orders_all_values(spark, ordered_rows, monkeypatch):
    groups, df = _groups(spark)
    monkeypatch.setattr(O, "BRACKET", 0.0)
    monkeypatch.setattr(O, "SKETCH", 3)
    got = {(r["k"], r["p"]): r["q"] for r in O.exact_quantiles(df, ["k"], "value", [0.25, 0.5]).collect()}
    for (k, p), q in got.items():
        assert q == pytest.approx(np.quantile(groups[k], p), rel=1e-12, abs=1e-12)
    assert len(ordered_rows) == 2


def test_best_per_metric_reads_the_averages_once(spark):
    rows = spark.createDataFrame([("b", 2.0, 1.0), ("a", 2.0, 3.0), ("c", 9.0, 0.5)], "model string, x double, y double")
    best = BL.best_per_metric(rows, "model", ["x", "y"])
    assert {tuple(r) for r in best.collect()} == {("x", "a", 2.0), ("y", "c", 0.5)}
    assert best._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") <= 1


def test_brackets_of_many_values(spark):
    """More values in the brackets than a range partitioning samples."""
    n = 600_011  # prime: every value comes once
    df = spark.range(n).selectExpr("'a' AS k", "cast(id * 7919 % 600011 AS double) AS value")
    df = df.union(df.selectExpr("'b'", "-2 * value")).repartition(8)
    got = {(r["k"], r["p"]): r["q"] for r in O.exact_quantiles(df, ["k"], "value", [0.25, 0.5, 0.75]).collect()}
    want = {(k, p): (p if k == "a" else 2 * (p - 1)) * (n - 1) for k in "ab" for p in (0.25, 0.5, 0.75)}
    assert got == pytest.approx(want, rel=1e-12)
