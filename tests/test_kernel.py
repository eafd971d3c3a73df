"""Kernel sums: every value counts, and a task holds a bounded number of them."""

import math

import numpy as np
import pyarrow as pa
import pytest

from pricelens.operators import profile as PR


def test_a_task_holds_a_bounded_number_of_values(monkeypatch):
    monkeypatch.setattr(PR, "KERNEL_HELD", 100)
    sizes, real = [], np.unique
    monkeypatch.setattr(np, "unique", lambda v, **kw: sizes.append(len(v)) or real(v, **kw))
    rng = np.random.default_rng(4)
    x, y = np.round(rng.normal(size=1000), 1), rng.normal(size=1000)
    batches = [pa.RecordBatch.from_pydict({"x0": x[i:i + 40], "x1": pa.array([None, *y[i + 1:i + 40]])}) for i in range(0, 1000, 40)]
    out = list(PR._kernel_sums(iter(batches), [(0.5, -2.0, 0.25), (0.3, -1.0, 0.2)], 17))
    kept = np.delete(y, np.arange(0, 1000, 40))
    for got, v, h, lo, step in zip(out, (x, kept), (0.5, 0.3), (-2.0, -1.0), (0.25, 0.2)):
        z = (lo + step * np.arange(17)[:, None] - v[None, :]) / h
        assert got.column("s").to_pylist() == pytest.approx(np.exp(-0.5 * z * z).sum(1).tolist(), rel=1e-12)
    assert max(sizes) <= 140 and sum(sizes) == 1000 + len(kept)


def test_the_values_are_not_shuffled(spark):
    df = spark.createDataFrame([(float(i % 13), math.nan if i % 2 else float(i), 7.0, None) for i in range(200)], "a double, `b c` double, same double, nothing double")
    d = PR.kernel_density(df, df.columns, 11)
    assert "hashpartitioning(column" not in d._jdf.queryExecution().executedPlan().toString()
    got = d.collect()
    assert {r["column"] for r in got} == {"a", "b c"} and len(got) == 22
    v = np.arange(0, 200, 2).astype(float)
    h, at = v.std(ddof=1) * len(v) ** -0.2, {r["point"]: r for r in got if r["column"] == "b c"}
    for k in range(11):
        p = v.min() + k * (v.max() - v.min()) / 10
        assert at[k]["x"] == pytest.approx(p) and at[k]["density"] == pytest.approx(np.exp(-0.5 * ((p - v) / h) ** 2).sum() / (len(v) * h * math.sqrt(2 * math.pi)))
