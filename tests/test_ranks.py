"""Rank correlations with heavy values and NULLs against pandas."""

import numpy as np
import pandas as pd
import pytest

from pricelens.operators import profile as PR


def test_heavy_values_nulls_and_ties(spark):
    rng = np.random.default_rng(1)
    n = 2000
    x = pd.DataFrame({"a": rng.normal(size=n), "b": np.round(rng.normal(size=n), 1), "hot": np.where(rng.random(n) < 0.4, 7.0, rng.normal(size=n)),
                      "one hot": (rng.random(n) < 0.3).astype(float), "flat": 3.0, "empty": np.nan})
    x["c"] = x["a"] + x["hot"] + rng.normal(size=n)
    x.loc[rng.random(n) < 0.4, "hot"] = np.nan
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x.to_numpy()], ", ".join(f"`{n}` double" for n in x)).repartition(5)
    got = {(r["col_a"], r["col_b"]): r["rho"] for r in PR.spearman_matrix(df, list(x)).collect()}
    ranks = x.rank()
    for a in x:
        for b in x:
            want = 1.0 if a == b else ranks[[a, b]].dropna().corr().iloc[0, 1]
            if a != b and (pd.isna(want) or {a, b} & {"flat", "empty"}):
                assert got[a, b] is None
            else:
                assert got[a, b] == pytest.approx(want, abs=1e-12)


def test_no_value_joined_by_shuffle_holds_more_than_a_partitions_share(spark, monkeypatch):
    n = 4000
    rows = [(float(7 if i % 10 < 4 else i), None if i % 10 >= 6 else float(i % 900)) for i in range(n)]
    df = spark.createDataFrame(rows, "a double, b double")
    seen = {}
    light = PR._light_values
    monkeypatch.setattr(PR, "_light_values", lambda batches, heavy, p: (seen.update(heavy), light(batches, heavy, p))[1])
    (_, _, _, both), distinct = PR.rank_moments(df, ["a", "b"], partitions=8)
    assert both[0, 1] == sum(r[1] is not None for r in rows) and distinct[1] == 540
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array([[a, np.nan if b is None else b] for a, b in rows], pa.list_(pa.float64()))], names=["row", "x"])
    joined = next(light(iter([batch]), {0: (np.array([7.0]), np.array([1.0]))}, 2)).to_pandas()
    assert joined.groupby(["place", "value"]).size().max() <= n / 8 and not joined["value"].isna().any()


def test_an_empty_table(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert {(r["col_a"], r["rho"]) for r in PR.spearman_matrix(df, ["a", "b"]).collect()} == {("a", 1.0), ("b", 1.0), ("a", None), ("b", None)}
