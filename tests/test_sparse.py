"""One-hot vectors against pandas, with many, unseen and missing categories."""

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from pricelens.operators.base import load_stage
from pricelens.operators.features import OneHotEncoder
from pricelens.operators.sparse import SparseOneHotEncoder

ROWS = [(1, "b", "x", 1.5), (2, "a", None, 0.0), (3, None, "y y", -2.0), (4, "é", "x", None), (5, "a", "x", float("nan")), (6, None, None, 4.0)]
SPEC = "id long, one string, `t wo` string, num double"


def _entries(rows):
    return {r["id"]: None if r["encoded"] is None else dict(zip(map(int, r["encoded"].indices), r["encoded"].values)) for r in rows}


def test_entries_unseen_and_missing(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SPEC)
    model = SparseOneHotEncoder(["one", "t wo"], ["num"]).fit(df)
    # num 0; one: a 1, b 2, é 3; t wo: x 4, y y 5
    assert model.size == 6
    want = {1: {0: 1.5, 2: 1, 4: 1}, 2: {0: 0, 1: 1}, 3: {0: -2, 5: 1}, 4: None, 5: None, 6: {0: 4}}
    assert _entries(model.transform(df).collect()) == want
    other = spark.createDataFrame([(1, "c", "x", 2.0)], SPEC)
    assert _entries(model.transform(other).collect()) == {1: {0: 2.0, 4: 1.0}}
    model.save(str(tmp_path / "m"))
    again = load_stage(spark, str(tmp_path / "m"))
    assert _entries(again.transform(df).collect()) == want
    assert {(r["feature"], r["category"]): r["coefficient"] for r in again.named(np.arange(6) * 10).collect()} == {
        ("num", None): 0, ("one", "a"): 10, ("one", "b"): 20, ("one", "é"): 30, ("t wo", "x"): 40, ("t wo", "y y"): 50}


def test_empty_and_no_category(spark):
    df = spark.createDataFrame([], SPEC)
    model = SparseOneHotEncoder(["one"], ["num"]).fit(df)
    assert model.size == 1 and model.transform(df).count() == 0
    assert _entries(model.transform(spark.createDataFrame(ROWS[:1], SPEC)).collect()) == {1: {0: 1.5}}


def test_equals_the_wide_form(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, str(rng.integers(30)), str(rng.integers(7)), 1.0) for i in range(500)], SPEC).repartition(6)
    wide = OneHotEncoder(["one", "t wo"]).fit(df)
    cols = [f"{k}_{v}" for k, vals in wide.categories.items() for v in vals]
    dense = {r["id"]: [r[x] for x in cols] for r in wide.transform(df).collect()}
    sparse = {r["id"]: r["encoded"].toArray().tolist() for r in SparseOneHotEncoder(["one", "t wo"]).fit(df).transform(df).collect()}
    assert sparse == dense


def test_200000_categories(spark):
    """A model over them, the schema as narrow as before and a third of the rows in one category."""
    n = 300_000
    df = spark.range(n, numPartitions=8).select(
        "id", F.when(F.col("id") < n // 3, F.lit("hot")).otherwise(F.concat(F.lit("c"), F.col("id"))).alias("one"),
        F.lit(None).cast("string").alias("t wo"), (F.col("id") % 10).cast("double").alias("num"))
    model = SparseOneHotEncoder(["one", "t wo"], ["num"]).fit(df)
    assert model.size == 1 + 1 + 2 * n // 3
    rows = model.transform(df).withColumn("y", 3 * F.col("num") + F.when(F.col("one") == "hot", 5.0).otherwise(0.0))
    assert len(rows.columns) == 6 and len(rows.schema["encoded"].metadata) == 0
    got = rows.select(F.unwrap_udt("encoded")["indices"].alias("ix")).agg(F.countDistinct("ix").alias("d"), F.sum(F.size("ix")).alias("s")).first()
    assert got["d"] == model.size - 1 and got["s"] == 2 * n
    fit = LinearRegression(featuresCol="encoded", labelCol="y", solver="l-bfgs", maxIter=3, regParam=1.0).fit(rows)
    named = model.named(fit.coefficients)
    assert named.count() == model.size
    assert named.where("feature = 'num'").first()["coefficient"] > 1
