"""Ordered target statistics against a loop over the rows in their order."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.operators.base import load_stage
from pricelens.operators.ordered_target import OrderedTargetEncoder, running_sums

SPEC = "row_id long, one string, `t wo` string, y double"


def _rows(n=400, seed=4):
    rng = np.random.default_rng(seed)
    hot = rng.random(n)
    return [(i, None if hot[i] < 0.1 else "hot" if hot[i] < 0.5 else str(rng.integers(12)), "" if i % 3 else None,
             None if i % 17 == 0 else float(rng.normal())) for i in range(n)]


def brute(rows, at, seed=42, a=1.0):
    prior = np.mean([r[3] for r in rows if r[3] is not None])
    sums, out = {}, {}
    for r in sorted(rows, key=lambda r: hashlib.md5(f"{seed}|{r[0]}".encode()).hexdigest()):
        s, n = sums.get(r[at], (0.0, 0))
        out[r[0]] = (s + a * prior) / (n + a)
        if r[3] is not None:
            sums[r[at]] = (s + r[3], n + 1)
    return out, sums, prior


@pytest.mark.parametrize("parts", [1, 9])
def test_training_equals_a_loop(spark, parts):
    rows = _rows()
    df = spark.createDataFrame(rows, SPEC).repartition(parts)
    model = OrderedTargetEncoder(["one", "t wo"], "y").fit(df)
    got = {r["row_id"]: r for r in model.training(df).collect()}
    assert len(got) == len(rows) and list(got[0].asDict()) == ["row_id", "one", "t wo", "y"]
    for at, name in ((1, "one"), (2, "t wo")):
        want, _, _ = brute(rows, at)
        assert all(got[i][name] == pytest.approx(want[i], abs=1e-12) for i in want)
    assert all(got[r[0]]["y"] == r[3] for r in rows)


def test_scoring_uses_all_rows(spark, tmp_path):
    rows = _rows()
    model = OrderedTargetEncoder(["one", "t wo"], "y", a=2.0).fit(spark.createDataFrame(rows, SPEC))
    model.save(str(tmp_path / "m"))
    new = spark.createDataFrame([(0, "hot", None, None), (1, None, "", None), (2, "unseen", "unseen", None)], SPEC)
    got = {r["row_id"]: r for r in load_stage(spark, str(tmp_path / "m")).transform(new).collect()}
    for at, name in ((1, "one"), (2, "t wo")):
        _, sums, prior = brute(rows, at)
        for i, v in ((0, ("hot", None)), (1, (None, "")), (2, ("unseen", "unseen"))):
            s, n = sums.get(v[at - 1], (0.0, 0))
            assert got[i][name] == pytest.approx((s + 2 * prior) / (n + 2))


def test_own_and_later_labels_do_not_show(spark):
    rows = _rows(200)
    last = max(range(200), key=lambda i: hashlib.md5(f"42|{i}".encode()).hexdigest())
    other = [r if r[0] != last else (*r[:3], 1e6) for r in rows]
    a, b = (OrderedTargetEncoder(["one"], "y").fit(spark.createDataFrame(rows, SPEC)) for _ in range(2))
    b.prior = a.prior
    x, y = ({r["row_id"]: r["one"] for r in m.training(spark.createDataFrame(t, SPEC)).collect()} for m, t in ((a, rows), (b, other)))
    assert x == y


def test_repeated_rows_empty_table_and_no_label(spark):
    twice = spark.createDataFrame([(1, "a", "b", 1.0)] * 3, SPEC)
    got = sorted(r["one"] for r in OrderedTargetEncoder(["one"], "y").fit(twice).training(twice).collect())
    assert got == [1.0, 1.0, 1.0]
    none = spark.createDataFrame([], SPEC)
    model = OrderedTargetEncoder(["one"], "y").fit(none)
    assert model.training(none).count() == 0 and model.transform(twice).first()["one"] is None
    blank = spark.createDataFrame([(1, "a", "b", None)], SPEC)
    assert OrderedTargetEncoder(["one"], "y").fit(blank).training(blank).first()["one"] is None


def test_a_hot_key_spreads_over_the_slices(spark):
    df = spark.range(4000).select(F.lit("hot").alias("k"), "id", F.lit(1.0).alias("v"))
    sums = running_sums(df, ["k"], ["id"], ["v"], partitions=8)
    assert sums.where("before_n <> id or before_v <> id").count() == 0 and sums.count() == 4000
    largest = df.repartitionByRange(8, "k", "id").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert largest < 1000


def test_rows_are_shuffled_once_and_joined_with_nothing(spark):
    df = spark.createDataFrame(_rows(), SPEC)
    plan = OrderedTargetEncoder(["one", "t wo"], "y").fit(df).training(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("RepartitionByExpression") == 1


def test_small_batches_many_categories_and_an_infinite_label(spark):
    rows = [(i, str(i % 150), "x" if i % 2 else None, float("inf") if i == 7 else float("nan") if i == 8 else float(i % 5)) for i in range(600)]
    df = spark.createDataFrame(rows, SPEC)
    model = OrderedTargetEncoder(["one", "t wo"], "y").fit(df)
    model.prior = 1.0
    known = [(*r[:3], None if r[3] != r[3] else r[3]) for r in rows]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {r["row_id"]: r for r in model.training(df).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    sums: dict = {}
    for r in sorted(known, key=lambda r: hashlib.md5(f"42|{r[0]}".encode()).hexdigest()):
        for at, name in ((1, "one"), (2, "t wo")):
            s, n = sums.get((at, r[at]), (0.0, 0))
            assert got[r[0]][name] == (s + 1.0) / (n + 1.0)
            if r[3] is not None:
                sums[at, r[at]] = (s + r[3], n + 1)
