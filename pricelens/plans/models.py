"""Regressors M1-M13 as Spark ML estimators, with the reference's search
spaces (T1 samples from them).

Penalty conversions (objective of the reference's learners -> Spark's
``LinearRegression``, whose loss is (1/2n)·||r||² and which divides the
penalty by the label scale σ_y):

* Ridge (α||w||²):          regParam = α·σ_y/n, elasticNet 0, solver normal
* Lasso ((1/2n)||r||² + α||w||₁): regParam = α, elasticNet 1
* ElasticNet (α, l1_ratio): A = α·l1, B = α(1-l1)·σ_y -> regParam A+B,
  elasticNet A/(A+B)
* linear SVR, squared ε-insensitive loss with ε = 0 == ridge with α = 1/(2C)
* Huber: Spark's huber loss (same scale-estimating form), regParam = α/n
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.regression import (DecisionTreeRegressionModel, DecisionTreeRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .boosting import HistBooster

SEED = 120
# The thirteen model families, in the reference's order.
FAMILIES = [
    "HuberRegressor", "Ridge", "Lasso", "ElasticNet", "LinearSVR", "DecisionTreeRegressor",
    "RandomForestRegressor", "ExtraTreesRegressor", "AdaBoostRegressor", "HistGradientBoostingRegressor",
    "XGBRegressor", "LGBMRegressor", "CatBoostRegressor",
]
LINEAR = FAMILIES[:5]
TRANSFORMED = FAMILIES[:4]          # gaussian transform step (F3)
CAPPABLE = FAMILIES[1:5]            # outlier capping choice (F2)


def _log_uniform(rng, lo, hi):
    return math.exp(rng.uniform(math.log(lo), math.log(hi)))


def sample_model_params(family: str, rng: random.Random) -> dict:
    """One draw from the family's search space (fixed values: its ranges)."""
    r = rng
    if family == "HuberRegressor":
        return {"epsilon": _log_uniform(r, 1.01, 2), "alpha": _log_uniform(r, 1e-6, 1)}
    if family in ("Ridge", "Lasso"):
        return {"alpha": _log_uniform(r, 1e-6, 2)}
    if family == "ElasticNet":
        return {"alpha": _log_uniform(r, 1e-6, 2), "l1_ratio": _log_uniform(r, 1e-6, 0.999999)}
    if family == "LinearSVR":
        return {"C": _log_uniform(r, 1e-4, 1)}
    if family in ("DecisionTreeRegressor", "RandomForestRegressor", "ExtraTreesRegressor"):
        return {"ccp_alpha": r.uniform(50, 75)}
    if family == "AdaBoostRegressor":
        return {"learning_rate": _log_uniform(r, 0.01, 1), "loss": r.choice(["linear", "square", "exponential"])}
    if family == "HistGradientBoostingRegressor":
        return {"learning_rate": _log_uniform(r, 0.01, 1), "max_leaf_nodes": r.randint(2, 50), "max_depth": r.randint(2, 10),
                "min_samples_leaf": r.randint(20, 100), "l2_regularization": r.uniform(0, 1)}
    if family == "XGBRegressor":
        return {"eta": _log_uniform(r, 0.1, 0.5), "gamma": _log_uniform(r, 0.1, 20), "min_child_weight": _log_uniform(r, 0.1, 1000),
                "max_depth": r.randint(1, 10), "lambda": _log_uniform(r, 0.1, 1000), "alpha": _log_uniform(r, 0.1, 100),
                "subsample": _log_uniform(r, 0.5, 1), "colsample_bytree": _log_uniform(r, 0.5, 1)}
    if family == "LGBMRegressor":
        return {"learning_rate": _log_uniform(r, 0.01, 0.3), "max_depth": r.randint(3, 12), "num_leaves": r.randint(8, 4096),
                "min_child_samples": r.randint(5, 100), "subsample": _log_uniform(r, 0.5, 1), "subsample_freq": r.randint(1, 10),
                "reg_alpha": _log_uniform(r, 0.1, 100), "reg_lambda": _log_uniform(r, 0.1, 100), "min_split_gain": _log_uniform(r, 0.1, 15)}
    if family == "CatBoostRegressor":
        return {"depth": r.randint(4, 10), "l2_leaf_reg": r.randint(2, 10), "random_strength": _log_uniform(r, 0.1, 10),
                "learning_rate": _log_uniform(r, 0.01, 0.3)}
    raise ValueError(family)


def _label_stats(df: DataFrame, label: str):
    row = df.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("sp"), F.stddev_samp(label).alias("ss")).first()
    return row["n"], row["sp"] or 1.0, row["ss"] or 1.0


#: Iterations that a linear family may take.
MAX_ITER = 10_000


class LinearFamily(Estimator):
    """M1-M5: converts the reference's penalty parameters to Spark's scale at
    fit time (needs n and σ_y of the training rows: one aggregate)."""

    def __init__(self, family: str, params: dict, featuresCol="features", labelCol="SP"):
        super().__init__()
        self.family, self.hp, self.featuresCol, self.labelCol = family, dict(params), featuresCol, labelCol

    def _fit(self, df):
        n, s_pop, _ = _label_stats(df, self.labelCol)
        fam, p = self.family, self.hp
        common = dict(featuresCol=self.featuresCol, labelCol=self.labelCol, standardization=False, maxIter=MAX_ITER)
        if fam in ("Ridge", "LinearSVR"):
            alpha = p["alpha"] if fam == "Ridge" else 1.0 / (2.0 * p["C"])
            est = LinearRegression(regParam=alpha * s_pop / n, elasticNetParam=0.0, solver="normal", **common)
        elif fam == "Lasso":
            est = LinearRegression(regParam=p["alpha"], elasticNetParam=1.0, tol=1e-8, **common)
        elif fam == "ElasticNet":
            a = p["alpha"] * p["l1_ratio"]
            b = p["alpha"] * (1 - p["l1_ratio"]) * s_pop
            est = LinearRegression(regParam=a + b, elasticNetParam=a / (a + b), tol=1e-8, **common)
        elif fam == "HuberRegressor":
            est = LinearRegression(loss="huber", epsilon=max(p["epsilon"], 1.000001), regParam=p["alpha"] / n,
                                   elasticNetParam=0.0, **common)
        else:
            raise ValueError(fam)
        return est.fit(df)


#: Spark's own bound of a tree's depth; the families have none.
MAX_DEPTH = 30

#: A deep tree is grown with each row's node kept beside it: a level then neither ships the
#: tree to its tasks nor walks rows through it.  So many MB hold the statistics of the nodes
#: that one pass splits, in each task; with less, a wide level takes more passes.
DEEP = {"cacheNodeIds": True, "maxMemoryInMB": 512}


def make_regressor(family: str, params: dict, featuresCol="features", labelCol="SP", seed: int = SEED):
    """A Spark estimator for one family + parameter draw."""
    p = params
    common = dict(featuresCol=featuresCol, labelCol=labelCol)
    if family in LINEAR:
        return LinearFamily(family, p, featuresCol, labelCol)
    if family == "DecisionTreeRegressor":
        return DecisionTreeRegressor(maxDepth=MAX_DEPTH, minInfoGain=p.get("ccp_alpha", 0.0), seed=seed, **DEEP, **common)
    if family == "RandomForestRegressor":
        return RandomForestRegressor(numTrees=50, maxDepth=10, featureSubsetStrategy="all",
                                     minInfoGain=p.get("ccp_alpha", 0.0), seed=seed, **common)
    if family == "ExtraTreesRegressor":
        return RandomForestRegressor(numTrees=50, maxDepth=10, featureSubsetStrategy="onethird", bootstrap=False,
                                     minInfoGain=p.get("ccp_alpha", 0.0), seed=seed, **common)
    if family == "AdaBoostRegressor":
        return AdaBoostR2(p.get("learning_rate", 1.0), p.get("loss", "linear"), featuresCol=featuresCol,
                          labelCol=labelCol, seed=seed)
    if family == "HistGradientBoostingRegressor":
        return HistBooster(100, p["learning_rate"], p["max_depth"], p.get("max_leaf_nodes", 31), l2=p.get("l2_regularization", 0.0),
                           min_child_rows=p["min_samples_leaf"], bins=255, seed=seed, **common)
    if family == "XGBRegressor":
        return HistBooster(50, p["eta"], p["max_depth"], l1=p.get("alpha", 0.0), l2=p.get("lambda", 1.0), gamma=p["gamma"], factor=0.5,
                           min_child_weight=p.get("min_child_weight", 1.0), bins=256, subsample=min(1.0, p["subsample"]),
                           columns=min(1.0, p["colsample_bytree"]), seed=seed, **common)
    if family == "LGBMRegressor":
        return HistBooster(100, p["learning_rate"], p["max_depth"], p.get("num_leaves", 31), l1=p.get("reg_alpha", 0.0), l2=p.get("reg_lambda", 0.0),
                           gamma=p["min_split_gain"], min_child_rows=p["min_child_samples"], bins=63, subsample=min(1.0, p["subsample"]),
                           subsample_every=p.get("subsample_freq", 1), seed=seed, **common)
    if family == "CatBoostRegressor":
        return HistBooster(50, p["learning_rate"], p["depth"], l2=p.get("l2_leaf_reg", 3.0), bins=128, symmetric=True,
                           random_strength=p.get("random_strength", 1.0), seed=seed, **common)
    raise ValueError(family)


# ----------------------------------------------------------------- M9 -----

def _sums(data: DataFrame) -> list[tuple[int, float]]:
    """(part, its weights) of each partition: one row per partition reaches the driver."""
    return sorted((r["_part"], r["w"]) for r in data.groupBy("_part").agg(F.sum("_w").alias("w")).collect())


def systematic_copies(data: DataFrame, total: float, n: int, start: float, sums: list[tuple[int, float]] | None = None) -> DataFrame:
    """``_copies`` of each row of ``data`` (with ``_part``, the partition it lies in, and a
    weight ``_w``): weights are laid end to end on a line of length n, and a row gets the
    points start, start + 1, ... that fall on its piece.  Its expected copies are n x its
    share of the weights, and they differ from that by less than 1.  Pieces begin where the partitions
    before end (``sums``: the weights of each, as ``_sums`` gives them).  Only the two columns leave the JVM."""
    begins, at = {}, 0.0
    for part, w in _sums(data) if sums is None else sums:
        begins[part], at = at, at + w

    @F.pandas_udf("double")
    def copies(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        ends = dict(begins)
        for parts, w in batches:
            if not len(w):
                yield pd.Series([], dtype="float64")
                continue
            part = int(parts.iloc[0])
            line = ends[part] + np.concatenate([[0.0], np.cumsum(w.to_numpy())])
            ends[part] = float(line[-1])
            yield pd.Series(np.diff(np.floor(line * (n / total) - start)))

    return data.withColumn("_copies", copies.asNondeterministic()("_part", "_w"))


class AdaBoostR2(Estimator):
    """M9: AdaBoost.R2 with depth-3 regression trees.

    Each stage fits a tree on rows resampled by weight (a row drawn k times has weight k
    in the fit), then updates the weights with one aggregate (max error, weighted mean
    loss; two for the losses that aren't linear) and a column expression.  The rows with their
    weights and copies are one persisted table per stage, which the passes of the tree and both
    aggregates read; lineage is cut every ``checkpoint_every`` stages.
    Prediction = weighted median of the stage predictions, computed per row
    with array functions (no UDF).
    """

    def __init__(self, learning_rate=1.0, loss="linear", n_estimators=50, max_depth=3,
                 featuresCol="features", labelCol="SP", seed=SEED, checkpoint_every=10):
        super().__init__()
        self.learning_rate, self.loss, self.n_estimators = learning_rate, loss, n_estimators
        self.max_depth, self.featuresCol, self.labelCol = max_depth, featuresCol, labelCol
        self.seed, self.checkpoint_every = seed, checkpoint_every

    def _fit(self, df):
        # the checkpoint fixes which rows lie in which partition, and their order
        x = self.featuresCol
        data = cut_lineage(df.select(F.col(x), F.col(self.labelCol).cast("double").alias("_y"),
                                     F.lit(1.0).alias("_w"), F.spark_partition_id().alias("_part")))
        sums = _sums(data)
        total = sum(w for _, w in sums)
        n = int(total)
        held, trees, weights = None, [], []
        for k in range(self.n_estimators):
            start = random.Random(f"{self.seed}-{k}").random()
            drawn = systematic_copies(data, total, n, start, sums).persist()
            dt = DecisionTreeRegressor(featuresCol=x, labelCol="_y", weightCol="_copies",
                                       maxDepth=self.max_depth, seed=self.seed + k)
            m = dt.fit(drawn.where("_copies > 0"))
            if held is not None:
                held.unpersist()
            held = drawn
            # the tree is cheaper to walk again than the rows are to keep once more
            scored = m.copy().setPredictionCol("_p").transform(drawn).select(x, "_y", "_w", "_part", F.abs(F.col("_p") - F.col("_y")).alias("_e"))
            row = scored.agg(F.max(F.when(F.col("_w") > 0, F.col("_e"))).alias("most"), F.sum("_w").alias("w"), F.sum(F.col("_w") * F.col("_e")).alias("we")).first()
            emax = row["most"] or 0.0
            if emax <= 0:
                trees.append(m)
                weights.append(1.0)
                break
            e = F.col("_e") / F.lit(emax)
            if self.loss == "square":
                e = e * e
            elif self.loss == "exponential":
                e = 1 - F.exp(-e)
            if self.loss in ("square", "exponential"):
                err = scored.agg((F.sum(F.col("_w") * e) / F.sum("_w")).alias("err")).first()["err"]
            else:
                err = row["we"] / emax / row["w"]
            if err >= 0.5 and trees:
                break
            trees.append(m)
            if err <= 0 or err >= 0.5:
                weights.append(1.0)
                break
            beta = err / (1.0 - err)
            weights.append(self.learning_rate * math.log(1.0 / beta))
            if k + 1 == self.n_estimators:
                break
            data = scored.select(x, "_y", (F.col("_w") * F.pow(F.lit(beta), (1 - e) * self.learning_rate)).alias("_w"), "_part")
            if (k + 1) % self.checkpoint_every == 0:
                data = cut_lineage(data)
            sums = _sums(data)
            total = sum(w for _, w in sums)
        if held is not None:
            held.unpersist()
        return AdaBoostR2Model(trees, weights, x)


class AdaBoostR2Model(Model):
    def __init__(self, trees, weights, featuresCol="features", predictionCol="prediction"):
        super().__init__()
        self.trees, self.weights = list(trees), list(weights)
        self.featuresCol, self.predictionCol = featuresCol, predictionCol

    def _transform(self, df):
        out = df
        names = []
        for i, t in enumerate(self.trees):
            name = f"_ada{i}"
            out = t.copy().setFeaturesCol(self.featuresCol).setPredictionCol(name).transform(out)
            names.append(name)
        preds = F.array(*[F.col(n) for n in names])
        w = F.array(*[F.lit(float(x)) for x in self.weights])
        pairs = F.array_sort(F.arrays_zip(preds.alias("p"), w.alias("w")))
        total = sum(self.weights)
        init = F.struct(F.lit(0.0).alias("cum"), F.lit(None).cast("double").alias("res"))
        med = F.aggregate(pairs, init, lambda acc, x: F.struct(
            (acc["cum"] + x["w"]).alias("cum"),
            F.when(acc["res"].isNull() & (acc["cum"] + x["w"] >= F.lit(0.5 * total)), x["p"])
            .otherwise(acc["res"]).alias("res")))
        return out.withColumn(self.predictionCol, med["res"]).drop(*names)

    def save(self, path):
        import os
        from pyspark.sql import SparkSession
        from ..session import write_json
        for i, t in enumerate(self.trees):
            t.write().overwrite().save(os.path.join(path, f"tree{i}"))
        write_json(SparkSession.active(), os.path.join(path, "weights.json"),
                   {"weights": self.weights, "featuresCol": self.featuresCol})

    @classmethod
    def load(cls, path):
        import os
        from pyspark.sql import SparkSession
        from ..session import read_json
        meta = read_json(SparkSession.active(), os.path.join(path, "weights.json"))
        trees = [DecisionTreeRegressionModel.load(os.path.join(path, f"tree{i}")) for i in range(len(meta["weights"]))]
        return cls(trees, meta["weights"], meta["featuresCol"])


# Mid-range draws used when a family is fitted without a search.
DEFAULT_PARAMS = {
    "HuberRegressor": {"epsilon": 1.35, "alpha": 1e-4},
    "Ridge": {"alpha": 1.0},
    "Lasso": {"alpha": 1.0},
    "ElasticNet": {"alpha": 1.0, "l1_ratio": 0.5},
    "LinearSVR": {"C": 0.1},
    "DecisionTreeRegressor": {"ccp_alpha": 60.0},
    "RandomForestRegressor": {"ccp_alpha": 60.0},
    "ExtraTreesRegressor": {"ccp_alpha": 60.0},
    "AdaBoostRegressor": {"learning_rate": 0.1, "loss": "linear"},
    "HistGradientBoostingRegressor": {"learning_rate": 0.1, "max_leaf_nodes": 31, "max_depth": 6, "min_samples_leaf": 20, "l2_regularization": 0.0},
    "XGBRegressor": {"eta": 0.3, "gamma": 1.0, "min_child_weight": 1.0, "max_depth": 6, "lambda": 1.0, "alpha": 0.1, "subsample": 0.8, "colsample_bytree": 0.8},
    "LGBMRegressor": {"learning_rate": 0.1, "max_depth": 6, "num_leaves": 31, "min_child_samples": 20, "subsample": 0.8, "subsample_freq": 1,
                      "reg_alpha": 0.1, "reg_lambda": 0.1, "min_split_gain": 1.0},
    "CatBoostRegressor": {"depth": 6, "l2_leaf_reg": 3, "random_strength": 1.0, "learning_rate": 0.1},
}
