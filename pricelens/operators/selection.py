"""Feature selection (V1-V8).

Scores are single aggregates over the table (correlations, binned
contingency counts) or Spark ML fits; what reaches the driver is one number
per feature.  ``FeatureSelector`` is the fit/transform stage the model
pipelines use.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c, nan_to_null
from ..functions.stats import column_moments
from .base import FittedStage, Stage, materialise

SEED = 120


def _finite(x):
    """NULL for NaN and ±infinity."""
    d = x.cast("double")
    return F.when(F.isnan(d) | (F.abs(d) == float("inf")), F.lit(None).cast("double")).otherwise(d)


def f_regression(df: DataFrame, features, label: str) -> DataFrame:
    """V5: ``feature, r, f_score`` with F = r²/(1-r²)·(n-2)."""
    features = list(features)
    # constant columns have no correlation
    *found, y = column_moments(df, [c(f) for f in features] + [c(label)], "nan")
    out = []
    for f, o in zip(features, found):
        r = o["r"] if o["sd"] and y["sd"] else None
        fs = None if r is None else (r * r / (1 - r * r) * (o["rows"] - 2) if abs(r) < 1 else math.inf)
        out.append((f, r, fs))
    return df.sparkSession.createDataFrame(out, "feature string, r double, f_score double")


def top_k(scores: DataFrame, score: str, k: int, name: str = "feature") -> DataFrame:
    """D3: the k best rows by score (descending; ties by name)."""
    return scores.orderBy(F.desc(score), F.col(name)).limit(k)


def mutual_information(df: DataFrame, features, label: str, bins: int = 10) -> DataFrame:
    """V4 (re-aimed from the neighbour estimator): mutual information of
    equal-width-binned feature and label, Σ p(x,y)·ln(p(x,y)/(p(x)p(y))).
    All features in one pass over the unpivoted table for the ranges and one for the joint counts,
    which hold at most bins² rows a feature and give the others."""
    features = list(features)
    y = nan_to_null(c(label))
    pairs = [F.struct(F.lit(f).alias("feature"), nan_to_null(c(f).cast("double")).alias("x")) for f in features]
    long = (df.select(y.alias("y"), F.explode(F.array(*pairs)).alias("kv"))
            .select("kv.feature", "kv.x", "y").where(F.col("x").isNotNull() & F.col("y").isNotNull()))
    st = long.groupBy("feature").agg(F.min("x").alias("xl"), F.max("x").alias("xh"), F.min("y").alias("yl"),
                                     F.max("y").alias("yh"), F.count(F.lit(1)).alias("n"))

    def bucket(v, lo, hi):
        w = F.col(hi) - F.col(lo)
        return F.when(w > 0, F.least(F.floor((F.col(v) - F.col(lo)) / w * bins), F.lit(bins - 1))).otherwise(F.lit(0))

    b = long.join(F.broadcast(st), ["feature"]).select("feature", "n", bucket("x", "xl", "xh").alias("bx"),
                                                        bucket("y", "yl", "yh").alias("by"))
    j = materialise(b.groupBy("feature", "bx", "by").agg(F.count(F.lit(1)).alias("nxy"), F.first("n").alias("n")))
    mx = j.groupBy("feature", "bx").agg(F.sum("nxy").alias("nx"))
    my = j.groupBy("feature", "by").agg(F.sum("nxy").alias("ny"))
    t = j.join(mx, ["feature", "bx"]).join(my, ["feature", "by"])
    return t.groupBy("feature").agg(
        F.sum(F.col("nxy") / F.col("n") * F.log(F.col("nxy") * F.col("n") / (F.col("nx") * F.col("ny")))).alias("mi"))


def spearman_rows(df: DataFrame, features) -> dict:
    from .profile import spearman_matrix
    return {(r["col_a"], r["col_b"]): r["rho"] for r in spearman_matrix(df, features).collect()}


def correlated_to_drop(df: DataFrame, features, threshold: float = 0.8) -> list:
    """V1: Spearman; walk the columns in order, each unexamined column
    absorbs the later ones correlated above ``threshold``; all but the first
    of each group are dropped.  The loop runs over a p×p matrix on the
    driver (p = number of features)."""
    features = list(features)
    rho = spearman_rows(df, features)
    examined, drop = set(), []
    for f in features:
        if f in examined:
            continue
        examined.add(f)
        for g in features:
            if g in examined:
                continue
            v = rho.get((g, f))
            if v is not None and abs(v) > threshold:
                examined.add(g)
                drop.append(g)
    return drop


def _assemble(df, features, out="_features"):
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def lasso_scores(df: DataFrame, features, label: str, alpha: float = 1.0, scaled: bool = False) -> dict:
    """V2: |coef| of an L1 fit (× feature std when the inputs are unscaled)."""
    features = list(features)
    data = _assemble(df, features)
    lr = LinearRegression(featuresCol="_features", labelCol=label, elasticNetParam=1.0, regParam=alpha,
                          standardization=False, maxIter=1000, tol=1e-8)
    coef = lr.fit(data).coefficients.toArray()
    if scaled:
        return {f: abs(float(v)) for f, v in zip(features, coef)}
    row = df.agg(*[F.stddev_pop(c(f)).alias(f"s{i}") for i, f in enumerate(features)]).first()
    return {f: abs(float(v)) * (row[f"s{i}"] or 0.0) for i, (f, v) in enumerate(zip(features, coef))}


def tree_importances(df: DataFrame, features, label: str, trees: int = 100, seed: int = SEED) -> dict:
    """V3: impurity importances of an extra-trees-like forest (no bootstrap,
    a third of the features per split)."""
    features = list(features)
    rf = RandomForestRegressor(featuresCol="_features", labelCol=label, numTrees=trees, bootstrap=False,
                               featureSubsetStrategy="onethird", seed=seed, maxDepth=10)
    imp = rf.fit(_assemble(df, features)).featureImportances.toArray()
    return {f: float(v) for f, v in zip(features, imp)}


def mi_scores(df, features, label, bins=10) -> dict:
    return {r["feature"]: r["mi"] for r in mutual_information(df, features, label, bins).collect()}


def f_scores(df, features, label) -> dict:
    return {r["feature"]: r["f_score"] for r in f_regression(df, features, label).collect()}


def uncorrelated_recursive(df: DataFrame, features, label: str, threshold: float = 0.7,
                           seed: int = SEED) -> list:
    """V6 (re-aimed): of every highly correlated pair keep the member with
    the higher mutual information, then repeatedly fit a boosted-tree model
    and drop features without importance, until none is dropped."""
    features = list(features)
    mi = mi_scores(df, features, label)
    rho = spearman_rows(df, features)
    keep = list(features)
    for i, a in enumerate(features):
        for b in features[i + 1:]:
            v = rho.get((a, b))
            if a in keep and b in keep and v is not None and abs(v) > threshold:
                keep.remove(b if (mi.get(a) or 0) >= (mi.get(b) or 0) else a)
    while True:
        gbt = GBTRegressor(featuresCol="_features", labelCol=label, maxIter=20, maxDepth=5, seed=seed)
        imp = gbt.fit(_assemble(df, keep)).featureImportances.toArray()
        nxt = [f for f, v in zip(keep, imp) if v > 0]
        if not nxt or nxt == keep:
            break
        keep = nxt
    return keep


def _top(scores: dict, k: int, order) -> list:
    ranked = sorted(scores.items(), key=lambda kv: (-(kv[1] if kv[1] is not None and not math.isnan(kv[1])
                                                       else -math.inf), order.index(kv[0])))
    return [f for f, _ in ranked[:k]]


def chosen_features(method: str, number: int | None, feats: list, scores) -> list:
    """V7 + V8: the features that a method keeps of ``feats``; ``scores()`` gives a number
    for each (``Uncorrelated``: the kept ones).  An empty choice keeps every feature."""
    k = min(number or len(feats), len(feats))
    if method == "Uncorrelated":
        chosen = list(scores())
    elif method == "ANOVA" and (number or 0) > len(feats):
        chosen = list(feats)
    elif method in ("Lasso", "FeatureImportance_ET", "MutualInformation", "ANOVA"):
        chosen = _top(scores(), k, feats)
    else:
        raise ValueError(method)
    if method in ("ANOVA", "FeatureImportance_ET"):
        chosen = [f for f in feats if f in set(chosen)]
    return chosen or list(feats)


class FeatureSelector(Stage):
    """V1-V7 as one stage: optional correlated-feature drop, then a method
    (``Lasso``, ``FeatureImportance_ET``, ``MutualInformation``, ``ANOVA``,
    ``Uncorrelated``) choosing ``number`` features (V8).  An empty choice
    keeps every feature (V7)."""

    def __init__(self, features=None, label: str = "SP", method: str = "ANOVA", number: int | None = 10,
                 drop_correlated: bool = False, scaled: bool = False, exclude=("row_id", "fold"),
                 outputCol: str = "features"):
        super().__init__()
        self.features = list(features) if features else None
        self.label, self.method = label, method
        self.number, self.drop_correlated, self.scaled = number, drop_correlated, scaled
        self.exclude, self.outputCol = set(exclude) | {label}, outputCol

    def _fit(self, df):
        if self.features:
            feats = [f for f in self.features if f in df.columns]
        else:
            feats = [n for n, t in df.dtypes if t in ("double", "int", "bigint", "float") and n not in self.exclude]
        dropped = correlated_to_drop(df, feats) if self.drop_correlated else []
        feats = [f for f in feats if f not in dropped]
        scores = {"Lasso": lambda: lasso_scores(df, feats, self.label, scaled=self.scaled),
                  "FeatureImportance_ET": lambda: tree_importances(df, feats, self.label),
                  "MutualInformation": lambda: mi_scores(df, feats, self.label),
                  "ANOVA": lambda: f_scores(df, feats, self.label),
                  "Uncorrelated": lambda: uncorrelated_recursive(df, feats, self.label)}
        chosen = chosen_features(self.method, self.number, feats, scores.get(self.method))
        # Learners refuse NaN / infinite inputs (e.g. the std of a one-row
        # group): they are filled with the feature's mean on the fitting rows.
        means = column_moments(df, [c(f) for f in chosen], "nonfinite", spread=False)
        fill = {f: (o["mean"] if o["mean"] is not None else 0.0) for f, o in zip(chosen, means)}
        return FeatureSelectorModel(chosen, dropped, self.outputCol, fill)


class FeatureSelectorModel(FittedStage):
    """Drops the correlated columns and assembles the selected ones into
    ``outputCol`` (missing values pass through as NaN)."""

    def __init__(self, selected, dropped, outputCol="features", fill=None):
        super().__init__()
        self.selected, self.dropped, self.outputCol = selected, dropped, outputCol
        self.fill = fill or {}

    def _transform(self, df):
        out = df.drop(*[d for d in self.dropped if d in df.columns])
        tmp = {f"_sel{i}": F.coalesce(_finite(c(f)), F.lit(float(self.fill.get(f, 0.0))))
               for i, f in enumerate(self.selected)}
        out = out.withColumns(tmp)
        res = VectorAssembler(inputCols=list(tmp), outputCol=self.outputCol, handleInvalid="keep").transform(out)
        return res.drop(*tmp)
