"""Grouped-mean predictors evaluated by grouped cross-validation.

These give the evaluation operators (A18-A21, G1) real inputs whose every
step is also expressible in SQL: a smoothed group mean
``(Σy + α·ȳ)/(n + α)`` fitted on the training folds, scored on the held-out
fold.  Training statistics of every fold come from ONE aggregate: per
``(group, fold)`` sums, and "all folds but f" = total minus fold f.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import c
from ..functions.ordered import exact_quantiles


def grouped_cv_predictions(df: DataFrame, group: str, fold: str, label: str = "SP",
                           alpha: float = 0.0, model: str | None = None) -> DataFrame:
    """Rows of every held-out fold with ``model, fold, actual, predicted``."""
    y = c(label)
    base = df.select(c(group).cast("string").alias("_g"), c(fold).cast("string").alias("fold"), y.alias("actual"))
    per = base.groupBy("_g", "fold").agg(F.sum("actual").alias("s"), F.count(F.lit(1)).alias("n"))
    tot_g = per.groupBy("_g").agg(F.sum("s").alias("g_s"), F.sum("n").alias("g_n"))
    per_f = per.groupBy("fold").agg(F.sum("s").alias("fs"), F.sum("n").alias("fn"))
    # Fold-level prior: mean label of the training rows of that fold (the
    # fold table has one row per fold, so the window is tiny).
    every = Window.partitionBy(F.lit(0))
    prior = per_f.select("fold", ((F.sum("fs").over(every) - F.col("fs"))
                                  / (F.sum("fn").over(every) - F.col("fn"))).alias("prior"))
    train = (per.join(tot_g, ["_g"])
             .select("_g", "fold", (F.col("g_s") - F.col("s")).alias("ts"), (F.col("g_n") - F.col("n")).alias("tn")))
    pred_tab = (train.join(F.broadcast(prior), ["fold"])
                .select("_g", "fold", "prior",
                        F.when(F.col("tn") + alpha > 0,
                               (F.col("ts") + F.lit(alpha) * F.col("prior")) / (F.col("tn") + F.lit(alpha)))
                        .alias("_p")))
    scored = (base.join(pred_tab, ["_g", "fold"], "left")
              .join(F.broadcast(prior.withColumnRenamed("prior", "_prior")), ["fold"], "left"))
    return scored.select(F.lit(model or f"{group}_mean").alias("model"), "fold", "actual",
                         F.coalesce(F.col("_p"), F.col("_prior")).alias("predicted"))


def fold_metrics(pred: DataFrame, keys=("model", "fold")) -> DataFrame:
    """A21 per fold: ``rmse, mae, median_ae`` (median absolute error is exact)."""
    keys = list(keys)
    err = pred.select(*keys, (F.col("predicted") - F.col("actual")).alias("e"))
    agg = err.groupBy(*keys).agg(F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse"),
                                 F.avg(F.abs("e")).alias("mae"))
    med = exact_quantiles(err.select(*keys, F.abs("e").alias("ae")), keys, "ae", [0.5])
    return agg.join(med.select(*keys, F.col("q").alias("median_ae")), keys)


def fold_averages(metrics: DataFrame, key: str = "model", cols=("rmse", "mae", "median_ae")) -> DataFrame:
    """Mean and population std of each metric over the folds."""
    aggs = []
    for m in cols:
        aggs += [F.avg(m).alias(f"avg_{m}"), F.stddev_pop(m).alias(f"std_{m}")]
    return metrics.groupBy(key).agg(*aggs)


def best_per_metric(averages: DataFrame, key: str = "model", cols=("avg_rmse", "avg_mae", "avg_median_ae")) -> DataFrame:
    """Arg-min of every averaged metric (ties -> smallest key)."""
    # one aggregate for all metrics: what the averages come from is read once
    best = averages.agg(*[F.struct(F.lit(m).alias("metric"), F.min_by(F.col(key), F.struct(F.col(m), F.col(key))).alias(key),
                                   F.min(m).alias("value")).alias(f"_{i}") for i, m in enumerate(cols)])
    return best.select(F.explode(F.array(*[F.col(f"_{i}") for i in range(len(cols))])).alias("b")).select("b.*")


def best_trial(trials: DataFrame, value: str = "value", key: str = "number") -> DataFrame:
    """The trial with the lowest objective value (ties -> lowest number)."""
    return trials.agg(F.min_by(F.struct(*[F.col(n) for n in trials.columns]),
                               F.struct(F.col(value), F.col(key))).alias("t")).select("t.*")
