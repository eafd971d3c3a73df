"""Pipeline assembly (F9), hyperparameter search (T1), inner CV (T2), nested
CV (T3), refit (T4), model selection (T5), final model (T6) and folds
(D4-D6).

The driver loops over trials and folds; every fit inside is distributed.
The prepared table is written once to the checkpoint folder with a stable
row id and fold columns, so each fold is a filter on that table (pushed into
the scan) and a lost executor recomputes from the written table.
"""

from __future__ import annotations

import json
import os
import random
import time
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.errors import ArithmeticException, IllegalArgumentException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import c
from ..operators import features as FE
from ..operators.base import FittedStage, load_stage, written_table
from ..operators.clean import with_row_id
from ..operators.selection import FeatureSelector
from ..session import cut_lineage, read_json, write_json
from ..spec import SALES, FeatureSpec
from . import baselines as BL
from . import gram as GR
from . import study as ST
from .boosting import HistBoosterModel
from .models import (CAPPABLE, FAMILIES, LINEAR, SEED, TRANSFORMED, AdaBoostR2Model, make_regressor,
                     sample_model_params)

# Preprocessing choices searched with every model.
SCALINGS = ["Standard", "MinMax", "Robust", "Combine"]
SELECTIONS = ["Lasso", "FeatureImportance_ET", "MutualInformation", "ANOVA", "Uncorrelated"]


def FOLDS(spec: FeatureSpec) -> tuple:
    """Columns of the training table that are no features."""
    return (spec.row_id, "fold", "inner_fold")


@dataclass
class Choice:
    family: str
    model_params: dict = field(default_factory=dict)
    outlier: str = "retained"
    scaling: str = "no"
    selection: str = "ANOVA"
    drop_correlated: bool = False
    number: int | None = 10


def sample_choice(family: str, rng: random.Random, max_features: int = 30) -> Choice:
    """One draw of model parameters and preprocessing choices (V8: number of
    features 1..30, none for the uncorrelated-recursive method)."""
    ch = Choice(family, sample_model_params(family, rng))
    ch.outlier = rng.choice(["capped", "retained"]) if family in CAPPABLE else "retained"
    ch.scaling = rng.choice(SCALINGS) if family in LINEAR else "no"
    ch.selection = rng.choice(SELECTIONS)
    ch.drop_correlated = rng.choice([True, False]) if ch.selection != "Uncorrelated" else False
    ch.number = rng.randint(1, max_features) if ch.selection != "Uncorrelated" else None
    return ch


def preparation(ch: Choice, spec: FeatureSpec = SALES, rare_tol: float = 0.05) -> list:
    """The steps before scaling: they depend on the family's kind and the outlier choice."""
    cont, nom, cyc = list(spec.continuous), list(spec.nominal), list(spec.cyclic)
    stages = []
    if ch.outlier == "capped":
        stages.append(FE.OutlierCapper(cont))
    if ch.family in TRANSFORMED:
        stages.append(FE.GaussianTransformer(cont))
    stages.append(FE.RareLabelEncoder(nom, tol=rare_tol))
    stages.append(FE.GroupStatFeatures(cont))
    stages.append(FE.IntervalEncoder(spec.interval[0], spec.interval_origin))
    if ch.family in LINEAR:
        stages.append(FE.OneHotEncoder(nom))
        stages.append(FE.CyclicalEncoder(cyc))
    else:
        # nominal and cyclic target encodings fitted together: each column is
        # encoded on its own, so one stage = one pass instead of two
        stages.append(FE.TargetEncoder(nom + cyc, spec.label))
    return stages


def build_pipeline(ch: Choice, spec: FeatureSpec = SALES, rare_tol: float = 0.05) -> Pipeline:
    """the step list for one family and choice, in the reference's order:
    capping -> gaussian transform -> rare labels -> group statistics ->
    interval -> encoding -> cyclic -> scaling -> selection -> model."""
    stages = preparation(ch, spec, rare_tol)
    if ch.family in LINEAR:
        stages.append(FE.Scaler(ch.scaling.lower(), exclude=[spec.label, *FOLDS(spec)]))
    stages.append(FeatureSelector(None, spec.label, ch.selection, ch.number, ch.drop_correlated,
                                  scaled=ch.scaling != "no", exclude=FOLDS(spec)))
    stages.append(make_regressor(ch.family, ch.model_params, "features", spec.label))
    return Pipeline(stages=stages)


def _param(stage, name: str) -> str:
    """A column's name as a stage holds it: a plain attribute, or a parameter of Spark's."""
    own = getattr(stage, name)
    return own if isinstance(own, str) else stage.getOrDefault(own)


def fit_pipeline(pipeline: Pipeline, df: DataFrame) -> PipelineModel:
    """``Pipeline.fit`` with the intermediate table persisted between stages.

    Plain ``Pipeline.fit`` hands each stage the lazily transformed input, so
    every aggregate of stage k recomputes stages 1..k-1 (and fuses their
    expressions into one generated class).  Here each stage's output is
    persisted (memory, spilling to disk).  The next fit materialises it from
    the table before, which is released only then; a lost executor
    recomputes it from lineage.
    """
    from pyspark import StorageLevel
    from pyspark.ml import Estimator
    stages = pipeline.getStages()
    cur, held, models = df, [], []
    for i, st in enumerate(stages):
        t0 = time.time()
        model = st.fit(cur) if isinstance(st, Estimator) else st
        if os.environ.get("PRICELENS_TRACE"):
            print(f"  fit {type(st).__name__}: {time.time() - t0:.2f}s", flush=True)
        models.append(model)
        if isinstance(st, Estimator):  # its fit has read, and so filled, the last table
            for older in held[:-1]:
                older.unpersist()
            held = held[-1:]
        if i < len(stages) - 1:
            cur = model.transform(cur)
            if i == len(stages) - 2 and hasattr(stages[-1], "labelCol"):  # all that the last fit reads
                cur = cur.select(*[c(_param(stages[-1], x)) for x in ("featuresCol", "labelCol")])
            cur = cur.persist(StorageLevel.MEMORY_AND_DISK)
            held.append(cur)
    for older in held:
        older.unpersist()
    return PipelineModel(models)


# ------------------------------------------------------------- folds -------

def assign_folds(df: DataFrame, k: int = 5, seed: int = SEED, key: str = "row_id", name: str = "fold") -> DataFrame:
    """Shuffled k folds by a seeded hash of the stable row key
    (deterministic under re-execution; fold sizes are equal in expectation)."""
    return df.withColumn(name, F.pmod(F.xxhash64(F.lit(seed), c(key)), F.lit(k)).cast("int"))


#: Rows among which the driver looks a block's end up.
FEW = 10_000


def _row_at(df: DataFrame, order: list, place: int) -> list:
    """The values of ``order`` in the row of that place (from 0) of the total order, NULL first: column by
    column, the value that covers the place is found among counts, and only its rows go on."""
    from ..functions.ordered import ordered_counts
    known: list = []
    for i, x in enumerate(order):
        empty = df.where(c(x).isNull()).count()
        if place < empty:
            known, count = [*known, None], empty
        else:
            counts = ordered_counts(df, [], x)
            row = counts.where((F.col("cum_before") <= place - empty) & (F.col("cum_before") + F.col("cnt") > place - empty)).first()
            known, count, place = [*known, row[x]], row["cnt"], place - empty - row["cum_before"]
        df = df.where(c(x).eqNullSafe(F.lit(known[-1]).cast(df.schema[x].dataType)))
        rest = order[i + 1:]
        if rest and count <= FEW:
            row = df.select(*[c(y) for y in rest]).orderBy(*[c(y) for y in rest]).offset(place).first()
            return [*known, *row]
    return known


def contiguous_folds(df: DataFrame, k: int = 3, order=None, name: str = "block") -> DataFrame:
    """Unshuffled k blocks over a total row order, ``ntile`` semantics; rows equal in the order
    share the block of the first.  The k - 1 rows before the blocks are looked up among counts of single columns, and a
    row's block is the number of those below it: no row is sorted, joined or moved."""
    order = list(order or df.columns)
    held = written_table(df, "blocks")
    n = held.count()
    key = F.struct(*[c(x).alias(f"k{i}") for i, x in enumerate(order)])
    block = F.lit(1)
    for i in range(1, k):
        start = i * (n // k) + min(i, n % k)
        if 0 < start < n:
            last = _row_at(held, order, start - 1)
            block = block + (key > F.struct(*[F.lit(v).cast(held.schema[x].dataType).alias(f"k{j}") for j, (x, v) in enumerate(zip(order, last))])).cast("int")
    return held.withColumn(name, block)


def nested_samples(df: DataFrame, sizes, seed: int = SEED, key: str = "row_id") -> DataFrame:
    """Learning-curve subsets: u = hash(row) in [0, 1); the subset for
    fraction s is u < s, so smaller subsets nest inside larger ones."""
    u = F.pmod(F.xxhash64(F.lit(seed + 1), c(key)), F.lit(1_000_003)) / 1_000_003.0
    return df.withColumn("_u", u).withColumns({f"in_{i}": F.col("_u") < F.lit(float(s)) for i, s in enumerate(sizes)})


def prepare_training_table(df: DataFrame, spec: FeatureSpec = SALES, k: int = 5, seed: int = SEED) -> DataFrame:
    """De-duplicated features + label with a stable row id and outer fold,
    written to the checkpoint folder."""
    cols = [x for x in spec.features if x in df.columns] + [spec.label]
    base = with_row_id(df.select(*[c(x) for x in cols]).dropDuplicates(), spec.row_id)
    return cut_lineage(assign_folds(base, k, seed, spec.row_id))


# --------------------------------------------------------- evaluation ------

def _metrics(pred: DataFrame, label: str) -> dict:
    # written once: the error sums, the sketch and the counts of the median read it, and rows are scored once
    scored = written_table(pred.select(F.lit("m").alias("model"), F.lit("f").alias("fold"),
                                       F.col(label).alias("actual"), F.col("prediction").alias("predicted")), "scored")
    row = BL.fold_metrics(scored).first()
    return {m: row[m] for m in ("rmse", "mae", "median_ae")} if row else {}


def cross_validate(train: DataFrame, ch: Choice, spec: FeatureSpec, folds: int = 3, seed: int = SEED,
                   rare_tol: float = 0.05) -> dict:
    """Refit the whole pipeline inside each inner fold (no leakage);
    mean train / validation RMSE, MAE, median AE.  Rows given as ``SharedFolds`` are
    prepared for all their choices together."""
    if isinstance(train, SharedFolds):
        return train.result(ch)
    data = assign_folds(train, folds, seed + 7, spec.row_id, "inner_fold")

    def one(f):
        tr = data.where(F.col("inner_fold") != f)
        model = fit_pipeline(build_pipeline(ch, spec, rare_tol), tr)
        # score train and validation rows of this fold in one pass
        return model.transform(data).select(
            F.lit(f).alias("fold"),
            F.when(F.col("inner_fold") == f, F.lit("val")).otherwise(F.lit("train")).alias("model"),
            c(spec.label).alias("actual"), F.col("prediction").alias("predicted"))

    # the folds' fits run at once: their many short jobs fill each other's gaps
    preds = reduce(DataFrame.unionByName, ST.at_once(one, list(range(folds))))
    # every fold's metrics in one job set (exact median AE included); the
    # scored rows are persisted so the metric jobs do not re-score
    from pyspark import StorageLevel
    preds = preds.persist(StorageLevel.MEMORY_AND_DISK)
    rows = BL.fold_metrics(preds).collect()
    preds.unpersist()
    res = {f"{s}_{m}": [] for s in ("train", "val") for m in ("rmse", "mae", "median_ae")}
    for r in rows:
        for m in ("rmse", "mae", "median_ae"):
            res[f"{r['model']}_{m}"].append(r[m])
    return {k: sum(v) / len(v) for k, v in res.items()}


#: What a draw of parameters itself can cause; anything else stops the study.
DRAW_ERRORS = (IllegalArgumentException, ArithmeticException, ValueError, ArithmeticError)


def evaluate(train: DataFrame, choices: list, spec: FeatureSpec, folds: int = 3, seed: int = SEED,
             rare_tol: float = 0.05, workers: int = ST.AT_ONCE) -> list:
    """T2 for many choices: the inner folds are prepared once for each outlier choice and
    kind of family, and all choices are scored on them.  A row of mean metrics for each
    choice, or the error of a draw that can't be fitted."""
    data = assign_folds(train, folds, seed + 7, spec.row_id, "inner_fold").persist()
    kinds = sorted({(ch.family in LINEAR, ch.family in TRANSFORMED, ch.outlier) for ch in choices})

    def one(item):
        kind, f = item
        own = [(k, ch) for k, ch in enumerate(choices) if (ch.family in LINEAR, ch.family in TRANSFORMED, ch.outlier) == kind]
        rows = data.where(F.col("inner_fold") != f)
        try:
            fold = ST.PreparedFold(rows, data, preparation(own[0][1], spec, rare_tol), spec.label, FOLDS(spec), fit_pipeline)
        except DRAW_ERRORS as e:
            return [(k, e) for k, _ in own]
        split = F.when(F.col("inner_fold") == f, F.lit("val")).otherwise(F.lit("train"))

        def trial(pair):
            k, ch = pair
            try:
                return k, fold.fitted(ch, split, BL.fold_metrics)
            except DRAW_ERRORS as e:
                return k, e
        quadratic = [p for p in own if p[1].family in GR.QUADRATIC]
        try:
            out = list(zip([k for k, _ in quadratic], fold.quadratic([ch for _, ch in quadratic], split))) if quadratic else []
            return out + ST.at_once(trial, [p for p in own if p[1].family not in GR.QUADRATIC], max(1, workers // len(items)))
        finally:
            fold.close()

    items = [(kind, f) for kind in kinds for f in range(folds)]
    found: dict = {k: [] for k in range(len(choices))}
    for part in ST.at_once(one, items, workers):
        for k, res in part:
            found[k].append(res)
    data.unpersist()
    out = []
    for k in range(len(choices)):
        bad = [r for r in found[k] if isinstance(r, Exception)]
        out.append(bad[0] if bad else {m: sum(r[m] for r in found[k]) / folds for m in ST.METRICS})
    return out


class SharedFolds:
    """Training rows whose inner folds are prepared for many choices, which are all
    evaluated when the first result is asked for."""

    def __init__(self, train: DataFrame, choices: list, spec: FeatureSpec, folds: int = 3, seed: int = SEED,
                 rare_tol: float = 0.05, workers: int = ST.AT_ONCE):
        self.choices = list(choices)
        self._work = lambda: evaluate(train, self.choices, spec, folds, seed, rare_tol, workers)
        self._found: list | None = None

    def result(self, choice: Choice) -> dict:
        if self._found is None:
            try:
                self._found = self._work()
            except DRAW_ERRORS as e:  # no draw's own error: it stops the study
                raise RuntimeError("the choices can't be evaluated") from e
        res = self._found[self.choices.index(choice)]  # equal choices have equal results
        if isinstance(res, Exception):
            raise res
        return res


def draws(family: str, n_trials: int = 20, seed: int = SEED) -> list:
    """The choices of a seeded random search, in order."""
    rng = random.Random(f"{seed}-{family}")
    return [sample_choice(family, rng) for _ in range(n_trials)]


def tune(train: DataFrame, family: str, n_trials: int = 20, spec: FeatureSpec = SALES, seed: int = SEED,
         inner_folds: int = 3, rare_tol: float = 0.05, done: list | None = None, study: "ST.Study | None" = None,
         workers: int = ST.AT_ONCE, batch: int | None = None, shared: SharedFolds | None = None) -> list:
    """Seeded random search minimising mean validation RMSE.  Trials already in
    ``study`` (or ``done``) are not run again; the random stream is replayed, so the others
    are the same draws.  ``batch`` trials (all) share prepared folds and are written together;
    ``shared``: folds of ``train`` that the searches of other families use as well."""
    finished = {t["number"]: t for t in (done or []) if t.get("state") == "COMPLETE"}
    if study is not None:
        finished |= study.finished()
    drawn = draws(family, n_trials, seed)
    open_ = [k for k in range(n_trials) if k not in finished]
    size = batch or max(1, len(open_))
    for i in range(0, len(open_), size):
        numbers, start = open_[i:i + size], time.time()
        rows = []
        held = shared or SharedFolds(train, [drawn[k] for k in numbers], spec, inner_folds, seed, rare_tol, workers)
        for k in numbers:
            row = {"number": k, "family": family, "params": json.dumps(asdict(drawn[k]), sort_keys=True), "datetime_start": start}
            try:
                res = cross_validate(held, drawn[k], spec, inner_folds, seed, rare_tol)
            except DRAW_ERRORS as e:  # a draw that can't be fitted is recorded as a failed trial
                row.update(value=None, state="FAIL", error=str(e)[:200])
            else:
                row.update(value=res["val_rmse"], state="COMPLETE", **{f"user_attrs_{m}": v for m, v in res.items()})
            row["datetime_complete"] = time.time()
            row["duration"] = (row["datetime_complete"] - start) / len(numbers)  # trials of a batch run together
            rows.append(row)
        if study is not None:
            study.append(rows)
        finished.update((r["number"], r) for r in rows)
    return [finished[k] for k in range(n_trials)]


def best_of(trials: list) -> dict:
    """A20 on the driver-side trial list (n_trials rows)."""
    ok = [t for t in trials if t.get("state") == "COMPLETE" and t.get("value") is not None]
    return min(ok, key=lambda t: (t["value"], t["number"]))


def choice_from(trial: dict) -> Choice:
    return Choice(**json.loads(trial["params"]))


def refit(train: DataFrame, ch: Choice, spec: FeatureSpec = SALES, rare_tol: float = 0.05) -> PipelineModel:
    """T4: fit the chosen pipeline on all training rows."""
    return fit_pipeline(build_pipeline(ch, spec, rare_tol), train)


def nested_cv(table: DataFrame, family: str, n_trials: int = 20, spec: FeatureSpec = SALES, outer: int = 5,
              inner: int = 3, seed: int = SEED, rare_tol: float = 0.05, folds=None, path: str | None = None,
              workers: int = ST.AT_ONCE):
    """Outer folds of the prepared table -> T1 on the outer-train rows ->
    T4 -> holdout metrics.  Returns ``(fold_rows, trial_rows)``.  With ``path``, trials
    are appended there, and those found there are not run again."""
    def one(f):
        tr = table.where(F.col("fold") != f)
        study = ST.Study(table.sparkSession, path, f"{family}-{seed}-{outer}x{inner}-{f}") if path else None
        trials = tune(tr, family, n_trials, spec, seed, inner, rare_tol, study=study, workers=workers)
        best = best_of(trials)
        model = refit(tr, choice_from(best), spec, rare_tol)
        row = {"model": family, "fold": f, "params": best["params"]}
        for s, part in (("train", tr), ("test", table.where(F.col("fold") == f))):
            row.update({f"{s}_{m}": v for m, v in _metrics(model.transform(part), spec.label).items()})
        row["val_rmse"], row["val_mae"], row["val_median_ae"] = (
            best.get("user_attrs_val_rmse"), best.get("user_attrs_val_mae"), best.get("user_attrs_val_median_ae"))
        return row, [{**t, "fold": f} for t in trials]

    done = ST.at_once(one, list(folds if folds is not None else range(outer)), min(2, workers))
    return [row for row, _ in done], [t for _, trials in done for t in trials]


def leaderboard(spark: SparkSession, fold_rows: list) -> DataFrame:
    """A18 over the fold table: mean and population std of 9 metrics."""
    metrics = [f"{s}_{m}" for s in ("train", "val", "test") for m in ("rmse", "mae", "median_ae")]
    df = spark.createDataFrame([{k: (float(r[k]) if r.get(k) is not None else None) for k in metrics}
                                | {"model": r["model"]} for r in fold_rows])
    return BL.fold_averages(df, "model", metrics)


def select_model(spark: SparkSession, table: DataFrame, families=FAMILIES, n_trials: int = 20,
                 spec: FeatureSpec = SALES, **kw):
    """T5: nested CV for every family, leaderboard, best per metric."""
    rows = []
    for fam in families:
        fr, _ = nested_cv(table, fam, n_trials, spec, **kw)
        rows += fr
    board = leaderboard(spark, rows)
    best = BL.best_per_metric(board, "model", ["avg_test_rmse", "avg_test_mae", "avg_test_median_ae"])
    return rows, board, best


def final_model(table: DataFrame, family: str, n_trials: int = 20, spec: FeatureSpec = SALES, seed: int = SEED,
                inner: int = 3, rare_tol: float = 0.05, path: str | None = None):
    """Tune on all rows, refit, optionally save."""
    trials = tune(table, family, n_trials, spec, seed, inner, rare_tol)
    model = refit(table, choice_from(best_of(trials)), spec, rare_tol)
    if path:
        save_pipeline_model(model, path)
    return model, trials


# ------------------------------------------------------------ persistence --

def save_pipeline_model(model: PipelineModel, path: str) -> None:
    """Stages are saved one by one: Spark ML stages with their own writer,
    custom stages as JSON + parquet, plus a manifest."""
    manifest = []
    for i, st in enumerate(model.stages):
        sub = os.path.join(path, f"stage{i:02d}")
        if isinstance(st, FittedStage):
            st.save(sub)
            kind = "custom"
        elif isinstance(st, AdaBoostR2Model):
            st.save(sub)
            kind = "adaboost"
        elif isinstance(st, HistBoosterModel):
            st.save(sub)
            kind = "booster"
        else:
            st.write().overwrite().save(sub)
            kind = f"{type(st).__module__}.{type(st).__name__}"
        manifest.append({"path": sub, "kind": kind})
    write_json(SparkSession.active(), os.path.join(path, "manifest.json"), manifest)


def load_pipeline_model(spark: SparkSession, path: str) -> PipelineModel:
    import importlib
    manifest = read_json(spark, os.path.join(path, "manifest.json"))
    stages = []
    for m in manifest:
        if m["kind"] == "custom":
            stages.append(load_stage(spark, m["path"]))
        elif m["kind"] == "adaboost":
            stages.append(AdaBoostR2Model.load(m["path"]))
        elif m["kind"] == "booster":
            stages.append(HistBoosterModel.load(m["path"]))
        else:
            mod, _, name = m["kind"].rpartition(".")
            stages.append(getattr(importlib.import_module(mod), name).load(m["path"]))
    return PipelineModel(stages)
