"""Fit/transform feature operators.

Every fit is one or a few aggregate jobs; every transform is a projection or
a join to a fitted dimension table.  State kept on the driver is bounded by
the number of columns (scalars per column), by ``1/tol`` (rare-label keep
lists) or by a fixed grid size (quantile transform); anything that grows with
the data (group statistics, target encodings) stays a DataFrame.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import c, nan_to_null
from ..functions.normal import ndtri_array
from ..functions.ordered import exact_quantiles, long_values, ordered_counts
from ..functions.stats import (BOUNDS_THRESHOLD, NORMAL_CLIP, anderson_darling,
                               anderson_from_ordered, column_moments, grid_quantiles, is_gaussian,
                               yeo_johnson, yeo_johnson_lambda)
from .base import FittedStage, Stage, join_dimension, materialise, written_table


# ---------------------------------------------------------------- F1 ------

def gaussian_split(df: DataFrame, cols) -> tuple[list, list, dict]:
    """``(gaussian, non_gaussian, {col: (A², critical)})`` with one
    ordered-count pass over all columns together."""
    cols = list(cols)
    res = anderson_darling(long_values(df, cols))
    gauss, non = [], []
    for col in cols:
        stat, crit = res.get(col, (None, None))
        (gauss if is_gaussian(stat, crit) else non).append(col)
    return gauss, non, res


# ---------------------------------------------------------------- F2 ------

class OutlierCapper(Stage):
    """winsorise both tails.  Non-gaussian columns: [Q1 - f·IQR, Q3 + f·IQR]
    (f = 1.5); gaussian columns: mean ± 3·std (sample std).  ``method`` =
    ``auto`` (decided by F1), ``iqr`` or ``gaussian`` for every column."""

    def __init__(self, columns, method: str = "auto", iqr_fold: float = 1.5, gaussian_fold: float = 3.0):
        super().__init__()
        self.columns, self.method = list(columns), method
        self.iqr_fold, self.gaussian_fold = iqr_fold, gaussian_fold

    def _fit(self, df):
        if self.method == "auto":
            gauss, non, _ = gaussian_split(df, self.columns)
        elif self.method == "iqr":
            gauss, non = [], list(self.columns)
        else:
            gauss, non = list(self.columns), []
        bounds = {}
        if non:
            qs = exact_quantiles(long_values(df, non), ["column"], "value", [0.25, 0.75]).collect()
            q = {(r["column"], r["p"]): r["q"] for r in qs}
            for col in non:
                if (col, 0.25) not in q:  # no value at all: nothing to cap
                    continue
                q1, q3 = q[(col, 0.25)], q[(col, 0.75)]
                iqr = q3 - q1
                bounds[col] = (q1 - self.iqr_fold * iqr, q3 + self.iqr_fold * iqr)
        if gauss:
            row = df.agg(*[F.avg(nan_to_null(c(x))).alias(f"m{i}") for i, x in enumerate(gauss)],
                         *[F.stddev_samp(nan_to_null(c(x))).alias(f"s{i}") for i, x in enumerate(gauss)]).first()
            for i, col in enumerate(gauss):
                m, s = row[f"m{i}"], row[f"s{i}"]
                bounds[col] = (m - self.gaussian_fold * s, m + self.gaussian_fold * s)
        return OutlierCapperModel(bounds, gauss, non)


class OutlierCapperModel(FittedStage):
    def __init__(self, bounds, gaussian, non_gaussian):
        super().__init__()
        self.bounds, self.gaussian, self.non_gaussian = bounds, gaussian, non_gaussian

    def _transform(self, df):
        return df.withColumns({col: F.least(F.greatest(c(col), F.lit(lo)), F.lit(hi))
                               for col, (lo, hi) in self.bounds.items()})


# ---------------------------------------------------------------- F3 ------
# The six candidate transforms, in the reference's order.
TRANSFORMS = ["logarithmic", "reciprocal", "square-root", "yeo-johnson", "square", "quantile"]


def _apply_simple(name: str, x, lam=None):
    if name == "logarithmic":
        return F.log(x)
    if name == "reciprocal":
        return F.when(x != 0, F.lit(1.0) / x)
    if name == "square-root":
        return F.sqrt(x)
    if name == "square":
        return x * x
    if name == "yeo-johnson":
        return yeo_johnson(x, lam)
    raise ValueError(name)


def _quantile_udf(grids: dict):
    """Arrow-batched interpolation of a value into its column's quantile
    grid (the quantile transform's empirical CDF), averaging the forward and
    backward interpolation so repeated quantiles map to their middle.  The
    grids are bounded (≤ 1000 points per column) and shipped with the UDF.  The result is
    Φ⁻¹ of that, clipped like the reference's transform."""
    prepared = {k: (np.asarray(v, dtype=float), np.linspace(0.0, 1.0, len(v))) for k, v in grids.items()}

    @F.pandas_udf(T.DoubleType())
    def normal(col: pd.Series, x: pd.Series) -> pd.Series:
        out = np.full(len(x), np.nan)
        xv = x.to_numpy(dtype=float, na_value=np.nan)
        for name in pd.unique(col):
            if name not in prepared:
                continue
            q, ref = prepared[name]
            m = (col == name).to_numpy()
            v = xv[m]
            r = 0.5 * (np.interp(v, q, ref) - np.interp(-v, -q[::-1], -ref[::-1]))
            r = np.where(v + BOUNDS_THRESHOLD > q[-1], 1.0, r)
            r = np.where(v - BOUNDS_THRESHOLD < q[0], 0.0, r)
            z = np.where(r <= 0, NORMAL_CLIP, -NORMAL_CLIP)  # the ends, and NaN below
            inner = (r > 0) & (r < 1)
            z[inner] = ndtri_array(r[inner])
            out[m] = np.where(np.isnan(r), np.nan, np.clip(z, NORMAL_CLIP, -NORMAL_CLIP))
        return pd.Series(out)

    return normal


class GaussianTransformer(Stage):
    """for every non-gaussian column (F1), try the six transforms and keep
    one whose transformed A² is below the 5 % critical value.

    All candidates are tested together, on one ordered-count table of the raw values: a
    candidate keeps or reverses the order of the values of one sign, so its ranks follow
    from theirs by arithmetic, and equal results need not be merged (A² adds up over the
    parts of a tie).  Only squares of a column with both signs are put in order anew.
    Choice: lowest statistic (``alphabetical=True`` reproduces the reference, which takes
    the alphabetically first passing name).
    """

    def __init__(self, columns, alphabetical: bool = False, quantiles: int = 1000):
        super().__init__()
        self.columns, self.alphabetical, self.quantiles = list(columns), alphabetical, quantiles

    def _fit(self, df):
        # One ordered count table (distinct values per column), written once, feeds
        # everything: the normality test of the raw columns, the λ search, the quantile
        # grid and the candidate tests.
        oc = materialise(ordered_counts(long_values(df, self.columns), ["column"], "value"))
        info = {r["column"]: r for r in oc.groupBy("column").agg(
            F.min("value").alias("mn"), F.max("value").alias("mx"), F.sum("cnt").alias("n"),
            F.sum(F.when(F.col("value") < 0, F.col("cnt")).otherwise(0)).alias("below")).collect()}
        raw = {r["column"]: r for r in anderson_from_ordered(oc, ["column"]).collect()}
        non = [col for col in self.columns if col in raw
               and not is_gaussian(raw[col]["statistic"], raw[col]["critical"])]
        if not non:
            return GaussianTransformerModel({}, {}, {})
        in_non = F.col("column").isin(non)
        lambdas = yeo_johnson_lambda(oc.where(in_non))
        grids = {}  # (bounded: at most 1000 points per column)
        for r in grid_quantiles(oc.where(in_non), ["column"], self.quantiles).collect():
            grids.setdefault(r["column"], []).append((r["j"], r["q"]))
        grids = {k: [q for _, q in sorted(v)] for k, v in grids.items()}
        normal = _quantile_udf(grids)

        # Every candidate of every column in ONE projection: a transform that
        # is undefined somewhere yields NULL there and is rejected below
        # (the reference's transformers refuse such columns).
        x = F.col("value")
        lam = F.create_map(*[e for k, v in lambdas.items() for e in (F.lit(k), F.lit(float(v)))])[F.col("column")]
        staged = oc.where(in_non).withColumn("_lam", lam)
        staged = staged.withColumn("_tq", normal(F.col("column"), x))
        cb, cnt, total = F.col("cum_before"), F.col("cnt"), F.col("total")
        below = F.create_map(*[e for k in non for e in (F.lit(k), F.lit(int(info[k]["below"])).cast("long"))])[F.col("column")]
        mirrored = F.when(x < 0, below - cb - cnt)  # rows below, if the order of the negative values turns
        both = [k for k in non if info[k]["mn"] < 0 < info[k]["mx"]]
        one_sign = ~F.col("column").isin(both)
        cands = {
            "logarithmic": (F.when(x > 0, F.log(x)), cb),
            "reciprocal": (F.when(x != 0, F.lit(1.0) / x), F.coalesce(mirrored, below + total - cb - cnt)),
            "square-root": (F.when(x >= 0, F.sqrt(x)), cb),
            "yeo-johnson": (yeo_johnson(x, F.col("_lam")), cb),
            "square": (F.when(one_sign, x * x), F.when(below > 0, total - cb - cnt).otherwise(cb)),
            "quantile": (F.col("_tq"), cb),
        }
        arr = F.array(*[F.struct(F.lit(name).alias("transform"), nan_to_null(e).alias("value"), before.alias("cum_before"))
                        for name, (e, before) in cands.items()])
        cand = (staged.select("column", "cnt", "total", F.explode(arr).alias("_t"))
                .select("column", "_t.transform", "_t.value", "cnt", "_t.cum_before", "total").where(F.col("value").isNotNull()))
        if both:
            squares = oc.where(F.col("column").isin(both)).select("column", F.lit("square").alias("transform"), (x * x).alias("value"), "cnt")
            cand = cand.unionByName(materialise(ordered_counts(squares, ["column", "transform"], "value", weight="cnt")))
        tests = anderson_from_ordered(cand, ["column", "transform"]).collect()
        passing = {}
        for r in tests:
            if r["counted"] != info[r["column"]]["n"]:
                continue  # undefined for some rows (log of 0, 1/0, square root of a negative)
            if r["statistic"] is not None and not math.isnan(r["statistic"]) and r["statistic"] < r["critical"]:
                passing.setdefault(r["column"], []).append((r["transform"], r["statistic"]))
        chosen = {}
        for col, opts in passing.items():
            chosen[col] = (min(opts)[0] if self.alphabetical else min(opts, key=lambda t: t[1])[0])
        used_grids = {k: grids[k] for k, v in chosen.items() if v == "quantile"}
        used_lambdas = {k: lambdas[k] for k, v in chosen.items() if v == "yeo-johnson"}
        return GaussianTransformerModel(chosen, used_lambdas, used_grids)


class GaussianTransformerModel(FittedStage):
    def __init__(self, chosen, lambdas, grids):
        super().__init__()
        self.chosen, self.lambdas, self.grids = chosen, lambdas, grids

    def _transform(self, df):
        guarded = [k for k, v in self.chosen.items() if v in ("logarithmic", "reciprocal", "square-root")]
        skip = set()
        if guarded:
            # The reference drops a column from a guarded transform when the
            # data being transformed contains values it cannot take.
            row = df.agg(*[F.sum(F.when(c(k) <= 0 if self.chosen[k] == "logarithmic"
                                         else (c(k) == 0 if self.chosen[k] == "reciprocal" else c(k) < 0), 1)
                                 .otherwise(0)).alias(f"g{i}") for i, k in enumerate(guarded)]).first()
            skip = {k for i, k in enumerate(guarded) if (row[f"g{i}"] or 0) > 0}
        out = {}
        res = df
        normal = _quantile_udf(self.grids) if self.grids else None
        for col, name in self.chosen.items():
            if col in skip:
                continue
            if name == "quantile":
                res = res.withColumn(col, normal(F.lit(col), c(col).cast("double")))
            else:
                out[col] = _apply_simple(name, c(col), self.lambdas.get(col))
        return res.withColumns(out) if out else res


# ---------------------------------------------------------------- F4 ------

class RareLabelEncoder(Stage):
    """categories whose share is below ``tol`` become ``Rare``, only for
    columns with more than ``n_categories`` distinct values; unseen values
    at transform time become ``Rare`` as well.  The keep-list of a column has
    at most ``1/tol`` entries (or ``n_categories``), so it is held as a list."""

    def __init__(self, columns, tol: float = 0.05, n_categories: int = 10, replace_with: str = "Rare"):
        super().__init__()
        self.columns, self.tol, self.n_categories, self.replace_with = list(columns), tol, n_categories, replace_with

    def _fit(self, df):
        pairs = [F.struct(F.lit(col).alias("column"), c(col).cast("string").alias("value")) for col in self.columns]
        counts = (df.select(F.explode(F.array(*pairs)).alias("kv")).select("kv.column", "kv.value")
                  .where(F.col("value").isNotNull())
                  .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
        # Per-column totals and distinct counts are a p-row table; the rows
        # kept (share >= tol, or all values of a small column) are at most
        # max(1/tol, n_categories) per column, which bounds what is collected.
        tot = counts.groupBy("column").agg(F.sum("n").alias("_tot"), F.count(F.lit(1)).alias("nu"))
        kept = (counts.join(F.broadcast(tot), ["column"])
                .where((F.col("nu") <= self.n_categories) | (F.col("n") / F.col("_tot") >= self.tol))
                .select("column", "value").collect())
        keep = {col: [] for col in self.columns}
        for r in kept:
            keep[r["column"]].append(r["value"])
        return RareLabelModel({k: sorted(v) for k, v in keep.items()}, self.replace_with)


class RareLabelModel(FittedStage):
    def __init__(self, keep, replace_with="Rare"):
        super().__init__()
        self.keep, self.replace_with = keep, replace_with

    def _transform(self, df):
        return df.withColumns({col: F.when(c(col).isin(vals), c(col)).otherwise(F.lit(self.replace_with))
                               for col, vals in self.keep.items()})


# ---------------------------------------------------------------- F5 ------
# Names of the group statistics and of the grouping suffixes.
GROUP_STATS = ("mean", "std", "median")


class GroupStatFeatures(Stage):
    """F5 = A1 + A2 + A3 fitted, J1 + J2 + J3 at transform.

    For each grouping (``ZONE`` -> suffix ``Zone``, ``Brand`` -> ``Brand``):
    mean, sample std and exact median of the continuous columns, named
    ``<col>_<stat>_<suffix>``; plus the number of distinct ``MC`` per Brand
    (``Brand_MC_nunique``).  Medians come from the ordered-count table (a
    hot group spreads over many range partitions).  Group tables are written
    to the checkpoint folder and left-joined back.
    """

    def __init__(self, continuous, groups=(("ZONE", "Zone"), ("Brand", "Brand")),
                 nunique=(("Brand", "MC", "Brand_MC_nunique"),)):
        super().__init__()
        self.continuous, self.groups, self.nunique = list(continuous), list(groups), list(nunique)

    def _fit(self, df):
        # All groupings in ONE pass: rows are unpivoted to
        # (grouping, group value, column, value); means / stds are one
        # aggregate and the medians one ordered-count pass over that table.
        groups = [k for k, _ in self.groups]
        items = [F.struct(F.lit(k).alias("grp"), c(k).cast("string").alias("gval"), F.lit(col).alias("column"),
                          nan_to_null(c(col).cast("double")).alias("value"))
                 for k in groups for col in self.continuous]
        long = (df.select(F.explode(F.array(*items)).alias("t")).select("t.*")
                .where(F.col("gval").isNotNull()))
        keys = ["grp", "gval", "column"]
        ms = long.groupBy(*keys).agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
        med = exact_quantiles(long, keys, "value", [0.5]).select(*keys, F.col("q").alias("median"))
        stats = ms.join(med, keys, "left")
        extra = []
        for key, col, name in self.nunique:
            extra.append(df.where(c(key).isNotNull()).groupBy(c(key).cast("string").alias("gval"))
                         .agg(F.countDistinct(c(col)).cast("double").alias("mean"))
                         .select(F.lit(key).alias("grp"), "gval", F.lit(name).alias("column"), "mean",
                                 F.lit(None).cast("double").alias("std"), F.lit(None).cast("double").alias("median")))
        for e in extra:
            stats = stats.unionByName(e)
        stats = written_table(stats, "group-stats")
        suffix = dict(self.groups)
        return GroupStatModel(groups, stats, self.continuous, suffix, [(k, n) for k, _, n in self.nunique])


def group_stats(df: DataFrame, key: str, cols, suffix: str) -> DataFrame:
    """``key, <col>_mean_<suffix>, <col>_std_<suffix>, <col>_median_<suffix>``."""
    base = df.where(c(key).isNotNull())
    ms = base.groupBy(c(key)).agg(*[e for col in cols for e in (
        F.avg(nan_to_null(c(col))).alias(f"{col}_mean_{suffix}"),
        F.stddev_samp(nan_to_null(c(col))).alias(f"{col}_std_{suffix}"))])
    med = exact_quantiles(long_values(base, cols, extra=[key]), [key, "column"], "value", [0.5])
    med_wide = (med.groupBy(c(key)).pivot("column", list(cols)).agg(F.first("q")))
    med_wide = med_wide.select(c(key), *[c(col).alias(f"{col}_median_{suffix}") for col in cols])
    out = ms.join(med_wide, [key], "left")
    order = [f"{col}_{s}_{suffix}" for col in cols for s in GROUP_STATS]
    return out.select(c(key), *[c(n) for n in order])


class GroupStatModel(FittedStage):
    """Holds the long statistics table (grouping, group value, column, mean,
    std, median); each grouping is pivoted to ``<col>_<stat>_<suffix>``
    columns and left-joined on its key."""

    _frames = ("stats",)

    def __init__(self, keys, stats, continuous, suffix, nunique):
        super().__init__()
        self.keys, self.stats = keys, stats
        self.continuous, self.suffix, self.nunique = continuous, suffix, nunique

    def _dimension(self, key):
        sub = self.stats.where(F.col("grp") == key)
        aggs = []
        for col in self.continuous:
            for st in GROUP_STATS:
                aggs.append(F.max(F.when(F.col("column") == col, F.col(st))).alias(f"{col}_{st}_{self.suffix[key]}"))
        for k, name in self.nunique:
            if k == key:
                aggs.append(F.max(F.when(F.col("column") == name, F.col("mean"))).cast("long").alias(name))
        return sub.groupBy(F.col("gval").alias(key)).agg(*aggs)

    def _transform(self, df):
        out = df
        for key in self.keys:
            dim = self._dimension(key)
            out = join_dimension(out.withColumn("_gk", c(key).cast("string")),
                                 dim.withColumnRenamed(key, "_gk"), ["_gk"]).drop("_gk")
        return out


# ---------------------------------------------------------------- F6 ------

class IntervalEncoder(Stage):
    """``year - origin`` (fixed origin, nothing learnt)."""

    def __init__(self, column: str = "Fdate_year", origin: int = 2017):
        super().__init__()
        self.column, self.origin = column, origin

    def _fit(self, df):
        return IntervalModel(self.column, self.origin)


class IntervalModel(FittedStage):
    def __init__(self, column, origin):
        super().__init__()
        self.column, self.origin = column, origin

    def _transform(self, df):
        return df.withColumn(self.column, c(self.column) - F.lit(self.origin))


# ---------------------------------------------------------------- F7 ------

class TargetEncoder(Stage):
    """smoothed target mean per category, ``(Σy + a·ȳ)/(n + a)`` with
    a = 1; unseen and missing categories get ȳ.  Columns whose encoded
    variance on the fitting data is at most 1e-4 are dropped
    (``drop_invariant``).  Per-category sums are a DataFrame joined back."""

    def __init__(self, columns, label: str = "SP", a: float = 1.0, drop_invariant: bool = True):
        super().__init__()
        self.columns, self.label, self.a, self.drop_invariant = list(columns), label, a, drop_invariant

    def _fit(self, df):
        y = nan_to_null(c(self.label))
        # job 1: prior and NULL counts per column
        head = df.agg(F.avg(y).alias("m"), *[F.sum(F.when(c(col).isNull(), 1).otherwise(0)).alias(f"z{i}")
                                              for i, col in enumerate(self.columns)]).first()
        prior = head["m"]
        pairs = [F.struct(F.lit(col).alias("column"), c(col).cast("string").alias("category")) for col in self.columns]
        stats = (df.select(y.alias("_y"), F.explode(F.array(*pairs)).alias("kv"))
                 .select("kv.column", "kv.category", "_y")
                 .where(F.col("category").isNotNull())
                 .groupBy("column", "category")
                 .agg(F.sum("_y").alias("sum_y"), F.count("_y").alias("n")))
        # job 2: the per-category table, written once
        stats = written_table(stats.withColumn(
            "enc", (F.col("sum_y") + F.lit(self.a * prior)) / (F.col("n") + F.lit(self.a))), "target-encoding")
        # job 3: the encoded variance per column (n_k rows
        # share the value e_k; NULL categories are encoded with the prior)
        v = (stats.groupBy("column").agg(
            F.count(F.lit(1)).alias("k"), F.sum("n").alias("N"), F.sum(F.col("n") * F.col("enc")).alias("s1"),
            F.sum(F.col("n") * F.col("enc") * F.col("enc")).alias("s2")).collect())
        drop = []
        if self.drop_invariant:
            seen = set()
            for r in v:
                seen.add(r["column"])
                z = head[f"z{self.columns.index(r['column'])}"] or 0
                n = r["N"] + z
                s1 = r["s1"] + z * prior
                s2 = r["s2"] + z * prior * prior
                var = (s2 - s1 * s1 / n) / (n - 1) if n > 1 else 0.0
                if var <= 10e-5:
                    drop.append(r["column"])
            drop += [col for col in self.columns if col not in seen]
        return TargetEncoderModel(self.columns, prior, drop, stats)


class TargetEncoderModel(FittedStage):
    _frames = ("stats",)

    def __init__(self, columns, prior, drop, stats):
        super().__init__()
        self.columns, self.prior, self.drop, self.stats = columns, prior, drop, stats

    def _transform(self, df):
        out = df
        for col in self.columns:
            if col in self.drop:
                continue
            dim = (self.stats.where(F.col("column") == col)
                   .select(F.col("category").alias("_cat"), F.col("enc").alias("_enc")))
            out = (join_dimension(out.withColumn("_cat", c(col).cast("string")), dim, ["_cat"])
                   .withColumn(col, F.coalesce(F.col("_enc"), F.lit(self.prior))).drop("_cat", "_enc"))
        return out.drop(*[d for d in self.drop if d in out.columns])


# ---------------------------------------------------------------- P11 -----

class CyclicalEncoder(Stage):
    """``<col>_sin``/``<col>_cos`` = sin/cos(2π·x / max), max learnt in
    fit; originals dropped."""

    def __init__(self, columns, drop_original: bool = True):
        super().__init__()
        self.columns, self.drop_original = list(columns), drop_original

    def _fit(self, df):
        row = df.agg(*[F.max(c(col)).alias(f"m{i}") for i, col in enumerate(self.columns)]).first()
        return CyclicalModel({col: float(row[f"m{i}"]) for i, col in enumerate(self.columns)}, self.drop_original)


class CyclicalModel(FittedStage):
    def __init__(self, max_values, drop_original=True):
        super().__init__()
        self.max_values, self.drop_original = max_values, drop_original

    def _transform(self, df):
        new = {}
        for col, m in self.max_values.items():
            ang = c(col) * F.lit(2 * math.pi / m)
            new[f"{col}_sin"], new[f"{col}_cos"] = F.sin(ang), F.cos(ang)
        out = df.withColumns(new)
        return out.drop(*self.max_values) if self.drop_original else out


# ---------------------------------------------------------------- P12 -----

class OneHotEncoder(Stage):
    """One 0/1 column ``<col>_<category>`` per category seen in fit (no
    drop-last, no limit); unseen -> all zeros; originals dropped.  The categories
    are the names of the result's columns, so the driver holds them; with very
    many, group the rare ones first (F4)."""

    def __init__(self, columns):
        super().__init__()
        self.columns = list(columns)

    def _fit(self, df):
        pairs = [F.struct(F.lit(col).alias("column"), c(col).cast("string").alias("value")) for col in self.columns]
        rows = (df.select(F.explode(F.array(*pairs)).alias("kv")).select("kv.column", "kv.value")
                .where(F.col("value").isNotNull()).distinct().collect())
        cats = {col: [] for col in self.columns}
        for r in rows:
            cats[r["column"]].append(r["value"])
        return OneHotModel({k: sorted(v) for k, v in cats.items()})


class OneHotModel(FittedStage):
    def __init__(self, categories):
        super().__init__()
        self.categories = categories

    def _transform(self, df):
        new = {f"{col}_{v}": (c(col) == F.lit(v)).cast("int") for col, vals in self.categories.items() for v in vals}
        new = {k: F.coalesce(e, F.lit(0)) for k, e in new.items()}
        return df.withColumns(new).drop(*self.categories)


# ---------------------------------------------------------------- F8 ------

class Scaler(Stage):
    """F8: ``standard`` ((x-μ)/σ, population σ, σ=0 -> 1), ``minmax``
    ((x-min)/(max-min), constant -> 0), ``robust`` ((x-median)/IQR, exact
    quartiles, IQR=0 -> 1), ``combine`` (standard on F1-gaussian columns,
    min-max on the rest).  Column order is kept; a column without values passes through."""

    def __init__(self, method: str = "standard", columns=None, exclude=()):
        super().__init__()
        self.method, self.columns, self.exclude = method.lower(), columns, set(exclude)

    def _fit(self, df):
        cols = self.columns or [n for n, t in df.dtypes
                                if t in ("double", "int", "bigint", "float") and n not in self.exclude]
        params = {}
        if self.method == "combine":
            gauss, non, _ = gaussian_split(df, cols)
            params.update(_standard(df, gauss))
            params.update(_minmax(df, non))
        elif self.method == "standard":
            params = _standard(df, cols)
        elif self.method == "minmax":
            params = _minmax(df, cols)
        elif self.method == "robust":
            qs = exact_quantiles(long_values(df, cols), ["column"], "value", [0.25, 0.5, 0.75]).collect()
            q = {(r["column"], r["p"]): r["q"] for r in qs}
            for col in cols:
                if (col, 0.5) not in q:  # no value at all: nothing to scale by
                    continue
                iqr = q[(col, 0.75)] - q[(col, 0.25)]
                params[col] = (q[(col, 0.5)], iqr if iqr != 0 else 1.0)
        else:
            raise ValueError(self.method)
        return ScalerModel(params)


def _standard(df, cols):
    if not cols:
        return {}
    found = zip(cols, column_moments(df, [c(x) for x in cols]))
    return {x: (o["mean"], o["sd"] if o["sd"] else 1.0) for x, o in found if o["mean"] is not None}


def _minmax(df, cols):
    if not cols:
        return {}
    row = df.agg(*[F.min(c(x)).alias(f"a{i}") for i, x in enumerate(cols)],
                 *[F.max(c(x)).alias(f"b{i}") for i, x in enumerate(cols)]).first()
    out = {}
    for i, x in enumerate(cols):
        if row[f"a{i}"] is None:
            continue
        rng = row[f"b{i}"] - row[f"a{i}"]
        out[x] = (row[f"a{i}"], rng if rng != 0 else 1.0)
    return out


class ScalerModel(FittedStage):
    def __init__(self, scales):
        super().__init__()
        self.scales = scales

    def _transform(self, df):
        return df.withColumns({col: (c(col) - F.lit(float(a))) / F.lit(float(s))
                               for col, (a, s) in self.scales.items()})


def quantile_normal_model(df: DataFrame, cols, quantiles: int = 1000) -> "GaussianTransformerModel":
    """F3f on its own: every column mapped through its empirical CDF
    (exact ``linspace(0, 1, K)`` quantile grid, K = min(1000, n)) then Φ⁻¹."""
    cols = list(cols)
    counts = long_values(df, cols).where(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("cnt"))
    oc = ordered_counts(counts, ["column"], "value", weight="cnt")
    grids = {}
    for r in grid_quantiles(oc, ["column"], quantiles).collect():
        grids.setdefault(r["column"], []).append((r["j"], r["q"]))
    grids = {k: [q for _, q in sorted(v)] for k, v in grids.items()}
    return GaussianTransformerModel({k: "quantile" for k in cols}, {}, grids)
