"""Distribution statistics built on the ordered-count table.

* Anderson-Darling normality statistic (F1),
* moments of a count table,
* an even quantile grid (F3f) computed arithmetically from the ranks,
* Yeo-Johnson expression and its λ by maximum likelihood (F3d).
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import c
from .normal import with_log_ndtr_pair
from .ordered import ordered_counts

# Anderson-Darling critical values for the normal case with
# estimated mean and variance (significance 15, 10, 5, 2.5, 1 %).  The
# statistic is compared with the 5 % entry after the small-sample correction
# value / (1 + 4/n - 25/n^2).
AD_NORMAL_CRITICAL = [0.576, 0.656, 0.787, 0.918, 1.092]
AD_LEVEL_INDEX = 2


def moments(oc: DataFrame, keys, value: str = "value") -> DataFrame:
    """``keys, n, mean, std`` (sample std) of a ``(keys, value, cnt)`` table.
    Two passes (mean, then squared deviations) for numerical stability."""
    keys = list(keys)
    m = oc.groupBy(*[c(k) for k in keys]).agg(
        F.sum("cnt").alias("n"), (F.sum(F.col("cnt") * c(value)) / F.sum("cnt")).alias("mean"))
    dev = (oc.join(F.broadcast(m), keys)
           .groupBy(*[c(k) for k in keys])
           .agg(F.first("n").alias("n"), F.first("mean").alias("mean"),
                F.sum(F.col("cnt") * (c(value) - F.col("mean")) ** 2).alias("_ss")))
    return dev.select(*[c(k) for k in keys], "n", "mean",
                      F.when(F.col("n") > 1, F.sqrt(F.col("_ss") / (F.col("n") - 1))).alias("std"))


# -- moments of many columns ----------------------------------------------
# One aggregate with a few expressions per column is generated as one method, which the JVM
# no longer compiles for some dozens of columns; tasks add up Arrow batches instead.

def _taken(x: np.ndarray, valid: np.ndarray, skip: str) -> np.ndarray:
    return valid if skip == "null" else valid & ~np.isnan(x) if skip == "nan" else valid & np.isfinite(x)


def _columns(batch: pa.RecordBatch, skip: str):
    for col in batch.columns:
        x = col.to_numpy(zero_copy_only=False)
        yield x, _taken(x, col.is_valid().to_numpy(zero_copy_only=False), skip)


def _first_sums(batches, p: int, skip: str):
    rows, n, s, lo, hi = 0, np.zeros(p), np.zeros(p), np.full(p, np.inf), np.full(p, -np.inf)
    for batch in batches:
        rows += batch.num_rows
        for i, (x, m) in enumerate(_columns(batch, skip)):
            v = x[m]
            if len(v):
                n[i], s[i], lo[i], hi[i] = n[i] + len(v), s[i] + v.sum(), min(lo[i], v.min()), max(hi[i], v.max())
    yield pa.RecordBatch.from_pydict({"i": np.arange(p), "rows": np.full(p, float(rows)), "n": n, "s": s, "lo": lo, "hi": hi})


def _second_sums(batches, p: int, skip: str, shift: np.ndarray):
    held = np.zeros((p, 8))
    with np.errstate(all="ignore"):
        for batch in batches:
            pairs = list(_columns(batch, skip))
            y, my = pairs[-1]
            for i, (x, m) in enumerate(pairs):
                d = x[m] - shift[i]
                held[i, :2] += (d.sum(), d @ d)
                both = m & my
                d, e = x[both] - shift[i], y[both] - shift[-1]
                held[i, 2:] += (len(d), d.sum(), d @ d, e.sum(), e @ e, d @ e)
    yield pa.RecordBatch.from_pydict({"i": np.arange(p)} | {f"h{k}": held[:, k] for k in range(8)})


def column_moments(df: DataFrame, columns, skip: str = "null", spread: bool = True) -> list[dict]:
    """For each column ``rows`` (of the table), ``n``, ``mean`` and, with ``spread``, ``sd`` (population) and
    ``r`` (correlation with the last column over the rows that have both), in one pass for the
    means and one about them.  ``skip``: ``null``, ``nan`` (also NaN) or ``nonfinite`` (also
    infinities) don't count.  A column of equal values has an ``sd`` of exactly 0."""
    p = len(columns)
    rows = df.select(*[col.cast("double").alias(f"x{i}") for i, col in enumerate(columns)])
    first = (rows.mapInArrow(lambda b: _first_sums(b, p, skip), "i long, rows double, n double, s double, lo double, hi double")
             .groupBy("i").agg(F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect())
    out = [{"rows": 0, "n": 0, "mean": None, "sd": None, "r": None} for _ in range(p)]
    for r in first:
        n = int(r["n"])
        out[r["i"]].update(rows=int(r["rows"]), n=n, mean=r["s"] / n if n else None, constant=r["lo"] == r["hi"])
    if not spread:
        return out
    shift = np.array([o["mean"] if o["mean"] is not None and math.isfinite(o["mean"]) else 0.0 for o in out])
    second = (rows.mapInArrow(lambda b: _second_sums(b, p, skip, shift), "i long, " + ", ".join(f"h{k} double" for k in range(8)))
              .groupBy("i").agg(*[F.sum(f"h{k}").alias(f"h{k}") for k in range(8)]).collect())
    for r in second:
        o = out[r["i"]]
        if not o["n"]:
            continue
        d, dd, m, pd, pdd, pe, pee, pde = (r[f"h{k}"] for k in range(8))
        if o["constant"]:
            o["sd"] = 0.0
            continue
        o["sd"] = _root((dd - d * d / o["n"]) / o["n"])
        if m > 1:
            scale = _root(pdd - pd * pd / m) * _root(pee - pe * pe / m)
            o["r"] = (pde - pd * pe / m) / scale if scale else None
    return out


def _root(v: float) -> float:
    return math.nan if math.isnan(v) else math.sqrt(max(0.0, v))


def anderson_from_ordered(oc: DataFrame, keys, value: str = "value") -> DataFrame:
    """A² per key from an ordered-count table (``cnt, cum_before, total``).

    With ranks i = cb+1 .. cb+k for a distinct value of multiplicity k,
    A² = -N - (1/N) Σ_i [(2i-1) ln Φ(w_i) + (2N+1-2i) ln(1-Φ(w_i))], and the
    sum over a tie block is closed form, so ONE aggregate gives the statistic.  ``counted``
    is the number of rows that the table holds of the ``n``.
    """
    keys = list(keys)
    mom = moments(oc, keys, value)
    j = oc.join(F.broadcast(mom), keys)
    w = F.when(F.col("std") > 0, (c(value) - F.col("mean")) / F.col("std"))
    j = with_log_ndtr_pair(j, w, "_lphi", "_lphic")
    k = F.col("cnt").cast("double")
    cb = F.col("cum_before").cast("double")
    n = F.col("total").cast("double")
    term = F.col("_lphi") * k * (2 * cb + k) + F.col("_lphic") * k * (2 * n - 2 * cb - k)
    agg = j.groupBy(*[c(k_) for k_ in keys]).agg(F.first("total").alias("n"), F.sum("cnt").alias("counted"), F.sum(term).alias("_s"))
    nn = F.col("n").cast("double")
    crit = F.lit(AD_NORMAL_CRITICAL[AD_LEVEL_INDEX]) / (1 + 4 / nn - 25 / (nn * nn))
    return agg.select(*[c(k_) for k_ in keys], "n", "counted",
                      (-nn - F.col("_s") / nn).alias("statistic"), crit.alias("critical"))


def anderson_darling(long_df: DataFrame, keys=("column",), value: str = "value",
                     weight: str | None = None) -> dict:
    """{key: (statistic, critical_5pct)} for a long ``(keys, value)`` table."""
    from ..session import cut_lineage
    # written once: the three aggregates below read it instead of
    # recomputing the range-partitioned counts
    oc = cut_lineage(ordered_counts(long_df, keys, value, weight=weight))
    rows = anderson_from_ordered(oc, keys, value).collect()
    out = {}
    for r in rows:
        key = tuple(r[k] for k in keys)
        out[key[0] if len(key) == 1 else key] = (r["statistic"], r["critical"])
    return out


def is_gaussian(stat, critical) -> bool:
    """The reference calls a column non-gaussian when A² > critical; a NaN
    statistic (constant column) therefore counts as gaussian."""
    if stat is None or (isinstance(stat, float) and math.isnan(stat)):
        return True
    return not stat > critical


def grid_quantiles(oc: DataFrame, keys, k: int = 1000, value: str = "value") -> DataFrame:
    """Quantiles at ``linspace(0, 1, K)`` with K = min(k, n) per key, exact,
    linear interpolation.  Each distinct value emits only the grid indices
    whose interpolation ranks it covers (integer arithmetic, no probe list)."""
    keys = list(keys)
    n = F.col("total")
    kk = F.least(F.lit(k).cast("long"), n)
    m1 = kk - 1  # K - 1
    n1 = F.greatest(n - 1, F.lit(1))  # N - 1
    cb = F.col("cum_before")
    hi_rank = cb + F.col("cnt") - 1

    def ceil_div(a, b):
        return F.floor((a + b - 1) / b).cast("long")

    # j with floor(j*(N-1)/(K-1)) in [lo_r, hi_r]  <=>  j*(N-1) in [lo_r*(K-1), (hi_r+1)*(K-1) - 1]
    def j_range(lo_r, hi_r):
        j_lo = ceil_div(lo_r * m1, n1)
        j_hi = F.floor(((hi_r + 1) * m1 - 1) / n1).cast("long")
        # K = 1 (a single row): only grid point 0, held by rank 0
        j_hi = F.when(m1 == 0, F.when((lo_r <= 0) & (hi_r >= 0), F.lit(0)).otherwise(F.lit(-1))).otherwise(j_hi)
        return F.greatest(j_lo, F.lit(0)), F.least(j_hi, m1)

    lo_a, lo_b = j_range(cb, hi_rank)           # value is the lower neighbour
    hi_a, hi_b = j_range(cb - 1, hi_rank - 1)   # value is the upper neighbour
    base = oc.select(*[c(x) for x in keys], c(value).alias("_v"), n.alias("_n"), kk.alias("_k"),
                     lo_a.alias("_la"), lo_b.alias("_lb"), hi_a.alias("_ha"), hi_b.alias("_hb"))
    lows = (base.where(F.col("_la") <= F.col("_lb"))
            .select(*[c(x) for x in keys], "_v", "_n", "_k",
                    F.explode(F.sequence("_la", "_lb")).alias("j"), F.lit(True).alias("_is_lo")))
    highs = (base.where((F.col("_ha") <= F.col("_hb")))
             .select(*[c(x) for x in keys], "_v", "_n", "_k",
                     F.explode(F.sequence("_ha", "_hb")).alias("j"), F.lit(False).alias("_is_lo")))
    both = lows.unionByName(highs)
    agg = both.groupBy(*[c(x) for x in keys], "j").agg(
        F.max(F.when(F.col("_is_lo"), F.col("_v"))).alias("_lo"),
        F.max(F.when(~F.col("_is_lo"), F.col("_v"))).alias("_hi"),
        F.first("_n").alias("_n"), F.first("_k").alias("_k"))
    h = F.when(F.col("_k") > 1, F.col("j") * (F.col("_n") - 1) / (F.col("_k") - 1)).otherwise(F.lit(0.0))
    frac = h - F.floor(h)
    hi_v = F.coalesce(F.col("_hi"), F.col("_lo"))
    return agg.select(*[c(x) for x in keys], "j",
                      (F.col("_lo") + frac * (hi_v - F.col("_lo"))).alias("q"))


# -- Yeo-Johnson ------------------------------------------------------------

def yeo_johnson(x: Column, lam: Column | float) -> Column:
    lam = lam if isinstance(lam, Column) else F.lit(float(lam))
    pos = F.when(F.abs(lam) < 1e-12, F.log1p(x)).otherwise((F.pow(x + 1, lam) - 1) / lam)
    two = F.lit(2.0) - lam
    neg = F.when(F.abs(two) < 1e-12, -F.log1p(-x)).otherwise(-(F.pow(1 - x, two) - 1) / two)
    return F.when(x >= 0, pos).otherwise(neg)


def _yeo_johnson_values(x: np.ndarray, lam: float) -> np.ndarray:
    out, up = np.empty_like(x), x >= 0
    high, low, two = np.log1p(x[up]), np.log1p(-x[~up]), 2.0 - lam
    out[up] = high if abs(lam) < 1e-12 else np.expm1(lam * high) / lam
    out[~up] = -low if abs(two) < 1e-12 else -np.expm1(two * low) / two
    return out


def _likelihood_sums(batches, about: list, offsets: list):
    """Sums and sums of squares of y - y(x̄) per key and λ = centre + offset; ``about`` holds
    each key's centre and x̄."""
    held = np.zeros((len(about), len(offsets), 2))
    seen: set = set()
    with np.errstate(all="ignore"):  # an overflow's sum is not finite, and its λ not taken
        for batch in batches:
            keys, xs, counts = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            for k in np.unique(keys):
                seen.add(int(k))
                x, cnt = xs[keys == k], counts[keys == k]
                centre, mean = about[k]
                for j, off in enumerate(offsets):
                    y = _yeo_johnson_values(x, centre + off) - _yeo_johnson_values(np.array([mean]), centre + off)
                    held[k, j] += (cnt @ y, cnt @ (y * y))
    for k in seen:
        m = len(offsets)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(m, k)), pa.array(np.arange(m)), pa.array(held[k, :, 0]), pa.array(held[k, :, 1])],
                                         names=["_key", "_off", "s", "q"])


def yeo_johnson_lambda(counts: DataFrame, keys=("column",), value: str = "value",
                       rounds=((-3.0, 3.0, 0.25), (0.25, 0.025), (0.025, 0.0025), (0.0025, 0.00025))) -> dict:
    """λ maximising the Yeo-Johnson profile log-likelihood
    -n/2 ln var(y_λ) + (λ-1) Σ sign(x) ln(1+|x|), per key.

    Each round evaluates its candidate λ grid in ONE aggregate over the
    count table (``keys, value, cnt``): each task adds its Arrow batches up to two sums per
    (key, λ), so it ships one row per (key, λ).  Later rounds refine around the
    best λ.  While a key's best λ lies at an end of the grid, its grid moves
    there and the round is repeated, so λ isn't bound to the first range.
    Sums are taken about y(x̄) for numerical stability.
    """
    keys = list(keys)
    x = c(value)
    cnt = F.col("cnt")
    base = counts.groupBy(*[c(k) for k in keys]).agg(
        F.sum(cnt).alias("_n"),
        F.sum(cnt * F.signum(x) * F.log1p(F.abs(x))).alias("_slog"),
        (F.sum(cnt * x) / F.sum(cnt)).alias("_xbar"))
    base_rows = {tuple(r[k] for k in keys): r for r in base.collect()}
    centers = {key: 0.0 for key in base_rows}
    reached = {key: -math.inf for key in base_rows}
    todo = []
    for spec in rounds:
        if len(spec) == 3:
            lo, hi, step = spec
            offsets = [lo + i * step for i in range(int(round((hi - lo) / step)) + 1)]
        else:
            half, step = spec
            m = int(round(half / step))
            offsets = [i * step for i in range(-m, m + 1)]
        todo.append((offsets, None))
    while todo:
        offsets, only = todo.pop(0)
        active = [key for key in centers if only is None or key in only]
        if not active:
            continue
        cen = counts.sparkSession.createDataFrame([(*key, i) for i, key in enumerate(active)], [*keys, "_key"])
        about = [(float(centers[key]), float(base_rows[key]["_xbar"])) for key in active]
        res = (counts.where(x.isNotNull()).join(F.broadcast(cen), keys).select("_key", x.cast("double").alias("_x"), cnt.cast("double").alias("_cnt"))
               .mapInArrow(lambda batches, about=about, offsets=offsets: _likelihood_sums(batches, about, offsets), "_key long, _off long, s double, q double")
               .groupBy("_key", "_off").agg(F.sum("s").alias("s"), F.sum("q").alias("q")).orderBy("_key", "_off").collect())
        best = {key: (centers[key], -math.inf, 0.0) for key in active}
        for r in res:
            key, off = active[r["_key"]], offsets[r["_off"]]
            lam, n, slog = centers[key] + off, base_rows[key]["_n"], base_rows[key]["_slog"]
            if r["s"] is None or r["q"] is None:
                continue
            mean = r["s"] / n
            var = r["q"] / n - mean * mean
            if not var > 0 or not math.isfinite(var):
                continue
            llf = -n / 2.0 * math.log(var) + (lam - 1) * slog
            if llf > best[key][1]:
                best[key] = (lam, llf, off)
        ends = set()
        for key, (lam_best, llf, off) in best.items():
            better = llf > reached[key] + 1e-9 * abs(reached[key]) if math.isfinite(reached[key]) else math.isfinite(llf)
            if llf >= reached[key]:
                centers[key], reached[key] = lam_best, llf
            if better and off in (offsets[0], offsets[-1]):
                ends.add(key)
        if ends:
            todo.insert(0, (offsets, ends))
    return {k[0] if len(k) == 1 else k: v for k, v in centers.items()}


# -- quantile -> normal ----------------------------------------------------
BOUNDS_THRESHOLD = 1e-7
_EPS = 2.220446049250313e-16
NORMAL_CLIP = NormalDist().inv_cdf(BOUNDS_THRESHOLD - _EPS)
