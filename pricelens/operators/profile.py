"""Column profiling.

Every multi-column profile is ONE aggregation over an unpivoted
``(column, value)`` table, never one job per column.  Order statistics use the
ordered-count table (``functions.ordered``) so that no global window or exact
``percentile`` buffer holds a whole column in one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import c, nan_to_null
from ..functions.ordered import (average_rank_table, exact_quantiles, long_values,
                                 ordered_counts)
from ..session import cut_lineage
from .base import join_dimension, written_table


def _long_text(df: DataFrame, cols) -> DataFrame:
    pairs = [F.struct(F.lit(n).alias("column"), c(n).cast("string").alias("value")) for n in cols]
    return df.select(F.explode(F.array(*pairs)).alias("kv")).select("kv.column", "kv.value")


# -- A4 ----------------------------------------------------------------------

def column_info(df: DataFrame) -> DataFrame:
    """A4: ``name, non_nulls, type`` -- one aggregate, then unpivot."""
    cols = df.columns
    counts = df.agg(*[F.count(c(n)).alias(f"_{i}") for i, n in enumerate(cols)])
    types = dict(df.dtypes)
    stacked = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"_{i}").alias("non_nulls"),
                                           F.lit(types[n]).alias("type")) for i, n in enumerate(cols)]))
    return counts.select(stacked.alias("r")).select("r.name", "r.non_nulls", "r.type")


# -- A5 ----------------------------------------------------------------------

def numeric_summary(df: DataFrame, cols) -> DataFrame:
    """A5: ``variable, count, mean, std, min, 25%, 50%, 75%, max`` (exact,
    linearly interpolated quartiles)."""
    long = long_values(df, cols)
    mom = long.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    q = exact_quantiles(long, ["column"], "value", [0.25, 0.5, 0.75])
    qw = q.groupBy("column").pivot("p", [0.25, 0.5, 0.75]).agg(F.first("q"))
    qw = qw.select("column", *[F.col(f"`{p}`").alias(n) for p, n in ((0.25, "25%"), (0.5, "50%"), (0.75, "75%"))])
    return (mom.join(qw, ["column"])
            .select(F.col("column").alias("variable"), "count", "mean", "std", "min", c("25%"), c("50%"),
                    c("75%"), "max"))


# -- A6 ----------------------------------------------------------------------

def distinct_counts(df: DataFrame, cols=None) -> DataFrame:
    """``Variable, Number`` (NULLs not counted)."""
    cols = cols or df.columns
    return (_long_text(df, cols).where(F.col("value").isNotNull()).distinct()
            .groupBy(F.col("column").alias("Variable")).agg(F.count(F.lit(1)).alias("Number")))


# -- A7 / A8 -----------------------------------------------------------------

def profile_columns(df: DataFrame) -> list:
    """Columns the reference value-counts: text columns and date parts."""
    return [n for n, t in df.dtypes if t == "string" or "Fdate" in n]


def value_counts(df: DataFrame, cols) -> DataFrame:
    """``column, value, count`` per category, missing skipped (sorted by
    column, descending count, value)."""
    return (_long_text(df, cols).where(F.col("value").isNotNull())
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
            .orderBy("column", F.desc("count"), "value"))


def category_shares(df: DataFrame, cols, max_distinct: int = 50) -> DataFrame:
    """``column, value, count, share`` (percent of all rows of the
    table), for columns with fewer than ``max_distinct`` categories."""
    vc = (_long_text(df, cols).where(F.col("value").isNotNull())
          .groupBy("column", "value").agg(F.count(F.lit(1)).alias("count")))
    n_rows = df.count()
    per_col = vc.groupBy("column").agg(F.count(F.lit(1)).alias("_nu"))
    return (vc.join(F.broadcast(per_col), ["column"]).where(F.col("_nu") < max_distinct)
            .select("column", "value", "count", (F.col("count") / F.lit(float(n_rows)) * 100).alias("share")))


# -- A9 / A10 ----------------------------------------------------------------

def _box(long: DataFrame, keys, whis: float = 1.5) -> DataFrame:
    q = exact_quantiles(long, keys, "value", [0.25, 0.5, 0.75])
    qw = (q.groupBy(*keys).pivot("p", [0.25, 0.5, 0.75]).agg(F.first("q"))
          .select(*keys, F.col("`0.25`").alias("q1"), F.col("`0.5`").alias("median"), F.col("`0.75`").alias("q3")))
    qw = qw.withColumn("iqr", F.col("q3") - F.col("q1")).withColumns({
        "_lo": F.col("q1") - whis * F.col("iqr"), "_hi": F.col("q3") + whis * F.col("iqr")})
    j = join_dimension(long.where(F.col("value").isNotNull()), written_table(qw, "quartiles"), keys, how="inner")
    inside = (F.col("value") >= F.col("_lo")) & (F.col("value") <= F.col("_hi"))
    return j.groupBy(*keys).agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.first("iqr").alias("iqr"),
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(1)).alias("outliers"),
        F.count(F.lit(1)).alias("n"))


def box_by_category(df: DataFrame, cat_cols, target: str = "SP", max_distinct: int = 50) -> DataFrame:
    """Box statistics of ``target`` per category of each small category
    column: ``column, category, q1, median, q3, iqr, whisker_low,
    whisker_high, outliers, n``."""
    nun = {r["Variable"]: r["Number"] for r in distinct_counts(df, cat_cols).collect()}
    small = [n for n in cat_cols if nun.get(n, 0) < max_distinct]
    pairs = [F.struct(F.lit(n).alias("column"), c(n).cast("string").alias("category")) for n in small]
    long = (df.select(nan_to_null(c(target)).alias("value"), F.explode(F.array(*pairs)).alias("kv"))
            .select("kv.column", "kv.category", "value").where(F.col("category").isNotNull()))
    return _box(long, ["column", "category"])


def box_by_column(df: DataFrame, cols) -> DataFrame:
    """A10: the same statistics per numeric column."""
    return _box(long_values(df, cols), ["column"])


# -- A11 ---------------------------------------------------------------------

def skewness(df: DataFrame, cols) -> DataFrame:
    """Bias-corrected sample skewness G1 = g1·sqrt(n(n-1))/(n-2)."""
    long = long_values(df, cols)
    n = F.count("value")
    g1 = F.skewness("value")
    return long.groupBy("column").agg(
        F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2)).alias("skewness"), n.alias("n"))


# -- A12 ---------------------------------------------------------------------

#: Values of a column that a task of the kernel sums holds before it adds them up.
KERNEL_HELD = 1 << 20


def _kernel_sums(batches: Iterator[pa.RecordBatch], spans: list, grid: int) -> Iterator[pa.RecordBatch]:
    """This task's share of the kernel sums: one vector of ``grid`` numbers per column, whose
    (h, lo, step) ``spans`` holds; equal values are counted among those held."""
    total = np.zeros((len(spans), grid))
    held: list[list] = [[] for _ in spans]

    def add(i: int) -> None:
        h, lo, step = spans[i]
        points = lo + np.arange(grid) * step
        values, counts = np.unique(np.concatenate(held[i]), return_counts=True)
        held[i] = []
        for at in range(0, len(values), 1024):
            z = (points[:, None] - values[None, at:at + 1024]) / h
            total[i] += np.exp(-0.5 * z * z) @ counts[at:at + 1024].astype(float)

    for batch in batches:
        for i, col in enumerate(batch.columns):
            held[i].append(col.drop_null().to_numpy(zero_copy_only=False))
            if sum(map(len, held[i])) >= KERNEL_HELD:
                add(i)
    for i in range(len(spans)):
        if held[i]:
            add(i)
        yield pa.RecordBatch.from_pydict({"i": np.full(grid, i), "point": np.arange(grid, dtype=np.int32), "s": total[i]})


def kernel_density(df: DataFrame, cols, grid: int = 500) -> DataFrame:
    """Gaussian KDE (Scott bandwidth h = σ·n^(-1/5)) on ``grid`` evenly
    spaced points between each column's min and max.

    No cross join and no cutoff: each task adds all of its values to one vector of ``grid``
    sums per column, and the vectors are added up per grid point.  A task holds a bounded
    number of values, whatever their number and that of the distinct ones.
    Returns ``column, point, x, density, density_scaled`` where
    ``density_scaled = density·(max-min)``.
    """
    cols = list(cols)
    long = long_values(df, cols).where(F.col("value").isNotNull())
    st = long.groupBy("column").agg(F.count("value").alias("n"), F.stddev_samp("value").alias("sd"),
                                     F.min("value").alias("lo"), F.max("value").alias("hi"))
    st = st.select("*", (F.col("sd") * F.pow(F.col("n").cast("double"), -0.2)).alias("h"),
                   ((F.col("hi") - F.col("lo")) / (grid - 1)).alias("step"))
    st = st.where((F.col("step") > 0) & (F.col("h") > 0))
    rows = st.collect()  # one per column
    spans = [(r["h"], r["lo"], r["step"]) for r in rows]
    wide = df.select(*[nan_to_null(c(r["column"]).cast("double")).alias(f"x{i}") for i, r in enumerate(rows)])
    sums = wide.mapInArrow(lambda b: _kernel_sums(b, spans, grid), "i long, point int, s double")
    dens = sums.groupBy("i", "point").agg(F.sum("s").alias("_s"))
    places = df.sparkSession.createDataFrame([(i, *r) for i, r in enumerate(rows)], T.StructType([T.StructField("i", T.LongType()), *st.schema.fields]))
    g = dens.join(F.broadcast(places), ["i"])
    density = F.col("_s") / (F.col("n") * F.col("h") * F.lit(math.sqrt(2 * math.pi)))
    return g.select("column", "point", (F.col("lo") + F.col("point") * F.col("step")).alias("x"),
                    density.alias("density"), (density * (F.col("hi") - F.col("lo"))).alias("density_scaled"))


# -- A13 ---------------------------------------------------------------------

def scatter_bins(df: DataFrame, cols, target: str = "SP", bins: int = 50) -> DataFrame:
    """2-D binned counts of each feature against the target:
    ``column, bin_x, bin_y, count`` (bins over each axis' min..max)."""
    y = nan_to_null(c(target))
    long = (long_values(df, cols, extra=[target]).withColumnRenamed(target, "_y")
            .where(F.col("value").isNotNull() & F.col("_y").isNotNull()))
    st = long.groupBy("column").agg(F.min("value").alias("xl"), F.max("value").alias("xh"),
                                    F.min("_y").alias("yl"), F.max("_y").alias("yh"))
    j = long.join(F.broadcast(st), ["column"])

    def bucket(v, lo, hi):
        width = F.col(hi) - F.col(lo)
        b = F.floor((F.col(v) - F.col(lo)) / width * bins)
        return F.when(width > 0, F.least(b, F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")

    del y
    return (j.select("column", bucket("value", "xl", "xh").alias("bin_x"), bucket("_y", "yl", "yh").alias("bin_y"))
            .groupBy("column", "bin_x", "bin_y").agg(F.count(F.lit(1)).alias("count")))


# -- A14 / A15 ---------------------------------------------------------------

def _block(batch: pa.RecordBatch, p: int) -> np.ndarray:
    return np.array(batch.column("x").flatten().to_numpy(zero_copy_only=False), np.float64).reshape(batch.num_rows, p)


def _heavy_ranks(x: np.ndarray, heavy: dict) -> np.ndarray:
    """Ranks of heavy values; NaN for the others."""
    out = np.full(x.shape, np.nan)
    for i, (values, ranks) in heavy.items():
        at = np.minimum(np.searchsorted(values, x[:, i]), len(values) - 1)
        hit = values[at] == x[:, i]
        out[hit, i] = ranks[at[hit]]
    return out


def _light_values(batches: Iterator[pa.RecordBatch], heavy: dict, p: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = _block(batch, p)
        row, place = np.nonzero(~np.isnan(x) & np.isnan(_heavy_ranks(x, heavy)))
        yield pa.RecordBatch.from_arrays([pa.array(batch.column("row").to_numpy()[row]), pa.array(place.astype(np.int32)), pa.array(x[row, place])], names=["row", "place", "value"])


def _rank_products(batches: Iterator[pa.RecordBatch], heavy: dict, p: int, middle: float) -> Iterator[pa.RecordBatch]:
    """This task's sums over rows, for each pair of columns and the rows that have both:
    products of the ranks (less ``middle``), ranks and squares of the first one, rows."""
    total = np.zeros((4, p, p))
    for batch in batches:
        if not batch.num_rows:
            continue
        r = _heavy_ranks(_block(batch, p), heavy)
        lists = batch.column("light")
        if len(flat := lists.flatten()):
            sizes = np.diff(lists.offsets.to_numpy()) if not lists.null_count else np.array([len(v) if v else 0 for v in lists.to_pylist()])
            r[np.repeat(np.arange(len(r)), sizes), flat.field("place").to_numpy()] = flat.field("rank").to_numpy()
        there = ~np.isnan(r)
        z, m = np.where(there, r - middle, 0.0), there.astype(float)
        total += np.stack([z.T @ z, z.T @ m, (z * z).T @ m, m.T @ m])
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["k", "v"])


def rank_moments(df: DataFrame, cols, partitions: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the columns' average ranks for every pair of columns (``_rank_products``),
    and each column's number of distinct values.

    One long pass over all columns counts their values and gives the ranks.  A value in
    more than a partition's share of the rows (so at most ``partitions`` for a column) goes
    with the tasks as a lookup; NULLs need no rank; the rest of the values, each below that
    share, are joined by a shuffle.
    """
    cols = list(cols)
    p = len(cols)
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = F.array(*[F.coalesce(c(n).cast("double"), F.lit(float("nan"))) for n in cols])
    rows = cut_lineage(df.select(F.monotonically_increasing_id().alias("row"), x.alias("x")))
    n = rows.count()
    long = rows.select(F.posexplode("x").alias("place", "value")).where(~F.isnan("value"))
    ranks = average_rank_table(ordered_counts(long, ["place"], "value", partitions), ["place"], "value", "cnt")
    ranks = cut_lineage(ranks)
    distinct = np.zeros(p, int)
    for r in ranks.groupBy("place").count().collect():
        distinct[r["place"]] = r["count"]
    heavy: dict = {}
    for r in ranks.where(F.col("cnt") * parts > n).orderBy("place", "value").collect():
        heavy.setdefault(r["place"], []).append((r["value"], r["rank"]))
    heavy = {i: tuple(np.array(v, float).T) for i, v in heavy.items()}
    light = rows.mapInArrow(lambda b: _light_values(b, heavy, p), "row long, place int, value double")
    found = light.join(ranks.where(F.col("cnt") * parts <= n), ["place", "value"])
    tail = found.groupBy("row").agg(F.collect_list(F.struct("place", "rank")).alias("light"))
    sums = (rows.join(tail, "row", "left").select("x", "light")
            .mapInArrow(lambda b: _rank_products(b, heavy, p, (n + 1) / 2), "k long, v double")
            .groupBy("k").agg(F.sum("v").alias("v")))
    total = np.zeros(4 * p * p)
    for r in sums.collect():  # 4 p² numbers
        total[r["k"]] = r["v"]
    return total.reshape(4, p, p), distinct


def spearman_matrix(df: DataFrame, cols) -> DataFrame:
    """``col_a, col_b, rho`` for every ordered pair (diagonal = 1); Pearson
    correlation of average ranks over the rows that have both, all pairs in ONE
    aggregate.  A column of one value has no correlation."""
    cols = list(cols)
    (product, first, square, n), distinct = rank_moments(df, cols)
    out = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            v = 1.0 if i == j else None
            if i != j and distinct[i] > 1 and distinct[j] > 1 and n[i, j]:
                var = (square[i, j] - first[i, j] ** 2 / n[i, j]) * (square[j, i] - first[j, i] ** 2 / n[i, j])
                v = float((product[i, j] - first[i, j] * first[j, i] / n[i, j]) / math.sqrt(var)) if var > 0 else None
            out.append((a, b, v))
    return df.sparkSession.createDataFrame(out, "col_a string, col_b string, rho double")


def high_correlation_pairs(matrix: DataFrame, cols, threshold: float = 0.8,
                           collapse_equal_values: bool = False) -> DataFrame:
    """Pairs ``col_a`` before ``col_b`` (column order) with |ρ| >
    threshold, ρ ≠ 1.  ``collapse_equal_values`` reproduces the reference,
    which de-duplicates on the value so two pairs with equal ρ collapse."""
    order = {n: i for i, n in enumerate(cols)}
    pos = F.create_map(*[x for n, i in order.items() for x in (F.lit(n), F.lit(i))])
    m = matrix.where((pos[F.col("col_a")] < pos[F.col("col_b")]) & (F.col("rho") != 1.0)
                     & (F.abs(F.col("rho")) > threshold))
    if collapse_equal_values:
        m = m.dropDuplicates(["rho"])
    return m


# -- A16 ---------------------------------------------------------------------

def cramers_v(df: DataFrame, cat_cols, bias_correction: bool = True) -> list:
    """Cramér's V for every pair of category columns, one aggregation for all
    pairs: chi² = n·(Σ O²/(row·col) - 1) over the observed cells only."""
    pairs = [(a, b) for i, a in enumerate(cat_cols) for b in cat_cols[i + 1:]]
    if not pairs:
        return []
    arr = F.array(*[F.struct(F.lit(f"{a}\u0001{b}").alias("pair"), c(a).cast("string").alias("x"),
                             c(b).cast("string").alias("y")) for a, b in pairs])
    cells = (df.select(F.explode(arr).alias("t")).select("t.pair", "t.x", "t.y")
             .where(F.col("x").isNotNull() & F.col("y").isNotNull())
             .groupBy("pair", "x", "y").agg(F.count(F.lit(1)).alias("o")))
    rows = cells.groupBy("pair", "x").agg(F.sum("o").alias("rt"))
    colt = cells.groupBy("pair", "y").agg(F.sum("o").alias("ct"))
    j = cells.join(rows, ["pair", "x"]).join(colt, ["pair", "y"])
    agg = j.groupBy("pair").agg(
        F.sum(F.col("o") * F.col("o") / (F.col("rt") * F.col("ct"))).alias("s"),
        F.sum("o").alias("n"), F.countDistinct("x").alias("r"), F.countDistinct("y").alias("k")).collect()
    out = []
    for rw in agg:
        a, b = rw["pair"].split("\u0001")
        n, r, k = rw["n"], rw["r"], rw["k"]
        chi2 = n * (rw["s"] - 1.0)
        phi2 = chi2 / n
        if bias_correction:
            phi2c = max(0.0, phi2 - (k - 1) * (r - 1) / (n - 1))
            rc = r - (r - 1) ** 2 / (n - 1)
            kc = k - (k - 1) ** 2 / (n - 1)
            d = min(kc - 1, rc - 1)
            v = 0.0 if d == 0 else math.sqrt(phi2c / d)
        else:
            d = min(k - 1, r - 1)
            v = 0.0 if d == 0 else math.sqrt(phi2 / d)
        out += [(a, b, v), (b, a, v)]
    return out


def correlation_ratio(df: DataFrame, cat_cols, num_cols) -> list:
    """η = sqrt(Σ n_c (ȳ_c - ȳ)² / Σ (y - ȳ)²) for every (category, numeric)
    pair, one aggregation over the unpivoted table."""
    if not cat_cols or not num_cols:
        return []
    arr = F.array(*[F.struct(F.lit(f"{a}\u0001{b}").alias("pair"), c(a).cast("string").alias("x"),
                             nan_to_null(c(b).cast("double")).alias("y")) for a in cat_cols for b in num_cols])
    long = (df.select(F.explode(arr).alias("t")).select("t.pair", "t.x", "t.y")
            .where(F.col("x").isNotNull() & F.col("y").isNotNull()))
    tot = long.groupBy("pair").agg(F.avg("y").alias("ybar"), F.var_pop("y").alias("vp"), F.count("y").alias("n"))
    grp = long.groupBy("pair", "x").agg(F.count("y").alias("nc"), F.avg("y").alias("yc"))
    j = grp.join(F.broadcast(tot), ["pair"])
    agg = j.groupBy("pair").agg(
        F.sum(F.col("nc") * (F.col("yc") - F.col("ybar")) ** 2).alias("between"),
        F.first("vp").alias("vp"), F.first("n").alias("n")).collect()
    out = []
    for rw in agg:
        a, b = rw["pair"].split("\u0001")
        total = rw["vp"] * rw["n"]
        eta = 0.0 if not total else math.sqrt(rw["between"] / total)
        out += [(a, b, eta), (b, a, eta)]
    return out


def mixed_association(df: DataFrame, cat_cols, num_cols, bias_correction: bool = True) -> DataFrame:
    """``col_a, col_b, assoc`` over all columns: Spearman for
    numeric-numeric, Cramér's V for category-category, correlation ratio for
    mixed pairs; diagonal 1."""
    cat_cols, num_cols = list(cat_cols), list(num_cols)
    rows = []
    if num_cols:
        rows += [(r["col_a"], r["col_b"], r["rho"]) for r in spearman_matrix(df, num_cols).collect()]
    rows += cramers_v(df, cat_cols, bias_correction)
    rows += [(a, a, 1.0) for a in cat_cols]
    rows += correlation_ratio(df, cat_cols, num_cols)
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, assoc double")


# -- A17 ---------------------------------------------------------------------

def distinct_values(df: DataFrame, cols) -> DataFrame:
    """``column, value`` -- the distinct values offered by a form."""
    return _long_text(df, cols).where(F.col("value").isNotNull()).distinct()
