"""Order statistics without a single-task global window.

Exact medians, quartiles, average ranks, empirical CDFs and the
Anderson-Darling sum all need, for every value, the number of rows below it.
A window ``ORDER BY value`` over the whole table runs in one task, and an exact
``percentile`` aggregate holds every distinct value of a group in one buffer.
Instead:

1. count rows per ``(keys, value)`` (partial aggregation, so a value repeated
   a billion times is one row);
2. range-partition those counts on ``(keys, value)`` -- a hot key spreads over
   many range partitions;
3. running sum inside each range partition (window keyed by the partition id,
   so every task holds one range slice only);
4. per-partition totals -> offsets (a table of at most partitions + groups rows).

The counts of step 1 are checkpointed, so the input is evaluated once: the range
sampling and both readers of step 3 and 4 start from the written counts.  There is
one path whatever the size.

The result has one row per distinct ``(keys, value)`` with ``cnt``,
``cum_before`` (rows strictly below) and ``total`` (rows in the key group).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path
from .columns import c


def _partitions(df: DataFrame, partitions: int | None) -> int:
    if partitions:
        return partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _window(keys):
    return Window.partitionBy(*[c(k) for k in keys]) if keys else Window.partitionBy(F.lit(0))


def ordered_counts(df: DataFrame, keys, value: str, partitions: int | None = None,
                   weight: str | None = None, more=()) -> DataFrame:
    """``weight`` names a row-count column when ``df`` is already a count
    table (one row per distinct value, possibly split over several rows); the greatest
    of each of the columns ``more`` goes along."""
    keys = list(keys)
    kcols = [c(k) for k in keys]
    n_expr = F.sum(c(weight)) if weight else F.count(F.lit(1))
    counts = (df.where(c(value).isNotNull())
              .groupBy(*kcols, c(value))
              .agg(n_expr.cast("long").alias("cnt"), *[F.max(c(m)).alias(m) for m in more]))
    counts = cut_lineage(counts)
    ranged = (counts.repartitionByRange(_partitions(df, partitions), *kcols, c(value))
              .withColumn("_pid", F.spark_partition_id()))
    if more:  # the totals below don't read these columns and so would be sliced on their own
        ranged = cut_lineage(ranged)
    w_local = (Window.partitionBy(F.col("_pid"), *kcols).orderBy(c(value))
               .rowsBetween(Window.unboundedPreceding, -1))
    local = ranged.withColumn("_before", F.coalesce(F.sum("cnt").over(w_local), F.lit(0)))
    totals = ranged.groupBy(F.col("_pid"), *kcols).agg(F.sum("cnt").alias("_ptot"))
    w_off = _window(keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_pid", *kcols,
        F.coalesce(F.sum("_ptot").over(w_off), F.lit(0)).alias("_offset"),
        F.sum("_ptot").over(_window(keys)).alias("total"))
    return (local.join(offsets, ["_pid", *keys])
            .select(*kcols, c(value), *more, "cnt",
                    (F.col("_offset") + F.col("_before")).alias("cum_before"), "total"))


#: Half the width of a quantile's bracket, as a share of the rows, and the error that the
#: sketches behind it may have (1 / SKETCH).
BRACKET, SKETCH = 0.004, 1000


def _collapsed(df: DataFrame, keys: list, value: str, probs) -> DataFrame:
    """Counts that hold every value near a wanted quantile as it is and one row for all values
    between two such brackets: ``keys..., value`` (the least), ``_wide`` (more than one value),
    ``cnt``.  Brackets come from sketches; whether they were right shows in the counts."""
    ends = [min(1.0, max(0.0, float(p) + d)) for p in probs for d in (-BRACKET, BRACKET)]
    sketch = (df.where(c(value).isNotNull()).groupBy(*[c(k) for k in keys])
              .agg(F.percentile_approx(c(value), F.array(*[F.lit(e) for e in ends]), F.lit(SKETCH)).alias("_b")))
    # written as Parquet: Spark knows its size, and a small one needs no shuffle of the rows
    path = scratch_path(df.sparkSession, "sketch")
    sketch.write.parquet(path)
    sketch = df.sparkSession.read.schema(sketch.schema).parquet(path)
    joined = df.where(c(value).isNotNull())
    joined = joined.join(sketch, keys) if keys else joined.crossJoin(F.broadcast(sketch))
    inside, passed = F.lit(False), F.lit(0)
    for i in range(len(probs)):
        # nothing lies beyond the first and the last row
        lo = F.lit(True) if ends[2 * i] <= 0.0 else c(value) >= F.col("_b")[2 * i]
        hi = F.lit(False) if ends[2 * i + 1] >= 1.0 else c(value) > F.col("_b")[2 * i + 1]
        inside = inside | (lo & ~hi)
        passed = passed + lo.cast("int") + hi.cast("int")
    counts = (joined.select(*[c(k) for k in keys], c(value).alias("_v"), inside.alias("_in"), passed.alias("_seg"))
              .groupBy(*[c(k) for k in keys], "_seg", F.when(F.col("_in"), F.col("_v")).alias("_own"))
              .agg(F.min("_v").alias("_least"), F.max("_v").alias("_most"), F.count(F.lit(1)).alias("cnt")))
    return counts.select(*[c(k) for k in keys], F.col("_least").alias(value), (F.col("_least") < F.col("_most")).alias("_wide"), "cnt")


def exact_quantiles(df: DataFrame, keys, value: str, probs, partitions: int | None = None,
                    ordered: DataFrame | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles (numpy ``linear`` / Spark
    ``percentile`` / DuckDB ``quantile_cont``) of ``value`` per ``keys``.

    Only values near the wanted quantiles are ordered: sketches bracket them, the others are
    counted.  Should a bracket miss its quantile, all values are ordered.

    Returns ``keys..., p, q`` with one row per group and probability.
    """
    keys, probs = list(keys), list(probs)
    if ordered is None:
        near = cut_lineage(_hits(ordered_counts(_collapsed(df, keys, value, probs), keys, value, partitions, "cnt", ("_wide",)), keys, value, probs, ["_wide"]))
        if near.where("_wide").isEmpty():
            return _interpolated(near, keys)
        ordered = ordered_counts(df, keys, value, partitions)
    return _interpolated(_hits(ordered, keys, value, probs), keys)


def _hits(oc: DataFrame, keys: list, value: str, probs, more=()) -> DataFrame:
    """The rows of an ordered-count table that a wanted quantile lies on or next to."""
    total, cb, cnt = F.col("total"), F.col("cum_before"), F.col("cnt")
    probes = F.array(*[F.lit(float(p)) for p in probs])

    def covers(r: Column) -> Column:
        return (r >= cb) & (r < cb + cnt)

    def probe(p):
        h = (total - 1).cast("double") * p
        lo = F.floor(h)
        hi = F.least(lo + 1, total - 1)
        return F.struct(p.alias("p"), h.alias("h"), covers(lo).alias("is_lo"), covers(hi).alias("is_hi"))

    hits = F.filter(F.transform(probes, probe), lambda s: s["is_lo"] | s["is_hi"])
    return oc.select(*[c(k) for k in keys], c(value).alias("_v"), *more, F.explode(hits).alias("_s"))


def _interpolated(ex: DataFrame, keys: list) -> DataFrame:
    agg = (ex.groupBy(*[c(k) for k in keys], F.col("_s.p").alias("p"))
           .agg(F.max(F.when(F.col("_s.is_lo"), F.col("_v"))).alias("_lo"),
                F.max(F.when(F.col("_s.is_hi"), F.col("_v"))).alias("_hi"),
                F.max(F.col("_s.h")).alias("_h")))
    frac = F.col("_h") - F.floor(F.col("_h"))
    return agg.select(*[c(k) for k in keys], "p",
                      (F.col("_lo") + frac * (F.col("_hi") - F.col("_lo"))).alias("q"))


def quantile_columns(df: DataFrame, columns, probs, names=None, partitions: int | None = None) -> DataFrame:
    """Exact quantiles of several numeric columns in ONE pass: unpivot to a
    long ``(column, value)`` table and treat the column name as the key.

    Returns ``column, p, q``.
    """
    long = long_values(df, columns, names)
    return exact_quantiles(long, ["column"], "value", probs, partitions)


def long_values(df: DataFrame, columns, names=None, extra=()) -> DataFrame:
    """``(extra..., column, value)`` with value cast to double; NaN -> NULL."""
    names = list(names or columns)
    pairs = [F.struct(F.lit(n).alias("column"), F.nanvl(c(col).cast("double"), F.lit(None).cast("double")).alias("value"))
             for n, col in zip(names, columns)]
    return (df.select(*[c(e) for e in extra], F.explode(F.array(*pairs)).alias("_kv"))
            .select(*[c(e) for e in extra], "_kv.column", "_kv.value"))


def average_rank_table(oc: DataFrame, keys, value: str, *more: str) -> DataFrame:
    """1-based average rank of each distinct value (ties share the mean rank)."""
    return oc.select(*[c(k) for k in keys], c(value), *more,
                     (F.col("cum_before") + (F.col("cnt") + 1) / 2.0).alias("rank"))
