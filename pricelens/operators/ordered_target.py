"""Ordered target statistics (M13): a category encoded by the rows before it.

A plain target mean holds the row's own label.  Here all rows stand in a seeded order, and a
row's category becomes ``(Σ y of earlier rows of that category + a·prior) / (their number + a)``:
no row sees its own label or a later one's.  Rows to be scored, which have no place in the
order, get the statistic over all fitted rows.

The running sums need no window over a category: the order is cut into slices, whose totals by
category are added up over the slices before.  These offsets go to their slice beside its rows,
which are sorted there and read as a stream that keeps one sum and number per category.  So whole rows are
shuffled once, whatever the number of columns, and a category with a third of all rows spreads
over all slices.  Slices are equal ranges of a hash of the key: rows that repeat a key share one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import c, nan_to_null
from ..session import cut_lineage
from .base import FittedStage, Stage, join_dimension, written_table


def seeded_order(columns, seed: int) -> Column:
    """A place for each row from its own values: the same on every run, and in any SQL engine."""
    values = [c(x) if isinstance(x, str) else x for x in columns]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(v.cast("string"), F.lit("")) for v in values]))


def order_slice(order: Column, slices: int) -> Column:
    """The number of an ``order``'s slice: equal ranges of its first 32 bits."""
    return F.shiftright(F.conv(F.substring(order, 1, 8), 16, 10).cast("long") * slices, 32).cast("int")


def running_sums(df: DataFrame, keys, order, values, partitions: int | None = None) -> DataFrame:
    """``df`` with ``before_n`` and ``before_<v>`` for each of ``values``: number of earlier
    rows of the same ``keys`` by ``order`` and the sums of their values (NULLs count as rows
    that add nothing).  Rows equal in keys and order are placed one after the other."""
    keys, order, values = list(keys), list(order), list(values)
    if partitions is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [*[c(k) for k in keys], *[c(o) for o in order]]
    # written once: the slices of both readers below are then the same
    placed = cut_lineage(df.repartitionByRange(partitions, *by).withColumn("_slice", F.spark_partition_id()))
    measures = {"n": F.lit(1), **{v: c(v) for v in values}}
    own = Window.partitionBy("_slice", *[c(k) for k in keys]).orderBy(*[c(o) for o in order]).rowsBetween(Window.unboundedPreceding, -1)
    inside = placed.withColumns({f"before_{k}": F.coalesce(F.sum(e).over(own), F.lit(0)) for k, e in measures.items()})
    # one row per slice and key: slices + keys rows
    totals = placed.groupBy("_slice", *[c(k) for k in keys]).agg(*[F.sum(e).alias(f"_t_{k}") for k, e in measures.items()])
    earlier = Window.partitionBy(*[c(k) for k in keys]).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_slice", *[c(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                            *[F.coalesce(F.sum(f"_t_{k}").over(earlier), F.lit(0)).alias(f"_o_{k}") for k in measures])
    same = [inside["_slice"] == offsets["_slice"], *[inside[f"`{k}`"].eqNullSafe(offsets[f"_k{i}"]) for i, k in enumerate(keys)]]
    joined = inside.join(offsets, same, "left")
    return joined.select(*[inside[f"`{x}`"] for x in df.columns], *[(F.col(f"before_{k}") + F.col(f"_o_{k}")).alias(f"before_{k}") for k in measures])


class _Running:
    """Sum and number of the labels seen so far, by category."""

    def __init__(self):
        self.codes: dict = {}
        self.sums, self.counts = np.zeros(1024), np.zeros(1024, np.int64)

    def code(self, categories: pa.Array) -> np.ndarray:
        """Numbers of the categories (NULL has one too), new ones added."""
        found = categories.dictionary_encode(null_encoding="encode")
        own = np.array([self.codes.setdefault(v, len(self.codes)) for v in found.dictionary.to_pylist()], np.int64)
        while len(self.codes) > len(self.sums):
            self.sums, self.counts = (np.concatenate([x, np.zeros_like(x)]) for x in (self.sums, self.counts))
        return own[found.indices.to_numpy()]

    def start(self, categories: pa.Array, sums: pa.Array, counts: pa.Array) -> None:
        at = self.code(categories)
        self.sums[at], self.counts[at] = sums.to_numpy(), counts.to_numpy()

    def before(self, categories: pa.Array, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum and number before each row; the rows (label NaN: none) are added after."""
        code = self.code(categories)
        by = np.argsort(code, kind="stable")
        code, known = code[by], ~np.isnan(y[by])
        first = np.append(True, code[1:] != code[:-1])
        run = np.cumsum(first) - 1
        out = []
        for state, v in ((self.sums, np.where(known, y[by], 0.0)), (self.counts, known.astype(np.int64))):
            v[first] += state[code[first]]
            upto = pd.Series(v).groupby(run).cumsum().to_numpy()
            if not np.isfinite(upto).all():  # pandas corrects its sums, which an infinite label makes NaN
                at = np.append(np.flatnonzero(first), len(v))
                upto = np.concatenate([np.cumsum(v[a:b]) for a, b in zip(at, at[1:])])
            own = np.empty_like(upto)
            own[1:] = upto[:-1]
            own[first] = state[code[first]]
            state[code[np.append(first[1:], True)]] = upto[np.append(first[1:], True)]
            placed = np.empty_like(own)
            placed[by] = own
            out.append(placed)
        return out[0], out[1]


def _streamed(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[pa.RecordBatch]:
    """Rows with the sums and numbers before them, from a slice's offsets and then its rows in order."""
    at, running = None, []
    for batch in batches:
        slices = batch.column("_slice").to_numpy()
        edges = np.flatnonzero(np.diff(slices)) + 1
        for a, b in zip([0, *edges], [*edges, len(slices)]):
            if a == b:
                continue
            if slices[a] != at:
                at, running = slices[a], [_Running() for _ in range(columns)]
            part = batch.slice(a, b - a)
            for i, r in enumerate(running):
                own = part.filter(pc.equal(part.column("_place"), i))
                r.start(own.column("_category"), own.column("_s"), own.column("_n"))
            rows = part.filter(pc.is_null(part.column("_place")))
            if not rows.num_rows:
                continue
            y = rows.column("_y").to_numpy(zero_copy_only=False)  # NULL: NaN
            found = [r.before(rows.column(f"_c{i}"), y) for i, r in enumerate(running)]
            yield pa.RecordBatch.from_arrays([rows.column("_row"), *[pa.array(x) for pair in found for x in pair]],
                                             names=["_row", *[f"_{k}{i}" for i in range(columns) for k in "sn"]])


class OrderedTargetEncoder(Stage):
    """Encoder of ``columns`` by ``label``.  The model's ``transform`` scores new rows; its
    ``training`` encodes the fitted rows by their place in the seeded order, which comes from
    the values of ``key`` (then ``ties``, so that only equal rows may trade places).

    NULL is a category of its own.  Rows without label count for nothing and are encoded like
    the others; unseen categories, and the first row of each, get the prior (the mean label)."""

    def __init__(self, columns, label: str = "SP", key=("row_id",), ties=(), a: float = 1.0, seed: int = 42):
        super().__init__()
        self.columns, self.label, self.key, self.ties, self.a, self.seed = list(columns), label, list(key), list(ties), a, seed

    def _fit(self, df):
        y = nan_to_null(c(self.label))
        prior = df.agg(F.avg(y)).first()[0]
        pairs = [F.struct(F.lit(i).alias("place"), c(col).cast("string").alias("category")) for i, col in enumerate(self.columns)]
        sums = (df.select(y.alias("_y"), F.explode(F.array(*pairs)).alias("kv")).groupBy("kv.place", "kv.category")
                .agg(F.sum("_y").alias("s"), F.count("_y").alias("n")))
        return OrderedTargetModel(self.columns, self.label, self.key, self.ties, self.a, self.seed, prior, written_table(sums, "ordered-target"))


class OrderedTargetModel(FittedStage):
    _frames = ("sums",)

    def __init__(self, columns, label, key, ties, a, seed, prior, sums):
        super().__init__()
        self.columns, self.label, self.key, self.ties, self.a, self.seed = columns, label, key, ties, a, seed
        self.prior, self.sums = prior, sums

    def _statistic(self, total: Column, n: Column) -> Column:
        prior = F.lit(self.prior).cast("double")
        return (F.coalesce(total, F.lit(0.0)) + F.lit(float(self.a)) * prior) / (F.coalesce(n, F.lit(0)) + F.lit(float(self.a)))

    def _transform(self, df):
        out = df
        for i, col in enumerate(self.columns):
            # NULL is found as a category too: the flag tells it from every text
            dim = self.sums.where(F.col("place") == i).select(
                F.col("category").isNull().alias("_none"), F.coalesce("category", F.lit("")).alias("_cat"), F.col("s").alias("_s"), F.col("n").alias("_n"))
            keyed = out.withColumns({"_none": c(col).isNull(), "_cat": F.coalesce(c(col).cast("string"), F.lit(""))})
            out = join_dimension(keyed, dim, ["_none", "_cat"]).withColumn(col, self._statistic(F.col("_s"), F.col("_n"))).drop("_none", "_cat", "_s", "_n")
        return out

    def training(self, df: DataFrame) -> DataFrame:
        """The fitted rows with each column encoded by the rows before.  ``df`` is read twice."""
        slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        label = nan_to_null(c(self.label).cast("double"))
        places = [F.struct(F.lit(i).alias("place"), c(col).cast("string").alias("category")) for i, col in enumerate(self.columns)]
        totals = (df.select(order_slice(seeded_order(self.key, self.seed), slices).alias("_slice"), label.alias("_y"), F.explode(F.array(*places)).alias("kv"))
                  .groupBy("_slice", F.col("kv.place").alias("_place"), F.col("kv.category").alias("_category"))
                  .agg(F.sum("_y").alias("s"), F.count("_y").alias("n")))
        earlier = Window.partitionBy("_place", "_category").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        offsets = totals.select("_slice", "_place", "_category", F.coalesce(F.sum("s").over(earlier), F.lit(0.0)).alias("_s"),
                                F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_n")).where("_n > 0")
        whole = F.struct(*[c(x) for x in df.columns]).alias("_row")
        rows = df.select(order_slice(seeded_order(self.key, self.seed), slices).alias("_slice"), whole)
        both = rows.unionByName(offsets, allowMissingColumns=True).repartitionById(slices, "_slice")

        def own(name: str) -> Column:
            return F.col("_row").getField(name)
        order = ["_slice", F.col("_place").isNull(), seeded_order([own(k) for k in self.key], self.seed), *[own(t) for t in self.ties]]
        inputs = both.sortWithinPartitions(*order).select(
            "_slice", "_row", "_place", "_category", "_s", "_n", nan_to_null(own(self.label).cast("double")).alias("_y"),
            *[own(col).cast("string").alias(f"_c{i}") for i, col in enumerate(self.columns)])
        schema = T.StructType([inputs.schema["_row"]])
        for i in range(len(self.columns)):
            schema = schema.add(f"_s{i}", "double").add(f"_n{i}", "long")
        count = len(self.columns)
        found = inputs.mapInArrow(lambda batches: _streamed(batches, count), schema)
        at = {x: i for i, x in enumerate(self.columns)}
        return found.select(*[(self._statistic(F.col(f"_s{at[x]}"), F.col(f"_n{at[x]}")) if x in at else own(x)).alias(x) for x in df.columns])
