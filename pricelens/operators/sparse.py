"""P12 without a wide schema: one-hot encoding as one sparse vector per row.

``OneHotEncoder`` makes a column of every category, whose names the driver holds.  Here the
categories are numbered 0, 1, ... by column and value with distributed ranks and stay a
written table; a row carries the numbers of its own categories only, so neither the driver
nor a row grows with the number of categories.  Spark ML's models read the vector as it is,
and ``named`` turns their coefficients back into rows of names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c
from ..functions.ordered import ordered_counts
from .base import FittedStage, Stage, join_dimension, written_table

#: A vector's size and indices are 32-bit.
LARGEST = 2**31 - 1


class SparseOneHotEncoder(Stage):
    """Vector ``[numeric..., one 0/1 entry per category seen in fit]`` in column ``output``.

    Unseen and NULL categories have no entry; a NULL or NaN among ``numeric`` makes the
    vector null.  The columns themselves stay.  An empty table gives no categories."""

    def __init__(self, columns, numeric=(), output: str = "encoded"):
        super().__init__()
        self.columns, self.numeric, self.output = list(columns), list(numeric), output

    def _fit(self, df):
        pairs = [F.struct(F.lit(i).alias("place"), c(col).cast("string").alias("category")) for i, col in enumerate(self.columns)]
        seen = df.select(F.explode(F.array(*pairs)).alias("kv")).where("kv.category is not null").distinct()
        # one row per category, so the rows before it are its number
        numbers = ordered_counts(seen, [], "kv")
        first = len(self.numeric)
        names = written_table(numbers.select("kv.place", "kv.category", (F.col("cum_before") + first).alias("index")), "categories")
        size = first + names.count()
        if size > LARGEST:
            raise ValueError(f"{size} entries: a vector holds at most {LARGEST}")
        return SparseOneHotModel(self.columns, self.numeric, self.output, size, names)


class SparseOneHotModel(FittedStage):
    _frames = ("names",)

    def __init__(self, columns, numeric, output, size, names):
        super().__init__()
        self.columns, self.numeric, self.output, self.size, self.names = columns, numeric, output, size, names

    def _transform(self, df):
        out = df
        for i, col in enumerate(self.columns):
            dim = self.names.where(F.col("place") == i).select(F.col("category").alias("_cat"), F.col("index").cast("int").alias(f"_at{i}"))
            out = join_dimension(out.withColumn("_cat", c(col).cast("string")), dim, ["_cat"]).drop("_cat")
        at = [F.col(f"_at{i}") for i in range(len(self.columns))]
        values = [F.nanvl(c(x).cast("double"), F.lit(None).cast("double")) for x in self.numeric]
        return out.withColumn(self.output, _vectors(values, at, self.size)).drop(*[f"_at{i}" for i in range(len(self.columns))])

    def named(self, coefficients) -> DataFrame:
        """Rows ``feature, category, index, coefficient`` of a fitted model's coefficients;
        ``category`` is null for the numeric features."""
        spark = self.names.sparkSession
        table = spark.createDataFrame(pa.table({"index": pa.array(range(len(coefficients)), pa.int64()),
                                                "coefficient": pa.array([float(x) for x in coefficients], pa.float64())}))
        columns = F.array(*[F.lit(x) for x in self.columns])
        names = self.names.select("index", columns[F.col("place")].alias("feature"), "category")
        if self.numeric:
            own = [(i, x, None) for i, x in enumerate(self.numeric)]
            names = names.unionByName(spark.createDataFrame(own, "index long, feature string, category string"))
        return names.join(table, "index").select("feature", "category", "index", "coefficient")


def _vectors(numeric: list[Column], at: list[Column], size: int) -> Column:
    dense = len(numeric)

    def build(*columns: pa.Array) -> pa.Array:
        rows = len(columns[0])
        there = np.column_stack([x.is_valid().to_numpy(zero_copy_only=False) for x in columns])
        missing = ~there[:, :dense].all(1)
        weight = np.ones(there.shape)
        index = np.empty(there.shape, np.int32)
        for k, x in enumerate(columns):
            if k < dense:
                index[:, k], weight[:, k] = k, x.fill_null(0.0).to_numpy(zero_copy_only=False)
            else:
                index[:, k] = x.fill_null(0).to_numpy(zero_copy_only=False)
        # row after row: the numeric entries, then the categories that were seen
        ends = pa.array(np.concatenate([[0], np.cumsum(there.sum(1))]).astype(np.int32))
        return pa.StructArray.from_arrays(
            [pa.array(np.zeros(rows, np.int8)), pa.array(np.full(rows, size, np.int32)),
             pa.ListArray.from_arrays(ends, pa.array(index[there])), pa.ListArray.from_arrays(ends, pa.array(weight[there]))],
            names=["type", "size", "indices", "values"], mask=pa.array(missing))
    return F.arrow_udf(build, VectorUDT())(*numeric, *at)
