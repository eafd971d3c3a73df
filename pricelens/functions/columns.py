"""Column helpers shared by every operator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def c(name: str) -> Column:
    """Column by exact name; names of the sales table hold spaces, %, ( ) - * /."""
    return F.col(f"`{name}`")


def nan_to_null(col: Column) -> Column:
    """Spark orders NaN above every number (``NaN >= 0`` is true), the
    reference drops NaN rows in comparisons: map NaN to NULL first."""
    return F.nanvl(col, F.lit(None).cast("double"))


def nan_to_null_all(df: DataFrame, names) -> DataFrame:
    return df.withColumns({n: nan_to_null(c(n)) for n in names})


def is_numeric_type(dtype: str) -> bool:
    return dtype in ("double", "float", "int", "bigint", "smallint", "tinyint") or dtype.startswith("decimal")


def numeric_columns(df: DataFrame, exclude=()) -> list:
    return [n for n, t in df.dtypes if is_numeric_type(t) and n not in exclude]


def string_columns(df: DataFrame, exclude=()) -> list:
    return [n for n, t in df.dtypes if t == "string" and n not in exclude]


def stable_row_id(names, seed: int = 0) -> Column:
    """A stable 64-bit key from the row's values (never
    ``monotonically_increasing_id``, whose value depends on partitioning)."""
    return F.xxhash64(F.lit(seed), *[c(n) for n in names])
