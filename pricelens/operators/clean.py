"""Cleaning (P1-P9), duplicate handling (D1) and scoring-side expressions
(P13, P14).  All of it is one chained projection/filter that Catalyst
collapses into a single scan stage; only D1 shuffles (on all columns).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import c, nan_to_null, stable_row_id
from ..spec import DROP_COLUMNS, DROP_REASON, SALES, FeatureSpec


def filter_nonnegative_cost(df: DataFrame, col: str = "Sales at Cost") -> DataFrame:
    """Keep ``col >= 0``; NaN and NULL are dropped (NaN is not >= 0)."""
    return df.where(nan_to_null(c(col)) >= 0)


def repair_signs(df: DataFrame, cols=("NSU", "MRP", "SP")) -> DataFrame:
    """Absolute value of the signed quantity and prices."""
    return df.withColumns({n: F.abs(c(n)) for n in cols})


def recompute_gross_sales(df: DataFrame, qty: str = "NSU", price: str = "MRP",
                          out: str = "Gross Sales", rounded: bool = True) -> DataFrame:
    """Gross sales = qty * price, rounded half-to-even to 2 places
    (NumPy ``round``); ``rounded=False`` is the unrounded scoring form."""
    expr = c(qty) * c(price)
    return df.withColumn(out, F.bround(expr, 2) if rounded else expr)


def filter_price_cap(df: DataFrame, sp: str = "SP", mrp: str = "MRP") -> DataFrame:
    """Keep ``SP <= MRP``; rows with NaN/NULL on either side are dropped."""
    return df.where(nan_to_null(c(sp)) <= nan_to_null(c(mrp)))


def date_parts(df: DataFrame, col: str = "Fdate", drop_source: bool = True) -> DataFrame:
    """P5: year / month / quarter of a date column; NULL dates stay NULL."""
    out = df.withColumns({
        f"{col}_year": F.year(c(col)).cast("int"),
        f"{col}_month": F.month(c(col)).cast("int"),
        f"{col}_quarter": F.quarter(c(col)).cast("int"),
    })
    return out.drop(col) if drop_source else out


def date_parts_as_text(df: DataFrame, cols=("Fdate_year", "Fdate_month", "Fdate_quarter")) -> DataFrame:
    """The reference turns the date parts into strings before profiling."""
    return df.withColumns({n: c(n).cast("string") for n in cols})


def clean(df: DataFrame, spec: FeatureSpec = SALES, as_text: bool = False) -> DataFrame:
    """P7 = P1 -> P2 -> P3 -> P4 -> P5 (-> P6 when ``as_text``)."""
    out = filter_nonnegative_cost(df)
    out = repair_signs(out)
    out = recompute_gross_sales(out)
    out = filter_price_cap(out, spec.label)
    out = date_parts(out, spec.date_col)
    return date_parts_as_text(out) if as_text else out


def drop_irrelevant(df: DataFrame, cols=DROP_COLUMNS):
    """Drop columns; returns ``(table, audit)`` where audit lists
    ``Columns_Removed, Reason`` (a constant-size table)."""
    spark = df.sparkSession
    audit = spark.createDataFrame([(n, DROP_REASON) for n in cols], "Columns_Removed string, Reason string")
    present = [n for n in cols if n in df.columns]
    return df.drop(*present), audit


def split_duplicates(df: DataFrame, chunk: int = 1_000_000):
    """``(kept, repeats)``.  k identical rows give 1 kept row and k-1
    repeats (NULLs compare equal).

    No window over the duplicate group (a group holding a third of the table
    would be one task): copies are counted by a partial aggregate, and the
    k-1 repeats are regenerated in two steps -- first one row per chunk of at
    most ``chunk`` copies, spread round-robin, then the copies inside each
    chunk -- so a hot row is re-expanded by many tasks.
    """
    cols = list(df.columns)
    counted = df.groupBy(*[c(n) for n in cols]).agg(F.count(F.lit(1)).alias("_copies"))
    kept = counted.drop("_copies")
    extra = counted.where(F.col("_copies") > 1).withColumn("_extra", F.col("_copies") - 1)
    chunks = (extra
              .withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("_extra") - 1) / chunk))))
              .withColumn("_n", F.least(F.lit(chunk), F.col("_extra") - F.col("_chunk") * chunk)))
    spread = chunks.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    repeats = (spread.withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("_n"))))
               .select(*[c(n) for n in cols]))
    return kept, repeats


def drop_duplicates(df: DataFrame) -> DataFrame:
    """D1, simple form."""
    return df.dropDuplicates()


def with_row_id(df: DataFrame, name: str = "row_id", seed: int = 0) -> DataFrame:
    """Stable 64-bit row key from all values.  On a de-duplicated table (D1
    runs first) it identifies rows up to hash collisions; it is used to assign
    folds and samples, never as a join key."""
    return df.withColumn(name, stable_row_id(list(df.columns), seed))


def features_and_label(df: DataFrame, spec: FeatureSpec = SALES) -> DataFrame:
    """The reference writes X and y as two files aligned by position.
    Spark keeps ONE table: features, label and a stable row id."""
    keep = [n for n in spec.features if n in df.columns] + [spec.label]
    return df.select(*[c(n) for n in keep])


def quarter_from_month(col: str = "Fdate_month"):
    """Quarter from a month number (1-3 -> 1, ..., 10-12 -> 4)."""
    return F.ceil(c(col) / 3).cast("int")


def prepare(spark: SparkSession, raw: DataFrame, spec: FeatureSpec = SALES) -> DataFrame:
    """Whole preprocessing stage: clean -> drop -> de-duplicate -> one table."""
    cleaned = clean(raw, spec)
    table, _ = drop_irrelevant(cleaned)
    return features_and_label(table.dropDuplicates(), spec)
