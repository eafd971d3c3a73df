"""Result rounding shared by the Spark queries and their SQL oracle.

Two engines sum in different orders, so doubles agree only to ~1e-15
relative.  Every double result is rounded to 9 decimals or 9 significant
digits, whichever is coarser.  The rounding is written as the same chain of
IEEE operations on both sides (``floor(x / p * 1e8 + 0.5) / 1e8 * p``), not
with each engine's ``round``, whose tie handling differs (decimal text vs
binary product); ``+ 0.0`` turns -0.0 into 0.0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 9


def round_col(x, digits: int = DIGITS):
    sig_scale, abs_scale = float(10 ** (digits - 1)), float(10 ** digits)
    e = F.floor(F.log10(F.abs(x)))
    p = F.pow(F.lit(10.0), e)
    sig = F.floor(x / p * F.lit(sig_scale) + F.lit(0.5)) / F.lit(sig_scale) * p
    small = F.floor(x * F.lit(abs_scale) + F.lit(0.5)) / F.lit(abs_scale)
    return (F.when(x.isNull() | F.isnan(x), x)
            .when(F.abs(x) < 1.0, small + F.lit(0.0))
            .otherwise(sig + F.lit(0.0)))


def round_doubles(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    dbl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not dbl:
        return df
    return df.withColumns({n: round_col(F.col(f"`{n}`").cast("double"), digits) for n in dbl})


def round_sql(col: str, digits: int = DIGITS) -> str:
    _SIG, _ABS = float(10 ** (digits - 1)), float(10 ** digits)
    q = f'"{col}"'
    p = f"pow(10.0, floor(log10(abs({q}))))"
    return (f"CASE WHEN {q} IS NULL OR isnan({q}) THEN {q} "
            f"WHEN abs({q}) < 1.0 THEN floor({q} * {_ABS!r} + 0.5) / {_ABS!r} + 0.0 "
            f"ELSE floor({q} / {p} * {_SIG!r} + 0.5) / {_SIG!r} * {p} + 0.0 END")


def wrap_sql(sql: str, doubles, digits: int = DIGITS) -> str:
    """``SELECT * REPLACE (round(..) AS col, ...) FROM (sql)``."""
    doubles = list(doubles)
    if not doubles:
        return sql
    repl = ", ".join(f'{round_sql(d, digits)} AS "{d}"' for d in doubles)
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) AS _q"
