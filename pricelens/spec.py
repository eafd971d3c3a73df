"""Data model of the sales table: declared schema (S1) and feature roles.

The roles are a dataclass so every operator works on any table that names its
columns; the defaults describe the sales table.
"""

from __future__ import annotations

import json
import os
import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

SCHEMA_JSON = os.path.join(os.path.dirname(__file__), "resources", "sales_schema.json")

# Columns the reference removes as irrelevant, in its order.
DROP_COLUMNS = [
    "UID", "NSV", "GST Value", "NSV-GST", "(NSV-GST)-SALES AT COST",
    "Gross RGM(P-L)", "Gross Margin %(Q/P*100)", "MARGIN%", "DIS", "DIS%",
]
DROP_REASON = "Irrelevant column"

_VARCHAR = re.compile(r"varchar\((\d+)\)", re.I)


@dataclass(frozen=True)
class FeatureSpec:
    continuous: tuple = ("NSU", "Sales at Cost", "Gross Sales", "MRP")
    nominal: tuple = ("NAME", "ZONE", "Brand", "MC")
    cyclic: tuple = ("Fdate_month", "Fdate_quarter")
    interval: tuple = ("Fdate_year",)
    label: str = "SP"
    row_id: str = "row_id"
    date_col: str = "Fdate"
    interval_origin: int = 2017

    @property
    def features(self) -> list:
        return [*self.nominal, *self.continuous, *self.interval, *self.cyclic]


SALES = FeatureSpec()
# The supplied test tables start in 1995 (orders.o_orderdate), so the
# interval origin there is 1995.
TEST_SALES = FeatureSpec(interval_origin=1995)


@dataclass
class DeclaredSchema:
    """Parsed schema JSON: Spark schema plus the varchar length limits."""

    struct: T.StructType
    max_lengths: dict = field(default_factory=dict)
    declared_types: dict = field(default_factory=dict)

    @property
    def names(self) -> list:
        return self.struct.fieldNames()


def _spark_type(declared: str) -> T.DataType:
    d = declared.strip().lower()
    if d in ("int", "integer"):
        return T.IntegerType()
    if d in ("bigint", "long"):
        return T.LongType()
    if d in ("float", "double", "double precision", "real"):
        return T.DoubleType()
    if d == "date":
        return T.DateType()
    if d.startswith("timestamp"):
        return T.TimestampType()
    if d.startswith("varchar") or d in ("text", "string"):
        return T.StringType()
    raise ValueError(f"unsupported declared type {declared!r}")


def load_schema(path: str = SCHEMA_JSON) -> DeclaredSchema:
    """Read the declared schema JSON (``ColName`` in file order)."""
    with open(path) as fh:
        doc = json.load(fh)
    cols = doc["ColName"]
    fields, limits = [], {}
    for name, declared in cols.items():
        fields.append(T.StructField(name, _spark_type(declared), True))
        m = _VARCHAR.fullmatch(declared.strip())
        if m:
            limits[name] = int(m.group(1))
    return DeclaredSchema(T.StructType(fields), limits, dict(cols))
