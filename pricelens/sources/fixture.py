"""The raw sales table, derived from the supplied star-schema test tables.

lineitem -> part, supplier, orders -> customer -> nation -> region; every key
matches, so the view has one row per lineitem row.  ``SALES_SQL`` is the same
view in ANSI SQL for the oracle.

Scale: lineitem x orders and lineitem x part are fact-to-large-dimension joins
and shuffle on their keys (sort-merge, AQE may demote to broadcast when the
runtime size allows).  Only nation (25 rows) and region (5 rows) are
broadcast explicitly: their size is fixed by the schema, not by the data.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def sales_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20-column raw sales table (declared schema order)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    supp = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")

    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")
    cust_zone = cust.join(F.broadcast(geo), cust.c_nationkey == geo.n_nationkey).select("c_custkey", "r_name")
    order_zone = orders.join(cust_zone, orders.o_custkey == cust_zone.c_custkey).select("o_orderkey", "o_orderdate", "r_name")

    j = (li.join(order_zone, li.l_orderkey == order_zone.o_orderkey)
         .join(part, li.l_partkey == part.p_partkey)
         .join(supp, li.l_suppkey == supp.s_suppkey))

    q = F.col("l_quantity")
    mrp = F.col("l_extendedprice") / q
    sp = mrp * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    nsv = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    gst = nsv * F.col("l_tax")
    cost = F.when(F.col("s_acctbal") < 0, -(q * F.col("p_retailprice"))).otherwise(q * F.col("p_retailprice"))
    nsu = F.when(F.col("l_returnflag") == "R", -q).otherwise(q)
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("UID"),
        F.col("p_name").alias("NAME"),
        F.col("r_name").alias("ZONE"),
        F.col("p_brand").alias("Brand"),
        F.col("p_type").alias("MC"),
        F.col("o_orderdate").cast("date").alias("Fdate"),
        nsu.alias("NSU"),
        nsv.alias("NSV"),
        gst.alias("GST Value"),
        (nsv - gst).alias("NSV-GST"),
        cost.alias("Sales at Cost"),
        (nsv - gst - cost).alias("(NSV-GST)-SALES AT COST"),
        (F.col("l_discount") * 100).alias("MARGIN%"),
        F.col("l_extendedprice").alias("Gross Sales"),
        (F.col("l_extendedprice") - cost).alias("Gross RGM(P-L)"),
        (F.col("l_tax") * 100).alias("Gross Margin %(Q/P*100)"),
        mrp.alias("MRP"),
        sp.alias("SP"),
        (mrp - sp).alias("DIS"),
        (F.col("l_discount") * 100).alias("DIS%"),
    )


SALES_SQL = """
sales AS (
  SELECT
    l.l_orderkey * 10 + l.l_linenumber AS "UID",
    p.p_name AS "NAME",
    r.r_name AS "ZONE",
    p.p_brand AS "Brand",
    p.p_type AS "MC",
    CAST(o.o_orderdate AS DATE) AS "Fdate",
    CASE WHEN l.l_returnflag = 'R' THEN -l.l_quantity ELSE l.l_quantity END AS "NSU",
    l.l_extendedprice * (1 - l.l_discount) AS "NSV",
    l.l_extendedprice * (1 - l.l_discount) * l.l_tax AS "GST Value",
    l.l_extendedprice * (1 - l.l_discount) - l.l_extendedprice * (1 - l.l_discount) * l.l_tax AS "NSV-GST",
    CASE WHEN s.s_acctbal < 0 THEN -(l.l_quantity * p.p_retailprice) ELSE l.l_quantity * p.p_retailprice END AS "Sales at Cost",
    l.l_extendedprice * (1 - l.l_discount) - l.l_extendedprice * (1 - l.l_discount) * l.l_tax
      - CASE WHEN s.s_acctbal < 0 THEN -(l.l_quantity * p.p_retailprice) ELSE l.l_quantity * p.p_retailprice END
      AS "(NSV-GST)-SALES AT COST",
    l.l_discount * 100 AS "MARGIN%",
    l.l_extendedprice AS "Gross Sales",
    l.l_extendedprice - CASE WHEN s.s_acctbal < 0 THEN -(l.l_quantity * p.p_retailprice) ELSE l.l_quantity * p.p_retailprice END
      AS "Gross RGM(P-L)",
    l.l_tax * 100 AS "Gross Margin %(Q/P*100)",
    l.l_extendedprice / l.l_quantity AS "MRP",
    l.l_extendedprice / l.l_quantity * (1 - l.l_discount) * (1 + l.l_tax) AS "SP",
    l.l_extendedprice / l.l_quantity - l.l_extendedprice / l.l_quantity * (1 - l.l_discount) * (1 + l.l_tax) AS "DIS",
    l.l_discount * 100 AS "DIS%"
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer cu ON o.o_custkey = cu.c_custkey
  JOIN nation n ON cu.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
)"""

# P7 cleaning in SQL, on top of ``sales``: cost >= 0, abs, recomputed gross
# sales (half-even), SP <= MRP, date parts, Fdate and the 10 irrelevant
# columns dropped.
CLEAN_SQL = """
repaired AS (
  SELECT "NAME", "ZONE", "Brand", "MC", "Fdate",
         abs("NSU") AS "NSU", "Sales at Cost", abs("MRP") AS "MRP", abs("SP") AS "SP"
  FROM sales WHERE "Sales at Cost" >= 0
),
clean AS (
  SELECT "NAME", "ZONE", "Brand", "MC", "NSU", "Sales at Cost",
         round_even("NSU" * "MRP", 2) AS "Gross Sales", "MRP", "SP",
         CAST(year("Fdate") AS INTEGER) AS "Fdate_year",
         CAST(month("Fdate") AS INTEGER) AS "Fdate_month",
         CAST(quarter("Fdate") AS INTEGER) AS "Fdate_quarter"
  FROM repaired WHERE "SP" <= "MRP"
)"""


def with_clean(sql_body: str, extra_ctes: str = "") -> str:
    ctes = SALES_SQL + "," + CLEAN_SQL + ("," + extra_ctes if extra_ctes else "")
    return "WITH " + ctes + "\n" + sql_body
