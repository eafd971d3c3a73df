"""Registered queries: one per operator of the inventory, each reading the
supplied test tables, plus the equivalent DuckDB SQL where one exists.

``QUERIES[name] = (callable(spark, sf_dir) -> DataFrame, sql | None)``.
Double results are rounded identically on both sides (``functions.rounding``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.columns import c
from .functions.rounding import round_doubles, wrap_sql
from .operators import clean as CL
from .operators import features as FE
from .operators import profile as PR
from .operators.base import written_table
from .plans import baselines as BL
from .sources.fixture import SALES_SQL, sales_view, with_clean
from .spec import DROP_COLUMNS, TEST_SALES

CONT = ["NSU", "Sales at Cost", "Gross Sales", "MRP"]
NUM5 = CONT + ["SP"]
NOMINAL = ["NAME", "ZONE", "Brand", "MC"]
DATE_PARTS = ["Fdate_year", "Fdate_month", "Fdate_quarter"]
CLEAN_COLS = NOMINAL + NUM5 + DATE_PARTS
CAT7 = NOMINAL + DATE_PARTS
SMALL_CATS = ["ZONE", "Brand", "MC"] + DATE_PARTS  # fewer than 50 categories
SCALE_COLS = CONT + DATE_PARTS
# Categories of the test tables (region names, part types).
ZONES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
RARE_TOL = 0.04
INTERVAL_ORIGIN = TEST_SALES.interval_origin

QUERIES: dict = {}


def q(name, doubles=(), sql=None, digits: int = 9):
    """Register a query.  ``digits``: significant digits kept on both sides
    (6 for per-row values that depend on fitted coefficients, whose last bits
    differ between the engines' solvers)."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(spark, sf_dir), digits)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = (run, wrap_sql(sql, doubles, digits) if sql is not None else None)
        return fn
    return deco


def clean_table(spark, sf_dir) -> DataFrame:
    table, _ = CL.drop_irrelevant(CL.clean(sales_view(spark, sf_dir), TEST_SALES))
    return table


def held_table(spark, sf_dir, *columns) -> DataFrame:
    """The clean table (or some columns) written once, for queries that read it several
    times: the joins below it then run once."""
    t = clean_table(spark, sf_dir)
    return written_table(t.select(*[c(x) for x in columns]) if columns else t, "clean")


def _qi(n):  # quoted SQL identifier
    return f'"{n}"'


# =========================================================== cleaning ======

@q("clean_sales", NUM5, with_clean("SELECT * FROM clean"))
def clean_sales(spark, sf):
    """The cleaned feature table."""
    return clean_table(spark, sf)


@q("date_parts_text", NUM5, with_clean(
    "SELECT * REPLACE (CAST(Fdate_year AS VARCHAR) AS Fdate_year, CAST(Fdate_month AS VARCHAR) AS Fdate_month, "
    "CAST(Fdate_quarter AS VARCHAR) AS Fdate_quarter) FROM clean"))
def date_parts_text(spark, sf):
    """Date parts as text (profiling view of the reference)."""
    return CL.date_parts_as_text(clean_table(spark, sf))


@q("scoring_columns", ["NSU", "MRP", "gross_unrounded"], with_clean(
    'SELECT "NSU", "MRP", "Fdate_month", CAST(ceil("Fdate_month" / 3) AS INTEGER) AS quarter_from_month, '
    '"NSU" * "MRP" AS gross_unrounded FROM clean'))
def scoring_columns(spark, sf):
    """P13 + P14: quarter from month and unrounded gross sales."""
    t = clean_table(spark, sf)
    return t.select("NSU", "MRP", "Fdate_month", CL.quarter_from_month().alias("quarter_from_month"),
                    (c("NSU") * c("MRP")).alias("gross_unrounded"))


_DUP_SQL = ("SELECT * EXCLUDE (_c, i) FROM (SELECT *, count(*) AS _c FROM clean GROUP BY ALL) t, "
            "range(1, t._c) r(i)")


@q("duplicate_repeats", NUM5, with_clean(_DUP_SQL))
def duplicate_repeats(spark, sf):
    """The k-1 repeats of every row present k times."""
    _, rep = CL.split_duplicates(clean_table(spark, sf))
    return rep


@q("deduplicated", NUM5, with_clean("SELECT DISTINCT * FROM clean"))
def deduplicated(spark, sf):
    """One row per distinct row (NULLs equal)."""
    kept, _ = CL.split_duplicates(clean_table(spark, sf))
    return kept


_RAW_DOUBLES = ["NSU", "NSV", "GST Value", "NSV-GST", "Sales at Cost", "(NSV-GST)-SALES AT COST", "MARGIN%",
                "Gross Sales", "Gross RGM(P-L)", "Gross Margin %(Q/P*100)", "MRP", "SP", "DIS", "DIS%"]


_APPENDED_SQL = ("appended AS (SELECT * FROM clean UNION ALL SELECT * FROM clean WHERE Fdate_quarter = 1 "
                 "UNION ALL SELECT * FROM clean WHERE Fdate_month = 2)")


def _appended(spark, sf):
    """The cleaned table with one quarter in it twice and one month of that three times."""
    t = clean_table(spark, sf)
    return t.unionByName(t.where("Fdate_quarter = 1")).unionByName(t.where("Fdate_month = 2"))


@q("appended_repeats", NUM5, with_clean(_DUP_SQL.replace("FROM clean", "FROM appended"), _APPENDED_SQL))
def appended_repeats(spark, sf):
    """D1 on a table that holds repeats: the k-1 repeats of every row present k times."""
    return CL.split_duplicates(_appended(spark, sf))[1]


@q("appended_deduplicated", NUM5, with_clean("SELECT DISTINCT * FROM appended", _APPENDED_SQL))
def appended_deduplicated(spark, sf):
    """D1 on a table that holds repeats: one row per distinct row."""
    return CL.split_duplicates(_appended(spark, sf))[0]


def _written_csv(rows, path):
    """``rows`` as compressed CSV, in a folder for each ``_part`` if they have that column: a reader takes such a file
    whole, so files are bounded."""
    parts = [x for x in rows.columns if x == "_part"]
    rows.write.partitionBy(parts).option("header", True).option("compression", "gzip").option("maxRecordsPerFile", 500_000).csv(path)
    return path


def _ingested(spark, sf, check_lengths):
    """The read-back table, the rejects and the CSV that these are read from."""
    from .session import discard, scratch_path
    from .sources import ingest as IN
    csv_dir = _written_csv(sales_view(spark, sf), scratch_path(spark, "batch-csv"))
    discard(spark)
    return *IN.ingest(spark, csv_dir, scratch_path(spark, "sales-table"), check_lengths=check_lengths), csv_dir


@q("sales_ingest", _RAW_DOUBLES, "WITH " + SALES_SQL +
   ' SELECT DISTINCT * REPLACE (CAST("UID" AS INTEGER) AS "UID") FROM sales')
def sales_ingest(spark, sf):
    """CSV batch -> declared schema -> table -> distinct read-back."""
    from .session import discard
    compiled, _, csv_dir = _ingested(spark, sf, check_lengths=False)
    discard(spark, csv_dir)  # the table holds its rows; the rejects, which would be read from it, aren't wanted
    return compiled


def _raw_text(spark, sf):
    """The raw sales rows as text with blanks, ``null`` and unreadable numbers among them."""
    t = sales_view(spark, sf)
    text = t.select(*[c(n).cast("string").alias(n) for n in t.columns])
    uid = c("UID").cast("long")
    return text.withColumns({"Brand": F.when(uid % 31 == 0, "   ").when(uid % 37 == 0, "null").otherwise(c("Brand")),
                             "NSU": F.when(uid % 50 == 0, "n/a").otherwise(c("NSU"))})


def _batch_table(spark, sf):
    """Three loads: half of the rows, the same batch again, and all rows."""
    from .session import discard, path_exists, scratch_path
    from .sources import batches as BA
    table = BA.BatchTable(spark, scratch_path(spark, "batch-table"))
    text, uid = _raw_text(spark, sf), c("UID").cast("long")
    # each row is written once, whatever batches it is in, and the view's joins run once for all parts
    own = {"even": uid % 2 == 0, "odd": F.coalesce(uid % 2 != 0, F.lit(True)), "fives": uid % 5 == 0}
    part = F.explode(F.array_compact(F.array(*[F.when(e, F.lit(p)) for p, e in own.items()])))
    top = _written_csv(text.withColumn("_part", part), scratch_path(spark, "batch-csv"))
    csv = {p: f"{top}/_part={p}" for p in own}
    for folder in csv.values():
        if not path_exists(spark, folder):  # a part without rows
            _written_csv(text.where("false"), folder)
    discard(spark)
    for name, parts in (("half", ["even"]), ("half", ["even", "odd"]), ("all", ["even", "odd", "fives"])):
        table.load(name, [csv[p] for p in parts])
    discard(spark)
    return table


_BATCH_SQL = "WITH " + SALES_SQL + """, raw AS (
  SELECT * REPLACE (CAST("UID" AS INTEGER) AS "UID", CASE WHEN "UID" % 50 <> 0 THEN "NSU" END AS "NSU",
                    CASE WHEN "UID" % 31 <> 0 AND "UID" % 37 <> 0 THEN "Brand" END AS "Brand"),
         concat_ws('; ', CASE WHEN "UID" % 50 = 0 THEN 'unparseable row' END, CASE WHEN length("ZONE") > 5 THEN 'ZONE longer than 5' END) AS reason
  FROM sales)"""


@q("batch_rows", _RAW_DOUBLES, _BATCH_SQL + " SELECT DISTINCT * EXCLUDE (reason) FROM raw WHERE reason = ''")
def batch_rows(spark, sf):
    """Three loads through the commit log, each row once."""
    return _batch_table(spark, sf).rows()


@q("batch_rejects", _RAW_DOUBLES, _BATCH_SQL + " SELECT raw.* FROM raw, range(0, CASE WHEN \"UID\" % 2 = 0 THEN 2 ELSE 1 END + CASE WHEN \"UID\" % 5 = 0 THEN 1 ELSE 0 END) AS r(i) WHERE reason <> ''")
def batch_rejects(spark, sf):
    """The rejects of all loads with their reasons."""
    return _batch_table(spark, sf).rejects()


@q("batch_log", (), _BATCH_SQL + """, loads AS (
  SELECT 'half' AS batch, *, "UID" % 2 = 0 AS fresh FROM raw WHERE "UID" % 2 = 0
  UNION ALL SELECT 'all', raw.*, "UID" % 2 <> 0 FROM raw, range(0, CASE WHEN "UID" % 5 = 0 THEN 2 ELSE 1 END) AS r(i)),
kept AS (SELECT batch, count(*) AS n FROM (SELECT DISTINCT * FROM loads WHERE fresh AND reason = '') GROUP BY batch),
seen AS (SELECT batch, count(*) FILTER (WHERE reason = '') AS good, count(*) FILTER (WHERE reason <> '') AS rejects FROM loads GROUP BY batch)
SELECT batch, n AS "rows", good - n AS repeats, rejects FROM seen JOIN kept USING (batch)""")
def batch_log(spark, sf):
    """The commit log: rows kept, repeats left out and rejects of each batch."""
    return _batch_table(spark, sf).log().select("batch", "rows", "repeats", "rejects")


@q("ingest_rejects", _RAW_DOUBLES, "WITH " + SALES_SQL +
   ' SELECT * REPLACE (CAST("UID" AS INTEGER) AS "UID"), \'ZONE longer than 5\' AS reason '
   'FROM sales WHERE length("ZONE") > 5')
def ingest_rejects(spark, sf):
    """Rows failing the declared checks (ZONE is varchar(5)) with a reason."""
    _, rejects, _ = _ingested(spark, sf, check_lengths=True)
    return rejects


# =========================================================== encoders ======

@q("interval_encoding", NUM5, with_clean(
    f"SELECT * REPLACE (Fdate_year - {INTERVAL_ORIGIN} AS Fdate_year) FROM clean"))
def interval_encoding(spark, sf):
    """Year minus a fixed origin."""
    t = clean_table(spark, sf)
    return FE.IntervalEncoder("Fdate_year", INTERVAL_ORIGIN).fit(t).transform(t)


_CYC = ", ".join(
    f"sin({col} * (2 * pi() / (SELECT max({col}) FROM clean))) AS {col}_sin, "
    f"cos({col} * (2 * pi() / (SELECT max({col}) FROM clean))) AS {col}_cos"
    for col in ("Fdate_month", "Fdate_quarter"))


@q("cyclical_encoding", NUM5 + ["Fdate_month_sin", "Fdate_month_cos", "Fdate_quarter_sin", "Fdate_quarter_cos"],
   with_clean(f"SELECT * EXCLUDE (Fdate_month, Fdate_quarter), {_CYC} FROM clean"))
def cyclical_encoding(spark, sf):
    """sin/cos of month and quarter over their fitted maximum."""
    t = clean_table(spark, sf)
    return FE.CyclicalEncoder(["Fdate_month", "Fdate_quarter"]).fit(t).transform(t)


_OH = ", ".join([f"CAST(\"ZONE\" = '{v}' AS INTEGER) AS \"ZONE_{v}\"" for v in ZONES]
                + [f"CAST(\"MC\" = '{v}' AS INTEGER) AS \"MC_{v}\"" for v in PART_TYPES])


@q("one_hot_encoding", NUM5, with_clean(f'SELECT * EXCLUDE ("ZONE", "MC"), {_OH} FROM clean'))
def one_hot_encoding(spark, sf):
    """One 0/1 column per category, no drop-last."""
    t = clean_table(spark, sf)
    return FE.OneHotEncoder(["ZONE", "MC"]).fit(t).transform(t)


@q("one_hot_nominals")
def one_hot_nominals(spark, sf):
    """P12 over all four nominals (the SQL of one_hot_encoding has two of them)."""
    t = clean_table(spark, sf)
    return FE.OneHotEncoder(NOMINAL).fit(t).transform(t)


_SPARSE_SQL = ("seen AS (" + " UNION ".join(f'SELECT {i} AS place, "{x}" AS category FROM clean' for i, x in enumerate(NOMINAL)) + "), "
               "numbers AS (SELECT place, category, row_number() OVER (ORDER BY place, category) - 1 AS at FROM seen WHERE category IS NOT NULL)")


@q("sparse_one_hot", NUM5, with_clean(
    "SELECT clean.*, (SELECT count(*) FROM numbers)::INTEGER AS n_entries, concat_ws(',', " + ", ".join(f"n{i}.at" for i in range(len(NOMINAL)))
    + ") AS entries FROM clean " + " ".join(f'LEFT JOIN numbers n{i} ON n{i}.place = {i} AND n{i}.category = clean."{x}"' for i, x in enumerate(NOMINAL)),
    _SPARSE_SQL))
def sparse_one_hot(spark, sf):
    """P12 over all four nominals as one sparse vector a row, its entries numbered by column and category."""
    from .operators.sparse import SparseOneHotEncoder
    t = clean_table(spark, sf)
    rows = SparseOneHotEncoder(NOMINAL).fit(t).transform(t).withColumn("v", F.unwrap_udt("encoded"))
    return rows.select(*CLEAN_COLS, F.col("v.size").alias("n_entries"), F.concat_ws(",", F.col("v.indices").cast("array<string>")).alias("entries"))


@q("sparse_ridge_coefficients")
def sparse_ridge_coefficients(spark, sf):
    """P12 + M2: ridge on the continuous features and the sparse vector of all categories; coefficients by name."""
    from pyspark.ml.regression import LinearRegression

    from .operators.sparse import SparseOneHotEncoder
    t = clean_table(spark, sf)
    enc = SparseOneHotEncoder(NOMINAL, CONT).fit(t)
    fit = LinearRegression(featuresCol="encoded", labelCol="SP", regParam=0.1, solver="l-bfgs").fit(enc.transform(t).where("encoded is not null"))
    return enc.named(fit.coefficients)


def _rare_case(col):
    return (f'CASE WHEN (SELECT count(DISTINCT "{col}") FROM clean) <= 10 '
            f'OR "{col}" IN (SELECT "{col}" FROM clean GROUP BY 1 '
            f'HAVING count(*) / (SELECT count("{col}") FROM clean) >= {RARE_TOL}) '
            f'THEN "{col}" ELSE \'Rare\' END AS "{col}"')


@q("rare_labels", NUM5, with_clean(
    "SELECT * REPLACE (" + ", ".join(_rare_case(x) for x in NOMINAL) + ") FROM clean"))
def rare_labels(spark, sf):
    """categories under 4 % share become 'Rare' (columns with > 10 categories)."""
    t = clean_table(spark, sf)
    return FE.RareLabelEncoder(NOMINAL, tol=RARE_TOL).fit(t).transform(t)


def _te_join(col):
    return (f'LEFT JOIN (SELECT "{col}" AS _k, (sum("SP") + (SELECT avg("SP") FROM clean)) / (count("SP") + 1) AS _e '
            f'FROM clean GROUP BY 1) te_{col} ON clean."{col}" = te_{col}._k')


@q("target_encoding", NUM5 + NOMINAL, with_clean(
    "SELECT clean.* REPLACE (" + ", ".join(
        f'coalesce(te_{x}._e, (SELECT avg("SP") FROM clean)) AS "{x}"' for x in NOMINAL) + ") FROM clean "
    + " ".join(_te_join(x) for x in NOMINAL)))
def target_encoding(spark, sf):
    """smoothed target mean (Σy + ȳ)/(n + 1) per category."""
    t = clean_table(spark, sf)
    return FE.TargetEncoder(NOMINAL, "SP").fit(t).transform(t)


_PLACE_KEY = NOMINAL + DATE_PARTS


def _ordered_sql(col):
    order = "md5(concat_ws('|', '42', " + ", ".join(f"coalesce(CAST(\"{x}\" AS VARCHAR), '')" for x in _PLACE_KEY) + ")), " + ", ".join(f'"{x}" NULLS FIRST' for x in NUM5)
    w = f'OVER (PARTITION BY "{col}" ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)'
    return f'(coalesce(sum("SP") {w}, 0) + m) / (count("SP") {w} + 1) AS "{col}"'


def _ordered_encoder():
    from .operators.ordered_target import OrderedTargetEncoder
    return OrderedTargetEncoder(NOMINAL, "SP", key=_PLACE_KEY, ties=NUM5)


@q("ordered_target_statistics", NUM5 + NOMINAL, with_clean(
    "SELECT " + ", ".join([*map(_ordered_sql, NOMINAL), *map(_qi, NUM5 + DATE_PARTS)])
    + ' FROM clean, (SELECT avg("SP") AS m FROM clean)'))
def ordered_target_statistics(spark, sf):
    """Every nominal encoded by the rows before it in a seeded order."""
    t = held_table(spark, sf)
    return _ordered_encoder().fit(t).training(t)


# ========================================================= group stats =====

def _group_sql(key, suffix):
    parts = []
    for col in CONT:
        parts += [f'avg("{col}") AS "{col}_mean_{suffix}"', f'stddev_samp("{col}") AS "{col}_std_{suffix}"',
                  f'median("{col}") AS "{col}_median_{suffix}"']
    return f'SELECT "{key}", {", ".join(parts)} FROM clean WHERE "{key}" IS NOT NULL GROUP BY "{key}"'


def _group_cols(suffix):
    return [f"{col}_{s}_{suffix}" for col in CONT for s in ("mean", "std", "median")]


@q("zone_group_stats", _group_cols("Zone"), with_clean(_group_sql("ZONE", "Zone")))
def zone_group_stats(spark, sf):
    """A1: mean / sample std / exact median of the continuous columns per ZONE."""
    return FE.group_stats(clean_table(spark, sf), "ZONE", CONT, "Zone")


@q("brand_group_stats", _group_cols("Brand"), with_clean(_group_sql("Brand", "Brand")))
def brand_group_stats(spark, sf):
    """A2: the same per Brand."""
    return FE.group_stats(clean_table(spark, sf), "Brand", CONT, "Brand")


@q("brand_mc_nunique", (), with_clean(
    'SELECT "Brand", count(DISTINCT "MC") AS "Brand_MC_nunique" FROM clean WHERE "Brand" IS NOT NULL GROUP BY 1'))
def brand_mc_nunique(spark, sf):
    """A3: distinct MC per Brand."""
    t = clean_table(spark, sf)
    return t.where(c("Brand").isNotNull()).groupBy("Brand").agg(F.countDistinct("MC").alias("Brand_MC_nunique"))


@q("group_stat_features", NUM5 + _group_cols("Zone") + _group_cols("Brand"), with_clean(
    "SELECT * FROM clean LEFT JOIN zs USING (\"ZONE\") LEFT JOIN bs USING (\"Brand\") LEFT JOIN bm USING (\"Brand\")",
    f"zs AS ({_group_sql('ZONE', 'Zone')}), bs AS ({_group_sql('Brand', 'Brand')}), "
    'bm AS (SELECT "Brand", count(DISTINCT "MC") AS "Brand_MC_nunique" FROM clean GROUP BY 1)'))
def group_stat_features(spark, sf):
    """F5 = A1-A3 joined back (J1-J3): 25 new columns per row."""
    t = held_table(spark, sf)
    return FE.GroupStatFeatures(CONT).fit(t).transform(t)


# ============================================================ profile ======

_TYPES = {**{n: "string" for n in NOMINAL}, **{n: "double" for n in NUM5}, **{n: "int" for n in DATE_PARTS}}


@q("column_info", (), with_clean(" UNION ALL ".join(
    f"SELECT '{n}' AS name, count(\"{n}\") AS non_nulls, '{_TYPES[n]}' AS type FROM clean" for n in CLEAN_COLS)))
def column_info(spark, sf):
    """A4: non-null count and type per column."""
    return PR.column_info(clean_table(spark, sf))


@q("numeric_summary", ["mean", "std", "min", "25%", "50%", "75%", "max"], with_clean(" UNION ALL ".join(
    f"SELECT '{n}' AS variable, count(\"{n}\") AS count, avg(\"{n}\") AS mean, stddev_samp(\"{n}\") AS std, "
    f"min(\"{n}\") AS min, quantile_cont(\"{n}\", 0.25) AS \"25%\", quantile_cont(\"{n}\", 0.5) AS \"50%\", "
    f"quantile_cont(\"{n}\", 0.75) AS \"75%\", max(\"{n}\") AS max FROM clean" for n in NUM5)))
def numeric_summary(spark, sf):
    """A5: count, mean, std, min, exact quartiles, max per numeric column."""
    t = CL.date_parts_as_text(clean_table(spark, sf))
    return PR.numeric_summary(t, PR_numeric(t))


def PR_numeric(t):
    return [n for n, ty in t.dtypes if ty == "double"]


@q("distinct_counts", (), with_clean(" UNION ALL ".join(
    f"SELECT '{n}' AS \"Variable\", count(DISTINCT \"{n}\") AS \"Number\" FROM clean" for n in CLEAN_COLS)))
def distinct_counts(spark, sf):
    """Distinct values per column."""
    return PR.distinct_counts(clean_table(spark, sf))


@q("value_counts", (), with_clean(" UNION ALL ".join(
    f"SELECT '{n}' AS column, CAST(\"{n}\" AS VARCHAR) AS value, count(*) AS count FROM clean "
    f"WHERE \"{n}\" IS NOT NULL GROUP BY 2" for n in CAT7)))
def value_counts(spark, sf):
    """Value counts of the text columns and the date parts."""
    t = CL.date_parts_as_text(clean_table(spark, sf))
    return PR.value_counts(t, PR.profile_columns(t))


@q("category_shares", ["share"], with_clean(" UNION ALL ".join(
    f"SELECT '{n}' AS column, CAST(\"{n}\" AS VARCHAR) AS value, count(*) AS count, "
    f"count(*) / (SELECT count(*) FROM clean) * 100 AS share FROM clean WHERE \"{n}\" IS NOT NULL GROUP BY 2 "
    f"HAVING (SELECT count(DISTINCT \"{n}\") FROM clean) < 50" for n in CAT7)))
def category_shares(spark, sf):
    """Category share in percent, for columns with < 50 categories."""
    t = CL.date_parts_as_text(clean_table(spark, sf))
    return PR.category_shares(t, PR.profile_columns(t))


def _box_sql(label, key_expr, value, where="TRUE", key_name=None):
    key_sel = f"{key_expr} AS {key_name}, " if key_name else ""
    grp = f"GROUP BY {key_expr}" if key_name else ""
    join = f"ON {key_expr} = s.{key_name}" if key_name else "ON TRUE"
    return (
        f"(WITH s AS (SELECT {key_sel}quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS median, "
        f"quantile_cont({value}, 0.75) AS q3 FROM clean WHERE {value} IS NOT NULL AND {where} {grp}) "
        f"SELECT '{label}' AS column, {('s.' + key_name + ' AS category, ') if key_name else ''}"
        f"any_value(s.q1) AS q1, any_value(s.median) AS median, any_value(s.q3) AS q3, "
        f"any_value(s.q3 - s.q1) AS iqr, "
        f"min(CASE WHEN {value} BETWEEN s.q1 - 1.5 * (s.q3 - s.q1) AND s.q3 + 1.5 * (s.q3 - s.q1) THEN {value} END) AS whisker_low, "
        f"max(CASE WHEN {value} BETWEEN s.q1 - 1.5 * (s.q3 - s.q1) AND s.q3 + 1.5 * (s.q3 - s.q1) THEN {value} END) AS whisker_high, "
        f"CAST(sum(CASE WHEN {value} BETWEEN s.q1 - 1.5 * (s.q3 - s.q1) AND s.q3 + 1.5 * (s.q3 - s.q1) THEN 0 ELSE 1 END) AS BIGINT) AS outliers, "
        f"count(*) AS n FROM clean JOIN s {join} WHERE {value} IS NOT NULL AND {where} "
        f"{'GROUP BY s.' + key_name if key_name else ''})")


_BOX = ["q1", "median", "q3", "iqr", "whisker_low", "whisker_high"]


@q("box_by_category", _BOX, with_clean(" UNION ALL ".join(
    _box_sql(n, f'CAST("{n}" AS VARCHAR)', '"SP"', where=f'"{n}" IS NOT NULL', key_name="category")
    for n in SMALL_CATS)))
def box_by_category(spark, sf):
    """Box statistics of SP per category (columns with < 50 categories)."""
    t = CL.date_parts_as_text(held_table(spark, sf))
    return PR.box_by_category(t, PR.profile_columns(t), "SP")


@q("box_by_column", _BOX, with_clean(" UNION ALL ".join(_box_sql(n, None, f'"{n}"') for n in NUM5)))
def box_by_column(spark, sf):
    """A10: box statistics per numeric column."""
    return PR.box_by_column(held_table(spark, sf, *NUM5), NUM5)


@q("skewness", ["skewness"], with_clean(" UNION ALL ".join(
    f"SELECT '{n}' AS column, skewness(\"{n}\") AS skewness, count(\"{n}\") AS n FROM clean" for n in NUM5)))
def skewness(spark, sf):
    """Bias-corrected sample skewness."""
    return PR.skewness(clean_table(spark, sf), NUM5)


_KDE_SQL = " UNION ALL ".join(
    f"(WITH st AS (SELECT count(\"{n}\") AS n, stddev_samp(\"{n}\") * pow(count(\"{n}\"), -0.2) AS h, "
    f"min(\"{n}\") AS lo, max(\"{n}\") AS hi FROM clean), "
    f"g AS (SELECT CAST(i AS INTEGER) AS point, lo + i * ((hi - lo) / 499) AS x FROM st, range(0, 500) r(i)) "
    f"SELECT '{n}' AS column, g.point, any_value(g.x) AS x, "
    f"sum(exp(-0.5 * ((g.x - clean.\"{n}\") / st.h) * ((g.x - clean.\"{n}\") / st.h))) / (any_value(st.n) * any_value(st.h) * sqrt(2 * pi())) AS density, "
    f"sum(exp(-0.5 * ((g.x - clean.\"{n}\") / st.h) * ((g.x - clean.\"{n}\") / st.h))) / (any_value(st.n) * any_value(st.h) * sqrt(2 * pi())) * (any_value(st.hi) - any_value(st.lo)) AS density_scaled "
    f"FROM g, st, clean WHERE clean.\"{n}\" IS NOT NULL GROUP BY g.point)" for n in NUM5)


@q("kernel_density", ["x", "density", "density_scaled"], with_clean(_KDE_SQL))
def kernel_density(spark, sf):
    """Gaussian KDE (Scott bandwidth) on a 500-point grid per column."""
    return PR.kernel_density(held_table(spark, sf, *NUM5), NUM5)


_SCAT_SQL = " UNION ALL ".join(
    f"(WITH st AS (SELECT min(\"{n}\") AS xl, max(\"{n}\") AS xh, min(\"SP\") AS yl, max(\"SP\") AS yh FROM clean "
    f"WHERE \"{n}\" IS NOT NULL AND \"SP\" IS NOT NULL) "
    f"SELECT '{n}' AS column, "
    f"CAST(CASE WHEN xh - xl > 0 THEN least(floor((\"{n}\" - xl) / (xh - xl) * 50), 49) ELSE 0 END AS INTEGER) AS bin_x, "
    f"CAST(CASE WHEN yh - yl > 0 THEN least(floor((\"SP\" - yl) / (yh - yl) * 50), 49) ELSE 0 END AS INTEGER) AS bin_y, "
    f"count(*) AS count FROM clean, st WHERE \"{n}\" IS NOT NULL AND \"SP\" IS NOT NULL GROUP BY 2, 3)"
    for n in CONT)


@q("scatter_bins", (), with_clean(_SCAT_SQL))
def scatter_bins(spark, sf):
    """50 x 50 binned scatter of each continuous feature against SP."""
    return PR.scatter_bins(clean_table(spark, sf), CONT, "SP", 50)


def _rank_cte(cols):
    return ("ranked AS (SELECT " + ", ".join(
        f'rank() OVER (ORDER BY "{n}") + (count(*) OVER (PARTITION BY "{n}") - 1) / 2.0 AS "r_{n}"' for n in cols)
        + " FROM clean)")


def _spearman_sql(cols):
    parts = []
    for a in cols:
        for b in cols:
            if a == b:
                parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, CAST(1.0 AS DOUBLE) AS rho")
            else:
                parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr(\"r_{a}\", \"r_{b}\") AS rho FROM ranked")
    return " UNION ALL ".join(parts)


@q("spearman_matrix", ["rho"], with_clean(_spearman_sql(NUM5), _rank_cte(NUM5)))
def spearman_matrix(spark, sf):
    """Spearman correlation matrix of the numeric columns."""
    return PR.spearman_matrix(clean_table(spark, sf), NUM5)


def _pairs_sql(cols):
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr(\"r_{a}\", \"r_{b}\") AS rho FROM ranked")
    return ("SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE abs(rho) > 0.8 AND rho <> 1.0")


@q("high_correlation_pairs", ["rho"], with_clean(_pairs_sql(NUM5), _rank_cte(NUM5)))
def high_correlation_pairs(spark, sf):
    """Pairs with |Spearman ρ| > 0.8 (ρ ≠ 1)."""
    t = clean_table(spark, sf)
    return PR.high_correlation_pairs(PR.spearman_matrix(t, NUM5), NUM5)


def _cramer_sql(a, b):
    x, y = f'CAST("{a}" AS VARCHAR)', f'CAST("{b}" AS VARCHAR)'
    return (
        f"(WITH cells AS (SELECT {x} AS x, {y} AS y, count(*) AS o FROM clean WHERE \"{a}\" IS NOT NULL AND \"{b}\" IS NOT NULL GROUP BY 1, 2), "
        f"rt AS (SELECT x, sum(o) AS rt FROM cells GROUP BY 1), ct AS (SELECT y, sum(o) AS ct FROM cells GROUP BY 1), "
        f"agg AS (SELECT sum(o * o / (rt * ct)) AS s, sum(o) AS n, count(DISTINCT cells.x) AS r, count(DISTINCT cells.y) AS k "
        f"FROM cells JOIN rt USING (x) JOIN ct USING (y)), "
        f"v AS (SELECT greatest(0.0, (n * (s - 1.0)) / n - (k - 1) * (r - 1) / (n - 1)) AS phi2c, "
        f"r - (r - 1) * (r - 1) / (n - 1) AS rc, k - (k - 1) * (k - 1) / (n - 1) AS kc FROM agg), "
        f"w AS (SELECT CASE WHEN least(kc - 1, rc - 1) = 0 THEN 0.0 ELSE sqrt(phi2c / least(kc - 1, rc - 1)) END AS v FROM v) "
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, v AS assoc FROM w UNION ALL SELECT '{b}', '{a}', v FROM w)")


def _eta_sql(a, b):
    x = f'CAST("{a}" AS VARCHAR)'
    return (
        f"(WITH base AS (SELECT {x} AS x, \"{b}\" AS y FROM clean WHERE \"{a}\" IS NOT NULL AND \"{b}\" IS NOT NULL), "
        f"tot AS (SELECT avg(y) AS ybar, var_pop(y) * count(y) AS total FROM base), "
        f"g AS (SELECT count(y) AS nc, avg(y) AS yc FROM base GROUP BY x), "
        f"e AS (SELECT CASE WHEN any_value(total) = 0 THEN 0.0 ELSE sqrt(sum(nc * (yc - ybar) * (yc - ybar)) / any_value(total)) END AS v "
        f"FROM g, tot) "
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, v AS assoc FROM e UNION ALL SELECT '{b}', '{a}', v FROM e)")


def _assoc_sql():
    parts = [_spearman_sql(NUM5).replace(" AS rho", " AS assoc")]
    parts += [_cramer_sql(a, b) for i, a in enumerate(CAT7) for b in CAT7[i + 1:]]
    parts += [f"SELECT '{a}' AS col_a, '{a}' AS col_b, CAST(1.0 AS DOUBLE) AS assoc" for a in CAT7]
    parts += [_eta_sql(a, b) for a in CAT7 for b in NUM5]
    return " UNION ALL ".join(parts)


@q("mixed_association", ["assoc"], with_clean(_assoc_sql(), _rank_cte(NUM5)))
def mixed_association(spark, sf):
    """Spearman / Cramér's V (bias corrected) / correlation ratio."""
    t = CL.date_parts_as_text(held_table(spark, sf))
    return PR.mixed_association(t, CAT7, NUM5)


@q("distinct_values", (), with_clean(" UNION ALL ".join(
    f"SELECT DISTINCT '{n}' AS column, \"{n}\" AS value FROM clean WHERE \"{n}\" IS NOT NULL" for n in NOMINAL)))
def distinct_values(spark, sf):
    """Distinct values of the nominal columns (scoring form lists)."""
    return PR.distinct_values(clean_table(spark, sf), NOMINAL)


# ====================================================== fitted transforms ==

def _cap_sql(kind):
    parts = []
    for n in CONT:
        if kind == "iqr":
            lo = f"(SELECT quantile_cont(\"{n}\", 0.25) - 1.5 * (quantile_cont(\"{n}\", 0.75) - quantile_cont(\"{n}\", 0.25)) FROM clean)"
            hi = f"(SELECT quantile_cont(\"{n}\", 0.75) + 1.5 * (quantile_cont(\"{n}\", 0.75) - quantile_cont(\"{n}\", 0.25)) FROM clean)"
        else:
            lo = f"(SELECT avg(\"{n}\") - 3 * stddev_samp(\"{n}\") FROM clean)"
            hi = f"(SELECT avg(\"{n}\") + 3 * stddev_samp(\"{n}\") FROM clean)"
        parts.append(f'least(greatest("{n}", {lo}), {hi}) AS "{n}"')
    return "SELECT * REPLACE (" + ", ".join(parts) + ") FROM clean"


@q("outlier_cap_iqr", NUM5, with_clean(_cap_sql("iqr")))
def outlier_cap_iqr(spark, sf):
    """F2 (non-gaussian rule): cap at Q1 - 1.5 IQR, Q3 + 1.5 IQR."""
    t = clean_table(spark, sf)
    return FE.OutlierCapper(CONT, method="iqr").fit(t).transform(t)


@q("outlier_cap_gaussian", NUM5, with_clean(_cap_sql("gaussian")))
def outlier_cap_gaussian(spark, sf):
    """F2 (gaussian rule): cap at mean ± 3 sample std."""
    t = clean_table(spark, sf)
    return FE.OutlierCapper(CONT, method="gaussian").fit(t).transform(t)


YJ_FIXED = 0.5
_PT = {"log": 'ln("{n}")', "reciprocal": '1.0 / "{n}"', "sqrt": 'sqrt("{n}")', "square": '"{n}" * "{n}"',
       "yeojohnson": f'CASE WHEN "{{n}}" >= 0 THEN (pow("{{n}}" + 1, {YJ_FIXED}) - 1) / {YJ_FIXED} '
                     f'ELSE -(pow(1 - "{{n}}", {2 - YJ_FIXED}) - 1) / {2 - YJ_FIXED} END'}
_PT_COLS = [f"{n}_{k}" for n in CONT for k in _PT]


@q("power_transforms", NUM5 + _PT_COLS, with_clean(
    "SELECT *, " + ", ".join(f'{e.format(n=n)} AS "{n}_{k}"' for n in CONT for k, e in _PT.items()) + " FROM clean"))
def power_transforms(spark, sf):
    """F3a-F3e: log, reciprocal, square root, square, Yeo-Johnson (fixed λ)."""
    t = clean_table(spark, sf)
    names = {"log": "logarithmic", "reciprocal": "reciprocal", "sqrt": "square-root", "square": "square",
             "yeojohnson": "yeo-johnson"}
    return t.withColumns({f"{n}_{k}": FE._apply_simple(v, c(n), YJ_FIXED) for n in CONT for k, v in names.items()})


def _scale_sql(kind):
    parts = []
    for n in SCALE_COLS:
        if kind == "standard":
            e = (f'("{n}" - (SELECT avg("{n}") FROM clean)) / (SELECT CASE WHEN stddev_pop("{n}") = 0 THEN 1.0 '
                 f'ELSE stddev_pop("{n}") END FROM clean)')
        elif kind == "minmax":
            e = (f'("{n}" - (SELECT min("{n}") FROM clean)) / (SELECT CASE WHEN max("{n}") = min("{n}") THEN 1.0 '
                 f'ELSE max("{n}") - min("{n}") END FROM clean)')
        else:
            e = (f'("{n}" - (SELECT median("{n}") FROM clean)) / (SELECT CASE WHEN quantile_cont("{n}", 0.75) = '
                 f'quantile_cont("{n}", 0.25) THEN 1.0 ELSE quantile_cont("{n}", 0.75) - quantile_cont("{n}", 0.25) END FROM clean)')
        parts.append(f'CAST({e} AS DOUBLE) AS "{n}"')
    return "SELECT * REPLACE (" + ", ".join(parts) + ") FROM clean"


def _scaler(kind):
    def fn(spark, sf):
        t = clean_table(spark, sf)
        return FE.Scaler(kind, columns=SCALE_COLS).fit(t).transform(t)
    fn.__doc__ = f"F8: {kind} scaling of the numeric features."
    return fn


for _k in ("standard", "minmax", "robust"):
    q(f"{_k}_scaling", NUM5 + DATE_PARTS, with_clean(_scale_sql(_k)))(_scaler(_k))


# ========================================================== selection ======

FEATS7 = CONT + DATE_PARTS


@q("f_regression_scores", ["r", "f_score"], with_clean(" UNION ALL ".join(
    f"SELECT '{n}' AS feature, corr(\"{n}\", \"SP\") AS r, "
    f"corr(\"{n}\", \"SP\") * corr(\"{n}\", \"SP\") / (1 - corr(\"{n}\", \"SP\") * corr(\"{n}\", \"SP\")) * (count(*) - 2) AS f_score "
    f"FROM clean" for n in FEATS7)))
def f_regression_scores(spark, sf):
    """V5: univariate F-statistic of each feature against SP."""
    from .operators import selection as SE
    return SE.f_regression(clean_table(spark, sf), FEATS7, "SP")


@q("top_k_f_scores", ["f_score"], with_clean(
    "SELECT feature, f_score FROM (" + " UNION ALL ".join(
        f"SELECT '{n}' AS feature, corr(\"{n}\", \"SP\") * corr(\"{n}\", \"SP\") / (1 - corr(\"{n}\", \"SP\") * corr(\"{n}\", \"SP\")) * (count(*) - 2) AS f_score FROM clean"
        for n in FEATS7) + ") ORDER BY f_score DESC, feature LIMIT 3"))
def top_k_f_scores(spark, sf):
    """D3: the top-3 features by F-score (a top-k report; ties by name)."""
    from .operators import selection as SE
    return SE.top_k(SE.f_regression(clean_table(spark, sf), FEATS7, "SP").select("feature", "f_score"),
                    "f_score", 3)


def _mi_sql(n, bins=10):
    bx = f'CASE WHEN xh > xl THEN least(floor(("{n}" - xl) / (xh - xl) * {bins}), {bins - 1}) ELSE 0 END'
    byy = f'CASE WHEN yh > yl THEN least(floor(("SP" - yl) / (yh - yl) * {bins}), {bins - 1}) ELSE 0 END'
    return (f"(WITH st AS (SELECT min(\"{n}\") AS xl, max(\"{n}\") AS xh, min(\"SP\") AS yl, max(\"SP\") AS yh, count(*) AS n "
            f"FROM clean WHERE \"{n}\" IS NOT NULL AND \"SP\" IS NOT NULL), "
            f"b AS (SELECT {bx} AS bx, {byy} AS byy FROM clean, st WHERE \"{n}\" IS NOT NULL AND \"SP\" IS NOT NULL), "
            f"j AS (SELECT bx, byy, count(*) AS nxy FROM b GROUP BY 1, 2), "
            f"mx AS (SELECT bx, count(*) AS nx FROM b GROUP BY 1), my AS (SELECT byy, count(*) AS ny FROM b GROUP BY 1) "
            f"SELECT '{n}' AS feature, sum(nxy / st.n * ln(nxy * st.n / (nx * ny))) AS mi "
            f"FROM j JOIN mx USING (bx) JOIN my USING (byy), st)")


@q("mutual_information", ["mi"], with_clean(" UNION ALL ".join(_mi_sql(n) for n in FEATS7)))
def mutual_information(spark, sf):
    """V4 (re-aimed): binned mutual information of each feature with SP."""
    from .operators import selection as SE
    return SE.mutual_information(clean_table(spark, sf), FEATS7, "SP", bins=10)


# ================================================ evaluation (baselines) ===

_BASE_MODELS = ["Brand", "MC", "NAME"]


def _cv_pred_sql(group, alpha=0.0, model=None):
    model = model or f"{group}_mean"
    return (
        f"(WITH base AS (SELECT CAST(\"{group}\" AS VARCHAR) AS g, \"ZONE\" AS fold, \"SP\" AS actual FROM clean), "
        f"per AS (SELECT g, fold, sum(actual) AS s, count(*) AS n FROM base GROUP BY 1, 2), "
        f"tg AS (SELECT g, sum(s) AS g_s, sum(n) AS g_n FROM per GROUP BY 1), "
        f"pf AS (SELECT fold, sum(s) AS fs, sum(n) AS fn FROM per GROUP BY 1), "
        f"pr AS (SELECT fold, (sum(fs) OVER () - fs) / (sum(fn) OVER () - fn) AS prior FROM pf), "
        f"tr AS (SELECT per.g, per.fold, g_s - s AS ts, g_n - n AS tn FROM per JOIN tg USING (g)), "
        f"pt AS (SELECT tr.g, tr.fold, CASE WHEN tn + {alpha} > 0 THEN (ts + {alpha} * prior) / (tn + {alpha}) END AS p "
        f"FROM tr JOIN pr USING (fold)) "
        f"SELECT '{model}' AS model, base.fold, base.actual, coalesce(pt.p, pr.prior) AS predicted "
        f"FROM base LEFT JOIN pt ON base.g = pt.g AND base.fold = pt.fold LEFT JOIN pr ON base.fold = pr.fold)")


_PRED_ALL = " UNION ALL ".join(_cv_pred_sql(g) for g in _BASE_MODELS)
_METRICS_SQL = ("SELECT model, fold, sqrt(avg((predicted - actual) * (predicted - actual))) AS rmse, "
                "avg(abs(predicted - actual)) AS mae, median(abs(predicted - actual)) AS median_ae "
                "FROM preds GROUP BY 1, 2")


def _cv_metrics(spark, sf):
    t = held_table(spark, sf, *_BASE_MODELS, "ZONE", "SP")
    preds = None
    for g in _BASE_MODELS:
        p = BL.grouped_cv_predictions(t, g, "ZONE", "SP")
        preds = p if preds is None else preds.unionByName(p)
    return written_table(BL.fold_metrics(written_table(preds, "predictions")), "fold-metrics")


@q("cv_fold_metrics", ["rmse", "mae", "median_ae"], with_clean(_METRICS_SQL, f"preds AS ({_PRED_ALL})"))
def cv_fold_metrics(spark, sf):
    """A21 + grouped CV: RMSE / MAE / median AE of group-mean predictors
    (Brand, MC, NAME) for each leave-one-ZONE-out fold."""
    return _cv_metrics(spark, sf)


_AVG_SQL = ("SELECT model, avg(rmse) AS avg_rmse, stddev_pop(rmse) AS std_rmse, avg(mae) AS avg_mae, "
            "stddev_pop(mae) AS std_mae, avg(median_ae) AS avg_median_ae, stddev_pop(median_ae) AS std_median_ae "
            "FROM m GROUP BY 1")
_AVG_COLS = ["avg_rmse", "std_rmse", "avg_mae", "std_mae", "avg_median_ae", "std_median_ae"]


@q("cv_fold_averages", _AVG_COLS, with_clean(_AVG_SQL, f"preds AS ({_PRED_ALL}), m AS ({_METRICS_SQL})"))
def cv_fold_averages(spark, sf):
    """Mean and population std of every metric over the folds."""
    return BL.fold_averages(_cv_metrics(spark, sf))


@q("best_model_per_metric", ["value"], with_clean(
    " UNION ALL ".join(f"SELECT '{m}' AS metric, arg_min(model, ({m}, model)) AS model, min({m}) AS value FROM a"
                       for m in ("avg_rmse", "avg_mae", "avg_median_ae")),
    f"preds AS ({_PRED_ALL}), m AS ({_METRICS_SQL}), a AS ({_AVG_SQL})"))
def best_model_per_metric(spark, sf):
    """Arg-min model per averaged metric."""
    return BL.best_per_metric(BL.fold_averages(_cv_metrics(spark, sf)))


_ALPHAS = [0.0, 1.0, 5.0, 20.0, 100.0]
_TRIALS_SQL = " UNION ALL ".join(
    f"SELECT {i} AS number, CAST({a} AS DOUBLE) AS alpha, avg(rmse) AS value FROM (SELECT model, fold, "
    f"sqrt(avg((predicted - actual) * (predicted - actual))) AS rmse FROM {_cv_pred_sql('Brand', a, 'Brand_smoothed')} "
    f"GROUP BY 1, 2)" for i, a in enumerate(_ALPHAS))


@q("best_trial", ["alpha", "value"], with_clean(
    "SELECT number, alpha, value FROM trials ORDER BY value, number LIMIT 1", f"trials AS ({_TRIALS_SQL})"))
def best_trial(spark, sf):
    """Best of a grid of smoothing strengths for the Brand-mean model
    (trial table: number, alpha, value = mean CV RMSE)."""
    t = clean_table(spark, sf)
    rows = None
    for i, a in enumerate(_ALPHAS):
        p = BL.grouped_cv_predictions(t, "Brand", "ZONE", "SP", alpha=a, model="Brand_smoothed")
        m = (p.groupBy("model", "fold").agg(F.sqrt(F.avg((F.col("predicted") - F.col("actual")) ** 2)).alias("rmse"))
             .agg(F.avg("rmse").alias("value"))
             .select(F.lit(i).alias("number"), F.lit(float(a)).alias("alpha"), "value"))
        rows = m if rows is None else rows.unionByName(m)
    return BL.best_trial(rows)



# ============================================ export / append (S8, S10) ====

@q("export_roundtrip", NUM5, with_clean("SELECT * FROM clean"))
def export_roundtrip(spark, sf):
    """The cleaned table exported as CSV (header, no index) and read back
    with its schema."""
    from .session import scratch_path
    from .sources import ingest as IN
    t = clean_table(spark, sf)
    path = scratch_path(spark, "export-csv")
    IN.export(t, path, "csv")
    return spark.read.schema(t.schema).option("header", True).csv(path)


@q("append_results", ["rmse", "mae", "median_ae"], with_clean(
    "SELECT * FROM m UNION ALL SELECT * FROM m", f"preds AS ({_PRED_ALL}), m AS ({_METRICS_SQL})"))
def append_results(spark, sf):
    """A result table appended twice (header-once, rows accumulate)."""
    from .session import scratch_path
    from .sources import ingest as IN
    path = scratch_path(spark, "results")
    m = _cv_metrics(spark, sf)
    IN.append_result(m, path)
    IN.append_result(m, path)
    return spark.read.parquet(path)


# ============================================= diagnostics / linear SHAP ===

def _ols2_sql():
    return (
        "st AS (SELECT avg(\"MRP\") AS m1, avg(\"NSU\") AS m2, avg(\"SP\") AS my FROM clean), "
        "cs AS (SELECT sum((\"MRP\" - m1) * (\"MRP\" - m1)) AS s11, sum((\"NSU\" - m2) * (\"NSU\" - m2)) AS s22, "
        "sum((\"MRP\" - m1) * (\"NSU\" - m2)) AS s12, sum((\"MRP\" - m1) * (\"SP\" - my)) AS s1y, "
        "sum((\"NSU\" - m2) * (\"SP\" - my)) AS s2y FROM clean, st), "
        "co AS (SELECT (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1, "
        "(s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM cs), "
        "fit AS (SELECT b1, b2, my - b1 * m1 - b2 * m2 AS a, m1, m2 FROM co, st)")


@q("ols_residuals", ["MRP", "NSU", "SP", "predicted", "residual"], with_clean(
    "SELECT \"MRP\", \"NSU\", \"SP\", a + b1 * \"MRP\" + b2 * \"NSU\" AS predicted, "
    "a + b1 * \"MRP\" + b2 * \"NSU\" - \"SP\" AS residual FROM clean, fit", _ols2_sql()), digits=6)
def ols_residuals(spark, sf):
    """G1: residual = predicted - actual of a least-squares fit SP ~ MRP + NSU."""
    from .plans import diagnose as DG
    t = clean_table(spark, sf).select("MRP", "NSU", "SP")
    a, beta, _ = DG.ols(t, ["MRP", "NSU"], "SP")
    pred = F.lit(a) + F.lit(float(beta[0])) * c("MRP") + F.lit(float(beta[1])) * c("NSU")
    return DG.residuals(t.withColumn("predicted", pred), "SP", "predicted")


_COOK_SQL = (
    "WITH m AS (SELECT avg(\"MRP\") AS mx, avg(\"SP\") AS my, count(*) AS n, sum(\"MRP\" * \"MRP\") AS sxx0 FROM clean), "
    "f AS (SELECT sum((\"MRP\" - mx) * (\"SP\" - my)) / sum((\"MRP\" - mx) * (\"MRP\" - mx)) AS b FROM clean, m), "
    "fit AS (SELECT b, my - b * mx AS a, n, sxx0 FROM f, m), "
    "r AS (SELECT \"MRP\", \"SP\", a + b * \"MRP\" AS predicted, \"SP\" - (a + b * \"MRP\") AS res, "
    "\"MRP\" * \"MRP\" / sxx0 AS leverage, n FROM clean, fit), "
    "s AS (SELECT sum(res * res) / (any_value(n) - 1) AS mse FROM r) "
    "SELECT \"MRP\", \"SP\", predicted, leverage, res * res * leverage / (1 * mse * (1 - leverage) * (1 - leverage)) AS cooks_d, "
    "res * res * leverage / (1 * mse * (1 - leverage) * (1 - leverage)) > 4.0 / n AS influential FROM r, s")


@q("cooks_distance", ["MRP", "SP", "predicted", "leverage", "cooks_d"], with_clean(
    "SELECT * FROM (" + _COOK_SQL + ")"), digits=6)
def cooks_distance(spark, sf):
    """Leverage, Cook's distance and the 4/n influence flag (SP ~ MRP)."""
    from .plans import diagnose as DG
    t = clean_table(spark, sf).select("MRP", "SP")
    return DG.cooks_distance(t, ["MRP"], "SP").select("MRP", "SP", "predicted", "leverage", "cooks_d", "influential")


_QR_SQL = _ols2_sql() + """,
raw AS (SELECT sum("MRP" * "MRP") AS aa, sum("MRP" * "NSU") AS ab, sum("NSU" * "NSU") AS bb, count(*) AS n FROM clean),
r AS (SELECT "MRP", "NSU", "SP", n, a + b1 * "MRP" + b2 * "NSU" AS predicted, a + b1 * "MRP" + b2 * "NSU" - "SP" AS residual,
             ("MRP" * "MRP" * bb - 2 * "MRP" * "NSU" * ab + "NSU" * "NSU" * aa) / (aa * bb - ab * ab) AS leverage FROM clean, fit, raw),
s AS (SELECT sum(residual * residual) / (any_value(n) - 2) AS mse FROM r),
d AS (SELECT r.*, residual * residual * leverage / (2 * mse * (1 - leverage) * (1 - leverage)) AS cooks_d FROM r, s)"""


def _collinear(spark, sf):
    return clean_table(spark, sf).select("MRP", "NSU", "SP").withColumn("BLEND", 2 * c("MRP") + 3 * c("NSU"))


@q("qr_cooks_distance", ["MRP", "NSU", "SP", "predicted", "residual", "leverage", "cooks_d"], with_clean(
    'SELECT "MRP", "NSU", "SP", predicted, residual, leverage, cooks_d, cooks_d > 4.0 / n AS influential FROM d', _QR_SQL), digits=6)
def qr_cooks_distance(spark, sf):
    """G1 + G2 on collinear features: SP ~ MRP + NSU + (2 MRP + 3 NSU), of which two are kept."""
    from .plans import qr as QR
    t = _collinear(spark, sf)
    return QR.cooks_distance(t, ["MRP", "NSU", "BLEND"], "SP").drop("BLEND")


@q("qr_influence_by_zone", ["max_leverage", "max_cooks_d", "rmse"], with_clean(
    'SELECT "ZONE", count(*) FILTER (cooks_d > 4.0 / n) AS influential, max(leverage) AS max_leverage, max(cooks_d) AS max_cooks_d, '
    'sqrt(avg(residual * residual)) AS rmse FROM d GROUP BY "ZONE"',
    _QR_SQL.replace('SELECT "MRP", "NSU", "SP", n,', 'SELECT "ZONE", "MRP", "NSU", "SP", n,')), digits=6)
def qr_influence_by_zone(spark, sf):
    """G2 summed up: influential rows and the largest distance per ZONE, SP ~ MRP + NSU."""
    from .plans import qr as QR
    rows = QR.cooks_distance(clean_table(spark, sf), ["MRP", "NSU"], "SP")
    return rows.groupBy("ZONE").agg(F.sum(F.col("influential").cast("long")).alias("influential"), F.max("leverage").alias("max_leverage"),
                                    F.max("cooks_d").alias("max_cooks_d"), F.sqrt(F.avg(F.col("residual") ** 2)).alias("rmse"))


def _shap_lin(spark, sf):
    from .plans import diagnose as DG
    from .plans import explain as EX
    t = clean_table(spark, sf).select("MRP", "NSU", "SP")
    a, beta, means = DG.ols(t, ["MRP", "NSU"], "SP")
    return EX.linear_shap(t, ["MRP", "NSU"], beta, a, means)


_SHAP_SQL = ("SELECT \"MRP\", \"NSU\", \"SP\", b1 * (\"MRP\" - m1) AS \"phi_MRP\", b2 * (\"NSU\" - m2) AS \"phi_NSU\", "
             "a + b1 * m1 + b2 * m2 AS base, a + b1 * \"MRP\" + b2 * \"NSU\" AS predicted FROM clean, fit")


@q("linear_shap", ["MRP", "NSU", "SP", "phi_MRP", "phi_NSU", "base", "predicted"],
   with_clean(_SHAP_SQL, _ols2_sql()), digits=6)
def linear_shap(spark, sf):
    """Linear SHAP values β_j (x_j - E x_j) of the least-squares fit."""
    return _shap_lin(spark, sf)


@q("shap_additivity", ["max_abs_dev", "rel_dev"], with_clean(
    "SELECT max(abs(base + \"phi_MRP\" + \"phi_NSU\" - predicted)) AS max_abs_dev, "
    "max(abs(base + \"phi_MRP\" + \"phi_NSU\" - predicted)) / greatest(max(abs(predicted)), 1e-12) AS rel_dev, "
    "max(abs(base + \"phi_MRP\" + \"phi_NSU\" - predicted)) / greatest(max(abs(predicted)), 1e-12) <= 0.01 AS additive "
    "FROM s", _ols2_sql() + f", s AS ({_SHAP_SQL})"))
def shap_additivity(spark, sf):
    """Base + Σφ reproduces the prediction (relative deviation <= 1 %)."""
    d = _shap_lin(spark, sf).withColumn("phi", F.array("phi_MRP", "phi_NSU"))
    from .plans import explain as EX
    return EX.additivity(d, "predicted")


@q("shap_importance", ["mean_abs_phi"], with_clean(
    "SELECT * FROM (SELECT 'MRP' AS feature, avg(abs(\"phi_MRP\")) AS mean_abs_phi FROM s UNION ALL "
    "SELECT 'NSU', avg(abs(\"phi_NSU\")) FROM s) ORDER BY mean_abs_phi DESC, feature LIMIT 40",
    _ols2_sql() + f", s AS ({_SHAP_SQL})"))
def shap_importance(spark, sf):
    """Features ranked by mean |φ| (top 40)."""
    from .plans import explain as EX
    d = _shap_lin(spark, sf)
    long = d.select(F.explode(F.array(
        F.struct(F.lit("MRP").alias("feature"), F.col("phi_MRP").alias("phi")),
        F.struct(F.lit("NSU").alias("feature"), F.col("phi_NSU").alias("phi")))).alias("t")).select("t.*")
    return EX.importance(long, 40)


@q("contiguous_blocks", NUM5, with_clean(
    "SELECT *, CAST(ntile(3) OVER (ORDER BY " + ", ".join(f'"{x}"' for x in CLEAN_COLS) + ") AS INTEGER) AS block "
    "FROM (SELECT DISTINCT * FROM clean)"))
def contiguous_blocks(spark, sf):
    """Three contiguous, unshuffled blocks over the row order (ntile)."""
    from .plans import pipeline as PL
    t = clean_table(spark, sf).dropDuplicates()
    return PL.contiguous_folds(t, 3, CLEAN_COLS, "block")


# ===================================== rows-only: fitted statistics =======
# (no SQL equivalent: order statistics of transformed values, iterative
# fits, model training; the driver records a row-count check, and pytest
# checks them against brute force on small fixtures)

def _training(spark, sf):
    from .plans import pipeline as PL
    return PL.prepare_training_table(clean_table(spark, sf), TEST_SALES)


@q("normality_test")
def normality_test(spark, sf):
    """Anderson-Darling A² and 5 % critical value per continuous column."""
    t = held_table(spark, sf, *NUM5)
    g, non, res = FE.gaussian_split(t, NUM5)
    rows = [(k, float(v[0]), float(v[1]), k in g) for k, v in res.items()]
    return spark.createDataFrame(rows, "column string, statistic double, critical double, gaussian boolean")


@q("gaussian_transform_choice")
def gaussian_transform_choice(spark, sf):
    """the transform chosen per non-gaussian column (and its λ)."""
    t = held_table(spark, sf)
    m = FE.GaussianTransformer(CONT).fit(t)
    rows = [(k, v, m.lambdas.get(k)) for k, v in m.chosen.items()] or [(None, None, None)]
    return spark.createDataFrame(rows, "column string, transform string, lambda double")


@q("gaussian_transform_apply")
def gaussian_transform_apply(spark, sf):
    """F3 applied: the continuous columns after their chosen transform."""
    t = held_table(spark, sf)
    return FE.GaussianTransformer(CONT).fit(t).transform(t)


@q("quantile_normal_transform")
def quantile_normal_transform(spark, sf):
    """F3f: empirical CDF over a 1000-point quantile grid, then Φ⁻¹."""
    t = clean_table(spark, sf)
    return FE.quantile_normal_model(t, CONT).transform(t)


@q("combined_scaling")
def combined_scaling(spark, sf):
    """F8d: standard scaling on gaussian columns, min-max on the rest."""
    t = clean_table(spark, sf)
    return FE.Scaler("combine", columns=SCALE_COLS).fit(t).transform(t)


@q("correlated_features")
def correlated_features(spark, sf):
    """V1: features dropped as Spearman-correlated (> 0.8) with an earlier one."""
    from .operators import selection as SE
    t = clean_table(spark, sf)
    drop = set(SE.correlated_to_drop(t, FEATS7))
    return spark.createDataFrame([(f, f in drop) for f in FEATS7], "feature string, dropped boolean")


def _score_table(spark, scores, chosen):
    return spark.createDataFrame([(f, float(v) if v is not None else None, f in chosen) for f, v in scores.items()],
                                 "feature string, score double, selected boolean")


@q("lasso_importance")
def lasso_importance(spark, sf):
    """V2: |Lasso coefficient| × feature std, top 3 selected."""
    from .operators import selection as SE
    t = clean_table(spark, sf)
    sc = SE.lasso_scores(t, FEATS7, "SP", alpha=1.0)
    return _score_table(spark, sc, set(SE._top(sc, 3, FEATS7)))


@q("tree_importance")
def tree_importance(spark, sf):
    """V3: extra-trees-style forest importances, top 3 selected."""
    from .operators import selection as SE
    t = held_table(spark, sf)
    sc = SE.tree_importances(t, FEATS7, "SP")
    return _score_table(spark, sc, set(SE._top(sc, 3, FEATS7)))


@q("uncorrelated_selection")
def uncorrelated_selection(spark, sf):
    """V6 (re-aimed): correlated pairs resolved by mutual information, then
    recursive boosted-tree importances."""
    from .operators import selection as SE
    t = held_table(spark, sf)
    keep = SE.uncorrelated_recursive(t, FEATS7, "SP")
    return spark.createDataFrame([(f, f in keep) for f in FEATS7], "feature string, selected boolean")


@q("feature_selection")
def feature_selection(spark, sf):
    """V7 + V8: the selector stage (ANOVA, 4 features, correlated drop) and
    the vector it assembles."""
    from .operators.selection import FeatureSelector
    t = held_table(spark, sf)
    m = FeatureSelector(FEATS7, "SP", "ANOVA", 4, drop_correlated=True).fit(t)
    return m.transform(t).select("SP", "features")


@q("hash_folds")
def hash_folds(spark, sf):
    """Shuffled 5-fold assignment by a seeded hash of the row key."""
    t = _training(spark, sf)
    return t.groupBy("fold").agg(F.count(F.lit(1)).alias("rows"))


@q("learning_curve_samples")
def learning_curve_samples(spark, sf):
    """Nested training fractions linspace(0.3, 1.0, 10)."""
    from .plans import pipeline as PL
    sizes = [0.3 + i * 0.7 / 9 for i in range(10)]
    d = PL.nested_samples(_training(spark, sf), sizes)
    return d.agg(*[F.sum(F.col(f"in_{i}").cast("long")).alias(f"n_{i}") for i in range(10)])


# ===================================== rows-only: models and evaluation ====

def _default_choice(family):
    from .plans import models as MD
    from .plans.pipeline import Choice
    return Choice(family, dict(MD.DEFAULT_PARAMS[family]), "retained",
                  "Standard" if family in MD.LINEAR else "no", "ANOVA", False, 30)


def _holdout(spark, sf, family):
    from .plans import pipeline as PL
    t = _training(spark, sf)
    tr, te = t.where(F.col("fold") != 0), t.where(F.col("fold") == 0)
    ch = _default_choice(family)
    model = PL.refit(tr, ch, TEST_SALES, RARE_TOL)
    m = PL._metrics(model.transform(te), "SP")
    return spark.createDataFrame([(family, m["rmse"], m["mae"], m["median_ae"])],
                                 "model string, rmse double, mae double, median_ae double")


def _register_family(tag, family, ident):
    def fn(spark, sf):
        return _holdout(spark, sf, family)
    fn.__doc__ = f"{ident}: {family} pipeline fitted on folds 1-4, scored on fold 0."
    q(f"holdout_{tag}")(fn)


for _tag, _fam, _id in [("huber", "HuberRegressor", "M1"), ("ridge", "Ridge", "M2"), ("lasso", "Lasso", "M3"),
                        ("elasticnet", "ElasticNet", "M4"), ("linear_svr", "LinearSVR", "M5"),
                        ("decision_tree", "DecisionTreeRegressor", "M6"),
                        ("random_forest", "RandomForestRegressor", "M7"),
                        ("extra_trees", "ExtraTreesRegressor", "M8"), ("adaboost", "AdaBoostRegressor", "M9"),
                        ("hist_gradient_boosting", "HistGradientBoostingRegressor", "M10"),
                        ("xgboost_preset", "XGBRegressor", "M11"), ("lightgbm_preset", "LGBMRegressor", "M12"),
                        ("catboost_preset", "CatBoostRegressor", "M13")]:
    _register_family(_tag, _fam, _id)


@q("holdout_ordered_catboost")
def holdout_ordered_catboost(spark, sf):
    """Symmetric trees on ordered target statistics, fitted on folds 1-4; fold 0 is
    scored with the statistics over all of those."""
    from pyspark.ml.feature import VectorAssembler

    from .plans import models as MD
    from .plans import pipeline as PL
    t = _training(spark, sf)
    tr, te = t.where(F.col("fold") != 0), t.where(F.col("fold") == 0)
    enc = _ordered_encoder().fit(tr)
    va = VectorAssembler(inputCols=NOMINAL + CONT + DATE_PARTS, outputCol="features")
    family = "CatBoostRegressor"
    rows = va.transform(enc.training(tr)).select("features", "SP").persist()
    model = MD.make_regressor(family, dict(MD.DEFAULT_PARAMS[family]), "features", "SP").fit(rows)
    rows.unpersist()
    m = PL._metrics(model.transform(va.transform(enc.transform(te))), "SP")
    return spark.createDataFrame([(family, m["rmse"], m["mae"], m["median_ae"])], "model string, rmse double, mae double, median_ae double")


def _prepared(spark, sf):
    """The training table after the steps of the linear pipelines, and its numeric features."""
    from .plans import pipeline as PL
    ch = _default_choice("Ridge")
    stages = PL.preparation(ch, TEST_SALES, RARE_TOL) + [FE.Scaler("standard", exclude=["SP", *PL.FOLDS(TEST_SALES)])]
    t = _training(spark, sf)
    rows = PL.fit_pipeline(PL.Pipeline(stages=stages), t).transform(t)
    out = {"SP", *PL.FOLDS(TEST_SALES)}
    return rows, [n for n, k in rows.dtypes if n not in out and k in ("double", "int", "bigint", "float")]


@q("model_coefficients")
def model_coefficients(spark, sf):
    """M2 without penalty on every encoded and scaled feature of the linear pipelines: the
    one-hot groups sum to 1 and are found to be aliased with the intercept."""
    from .plans import qr as QR
    rows, features = _prepared(spark, sf)
    return QR.coefficients(rows, features, "SP")


@q("model_diagnostics")
def model_diagnostics(spark, sf):
    """G1 + G2 on every encoded and scaled feature of the linear pipelines, per row."""
    from .plans import qr as QR
    rows, features = _prepared(spark, sf)
    return QR.cooks_distance(rows, features, "SP").select("row_id", "SP", "predicted", "residual", "leverage", "cooks_d", "influential")


@q("inner_cv_trial")
def inner_cv_trial(spark, sf):
    """One parameter draw scored by 3-fold CV with every fitted step
    refitted inside each fold."""
    from .plans import pipeline as PL
    t = _training(spark, sf).where(F.col("fold") != 0)
    res = PL.cross_validate(t, _default_choice("DecisionTreeRegressor"), TEST_SALES, 3, rare_tol=RARE_TOL)
    return spark.createDataFrame([tuple(float(res[k]) for k in sorted(res))],
                                 ", ".join(f"{k} double" for k in sorted(res)))


def _trial_frame(spark, trials):
    keys = ["number", "family", "value", "state", "duration", "params"]
    return spark.createDataFrame([tuple(t.get(k) for k in keys) for t in trials],
                                 "number int, family string, value double, state string, duration double, params string")


_GRAM_FITS = [("Ridge", {"alpha": 2.0}), ("LinearSVR", {"C": 0.001}), ("Lasso", {"alpha": 50.0}), ("ElasticNet", {"alpha": 0.01, "l1_ratio": 0.5})]
_GRAM_SQL = """, f AS (SELECT Fdate_quarter AS fold, MRP / 100 AS a, NSU AS b, SP AS y FROM clean),
total AS (SELECT count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(y) AS my FROM f),
z AS (SELECT fold, a - ma AS a, b - mb AS b, y - my AS y FROM f, total),
s AS (SELECT fold, count(*)::DOUBLE AS n, sum(a) AS sa, sum(b) AS sb, sum(y) AS sy, sum(a * a) AS aa, sum(b * b) AS bb, sum(y * y) AS yy,
             sum(a * b) AS ab, sum(a * y) AS ay, sum(b * y) AS sby FROM z GROUP BY fold),
t AS (SELECT v.fold, v.n AS vn, v.sa AS va, v.sb AS vb, v.sy AS vy, v.aa AS vaa, v.bb AS vbb, v.yy AS vyy, v.ab AS vab, v.ay AS vay, v.sby AS vby,
             sum(o.n) AS n, sum(o.sa) AS sa, sum(o.sb) AS sb, sum(o.sy) AS sy, sum(o.aa) AS aa, sum(o.bb) AS bb, sum(o.ab) AS ab, sum(o.ay) AS ay, sum(o.sby) AS sby
      FROM s v JOIN s o ON o.fold <> v.fold GROUP BY ALL),
cv AS (SELECT *, aa - sa * sa / n AS caa, bb - sb * sb / n AS cbb, ab - sa * sb / n AS cab, ay - sa * sy / n AS cay, sby - sb * sy / n AS cby FROM t),
alpha AS (SELECT * FROM (VALUES ('Ridge', 2.0::DOUBLE), ('LinearSVR', 500.0::DOUBLE)) x(family, l2)),
w AS (SELECT family, cv.*, ((cbb + l2) * cay - cab * cby) / ((caa + l2) * (cbb + l2) - cab * cab) AS wa,
             ((caa + l2) * cby - cab * cay) / ((caa + l2) * (cbb + l2) - cab * cab) AS wb FROM cv, alpha),
i AS (SELECT *, (sy - wa * sa - wb * sb) / n AS c FROM w)
SELECT family, fold::VARCHAR AS fold, wa, wb,
  sqrt((vyy + wa * wa * vaa + wb * wb * vbb + vn * c * c + 2 * wa * wb * vab + 2 * c * wa * va + 2 * c * wb * vb - 2 * wa * vay - 2 * wb * vby - 2 * c * vy) / vn) AS val_rmse
FROM i"""


def _gram_folds(spark, sf, fits):
    from .plans import gram as GR
    t = clean_table(spark, sf).select((c("MRP") / 100).alias("a"), c("NSU").alias("b"), "SP", "Fdate_quarter")
    rows = GR.folds_solved(GR.moments(t, ["a", "b"], "SP", c("Fdate_quarter")), fits)
    return spark.createDataFrame([(r["family"], r["fold"], float(r["coefficients"][0]), float(r["coefficients"][1]), r["val_rmse"]) for r in rows],
                                 "family string, fold string, wa double, wb double, val_rmse double")


@q("gram_cross_validation", ["wa", "wb", "val_rmse"], with_clean("", "").rstrip() + _GRAM_SQL, 6)
def gram_cross_validation(spark, sf):
    """T2, M2, M5 on two features: every fold's fit and error from one table of moments."""
    return _gram_folds(spark, sf, _GRAM_FITS[:2])


@q("gram_cross_validation_l1")
def gram_cross_validation_l1(spark, sf):
    """T2, M3, M4 on two features: the same with coordinate descent."""
    return _gram_folds(spark, sf, _GRAM_FITS[2:])


@q("linear_search")
def linear_search(spark, sf):
    """T1-T3 for M2-M5: 20 trials of each family in 3 inner folds of each of 5 outer folds,
    all fitted from moments; the best trial of each.  The families share the folds' preparation."""
    from .plans import pipeline as PL
    from .plans.gram import QUADRATIC
    t = _training(spark, sf)
    parts = [t.where(F.col("fold") != fold) for fold in range(5)]
    drawn = [ch for family in QUADRATIC for ch in PL.draws(family)]
    shared = [PL.SharedFolds(rows, drawn, TEST_SALES, rare_tol=RARE_TOL) for rows in parts]
    best = []
    for family in QUADRATIC:
        for fold, rows in enumerate(parts):
            trials = PL.tune(rows, family, spec=TEST_SALES, rare_tol=RARE_TOL, shared=shared[fold])
            b = PL.best_of(trials)
            best.append((family, fold, b["number"], b["params"], b["value"], b["user_attrs_val_mae"], b["user_attrs_val_median_ae"]))
    return spark.createDataFrame(best, "family string, fold int, number int, params string, val_rmse double, val_mae double, val_median_ae double")


@q("hyperparameter_search")
def hyperparameter_search(spark, sf):
    """Seeded random search (20 trials, 3 inner folds) minimising CV RMSE."""
    from .plans import pipeline as PL
    t = _training(spark, sf).where(F.col("fold") != 0)
    trials = PL.tune(t, "DecisionTreeRegressor", spec=TEST_SALES, rare_tol=RARE_TOL)
    return _trial_frame(spark, trials)


@q("nested_cv_leaderboard")
def nested_cv_leaderboard(spark, sf):
    """T3 + T4 + T5 + A18 + A19: nested CV (5 outer folds, 20 trials, 3 inner
    folds) of all 13 families; leaderboard of fold averages and the best model
    per test metric."""
    from .plans import pipeline as PL
    _, _, best = PL.select_model(spark, _training(spark, sf), spec=TEST_SALES, rare_tol=RARE_TOL)
    return best


@q("final_model_scoring")
def final_model_scoring(spark, sf):
    """T6 + Q1: tune on all rows (20 trials, 3 inner folds), refit, save, load the saved
    pipeline and score every row (prediction rounded to 2 places)."""
    from .plans import pipeline as PL
    from .plans import score as SC
    from .session import scratch_path
    t = _training(spark, sf)
    path = scratch_path(spark, "final-model")
    PL.final_model(t, "DecisionTreeRegressor", spec=TEST_SALES, rare_tol=RARE_TOL, path=path)
    loaded = PL.load_pipeline_model(spark, path)
    req = t.drop("Gross Sales", "Fdate_quarter")
    return SC.score(loaded, req).select("row_id", "SP", "predicted_price")


@q("learning_curve")
def learning_curve(spark, sf):
    """Train / test RMSE for 10 nested training fractions over the 5 outer folds."""
    from .plans import diagnose as DG
    from .plans import pipeline as PL
    t = _training(spark, sf)
    ch = _default_choice("DecisionTreeRegressor")
    sizes = [0.3 + i * 0.7 / 9 for i in range(10)]
    rows = DG.learning_curve(t, lambda tr: PL.refit(tr, ch, TEST_SALES, RARE_TOL), sizes)
    return spark.createDataFrame(rows, "size double, fold int, train_rmse double, test_rmse double")


def _forest_shap(spark, sf):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor
    from .plans import explain as EX
    t = held_table(spark, sf)
    d = VectorAssembler(inputCols=FEATS7, outputCol="features").transform(t)
    model = RandomForestRegressor(labelCol="SP", numTrees=50, maxDepth=10, seed=120).fit(d)
    scored = model.transform(d)
    shap = EX.tree_shap(scored, EX.model_trees(spark, model), keep=["SP", "prediction"] + FEATS7)
    return shap


@q("tree_shap")
def tree_shap(spark, sf):
    """Path-dependent tree SHAP of a random forest, per row."""
    s = _forest_shap(spark, sf)
    return s.select("SP", "prediction", "base", *[s["phi"][i].alias(f"phi_{i}") for i in range(len(FEATS7))])


@q("tree_shap_additivity")
def tree_shap_additivity(spark, sf):
    """E3 on tree SHAP: base + Σφ equals the forest prediction."""
    from .plans import explain as EX
    return EX.additivity(_forest_shap(spark, sf), "prediction")


@q("tree_shap_summary")
def tree_shap_summary(spark, sf):
    """E5 + E4: (feature, value, φ) points and the mean-|φ| ranking."""
    from .plans import explain as EX
    s = _forest_shap(spark, sf).withColumn("_x", F.array(*[c(x).cast("double") for x in FEATS7]))
    pts = EX.summary_points(s, FEATS7, "_x")
    return EX.importance(pts, 40)


@q("tree_shap_points")
def tree_shap_points(spark, sf):
    """E5: (feature, value, φ) of every row and feature of the forest."""
    from .plans import explain as EX
    s = _forest_shap(spark, sf).withColumn("_x", F.array(*[c(x).cast("double") for x in FEATS7]))
    return EX.summary_points(s, FEATS7, "_x")


@q("adaboost_stage_shap")
def adaboost_stage_shap(spark, sf):
    """AdaBoost stages explained with equal weights 1/n."""
    from pyspark.ml.feature import VectorAssembler
    from .plans import explain as EX
    from .plans.models import AdaBoostR2
    t = held_table(spark, sf)
    d = VectorAssembler(inputCols=FEATS7, outputCol="features").transform(t)
    ada = AdaBoostR2(0.5, "linear", labelCol="SP").fit(d)
    s = EX.tree_shap(d, EX.stage_average_trees(ada), keep=["SP"])
    return s.select("SP", "base", *[s["phi"][i].alias(f"phi_{i}") for i in range(len(FEATS7))])


@q("stream_scoring")
def stream_scoring(spark, sf):
    """Scoring a stream: raw sales batches read with ``readStream``, cleaned,
    scored per micro-batch with a fitted pipeline."""
    from .plans import pipeline as PL
    from .session import scratch_path
    from .streaming import score_stream as SS
    raw = sales_view(spark, sf)
    src = scratch_path(spark, "stream-src")
    raw.write.parquet(src)
    t = _training(spark, sf)
    model = PL.refit(t, _default_choice("DecisionTreeRegressor"), TEST_SALES, RARE_TOL)
    out, ck = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ck")
    stream = SS.cleaned_stream(spark, src, raw.schema, TEST_SALES)
    query = SS.start_scoring(stream.drop(*DROP_COLUMNS),
                             model, out, ck)
    query.awaitTermination()
    return spark.read.parquet(out).select("SP", "predicted_price")
