"""Mixing sources to target weights by capped water-filling, DataFrame functions only.

* Size of a document: its number of words (null text: 0).
* Sources share ``share`` of all sizes by weight.  A source stops at ``max_epochs``
  times its size; what it leaves is shared again by weight until none is above.
* A source is repeated ``floor(target / size)`` whole times; the rest is taken from
  the documents in the order of a seeded hash, until the next one would lie more
  than half beyond the target.  So each source ends within half a document of its
  target, and every rerun takes the same documents.

Defined cases: null sources are one source of their own, last in order; documents
without words have size 0 and are never taken beyond their whole repeats; sources
without words have target 0; rows with a null doc_id are ordered by their text;
rows alike in id (or, without id, text) are taken or left together; an empty table
gives an empty result; columns other than doc_id, text and source are passed on.

Only per-source rows (bounded by the number of sources) are windowed or joined.
The cut inside a source is found from sums over hash buckets of about
``bucket_words`` words, then inside the one bucket that holds the cut, so no task
sees a whole source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, row_of, sized_join, word_count, written

WEIGHTS = (3, 1, 2)
SEED = "mix-1"
HASH_BITS = 60


def _keyed(docs: DataFrame, seed: str) -> DataFrame:
    """docs with _src (a never-null name of the source) and _hash (60 seeded bits)."""
    name = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source")))
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))))
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), key).cast("binary")), 1, HASH_BITS // 4), 16, 10)
    return docs.withColumns({"_src": name, "_hash": bits.cast("long")})


def water_fill(sources: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """Targets of ``sources`` (_src, source_size long, weight): adds ``target``.

    A free source gets weight * level.  Raising the level to share what clamped
    sources leave clamps more of them, never fewer, so the rounds end."""
    cap = F.col("source_size") * F.lit(float(max_epochs))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, clamped = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > cap
        row = sources.agg(F.sum(F.when(over, cap)).alias("held"), F.sum(F.when(~over, F.col("weight"))).alias("free"), F.count(F.when(over, 1)).alias("n")).first()
        if row["n"] == clamped or not row["free"]:
            break
        clamped = row["n"]
        level = (total * share - (row["held"] or 0.0)) / float(row["free"])
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), cap) if row["free"] else cap)


def position_weights(sources: DataFrame, weights=WEIGHTS) -> DataFrame:
    """Weights by the place of the source's name in code point order, null last."""
    place = F.row_number().over(Window.orderBy(F.substring("_src", 1, 1).desc(), "_src")) - 1  # one row per source
    return sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int")))


def plan(sized: DataFrame, share: float = 1.5, max_epochs: float = 2.0, weigh=position_weights, bucket_words: int = 1_000_000) -> DataFrame:
    """Per source: source_size, target, whole (repeats of all) and edge: documents
    with _hash <= edge are taken once more.  ``sized``: _src, _hash, size."""
    sources = cut(sized.groupBy("_src").agg(F.sum("size").alias("source_size")))
    filled = water_fill(weigh(sources), share, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    filled = cut(filled.withColumn("whole", whole).withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size"))
                 .withColumn("buckets", F.ceil(F.col("source_size") / F.lit(bucket_words)) + 1))
    n = filled.count()
    # the bucket of each source in which the extra words end
    bucket = F.shiftright(F.shiftright("_hash", 30) * F.col("buckets"), 30)
    in_bucket = sized.join(F.broadcast(filled) if n <= 100_000 else filled, "_src").withColumn("bucket", bucket)
    order = Window.partitionBy("_src").orderBy("bucket")
    sums = in_bucket.groupBy("_src", "bucket", "extra").agg(F.sum("size").alias("words"))
    sums = sums.withColumn("before", F.sum("words").over(order) - F.col("words"))
    ends = cut(sums.where((F.col("before") <= F.col("extra")) & (F.col("extra") < F.col("before") + F.col("words"))).select("_src", "bucket", "before"))
    inside = sized_join(in_bucket, ends, ["_src", "bucket"], rows=n)
    inside = inside.groupBy("_src", "_hash", "before", "extra").agg(F.sum("size").alias("size"))
    upto = F.sum("size").over(Window.partitionBy("_src").orderBy("_hash")) - F.col("size") / 2
    last = inside.withColumn("upto", F.col("before") + upto).where("upto <= extra").groupBy("_src").agg(F.max("_hash").alias("inner_edge"))
    low = ends.join(filled, "_src").select("_src", F.expr("((bucket * 1073741824L + buckets - 1) div buckets) * 1073741824L - 1").alias("start_edge"))
    edges = filled.join(low, "_src", "left").join(last, "_src", "left")
    edge = F.when(F.col("extra") > 0, F.coalesce("inner_edge", "start_edge", F.lit(-1))).otherwise(F.lit(-1))
    return cut(edges.select("_src", "source_size", "target", "whole", edge.alias("edge")))


def _copies(keyed: DataFrame, mixture: DataFrame) -> DataFrame:
    joined = sized_join(keyed, mixture, "_src")
    return joined.withColumn("_copies", F.col("whole") + F.when(F.col("_hash") <= F.col("edge"), 1).otherwise(0))


def mix_sources(docs: DataFrame, seed: str = SEED, **how) -> DataFrame:
    """The mixture itself: every document as often as it is taken, all its columns."""
    keyed = _keyed(docs.select(row_of(docs), "doc_id", "source", "text"), seed)
    sized = written(keyed.select("_src", "_hash", word_count("text").alias("size")), "mix-sizes")
    taken = _copies(keyed.select("_row", "_src", "_hash"), plan(sized, **how)).where("_copies > 0")
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_row.*")


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    sized = written(_keyed(docs, SEED).select("doc_id", "_src", "_hash", word_count("text").alias("size")), "mix-sizes")
    out = _copies(sized, plan(sized))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("_copies")).alias("taken"))


SQL = r"""
WITH docs AS (
  SELECT doc_id, source,
         CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size,
         ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, '')))), 1, 15))::BIGINT AS h
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM docs GROUP BY source),
filled AS (  -- the first k sources in the order of cap / weight are clamped
  SELECT *, sum(2.0::DOUBLE * source_size) OVER w - 2.0::DOUBLE * source_size AS held,
         sum(weight) OVER () - (sum(weight) OVER w - weight) AS free
  FROM src WINDOW w AS (ORDER BY source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
level AS (
  SELECT max((1.5::DOUBLE * (SELECT sum(source_size)::DOUBLE FROM src) - held) / free) AS height FROM filled),
plan AS (
  SELECT source, source_size, least(weight * height, 2.0::DOUBLE * source_size) AS target FROM src, level),
whole AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM plan),
taken AS (
  SELECT d.*, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS extra,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h RANGE UNBOUNDED PRECEDING) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.h) AS alike
  FROM docs d JOIN whole p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN extra > 0 AND upto - alike / 2.0::DOUBLE <= extra THEN 1 ELSE 0 END))::BIGINT AS taken
FROM taken
"""
