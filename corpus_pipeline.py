"""The corpus pipeline: documents in, packed training sequences out.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame.  All but the last return the columns of ``documents``.  ``run`` applies
them one after another, each on the written result of the one before.

* quality: rows whose score is below the threshold go.  The model learns from the
  labels (labels.parquet) of the training fold.
* language: rows without a recognised language, or with less than half of their
  letters in one, go.
* near_duplicates: of each component of near copies the row with the smallest doc_id
  stays, of rows that share this doc_id the first by a hash of the text; rows with a
  null doc_id stay.
* mixing: rows are taken as often as the mixture takes them.
* packing: the places of all pieces in sequences.

Nulls, empty and very long texts, ties, repeated rows, empty tables and further
columns are handled as the operators' modules state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelens.llm import jaccard_join, langid, mixing, packing, quality_fm
from pricelens.llm.common import cut, row_of, sized_join, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_fm.fit(docs, quality_fm.training_labels(spark, sf_dir))
    return quality_fm.score(docs, model).where(F.col("_score") >= quality_fm.THRESHOLD).select("_row.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = langid.predict(docs, langid.fit(langid.training_rows(docs)))
    return judged.where((F.col("_lang_pred") != "und") & (F.col("_score") >= langid.ACCEPT)).select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = jaccard_join.jaccard_components(docs)
    first = cut(groups.where("doc_id = component_id").groupBy(F.col("doc_id").alias("_id")).agg(F.count("*").alias("_times")))
    rows = docs.select(row_of(docs), F.col("doc_id").alias("_id"))
    kept = sized_join(rows, first, "_id", "left")
    single = kept.where("_times = 1 or _id is null").select("_row.*")
    # only rows that share a doc_id are gathered: one of them stays
    order = Window.partitionBy("_id").orderBy(F.xxhash64("_row.text"))
    many = kept.where("_times > 1").withColumn("_place", F.row_number().over(order))
    return single.union(many.where("_place = 1").select("_row.*"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates), ("mixing", mixture), ("packing", packed)]

#: Classifiers, similarity joins and tokenizers have no SQL form; the tests hold each
#: stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
