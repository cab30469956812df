"""The corpus pipeline: documents in, packed training sequences out.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which ``run`` writes as Parquet under the session's
checkpoint folder and reads again as the next stage's ``docs``. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm import cotrain, decontam, line_dedup, ngram_join, packing
from panelforge.llm.common import shared_folder, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _resized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Co-trained quality classifier, fitted on all labels; documents that it rejects go."""
    docs = docs.select(*COLUMNS)
    return cotrain.score(docs, cotrain.fit(docs, table(spark, sf_dir, "labels"))).where("kept").select(*COLUMNS)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines go, and documents of which nothing is left."""
    out = line_dedup.dedup_lines(docs.select(*COLUMNS))
    return _resized(out.where("n_deleted = 0 or n_deleted < n_lines"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8) the document with the least id stays.

    Documents without an id are kept. Rows count as repeated, and one stays, if id and text are the same;
    other rows of one id are documents of their own, the one with the lesser hash of its text first.
    """
    docs = docs.select(*COLUMNS).withColumn("h", F.xxhash64("text"))
    keyed = docs.withColumn("key", F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "h")))
    found = ngram_join.near_duplicates(keyed, n=5, percent=80, doc_id="key", count_links=False)
    stay = found.where("doc_id = component_id").select("doc_id.doc_id", "doc_id.h").distinct()
    kept = docs.where("doc_id is not null").join(stay, ["doc_id", "h"], "left_semi")
    once = kept.groupBy("doc_id", "h").agg(F.min(F.struct("text", "lang", "source", "n_chars")).alias("x"))
    return once.select("doc_id", "x.*").unionByName(docs.where("doc_id is null").drop("h")).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go (its places in the text are found with it)."""
    out = decontam.decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return out.where("not contaminated").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full sequences along the Hilbert curve, with their token ids."""
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [("quality_classifier", quality), ("line_dedup", line_deduplication), ("ngram_jaccard_join", near_duplicates), ("decontamination", decontamination), ("packing", pack)]

#: Learned, iterative and tokenising stages have no SQL form; tests/llm/test_pipeline.py has the brute-force check.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
