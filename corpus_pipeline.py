"""Corpus pipeline: quality rules, near duplicates, secrets, mixture, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes it
as Parquet to the shared folder and reads it again as the next stage's docs. All
stages but the last return the columns of documents; n_chars follows the text.
SQL can't express the join, the lexer, the draw or the encoding.

Defined results: other columns of documents are ignored; null and empty texts
fail the quality rules; rows that share an id are rows of their own everywhere,
and the join keeps one row of each class whatever its id; rows without an id
share one draw of the mixture, and rows without a source or language are in the
group of other values.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provgraph.llm import chosen_path, quality, raking, secret_scan, sp_codec
from provgraph.llm.common import prepare, read, scratch, shared_folder
from provgraph.llm.queries import MIXTURE, MIXTURE_KEEP

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the lines that failed leave the others' texts."""
    kept = quality.cleaned(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays: the row of the smallest id, and of rows with that id the one whose text's hash is smallest."""
    prepare(spark)
    return chosen_path.deduplicated(docs.select(*COLUMNS)).select(*COLUMNS)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span the scan finds is masked; all documents stay."""
    prepare(spark)
    masked = secret_scan.masked(docs.select(*COLUMNS))
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixture_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn by the probabilities that meet the targets."""
    return raking.drawn(docs, MIXTURE, MIXTURE_KEEP).select(*COLUMNS)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, their number, and whether they decode to the text."""
    prepare(spark)
    return sp_codec.encode(docs, sp_codec.Model.load())


STAGES = [
    ("quality_rules", quality_stage),
    ("ngram_jaccard_join", duplicates_stage),
    ("secret_scan", secrets_stage),
    ("source_mix", mixture_stage),
    ("sentencepiece", tokens_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage stored for itself goes when its result is written."""
    docs = read(spark, sf_dir)
    for name, stage in STAGES:
        path = os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
        with scratch(spark):
            found = stage(spark, docs, sf_dir)
            found.write.parquet(path)
        docs = spark.read.schema(found.schema).parquet(path)
    return docs
