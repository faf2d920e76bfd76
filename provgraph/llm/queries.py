"""Registered queries of this subpackage, one for each operator, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provgraph.llm import block_topk, chosen_path, fill_middle, langid, licenses, maxent, quality, raking, secret_scan, sp_codec, toxicity, vector_codes, winnowing
from provgraph.llm.common import fold, prepare, read


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = read(spark, sf_dir)
    labels = read(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    found = toxicity.score(docs, *toxicity.learn(docs, labels))
    return found.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted", "clauses", "top_weight")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = read(spark, sf_dir)
    prototypes = langid.learn(docs.where(fold("doc_id", 5) != 0))
    return langid.predict(docs, prototypes).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


#: Production targets of the mixture: one large source held to a tenth, the others level.
MIXTURE = raking.Targets(
    source={"src0": 0.10} | {f"src{i}": 0.90 / 19 for i in range(1, 20)},
    lang={"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15},
    topic={"prose": 0.90, "listing": 0.04, "reference": 0.03, "dialogue": 0.03},
)
#: Share of all tokens that the mixture keeps.
MIXTURE_KEEP = 0.5


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raking.mix(read(spark, sf_dir), MIXTURE, MIXTURE_KEEP)


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = maxent.score(read(spark, sf_dir), fold("doc_id", 7) != 2)
    return found.select("doc_id", (fold("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return secret_scan.secret_scan(read(spark, sf_dir))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return chosen_path.near_duplicates(read(spark, sf_dir))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(read(spark, sf_dir))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(read(spark, sf_dir))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return winnowing.with_next(read(spark, sf_dir))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return sp_codec.encode(read(spark, sf_dir), sp_codec.Model.load())


def op11_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(read(spark, sf_dir, "embeddings"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.fill_in_middle(read(spark, sf_dir))


def queries() -> dict:
    found = (
        op1_toxicity, op2_language_id, op3_source_mix, op4_lm_scoring, op5_secret_scan, op6_ngram_jaccard_join, op7_license_scan,
        op8_quality_rules, op9_fingerprints, op10_sentencepiece, op11_top_k, op12_vector_codes, op13_fill_in_middle,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op7_license_scan": licenses.oracle_sql(),
        "op8_quality_rules": quality.ORACLE_SQL,
        "op11_top_k": block_topk.ORACLE_SQL,
        "op12_vector_codes": vector_codes.oracle_sql(),
        "op13_fill_in_middle": fill_middle.ORACLE_SQL,
    }
