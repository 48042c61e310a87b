"""The operators of this subpackage as named queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.llm import alignment, cover_tree, fingerprints, jaccard, langid, licenses, mixing, ngram_lm, packing, pii, prefix_trie, toxicity, vamana
from tickwell.llm.frames import table

Query = Callable[[SparkSession, str], DataFrame]

MIX_WEIGHTS = {"domain": {"d0": 4.0, "d1": 2.0, "d2": 1.0, "d3": 1.0}, "lang": {"en": 3.0, "de": 1.0, "fr": 1.0, "es": 1.0}}
MIX_SHARE, MIX_EPOCHS = 0.5, 3


def mix_levels() -> dict:
    """The test tables have no domain; sources are spread over four."""
    domain = F.concat(F.lit("d"), (F.crc32(F.coalesce("source", F.lit(""))) % 4).cast("string"))
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


def mixed(documents: DataFrame, added: tuple[str, ...] = ("mix_tokens", "mix_epoch")) -> DataFrame:
    return mixing.mix(documents, mix_levels(), MIX_WEIGHTS, share=MIX_SHARE, max_epochs=MIX_EPOCHS, added=added)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxic_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.text_scores(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixed(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"))
    return rows.select("doc_id", mix_levels()["domain"].alias("domain"), "lang", "source", "mix_tokens", "mix_epoch")


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vamana.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op10_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_digest(table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_digest(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    found = [op1_pii, op2_toxicity, op3_licenses, op4_lm_scores, op5_packing, op6_embedding_dedup, op7_jaccard_join,
             op8_mixing, op9_nearest, op10_languages, op11_alignment, op12_conversation_trie, op13_fingerprints]
    return {q.__name__: q for q in found}


def oracle_sql() -> dict[str, str]:
    return {"op3_licenses": licenses.oracle_sql(), "op12_conversation_trie": prefix_trie.oracle_sql()}
