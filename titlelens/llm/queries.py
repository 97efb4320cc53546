"""Registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlelens.llm import oracle


# For the synthetic tables; a caller passes a secret of their own.
SURROGATE_KEY = "synthetic-documents"


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titlelens.llm.token_files import token_files

    return token_files(table(spark, sf_dir, "documents"), vocabulary(), end_id=2)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titlelens.llm.quality import quality_report

    return quality_report(table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titlelens.llm.licenses import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titlelens.llm.decontaminate import decontaminate

    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titlelens.llm.ngram_join import similarity_groups

    # Ids of the table are unique, so the least id of a class names it.
    groups = similarity_groups(table(spark, sf_dir, "documents"), n=3, percent=90)
    return groups.select("doc_id", "n_shingles", "component_id", F.col("class_least").alias("class_id"), "n_links")


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titlelens.llm.pii import replace_entities

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_entities(docs, SURROGATE_KEY)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titlelens.llm.language import language_id

    return language_id(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titlelens.llm.line_dedup import line_report

    return line_report(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titlelens.llm.substring import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"), size=50).drop("text_key")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titlelens.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), vocabulary(), capacity=4096, end_id=1)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titlelens.llm.merkle import merkle_check

    return merkle_check(table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titlelens.llm.whitening import whitened

    return whitened(table(spark, sf_dir, "embeddings"), components=4)


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titlelens.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_files, op2_quality_rules, op3_ngram_jaccard_join, op4_pii_surrogates, op5_language_id, op6_line_dedup, op7_substring_dedup, op8_best_fit_packing, op9_license_scan, op10_decontaminate,
                              op11_merkle_manifest, op12_embedding_whitening, op13_source_mixing)
}

ORACLE_SQL: dict[str, str] = {
    "op2_quality_rules": oracle.quality(),
    "op3_ngram_jaccard_join": oracle.similar(),
    "op6_line_dedup": oracle.line_runs(),
    "op7_substring_dedup": oracle.repeats(),
    "op10_decontaminate": oracle.contamination(),
    "op11_merkle_manifest": oracle.merkle(),
}
