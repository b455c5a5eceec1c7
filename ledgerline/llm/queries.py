"""One query for each operator, over its whole tables, and the pipeline; SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, exact_dedup, langid, licenses, merkle, packing, pointintime, repair, simhash, tokencounts, toxicity, urlfilter
from .base import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = exact_dedup.duplicates(table(spark, sf_dir, "documents"))
    return marks.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.round_trip(table(spark, sf_dir, "documents"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotations(table(spark, sf_dir, "conversations"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs).select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.token_counts(table(spark, sf_dir, "documents"))


def op13_point_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pointintime.features(*[table(spark, sf_dir, name) for name in ("sales", "sale_lines", "clicks")])


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (op1_toxicity, op2_simhash, op3_exact_dedup, op4_decontamination, op5_repair_tokens, op6_licenses, op7_chat, op8_packing, op9_language, op10_urls, op11_merkle, op12_token_counts, op13_point_in_time, pipeline)
}

ORACLES = {"op3_exact_dedup": exact_dedup.ORACLE, "op4_decontamination": decontam.ORACLE, "op7_chat": chat.ORACLE, "op10_urls": urlfilter.ORACLE, "op11_merkle": merkle.ORACLE, "op13_point_in_time": pointintime.ORACLE}
