"""The corpus pipeline: language ID, exact dedup, near-dedup, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the columns of
documents and the language that the first predicts from the text (LANGUAGE), by which the last packs. Nulls, empty texts, empty tables, repeated rows and further columns are treated as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import decontam, exact_dedup, langid, packing, simhash
from ledgerline.llm.base import stored, table

#: Languages to keep, all learned ones if None, and the score they must have; five-word similarity of near-duplicates; column of
#: the predicted language.
WANTED, LEAST_SCORE, SIMILARITY, LANGUAGE = None, 0.0, 0.8, "lang_pred"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no language, or of none in WANTED or LEAST_SCORE, go; a null lang is filled with the prediction, and each row
    gets it as LANGUAGE too, whatever its lang says."""
    return langid.recognised(docs, WANTED, LEAST_SCORE, LANGUAGE)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.distinct_texts(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays: fingerprints within 3 bits, as in op2, or a
    five-word Jaccard similarity of SIMILARITY or more, which is beyond the reach of 64-bit fingerprints."""
    return simhash.representatives(docs, SIMILARITY)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of one language each, the predicted one. Workers take little here, as the stages before have filled the JVMs."""
    return packing.packed(docs, by=LANGUAGE, piece=1 << 19, capacity=1 << 17)


STAGES = [("language_id", language_id), ("exact_dedup", exact_duplicates), ("near_dedup", near_duplicates), ("decontamination", decontamination), ("packing", pack)]

#: Fingerprints, tokens and the language model have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
