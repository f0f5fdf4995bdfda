"""A corpus pipeline of five operators: each stage takes (spark, docs, sf_dir) and works on all that the one before kept.

quality -> near_duplicates -> decontaminate -> secrets -> pack. All but the last return the columns of documents, and further columns
that the input has. Defined results of all stages: rows that repeat a doc_id are judged each by its text; empty tables stay empty;
very long texts are taken whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varspan.llm import op01_secrets, op04_decontaminate, op06_quality, op08_setjoin, op09_packing
from varspan.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps. Null and empty texts are judged by their host and path; a null source or lang is a
    host or path of its own; without labels of both kinds all are kept."""
    return op06_quality.filter_quality(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest doc_id, of each component of near duplicates. Null, empty and blank texts are near to
    nothing and stay; so do rows without doc_id, and all rows of a doc_id that stays."""
    return op08_setjoin.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of any benchmark item. Null and empty texts have no words and stay; null benchmark texts are no items."""
    return op04_decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts masked and n_chars as the new text has. A null text stays null, and so is its n_chars."""
    return op01_secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences. Null and empty texts are their closing id alone; a null doc_id stays null."""
    return op09_packing.query(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("secrets", secrets), ("pack", pack)]

#: The classifier, the forest and the tokenizer can't be put as SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each stage's rows are written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = written(docs) if k < len(STAGES) - 1 else docs
    return docs
