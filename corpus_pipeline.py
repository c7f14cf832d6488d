"""From raw documents to packed training sequences, one stage after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import line_dedup, mixing, packing, quality_rules, simhash
from tidemark.llm.common import materialise, read

#: SQL cannot express the learned rules, the fingerprints or the tokenizer.
ORACLE_SQL = None


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs, read(spark, sf_dir, "labels"))


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are deleted; documents that lose all their lines go."""
    cleaned = line_dedup.dedup_lines(docs, min_words=50)
    left = (F.col("n_removed") == 0) | (F.btrim("text", F.lit(" \t\n\x0b\x0c\r")) != "")
    return cleaned.filter(left).withColumn("n_chars", F.when(
        F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs, shingle=4, distance=4)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix; one that is taken several times comes as several rows."""
    return mixing.taken(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in training sequences."""
    return packing.pack(docs, packing.public_tokenizer())


STAGES = [
    ("quality rules", good_documents),
    ("line dedup", distinct_lines),
    ("simhash near-dedup", one_of_each_group),
    ("mixing", mixture),
    ("packing", sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what the others keep is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
