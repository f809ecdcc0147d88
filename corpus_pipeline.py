"""A training corpus from raw documents: five stages, each of which works on all that the one before it kept.

Edge cases, in every stage: a null or empty text is an empty document (the classifier scores it like any other, empty ones
are near copies of each other, hold no benchmark item, and have only the end id); a row with a null id is a row, is never
the one that a group of copies keeps while another row of it has an id, and comes first in the token files; rows that
repeat an id and a text stay or go together, but for the mix, which takes each as often as the plan says; a null source is
a source of its own; an empty table gives an empty result; further columns, of whatever name, pass through all stages but
the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm import decontaminate, mixture, quality, simhash, token_ids
from waymark.llm._shared import shared_dir, table
from waymark.llm.queries import tokenizer_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (trained on the labels of all folds but the held-out one) accepts."""
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    forest = quality.train(docs, table(spark, sf_dir, "labels"), usable=~held)
    return docs.filter(quality.probability(docs, forest) >= quality.THRESHOLD)


def keep_one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest id, of every group of near copies."""
    return simhash.near_dedup(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark passage is found."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mixture.mixed(docs)


def write_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files' documents, read back: id, place, number of ids and their checksum."""
    return token_ids.read_tokens(token_ids.write_tokens(docs, tokenizer_path()))


STAGES = [
    ("quality classifier", keep_quality),
    ("simhash near-dedup", keep_one_of_copies),
    ("benchmark decontamination", drop_benchmark),
    ("source mixture", mix_sources),
    ("token ids", write_ids),
]

#: SQL can't express the classifier, the components of links or the tokenizer; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        path = shared_dir(spark, name.replace(" ", "-"))
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
