"""From raw documents to packed training sequences.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rowloom.llm import exact_dedup, near_dedup, packing, quality
from rowloom.llm.batches import lean
from rowloom.llm.tables import table, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. A null text is judged as an empty one, a row without doc_id like
    any other, repeated rows alike; without usable labels all stay. An empty table stays empty."""
    lean(spark)
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text: the one with the largest doc_id (a null one is smaller than any), of repeated rows any
    one. A null text equals an empty one. An empty table stays empty."""
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, Jaccard coefficient of 0.8 or more. The smallest
    doc_id stays (one that is null only where a group has no other), of repeated rows any one. Texts without words, null
    ones among them, are copies of each other. An empty table stays empty."""
    lean(spark)
    return near_dedup.one_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, their ids included. A null or empty text is the end id alone; null doc_ids, null
    sources and repeated rows are packed like others. An empty table gives no piece."""
    lean(spark)
    # executors have run the other stages and hold their memory: a smaller cache of pre-tokens, at some more work
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), cached=100_000)


STAGES = [("quality", keep_quality), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies), ("packing", pack)]

#: Classifier, fingerprints and tokenizer are beyond SQL: the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, applied to the documents of sf_dir one after the other."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
