"""Corpus pipeline: from documents to token ids for training.

Each stage calls one operator of ``catalogprep.llm`` on all that its predecessor kept; its
result is written as Parquet in the shared folder and read again for the next one.

1. quality: documents that the classifier, fitted on the labels, rejects go.
2. simhash: one document of each near-duplicate group stays.
3. substring: words of passages that also stand elsewhere go; documents stay.
4. mixing: documents are repeated or left out so that sources come near their targets.
5. sentencepiece: the texts' token ids, one row per copy.

The input may hold nulls, empty texts, repeated rows and extra columns; see the operators
for what each makes of them.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogprep.llm import mixing, pieces, quality, simhash, substring
from catalogprep.llm._common import read_table, saved


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = quality.graded_labels(read_table(spark, sf_dir, "labels"))
    return quality.select(docs, quality.train(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=simhash.SHINGLE, max_bits=simhash.MAX_BITS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shorter = substring.remove(docs)
    return shorter.withColumn("n_chars", F.char_length("text").cast("bigint")) if "n_chars" in docs.columns else shorter


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs, keep=("doc_id", "source"))


STAGES = [
    ("quality classifier", select_quality),
    ("simhash near-dedup", drop_near_duplicates),
    ("substring dedup", drop_repeated_passages),
    ("mixing sources", mix_sources),
    ("sentencepiece encoding", encode_pieces),
]

#: The stages hold models and encoders that SQL can't express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
