"""A training corpus from ``documents``: quality, line dedup, near dedup, mixing, encoding.

Each stage takes (spark, docs, folder) and returns a frame, which is written as Parquet and read again as
the next one's ``docs``.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlark.llm import bpe, lines, minhash, mixing, quality
from ledgerlark.llm.common import stage
from ledgerlark.llm.queries import tokenizer_path
from ledgerlark.session import read_table


def keep_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the rule ensemble does not reject."""
    return quality.good_documents(docs, read_table(spark, folder, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, without the lines of recurring templates; n_chars follows the text."""
    return lines.with_lines_dropped(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return minhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token counts and digests of every document of the mix."""
    return bpe.encode_texts(docs, tokenizer_path())


STAGES = [("quality", keep_quality), ("line dedup", drop_lines), ("near dedup", drop_near_duplicates), ("mixing", mix_sources), ("encoding", encode)]

#: SQL cannot fit the rule ensemble nor draw the mix; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, folder), f"corpus-{name.replace(' ', '-')}")
    return docs
