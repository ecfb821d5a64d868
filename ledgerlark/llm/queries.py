"""The operators' queries and their SQL, in the order of the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_table
from . import bpe, divergence, fingerprints, html, layouts, lines, minhash, mixing, pieces, pii, quality, ranking, urls, vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return add


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op1_main_text")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return html.main_texts(read_table(spark, folder, "pages"), layouts.fitted_field())


@query("op2_line_dedup", lines.LINES_SQL.format(documents="documents"))
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return lines.drop_recurring_lines(docs).select("doc_id", "text", "n_lines", "n_dropped")


@query("op3_personal_data")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(read_table(spark, folder, "documents"))


@query("op4_simhash")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.document_fingerprints(read_table(spark, folder, "documents"), F.col("doc_id") % 50 == 0)


@query("op5_quality_rules")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return quality.scored(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


@query("op6_neighbours")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.nearest(read_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op7_bpe")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_texts(read_table(spark, folder, "documents"), tokenizer_path())


@query("op8_url_verdicts", urls.URLS_SQL)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judged(read_table(spark, folder, "pages"))


@query("op9_source_mix")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return (mixing.mix(read_table(spark, folder, "documents"))
            .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies"))


@query("op10_near_dedup")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, folder, "documents"))


@query("op11_sentencepiece")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encode_texts(read_table(spark, folder, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query("op12_source_divergence", divergence.AUDIT_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(read_table(spark, folder, "documents"))


@query("op13_ranked_search", ranking.RANKING_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.ranked(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))
