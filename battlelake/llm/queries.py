"""The registered queries of this subpackage: production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from battlelake.llm import (
    alignment, bpe, chat, codes, decontaminate, languages, near_dup, pieces, search, secrets, token_counts, token_files, urls,
)
from battlelake.llm.oracle import SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.components(_table(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(_table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.report(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.report(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op5_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.report(_table(spark, sf_dir, "conversations"))


def op7_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.report(_table(spark, sf_dir, "documents"))


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.report(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.report(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.report(_table(spark, sf_dir, "embeddings"))


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.report(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_near_dup, op2_secrets, op3_token_counts, op4_bpe, op5_search, op6_chat, op7_languages, op8_urls,
        op9_token_files, op10_decontaminate, op11_alignment, op12_codes, op13_pieces)
}

ORACLE: dict[str, str] = SQL
