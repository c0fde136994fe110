"""A corpus made ready for training: STAGES in their order, each over all that its predecessor kept.

Each function takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import public_tokenizers  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from battlelake import session  # noqa: E402
from battlelake.llm import bpe, decontaminate, languages, near_dup, secrets  # noqa: E402

#: Words of a shingle in the near-copy stage; op1's own query counts in four.
SHINGLE = 5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in no language that was learnt, go; ``lang`` stays as it was given.

    Where nothing could be learnt, only those without a letter go.
    """
    held_out = languages.held_out(F.col("doc_id").try_cast("bigint"))
    model = languages.train(docs.where(~held_out).select("text", "lang"))
    if not model.families:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found, lang, _ = languages.predicted(docs, model, reject=True)
    return found.where(F.col(lang) != languages.UNDETERMINED).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the least doc_id."""
    return near_dup.representatives(docs, shingle=SHINGLE)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are replaced by a mark."""
    return secrets.redact(docs, "text", "doc_id")


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, their number, and whether they decode to the document's text."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.encode_and_decode(docs.select("doc_id", "text"), path)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", (F.col("decoded") == text).alias("round_trip"))


STAGES = [
    ("language", identify_language),
    ("near_dup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("secrets", redact_secrets),
    ("bpe", encode_and_decode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = session.cut_lineage(stage(spark, docs, sf_dir))
    return docs


#: A trained classifier and BPE have no SQL.
ORACLE_SQL = None
