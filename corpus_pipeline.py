"""The corpus pipeline: language, line dedup, near-duplicates, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's documents.  All but the last
return the columns of documents; the last returns the encoded documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furlong.llm import bpe, decontam, lang_id, line_dedup, simhash
from furlong.llm.queries import WORD_VOCABULARY
from furlong.llm.vocab import public_path
from furlong.session import scratch_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; those without any letter go."""
    return lang_id.accepted(docs, lang_id.learn(docs.where(~lang_id.held_out(F.col("doc_id")))))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that are copies of earlier ones; n_chars follows the text."""
    return line_dedup.dedup_lines(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, the one of the least id."""
    return simhash.keep_first(docs, shingle=4, max_bits=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the text that they decode to."""
    return bpe.encode_documents(docs, public_path(WORD_VOCABULARY))


STAGES = [
    ("language_id", language),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("bpe_encoding", tokens),
]

#: Profiles, SimHash components and BPE merges are not expressible in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of ``sf_dir``."""
    folder = scratch_dir(spark, "corpus-pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
