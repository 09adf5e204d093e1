"""A corpus pipeline of five stages: each reads all that its predecessor kept and decides what goes on.

Learned stages read the rows they are given only; nothing but `documents` is read. Each stage is written as Parquet and read
again as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.llm.byte_bpe import encode_documents
from tamis.llm.common import stash
from tamis.llm.jaccard_join import one_of_each
from tamis.llm.language_id import identify_languages
from tamis.llm.line_dedup import drop_boilerplate
from tamis.llm.mixing import mix_sources, take_copies
from tamis.llm.queries import tokenizer
from tamis.shipping import ship

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Documents with a lower score are rejected: held-out rows of the learned languages score above 0.3, random letters and unlearned scripts below 0.01.
LEAST_LANGUAGE_SCORE = 0.1


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters (`und`), and those unlike the languages learned or not told with LEAST_LANGUAGE_SCORE; lang stays as it was."""
    ship(spark)
    found = identify_languages(docs.select(*COLUMNS))
    return found.where((F.col("lang_pred") != "und") & (F.col("lang_score") >= LEAST_LANGUAGE_SCORE)).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that are boilerplate of their source, whose copies of one text count as one page; a document of which nothing else remains goes with them. n_chars follows the text."""
    clean = drop_boilerplate(docs.select(*COLUMNS), copies_once=True)
    return clean.where((F.col("n_dropped") == 0) | F.col("text").rlike(r"\S")).withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each component of similar texts."""
    ship(spark)
    return one_of_each(docs.select(*COLUMNS))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as many times as the mix of its source asks for, repeated rows for repeated copies."""
    ship(spark)
    return take_copies(mix_sources(docs.select(*COLUMNS), keep=COLUMNS), COLUMNS)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and what they decode to, as digests."""
    ship(spark)
    return encode_documents(docs.select("doc_id", "text"), *tokenizer(), digests=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("source_mixing", source_mixing),
    ("byte_bpe", byte_bpe),
]

#: SQL expresses neither the learned stage nor the encoder; tests/llm compares run() with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
