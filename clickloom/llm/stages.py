"""Stages of the corpus pipeline: each takes and returns documents with their columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import jaccard_join, language_id, line_dedup, mixing, packing
from .common import ship
from .queries import TARGET_WEIGHTS, domain_of

#: A document whose best language has less than this share of the probability is rejected.
LEAST_SCORE = 0.3
END_ID, SEQUENCE_TOKENS = 0, 2048


def _with_text(docs: DataFrame, text) -> DataFrame:
    """New texts, and their lengths where the table has them."""
    docs = docs.withColumn("text", text)
    if "n_chars" in docs.columns:
        docs = docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return docs


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts that are in some language; the network learns from their own labels.

    Rejected: null and empty texts, texts without a letter, and those of no clear language.
    Where no row has a language there is no network, and texts with a letter stay.
    """
    ship(spark)
    net = language_id.fit(docs)
    if net is None:
        return docs.filter(language_id.has_letter(F.col("text")))
    # The row travels as one column, so that none of its names can clash.
    rows = docs.select("text", F.struct("*").alias("_row"))
    marked = language_id.predict(rows, net, ("_row",))
    return marked.filter(
        (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    ).select("_row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that stand earlier, and documents that had lines and keep none."""
    ship(spark)
    done = line_dedup.dedup(docs)
    kept = done.filter((F.col("n_lines") == 0) | (F.col("n_dropped") < F.col("n_lines")))
    return _with_text(kept, F.col("text")).select(*docs.columns)


def near_copies(
    spark: SparkSession,
    docs: DataFrame,
    sf_dir: str,
    threshold: tuple[int, int] = jaccard_join.THRESHOLD,
    width: int = jaccard_join.WORDS,
) -> DataFrame:
    """One document of each group of linked texts stays, that with the smallest id.

    Rows without an id take no part and stay; equal rows are reduced to one.
    """
    ship(spark)
    joined = jaccard_join.join(docs, threshold, width)
    first = joined.filter("doc_id = component_id").select("doc_id").distinct()
    # The row travels as one column, so that none of its names can clash.
    whole = docs.select("doc_id", F.xxhash64("text").alias("hash"), F.struct("*").alias("row"))
    single = whole.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id", "hash"])
    return single.select("row.*").union(docs.filter("doc_id IS NULL"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights ask for: a repeated one has several rows."""
    ship(spark)
    return mixing.take(docs, mixing.plan(docs, domain_of(F.col("source")), TARGET_WEIGHTS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of SEQUENCE_TOKENS."""
    ship(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(docs, path, END_ID, SEQUENCE_TOKENS)
