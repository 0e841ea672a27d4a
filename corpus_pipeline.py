"""From raw documents to packed training sequences.

Each stage reads what the stage before wrote as Parquet below the shared folder, so a lost
executor costs a read and not the work before it.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from clickloom.functions.storage import materialise
from clickloom.llm import stages

#: Near copies of the pipeline: shingles of five words, Jaccard similarity of 0.8 or more.
NEAR = {"threshold": (80, 100), "width": 5}

STAGES = [
    ("language_id", stages.language),
    ("line_dedup", stages.lines),
    ("jaccard_join", partial(stages.near_copies, **NEAR)),
    ("mixing", stages.mix),
    ("packing", stages.pack),
]

#: Neither the network, the edit join nor the tokenizer can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
