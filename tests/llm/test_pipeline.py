"""The pipeline as a whole, and the subpackage's place in the repository."""

import os
import re
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from clickloom.functions.storage import materialise
from clickloom.llm import queries

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages_hand_over_documents(shipped):
    docs = shipped.read.parquet(f"{SF}/documents.parquet")
    copies = docs.filter("doc_id < 20").withColumn("doc_id", F.col("doc_id") + 10_000)
    junk = docs.limit(1).withColumn("text", F.lit("12 34 !!"))
    odd = docs.limit(2).withColumns({"text": F.lit(None).cast("string"), "lang": F.lit(None).cast("string")})
    docs = docs.union(copies).union(junk).union(odd).withColumn("score", F.lit("mine"))
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(shipped, docs, SF))
        assert docs.columns == columns, name
        counts.append(docs.count())
        if name != "mixing":
            assert docs.select("doc_id").distinct().count() == docs.count()
    assert counts[1] == counts[0] - 3  # junk and null texts
    assert counts[2] <= counts[1] - 20  # copies have no line of their own
    packed = corpus_pipeline.STAGES[-1][1](shipped, docs, SF).collect()
    rows = Counter(r.doc_id for r in docs.select("doc_id").collect())
    assert Counter(r.doc_id for r in packed if r.piece == 0) == rows


def test_empty_documents(shipped):
    docs = shipped.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(shipped, docs, SF))
        assert docs.count() == 0
    assert corpus_pipeline.STAGES[-1][1](shipped, docs, SF).count() == 0


def test_run(shipped):
    packed = corpus_pipeline.run(shipped, SF)
    assert packed.count() > 0
    full = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert full.agg(F.max("n")).first()[0] <= 2048


def test_names_of_queries():
    assert {re.match(r"op\d+_", name)[0] for name in queries.QUERIES} == {f"op{n}_" for n in range(1, 14)}


def test_nothing_else_imports_the_subpackage():
    for folder in ("clickloom", "checks"):
        for path, _, names in os.walk(os.path.join(ROOT, folder)):
            if os.path.basename(path) in ("llm", "__pycache__"):
                continue
            for name in names:
                if name.endswith(".py"):
                    with open(os.path.join(path, name)) as source:
                        assert not re.search(r"import.*\bllm\b|\bllm\b.*import", source.read()), name
