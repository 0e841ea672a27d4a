import pytest

from clickloom.llm.common import ship
from edge_texts import EDGES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def shipped(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def texts(shipped):
    """(doc_id, text) of the smallest documents table and the edge cases."""
    table = shipped.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return [tuple(r) for r in table.collect()] + EDGES


@pytest.fixture(scope="session")
def frame(shipped):
    def build(rows, schema="doc_id long, text string", parts=5):
        return shipped.createDataFrame(rows, schema).repartition(parts)

    return build


@pytest.fixture(scope="session")
def clashing(frame):
    """Adds columns named like those of the operators."""
    from pyspark.sql import functions as F

    def build(rows):
        names = "score rank n_lines lang_pred start length set_id words hits key id line _row n"
        return frame(rows).withColumns({c: F.lit("mine") for c in names.split()})

    return build
