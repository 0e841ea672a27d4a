"""Turn counted rows back into repeated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 100_000


def expand_copies(df: DataFrame, count_col: str, chunk: int = CHUNK) -> DataFrame:
    """Repeat every row ``count_col`` times and drop that column.

    A row with a very large count is first split into chunks which are spread
    over the cluster, so that no task writes out one hot group alone.
    """
    columns = [c for c in df.columns if c != count_col]
    count = F.col(count_col)

    few = df.filter(count <= chunk).withColumn("_copy", F.explode(F.sequence(F.lit(1), count)))

    chunks = (
        df.filter(count > chunk)
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.floor((count - 1) / chunk))))
        .repartition("_chunk", *columns)
        .withColumn("_size", F.least(F.lit(chunk), count - F.col("_chunk") * chunk))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_size").cast("int"))))
    )
    return few.select(*columns).unionAll(chunks.select(*columns))
