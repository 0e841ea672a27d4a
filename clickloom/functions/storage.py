"""Where intermediate results are kept when a plan has to be cut."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Paths of the innermost open scope; a thread has its own.
_made: ContextVar[list[str] | None] = ContextVar("_made", default=None)


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach.

    ``spark.checkpoint.dir`` names it. Without that setting it is a folder in the
    warehouse, which is shared too.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_steps"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def shared_path(spark: SparkSession, name: str) -> str:
    """A path for one new table under the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    own = _made.get()
    if own is not None:
        own.append(path)
    return path


def materialise(df: DataFrame) -> DataFrame:
    """Compute once into a table under the shared folder and go on from there.

    Lost executors cost a read of that table, not the work before it. Compared
    with ``checkpoint()`` the rows are columnar, so later steps read only the
    columns they use.
    """
    spark = df.sparkSession
    path = shared_path(spark, "step")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what was stored inside.

    A result has to be read or written before the scope ends. Scopes can be nested, and
    open at the same time in several threads: each removes only its own tables.
    """
    own: list[str] = []
    outer = _made.set(own)
    try:
        yield
    finally:
        _made.reset(outer)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        configuration = spark.sparkContext._jsc.hadoopConfiguration()
        for path in map(hadoop.Path, reversed(own)):
            path.getFileSystem(configuration).delete(path, True)
