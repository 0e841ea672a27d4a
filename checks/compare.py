"""Run registered queries and their SQL side by side.

    python -m checks.compare [--sf /root/testdata/sf0.01] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import math
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks import catalog, oracle

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, (int, float)):
        return (1, float(value) + 0.0)
    return (2, str(value))


def _rows(rows, names) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


SPARK_KINDS = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between a query result and its SQL, or None."""
    ours = _rows(df.collect(), df.columns)
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]) for c in result.description}
    theirs = _rows(result.fetchall(), names)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    mixed = [
        (n, k, kinds[n]) for n, k in df.dtypes if SPARK_KINDS.get(k) not in (kinds[n], None)
    ]
    if mixed:
        return f"types {mixed}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(ours)} rows differ, first {wrong[0]}"
    return None


def session(cpus: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        # gold alone needs more generated classes than the default cache of 100 holds
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        # the test data is tiny; keep all cores busy after a shuffle
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="/root/testdata/sf0.01")
    args.add_argument("prefix", nargs="*")
    options = args.parse_args()
    spark, con, sql = session(), connect(options.sf), oracle.build()
    bad = 0
    for name, run in catalog.QUERIES.items():
        if options.prefix and not name.startswith(tuple(options.prefix)):
            continue
        start = time.time()
        try:
            if name in sql:
                problem = difference(run(spark, options.sf), con, sql[name])
                state = "ok" if problem is None else f"DIFFERS: {problem}"
            else:
                state = f"rows {run(spark, options.sf).count()}"
        except Exception as error:  # noqa: BLE001
            causes = [x for x in str(error).splitlines() if x.startswith("Caused by")]
            state = f"FAILED: {type(error).__name__} {str(error)[:300]} {causes}"
        bad += state.startswith(("DIFFERS", "FAILED"))
        print(f"{name:40s} {time.time() - start:6.1f}s {state}", flush=True)
    print("unmatched SQL:", sorted(set(sql) - set(catalog.QUERIES)))
    print("problems:", bad)


if __name__ == "__main__":
    main()
