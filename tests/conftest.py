import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DAY0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_events(spark):
    """Bronze rows from (seconds since day 0, visitor, event, item, transaction)."""

    def build(rows):
        data = [
            (None if t is None else DAY0 + dt.timedelta(seconds=t), v, e, i, x)
            for t, v, e, i, x in rows
        ]
        return spark.createDataFrame(
            data,
            "event_time timestamp_ntz, visitorid long, event string, itemid long, "
            "transactionid long",
        )

    return build


@pytest.fixture(scope="session")
def day0():
    return (DAY0.date() - dt.date(1970, 1, 1)).days
