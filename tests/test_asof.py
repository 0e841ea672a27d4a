"""As-of join against a search in Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from clickloom.operators import asof

DAY = dt.datetime(2024, 1, 1)


def case(seed, hot=0):
    rng = random.Random(seed)
    at = lambda: None if rng.random() < 0.05 else DAY + dt.timedelta(hours=rng.randrange(60))
    key = lambda: rng.choice([1, 2, 3, 4, None])
    records = [(key(), at(), rng.choice(["a", "b", "c", None]), rng.randrange(9)) for _ in range(120)]
    asks = [(key(), at(), k) for k in range(150)] + [(2, DAY, 999)] * 3
    records += [(7, DAY + dt.timedelta(minutes=k), f"v{k:05d}", k) for k in range(hot) if k % 3 == 0]
    asks += [(7, DAY + dt.timedelta(minutes=k), 10_000 + k) for k in range(hot) if k % 5 == 0]
    return asks, records


def brute(asks, records, inclusive):
    out = []
    for key, at, own in asks:
        fits = [
            (t, v, w) for k, t, v, w in records
            if None not in (k, t, key, at) and k == key and (t <= at if inclusive else t < at)
        ]
        # Nulls are the smallest of values.
        best = max(fits, key=lambda r: (r[0], r[1] is not None, r[1] or "", r[2]), default=(None, None, None))
        out.append((key, at, own, *best))
    return sorted(out, key=str)


def run(spark, asks, records, parts, **options):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        a = spark.createDataFrame(asks, "k long, at timestamp_ntz, own long")
        r = spark.createDataFrame(records, "k long, time timestamp_ntz, v string, w long")
        return sorted(map(tuple, asof.as_of(a, r, ["k"], "at", "time", ["v", "w"], **options).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("inclusive", [False, True])
@pytest.mark.parametrize("parts", [1, 3, 9])
def test_equals_a_search(spark, inclusive, parts):
    asks, records = case(parts)
    assert run(spark, asks, records, parts, inclusive=inclusive) == brute(asks, records, inclusive)


def test_hot_key_spans_partitions(spark, monkeypatch):
    asks, records = case(5, hot=3000)
    parts = []
    handed = asof._handed_over

    def seen(placed, own):
        parts.append(placed.filter("k0 = 7").select("part").distinct().count())
        return handed(placed, own)

    monkeypatch.setattr(asof, "_handed_over", seen)
    assert run(spark, asks, records, 8) == brute(asks, records, False)
    assert parts[0] >= 4


def test_records_far_before_their_question(spark):
    """Partitions of questions alone get the record of a much earlier one."""
    records = [(1, DAY, "x", 0)]
    asks = [(1, DAY + dt.timedelta(minutes=k + 1), k) for k in range(2000)]
    assert run(spark, asks, records, 8) == brute(asks, records, False)


def test_edges(spark):
    assert run(spark, [], case(1)[1], 3) == []
    assert run(spark, case(1)[0], [], 3) == brute(case(1)[0], [], False)
    a = spark.createDataFrame([(1, DAY, "x")], "k long, at timestamp_ntz, v string")
    r = spark.createDataFrame([(1, DAY, "x")], "k long, time timestamp_ntz, v string")
    with pytest.raises(ValueError, match="both sides"):
        asof.as_of(a, r, ["k"], "at", "time", ["v"])
    # Extra columns of the questions stay, those of the records do not come in.
    odd = a.withColumnRenamed("v", "record").withColumn("part", F.lit("p"))
    extra = r.withColumn("ask", F.lit(1))
    out = asof.as_of(odd, extra, ["k"], "at", "time", ["v"], inclusive=True)
    assert [tuple(x) for x in out.collect()] == [(1, DAY, "x", "p", DAY, "x")]
