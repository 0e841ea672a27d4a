"""Radix selection against a sort in Python."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom.functions import radix

PROBS = [0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0]


def brute(values, probs):
    own = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
    out = []
    for p in probs:
        at = p * (len(own) - 1)
        low, high = own[math.floor(at)], own[math.ceil(at)]
        out.append(low + (high - low) * (at - math.floor(at)) if low != high else low)
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.floats(allow_nan=False), min_size=1, max_size=30))
def test_keys_keep_the_order(values):
    x = np.array(values)
    keys = radix.keys_of(x)
    assert ([radix.value_of(k) for k in sorted(keys)] == np.sort(x + 0.0)).all()
    assert radix.keys_of(np.array([np.nan]))[0] > keys.max() or not len(keys)


@pytest.mark.parametrize("seed", range(3))
def test_equals_a_sort(spark, seed):
    rng = random.Random(seed)
    kinds = [
        lambda: rng.gauss(0, 1e-3), lambda: float(rng.randrange(5)), lambda: -rng.random() * 1e300,
        lambda: rng.choice([0.0, -0.0, 5e-324, -5e-324, 1.0, math.nextafter(1.0, 2)]),
        lambda: rng.choice([math.inf, -math.inf, 3.5, None]), lambda: float(10**15 + rng.randrange(10**6)),
    ]
    columns = [[kind() for _ in range(700)] for kind in kinds]
    names = [f"c{k}" for k in range(len(kinds))]
    df = spark.createDataFrame(list(zip(*columns)), ", ".join(f"{n} double" for n in names)).repartition(6)
    found = {r["column"]: list(r)[1:] for r in radix.exact_quantiles(df, names, PROBS).collect()}
    for name, own in zip(names, columns):
        assert found[name] == pytest.approx(brute(own, PROBS), nan_ok=True, rel=1e-15, abs=0)


def test_nan_is_the_largest(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (2.0,)], "a double")
    low, middle, high = list(radix.exact_quantiles(df, ["a"], [0.0, 0.5, 1.0]).first())[1:]
    assert (low, middle) == (1.0, 2.0) and math.isnan(high)


def test_no_sort_and_few_passes(spark, monkeypatch):
    passes, plans = [], []
    digits = radix._digits

    def watched(stored, columns, level, prefixes):
        out = digits(stored, columns, level, prefixes)
        passes.append(level)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(radix, "_digits", watched)
    df = spark.range(50_000).select((F.xxhash64("id") / 3.0).alias("unique"), (F.col("id") % 7).alias("few"))
    found = {r["column"]: list(r)[1:] for r in radix.exact_quantiles(df, ["unique", "few"], PROBS).collect()}
    assert 1 < len(passes) <= 4 and not any("rangepartitioning" in p for p in plans)
    for name in ("unique", "few"):
        own = [float(r[0]) for r in df.select(F.col(name).cast("double")).collect()]
        assert found[name] == pytest.approx(brute(own, PROBS), rel=1e-15)
    passes.clear()
    few = radix.exact_quantiles(df.select("few"), ["few"], PROBS).first()
    assert few.p50 == 3.0 and passes == [0]


def test_equal_digits_of_a_task_are_added_up(spark, monkeypatch):
    monkeypatch.setattr(radix, "COMPACT", 50)
    df = spark.range(30_000, numPartitions=2).select((F.xxhash64("id") % 100_000 / 7.0).alias("a"))
    own = [r[0] for r in df.collect()]
    assert list(radix.exact_quantiles(df, ["a"], PROBS).first())[1:] == pytest.approx(brute(own, PROBS), rel=1e-15)


def test_empty_and_null_columns(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "a double, b int")
    assert [tuple(r) for r in radix.exact_quantiles(df, ["a", "b"], [0.5]).collect()] == [("b", 1.5)]
    assert radix.exact_quantiles(df.limit(0), ["a", "b"], [0.5]).collect() == []
