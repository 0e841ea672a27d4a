import pytest
from pyspark.sql import functions as F

from clickloom.functions import bins, ordered, radix
from clickloom.operators import catalog, explore
from clickloom.sources import star_schema
from frames import rows

SF = "/root/testdata/sf0.001"


def test_bins_are_right_closed(spark):
    values = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 1.0, 2.0, 2.5)], "v double")
    got = values.select("v", bins.right_closed_bin(F.col("v"), [0, 1, 2], ["a", "b"]).alias("b"))
    assert dict(rows(got)) == {-1.0: None, 0.0: "a", 1.0: "a", 2.0: "b", 2.5: None}
    with pytest.raises(ValueError):
        bins.right_closed_bin(F.col("v"), [0, 1], ["a", "b"])


def test_conversion_summary_rounds_half_to_even(spark):
    df = spark.createDataFrame(
        [(0.5, i == 0) for i in range(32)] + [(1.5, True)] * 8, "v double, c boolean"
    )
    got = explore.conversion_summary(df, "v", "c", [0, 1, 2, 9], ["a", "b", "e"], "n", "hits")
    # 1/32 is 3.125 %
    assert rows(got) == [("a", 32, 1, 3.12, 80.0), ("b", 8, 8, 100.0, 20.0)]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 1.0, 1.9, 4.0)], "v double")
    assert rows(bins.histogram(df, "v", 4), "bin", "n") == [(0, 1), (1, 2), (3, 1)]
    one = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert rows(bins.histogram(one, "v", 2)) == [(1, 3.0, 3.5, 2)]


@pytest.mark.parametrize("ties", [1, 7, 5000])
def test_running_totals_equal_global_window(spark, ties):
    df = spark.range(5000).select(
        "id", (F.xxhash64("id") % ties).alias("v"), (F.col("id") % 3).cast("string").alias("g")
    )
    for group in ([], ["g"]):
        got = ordered.running_totals(
            df, [F.desc("v"), F.asc("id")], {"cum": F.col("v")}, group=group, rank="rn", totals=True
        )
        over = f"(PARTITION BY {', '.join(group) or '1'} ORDER BY v DESC, id ROWS UNBOUNDED PRECEDING)"
        whole = f"(PARTITION BY {', '.join(group) or '1'})"
        df.createOrReplaceTempView("t")
        want = spark.sql(
            f"SELECT id, v, g, sum(v) OVER {over} cum, row_number() OVER "
            f"(PARTITION BY {', '.join(group) or '1'} ORDER BY v DESC, id) rn, "
            f"sum(v) OVER {whole}, count(1) OVER {whole} FROM t"
        )
        assert rows(got) == rows(want)


def test_running_totals_with_more_offsets_than_are_broadcast(spark, monkeypatch):
    df = spark.range(3000).withColumn("g", F.col("id") % 500)
    monkeypatch.setattr(ordered, "BROADCAST_ROWS", 10)
    got = ordered.running_totals(df, [F.asc("id")], {}, group=["g"], rank="rn", totals=True)
    assert got.filter("rn = 1 + id div 500 AND rn_total = 6").count() == 3000


def test_running_totals_split_the_rows(spark):
    """The ordered step never runs in a single partition."""
    df = spark.range(20_000).select("id", F.lit(0).alias("v"))
    got = ordered.running_totals(df, [F.asc("v"), F.asc("id")], {}, rank="rn")
    plan = got._jdf.queryExecution().executedPlan().toString()
    per_row = [x for x in plan.splitlines() if "Window" in x and "_in_rn" in x]
    assert per_row and all("_range_part" in x for x in per_row)
    assert got.filter("rn = id + 1").count() == 20_000


def test_exact_quantiles_match_percentile(spark):
    df = spark.range(1001).select((F.xxhash64("id") % 500).alias("a"), F.lit(None).cast("int").alias("b"))
    (row,) = radix.exact_quantiles(df, ["a", "b"], [0.0, 0.25, 0.999, 1.0]).collect()
    want = df.select(F.expr("percentile(a, array(0.0, 0.25, 0.999, 1.0))")).first()[0]
    assert list(row)[1:] == pytest.approx(want)
    assert ordered.quantile_label(0.999) == "p99_9"


def test_pareto_point(spark):
    counts = spark.createDataFrame([(1, 5), (2, 0), (3, 4), (4, 1)], "visitorid long, transaction long")
    pareto = explore.pareto_analysis(counts, "visitorid", "transaction", "visitors")
    assert [r.visitorid for r in pareto.orderBy("rank").collect()] == [1, 3, 4, 2]
    assert rows(explore.pareto_point(pareto, "transaction", "visitors", 0.8)) == [(0.9, 0.5)]
    nothing = explore.pareto_analysis(
        counts.withColumn("transaction", F.lit(0)), "visitorid", "transaction", "visitors"
    )
    assert explore.pareto_point(nothing, "transaction", "visitors", 0.8).count() == 0


def test_ratios_without_views_are_null(make_events):
    ratios = explore.event_ratios(make_events([(0, 1, "addtocart", 1, None)])).first()
    assert tuple(ratios) == (None, None, 0.0)


def test_depth_with_cycle_and_unknown_parent(spark):
    tree = spark.createDataFrame(
        [(1, 2), (2, 1), (3, 1), (4, -1), (5, 4), (6, 99), (7, None)],
        "categoryid int, parentid int",
    )
    got = dict(rows(catalog.build_category_depth(tree)))
    assert got == {1: None, 2: None, 3: None, 4: 0, 5: 1, 6: 1, 7: 0}
    assert rows(catalog.depth_distribution(catalog.build_category_depth(tree))) == [(0, 2), (1, 2)]


def test_depth_of_a_long_chain(spark):
    chain = spark.range(300).select(
        F.col("id").cast("int").alias("categoryid"), (F.col("id") - 1).cast("int").alias("parentid")
    )
    got = catalog.build_category_depth(chain)
    assert got.filter("depth = categoryid").count() == 300


def test_category_purchases_equal_joined_events(spark):
    """Also when property records repeat."""
    events = star_schema.click_events(spark, SF)
    properties = star_schema.item_properties(spark, SF)
    pairs = catalog.item_categories(properties.unionAll(properties.filter("itemid < 9")))
    joined = catalog.category_events(events, pairs)
    plain = joined.groupBy("categoryid").agg(
        F.count_distinct("itemid"),
        F.count_if(F.col("event") == "view"),
        F.count_if(F.col("event") == "transaction"),
    )
    ours = catalog.category_purchases(events, pairs).drop("conversion_rate")
    assert rows(ours) == rows(plain)
    once = catalog.item_categories(properties.unionAll(properties), dedup=True)
    assert rows(once) == rows(catalog.item_categories(properties).distinct())


def test_parent_lookup_refuses_two_parents(spark):
    purchases = spark.createDataFrame(
        [("['5']", 1, 2, 1, 50.0)],
        "categoryid string, items long, views long, transactions long, conversion_rate double",
    )
    tree = spark.createDataFrame([(5, 4)], "categoryid int, parentid int")
    (row,) = catalog.with_parent(purchases, tree).collect()
    assert (row.categoryid, row.parentid) == ("5", "4")
    with pytest.raises(Exception, match="not unique"):
        catalog.with_parent(purchases, tree.unionAll(tree)).collect()


def test_property_as_of_is_strictly_before(spark):
    log = spark.createDataFrame(
        [(1, 7, "a", "x"), (2, 7, "a", "y"), (3, 7, "a", "z")],
        "timestamp long, itemid long, property string, value string",
    )
    assert rows(catalog.property_as_of(log, 3)) == [(7, "a", 2, "y")]
