import pytest

from clickloom.functions.copies import expand_copies
from clickloom.operators import profile, quality
from clickloom.sources import layers
from frames import rows

DIRTY = [
    (0, 1, "view", 1, None),
    (0, 1, "view", 1, None),
    (0, 1, "view", 1, None),
    (1, 1, "view", None, None),
    (1, 1, "view", None, None),
    (2, 1, None, 1, None),
    (3, 1, "signup", None, 5),
    (4, None, "view", None, None),
    (5, 1, "transaction", 1, None),
    (6, 1, "addtocart", 1, 7),
    (None, 1, "view", 1, None),
    (None, 1, "view", 1, None),
    (7, 1, "transaction", 1, 8),
]


def test_first_broken_rule_wins(make_events):
    found = rows(quality.error_counts(quality.count_copies(make_events(DIRTY))))
    assert dict(found) == {
        None: 2,
        "duplicated_row": 2,
        # both copies keep the code of the row rule
        "null_item_id": 2,
        "null_event": 1,
        "not_accepted_event": 1,
        "null_visitor_id": 1,
        "transaction_without_id": 1,
        "id_without_transaction_event": 1,
        # not dropped before validation when used alone
        "null_timestamp": 2,
    }


def test_validate_keeps_every_row(make_events):
    bronze = make_events(DIRTY)
    validated = quality.validate(bronze)
    good, bad = quality.split_validated(validated)
    assert validated.count() == len(DIRTY)
    assert rows(validated.drop("_dq_error")) == rows(bronze)
    assert good.count() + bad.count() == len(DIRTY)
    metrics = quality.calculate_quality_metrics(validated).first()
    assert metrics == quality.quality_metrics_from_counts(quality.count_copies(bronze)).first()
    assert tuple(metrics) == (13, 2, 11)


def test_metrics_of_nothing(make_events):
    empty = quality.count_copies(make_events([]))
    assert tuple(quality.quality_metrics_from_counts(empty).first()) == (0, 0, 0)


@pytest.mark.parametrize("chunk", [1, 3, 10, 100])
def test_copies_are_expanded_in_chunks(spark, chunk):
    counted = spark.createDataFrame([("a", 1), ("b", 10), ("c", 31)], "k string, n long")
    expanded = expand_copies(counted, "n", chunk=chunk)
    assert expanded.columns == ["k"]
    assert rows(expanded.groupBy("k").count()) == [("a", 1), ("b", 10), ("c", 31)]


def test_one_row_copied_many_times(spark):
    """Half of the input is copies of a single row."""
    many = spark.range(300_000).selectExpr(
        "timestamp_ntz'2024-01-01' AS event_time",
        "IF(id % 2 = 0, 0, id) AS visitorid",
        "'view' AS event",
        "1L AS itemid",
        "CAST(NULL AS LONG) AS transactionid",
    )
    validated = quality.validate(many)
    counts = dict(rows(validated.groupBy("_dq_error").count()))
    assert counts == {None: 150_001, "duplicated_row": 149_999}


def test_duplicate_listing(make_events):
    bronze = make_events(DIRTY)
    listed = quality.list_duplicates(bronze)
    assert listed.count() == 7
    assert rows(quality.duplicates_by(bronze, "event")) == [("view", 7)]
    assert quality.drop_exact_duplicates(bronze).count() == 9


def test_write_silver_and_quarantine(spark, make_events, tmp_path):
    counts = layers.write_silver(make_events(DIRTY), f"{tmp_path}/s", f"{tmp_path}/q")
    assert counts == {"total_rows": 13, "valid_rows": 2, "quarantined_rows": 11}
    silver = layers.read_silver(spark, f"{tmp_path}/s")
    assert silver.columns == ["event_time", "visitorid", "event", "itemid", "transactionid"]
    assert silver.count() == 2
    assert layers.read_layer(spark, f"{tmp_path}/q").count() == 11
    assert sorted(p.name for p in (tmp_path / "s").glob("event=*")) == [
        "event=transaction",
        "event=view",
    ]


def test_missing_summary_counts_blank_text(spark):
    df = spark.createDataFrame(
        [(1, "a"), (None, " \t "), (None, None), (4, "")], "n int, s string"
    )
    assert rows(profile.missing_summary(df)) == [
        ("n", 2, 0, 2, 50.0),
        ("s", 1, 2, 3, 75.0),
    ]


def test_missing_by_category_keeps_null_category(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", None), ("a", None), ("b", 1), (None, None)], "c string, v int"
    )
    assert rows(profile.missing_by_category(df, "v", min_missing=1)) == [
        ("c", None, 1, 1, 100.0),
        ("c", "a", 3, 2, 66.67),
    ]


def test_describe_matches_hand_values(spark):
    df = spark.createDataFrame(
        [(0, "x"), (0, "y"), (5, "y"), (None, None), (7, "x")], "n int, s string"
    )
    by = {r["column"]: r for r in profile.describe(df, ["n"], ["s"]).collect()}
    assert (by["n"]["count"], by["n"]["mean"], by["n"]["p50"], by["n"]["p75"]) == (4, 3.0, 2.5, 5.5)
    assert (by["s"]["count"], by["s"]["unique"], by["s"]["top"], by["s"]["freq"]) == (4, 2, "x", 2)


def test_integrality(spark):
    halves = spark.createDataFrame([(1.0,), (None,), (2.5,)], "p double")
    assert not profile.all_whole_numbers(halves, "p").first()[0]
    assert profile.all_whole_numbers(halves.filter("p is null or p < 2"), "p").first()[0]


def test_validation_shuffles_the_rows_once(make_events):
    validated = quality.validate(make_events(DIRTY))
    validated.collect()
    plan = validated._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    by_row = [x for x in final.splitlines() if "Exchange hashpartitioning(event_time" in x]
    assert len([x for x in by_row if "_chunk" not in x and "Reused" not in x]) == 1
