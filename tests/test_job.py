import datetime as dt

import pytest
from pyspark.sql import functions as F

from clickloom.functions import storage
from clickloom.operators import score
from clickloom.plans import batch_job, gold
from clickloom.operators.snapshots import add_snapshot_day
from clickloom.sources import catalog as catalog_files
from clickloom.sources import events as event_files
from clickloom.sources import layers, star_schema
from checks.catalog import fixed_score
from frames import rows

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_filter_reaches_the_scan(spark, tmp_path):
    star_schema.raw_events(spark, SF).write.parquet(f"{tmp_path}/raw")
    raw = event_files.read_raw_events(spark, f"{tmp_path}/raw")
    kept = event_files.filter_feature_window(raw, event_files.get_reference_date(raw), 5)
    assert "GreaterThanOrEqual(timestamp" in plan_of(kept)
    days = kept.agg(F.count_distinct(F.to_date("timestamp"))).first()[0]
    assert days == 6


def test_empty_raw_has_no_reference_date(spark):
    with pytest.raises(ValueError, match="empty"):
        event_files.get_reference_date(star_schema.raw_events(spark, SF).limit(0))


def test_csv_conversions(spark, tmp_path):
    log = tmp_path / "events.csv"
    log.write_text(
        "timestamp,visitorid,event,itemid,transactionid\n"
        "1433221332117,1,view,10,\n1430622004384,2,transaction,11,77\n1433221332000,3,view,12,\n"
    )
    parts = []
    for i, line in enumerate(["1435460400000,7,categoryid,5 6", "1431226800000,3,790,n552.000"]):
        path = tmp_path / f"props{i}.csv"
        path.write_text("timestamp,itemid,property,value\n" + line + "\n")
        parts.append(str(path))
    tree = tmp_path / "tree.csv"
    tree.write_text("categoryid,parentid\n1,\n2,1\n")
    catalog_files.convert_all(spark, str(log), parts, str(tree), f"{tmp_path}/out")
    months = sorted(p.name for p in (tmp_path / "out/events").glob("year_month=*"))
    assert months == ["year_month=2015-05", "year_month=2015-06"]
    events = event_files.read_raw_events(spark, f"{tmp_path}/out/events")
    assert events.filter("visitorid = 1").first().timestamp == dt.datetime(2015, 6, 2, 5, 2, 12, 117000)
    properties = spark.read.parquet(f"{tmp_path}/out/item_properties")
    assert rows(properties, "itemid", "value") == [(3, "n552.000"), (7, "5 6")]
    assert rows(spark.read.parquet(f"{tmp_path}/out/category_tree")) == [(1, None), (2, 1)]


def test_stages_and_chain_agree(spark, tmp_path):
    star_schema.raw_events(spark, SF).write.parquet(f"{tmp_path}/raw")
    counts = batch_job.run_all(spark, f"{tmp_path}/raw", f"{tmp_path}/out", fixed_score)
    assert counts["bronze"] == counts["silver"] + counts["quarantine"] == 1000
    by_stage = layers.read_layer(spark, f"{tmp_path}/out/predictions")
    assert by_stage.count() == counts["predictions"] > 0
    chain = batch_job.score_raw_events(star_schema.raw_events(spark, SF), fixed_score)
    assert [(v, round(p, 9)) for v, p in rows(chain)] == [(v, round(p, 9)) for v, p in rows(by_stage)]


def test_scoring_reads_one_day_folder(spark, tmp_path):
    silver = add_snapshot_day(star_schema.click_events(spark, SF))
    layers.write_gold(gold.build_gold(silver), f"{tmp_path}/gold", by_day=True)
    inference = score.prepare_inference_data(layers.read_gold(spark, f"{tmp_path}/gold"))
    scan = [x for x in plan_of(inference).splitlines() if "PartitionFilters" in x]
    assert any("snapshot_day" in x.split("PartitionFilters")[1].split("]")[0] for x in scan)
    assert inference.columns[0] == "visitorid"


def test_popularity_scans_skip_view_folders(spark, tmp_path):
    layers.write_silver(star_schema.click_events(spark, SF), f"{tmp_path}/s", f"{tmp_path}/q")
    from clickloom.operators.popularity import popularity_spans

    silver = add_snapshot_day(layers.read_silver(spark, f"{tmp_path}/s"))
    plan = plan_of(popularity_spans(silver))
    assert "PartitionFilters: [isnotnull(event" in plan


def test_shared_folder_comes_from_the_session(spark):
    assert storage.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert storage.shared_path(spark, "x") != storage.shared_path(spark, "x")
