"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores and
BENCH_RUNS the runs per query; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import catalog  # noqa: E402
from checks.compare import session  # noqa: E402
from clickloom.functions import storage  # noqa: E402
from clickloom.operators import explore, popularity, quality, score, sessions, snapshots  # noqa: E402
from clickloom.operators import evaluate, train  # noqa: E402
from clickloom.plans import batch_job, gold  # noqa: E402
from clickloom.sources import layers, star_schema  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def main() -> None:
    spark = session(CPUS)
    base = storage.shared_path(spark, "bench")
    # The job hands over through Parquet, so each stage is timed on a stored input.
    star_schema.dirty_events(spark, SF_DIR).write.parquet(f"{base}/bronze")
    layers.write_silver(
        star_schema.click_events(spark, SF_DIR), f"{base}/silver", f"{base}/quarantine"
    )
    bronze = layers.read_bronze(spark, f"{base}/bronze")
    silver = snapshots.add_snapshot_day(layers.read_silver(spark, f"{base}/silver"))
    layers.write_gold(gold.build_gold(silver), f"{base}/gold", by_day=True)
    stored_gold = layers.read_gold(spark, f"{base}/gold")
    days = snapshots.build_snapshot_dates(silver)
    labels = star_schema.scored_labels(spark, SF_DIR)
    pairs = catalog.catalog.item_categories(star_schema.item_properties(spark, SF_DIR))

    tree = star_schema.category_tree(spark, SF_DIR)
    raw = star_schema.raw_events(spark, SF_DIR)
    training_rows = storage.materialise(gold.build_training_frame(silver))

    queries = {
        "dq_classify": lambda: quality.validate(bronze),
        "dq_metrics": lambda: quality.quality_metrics_from_counts(quality.count_copies(bronze)),
        "session_features": lambda: sessions.build_session_features(silver, days),
        "popularity_features": lambda: popularity.build_item_popularity_features(silver, days),
        "threshold_sparse": lambda: popularity.top_seller_threshold(silver),
        "gold": lambda: gold.build_gold(silver),
        "gold_by_parts": lambda: gold.build_gold_by_parts(silver, days),
        "training_frame": lambda: gold.build_training_frame(silver),
        "scoring": lambda: score.predict(
            catalog.fixed_score, score.prepare_inference_data(stored_gold)
        ),
        "session_summary": lambda: explore.session_summary(silver),
        "visitor_funnel": lambda: explore.build_funnel(
            explore.visitor_event_counts(silver), "visitors"
        ),
        "pareto_items": lambda: explore.pareto_analysis(
            explore.item_event_counts(silver), "itemid", "transaction", "items"
        ),
        "category_purchases": lambda: catalog.catalog.category_purchases(silver, pairs),
        "evaluate_model": lambda: evaluate.evaluate_model(labels),
        "ranking_analysis": lambda: evaluate.ranking_analysis(labels),
        "category_depth": lambda: catalog.catalog.build_category_depth(tree),
        "end_to_end": lambda: batch_job.score_raw_events(raw, catalog.fixed_score),
        "logistic_fit": lambda: train.score_rows(
            train.fit_model(training_rows, train.ModelSpec("logistic")), training_rows
        ),
    }
    seconds = {}
    for name, build in queries.items():
        times = []
        for _ in range(RUNS):
            start = time.perf_counter()
            with storage.scope(spark):
                build().write.format("noop").mode("overwrite").save()
                times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    total = sum(seconds.values())
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(total, 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
