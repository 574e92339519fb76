"""Times the headline jobs and queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default: all).
Each figure is the better of two runs after a first one, inputs prepared beforehand.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from basketflow.operators.aggregate import basket_ledger, basket_totals
from basketflow.operators.serving import cache_rows, lookup
from basketflow.plans.scoring import prediction_cache, score, score_and_cache
from basketflow.plans.training import train_model
from basketflow.queries.arrivals import COLUMNS, LATE_DAY, Arrivals
from basketflow.queries.inputs import EVENT_IDS, ORDER_IDS, order_baskets, order_totals
from basketflow.queries.registry import REGISTRY
from basketflow.session import build_session, working_dir
from basketflow.sinks.csv import write_day_folders
from basketflow.sources.baskets import read_csv, text_schema
from basketflow.sources.models import ModelStore
from basketflow.streaming.incremental import IncrementalAggregation

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
QUERIES = (
    "agg_full",
    "agg_events",
    "agg_fractions",
    "melt_baskets",
    "quarantine",
    "split_by_dow",
    "schema_drift",
    "split_test",
    "feature_vector",
    "mse",
    "prediction_cache",
    "cache_serve",
)


def run(df):
    df.write.format("noop").mode("overwrite").save()


def best(action, runs=3):
    """Seconds of the best run but the first."""
    times = []
    for _ in range(runs):
        started = time.perf_counter()
        action()
        times.append(time.perf_counter() - started)
    return round(min(times[1:]), 3)


def main():
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    base = working_dir(spark, "bench")
    timings = {}

    baskets = order_baskets(spark, SF_DIR)
    baskets.write.option("header", True).csv(f"{base}/baskets")
    wide = lambda: read_csv(spark, f"{base}/baskets/*.csv", text_schema(baskets.columns))
    timings["csv_melt_aggregate"] = best(lambda: run(basket_totals(wide(), ORDER_IDS)))
    timings["csv_sums_and_rejects"] = best(lambda: run(basket_ledger(wide(), ORDER_IDS)))
    timings["csv_split_by_weekday"] = best(lambda: write_day_folders(wide(), f"{base}/days"))
    whole = lambda: read_csv(spark, f"{base}/baskets/*.csv", text_schema(baskets.columns), keep_malformed=True)
    timings["csv_split_with_quarantine"] = best(lambda: write_day_folders(whole(), f"{base}/sorted"))

    arrivals = Arrivals(spark, SF_DIR, "bench")
    job = IncrementalAggregation(spark, arrivals.landing, arrivals.state, EVENT_IDS, COLUMNS)
    days = iter(range(7))

    def one_arrival():
        arrivals.arrive([next(days)])
        job.run_available()

    timings["incremental_run"] = best(one_arrival)
    five = Arrivals(spark, SF_DIR, "bench")

    def five_runs():
        five.state += "x"
        five.landing += "x"
        five_job = IncrementalAggregation(spark, five.landing, five.state, EVENT_IDS, COLUMNS)
        for arrived in LATE_DAY:
            five.arrive(arrived)
            five_job.run_available()

    timings["incremental_five_runs"] = best(five_runs, runs=2)

    totals_path = f"{base}/totals"
    order_totals(spark, SF_DIR).write.parquet(totals_path)
    store = ModelStore(spark, f"{base}/models")
    cache = prediction_cache(spark, f"{base}/cache")
    timings["train_run"] = best(lambda: train_model(spark, spark.read.parquet(totals_path), store))
    timings["score_and_cache_run"] = best(
        lambda: score_and_cache(spark, store, f"{base}/predictions", cache)
    )

    # A lookup in a cache of many refreshes, before and after folding.
    many = prediction_cache(spark, f"{base}/many")
    predictions = score(spark, store, f"{base}/predictions")
    for _ in range(20):
        many.append(cache_rows(predictions, 1))
    timings["lookup_in_20_batches"] = best(lambda: lookup(many.read(), "3:8:Brand#11").collect(), runs=2)
    many.compact()
    timings["lookup_in_folded_cache"] = best(lambda: lookup(many.read(), "3:8:Brand#11").collect(), runs=2)

    for name in QUERIES:
        timings[name] = best(lambda: run(REGISTRY[name][0](spark, SF_DIR)))

    print(
        json.dumps(
            {
                "metric": "sum of best warm times",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(CPUS),
            }
        ),
        flush=True,
    )


if __name__ == "__main__":
    main()
