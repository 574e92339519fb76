"""Command line: ``spark-submit`` this package's jobs.

    python -m basketflow split ORDERS_CSV RAW_DIR
    python -m basketflow full RAW_DIR OUTPUT_DIR
    python -m basketflow incremental LANDING_DIR STATE_DIR [--every "4 seconds"]
    python -m basketflow train STATE_DIR MODEL_DIR [--every "20 seconds"]
    python -m basketflow predict MODEL_DIR PREDICTION_DIR [--input ROWS]
    python -m basketflow predict-cached MODEL_DIR PREDICTION_DIR CACHE_DIR
    python -m basketflow refresh MODEL_DIR PREDICTION_DIR CACHE_DIR [--every "20 seconds"]
    python -m basketflow get CACHE_DIR KEY
    python -m basketflow keys CACHE_DIR [OUTPUT_CSV]
    python -m basketflow compact STATE_DIR
    python -m basketflow compact-cache CACHE_DIR
"""

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .errors import EmptyInput, MalformedBaskets, MalformedKey, ModelNotFound
from .functions.keys import KEYS
from .operators.serving import list_keys, lookup
from .plans.aggregation import full_aggregation, leading_id_columns, split_orders
from .plans.highwater import HighWaterAggregation
from .plans.periodic import repeat
from .plans.scoring import prediction_cache, refresh_if_retrained, score, score_and_cache
from .plans.state import AggregationState
from .plans.training import ForestSettings, train_if_changed, train_model
from .session import build_session
from .sinks.csv import export_csv
from .sources.baskets import available_days, csv_columns, days_glob
from .sources.models import ModelStore
from .streaming.incremental import IncrementalAggregation
from .streaming.stateful import StatefulTotals


def names(text: str) -> list[str]:
    return [name.strip() for name in text.split(",")]


def option(text: str) -> tuple[str, str]:
    name, _, value = text.partition("=")
    return name, value


def arguments(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="basketflow")
    jobs = parser.add_subparsers(dest="job", required=True)

    split = jobs.add_parser("split", help="orders CSV to one folder per weekday")
    split.add_argument("orders")
    split.add_argument("output")
    split.add_argument("--quarantine", help="also as a table: the lines that fit no weekday")
    split.add_argument("--rebalance", action="store_true")
    split.add_argument("--log", help="run log folder")

    full = jobs.add_parser("full", help="aggregate all day folders")
    full.add_argument("raw")
    full.add_argument("output")
    full.add_argument("--ids", type=names, help="id columns; default: the first four")
    full.add_argument("--csv")
    full.add_argument("--quarantine", help="a table of all that did not count")
    full.add_argument("--log", help="run log folder")

    incremental = jobs.add_parser("incremental", help="aggregate what has arrived since the last run")
    incremental.add_argument("landing")
    incremental.add_argument("state")
    incremental.add_argument("--ids", type=names, help="id columns; default: the first four")
    incremental.add_argument("--drift", action="store_true", help="files may differ in their headers")
    incremental.add_argument("--every", help="keep running with this interval, e.g. '4 seconds'")
    incremental.add_argument("--max-files", type=int, help="files per micro-batch")
    incremental.add_argument("--max-file-age", default="7d", help="how long files are remembered, e.g. 90m, 36h or 7d; older ones are looked up")
    incremental.add_argument("--archive", help="folder to move processed files to")
    incremental.add_argument("--compact-every", type=int, default=100, help="batches between folds")
    incremental.add_argument("--csv", help="export the merged aggregate")
    incremental.add_argument("--quarantine", help="a table of all that did not count")

    stateful = jobs.add_parser("stateful", help="incremental, with running totals in a state store")
    stateful.add_argument("landing")
    stateful.add_argument("state")
    stateful.add_argument("--ids", type=names, help="id columns; default: the first four")
    stateful.add_argument("--every", help="keep running with this interval, e.g. '4 seconds'")
    stateful.add_argument("--csv", help="export the totals")

    highwater = jobs.add_parser("highwater", help="incremental, days above the last one only")
    highwater.add_argument("landing")
    highwater.add_argument("state")
    highwater.add_argument("--ids", type=names, help="id columns; default: the first four")

    for name, text in (("reset", "forget the progress; the next run starts over"), ("compact", "fold the state's tables")):
        job = jobs.add_parser(name, help=text)
        job.add_argument("state")

    train = jobs.add_parser("train", help="train a model version on the aggregate")
    train.add_argument("state", nargs="?", help="state of an incremental job, strict or not")
    train.add_argument("models")
    train.add_argument("--input", help="train on this aggregate table instead")
    train.add_argument("--strict", action="store_true")
    train.add_argument("--every", help="train again whenever the aggregate has changed")

    for name, text in (
        ("predict", "score the current model's test set"),
        ("predict-cached", "score, and refresh the cache"),
        ("refresh", "score and cache again if a newer model was published"),
    ):
        predict = jobs.add_parser(name, help=text)
        predict.add_argument("models")
        predict.add_argument("output")
        if name != "predict":
            predict.add_argument("cache")
            predict.add_argument("--client", help="key-value client as package.module:factory")
            predict.add_argument("--client-option", type=option, action="append", default=[], metavar="NAME=VALUE")
        if name == "refresh":
            predict.add_argument("--every", help="keep running with this interval")
        predict.add_argument("--input", help="table of rows to score instead of the test set")
        predict.add_argument("--csv")

    get = jobs.add_parser("get", help="the cached prediction of dow:hour:category")
    get.add_argument("cache")
    get.add_argument("key")

    keys = jobs.add_parser("keys", help="all cached keys, in order")
    keys.add_argument("cache")
    keys.add_argument("output", nargs="?", help="CSV folder; default: print them")

    compact_cache = jobs.add_parser("compact-cache", help="fold the cache's batches")
    compact_cache.add_argument("cache")
    return parser.parse_args(argv)


def header(spark: SparkSession, landing: str) -> list[str]:
    """Column names of the first day that has files."""
    days = available_days(spark, landing)
    if not days:
        raise EmptyInput(landing)
    return csv_columns(spark, days_glob(landing, days[:1]))


def incremental_job(spark: SparkSession, args) -> IncrementalAggregation:
    columns = header(spark, args.landing)
    return IncrementalAggregation(
        spark,
        args.landing,
        args.state,
        args.ids or leading_id_columns(columns),
        None if args.drift else columns,
        max_files_per_trigger=args.max_files,
        max_file_age=args.max_file_age,
        archive=args.archive,
        compact_every=args.compact_every,
    )


def rows_of(spark: SparkSession, path: str | None) -> DataFrame | None:
    return None if path is None else spark.read.parquet(path)


def repeated(job: Callable[[], object], every: str | None) -> None:
    if every:
        repeat(job, every)
    else:
        job()


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    if args.job == "split":
        split_orders(spark, args.orders, args.output, args.quarantine, args.rebalance, run_log=args.log)
    elif args.job == "full":
        full_aggregation(
            spark, args.raw, args.output, args.ids, csv_output=args.csv, quarantine=args.quarantine, run_log=args.log
        )
    elif args.job == "incremental":
        job = incremental_job(spark, args)
        if args.every:
            job.run_every(args.every).awaitTermination()
        else:
            print("batches:", job.run_available())
            if args.csv:
                export_csv(job.totals(), args.csv)
            if args.quarantine:
                job.quarantine().write.mode("overwrite").parquet(args.quarantine)
    elif args.job == "stateful":
        columns = header(spark, args.landing)
        totals = StatefulTotals(spark, args.landing, args.state, args.ids or leading_id_columns(columns), columns)
        if args.every:
            totals.run_every(args.every).awaitTermination()
        else:
            totals.run_available()
            if args.csv:
                export_csv(totals.totals(), args.csv)
    elif args.job == "highwater":
        ids = args.ids or leading_id_columns(header(spark, args.landing))
        strict = HighWaterAggregation(spark, args.landing, args.state, ids)
        print("days:", strict.run(), "skipped:", [r.day for r in strict.skipped_days().collect()])
    elif args.job == "reset":
        AggregationState(spark, args.state).reset()
    elif args.job == "compact":
        AggregationState(spark, args.state).compact()
    elif args.job == "train":
        train(spark, args)
    elif args.job == "predict":
        score(
            spark,
            ModelStore(spark, args.models),
            args.output,
            rows_of(spark, args.input),
            csv_output=args.csv,
            run_log=f"{args.models}/run_log",
        )
    elif args.job in ("predict-cached", "refresh"):
        job = score_and_cache if args.job == "predict-cached" else refresh_if_retrained
        options = {"client": args.client, **dict(args.client_option)}
        work = lambda: job(
            spark,
            ModelStore(spark, args.models),
            args.output,
            prediction_cache(spark, args.cache),
            rows_of(spark, args.input),
            csv_output=args.csv,
            run_log=f"{args.models}/run_log",
            **options,
        )
        repeated(work, getattr(args, "every", None))
    elif args.job == "get":
        found = lookup(prediction_cache(spark, args.cache).read(), args.key).first()
        if found is None:
            print(f"no prediction for {args.key}")
            return 1
        print(found.prediction)
    elif args.job == "keys":
        keys = list_keys(prediction_cache(spark, args.cache).rows()).orderBy("key")
        if args.output:
            export_csv(keys, args.output)
        else:
            for row in keys.toLocalIterator():
                print(row.key)
    elif args.job == "compact-cache":
        cache = prediction_cache(spark, args.cache)
        cache.vacuum()
        cache.compact()
    return 0


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    store = ModelStore(spark, args.models)
    settings, log = ForestSettings(strict=args.strict), f"{args.models}/run_log"
    if not args.input and not args.state:
        raise EmptyInput("name a state or an --input")

    def totals() -> DataFrame:
        if args.input:
            return spark.read.parquet(args.input).select(*KEYS, F.col("items").cast("bigint").alias("items"))
        return AggregationState(spark, args.state).totals()

    if args.every:
        version = lambda: None if args.input else AggregationState(spark, args.state).version()
        poll = lambda: train_if_changed(spark, state=version(), totals=totals(), store=store, settings=settings, run_log=log)
        repeat(poll, args.every)
    else:
        train_model(spark, totals(), store, settings, run_log=log)
        store.metrics().show()


def main(argv=None) -> int:
    args = arguments(argv)
    spark = build_session(f"basketflow-{args.job}")
    try:
        return run(spark, args)
    except (EmptyInput, MalformedBaskets, MalformedKey, ModelNotFound) as error:
        print(f"{type(error).__name__}: {error}")
        return 1


if __name__ == "__main__":
    raise SystemExit(main())
