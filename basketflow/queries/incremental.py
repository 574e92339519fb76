"""Incremental aggregation: runs over arriving day folders, and the state they leave."""

import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.highwater import HighWaterAggregation
from ..session import working_dir
from ..streaming.incremental import IncrementalAggregation
from ..streaming.stateful import StatefulTotals
from .arrivals import COLUMNS, IN_ORDER, LATE_DAY, Arrivals
from ..sources import files
from .inputs import (
    EVENT_FACTS_SQL,
    EVENT_IDS,
    EVENT_TYPES,
    RAW_FACTS_SQL,
    RAW_TOTALS_SQL,
    event_baskets,
    event_totals_sql,
    raw_event_baskets,
)


def _run(arrivals: Arrivals, script, **options) -> IncrementalAggregation:
    job = IncrementalAggregation(
        arrivals.spark, arrivals.landing, arrivals.state, EVENT_IDS, COLUMNS, **options
    )
    for days in script:
        arrivals.arrive(days)
        job.run_available()
    return job


def agg_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run per day, in order."""
    return _run(Arrivals(spark, sf_dir, "agg_incremental"), IN_ORDER).totals()


def agg_incremental_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A late day, a run without news and three days at once."""
    return _run(Arrivals(spark, sf_dir, "agg_incremental_late"), LATE_DAY).totals()


def agg_catch_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days in one run, a bounded number of files per batch."""
    arrivals = Arrivals(spark, sf_dir, "agg_catch_up")
    return _run(arrivals, ([0, 1, 2, 3, 4, 5, 6],), max_files_per_trigger=3).totals()


def agg_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial sums folded into a base half way, folded batches deleted, then more days."""
    arrivals = Arrivals(spark, sf_dir, "agg_compacted")
    job = _run(arrivals, LATE_DAY[:2])
    job.partials.compact()
    job.partials.vacuum()
    return _run(arrivals, LATE_DAY[2:]).totals()


def agg_file_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files are forgotten after an hour: a day comes with an old time, a counted file gets a new one.

    Day 0 is so much older than days 1 and 3 that it is forgotten at once.
    """
    arrivals = Arrivals(spark, sf_dir, "agg_file_age")
    now = time.time()
    job = IncrementalAggregation(spark, arrivals.landing, arrivals.state, EVENT_IDS, COLUMNS, max_file_age="1h")
    arrivals.arrive([0])
    files.set_time(spark, f"{arrivals.landing}/0/*.csv", now - 2 * 86400)
    arrivals.arrive([1, 3])
    job.run_available()
    arrivals.arrive([2])
    files.set_time(spark, f"{arrivals.landing}/2/*.csv", now - 86400)
    job.run_available()
    files.set_time(spark, f"{arrivals.landing}/[02]/*.csv", now + 60)
    arrivals.arrive([4, 5, 6])
    for _ in range(2):
        job.run_available()
        job.compact()
    return job.totals()


def agg_stateful(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running totals in a state store, as days arrive late; the batch of day 2 is repeated."""
    arrivals = Arrivals(spark, sf_dir, "agg_stateful")
    job = StatefulTotals(spark, arrivals.landing, arrivals.state, EVENT_IDS, COLUMNS, compact_every=3)
    for days in LATE_DAY:
        arrivals.arrive(days)
        job.run_available()
        if days == [2]:
            files.remove_dir(spark, f"{job.checkpoint}/commits/2")
            files.remove_dir(spark, f"{job.checkpoint}/commits/.2.crc")
            job.run_available()
    return job.totals()


def agg_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival folders by date: weekdays return week after week, their sums merge."""
    base = working_dir(spark, "agg_dates")
    dated = event_baskets(spark, sf_dir, F.date_format("ts", "yyyyMMdd").alias("day"))
    dated.write.partitionBy("day").option("header", True).csv(f"{base}/landing")
    job = IncrementalAggregation(spark, f"{base}/landing", f"{base}/state", EVENT_IDS, COLUMNS)
    job.run_available()
    return job.totals()


def agg_incremental_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first folders lack a category that later ones have, in another column order."""
    arrivals = Arrivals(spark, sf_dir, "agg_incremental_drift")
    job = IncrementalAggregation(spark, arrivals.landing, arrivals.state, EVENT_IDS)
    for day in range(7):
        rows = arrivals.staged_day(day)
        rows = rows.drop("purchase") if day < 2 else rows.select(*reversed(COLUMNS))
        rows = rows.withColumnRenamed("error", "day")
        if day == 1:
            files.create(spark, f"{arrivals.landing}/9/empty.csv")
        rows.write.option("header", True).csv(f"{arrivals.landing}/{day}")
        if day in (1, 6):
            job.run_available()
    return job.totals()


def agg_highwater(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strict rule: day 2 arrives after day 3 and stays out."""
    return _run_highwater(Arrivals(spark, sf_dir, "agg_highwater"), LATE_DAY).totals()


def skipped_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_highwater(Arrivals(spark, sf_dir, "skipped_days"), LATE_DAY).skipped_days()


def _run_highwater(arrivals: Arrivals, script) -> HighWaterAggregation:
    job = HighWaterAggregation(arrivals.spark, arrivals.landing, arrivals.state, EVENT_IDS)
    for days in script:
        arrivals.arrive(days)
        job.run()
    return job


def pending_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days 2 and 4 have arrived since the last run."""
    arrivals = Arrivals(spark, sf_dir, "pending_days")
    job = _run(arrivals, LATE_DAY[:2])
    arrivals.arrive([2, 4])
    return job.pending_days()


def pending_days_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``pending_days``, with the state folded after every batch and the folded batches deleted."""
    arrivals = Arrivals(spark, sf_dir, "pending_days_compacted")
    _run(arrivals, LATE_DAY[:2], compact_every=1).compact()
    job = _run(arrivals, LATE_DAY[2:4], compact_every=1)
    arrivals.arrive([4])
    return job.pending_days()


def pending_days_quiet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days without a positive quantity, or without any basket, are processed like others."""
    arrivals = Arrivals(spark, sf_dir, "pending_days_quiet")
    zero = arrivals.staged_day(3).withColumns({kind: F.lit("0") for kind in EVENT_TYPES})
    zero.write.option("header", True).csv(f"{arrivals.landing}/3")
    zero.limit(0).write.option("header", True).csv(f"{arrivals.landing}/5")
    job = _run(arrivals, ([0],), compact_every=1)
    done = job.processed_days().select("day", F.lit("processed").alias("state"))
    arrivals.arrive([6])
    return done.unionByName(job.pending_days().withColumn("state", F.lit("pending")))


PENDING_QUIET_SQL = f"""
    SELECT DISTINCT order_dow AS day, CASE WHEN order_dow = 6 THEN 'pending' ELSE 'processed' END AS state
    FROM ({EVENT_FACTS_SQL}) WHERE order_dow IN (0, 3, 5, 6)
"""


def quarantine_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dirty export in two arrivals: every cell that did not count, with the reason."""
    base = working_dir(spark, "quarantine_incremental")
    baskets = raw_event_baskets(spark, sf_dir)
    job = IncrementalAggregation(spark, f"{base}/landing", f"{base}/state", EVENT_IDS, baskets.columns)
    for day in range(2):
        part = baskets.filter(F.col("event_id") % 2 == day)
        part.write.option("header", True).csv(f"{base}/landing/{day}")
        job.run_available()
    return job.quarantine()


QUARANTINE_INCREMENTAL_SQL = f"""
    SELECT order_dow, order_hour_of_day, category, items, reason, count(*) AS cells FROM (
        SELECT order_dow, order_hour_of_day, category, items,
               CASE WHEN order_dow IS NULL THEN 'order_dow_missing'
                    WHEN NOT regexp_full_match(order_dow, '[0-9]+') THEN 'order_dow_not_integer'
                    WHEN order_dow NOT IN ('0', '1', '2', '3', '4', '5', '6') THEN 'order_dow_out_of_range'
                    WHEN NOT regexp_full_match(order_hour_of_day, '[0-9]+') THEN 'order_hour_not_integer'
                    WHEN NOT regexp_full_match(items, '[0-9]+([.][0-9]*)?') THEN 'items_not_numeric'
                    END AS reason
        FROM ({RAW_FACTS_SQL}) WHERE items NOT IN ('0', '0.0')
    ) WHERE reason IS NOT NULL GROUP BY ALL
    UNION ALL
    SELECT order_dow, order_hour_of_day, category, CAST(CAST(total AS DECIMAL(38,0)) AS VARCHAR), 'total_too_large', cells
    FROM ({RAW_TOTALS_SQL}) WHERE total > 9223372036854775807
"""


def watermark_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(Arrivals(spark, sf_dir, "watermark_state"), LATE_DAY).processed_days()


def watermark_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After a reset every day is processed again, once."""
    arrivals = Arrivals(spark, sf_dir, "watermark_reset")
    job = _run(arrivals, LATE_DAY)
    job.reset()
    job.run_available()
    per_day = job.totals().groupBy(F.col("order_dow").alias("day")).agg(F.sum("items").alias("items"))
    return job.processed_days().join(per_day, "day")


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each run wrote down, without the columns that differ from run to run."""
    log = _run(Arrivals(spark, sf_dir, "run_log"), LATE_DAY).run_log()
    days = F.concat_ws(",", F.transform("days", lambda d: d.cast("string")))
    return log.select("job", "batch_id", F.when(F.col("days").isNotNull(), days).alias("days"), "rows", "status")


_BATCH_OF_DAY_SQL = "CASE WHEN order_dow <= 1 THEN 0 WHEN order_dow = 3 THEN 1 WHEN order_dow = 2 THEN 2 ELSE 3 END"

WATERMARK_STATE_SQL = f"""
    SELECT DISTINCT order_dow AS day, CAST({_BATCH_OF_DAY_SQL} AS BIGINT) AS batch_id
    FROM ({EVENT_FACTS_SQL})
"""

WATERMARK_RESET_SQL = f"""
    SELECT order_dow AS day, CAST(0 AS BIGINT) AS batch_id, CAST(sum(items) AS BIGINT) AS items
    FROM ({EVENT_FACTS_SQL}) WHERE items > 0 GROUP BY ALL
"""

RUN_LOG_SQL = f"""
    SELECT 'incremental' AS job, CAST(batch AS BIGINT) AS batch_id,
           string_agg(DISTINCT CAST(order_dow AS VARCHAR), ',' ORDER BY CAST(order_dow AS VARCHAR)) AS days,
           count(DISTINCT (order_dow, order_hour_of_day, category)) FILTER (items > 0) AS rows,
           'done' AS status
    FROM (SELECT *, {_BATCH_OF_DAY_SQL} AS batch FROM ({EVENT_FACTS_SQL}))
    GROUP BY batch
    UNION ALL SELECT 'incremental', NULL, NULL, NULL, 'idle'
"""

DRIFT_SQL = f"""
    SELECT * REPLACE (CASE category WHEN 'error' THEN 'day' ELSE category END AS category)
    FROM ({event_totals_sql("NOT (category = 'purchase' AND order_dow < 2)")})
"""

QUERIES = {
    "agg_incremental": (agg_incremental, event_totals_sql()),
    "agg_incremental_late": (agg_incremental_late, event_totals_sql()),
    "agg_catch_up": (agg_catch_up, event_totals_sql()),
    "agg_compacted": (agg_compacted, event_totals_sql()),
    "agg_file_age": (agg_file_age, event_totals_sql()),
    "agg_stateful": (agg_stateful, event_totals_sql()),
    "agg_dates": (agg_dates, event_totals_sql()),
    "agg_incremental_drift": (agg_incremental_drift, DRIFT_SQL),
    "agg_highwater": (agg_highwater, event_totals_sql("order_dow <> 2")),
    "skipped_days": (skipped_days, f"SELECT DISTINCT order_dow AS day FROM ({EVENT_FACTS_SQL}) WHERE order_dow = 2"),
    "pending_days": (pending_days, f"SELECT DISTINCT order_dow AS day FROM ({EVENT_FACTS_SQL}) WHERE order_dow IN (2, 4)"),
    "pending_days_compacted": (
        pending_days_compacted,
        f"SELECT DISTINCT order_dow AS day FROM ({EVENT_FACTS_SQL}) WHERE order_dow = 4",
    ),
    "pending_days_quiet": (pending_days_quiet, PENDING_QUIET_SQL),
    "quarantine_incremental": (quarantine_incremental, QUARANTINE_INCREMENTAL_SQL),
    "watermark_state": (watermark_state, WATERMARK_STATE_SQL),
    "watermark_reset": (watermark_reset, WATERMARK_RESET_SQL),
    "run_log": (run_log, RUN_LOG_SQL),
}
