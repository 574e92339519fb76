"""Reshape, filter, aggregate, CSV and quarantine queries."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.keys import KEYS
from ..functions.quantity import quantity
from ..operators.aggregate import (
    basket_ledger,
    basket_totals,
    basket_totals_by_column,
    facts_ledger,
    ledger_rejects,
    ledger_totals,
    positive_items,
    total_items,
)
from ..operators.features import cast_features
from ..operators.quality import quarantined_baskets, quarantined_cells
from ..operators.reshape import melt_baskets, valid_keys
from ..plans.aggregation import full_aggregation, split_orders, weekday
from ..session import working_dir
from ..sources import files
from ..sinks.csv import export_csv, write_day_folders
from ..sources.baskets import ARRIVAL_DAY, MALFORMED, melt_drifting_files, read_csv, read_days, text_schema, union_days
from .inputs import (
    EVENT_FACTS_SQL,
    EVENT_IDS,
    EVENT_TYPES,
    ORDER_FACTS_SQL,
    ORDER_IDS,
    ORDER_TOTALS_SQL,
    RAW_FACTS_SQL,
    RAW_TOTALS_SQL,
    event_baskets,
    event_totals,
    event_totals_sql,
    order_baskets,
    order_totals,
    raw_event_baskets,
)


def agg_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_totals(spark, sf_dir)


def agg_full_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return basket_totals_by_column(order_baskets(spark, sf_dir), ORDER_IDS)


def agg_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_totals(spark, sf_dir)


def agg_fractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts with decimals: fractions add up before the sum is cut to an integer."""
    return basket_totals(raw_event_baskets(spark, sf_dir), EVENT_IDS)


AGG_FRACTIONS_SQL = f"""
    SELECT CAST(order_dow AS INTEGER) AS order_dow,
           CAST(order_hour_of_day AS INTEGER) AS order_hour_of_day,
           category, CAST(total AS BIGINT) AS items
    FROM ({RAW_TOTALS_SQL}) WHERE total <= 9223372036854775807
"""


def agg_large_quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts of a dozen more digits: what the sums are, and what no BIGINT holds."""
    baskets = raw_event_baskets(spark, sf_dir)
    raised = F.concat("scaled", F.lit("00"))
    ledger = basket_ledger(baskets.withColumn("scaled", raised), EVENT_IDS)
    totals = ledger_totals(ledger).select(
        *[F.col(k).cast("string").alias(k) for k in KEYS], F.col("items").cast("string").alias("items")
    )
    beyond = ledger_rejects(ledger).filter("reason = 'total_too_large'")
    return totals.withColumn("fits", F.lit(True)).unionByName(
        beyond.select(*KEYS, "items").withColumn("fits", F.lit(False))
    )


AGG_LARGE_SQL = f"""
    SELECT order_dow, order_hour_of_day, category, CAST(CAST(total AS DECIMAL(38,0)) AS VARCHAR) AS items,
           total <= 9223372036854775807 AS fits
    FROM (SELECT * REPLACE (CASE WHEN category = 'scaled' THEN total * 100 ELSE total END AS total)
          FROM ({RAW_TOTALS_SQL}))
"""


def agg_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders CSV, weekday folders, full aggregation: the whole batch path over files."""
    base = working_dir(spark, "agg_job")
    event_baskets(spark, sf_dir).write.option("header", True).csv(f"{base}/orders")
    split_orders(spark, f"{base}/orders/*.csv", f"{base}/raw")
    return full_aggregation(spark, f"{base}/raw", f"{base}/aggregate")


def melt(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = melt_baskets(order_baskets(spark, sf_dir), ORDER_IDS, keep=ORDER_IDS)
    return facts.filter(F.col("items").isNotNull())


def positives(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = melt_baskets(raw_event_baskets(spark, sf_dir), EVENT_IDS, keep=("event_id",))
    return positive_items(facts).select("event_id", "category", "quantity")


POSITIVE_ITEMS_SQL = f"""
    SELECT event_id, category, CAST(items AS DOUBLE) AS quantity
    FROM ({RAW_FACTS_SQL})
    WHERE category <> 'note' AND CAST(items AS DOUBLE) >= 1
      AND CAST(items AS DOUBLE) < 1e38
"""


def cast_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = melt_baskets(raw_event_baskets(spark, sf_dir), EVENT_IDS, keep=EVENT_IDS)
    return cast_features(facts).select("event_id", *KEYS, "items")


CAST_FEATURES_SQL = f"""
    SELECT event_id,
           CASE WHEN regexp_full_match(order_dow, '[0-9]+')
                THEN CAST(order_dow AS INTEGER) END AS order_dow,
           CASE WHEN regexp_full_match(order_hour_of_day, '[0-9]+')
                THEN CAST(order_hour_of_day AS INTEGER) END AS order_hour_of_day,
           category,
           CASE WHEN regexp_full_match(items, '[0-9]+') THEN CAST(items AS BIGINT) END AS items
    FROM ({RAW_FACTS_SQL})
"""


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantined_cells(raw_event_baskets(spark, sf_dir), EVENT_IDS)


_KEY_REASON_SQL = """
           WHEN order_dow IS NULL THEN 'order_dow_missing'
           WHEN NOT regexp_full_match(order_dow, '[0-9]+') THEN 'order_dow_not_integer'
           WHEN order_dow NOT IN ('0', '1', '2', '3', '4', '5', '6') THEN 'order_dow_out_of_range'
           WHEN NOT regexp_full_match(order_hour_of_day, '[0-9]+') THEN 'order_hour_not_integer'
"""

QUARANTINE_SQL = f"""
    SELECT * FROM (
        SELECT order_dow, order_hour_of_day, category, items,
               CASE {_KEY_REASON_SQL}
               WHEN NOT regexp_full_match(items, '[0-9]+([.][0-9]*)?') THEN 'items_not_numeric'
               WHEN CAST(items AS DOUBLE) >= 1e38 THEN 'items_too_large' END AS reason
        FROM ({RAW_FACTS_SQL})
    ) WHERE reason IS NOT NULL
"""


def quarantine_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quarantined_baskets(raw_event_baskets(spark, sf_dir))
    return rows.select("event_id", "order_dow", "order_hour_of_day", "reason")


QUARANTINE_BASKETS_SQL = f"""
    SELECT * FROM (
        SELECT event_id, order_dow, order_hour_of_day, CASE {_KEY_REASON_SQL} END AS reason
        FROM ({RAW_FACTS_SQL}) WHERE category = 'amount'
    ) WHERE reason IS NOT NULL
"""


def split_by_dow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekday folders written in one pass; each row back with the folder it lies in."""
    folders = working_dir(spark, "split_by_dow")
    baskets = event_baskets(spark, sf_dir)
    write_day_folders(baskets, folders)
    rows = read_days(spark, folders, range(7), text_schema(baskets.columns))
    return rows.select(
        *[F.col(c).cast("bigint").alias(c) for c in ("event_id", "user_id")],
        *[F.col(c).cast("int").alias(c) for c in ("order_dow", "order_hour_of_day")],
        F.col(ARRIVAL_DAY).alias("day"),
    )


SPLIT_BY_DOW_SQL = f"""
    SELECT event_id, user_id, order_dow, order_hour_of_day, order_dow AS day
    FROM ({EVENT_FACTS_SQL})
"""


def split_orders_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dirty export split by weekday: what each folder and the quarantine got."""
    base = working_dir(spark, "split_orders")
    raw_event_baskets(spark, sf_dir).write.option("header", True).csv(f"{base}/orders")
    split_orders(
        spark, f"{base}/orders/*.csv", f"{base}/raw", quarantine=f"{base}/bad", rebalance=True
    )
    kept = read_days(spark, f"{base}/raw", range(7)).groupBy(F.col(ARRIVAL_DAY).alias("day")).count()
    bad = spark.read.parquet(f"{base}/bad").groupBy("reason").count()
    return kept.select(F.col("day").cast("string").alias("target"), F.col("count").alias("baskets")).unionByName(
        bad.select(F.col("reason").alias("target"), F.col("count").alias("baskets"))
    )


SPLIT_ORDERS_SQL = f"""
    SELECT target, count(*) AS baskets FROM (
        SELECT coalesce(CASE {_KEY_REASON_SQL} END, order_dow) AS target
        FROM ({RAW_FACTS_SQL}) WHERE category = 'amount'
    ) GROUP BY target
"""


def split_orders_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export with broken lines: every line once, in a weekday folder or in quarantine."""
    base = working_dir(spark, "split_orders_malformed")
    baskets = raw_event_baskets(spark, sf_dir)
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in baskets.columns])
    broken = (
        F.when(F.col("event_id") % 7 == 0, F.concat(line, F.lit(",more")))
        .when(F.col("event_id") % 7 == 1, F.substring_index(line, ",", 5))
        .otherwise(line)
    )
    # A table of whole lines, headed by the header.
    baskets.select(broken.alias(",".join(baskets.columns))).write.option("header", True).option("sep", "|").option(
        "escapeQuotes", False
    ).csv(f"{base}/orders")
    split_orders(spark, f"{base}/orders/*.csv", f"{base}/raw", quarantine=f"{base}/bad")
    schema = text_schema(baskets.columns)
    kept = read_days(spark, f"{base}/raw", range(7), schema).select(
        "event_id", F.col(ARRIVAL_DAY).cast("string").alias("target")
    )
    whole = F.substring_index(F.coalesce(F.col(MALFORMED), F.col("event_id")), ",", 1)
    bad = spark.read.parquet(f"{base}/bad").select(whole.alias("event_id"), F.col("reason").alias("target"))
    rows = kept.unionByName(bad)
    return rows.select(F.col("event_id").cast("bigint").alias("event_id"), "target")


SPLIT_MALFORMED_SQL = f"""
    SELECT event_id, CASE WHEN event_id % 7 < 2 THEN 'malformed_line'
                          ELSE coalesce(CASE {_KEY_REASON_SQL} END, order_dow) END AS target
    FROM ({RAW_FACTS_SQL}) WHERE category = 'amount'
"""


def weekday_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekday(event_baskets(spark, sf_dir), 3)


WEEKDAY_SQL = f"""
    SELECT event_id, user_id, order_dow, order_hour_of_day,
           {", ".join(f"CASE WHEN category = '{k}' THEN items END AS {k}" for k in EVENT_TYPES)}
    FROM ({EVENT_FACTS_SQL}) WHERE order_dow = 3
"""


def day_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten days asked for in one scan, of which three have no folder."""
    folders = working_dir(spark, "day_union")
    baskets = event_baskets(spark, sf_dir)
    write_day_folders(baskets, folders)
    rows = read_days(spark, folders, range(10), text_schema(baskets.columns))
    return rows.groupBy(F.col(ARRIVAL_DAY).alias("day")).agg(
        F.count(F.lit(1)).alias("baskets"),
        F.sum(F.coalesce(*[quantity(F.col(k), rows.schema[k].dataType) for k in EVENT_TYPES]))
        .cast("bigint")
        .alias("items"),
    )


DAY_UNION_SQL = f"""
    SELECT order_dow AS day, count(*) AS baskets, CAST(sum(items) AS BIGINT) AS items
    FROM ({EVENT_FACTS_SQL}) GROUP BY ALL
"""


def day_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables with other column orders and one column apart, united by name."""
    baskets = event_baskets(spark, sf_dir)
    weekdays = baskets.filter(F.col("order_dow").between(1, 5))
    weekend = baskets.filter(~F.col("order_dow").between(1, 5))
    return union_days([weekdays, weekend.select(*reversed(baskets.columns)).drop("signup")])


DAY_UNION_BY_NAME_SQL = f"""
    SELECT event_id, user_id, order_dow, order_hour_of_day,
           {", ".join(
               f"CASE WHEN category = '{k}'"
               f"{' AND order_dow BETWEEN 1 AND 5' if k == 'signup' else ''} THEN items END AS {k}"
               for k in EVENT_TYPES)}
    FROM ({EVENT_FACTS_SQL})
"""


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The aggregate exported as one CSV file and read back by glob, typed again."""
    path = working_dir(spark, "csv_roundtrip")
    totals = event_totals(spark, sf_dir)
    export_csv(totals, path)
    return cast_features(read_csv(spark, f"{path}/*.csv", text_schema(totals.columns)))


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with reordered columns and other category sets, summed together."""
    base = working_dir(spark, "schema_drift")
    baskets = event_baskets(spark, sf_dir)
    weekdays = baskets.filter(F.col("order_dow").between(1, 5))
    weekend = baskets.filter(~F.col("order_dow").between(1, 5))
    renamed = weekend.withColumnsRenamed({"view": "it's: a view, seen", "error": "day"}).drop("signup")
    weekdays.write.option("header", True).csv(f"{base}/week")
    renamed.select(*reversed(renamed.columns)).write.option("header", True).csv(f"{base}/weekend")
    files.create(spark, f"{base}/weekend/empty.csv")
    facts = melt_drifting_files(spark, f"{base}/*/*.csv", EVENT_IDS)
    return total_items(valid_keys(facts))


SCHEMA_DRIFT_SQL = f"""
    SELECT order_dow, order_hour_of_day,
           CASE WHEN category = 'view' AND order_dow NOT BETWEEN 1 AND 5 THEN 'it''s: a view, seen'
                WHEN category = 'error' AND order_dow NOT BETWEEN 1 AND 5 THEN 'day'
                ELSE category END AS category,
           CAST(sum(items) AS BIGINT) AS items
    FROM ({EVENT_FACTS_SQL})
    WHERE items > 0 AND NOT (category = 'signup' AND order_dow NOT BETWEEN 1 AND 5)
    GROUP BY ALL
"""

def schema_drift_repeated_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per weekday made of two exports, one after the other, with other column orders.

    Some lines stand before the first header, one kind of event is a column of the second export
    only, a header is repeated in between, and a note spells out the names of the id columns.
    """
    path = working_dir(spark, "schema_drift_repeated_header")
    first = [*EVENT_IDS, "click", "error", "view"]
    second = ["note", *reversed(EVENT_TYPES), *EVENT_IDS]
    baskets = event_baskets(spark, sf_dir).withColumn("note", F.lit(f"a field,{','.join(EVENT_IDS)},no header"))
    part = F.when(F.col("event_id") % 50 == 0, 0).when(F.col("event_id") % 3 == 0, 1).otherwise(2)
    quoted_note = F.concat(F.lit('"'), "note", F.lit('"'))

    def line(columns: list[str]) -> Column:
        texts = [quoted_note if c == "note" else F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
        return F.concat_ws(",", *texts)

    lines = baskets.select(
        F.col("order_dow").alias("day"),
        part.alias("part"),
        (F.col("event_id") + 1).alias("place"),
        F.when(part < 2, line(first)).otherwise(line(second)).alias("value"),
    )
    headers = [(1, 0, ",".join(first)), (1, 1000, ",".join(first)), (2, 0, ",".join(second))]
    places = F.array(
        *[F.struct(F.lit(p).alias("part"), F.lit(i).cast("bigint").alias("place"), F.lit(v).alias("value")) for p, i, v in headers]
    )
    whole = lines.unionByName(lines.select("day").distinct().select("day", F.inline(places)))
    ordered = whole.repartition("day").sortWithinPartitions("day", "part", "place")
    ordered.select("day", "value").write.partitionBy("day").text(path)
    facts = melt_drifting_files(spark, f"{path}/*/*.txt", EVENT_IDS, rejects=True, keyed=True)
    ledger = facts_ledger(facts)
    # Totals and rejects are read from it apart; the text is melted once.
    ledger_at = working_dir(spark, "schema_drift_ledger")
    ledger.write.parquet(ledger_at)
    ledger = spark.read.schema(ledger.schema).parquet(ledger_at)
    lost = ledger_rejects(ledger).groupBy("reason").agg(F.sum("cells").alias("items"))
    none = F.lit(None).cast("int")
    return ledger_totals(ledger).unionByName(
        lost.select(none.alias("order_dow"), none.alias("order_hour_of_day"), F.col("reason").alias("category"), "items")
    )


SCHEMA_DRIFT_REPEATED_SQL = f"""
    WITH facts AS (
        SELECT *, CASE WHEN event_id % 50 = 0 THEN 0 WHEN event_id % 3 = 0 THEN 1 ELSE 2 END AS part
        FROM ({EVENT_FACTS_SQL})
    )
    SELECT order_dow, order_hour_of_day, category, CAST(sum(items) AS BIGINT) AS items
    FROM facts WHERE items > 0 AND (part = 2 OR (part = 1 AND category IN ('click', 'error', 'view')))
    GROUP BY ALL
    UNION ALL SELECT NULL, NULL, 'header_missing', count(*) FROM facts WHERE part = 0
    UNION ALL SELECT NULL, NULL, 'items_not_numeric', count(*) FROM facts WHERE part = 2
"""

QUERIES = {
    "agg_full": (agg_full, ORDER_TOTALS_SQL),
    "agg_full_by_column": (agg_full_by_column, ORDER_TOTALS_SQL),
    "agg_events": (agg_events, event_totals_sql()),
    "agg_fractions": (agg_fractions, AGG_FRACTIONS_SQL),
    "agg_job": (agg_job, event_totals_sql()),
    "melt_baskets": (melt, ORDER_FACTS_SQL),
    "positive_items": (positives, POSITIVE_ITEMS_SQL),
    "cast_features": (cast_columns, CAST_FEATURES_SQL),
    "quarantine": (quarantine, QUARANTINE_SQL),
    "quarantine_baskets": (quarantine_baskets, QUARANTINE_BASKETS_SQL),
    "split_by_dow": (split_by_dow, SPLIT_BY_DOW_SQL),
    "split_orders": (split_orders_job, SPLIT_ORDERS_SQL),
    "weekday": (weekday_filter, WEEKDAY_SQL),
    "day_union": (day_union, DAY_UNION_SQL),
    "day_union_by_name": (day_union_by_name, DAY_UNION_BY_NAME_SQL),
    "csv_roundtrip": (csv_roundtrip, event_totals_sql()),
    "agg_large_quantities": (agg_large_quantities, AGG_LARGE_SQL),
    "split_orders_malformed": (split_orders_malformed, SPLIT_MALFORMED_SQL),
    "schema_drift": (schema_drift, SCHEMA_DRIFT_SQL),
    "schema_drift_repeated_header": (schema_drift_repeated_header, SCHEMA_DRIFT_REPEATED_SQL),
}
