"""Basket tables derived from the given tables, and the same facts in SQL."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.aggregate import basket_totals

# The event kinds of the given events table.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")

ORDER_IDS = ("o_orderkey", "o_custkey", "order_dow", "order_hour_of_day")
EVENT_IDS = ("event_id", "user_id", "order_dow", "order_hour_of_day")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, one column per brand with the quantity ordered.

    The lines are summed per order, in one exchange, before they meet the orders table: an
    order with a great many lines leaves each task as one row, and the join is unique on
    both sides. ``pivot`` would shuffle the lines twice.
    """
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    brands = [r[0] for r in part.select("p_brand").distinct().orderBy("p_brand").collect()]
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    per_order = (
        lines.join(part, lines.l_partkey == part.p_partkey)
        .groupBy("l_orderkey")
        .agg(
            *[
                F.sum(F.when(F.col("p_brand") == brand, F.col("l_quantity"))).cast("bigint").alias(brand)
                for brand in brands
            ]
        )
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        (F.dayofweek("o_orderdate") - 1).alias("order_dow"),
        (F.col("o_orderkey") % 24).cast("int").alias("order_hour_of_day"),
    )
    return orders.join(per_order, orders.o_orderkey == per_order.l_orderkey).drop("l_orderkey")


def event_baskets(
    spark: SparkSession, sf_dir: str, *extra: Column, events: DataFrame | None = None
) -> DataFrame:
    """One row per event, one column per kind of event; exactly one of them is filled.

    ``extra`` columns of the events table are added at the end.
    """
    events = table(spark, sf_dir, "events") if events is None else events
    amount = F.col("value").cast("int")
    return events.select(
        "event_id",
        "user_id",
        (F.dayofweek("ts") - 1).alias("order_dow"),
        F.hour("ts").alias("order_hour_of_day"),
        *[F.when(F.col("event_type") == kind, amount).alias(kind) for kind in EVENT_TYPES],
        *extra,
    )


def raw_event_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as an untyped export with the usual faults.

    Weekdays count from 1, are text for errors and missing for signups; the hour carries a
    unit for views; amounts have decimals, one column is far too large, one is no number.
    """
    kind = F.col("event_type")
    hour = F.hour("ts").cast("string")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.when(kind == "error", F.col("props"))
        .when(kind != "signup", F.dayofweek("ts").cast("string"))
        .alias("order_dow"),
        F.when(kind == "view", F.concat(hour, F.lit("h"))).otherwise(hour).alias("order_hour_of_day"),
        F.col("value").cast("decimal(12,2)").cast("string").alias("amount"),
        F.concat(F.floor("value").cast("string"), F.lit("00000000000000")).alias("scaled"),
        F.col("props").alias("note"),
    )


def event_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The aggregate table of the event baskets."""
    return basket_totals(event_baskets(spark, sf_dir), EVENT_IDS)


def order_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The aggregate table of the order baskets."""
    return basket_totals(order_baskets(spark, sf_dir), ORDER_IDS)


# --- the same in SQL, never by way of the wide form ---------------------------------

ORDER_FACTS_SQL = """
    SELECT o_orderkey, o_custkey,
           CAST(dayofweek(o_orderdate) AS INTEGER) AS order_dow,
           CAST(o_orderkey % 24 AS INTEGER) AS order_hour_of_day,
           p_brand AS category,
           CAST(trunc(sum(l_quantity)) AS BIGINT) AS items
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN part ON l_partkey = p_partkey
    GROUP BY ALL
"""

ORDER_TOTALS_SQL = f"""
    SELECT order_dow, order_hour_of_day, category, CAST(sum(items) AS BIGINT) AS items
    FROM ({ORDER_FACTS_SQL}) WHERE items > 0
    GROUP BY ALL
"""

EVENT_FACTS_SQL = """
    SELECT event_id, user_id, ts,
           CAST(dayofweek(ts) AS INTEGER) AS order_dow,
           CAST(hour(ts) AS INTEGER) AS order_hour_of_day,
           event_type AS category,
           CAST(trunc(value) AS INTEGER) AS items
    FROM events
"""


def event_totals_sql(where: str = "TRUE") -> str:
    return f"""
    SELECT order_dow, order_hour_of_day, category, CAST(sum(items) AS BIGINT) AS items
    FROM ({EVENT_FACTS_SQL}) WHERE items > 0 AND {where}
    GROUP BY ALL
"""


RAW_FACTS_SQL = """
    SELECT event_id,
           CASE WHEN event_type = 'error' THEN props
                WHEN event_type <> 'signup' THEN CAST(dayofweek(ts) + 1 AS VARCHAR) END AS order_dow,
           CASE WHEN event_type = 'view' THEN hour(ts) || 'h'
                ELSE CAST(hour(ts) AS VARCHAR) END AS order_hour_of_day,
           unnest(['amount', 'scaled', 'note']) AS category,
           unnest([CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR),
                   CAST(floor(value) AS BIGINT) || '00000000000000',
                   props]) AS items
    FROM events
"""


RAW_TOTALS_SQL = f"""
    SELECT order_dow, order_hour_of_day, category, trunc(sum(CAST(items AS DECIMAL(38,2)))) AS total,
           count(*) AS cells
    FROM ({RAW_FACTS_SQL})
    WHERE category <> 'note'
      AND order_dow IN ('0', '1', '2', '3', '4', '5', '6')
      AND regexp_full_match(order_hour_of_day, '[0-9]+')
      AND CAST(items AS DECIMAL(38,2)) >= 1
    GROUP BY ALL
"""


def split_sql(totals: str, split: str, seed: int = 42) -> str:
    """Rows of one side of the 90/10 split of an aggregate table."""
    side = "<" if split == "test" else ">="
    key = f"concat_ws(':', '{seed}', order_dow, order_hour_of_day, category)"
    return f"""
    SELECT * FROM ({totals})
    WHERE CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT) % 1000 {side} 100
"""


