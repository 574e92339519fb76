import random

import pytest
from pyspark.sql import functions as F

from basketflow.errors import MalformedBaskets
from basketflow.functions.keys import KEYS, hash_bucket, join_key, split_key
from basketflow.operators.aggregate import (
    basket_partials,
    basket_totals,
    basket_totals_by_column,
    finish_totals,
    merge_partials,
)
from basketflow.operators.quality import quarantined_baskets, quarantined_cells
from basketflow.operators.reshape import category_columns, melt_baskets, valid_keys
from basketflow.operators.sampling import hash_split
from support import rows

IDS = ["order_id", "user_id", "order_dow", "order_hour_of_day"]


def wide(spark, seed=1, baskets=200, categories=("fresh fruits", "it's", "a:b", "x.y", "tick`ed", 'say "hi"')):
    rng = random.Random(seed)
    data = [
        (str(i), str(i % 9), str(rng.randrange(7)), str(rng.randrange(24)))
        + tuple(rng.choice([None, "0", "1", "2", "1.7", "junk", " 3 "]) for _ in categories)
        for i in range(baskets)
    ]
    schema = ", ".join(f"{c} string" for c in IDS)
    schema += "".join(f", `{c.replace('`', '``')}` string" for c in categories)
    return spark.createDataFrame(data, schema)


def test_category_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, order_dow int, b int")
    assert category_columns(df, ["order_dow"]) == ["a", "b"]
    with pytest.raises(MalformedBaskets):
        category_columns(df, ["missing"])
    with pytest.raises(MalformedBaskets):
        category_columns(df, df.columns)


def test_melt_equals_unpivot(spark):
    df = wide(spark)
    quoted = ["`" + c.replace("`", "``") + "`" for c in df.columns[4:]]
    want = df.unpivot(["order_dow", "order_hour_of_day"], quoted, "category", "items")
    assert rows(melt_baskets(df, IDS)) == rows(want)


def test_melt_keeps_wide_work_out_of_the_explode(spark):
    df = spark.createDataFrame([(0, 0, *range(120))], ["order_dow", "order_hour_of_day", *[f"c{i}" for i in range(120)]])
    melted = melt_baskets(df, ["order_dow", "order_hour_of_day"])
    plan = melted._jdf.queryExecution().executedPlan().toString()
    generate = next(line for line in plan.splitlines() if "Generate" in line)
    assert "posexplode(_cells" in generate
    assert melted.count() == 120


def test_aggregate_before_melt_gives_the_same(spark):
    df = wide(spark)
    assert rows(basket_totals(df, IDS)) == rows(basket_totals_by_column(df, IDS))


def test_totals_against_python(spark):
    df = wide(spark)
    want = {}
    value = {"1": 1, "2": 2, "1.7": 1.7, " 3 ": 3}
    for r in df.collect():
        for c in df.columns[4:]:
            if r[c] in value:
                key = (int(r.order_dow), int(r.order_hour_of_day), c)
                want[key] = want.get(key, 0) + value[r[c]]
    got = {tuple(r)[:3]: r["items"] for r in basket_totals(df, IDS).collect()}
    assert got == {k: int(v + 1e-9) for k, v in want.items()}


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_any_batching_merges_to_the_full_aggregate(spark, parts):
    df = wide(spark, seed=parts)
    batches = [basket_partials(df.filter(F.col("order_id") % parts == i), IDS) for i in range(parts)]
    united = batches[0]
    for batch in batches[1:]:
        united = united.unionByName(batch)
    assert rows(finish_totals(merge_partials(united))) == rows(basket_totals(df, IDS))


def test_invalid_keys_are_left_out_and_listed(spark):
    data = [
        ("0", "1", "5", "2"),
        ("08", "1", "5", "2"),
        ("x", "1", "5", "2"),
        (None, "1", "5", "2"),
        ("3", "late", "5", "2"),
        ("3", None, "5", "2"),
        ("3", "4", "abc", "9" * 39),
        ("3", "4", "-1", ""),
    ]
    df = spark.createDataFrame(data, "order_dow string, order_hour_of_day string, a string, b string")
    assert valid_keys(df).count() == 3
    ids = ["order_dow", "order_hour_of_day"]
    assert rows(basket_totals(df, ids)) == [(0, 1, "a", 5), (0, 1, "b", 2)]
    per_basket = [(r.order_dow, r.reason) for r in quarantined_baskets(df).collect()]
    assert per_basket == [
        ("08", "order_dow_out_of_range"),
        ("x", "order_dow_not_integer"),
        (None, "order_dow_missing"),
        ("3", "order_hour_not_integer"),
        ("3", "order_hour_missing"),
    ]
    cells = quarantined_cells(df, ids)
    bad_items = cells.filter("reason like 'items%'").select("category", "items", "reason")
    assert rows(bad_items) == [
        ("a", "abc", "items_not_numeric"),
        ("b", "9" * 39, "items_too_large"),
    ]
    assert cells.filter("reason like 'order%'").count() == 10


def test_keys_round_trip(spark):
    data = [(3, 8, "frozen meals"), (0, 23, "a:b:c"), (6, 0, "")]
    df = spark.createDataFrame(data, "order_dow int, order_hour_of_day int, category string")
    keys = df.select(join_key().alias("key"))
    assert rows(keys.select(*split_key(F.col("key")))) == rows(df)


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.createDataFrame(
        [(d, h, f"c{c}", 1) for d in range(7) for h in range(24) for c in range(6)],
        "order_dow int, order_hour_of_day int, category string, items int",
    )
    train, test = hash_split(df)
    assert rows(train.union(test)) == rows(df)
    assert train.join(test, [*KEYS]).count() == 0
    assert 0.07 < test.count() / df.count() < 0.13
    assert rows(hash_split(df.repartition(7, "category"))[1]) == rows(test)
    assert rows(hash_split(df, seed=7)[1]) != rows(test)


def test_hash_bucket_is_spread(spark):
    df = spark.range(10000).select(F.col("id").alias("k"))
    counts = df.select(hash_bucket(["k"], 10).alias("b")).groupBy("b").count().collect()
    assert len(counts) == 10 and all(850 < r["count"] < 1150 for r in counts)
