import os
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from basketflow.errors import EmptyInput
from basketflow.functions.quantity import INTEGER_PATTERN
from basketflow.operators.aggregate import basket_totals, facts_ledger, total_items
from basketflow.operators.quality import quarantined_baskets
from basketflow.operators.reshape import valid_keys
from basketflow.plans.aggregation import full_aggregation, split_orders
from basketflow.queries.aggregation import schema_drift_repeated_header
from basketflow.session import working_dir
from basketflow.sinks.csv import export_csv, write_day_folders
from basketflow.sinks.keyvalue import write_keyvalue
from basketflow.sinks.runlog import append_run, read_run_log
from basketflow.sources import files
from basketflow.sources.baskets import (
    ARRIVAL_DAY,
    MALFORMED,
    available_days,
    melt_drifting_files,
    read_csv,
    read_days,
    text_schema,
    union_days,
)
from basketflow.sources.tables import BatchTable
from support import around_cells, rows

HEADER = "order_id,user_id,order_dow,order_hour_of_day,fruit,bread\n"
IDS = ["order_id", "user_id", "order_dow", "order_hour_of_day"]


def test_first_day_missing(spark, folder):
    root = folder(**{"1__a": HEADER + "1,1,1,5,2,\n", "day=2__b": HEADER + "2,1,2,6,,3\n"})
    assert available_days(spark, root) == [1, 2]
    got = read_days(spark, root, range(7))
    assert rows(got.select("order_id", ARRIVAL_DAY)) == [("1", 1), ("2", 2)]


def test_no_day_at_all(spark, folder):
    root = folder()
    assert available_days(spark, root) == []
    with pytest.raises(EmptyInput):
        read_days(spark, root, [0, 1], text_schema(["a"]))
    with pytest.raises(EmptyInput):
        read_days(spark, root, [0, 1])
    with pytest.raises(EmptyInput):
        read_days(spark, root, [])
    with pytest.raises(EmptyInput):
        full_aggregation(spark, root, f"{root}/out")
    with pytest.raises(EmptyInput):
        union_days([])


def test_header_only_day(spark, folder):
    root = folder(**{"0__a": HEADER, "1__a": HEADER + "1,1,1,5,2,\n"})
    assert read_days(spark, root, [0, 1]).count() == 1
    assert read_days(spark, root, [0]).count() == 0


def test_reordered_header_fails_instead_of_swapping(spark, folder):
    root = folder(**{"0__a": HEADER + "1,1,0,5,2,\n", "1__a": HEADER.replace("fruit,bread", "bread,fruit") + "1,1,1,5,2,\n"})
    with pytest.raises(Exception, match="header does not conform"):
        read_days(spark, root, [0, 1], text_schema(HEADER.strip().split(","))).collect()


def test_malformed_lines_are_kept_apart(spark, folder):
    root = folder(orders=HEADER + "1,1,1,5,2,\n2,1,1\n3,1,1,5,2,1,9,9\n")
    df = read_csv(spark, f"{root}/orders.csv", keep_malformed=True)
    bad = quarantined_baskets(df, malformed=MALFORMED)
    assert rows(bad.select(MALFORMED, "reason")) == [
        ("2,1,1", "malformed_line"),
        ("3,1,1,5,2,1,9,9", "malformed_line"),
    ]


def test_drifting_headers(spark, folder):
    root = folder(
        a='order_id,user_id,order_dow,order_hour_of_day,"it\'s, new",fresh fruits\n1,1,0,5,2,3\n1,1,0,5,,4\n',
        b="order_hour_of_day,fresh fruits,order_dow,user_id,order_id,a:b\n5,10,0,1,1,7\n",
    )
    facts = melt_drifting_files(spark, f"{root}/*.csv", IDS)
    assert set(rows(total_items(valid_keys(facts)))) == {
        (0, 5, "a:b", 7),
        (0, 5, "fresh fruits", 17),
        (0, 5, "it's, new", 2),
    }
    with pytest.raises(EmptyInput):
        melt_drifting_files(spark, f"{root}/nothing/*.csv", IDS)


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(4, 3)], "y int, x int")
    c = spark.createDataFrame([(5,)], "x int")
    assert rows(union_days([a, b, c])) == [(1, 2), (3, 4), (5, None)]


def test_export_is_one_file_even_when_empty(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(100).repartition(5).select("id", F.lit("a,b").alias("text"))
    for frame, lines in ((df, 101), (df.limit(0), 1)):
        export_csv(frame, path, single_file=True)
        parts = [p for p in os.listdir(path) if p.endswith(".csv")]
        assert len(parts) == 1
        assert len(open(f"{path}/{parts[0]}").read().splitlines()) == lines


@pytest.mark.parametrize("rebalance", [False, True])
def test_day_folders_keep_all_columns(spark, tmp_path, rebalance):
    df = spark.createDataFrame(
        [(str(i), "1", str(i % 9), "5", "2", None) for i in range(90)],
        ", ".join(f"{c} string" for c in HEADER.strip().split(",")),
    )
    path = str(tmp_path / "days")
    write_day_folders(df, path, rebalance=rebalance)
    assert available_days(spark, path) == list(range(7))
    back = read_days(spark, path, range(7))
    assert rows(back.drop(ARRIVAL_DAY)) == rows(df.filter("order_dow < 7"))
    assert back.filter(f"{ARRIVAL_DAY} <> order_dow").count() == 0


def test_split_then_full_aggregation(spark, folder):
    root = folder(
        orders=HEADER + "1,1,0,5,2,\n2,1,0,5,3,1\n3,1,6,23,,4\n4,1,9,2,7,7\n5,1,,2,7,7\n6,1,0,5,oops,1\n"
    )
    split_orders(spark, f"{root}/orders.csv", f"{root}/raw", quarantine=f"{root}/bad")
    assert spark.read.parquet(f"{root}/bad").count() == 2
    totals = full_aggregation(
        spark, f"{root}/raw", f"{root}/agg", csv_output=f"{root}/csv", quarantine=f"{root}/bad_cells"
    )
    want = [(0, 5, "bread", 2), (0, 5, "fruit", 5), (6, 23, "bread", 4)]
    assert rows(totals) == want
    assert rows(read_csv(spark, f"{root}/csv/*.csv")) == [tuple(map(str, r)) for r in want]
    assert rows(spark.read.parquet(f"{root}/bad_cells").select("items", "reason", "cells")) == [
        ("oops", "items_not_numeric", 1)
    ]
    assert rows(basket_totals(read_csv(spark, f"{root}/orders.csv"), IDS)) == want


def test_batch_table(spark, tmp_path):
    frame = lambda *values: spark.createDataFrame([(v,) for v in values], "v int")
    table = BatchTable(
        spark, str(tmp_path / "t"), frame(1).schema, lambda df: df.agg(F.sum("v").cast("int").alias("v"))
    )
    assert table.rows().count() == 0 and table.batches() == [] and table.base() == -1
    table.write(0, frame(1, 2))
    table.write(1, frame(10))
    table.write(1, frame(20))
    assert table.read().first()[0] == 23
    assert table.compact() == 1
    assert table.base() == 1 and rows(table.rows()) == [(23,)]
    table.write(2, frame(100))
    assert table.read().first()[0] == 123
    table.vacuum()
    assert table.batches() == [2] and table.read().first()[0] == 123
    table.compact()
    table.vacuum()
    assert table.batches() == [] and table.read().first()[0] == 123
    assert table.compact() == -1 and table.read().first()[0] == 123


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "log")
    assert read_run_log(spark, path).count() == 0
    append_run(spark, path, "full", "done", 3, [1, 2], 7, "out")
    append_run(spark, path, "full", "idle")
    log = read_run_log(spark, path)
    assert rows(log.select("job", "status", "batch_id", "days", "rows", "output")) == [
        ("full", "done", 3, [1, 2], 7, "out"),
        ("full", "idle", None, None, None, None),
    ]
    assert log.filter("ts is null or run_id is null").count() == 0


def test_keyvalue_sink(spark, tmp_path, monkeypatch):
    (tmp_path / "filestore.py").write_text(
        "import json, uuid\n"
        "class Client:\n"
        "    def __init__(self, options): self.path = options['folder'] + '/' + uuid.uuid4().hex + '.json'\n"
        "    def set_many(self, pairs):\n"
        "        with open(self.path, 'a') as f: f.write(json.dumps(pairs) + chr(10))\n"
        "    def close(self): pass\n"
    )
    store = tmp_path / "store"
    store.mkdir()
    spark.sparkContext.addPyFile(str(tmp_path / "filestore.py"))
    cache = spark.range(25).select(
        F.concat_ws(":", F.lit("0:1"), "id").alias("key"), (F.col("id") * 2).cast("int").alias("prediction")
    )
    write_keyvalue(cache.repartition(3), "filestore:Client", folder=str(store), batchsize="4")
    import json

    pairs, calls = {}, 0
    for name in os.listdir(store):
        for line in open(store / name):
            batch = json.loads(line)
            assert len(batch) <= 4
            pairs.update(batch)
            calls += 1
    assert pairs == {f"0:1:{i}": str(i * 2) for i in range(25)}
    assert calls < 25
    with pytest.raises(PySparkException):
        write_keyvalue(cache, "no_such_module:Client")


def test_folder_store_reads_committed_batches_only(spark, tmp_path):
    from basketflow.sinks.keyvalue import FolderClient, folder_pairs

    store = str(tmp_path / "store")
    cache = spark.createDataFrame([(f"k{i}", i) for i in range(9)], "key string, prediction int")
    write_keyvalue(cache.repartition(3), "folder", folder=store, batchsize="2")
    lost = FolderClient({"folder": store})
    lost.set_many({"k1": "wrong"})
    again = FolderClient({"folder": store})
    again.set_many({"k9": "first try"})
    again.commit("7", again.parts)
    again.parts = []
    again.set_many({"k9": "9"})
    again.commit("7", again.parts)
    assert rows(folder_pairs(spark, store)) == sorted((f"k{i}", str(i)) for i in range(10))
    again.abort(again.parts)
    assert "k9" not in {r.key for r in folder_pairs(spark, store).collect()}
    with pytest.raises(ValueError, match="folder"):
        FolderClient({})


def test_a_failed_stream_to_a_store_commits_nothing(spark, tmp_path):
    from basketflow.sinks.keyvalue import folder_pairs, stream_keyvalue

    schema = "key string, prediction int"
    path, store = str(tmp_path / "rows"), str(tmp_path / "store")
    spark.createDataFrame([("a", 1), ("b", 2)], schema).write.parquet(path)

    def run(rows):
        stream_keyvalue(rows, "folder", str(tmp_path / "checkpoint"), folder=store).trigger(availableNow=True).start().awaitTermination()

    stream = spark.readStream.schema(schema).parquet(path)
    bad = F.when(F.col("key") == "b", F.raise_error(F.lit("no"))).otherwise(F.col("key"))
    with pytest.raises(Exception, match="no"):
        run(stream.withColumn("key", bad))
    assert not os.path.exists(f"{store}/commits")
    run(stream)
    assert rows(folder_pairs(spark, store)) == [("a", "1"), ("b", "2")]


def test_a_category_called_day(spark, folder):
    root = folder(orders=HEADER.replace("fruit", "day") + "1,1,1,5,2,\n2,1,x,5,3,\n3,1,2\n")
    split_orders(spark, f"{root}/orders.csv", f"{root}/raw", quarantine=f"{root}/bad")
    assert available_days(spark, f"{root}/raw") == [1]
    back = read_days(spark, f"{root}/raw", range(7))
    assert rows(back.select("order_id", "day", ARRIVAL_DAY)) == [("1", "2", 1)]
    assert sorted(r.reason for r in spark.read.parquet(f"{root}/bad").collect()) == ["malformed_line", "order_dow_not_integer"]
    totals = full_aggregation(spark, f"{root}/raw", f"{root}/out", IDS)
    assert rows(totals) == [(1, 5, "day", 2)]


def test_listing(spark, folder):
    root = folder(**{"v=1__x": "", "v=2__x": "", "v=zz__x": "", "day=10__x": ""})
    assert files.numbered_dirs(spark, root, prefix="v=") == [1, 2]
    assert files.numbered_dirs(spark, root, prefix="v=", marker="x.csv") == [1, 2]
    assert files.numbered_dirs(spark, root, prefix="v=", marker="y.csv") == []
    assert not files.exists(spark, f"{root}/nothing")


def test_working_dir_follows_the_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = working_dir(spark, "a"), working_dir(spark, "a")
    assert first.startswith(base) and first != second


def test_each_line_goes_to_one_folder_as_it_was(spark, folder):
    lines = ["1,1,0, 05 ,2,", "2,1,0,5", "3,1,0,5,2,1,9", "4,1,x,5,1,1", "5,1,3,late,1,1", "6,1,,5,1,1", '7,1,6,5,"1",2', "8,1,,,,"]
    root = folder(orders=HEADER + "\n".join(lines) + "\n")
    split_orders(spark, f"{root}/orders.csv", f"{root}/raw", quarantine=f"{root}/bad", run_log=f"{root}/log")
    kept = read_days(spark, f"{root}/raw", range(7))
    assert rows(kept.select(*IDS)) == [("1", "1", "0", " 05 "), ("7", "1", "6", "5")]
    bad = spark.read.parquet(f"{root}/bad")
    assert rows(bad.select("order_id", MALFORMED, "reason")) == sorted([
        (None, "2,1,0,5", "malformed_line"), (None, "3,1,0,5,2,1,9", "malformed_line"),
        ("4", None, "order_dow_not_integer"), ("5", None, "order_hour_not_integer"),
        ("6", None, "order_dow_missing"), ("8", None, "order_dow_missing"),
    ], key=repr)
    assert [r.status for r in read_run_log(spark, f"{root}/log").collect()] == ["done"]
    with pytest.raises(EmptyInput):
        split_orders(spark, f"{root}/none.csv", f"{root}/raw2", run_log=f"{root}/log")
    assert sorted(r.status for r in read_run_log(spark, f"{root}/log").collect()) == ["done", "failed"]


def test_day_folders_are_root_paths(spark, folder):
    root = folder(**{f"{d}__{f}": HEADER + f"1,1,{d},5,2,\n" for d in range(3) for f in "abcd"})
    scan = read_days(spark, root, range(3))
    assert scan.count() == 12
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "(3 paths)" in plan or plan.count(f"{root}/") <= 3


def test_typed_keys_are_pushed_down(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("int(id) AS order_dow", "id AS order_hour_of_day", "1 AS a").write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = valid_keys(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    for bound in ("GreaterThanOrEqual(order_dow,0)", "LessThanOrEqual(order_dow,6)", "IsNotNull(order_hour_of_day)"):
        assert bound in plan


def test_drifting_files_without_header_or_rows(spark, folder):
    root = folder(a=HEADER + "1,1,0,5,2,\n", empty="", other="x,y\n1,2\n")
    facts = melt_drifting_files(spark, f"{root}/*.csv", IDS)
    assert rows(total_items(valid_keys(facts))) == [(0, 5, "fruit", 2)]
    assert melt_drifting_files(spark, f"{root}/empty.csv", IDS).count() == 0


def test_lines_of_drifting_files_without_header_are_rejects(spark, folder):
    root = folder(a=HEADER + "1,1,0,5,2,\n", empty="", other="x,y\n1,2\n")
    facts = melt_drifting_files(spark, f"{root}/*.csv", IDS, rejects=True)
    assert rows(facts.filter("fault IS NOT NULL").select("items", "fault")) == [("1,2", "header_missing"), ("x,y", "header_missing")]


def test_a_header_holds_for_the_lines_after_it(spark, folder):
    second = "bread,order_dow,order_hour_of_day,user_id,order_id,tea\n"
    root = folder(
        a="9,9,6,6,9,9\n" + HEADER + "1,1,0,5,2,\n" + HEADER + "2,1,0,5,1,\n" + second + "4,1,7,1,3,\n" + second + "8,1,7,1,4,1\n" + HEADER + "5,1,0,5,10,\n",
        b=second + "1,2,3,1,5,\n",
        c=HEADER + '6,1,0,5,"a, order_id,user_id,order_dow,order_hour_of_day",3\n',
    )
    facts = melt_drifting_files(spark, f"{root}/*.csv", IDS)
    want = [(0, 5, "bread", 3), (0, 5, "fruit", 13), (1, 7, "bread", 12), (1, 7, "tea", 1), (2, 3, "bread", 1)]
    assert rows(total_items(valid_keys(facts))) == want
    whole = melt_drifting_files(spark, f"{root}/*.csv", IDS, rejects=True)
    assert rows(whole.filter("fault IS NOT NULL").select("items", "fault")) == [("9,9,6,6,9,9", "header_missing")]
    # Lines that are no headers are either counted once or rejected once.
    assert whole.filter("fault IS NOT NULL OR category IS NULL").count() == 8


def test_headers_in_files_that_are_read_in_parts(spark, folder):
    """A file of many blocks, with another header in the middle."""
    second = "bread,order_dow,order_hour_of_day,user_id,order_id,tea\n"
    root = folder(a=HEADER + "1,1,0,5,2,\n" * 300 + second + "4,1,7,1,3,\n" * 300)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        facts = melt_drifting_files(spark, f"{root}/*.csv", IDS)
        assert facts.rdd.getNumPartitions() > 4
        assert rows(total_items(valid_keys(facts))) == [(0, 5, "fruit", 600), (1, 7, "bread", 1200)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_keys_of_drifting_files_are_made_once_a_line(spark, folder):
    second = "bread,order_dow,order_hour_of_day,user_id,order_id,tea\n"
    root = folder(a="0,0,\n" + HEADER + '1,1,0,5,2,\n1,1,9,5,"x,y",1\n1,1\n' + second + "4,1,,1,3,\n")
    made = facts_ledger(melt_drifting_files(spark, f"{root}/*.csv", IDS, rejects=True, keyed=True))
    assert rows(made) == rows(facts_ledger(melt_drifting_files(spark, f"{root}/*.csv", IDS, rejects=True)))
    above, below = around_cells(made)
    for once_a_line in (INTEGER_PATTERN, "array_position", "from_csv", "split(value"):
        assert once_a_line in below and once_a_line not in above
    assert below.count("from_csv") == 1


def test_names_in_quotes_make_a_header_however_many_quotes_follow(spark, folder):
    header = '"order_id",user_id,"order_dow",order_hour_of_day,"a ""b"", c"\n'
    root = folder(a=header + "1,1,0,5,2\n" + '1,1,0,5,"order_id"' + '""' * 50_000 + "\n")
    facts = melt_drifting_files(spark, f"{root}/a.csv", IDS, rejects=True)
    assert facts.filter("fault IS NOT NULL").count() == 0 and facts.filter("category IS NULL").count() == 2


def test_text_with_repeated_headers_is_melted_once(spark):
    plan = schema_drift_repeated_header(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert set(re.findall(r"Relation \[.*\] (\w+)", plan)) == {"parquet"}


def test_two_writers_never_share_a_batch(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    frame = spark.createDataFrame([(1,)], "v int")
    table = BatchTable(spark, str(tmp_path / "t"), frame.schema, lambda df: df)
    with ThreadPoolExecutor(4) as pool:
        batches = list(pool.map(lambda _: table.append(frame), range(8)))
    assert sorted(batches) == list(range(8)) and table.rows().count() == 8


def test_run_log_is_folded(spark, tmp_path):
    from basketflow.sinks.runlog import compact_run_log, logged_run

    path = str(tmp_path / "log")
    with pytest.raises(ZeroDivisionError), logged_run(spark, path, "job"):
        1 / 0
    for _ in range(4):
        append_run(spark, path, "job", "idle")
    compact_run_log(spark, path, at_least=3)
    assert sorted(r.status for r in read_run_log(spark, path).collect()) == ["failed", "idle", "idle", "idle", "idle"]
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) == 1
