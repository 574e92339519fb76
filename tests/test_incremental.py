import os
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from basketflow.errors import EmptyInput
from basketflow.functions.quantity import INTEGER_PATTERN
from basketflow.operators.aggregate import basket_totals
from basketflow.plans.highwater import HighWaterAggregation
from basketflow.queries.arrivals import COLUMNS, LATE_DAY, Arrivals
from basketflow.queries.inputs import EVENT_IDS, event_baskets
from basketflow.sources.baskets import ARRIVAL_DAY
from basketflow.streaming.incremental import IncrementalAggregation, age_in_ms
from basketflow.streaming.stateful import StatefulTotals
from support import around_cells, rows

SF = "/root/testdata/sf0.001"
HEADER = "order_id,user_id,order_dow,order_hour_of_day,fruit,bread\n"
IDS = ["order_id", "user_id", "order_dow", "order_hour_of_day"]


def job_on(spark, root, **options):
    return IncrementalAggregation(
        spark, f"{root}/landing", f"{root}/state", IDS, HEADER.strip().split(","), **options
    )


def test_any_arrival_order_equals_the_full_aggregate(spark):
    arrivals = Arrivals(spark, SF, "order")
    job = IncrementalAggregation(spark, arrivals.landing, arrivals.state, EVENT_IDS, COLUMNS)
    batches = []
    for days in LATE_DAY:
        arrivals.arrive(days)
        batches.append(job.run_available())
    assert batches == [[0], [1], [2], [], [3]]
    assert rows(job.totals()) == rows(basket_totals(event_baskets(spark, SF), EVENT_IDS))
    assert job.pending_days().count() == 0


def test_replayed_batch_does_not_count_twice(spark, folder):
    root = folder(landing__0__a=HEADER + "1,1,0,5,2,\n")
    job = job_on(spark, root)
    job.run_available()
    before = rows(job.totals())
    batch = spark.read.option("header", True).csv(f"{root}/landing/0").withColumn(ARRIVAL_DAY, F.lit(0))
    job.apply_batch(batch, 0)
    job.apply_batch(batch, 0)
    assert rows(job.totals()) == before == [(0, 5, "fruit", 2)]
    assert rows(job.processed_days()) == [(0, 0)]


def test_second_file_for_a_day_and_second_week(spark, folder):
    root = folder(landing__0__a=HEADER + "1,1,0,5,2,\n")
    job = job_on(spark, root)
    job.run_available()
    folder(landing__0__b=HEADER + "2,1,0,5,3,1\n", landing__7__a=HEADER + "3,1,0,5,10,\n")
    job.run_available()
    assert rows(job.totals()) == [(0, 5, "bread", 1), (0, 5, "fruit", 15)]
    assert rows(job.processed_days()) == [(0, 0), (7, 1)]


def test_day_without_positive_items_is_processed(spark, folder):
    root = folder(landing__0__a=HEADER + "1,1,0,5,0,\n", landing__1__a=HEADER)
    job = job_on(spark, root)
    assert job.run_available() == [0]
    assert job.totals().count() == 0
    assert rows(job.processed_days()) == [(0, 0), (1, 0)]
    assert job.pending_days().count() == 0
    assert job.run_available() == []


def test_failed_run_is_retried(spark, folder):
    root = folder(landing__0__a=HEADER + "1,1,0,5,2,\n", landing__1__bad="wrong,header\n1,2\n")
    job = job_on(spark, root)
    with pytest.raises(StreamingQueryException):
        job.run_available()
    assert [r.status for r in job.run_log().collect()] == ["failed"]
    assert job.totals().count() == 0
    folder(landing__1__bad=HEADER + "2,1,1,5,2,\n")
    assert job.run_available() == [0]
    assert rows(job.totals()) == [(0, 5, "fruit", 2), (1, 5, "fruit", 2)]


def test_nothing_to_do_is_logged(spark, folder):
    root = folder(landing__0__a=HEADER + "1,1,0,5,2,\n")
    job = job_on(spark, root)
    job.run_available()
    assert job.run_available() == []
    assert sorted(r.status for r in job.run_log().collect()) == ["done", "idle"]


def test_landing_must_exist(spark, tmp_path):
    with pytest.raises(EmptyInput):
        job_on(spark, str(tmp_path)).run_available()


def test_reset_starts_over_without_double_counting(spark, folder):
    root = folder(landing__0__a=HEADER + "1,1,0,5,2,\n")
    job = job_on(spark, root)
    job.run_available()
    folder(landing__1__a=HEADER + "1,1,1,5,2,\n")
    job.reset()
    assert job.totals().count() == 0 and job.processed_days().count() == 0
    assert job.run_available() == [0]
    assert rows(job.totals()) == [(0, 5, "fruit", 2), (1, 5, "fruit", 2)]


def test_bounded_batches(spark, folder):
    root = folder(**{f"landing__{d}__a": HEADER + f"1,1,{d},5,2,\n" for d in range(5)})
    job = job_on(spark, root, max_files_per_trigger=2)
    assert job.run_available() == [0, 1, 2]
    assert job.totals().count() == 5


def test_periodic_trigger(spark, folder):
    root = folder(landing__0__a=HEADER + "1,1,0,5,2,\n")
    job = job_on(spark, root)
    query = job.run_every("1 seconds")
    try:
        query.processAllAvailable()
        assert rows(job.totals()) == [(0, 5, "fruit", 2)]
        folder(landing__1__a=HEADER + "1,1,1,5,2,\n")
        query.processAllAvailable()
        assert job.totals().count() == 2
    finally:
        query.stop()
        query.awaitTermination(30)


def test_the_periodic_job_notes_quiet_days_and_idle_triggers(spark, folder):
    import time

    spark.conf.set("spark.sql.streaming.noDataProgressEventInterval", "500")
    root = folder(landing__0__a=HEADER + "1,1,0,5,2,\n", landing__4__a=HEADER)
    job = job_on(spark, root)
    query = job.run_every("200 milliseconds")
    try:
        query.processAllAvailable()
        until = time.time() + 60
        while time.time() < until and (rows(job.pending_days()) or "idle" not in [r.status for r in job.run_log().collect()]):
            time.sleep(0.5)
        assert [r.day for r in job.processed_days().orderBy("day").collect()] == [0, 4]
        assert rows(job.pending_days()) == []
        assert {r.status for r in job.run_log().collect()} >= {"done", "idle"}
    finally:
        spark.conf.unset("spark.sql.streaming.noDataProgressEventInterval")
        query.stop()
        query.awaitTermination(30)


def test_a_failure_between_batches_is_noted(spark, folder):
    import time

    root = folder(landing__0__a=HEADER + "1,1,0,5,2,\n", landing__1__a=HEADER.replace("fruit,bread", "bread,fruit") + "1,1,1,5,2,\n")
    job = job_on(spark, root)
    query = job.run_every("200 milliseconds")
    with pytest.raises(Exception, match="header does not conform"):
        query.awaitTermination(60)
    until = time.time() + 20
    while time.time() < until and "failed" not in [r.status for r in job.run_log().collect()]:
        time.sleep(0.5)
    assert [r.status for r in job.run_log().collect()].count("failed") == 1


def test_drifting_columns_in_the_stream(spark, folder):
    root = folder(landing__0__a=HEADER + "1,1,0,5,2,\n")
    job = IncrementalAggregation(spark, f"{root}/landing", f"{root}/state", IDS)
    job.run_available()
    folder(landing__1__a="tea,order_dow,order_hour_of_day,user_id,order_id,fruit\n4,0,5,1,1,3\n")
    job.run_available()
    assert rows(job.totals()) == [(0, 5, "fruit", 5), (0, 5, "tea", 4)]
    assert rows(job.processed_days()) == [(0, 0), (1, 1)]


def test_a_drifting_stream_makes_its_keys_once_a_line(spark, folder):
    root = folder(landing__0__a=HEADER + "1,1,0,5,2,\n")
    job = IncrementalAggregation(spark, f"{root}/landing", f"{root}/state", IDS)
    above, below = around_cells(job._ledger_of(job._rows(spark.read, f"{root}/landing/*/*.csv"), 0))
    for once_a_line in (INTEGER_PATTERN, "array_position", "from_csv"):
        assert once_a_line in below and once_a_line not in above


def test_highwater_leaves_late_days_out(spark, folder):
    root = folder(landing__0__a=HEADER + "1,1,0,5,2,\n", landing__3__a=HEADER + "1,1,3,5,2,\n")
    job = HighWaterAggregation(spark, f"{root}/landing", f"{root}/state", IDS)
    assert job.mark() == -1
    assert job.run() == [0, 3] and job.mark() == 3
    folder(landing__2__a=HEADER + "1,1,2,5,2,\n", landing__5__a=HEADER + "1,1,5,5,2,\n")
    assert job.run() == [5] and job.run() == []
    assert rows(job.skipped_days()) == [(2,)]
    assert [r[0] for r in rows(job.totals())] == [0, 3, 5]
    assert sorted(r.status for r in job.run_log().collect()) == ["done", "done", "idle"]


def test_late_file_with_an_old_timestamp(spark, folder):
    root = folder(landing__3__a=HEADER + "1,1,3,5,2,\n")
    job = job_on(spark, root)
    job.run_available()
    folder(landing__2__a=HEADER + "1,1,2,5,2,\n")
    old = time.time() - 30 * 86400
    os.utime(f"{root}/landing/2/a.csv", (old, old))
    assert job.run_available() == [1]
    assert [r[0] for r in rows(job.totals())] == [2, 3]


def test_compaction_on_the_way(spark, folder):
    root = folder()
    job = job_on(spark, root, compact_every=2)
    for day in range(5):
        folder(**{f"landing__{day}__a": HEADER + f"1,1,0,5,{day + 1},\n"})
        job.run_available()
    assert job.partials.base() == 3
    assert job.partials.batches() == [2, 3, 4]
    job.partials.vacuum()
    assert job.partials.batches() == [4]
    assert rows(job.totals()) == [(0, 5, "fruit", 15)]
    assert rows(job.processed_days()) == [(d, d) for d in range(5)]


def test_everything_left_out_is_listed(spark, folder):
    lines = ["1,1,0,5,2,oops", "2,1,9,5,1,0", "3,1,x,5,1,", "4,1,0", "5,1,1,5,,", "6,1,2,late,3,3"]
    root = folder(landing__0__a=HEADER + "\n".join(lines) + "\n", landing__3__a=HEADER + "7,1,3,5,1,\n")
    want = [
        ("0", "5", "bread", "oops", "items_not_numeric", 1),
        ("2", "late", "bread", "3", "order_hour_not_integer", 1),
        ("2", "late", "fruit", "3", "order_hour_not_integer", 1),
        ("9", "5", "bread", "0", "order_dow_out_of_range", 1),
        ("9", "5", "fruit", "1", "order_dow_out_of_range", 1),
        ("x", "5", "fruit", "1", "order_dow_not_integer", 1),
        (None, None, None, "4,1,0", "malformed_line", 1),
    ]
    jobs = [job_on(spark, root), HighWaterAggregation(spark, f"{root}/landing", f"{root}/strict", IDS)]
    jobs.append(IncrementalAggregation(spark, f"{root}/landing", f"{root}/drift", IDS))
    for job in jobs:
        job.run_available() if isinstance(job, IncrementalAggregation) else job.run()
        assert rows(job.quarantine()) == sorted(want, key=repr)
        assert rows(job.totals()) == [(0, 5, "fruit", 2), (3, 5, "fruit", 1)]
        assert sorted(r.day for r in job.processed_days().collect()) == [0, 3]


def test_a_category_called_day(spark, folder):
    header = HEADER.replace("bread", "day")
    root = folder(landing__0__a=header + "1,1,0,5,2,7\n")
    for columns in (header.strip().split(","), None):
        job = IncrementalAggregation(spark, f"{root}/landing", f"{root}/state-{columns is None}", IDS, columns)
        job.run_available()
        assert rows(job.totals()) == [(0, 5, "day", 7), (0, 5, "fruit", 2)]


def test_days_are_noted_whatever_the_compaction(spark, folder):
    root = folder()
    job = job_on(spark, root, compact_every=1)
    folder(landing__0__a=HEADER + "1,1,0,5,2,\n", landing__1__a=HEADER + "1,1,1,5,0,\n", landing__2__a=HEADER)
    job.run_available()
    folder(landing__3__a=HEADER + "1,1,3,5,2,\n", landing__1__b=HEADER + "1,1,1,5,4,\n")
    job.run_available()
    job.compact()
    assert rows(job.processed_days()) == [(0, 0), (1, 0), (2, 0), (3, 1)]
    assert job.pending_days().count() == 0
    assert rows(job.totals()) == [(0, 5, "fruit", 2), (1, 5, "fruit", 4), (3, 5, "fruit", 2)]


def test_periodic_runs_note_days_without_sums(spark, folder):
    root = folder(landing__0__a=HEADER + "1,1,0,5,0,\n")
    job = job_on(spark, root)
    query = job.run_every("1 seconds")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
        query.awaitTermination(30)
    assert rows(job.processed_days()) == [(0, 0)] and job.pending_days().count() == 0


def test_an_empty_file_does_not_stop_a_drifting_stream(spark, folder):
    root = folder(landing__0__a="", landing__1__a=HEADER + "1,1,1,5,2,\n")
    job = IncrementalAggregation(spark, f"{root}/landing", f"{root}/state", IDS)
    assert job.run_available() == [0]
    folder(landing__2__a="")
    job.run_available()
    assert rows(job.totals()) == [(1, 5, "fruit", 2)]


def test_processed_files_can_be_archived(spark, folder, tmp_path):
    root = folder(landing__0__a=HEADER + "1,1,0,5,2,\n")
    job = job_on(spark, root, archive=str(tmp_path / "archive"))
    job.run_available()
    for day in (1, 2):
        folder(**{f"landing__{day}__a": HEADER + f"1,1,{day},5,2,\n"})
        job.run_available()
    assert rows(job.totals()) == [(d, 5, "fruit", 2) for d in range(3)]


def test_highwater_state_can_be_reset_and_read_like_the_other(spark, folder):
    from basketflow.plans.state import AggregationState

    root = folder(landing__3__a=HEADER + "1,1,3,5,2,\n")
    job = HighWaterAggregation(spark, f"{root}/landing", f"{root}/state", IDS)
    job.run()
    assert rows(AggregationState(spark, f"{root}/state").totals()) == [(3, 5, "fruit", 2)]
    job.reset()
    assert job.mark() == -1 and job.run() == [3]
    job.compact()
    assert job.mark() == 3 and job.run() == []


def test_lines_without_a_header_are_rejects_of_a_drifting_stream(spark, folder):
    wrong = "order_id,user_id,Order_Dow,order_hour_of_day,fruit\n1,1,0,5,2\n\n2,1,0,5,3\n"
    root = folder(landing__0__a=HEADER + "1,1,0,5,2,\n1,1\n", landing__0__b="9,9\n")
    job = IncrementalAggregation(spark, f"{root}/landing", f"{root}/state", IDS)
    job.run_available()
    # A batch in which no file has a header.
    folder(landing__1__a=wrong)
    job.run_available()
    assert rows(job.totals()) == [(0, 5, "fruit", 2)]
    assert rows(job.processed_days()) == [(0, 0), (1, 1)]
    assert rows(job.quarantine().select("items", "reason", "cells")) == [
        ("1,1", "malformed_line", 1),
        ("1,1,0,5,2", "header_missing", 1),
        ("2,1,0,5,3", "header_missing", 1),
        ("9,9", "header_missing", 1),
        ("order_id,user_id,Order_Dow,order_hour_of_day,fruit", "header_missing", 1),
    ]


@pytest.mark.parametrize("drift", [False, True])
def test_files_are_forgotten_after_an_hour_and_counted_once(spark, folder, drift):
    def touch(day, seconds, name="a"):
        os.utime(f"{root}/landing/{day}/{name}.csv", (seconds, seconds))

    now = time.time()
    columns = None if drift else HEADER.strip().split(",")
    root = folder(landing__0__a=HEADER + "1,1,0,5,2,\n", landing__1__a=HEADER + "1,1,1,5,3,\n1,1\n")
    touch(0, now - 5 * 86400)
    job = IncrementalAggregation(spark, f"{root}/landing", f"{root}/state", IDS, columns, max_file_age="1h", compact_every=2)
    assert job.run_available() == [0]
    before = job.version()
    # Older than the bound: one of a new day, a second one of day 0, one of rejects alone, one without lines.
    folder(
        landing__2__a=HEADER + "1,1,2,5,4,\n", landing__0__odd=HEADER + "1,1,0,5,10,\n",
        landing__3__a=HEADER + "1,1\n", landing__4__a=HEADER,
    )
    for day, name in ((2, "a"), (0, "odd"), (3, "a"), (4, "a")):
        touch(day, now - 86400, name)
    assert job.run_available() == [] and job.version() != before
    want = [(0, 5, "fruit", 12), (1, 5, "fruit", 3), (2, 5, "fruit", 4)]
    assert rows(job.totals()) == want
    assert [r.day for r in job.processed_days().orderBy("day").collect()] == [0, 1, 2, 3, 4]
    bad = [(None, None, None, "1,1", "malformed_line", 2)]
    assert rows(job.quarantine()) == bad
    assert job.files().count() == 6
    version = job.version()
    assert job.run_available() == [] and job.version() == version
    # Counted, forgotten, and now with a new time, beside a new file.
    for day, name in ((0, "a"), (2, "a"), (0, "odd"), (3, "a")):
        touch(day, now + 60, name)
    folder(landing__5__a=HEADER + "1,1,5,5,1,\n")
    touch(5, now + 61)
    assert job.run_available() == [1]
    for _ in range(2):
        job.compact()
        assert rows(job.totals()) == [*want, (5, 5, "fruit", 1)]
        assert rows(job.quarantine()) == bad and job.files().count() == 7
    # The batch again, as after a failure.
    batch = job._rows(job._options(spark.read), f"{root}/landing/5/a.csv")
    job.apply_batch(batch, 1)
    assert rows(job.totals()) == [*want, (5, 5, "fruit", 1)]


def test_late_files_begun_and_not_finished_are_counted_once(spark, folder):
    root = folder(landing__0__a=HEADER + "1,1,0,5,2,\n")
    job = job_on(spark, root, max_file_age="1h")
    job.run_available()
    folder(landing__1__a=HEADER + "1,1,1,5,3,\n")
    old = time.time() - 86400
    os.utime(f"{root}/landing/1/a.csv", (old, old))
    # What a run that was lost before it noted its files leaves.
    job._partials(0, "late/").write(0, job._ledger_of(job._rows(job._options(spark.read), f"{root}/landing/1"), 0))
    job.compact()
    assert rows(job.totals()) == [(0, 5, "fruit", 2)]
    job.run_available()
    job.compact()
    assert rows(job.totals()) == [(0, 5, "fruit", 2), (1, 5, "fruit", 3)]


def test_ages():
    assert [age_in_ms(a) for a in ("90s", "2m", "1h", "7d")] == [90_000, 120_000, 3_600_000, 604_800_000]
    with pytest.raises(ValueError):
        age_in_ms("soon")


def test_running_totals_have_one_state_row_per_key(spark, folder):
    header = HEADER.strip().split(",")
    root = folder(landing__0__a=HEADER + "1,1,0,5,2,1\n2,1,0,5,3,\n3,1\n", landing__1__a=HEADER + "1,1,1,5,0.5,x\n")
    job = StatefulTotals(spark, f"{root}/landing", f"{root}/state", IDS, header, compact_every=2)
    job.run_available()
    folder(landing__0__b=HEADER + "4,1,0,5,10,\n5,1,2,5,1.5,\n")
    job.run_available()
    folder(landing__2__b=HEADER + "4,1,2,5,1.5,\n")
    for _ in range(2):
        job.run_available()
    want = [(0, 5, "bread", 1), (0, 5, "fruit", 15), (2, 5, "fruit", 3)]
    assert rows(job.totals()) == want
    # The last batch again.
    for name in ("2", ".2.crc"):
        os.remove(f"{job.checkpoint}/commits/{name}")
    job.run_available()
    assert rows(job.totals()) == want
    assert job.table.base() == 1 and job.table.batches() == [0, 1, 2]
    states = spark.read.format("statestore").load(job.checkpoint)
    assert states.count() == states.select("key").distinct().count() == 3
    with pytest.raises(EmptyInput):
        StatefulTotals(spark, f"{root}/none", f"{root}/other", IDS, header).run_available()
