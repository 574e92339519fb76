import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from basketflow.errors import EmptyInput, ModelNotFound
from basketflow.functions.keys import KEYS
from basketflow.operators import serving
from basketflow.operators.forest import forest_nodes, forest_scores
from basketflow.operators.metrics import mean_squared_error, round_prediction
from basketflow.operators.sampling import hash_split
from basketflow.plans.periodic import repeat, seconds
from basketflow.plans.scoring import (
    predict,
    prediction_cache,
    refresh_cache,
    refresh_if_retrained,
    score,
    score_and_cache,
)
from basketflow.plans.training import ForestSettings, fit_forest, train_if_changed, train_model
from basketflow.sinks.runlog import read_run_log
from basketflow.sources.models import ModelStore
from basketflow.streaming.scoring import cache_stream, read_fact_stream
from support import rows

SMALL = ForestSettings(num_trees=5)


@pytest.fixture(scope="module")
def totals(spark):
    data = [
        (d, h, f"c{c}", 10 * c + d + h % 5 + 1) for d in range(7) for h in range(24) for c in range(5)
    ]
    schema = "order_dow int, order_hour_of_day int, category string, items bigint"
    return spark.createDataFrame(data, schema).cache()


@pytest.fixture(scope="module")
def store(spark, totals, tmp_path_factory):
    store = ModelStore(spark, str(tmp_path_factory.mktemp("models") / "m"))
    train_model(spark, totals, store, run_log=f"{store.root}-log")
    return store


def test_training_publishes_a_version(spark, store, totals):
    assert store.current() == 1 and store.versions() == [1]
    metrics = store.metrics().first()
    train, test = hash_split(totals)
    assert (metrics.n_train, metrics.n_test, metrics.n_unseen) == (train.count(), test.count(), 0)
    assert rows(store.split(1, "test")) == rows(test)
    assert read_run_log(spark, f"{store.root}-log").first().status == "done"


def test_mse_equals_the_evaluator(store):
    scored = store.load().transform(store.split(1, "test"))
    evaluator = RegressionEvaluator(labelCol="items", metricName="mse")
    assert mean_squared_error(scored).first()[0] == pytest.approx(evaluator.evaluate(scored), rel=1e-12)
    assert store.metrics().first().mse == pytest.approx(evaluator.evaluate(scored), rel=1e-12)


def test_forest_beats_the_overall_mean(store):
    low, high, mean = store.split(1, "train").agg(F.min("items"), F.max("items"), F.avg("items")).first()
    test = store.split(1, "test")
    scored = store.load().transform(test)
    assert scored.filter(~F.col("prediction").between(low, high)).count() == 0
    flat = mean_squared_error(test.withColumn("prediction", F.lit(mean))).first()[0]
    assert store.metrics().first().mse < flat / 2


def test_the_forest_by_joins_equals_the_model(spark, store):
    model, nodes = store.load(1), forest_nodes(store.nodes(1))
    test = store.split(1, "test")
    unusual = spark.createDataFrame([(3, 4, "new", 1), (3, 4, None, 1), (3, 4, None, 2)], test.schema)
    scored = test.unionByName(unusual)
    want = rows(model.transform(scored).select(*test.columns, "prediction"))
    assert rows(forest_scores(scored, model, nodes).select(*test.columns, "prediction")) == want
    # Not by chance: with other thresholds for weekday and hour the scores differ.
    moved = F.when(F.col("categorical"), F.col("bounds")).otherwise(F.transform("bounds", lambda x: x - 2))
    other = forest_scores(scored, model, nodes.withColumn("bounds", moved))
    assert rows(other.select(*test.columns, "prediction")) != want
    # Rows without an hour, and no rows.
    none = spark.createDataFrame([(3, None, "c1", 1)], test.schema)
    assert rows(forest_scores(none, model, nodes).select("prediction")) == [(None,)]
    assert forest_scores(test.limit(0), model, nodes).count() == 0


def test_model_does_not_depend_on_the_input_layout(totals):
    train, test = hash_split(totals)
    first = predict(fit_forest(train, SMALL), test)
    second = predict(fit_forest(train.repartition(13).orderBy(F.desc("items")), SMALL), test)
    assert rows(first) == rows(second)


def test_unseen_category(totals):
    train, test = hash_split(totals)
    train = train.filter("category <> 'c4'")
    scored = predict(fit_forest(train, SMALL), test)
    assert scored.count() == test.count()
    strict = fit_forest(train, ForestSettings(num_trees=2, strict=True))
    with pytest.raises(Exception, match="Unseen label"):
        strict.transform(test).collect()


def test_unpublished_versions_are_invisible(spark, tmp_path, totals):
    store = ModelStore(spark, str(tmp_path / "m"))
    with pytest.raises(ModelNotFound):
        store.current()
    with pytest.raises(ModelNotFound):
        store.load(1)
    train, _ = hash_split(totals)
    store.save_model(1, fit_forest(train, SMALL))
    with pytest.raises(ModelNotFound):
        store.current()
    assert store.claim_version() == 2


def test_no_rows_to_train_on(spark, tmp_path, totals):
    with pytest.raises(EmptyInput):
        train_model(spark, totals.limit(0), ModelStore(spark, str(tmp_path / "m")))


def test_halves_round_away_from_zero(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-2.5,), (2.4,)], "prediction double")
    assert [r[0] for r in round_prediction(df).collect()] == [1, 2, 3, -3, 2]


def test_score_and_cache(spark, store, tmp_path):
    cache = prediction_cache(spark, str(tmp_path / "cache"))
    predictions = score_and_cache(
        spark, store, str(tmp_path / "out"), cache, csv_output=str(tmp_path / "csv")
    )
    assert predictions.columns == ["order_dow", "order_hour_of_day", "category", "items", "prediction"]
    assert predictions.count() == store.metrics().first().n_test
    assert rows(cache.read().select(*KEYS, "prediction")) == rows(predictions.drop("items"))
    again = score(spark, store, str(tmp_path / "out"))
    assert rows(again) == rows(predictions)


def test_cache_keeps_the_latest_version_per_key(spark, tmp_path):
    cache = prediction_cache(spark, str(tmp_path / "cache"))
    schema = "order_dow int, order_hour_of_day int, category string, prediction int"
    v1 = spark.createDataFrame([(0, 1, "a", 5), (0, 2, "b:c", 6)], schema)
    v2 = spark.createDataFrame([(0, 1, "a", 9)], schema)
    refresh_cache(cache, v1, 1)
    refresh_cache(cache, v2, 2)
    refresh_cache(cache, v2, 2)
    want = [("0:1:a", 0, 1, "a", 9, 2), ("0:2:b:c", 0, 2, "b:c", 6, 1)]
    assert rows(cache.read()) == want
    assert rows(serving.latest_version_only(cache.rows(), 2)) == want[:1]
    cache.compact()
    assert rows(cache.read()) == want
    assert rows(serving.lookup(cache.read(), "0:2:b:c")) == want[1:]
    assert serving.lookup(cache.read(), "6:2:b:c").count() == 0
    assert rows(serving.list_keys(cache.rows())) == [("0:1:a",), ("0:2:b:c",)]


def test_lookup_reads_one_weekday(spark, tmp_path):
    cache = prediction_cache(spark, str(tmp_path / "cache"))
    schema = "order_dow int, order_hour_of_day int, category string, prediction int"
    refresh_cache(cache, spark.createDataFrame([(d, 1, "a", d) for d in range(7)], schema), 1)
    cache.compact()
    found = serving.lookup(cache.read(), "3:1:a")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_dow" in plan
    assert rows(found) == [("3:1:a", 3, 1, "a", 3, 1)]


def test_serving_hits_and_misses(spark):
    schema = "order_dow int, order_hour_of_day int, category string, prediction int"
    cache = spark.createDataFrame([(0, 1, "a", 5)], schema)
    requests = spark.createDataFrame(
        [(1, 0, 1, "a"), (2, 0, 1, "a"), (3, 0, 2, "a"), (4, 0, 2, "a")],
        "request_id int, order_dow int, order_hour_of_day int, category string",
    )
    served = serving.serve(requests, cache)
    assert rows(served.select("request_id", "prediction", "cache_hit")) == [
        (1, 5, True),
        (2, 5, True),
        (3, None, False),
        (4, None, False),
    ]
    assert rows(serving.missing_keys(requests, cache)) == [(0, 2, "a")]
    answered = serving.serve_all(requests, cache, lambda keys: keys.withColumn("prediction", F.lit(7)))
    assert rows(answered.select("request_id", "prediction", "cache_hit")) == [
        (1, 5, True),
        (2, 5, True),
        (3, 7, False),
        (4, 7, False),
    ]


def test_cache_stream_uses_the_current_model(spark, store, tmp_path):
    source, cache = str(tmp_path / "rows"), prediction_cache(spark, str(tmp_path / "cache"))
    store.split(1, "test").write.parquet(source)
    writer = cache_stream(read_fact_stream(spark, source), store, cache, str(tmp_path / "checkpoint"))
    writer.trigger(availableNow=True).start().awaitTermination()
    want = predict(store.load(), store.split(1, "test"))
    assert rows(cache.read().select(*KEYS, "prediction")) == rows(want.drop("items"))


def test_serving_a_hot_key_without_broadcast(spark):
    schema = "order_dow int, order_hour_of_day int, category string, prediction int"
    cache = spark.createDataFrame([(d, h, "a", d * h) for d in range(7) for h in range(24)], schema)
    hot = F.col("id") % 3 == 0
    requests = spark.range(3000).select(
        F.col("id").alias("request_id"),
        F.when(hot, 2).otherwise(F.col("id") % 8).cast("int").alias("order_dow"),
        F.when(hot, 3).otherwise(F.col("id") % 24).cast("int").alias("order_hour_of_day"),
        F.lit("a").alias("category"),
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    want = rows(serving.serve(requests, cache))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        served = serving.serve(requests, cache)
        assert "SortMergeJoin" in served._jdf.queryExecution().executedPlan().toString()
        assert rows(served) == want and len(want) == 3000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_periodic_training_skips_what_is_known(spark, tmp_path, totals):
    store, log = ModelStore(spark, str(tmp_path / "m")), str(tmp_path / "log")
    inputs = [totals, totals.repartition(3).orderBy(F.desc("items")), totals.filter("order_dow < 6")]
    trained = []
    repeat(lambda: trained.append(train_if_changed(spark, inputs[len(trained)], store, SMALL, log)), "0.1 seconds", runs=3)
    assert trained == [1, None, 2]
    assert sorted(r.status for r in read_run_log(spark, log).collect()) == ["done", "done", "idle"]


def test_an_idle_poll_starts_no_job(spark, tmp_path, totals):
    store = ModelStore(spark, str(tmp_path / "m"))
    assert train_if_changed(spark, totals, store, SMALL, state="0/4") == 1

    def jobs_of(poll):
        spark.sparkContext.setJobGroup("poll", "poll")
        try:
            result = poll()
            return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup("poll"))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    unread = totals.withColumn("items", F.raise_error(F.lit("read")).cast("bigint"))
    assert jobs_of(lambda: train_if_changed(spark, unread, store, SMALL, state="0/4")) == (None, 0)
    # A new state with the same totals is read once and then known.
    assert train_if_changed(spark, totals, store, SMALL, state="0/5") is None
    assert jobs_of(lambda: train_if_changed(spark, unread, store, SMALL, state="0/5")) == (None, 0)
    assert train_if_changed(spark, totals.filter("order_dow < 6"), store, SMALL, state="0/6") == 2


def test_scored_rows_are_counted_on_the_way(spark, tmp_path, totals):
    store, log = ModelStore(spark, str(tmp_path / "m")), str(tmp_path / "log")
    train, test = hash_split(totals)
    store.save_model(1, fit_forest(train.filter("category <> 'c4'"), SMALL))
    score(spark, store, str(tmp_path / "out"), test, 1, run_log=log)
    score(spark, store, str(tmp_path / "out"), test.filter("category = 'c4'"), 1, run_log=log)
    score(spark, store, str(tmp_path / "out"), test.limit(0), 1, run_log=log)
    unseen = test.filter("category = 'c4'").count()
    noted = sorted((r["rows"], r.unseen) for r in read_run_log(spark, log).collect())
    assert noted == [(0, 0), (unseen, unseen), (test.count(), unseen)]


def test_recent_batches_lie_over_the_base(spark, tmp_path):
    cache = prediction_cache(spark, str(tmp_path / "cache"))
    schema = "order_dow int, order_hour_of_day int, category string, prediction int"
    every = [(d, h, c, d + h) for d in range(7) for h in range(24) for c in ("a", "b", None)]
    refresh_cache(cache, spark.createDataFrame(every, schema), 2)
    cache.compact()
    for batch in range(20):
        newer = [(3, batch, "a", 100 + batch), (3, batch, None, 200 + batch), (9, batch, "new", batch)]
        refresh_cache(cache, spark.createDataFrame(newer, schema), 3 if batch % 2 else 1, compact_every=10**6)
    want = rows(serving.latest_per_key(cache.rows()))
    assert cache.base() == 0 and len(cache.batches()) == 21
    assert rows(cache.read()) == want and len(want) == len(every) + 20
    found = serving.lookup(cache.read(), "3:5:a")
    assert rows(found) == [("3:5:a", 3, 5, "a", 105, 3)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    # Rows of the base meet the recent keys by broadcast joins, behind a pruned and filtered scan.
    anti, semi = plan.index("LeftAnti, BuildRight"), plan.index("LeftSemi, BuildRight")
    assert "Exchange" not in plan[anti : plan.index("FileScan", anti)]
    assert "Exchange" not in plan[semi : plan.index("FileScan", semi)].replace("BroadcastExchange", "")
    assert plan.count("PartitionFilters: [isnotnull(order_dow") >= 2 and "EqualTo(order_hour_of_day,5)" in plan
    cache.compact()
    assert rows(cache.read()) == want


def test_intervals():
    assert [seconds(t) for t in ("20 seconds", "1 minute", "0.5 hours")] == [20, 60, 1800]
    with pytest.raises(ValueError):
        seconds("soon")


def test_cache_follows_a_new_model(spark, tmp_path, totals):
    store, cache = ModelStore(spark, str(tmp_path / "m")), prediction_cache(spark, str(tmp_path / "cache"))
    refresh = lambda: refresh_if_retrained(spark, store, str(tmp_path / "out"), cache)
    train_model(spark, totals, store, SMALL)
    assert refresh() == 1 and refresh() is None
    keys = rows(cache.read().select("key"))
    train_model(spark, totals, store, ForestSettings(num_trees=3, seed=7))
    assert refresh() == 2 and refresh() is None
    assert {r.model_version for r in cache.read().collect()} == {2}
    assert set(keys) <= set(rows(cache.read().select("key")))


def test_trainings_at_once_get_their_own_versions(spark, tmp_path, totals):
    from concurrent.futures import ThreadPoolExecutor

    store = ModelStore(spark, str(tmp_path / "m"))
    with ThreadPoolExecutor(2) as pool:
        versions = list(pool.map(lambda _: train_model(spark, totals, store, SMALL), range(2)))
    assert sorted(versions) == store.versions() == [1, 2]


def test_claims_at_once_are_never_shared(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    store = ModelStore(spark, str(tmp_path / "m"))
    cache = prediction_cache(spark, str(tmp_path / "cache"))
    schema = "key string, order_dow int, order_hour_of_day int, category string, prediction int, model_version int"
    row = spark.createDataFrame([("0:1:a", 0, 1, "a", 5, 1)], schema).coalesce(1)

    def training(_):
        version = store.claim_version()
        row.write.parquet(f"{store.root}/v={version}/split")  # an existing folder is an error
        return version

    with ThreadPoolExecutor(2) as pool:
        versions = [v for _ in range(50) for v in pool.map(training, range(2))]
        batches = [b for _ in range(50) for b in pool.map(lambda _: cache.append(row), range(2))]
    assert len(set(versions)) == len(set(batches)) == 100
    assert sorted(batches) == cache.batches() and cache.rows().count() == 100


def test_a_claim_waits_for_one_begun_before(spark, tmp_path, monkeypatch):
    from basketflow.sources import files

    monkeypatch.setattr(files, "PATIENCE", 0.5)
    folder = str(tmp_path / "claims")
    files.create(spark, f"{folder}/choosing/someone-who-died")
    assert [files.claim_number(spark, folder, lambda: 4) for _ in range(2)] == [5, 6]
    # A ticket of the same number that sorts first keeps it.
    files.create(spark, f"{folder}/7-0")
    assert files.claim_number(spark, folder, lambda: 6) == 8


def test_refresh_goes_key_by_key(spark, tmp_path, totals):
    store, cache = ModelStore(spark, str(tmp_path / "m")), prediction_cache(spark, str(tmp_path / "cache"))
    refresh = lambda **more: refresh_if_retrained(spark, store, str(tmp_path / "out"), cache, **more)
    train_model(spark, totals, store, SMALL)
    assert refresh() == 1
    train_model(spark, totals, store, ForestSettings(num_trees=3, seed=7))
    one = cache.read().limit(1).select(*KEYS, F.lit(None).cast("bigint").alias("items"))
    refresh_cache(cache, predict(store.load(2), one), 2)
    assert {r.model_version for r in cache.read().collect()} == {1, 2}
    assert refresh() == 2 and {r.model_version for r in cache.read().collect()} == {2}
    assert refresh() is None
    # Rows named by the caller: only those the cache lacks at this version, null keys too.
    more = totals.limit(0).unionByName(spark.createDataFrame([(0, 1, None, None), (0, 1, "c1", 1)], totals.schema))
    known = cache.read().filter("category = 'c1' and order_dow = 0 and order_hour_of_day = 1").count()
    before = cache.rows().count()
    assert refresh(rows=more) == 2 and cache.rows().count() == before + 2 - known
    assert refresh(rows=more) is None


def test_cache_is_folded_on_the_way(spark, tmp_path):
    cache = prediction_cache(spark, str(tmp_path / "cache"))
    schema = "order_dow int, order_hour_of_day int, category string, prediction int"
    for version in range(1, 8):
        refresh_cache(cache, spark.createDataFrame([(0, 1, "a", version)], schema), version, compact_every=3)
    assert cache.base() == 5 and cache.batches() == [3, 4, 5, 6]
    assert rows(cache.read()) == [("0:1:a", 0, 1, "a", 7, 7)]


def test_a_batch_being_written_is_not_folded_over(spark, tmp_path):
    from basketflow.sources import files

    cache = prediction_cache(spark, str(tmp_path / "cache"))
    schema = "order_dow int, order_hour_of_day int, category string, prediction int"
    refresh_cache(cache, spark.createDataFrame([(0, 1, "a", 1)], schema), 1)
    assert files.create(spark, f"{cache.path}/claims/1")
    refresh_cache(cache, spark.createDataFrame([(0, 2, "a", 1)], schema), 1)
    cache.compact()
    assert cache.base() == 0 and cache.batches() == [0, 2] and cache.read().count() == 2


def test_a_failed_training_is_logged(spark, tmp_path, totals):
    log = str(tmp_path / "log")
    with pytest.raises(EmptyInput):
        train_model(spark, totals.limit(0), ModelStore(spark, str(tmp_path / "m")), run_log=log)
    assert "failed" in [r.status for r in read_run_log(spark, log).collect()]
