from basketflow.__main__ import arguments, main, run
from basketflow.plans.scoring import prediction_cache

HEADER = "order_id,user_id,order_dow,order_hour_of_day,fruit,bread\n"


def test_all_jobs_in_turn(spark, folder, capfd):
    lines = "".join(f"{i},1,{i % 7},{i % 24},{i % 5},{i % 3}\n" for i in range(1000))
    root = folder(orders=HEADER + lines)
    job = lambda *argv: run(spark, arguments([a.replace("@", root) for a in argv]))
    job("split", "@/orders.csv", "@/raw", "--quarantine", "@/bad")
    job("full", "@/raw", "@/aggregate", "--csv", "@/aggregate_csv")
    job("incremental", "@/raw", "@/state", "--csv", "@/incremental_csv")
    job("stateful", "@/raw", "@/stateful", "--csv", "@/stateful_csv")
    job("highwater", "@/raw", "@/strict", "--ids", "order_id,user_id,order_dow,order_hour_of_day")
    job("train", "@/strict", "@/strict_models")
    job("incremental", "@/raw", "@/drift", "--drift", "--quarantine", "@/drift_bad")
    assert spark.read.parquet(f"{root}/drift_bad").count() == 0
    full = spark.read.parquet(f"{root}/aggregate")
    exported = spark.read.option("header", True).csv(f"{root}/incremental_csv")
    assert full.count() == exported.count() > 0
    running = spark.read.option("header", True).csv(f"{root}/stateful_csv")
    assert exported.exceptAll(running).isEmpty() and running.exceptAll(exported).isEmpty()
    job("train", "@/state", "@/models")
    job("predict", "@/models", "@/predictions", "--csv", "@/predictions_csv")
    job("predict-cached", "@/models", "@/predictions", "@/cache")
    key = prediction_cache(spark, f"{root}/cache").read().first().key
    assert job("get", "@/cache", key) == 0 and job("get", "@/cache", "0:0:none") == 1
    job("keys", "@/cache")
    printed = capfd.readouterr().out.splitlines()
    assert set(printed) >= {r.key for r in prediction_cache(spark, f"{root}/cache").read().collect()}
    job("keys", "@/cache", "@/keys_csv")
    assert spark.read.option("header", True).csv(f"{root}/keys_csv").count() == prediction_cache(spark, f"{root}/cache").read().count()
    job("train", "@/models", "--input", "@/aggregate")
    job("refresh", "@/models", "@/predictions", "@/cache")
    assert {r.model_version for r in prediction_cache(spark, f"{root}/cache").read().collect()} == {2}
    job("predict", "@/models", "@/predictions", "--input", "@/aggregate", "--csv", "@/all_csv")
    assert spark.read.option("header", True).csv(f"{root}/all_csv").count() == full.count()
    job("compact-cache", "@/cache")
    job("compact", "@/state")
    job("reset", "@/state")


def test_malformed_key_is_a_failure(spark, tmp_path, capsys):
    assert main(["get", str(tmp_path), "no key"]) == 1
    assert "MalformedKey" in capsys.readouterr().out


def test_options_of_a_client():
    args = arguments(["refresh", "m", "p", "c", "--client", "a:b", "--client-option", "host=h", "--client-option", "port=1", "--every", "20 seconds"])
    assert dict(args.client_option) == {"host": "h", "port": "1"} and args.every == "20 seconds"


def test_missing_input_is_a_failure(spark, tmp_path, capsys):
    assert main(["full", str(tmp_path), str(tmp_path / "out")]) == 1
    assert main(["predict", str(tmp_path), str(tmp_path / "out")]) == 1
    assert "ModelNotFound" in capsys.readouterr().out
