"""Session defaults and the folder for working tables."""

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # One open writer per weekday folder instead of a sort of every task's rows.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app_name: str = "basketflow", master: str | None = None, **conf) -> SparkSession:
    """A session with this library's defaults; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def working_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder path for working tables, reachable by every executor.

    The parent is the shared folder named in ``spark.checkpoint.dir``. Only in local mode, and
    only when that setting is absent, a folder of this application below the temporary one
    takes its place; the session is left as it is.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = f"{tempfile.gettempdir()}/basketflow-{spark.sparkContext.applicationId}"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
