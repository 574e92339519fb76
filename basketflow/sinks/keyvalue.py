"""Writer for external key-value stores, as a Spark data source.

    spark.dataSource.register(KeyValueSink)
    rows.select("key", "value").write.format("keyvalue").mode("append") \
        .option("client", "package.module:factory").save()

The client is ``folder`` (``FolderClient``), ``redis`` (``RedisClient``) or another factory.
``factory(options)`` is called once per task and returns a client with ``set_many(dict)``
and ``close()``. A client may also have ``parts``, names of what it has written, and take them with
``commit(batch, parts)`` and ``abort(parts)``, called once per batch on the driver. ``writeStream``
works as well. Rows arrive as Arrow batches and go out in batches, not one call per key. Setting a key is
idempotent, so a retried task does no harm; give every key once (see ``latest_per_key``)
and no two tasks write the same key.
"""

import importlib
import json
import sys
import uuid
from dataclasses import dataclass

import pyarrow.fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceStreamArrowWriter,
    WriterCommitMessage,
)
from pyspark.sql.streaming import DataStreamWriter

BATCH_SIZE = 1000


class KeyValueSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "keyvalue"

    def schema(self) -> str:
        return "key string, value string"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return KeyValueWriter(dict(self.options))

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamArrowWriter:
        return KeyValueStreamWriter(dict(self.options))


@dataclass
class Written(WriterCommitMessage):
    """What a task has written, as its client tells."""

    parts: list[str]


def open_client(options: dict):
    if options["client"] in CLIENTS:
        return CLIENTS[options["client"]](options)
    module, factory = options["client"].split(":", 1)
    return getattr(importlib.import_module(module), factory)(options)


class _Writer:
    def __init__(self, options: dict):
        if "client" not in options:
            raise ValueError("option 'client' must be folder, redis or a factory as package.module:factory")
        self.options = options

    def write(self, batches) -> WriterCommitMessage:
        client = open_client(self.options)
        size = int(self.options.get("batchsize", BATCH_SIZE))
        try:
            for batch in batches:
                for start in range(0, batch.num_rows, size):
                    part = batch.slice(start, size)
                    keys, values = (part.column(c).to_pylist() for c in ("key", "value"))
                    client.set_many(dict(zip(keys, values, strict=True)))
        finally:
            client.close()
        return Written(getattr(client, "parts", []))

    def _undo(self, messages) -> None:
        """Nothing to undo if no task told of parts: the client may be what has failed."""
        parts = [p for m in messages if m for p in m.parts]
        if parts:
            self._tell("abort", parts)

    def _tell(self, method: str, *arguments) -> None:
        """Call a method that a client may leave out."""
        client = open_client(self.options)
        try:
            if hasattr(client, method):
                getattr(client, method)(*arguments)
        finally:
            client.close()


class KeyValueWriter(_Writer, DataSourceArrowWriter):
    def commit(self, messages) -> None:
        self._tell("commit", uuid.uuid4().hex, [p for m in messages if m for p in m.parts])

    def abort(self, messages) -> None:
        self._undo(messages)


class KeyValueStreamWriter(_Writer, DataSourceStreamArrowWriter):
    """A micro-batch is committed under its number, so one that is repeated replaces itself."""

    def commit(self, messages, batchId: int) -> None:
        self._tell("commit", str(batchId), [p for m in messages if m for p in m.parts])

    def abort(self, messages, batchId: int) -> None:
        self._undo(messages)


class FolderClient:
    """A store that is a folder of files, for whoever loads them elsewhere; option ``folder``.

    Pairs count once their batch is committed: ``commits/BATCH`` lists its files, so what a failed or
    repeated attempt has written is never read. ``folder_pairs`` reads the store.
    """

    def __init__(self, options: dict):
        if "folder" not in options:
            raise ValueError("option 'folder' must name a folder that all executors share")
        self._fs, self._root = pyarrow.fs.FileSystem.from_uri(options["folder"])
        self.parts: list[str] = []

    def set_many(self, pairs: dict) -> None:
        name = f"{uuid.uuid4().hex}.json"
        lines = [json.dumps({"key": key, "value": value}) for key, value in pairs.items()]
        self._write(f"parts/{name}", "\n".join([*lines, ""]))
        self.parts.append(name)

    def commit(self, batch: str, parts: list[str]) -> None:
        self._write(f"commits/{batch}.json", "".join(json.dumps({"batch": batch, "part": p}) + "\n" for p in parts))

    def abort(self, parts: list[str]) -> None:
        for part in parts:
            self._fs.delete_file(f"{self._root}/parts/{part}")

    def close(self) -> None:
        pass

    def _write(self, name: str, text: str) -> None:
        path = f"{self._root}/{name}"
        self._fs.create_dir(path.rpartition("/")[0], recursive=True)
        with self._fs.open_output_stream(path) as file:
            file.write(text.encode())


def folder_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """``(key, value)`` of all committed batches of a ``FolderClient``; of equal keys, any one counts."""
    commits = spark.read.schema("batch string, part string").json(f"{folder}/commits")
    pairs = spark.read.schema("key string, value string").json(f"{folder}/parts")
    pairs = pairs.withColumn("part", F.regexp_extract("_metadata.file_path", "([^/]+)$", 1))
    return pairs.join(commits.select("part").distinct(), "part").select("key", "value")


class RedisClient:
    """Sends each batch as one MSET."""

    def __init__(self, options: dict):
        try:
            import redis
        except ImportError as error:
            raise RuntimeError("the redis package is not installed on the executors") from error
        if "host" not in options:
            raise ValueError("option 'host' must name the server as the executors see it")
        self._connection = redis.Redis(
            host=options["host"],
            port=int(options.get("port", 6379)),
            db=int(options.get("db", 0)),
        )

    def set_many(self, pairs: dict) -> None:
        self._connection.mset(pairs)

    def close(self) -> None:
        self._connection.close()


CLIENTS = {"folder": FolderClient, "redis": RedisClient}
# Task code travels by value, so workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _pairs(cache: DataFrame) -> DataFrame:
    cache.sparkSession.dataSource.register(KeyValueSink)
    return cache.select("key", F.col("prediction").cast("string").alias("value"))


def write_keyvalue(cache: DataFrame, client: str, **options) -> None:
    """Send cache rows as ``key -> prediction`` to an external store."""
    writer = _pairs(cache).write.format("keyvalue").mode("append").option("client", client)
    for name, value in options.items():
        writer = writer.option(name, value)
    writer.save()


def stream_keyvalue(rows: DataFrame, client: str, checkpoint: str, **options) -> DataStreamWriter:
    """A stream of ``key, prediction`` rows sent to an external store, batch by batch."""
    writer = _pairs(rows).writeStream.format("keyvalue").option("client", client).option("checkpointLocation", checkpoint)
    for name, value in options.items():
        writer = writer.option(name, value)
    return writer.outputMode("append")
