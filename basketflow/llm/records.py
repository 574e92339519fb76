"""Token ids as length-delimited binary records, with an offset index beside each file.

A record is framed as
    length of the payload   8 bytes, little-endian
    masked CRC-32 of them   4 bytes
    payload                 16 bytes of header (``HEADER``), then the ids, 2 or 4 bytes each
    masked CRC-32 of it     4 bytes
and the index file holds the offset of every record and the end of the file, 8 bytes each.

A folder of records is what its manifest lists: a Parquet table with a row per file, written by
the job that wrote the files. File names are unique to a task attempt, so a lost or repeated
attempt leaves a file that no row names, never a damaged or doubled one.
"""

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketflow.llm.tables import documents
from basketflow.llm.tokenize import Encoder
from basketflow.session import working_dir

HEADER = "<BBHqI"  # 1 if there is a key, bytes an id, 0, key, number of ids
HEADER_SIZE = struct.calcsize(HEADER)
FRAME = 8 + 4 + 4  # bytes around a payload
WRITE_AT = 1 << 22  # bytes gathered before they go to the file
HEAD = 64
SHARD_BYTES = 1 << 26  # bytes of text for one file: long shards meet most of their words again

MANIFEST = "shard int, path string, records long, tokens long, bytes long, first long, last long"


def pack(key: int | None, ids: bytes, width: int) -> bytes:
    return struct.pack(HEADER, key is not None, width, 0, key or 0, len(ids) // width) + ids


def unpack(payload: bytes) -> tuple[int | None, np.ndarray]:
    known, width, _, key, n = struct.unpack_from(HEADER, payload)
    ids = np.frombuffer(payload, f"<u{width}", n, HEADER_SIZE)
    return (key if known else None), ids.astype("<u4")


MASK_DELTA = 0xA282EAD8


def masked(data: bytes) -> int:
    """The CRC-32 of some bytes, rotated and shifted.

    The mask keeps a checksum over data that holds checksums of its own a good one.
    """
    checksum = zlib.crc32(data)
    return ((checksum >> 15 | checksum << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def parse(data: bytes, at: int = 0) -> tuple[bytes, int] | None:
    """The payload that starts at an offset and the offset after it; None if it is not all there.

    Both checksums must hold.
    """
    if len(data) - at < FRAME:
        return None
    size, head = struct.unpack_from("<QI", data, at)
    if head != masked(data[at : at + 8]):
        raise ValueError(f"damaged length at offset {at}")
    end = at + FRAME + size
    if len(data) < end:
        return None
    payload = data[at + 12 : end - 4]
    if struct.unpack_from("<I", data, end - 4) != (masked(payload),):
        raise ValueError(f"damaged record at offset {at}")
    return payload, end


def payloads(path: str) -> Iterator[bytes]:
    """The payloads of a file in order, read in pieces."""
    fs, name = open_uri(path)
    with fs.open_input_stream(name) as stream:
        rest, at = b"", 0
        while True:
            while found := parse(rest, at):
                payload, at = found
                yield payload
            more = stream.read(WRITE_AT)
            if not more:
                if at < len(rest):
                    raise ValueError(f"{path} ends within a record")
                return
            rest, at = rest[at:] + more, 0


def read_at(path: str, begin: int, end: int) -> tuple[int | None, list[int]]:
    """The record between two offsets of an index."""
    fs, name = open_uri(path)
    with fs.open_input_file(name) as file:
        found = parse(file.read_at(end - begin, begin))
    if found is None:
        raise ValueError(f"{path} has no record from {begin} to {end}")
    key, ids = unpack(found[0])
    return key, ids.tolist()


# Writing


def write_records(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    order: list[Column],
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Encodes every text, appends ``end_id`` and writes the records; returns the manifest.

    Records lie in ascending ``order`` within and across files. A null text is an empty one, a
    null key is kept as null, rows with equal keys are records of their own; an empty table gives
    a manifest without rows. ``folder`` is a URI or path that all executors share; a file takes
    about ``shard_bytes`` bytes of text. Rows of equal order lie by the first ``HEAD`` characters of their
    text, then by its hash, and may span files. Other columns of ``docs`` are not read, so they cannot clash.
    """
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), *(
        c.alias(f"order{i}") for i, c in enumerate(order)
    ))
    # Rows that are equal in order, such as all without a key, are parted by text, equal texts by number.
    # Not by the whole text: keys of a sample go to the driver.
    rows = rows.withColumns(
        {"head": F.substring("text", 1, HEAD), "digest": F.xxhash64("text"), "row": F.monotonically_increasing_id()}
    )
    names = [*[f"order{i}" for i in range(len(order))], "head", "digest", "row"]
    rows = rows.repartitionByRange(-(-size // shard_bytes) or 1, *names).sortWithinPartitions(*names).select("key", "text")
    folder = qualified(docs.sparkSession, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        encoder = Encoder(tokenizer)
        end = encoder.pack([end_id])
        writer, tokens, keys = None, 0, [None, None]
        for batch in batches:
            if writer is None:
                writer = RecordWriter(f"{folder}/part-{shard:05d}-{uuid.uuid4().hex}")
            for k, own in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1)), strict=True):
                payload = pack(k, own + end, encoder.width)
                writer.append(payload)
                tokens += len(own) // encoder.width + 1
                keys = [k if writer.records == 1 else keys[0], k]
        if writer is not None and writer.records:
            size = writer.close()
            row = [shard, writer.path, writer.records, tokens, size, *keys]
            types = [pa.int32(), pa.string(), *[pa.int64()] * 5]
            columns = [pa.array([v], t) for v, t in zip(row, types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in MANIFEST.split(", ")])

    rows.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return manifest(docs.sparkSession, folder)


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme, as Spark resolves it, so that record files lie beside the manifest."""
    jvm = spark._jvm
    whole = jvm.org.apache.hadoop.fs.Path(path)
    uri = whole.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(whole).toString()
    return "file://" + uri.removeprefix("file:") if uri.startswith("file:/") and not uri.startswith("file://") else uri


class RecordWriter:
    """One record file and its index."""

    def __init__(self, stem: str):
        self.path = f"{stem}.rec"
        self.stem = stem
        fs, path = open_uri(self.path)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        self.file = fs.open_output_stream(path)
        self.waiting, self.size, self.offsets = [], 0, [0]
        self.pending = 0

    @property
    def records(self) -> int:
        return len(self.offsets) - 1

    def append(self, payload: bytes) -> None:
        framed = frame(payload)
        self.waiting.append(framed)
        self.size += len(framed)
        self.pending += len(framed)
        self.offsets.append(self.size)
        if self.pending >= WRITE_AT:
            self._flush()

    def _flush(self) -> None:
        self.file.write(b"".join(self.waiting))
        self.waiting, self.pending = [], 0

    def close(self) -> int:
        self._flush()
        self.file.close()
        fs, path = open_uri(f"{self.stem}.idx")
        with fs.open_output_stream(path) as index:
            index.write(np.array(self.offsets, "<u8").tobytes())
        return self.size


def open_uri(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri)


# Reading


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """``(shard, position, start, key, ids)`` in file order; ``start`` counts the ids before."""
    schema = "shard int, position long, start long, key long, ids array<long>"
    return _per_file(spark, folder).mapInArrow(_reader(lambda ids: ids.tolist(), pa.list_(pa.int64())), schema)


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """As ``read_records``, with the ids' number and CRC-32 (of 32-bit integers) for the ids."""

    def digest(ids: np.ndarray) -> dict:
        return {"n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.tobytes())}

    kind = pa.struct([("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    schema = "shard int, position long, start long, key long, ids struct<n_tokens: long, ids_crc32: long>"
    found = _per_file(spark, folder).mapInArrow(_reader(digest, kind), schema)
    return found.select("shard", "position", "start", "key", "ids.*")


def _per_file(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest, a file per task, with the number of ids in earlier files.

    The running sum goes over the files of a folder, of which there is one per some million ids.
    """
    files = manifest(spark, folder)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    return files.repartitionByRange(max(1, files.count()), "shard").select("shard", "path", "base", "records")


def _reader(of_ids, kind: pa.DataType):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _rows(row)

    def _rows(row: dict) -> Iterator[pa.RecordBatch]:
        start, found, size, position = row["base"], [], 0, -1
        for position, payload in enumerate(payloads(row["path"])):
            key, ids = unpack(payload)
            found.append((row["shard"], position, start, key, of_ids(ids)))
            start += len(ids)
            size += len(payload)
            if size >= WRITE_AT:
                yield _batch(found)
                found, size = [], 0
        if found:
            yield _batch(found)
        if row["records"] != position + 1:
            raise ValueError(f"{row['path']} holds {position + 1} records, not {row['records']}")

    def _batch(found: list) -> pa.RecordBatch:
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), kind]
        columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["shard", "position", "start", "key", "ids"])

    return read


def read_shuffled(spark: SparkSession, folder: str, seed: int) -> DataFrame:
    """``(shard, position, key, ids)`` of all records, dealt to tasks in an order set by ``seed``.

    Only offsets are shuffled; each task then reads its records by offset.
    """
    spans = "shard int, path string, position long, begin long, end long"

    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, name = open_uri(row["path"].removesuffix(".rec") + ".idx")
                with fs.open_input_stream(name) as stream:
                    at = np.frombuffer(stream.read(), "<u8").astype(np.int64)
                n = len(at) - 1
                columns = [
                    pa.array(np.full(n, row["shard"], np.int32)),
                    pa.array([row["path"]] * n),
                    pa.array(np.arange(n)),
                    pa.array(at[:-1]),
                    pa.array(at[1:]),
                ]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in spans.split(", ")])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(r["shard"], r["position"], *read_at(r["path"], r["begin"], r["end"])) for r in batch.to_pylist()]
            types = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "position", "key", "ids"])

    drawn = F.xxhash64(F.lit(seed), "shard", "position")
    dealt = _per_file(spark, folder).mapInArrow(offsets, spans).withColumn("drawn", drawn)
    dealt = dealt.repartitionByRange("drawn").sortWithinPartitions("drawn").drop("drawn")
    return dealt.mapInArrow(fetch, "shard int, position long, key long, ids array<long>")


# Query

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the installed tokenizer files are."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = working_dir(spark, "records")
    write_records(documents(spark, sf_dir), folder, tokenizer_path(), [F.col("doc_id")])
    read = read_digests(spark, folder)
    return read.select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32", "shard", "position")
