"""Directory listings on whatever file system a path names (local, HDFS, object store)."""

import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, sorted; empty when none does.

    Every path is a call into the JVM, so this is for folders, not for data files.
    """
    fs, path = _file_system(spark, pattern)
    return sorted(status.getPath().toString() for status in fs.globStatus(path) or [])


def exists(spark: SparkSession, pattern: str) -> bool:
    """Whether anything matches a glob pattern."""
    fs, path = _file_system(spark, pattern)
    return len(fs.globStatus(path) or []) > 0


def make_dirs(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.mkdirs(hadoop_path)


# How long a claim waits for another one that was begun before and not finished.
PATIENCE = 30.0


def create(spark: SparkSession, path: str) -> bool:
    """Create an empty file; false if it is there already.

    Not every file system lets only one of several callers succeed; see ``claim_number``.
    """
    fs, hadoop_path = _file_system(spark, path)
    fs.mkdirs(hadoop_path.getParent())
    try:
        fs.create(hadoop_path, False).close()
    except Exception:
        if fs.exists(hadoop_path):
            return False
        raise
    return True


def claim_number(spark: SparkSession, folder: str, taken: Callable[[], int]) -> int:
    """A number above ``taken()`` and all claims in ``folder`` that no other caller gets.

    Needs no exclusive create or rename, only listings that show finished writes. A ticket is a
    file ``N-id``, its name the caller's own. Whoever draws one shows that with a file in
    ``choosing`` until the ticket is there; after it, everyone seen choosing is waited for. Then all
    tickets with the same number can be seen, and the least id keeps it; others draw again.
    A caller that died while choosing holds others up for ``PATIENCE`` seconds, and one that takes half
    of that itself begins anew.
    """
    me = uuid.uuid4().hex
    choosing = f"{folder}/choosing"
    while True:
        begun = time.monotonic()
        create(spark, f"{choosing}/{me}")
        number = max(taken(), *_tickets(spark, folder), -1) + 1
        in_time = time.monotonic() - begun < PATIENCE / 2
        if in_time:
            create(spark, f"{folder}/{number}-{me}")
        remove_dir(spark, f"{choosing}/{me}")
        if not in_time:
            continue
        before, asked = set(glob(spark, f"{choosing}/*")), time.monotonic()
        while before and time.monotonic() - asked < PATIENCE:
            time.sleep(0.02)
            before &= set(glob(spark, f"{choosing}/*"))
        if min(_tickets(spark, folder)[number]) == me:
            return number
        me = uuid.uuid4().hex


def claimed_numbers(spark: SparkSession, folder: str) -> list[int]:
    return sorted(_tickets(spark, folder))


def _tickets(spark: SparkSession, folder: str) -> dict[int, list[str]]:
    """The ids of the tickets for each number."""
    found: dict[int, list[str]] = {}
    for path in glob(spark, f"{folder}/*"):
        number, _, owner = path.rsplit("/", 1)[-1].partition("-")
        if number.isdecimal():
            found.setdefault(int(number), []).append(owner)
    return found


def older(spark: SparkSession, pattern: str, seconds: float) -> bool:
    """Whether all files that match were last changed more than so many seconds ago."""
    fs, path = _file_system(spark, pattern)
    return all(time.time() - status.getModificationTime() / 1000 > seconds for status in fs.globStatus(path) or [])


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    fs, hadoop_path = _file_system(spark, path)
    return fs.getContentSummary(hadoop_path).getLength()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file as text, on the driver; None if it is not there."""
    fs, hadoop_path = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return None
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, in place of an older one."""
    fs, hadoop_path = _file_system(spark, path)
    stream = fs.create(hadoop_path, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def set_time(spark: SparkSession, pattern: str, seconds: float) -> None:
    """Set the time of the last change of all files that match."""
    fs, path = _file_system(spark, pattern)
    for status in fs.globStatus(path) or []:
        fs.setTimes(status.getPath(), int(seconds * 1000), -1)


def remove_dir(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def numbered_dirs(spark: SparkSession, root: str, prefix: str = "", marker: str = "") -> list[int]:
    """The numbers N of the folders ``root/{prefix}N`` (that hold a file ``marker``)."""
    suffix = f"/{marker}" if marker else ""
    depth = suffix.count("/")
    found = set()
    for path in glob(spark, f"{root}/{prefix}*{suffix}"):
        name = path.split("/")[-1 - depth]
        number = name[len(prefix) :]
        if number.isdecimal():
            found.add(int(number))
    return sorted(found)
