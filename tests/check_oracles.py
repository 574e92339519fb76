"""Run registered queries next to their SQL and compare: python tests/check_oracles.py [name...]

Environment: SF_DIR (default /root/testdata/sf0.01), TZ_CHECK (another session time zone).
"""

import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

from __spark_entry__ import oracle_sql, queries
from basketflow.session import build_session


TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def oracle_connection(sf_dir):
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def normalised(columns, rows):
    """Rows with columns in name order, sorted; floats as text with their full precision."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(list(r[i]) if isinstance(r[i], tuple) else r[i]) for i in order) for r in rows)


def compare(spark, connection, name, sf_dir):
    """(ok, message) of one query."""
    started = time.time()
    df = queries()[name](spark, sf_dir)
    got_rows = [tuple(r) for r in df.collect()]
    seconds = time.time() - started
    sql = oracle_sql().get(name)
    if sql is None:
        return bool(got_rows), f"rows only: {len(got_rows)} rows, {seconds:.1f} s"
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}"
    types = {d[0]: str(d[1]) for d in cursor.description}
    other = [f"{c}: {t} / {types[c]}" for c, t in df.dtypes if TYPES.get(t) != types[c]]
    if other:
        return False, f"types differ: {other}"
    got, want = normalised(df.columns, got_rows), normalised(names, cursor.fetchall())
    if got != want:
        extra, missing = sorted(set(got) - set(want))[:3], sorted(set(want) - set(got))[:3]
        return False, f"{len(got)} rows != {len(want)}; extra {extra}; missing {missing}"
    return True, f"{len(got)} rows, {seconds:.1f} s"


def main():
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(
        "oracles", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    )
    if "TZ_CHECK" in os.environ:
        spark.conf.set("spark.sql.session.timeZone", os.environ["TZ_CHECK"])
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    failed = 0
    for name in sys.argv[1:] or queries():
        try:
            ok, message = compare(spark, connection, name, sf_dir)
        except Exception as error:
            ok, message = False, f"{type(error).__name__}: {str(error)[:1500]}"
        failed += not ok
        print("ok  " if ok else "FAIL", name, message, flush=True)
    sys.exit(1 if failed else 0)


if __name__ == "__main__":
    main()
