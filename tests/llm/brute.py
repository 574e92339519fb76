"""Plain Python versions to hold the operators against."""

import re
import sys
from pathlib import Path

import xxhash

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from check_oracles import TYPES, normalised, oracle_connection

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})


def words(text):
    return WORDS.findall(text or "")


def simhash(text, k=4):
    found = words((text or "").translate(UPPER))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + k]) for i in range(max(1, len(found) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(items, linked):
    """The smallest item reachable from each item."""
    items = sorted(items)
    root = {i: i for i in items}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(items):
        for b in items[n + 1 :]:
            if linked(a, b):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: top(i) for i in items}


def assert_equals_sql(df, sql, sf_dir):
    """Same names, types and rows as the SQL has on the tables of a folder."""
    cursor = oracle_connection(sf_dir).execute(sql)
    names = {d[0]: str(d[1]) for d in cursor.description}
    assert names == {c: TYPES.get(t) for c, t in df.dtypes}
    want = normalised(list(names), cursor.fetchall())
    assert normalised(df.columns, [tuple(r) for r in df.collect()]) == want
