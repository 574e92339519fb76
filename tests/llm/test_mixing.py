import pytest
from brute import assert_equals_sql

from basketflow.llm import mixing

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "parts",
    [{"a": 1}, {"a": 1, "b": 1}, {"a": 3, "b": 5, "c": 7}, {"a": 97, "b": 2, "c": 1}, mixing.TARGET_PARTS],
)
def test_schedule_meets_release_and_deadline(spark, parts):
    slots = mixing.schedule(spark, parts).orderBy("slot").collect()
    period = sum(parts.values())
    assert [r.slot for r in slots] == list(range(period))
    had = dict.fromkeys(parts, 0)
    for t, r in enumerate(slots):
        assert r.release <= t < r.deadline and r.k == had[r["class"]] and list(r.ahead) == list(had.values())
        had[r["class"]] += 1
        for name, w in parts.items():
            assert abs(had[name] - (t + 1) * w / period) < 1
    assert had == parts


def test_bad_parts(spark):
    with pytest.raises(ValueError):
        mixing.schedule(spark, {"a": 0})
    with pytest.raises(ValueError):
        mixing.schedule(spark, {"a": mixing.MOST_PARTS + 1})


def test_every_row_has_a_place_and_shares_hold(spark, docs_of):
    rows = [(i, "x", "a") for i in range(200)] + [(1000 + i, "x", "b") for i in range(50)]
    rows += [(2000 + i, None, None) for i in range(9)] + [(3000, "x", "new"), (3000, "x", "new"), (None, "x", "a")]
    parts = {"a": 2, "b": 1}
    found = mixing.mix(docs_of(rows), parts, 4).orderBy("position", "place").collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in rows)
    assert len({(r.position, r.place) for r in found}) == len(rows)
    assert sorted({r.position for r in found}) == list(range(max(r.position for r in found) + 1))
    assert all(r.release <= r.slot < r.deadline for r in found)
    # Until a class runs out, shares differ from the target by less than a block.
    last = min(max(r.slot for r in found if r["class"] == c) for c in ("a", "b", mixing.OTHER))
    for t in range(1, last + 1):
        blocks = {(r["class"], r.block) for r in found if r.slot < t}
        for c, w in (("a", 2), ("b", 1), (mixing.OTHER, 1)):
            assert abs(sum(b[0] == c for b in blocks) - t * w / 4) < 1


def test_more_columns_and_empty_table(spark, docs_of):
    docs = docs_of([(1, "x", "src0"), (2, "y", "src1")]).selectExpr("*", "1 AS position", "2 AS rank", "3 AS `class`")
    assert mixing.mix(docs, mixing.TARGET_PARTS, 1).count() == 2
    assert mixing.in_mixed_order(docs, mixing.TARGET_PARTS, 1).columns == docs.columns
    assert mixing.mix(docs_of([]), mixing.TARGET_PARTS, 1).count() == 0
    assert mixing.in_mixed_order(docs_of([]), mixing.TARGET_PARTS, 1).count() == 0


def test_mixed_order_keeps_every_row(spark, docs_of):
    rows = [(i % 30, f"t{i}", f"src{i % 4}") for i in range(60)] + [(None, "n", "src0")] * 2
    docs = docs_of(rows)
    mixed = mixing.in_mixed_order(docs, mixing.TARGET_PARTS, 2)
    assert sorted(map(str, mixed.collect())) == sorted(map(str, docs.collect()))


def test_no_python_in_the_plan(spark):
    plan = mixing.op4_mix(spark, SF)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_sql_agrees(spark):
    assert_equals_sql(mixing.op4_mix(spark, SF), mixing.OP4_SQL, SF)
