import hashlib

import numpy as np
import pytest
import tiktoken
from hypothesis import given
from hypothesis import strategies as st

from basketflow.llm import bpe

SF = "/root/testdata/sf0.01"
RANKS, PATTERN = bpe.ranks_path(), bpe.split_pattern()


def plain(text):
    ids = bpe.encoding(RANKS, PATTERN).encode_ordinary(text or "")
    packed = np.array(ids, "<u4").tobytes()
    decoded = bpe.encoding(RANKS, PATTERN).decode_bytes(ids)
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest()


def in_parts(text, size):
    coder = (bpe.encoding(RANKS, PATTERN), bpe.encoding(RANKS, bpe.ONE_MATCH))
    return [i for part, one in bpe.parts(text, size) for i in coder[one].encode_ordinary(part)]


def test_query_equals_the_library(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r[0]: tuple(r)[1:] for r in bpe.op13_byte_bpe(spark, SF).collect()}
    assert got == {key: plain(text) for key, text in texts.items()}
    assert all(got[key][2] == hashlib.sha256((text or "").encode()).hexdigest() for key, text in texts.items())


@given(st.text(st.sampled_from("ab'st1 \t\n\r\x0b\x1c\x85\xa0 　é中!-"), max_size=60), st.integers(1, 9))
def test_parts_do_not_change_ids(text, size):
    assert "".join(part for part, _ in bpe.parts(text, size)) == text
    assert in_parts(text, size) == bpe.encoding(RANKS, PATTERN).encode_ordinary(text)


@pytest.mark.parametrize("white", [" ", "\n", "　", " \n"])
@pytest.mark.parametrize("around", [("", ""), ("a", ""), ("", "b"), ("a", "b c"), ("it's", "!")])
def test_long_runs_of_white_space(white, around):
    text = around[0] + white * bpe.LONG_RUN + around[1]
    assert any(one for _, one in bpe.parts(text))
    assert in_parts(text, 100) == bpe.encoding(RANKS, PATTERN).encode_ordinary(text)


def test_texts_without_a_safe_place_and_very_long_runs():
    for text in ("a" * 300_000, "中文" * 100_000, "x1!" * 100_000):
        assert in_parts(text, 1000) == bpe.encoding(RANKS, PATTERN).encode_ordinary(text)
    text = "a" + " " * 3_000_000 + "b"
    ids = in_parts(text, bpe.PART_CHARS)
    assert bpe.encoding(RANKS, PATTERN).decode_bytes(ids).decode() == text


def test_nulls_repeats_and_extra_columns(spark, docs_of):
    docs = docs_of([(1, None), (1, ""), (None, "a b"), (None, "a b"), (2, "x" * 1000)])
    docs = docs.selectExpr("*", "1 as ids", "2 as bytes", "3 as _ids", "4 as `a.b`")
    coded = bpe.encode(docs, RANKS, PATTERN)
    assert set(coded.columns) == {*docs.columns} - {"text"}
    back = bpe.decode(coded, RANKS, PATTERN)
    rows = sorted((str(r.doc_id), bytes(r.bytes).decode(), r["a.b"]) for r in back.collect())
    assert rows == [("1", "", 4), ("1", "", 4), ("2", "x" * 1000, 4), ("None", "a b", 4), ("None", "a b", 4)]
    empty = bpe.decode(bpe.encode(docs_of([]), RANKS, PATTERN), RANKS, PATTERN)
    assert empty.count() == 0
    assert bpe.decode(spark.sql("select cast(null as binary) as ids"), RANKS, PATTERN).head().bytes == b""


def test_bytes_that_are_not_utf8(spark):
    docs = spark.sql("select 1 as doc_id, cast(x'61ff62' as string) as text")
    back = bpe.decode(bpe.encode(docs, RANKS, PATTERN), RANKS, PATTERN).head()
    assert bytes(back.bytes).decode() == "a�b"


def test_special_strings_are_ordinary_text():
    assert isinstance(bpe.encoding(RANKS, PATTERN), tiktoken.Encoding)
    text = "<|endoftext|>"
    ids = in_parts(text, 100)
    assert len(ids) > 1 and bpe.encoding(RANKS, PATTERN).decode_bytes(ids).decode() == text
