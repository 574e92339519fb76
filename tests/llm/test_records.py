import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basketflow.llm import records
from basketflow.llm.tokenize import Encoder

SF = "/root/testdata/sf0.001"


def test_mask():
    assert records.masked(b"") == 0xA282EAD8
    checksum = zlib.crc32(b"123456789")
    back = (records.masked(b"123456789") - 0xA282EAD8) % (1 << 32)
    assert (back >> 17 | back << 15) % (1 << 32) == checksum == 0xCBF43926


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(records.tokenizer_path())


def encoded(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


TEXTS = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "\n\n a\n", "\t \tx", "don't  'll go", "x y  z",
    "   a", "\x1c a \x1cb", "a　 b　", "<|endoftext|>", "a <|endoftext|> b", "é è  ü", "😀 😀😀 ", "1 23  456", "a\r\n b",
    "​ x", "\x85 y \x85", "!!  ??", "  \n", "a\x00b \x00",
]


def test_pieces_encode_like_the_whole(tokenizer):
    encoder = Encoder(records.tokenizer_path())
    rng = random.Random(2)
    alphabet = [" ", " ", "\n", "a", "B", "'s", "é", "1", " ", "\t", "!", "\x1c", " ", "日本"]
    texts = TEXTS + ["".join(rng.choices(alphabet, k=rng.randrange(1, 25))) for _ in range(3000)]
    texts += [" ".join(f"w{rng.randrange(9**9)}" for _ in range(9000))]
    for text, ids in zip(texts, encoder.encode(pa.array(texts)), strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == encoded(tokenizer, text)[:-1], repr(text)


def expected(tokenizer, rows):
    start, found = 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = encoded(tokenizer, text)
        found.append((key, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return found


def digests(df):
    return [tuple(r)[:4] for r in df.orderBy("start").collect()]


def test_query_equals_whole_encoding(spark, tokenizer):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert digests(records.op1_token_records(spark, SF)) == expected(tokenizer, rows)


def test_edge_rows(spark, tokenizer, docs_of, sf_dir_of):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "again"), (3, "again"), (None, None), (50, "word " * 60000)]
    docs = docs_of(rows).withColumn("key", F.lit(1)).withColumn("order0", F.lit(2))
    assert digests(records.op1_token_records(spark, sf_dir_of(documents=docs))) == expected(tokenizer, rows)


def test_empty_table(spark, docs_of, sf_dir_of):
    assert records.op1_token_records(spark, sf_dir_of(documents=docs_of([]))).count() == 0


def test_round_trip_and_shuffled_reads(spark, tokenizer, docs_of, tmp_path):
    rows = [(i, f"text number {i}") for i in range(40)]
    folder = f"{tmp_path}/records"
    records.write_records(docs_of(rows), folder, records.tokenizer_path(), [F.col("doc_id")])
    read = records.read_records(spark, folder).orderBy("start").collect()
    assert [(r.key, r.ids) for r in read] == [(i, encoded(tokenizer, t)) for i, t in rows]
    drawn = [[(r.key, r.ids) for r in records.read_shuffled(spark, folder, seed).collect()] for seed in (1, 1, 2)]
    assert drawn[0] == drawn[1] != drawn[2]
    assert sorted(drawn[0]) == sorted(drawn[2]) == [(i, encoded(tokenizer, t)) for i, t in rows]


def test_damage_is_found(tmp_path):
    writer = records.RecordWriter(f"{tmp_path}/part")
    for n in range(3):
        writer.append(records.pack(n, np.arange(n + 5, dtype="<u2").tobytes(), 2))
    writer.close()
    data = bytearray((tmp_path / "part.rec").read_bytes())
    assert len(list(records.payloads(writer.path))) == 3
    for at in (2, 9, 20, len(data) - 1):
        broken = bytearray(data)
        broken[at] ^= 1
        (tmp_path / "bad.rec").write_bytes(broken)
        with pytest.raises(ValueError):
            list(records.payloads(f"{tmp_path}/bad.rec"))
    (tmp_path / "bad.rec").write_bytes(data[:-3])
    with pytest.raises(ValueError):
        list(records.payloads(f"{tmp_path}/bad.rec"))


def test_rows_without_a_key_span_files(spark, tokenizer, docs_of, tmp_path):
    rows = [(None, "same text")] * 400 + [(None, f"text {i}") for i in range(400)] + [(i, f"key {i}") for i in range(1600)]
    folder = str(tmp_path / "records")
    found = records.write_records(docs_of(rows, 6), folder, records.tokenizer_path(), [F.col("doc_id")], shard_bytes=2000)
    sizes = [r.records for r in found.collect()]
    assert len(sizes) >= 8 and max(sizes) <= 2 * len(rows) / len(sizes)
    got = records.read_digests(spark, folder).orderBy("start").collect()
    assert [r.key for r in got] == [None] * 800 + list(range(1600))
    want = sorted((str(k), zlib.crc32(np.array(encoded(tokenizer, t), "<u4").tobytes())) for k, t in rows)
    assert sorted((str(r.key), r.ids_crc32) for r in got) == want


def test_paths_without_a_scheme_are_qualified(spark, tmp_path):
    assert records.qualified(spark, str(tmp_path)) == f"file://{tmp_path}"
    assert records.qualified(spark, f"file://{tmp_path}/a") == f"file://{tmp_path}/a"
