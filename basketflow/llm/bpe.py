"""Byte-level BPE by a rank file, with the tiktoken library: texts to token ids and back to bytes.

The rank file is read from a local path on every worker, once; its path is a parameter. Ids are
binary, four little-endian bytes each, so that neither an id list nor a text is held as Python
objects longer than one document takes.

A long text is encoded in parts of about ``PART_CHARS`` characters. Parts are cut only where a
blank, tab or line end follows a character that is not white space: no match of the pattern
reaches over such a place, none that ends there looks ahead, and none that begins there looks
back. So the matches of the parts are those of the whole text, and nothing is merged across
matches. A text without such a place is one part. A run of ``LONG_RUN`` white-space characters or
more, at which the library's pattern matcher gives up from about a million on, is merged without
it: the run is one match, but for its last character if the text goes on after it.

Rows are independent and only mapped: no shuffle, and a lost task is computed again by itself.
Null keys stay, equal rows stay equal rows, ties cannot arise. A null text counts as empty, and an
empty text has no ids. Bytes that are not UTF-8 become U+FFFD before encoding. An empty table
stays empty. Columns of the table other than the text pass through; one that is already named like
the result (``ids``, ``bytes``) is replaced by it.
"""

import base64
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from basketflow.llm.tables import documents, text_bytes

PART_CHARS = 1 << 18
LONG_RUN = 1 << 16
STEP_ROWS = 64  # rows of a batch whose results are held at a time
SAFE = re.compile(r"(?<=\S)(?=[ \t\r\n])")
# The characters that Unicode calls white space, as the pattern's \s does.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
ONE_MATCH = r"[\s\S]+"
RUN = re.compile(f"[{WHITE}]{{{LONG_RUN},}}")


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@cache
def encoding(ranks: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file with a line per token: its bytes in Base64, its rank."""
    with open(ranks, "rb") as lines:
        of = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(ranks, pat_str=pattern, mergeable_ranks=of, special_tokens={})


def parts(text: str, size: int = PART_CHARS) -> Iterator[tuple[str, bool]]:
    """``text`` in parts, and whether a part is one match, a long run of white space.

    Other parts end at the first safe place after ``size`` characters.
    """
    begin = 0
    for run in RUN.finditer(text) if len(text) >= LONG_RUN else ():
        yield from _cut(text, begin, run.start(), size)
        begin = run.end() - (run.end() < len(text))
        yield text[run.start() : begin], True
    yield from _cut(text, begin, len(text), size)


def _cut(text: str, begin: int, end: int, size: int) -> Iterator[tuple[str, bool]]:
    while end - begin > size and (cut := SAFE.search(text, begin + size, end)):
        yield text[begin : cut.start()], False
        begin = cut.start()
    yield text[begin:end], False


def encode(docs: DataFrame, ranks: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with the column ``ids``, the token ids of each whole text, in place of the text."""

    def ids(value: bytes) -> bytes:
        found = parts(value.decode("utf-8", "replace"))
        coded = (encoding(ranks, ONE_MATCH if one else pattern).encode_ordinary(part) for part, one in found)
        return b"".join(np.array(of_part, "<u4").tobytes() for of_part in coded)

    others = [field for field in docs.schema if field.name not in (text, "ids")]
    return _mapped(docs, text_bytes(text), others, "ids", ids)


def decode(tokens: DataFrame, ranks: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``tokens`` with the column ``bytes``, what the ids stand for, byte for byte.

    The bytes of one token need not be UTF-8, so no text is made of them. Null ids stand for
    nothing: empty bytes. An id that is not in the rank file is an error.
    """

    def raw(value: bytes | None) -> bytes:
        return encoding(ranks, pattern).decode_bytes(np.frombuffer(value or b"", "<u4").tolist())

    return _mapped(tokens, F.col(ids), [field for field in tokens.schema if field.name != "bytes"], "bytes", raw)


def _mapped(df: DataFrame, source: Column, others: list[StructField], target: str, function) -> DataFrame:
    """Some columns of ``df`` and ``target``, a binary function of ``source``."""
    names = [field.name for field in others]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, len(whole), STEP_ROWS):
                batch = whole.slice(begin, STEP_ROWS)
                values = pa.array([function(value.as_py()) for value in batch.column(0)], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], values], [*names, target])

    schema = StructType([*others, StructField(target, BinaryType())])
    numbered = [F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(names)]
    return df.select(source.alias("source"), *numbered).mapInArrow(run, schema)


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and checksums of its ids and of the bytes decoded from them."""
    ranks, pattern = ranks_path(), split_pattern()
    coded = encode(documents(spark, sf_dir).select("doc_id", "text"), ranks, pattern)
    return decode(coded, ranks, pattern).select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
