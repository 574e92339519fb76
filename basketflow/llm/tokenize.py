"""Texts to token ids with a byte-level BPE tokenizer of the ``tokenizers`` library.

A byte-level tokenizer always begins a new word at a blank before a non-blank, so what lies between
two such places can be encoded alone. Words repeat, so the tokenizer sees each piece once; texts
are put together from the pieces' ids.
"""

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

BORDER = re.compile(r" (?=\S)")
# Texts in which white space or the end follows a blank are cut by BORDER, all others at blanks.
SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
LOOSE = f" (?:[{SPACES}]|$)"
REMEMBERED = 1_000_000  # pieces known at a time
TOGETHER = 4096  # new pieces encoded in one text
STEP_BYTES = 1 << 23  # text looked at in one step


class Pieces(dict):
    """Numbers of pieces in the order of their first appearance."""

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        return number


class Encoder:
    """Encodes whole texts; ids as little-endian bytes, ``width`` bytes each."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.width = 2 if size <= 1 << 16 else 4
        self.type = f"<u{self.width}"
        blank = self.tokenizer.pre_tokenizer.pre_tokenize_str(" ")[0][0]
        self.begins = np.zeros(size, bool)
        self.begins[[n for token, n in self.tokenizer.get_vocab().items() if token.startswith(blank)]] = True
        self._forget()

    def _forget(self) -> None:
        self.pieces, self.encoded = Pieces(), 0
        self.ids, self.first, self.length = np.zeros(0, self.type), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def pack(self, ids: Iterable[int]) -> bytes:
        return np.array(ids, self.type).tobytes()

    def encode(self, texts: pa.StringArray) -> Iterator[bytes]:
        """The ids of each text, in order."""
        size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        begin = 0
        while begin < len(texts):
            before = size[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(size, before + STEP_BYTES)))
            yield from self._encode(texts[begin:end])
            begin = end

    def _encode(self, texts: pa.StringArray) -> list[bytes]:
        if len(self.pieces) > REMEMBERED:
            self._forget()
        loose = pc.match_substring_regex(texts, LOOSE).to_numpy(zero_copy_only=False)
        found = np.empty(len(texts), object)
        found[~loose] = self._of_pieces(pc.split_pattern(texts.filter(pa.array(~loose)), " "))
        by_border = [BORDER.split(t) for t in texts.filter(pa.array(loose)).to_pylist()]
        found[loose] = self._of_pieces(pa.array(by_border, pa.list_(pa.string())))
        return found.tolist()

    def _of_pieces(self, texts: pa.ListArray) -> list[bytes]:
        """The ids of texts given as pieces; all but the first piece lack the blank before them."""
        if not len(texts):
            return []
        pieces, count = texts.flatten(), pc.list_value_length(texts).to_numpy()
        head = np.cumsum(count) - count
        is_head = np.zeros(len(pieces), bool)
        is_head[head] = True
        coded = pieces.filter(pa.array(~is_head)).dictionary_encode()
        known = coded.dictionary.to_pylist()
        numbers = np.fromiter(map(self.pieces.__getitem__, known), np.int64, len(known))
        self._learn()
        row = numbers[coded.indices.to_numpy()]
        length = self.length[row]
        ends = np.concatenate(([0], np.cumsum(length)))
        ids = self.ids[np.repeat(self.first[row] - ends[:-1], length) + np.arange(ends[-1])].tobytes()
        borders = (ends[np.concatenate(([0], np.cumsum(count - 1)))] * self.width).tolist()
        begins = self.tokenizer.encode_batch_fast(pieces.take(pa.array(head)).to_pylist(), add_special_tokens=False)
        spans = zip(begins, borders, borders[1:], strict=False)
        return [self.pack(begin.ids) + ids[a:b] for begin, a, b in spans]

    def _learn(self) -> None:
        """Encodes the pieces numbered since the last time, each with the blank before it."""
        new = list(self.pieces)[self.encoded :]
        ids, lengths = [self.ids], [self.length]
        for i in range(0, len(new), TOGETHER):
            some = new[i : i + TOGETHER]
            joined = self._one(" " + " ".join(some))
            starts = np.flatnonzero(self.begins[joined])
            if len(starts) != len(some):  # a piece holds blanks of its own
                parts = [self._one(" " + piece) for piece in some]
                joined, length = np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
            else:
                length = np.diff(np.append(starts, len(joined)))
            ids.append(joined)
            lengths.append(length)
        self.encoded += len(new)
        self.ids, self.length = np.concatenate(ids), np.concatenate(lengths)
        self.first = np.cumsum(self.length) - self.length

    def _one(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.type)
