"""Words and their hashes, inside tasks."""

import numpy as np
import xxhash

# Letters A-Z to lower case, ASCII punctuation and control characters to blanks.
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)


def plain_words(text: bytes) -> list[bytes]:
    """Lower-case words without ASCII punctuation."""
    return text.translate(_PLAIN).split()


class WordHashes(dict):
    """Hashes of words, remembered up to a bound per worker."""

    def __init__(self, most: int = 500_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
