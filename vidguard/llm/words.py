"""Words, word hashes and shingle hashes shared by the text operators.

A word is ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased; a shingle is five consecutive words, or
the whole sequence of a shorter text. Shingles are compared by 64-bit hashes that depend on the words
alone, so every task and every run computes the same ones.
"""

import numpy as np
import xxhash

SIZE = 5
_CACHE_WORDS = 100_000
_M64 = (1 << 64) - 1
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


class _Hashes(dict):
    """word -> 64-bit hash; emptied when full, so a worker's memory is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _Hashes()


def words(text: str | None) -> list[bytes]:
    """Lower-cased words in UTF-8. Bytes split on exactly space, tab, LF, VT, FF and CR."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, tokens), np.uint64, len(tokens))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(tokens: list[bytes]) -> np.ndarray:
    """One hash per shingle, in text order, repeats kept. Empty without words."""
    h = word_hashes(tokens)
    n = min(SIZE, len(h))
    if n == 0:
        return h
    total = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        total += mix(h[i:len(h) - n + 1 + i]) * _ODD[i]
    return mix(total)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    return np.unique(shingle_hashes(words(text)))
