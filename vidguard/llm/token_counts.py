"""Token counts under a word-end BPE vocabulary, by rank-synchronous array merging.

Texts are cut into pre-tokens by the rules the vocabulary file states (composed form, white space,
lower case, letter runs, single digits, other runs). Distinct pre-tokens of a batch are held as one
ragged array of symbols; each round finds the lowest-ranked adjacent pair of every sequence and
merges its occurrences in all sequences at once. Surviving symbols are counted. A worker remembers
the counts of short words in a bounded table, so frequent words are merged once.
"""

import json
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from . import tables

WORD_LIMIT = 400_000
LONG_WORD = 64
# white space as the vocabulary's patterns mean it (Unicode White_Space); fixed values
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPLIT = regex.compile(f"[{_SPACE}]+")
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^" + _SPACE + r"\p{L}\p{N}]+")
_NOT_SPACE = regex.compile(r"[\x1c-\x1f]")  # str.split() takes these for white space


def _byte_chars() -> list[str]:
    """Printable stand-ins of the 256 bytes: themselves, or the next code point from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    moved = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + moved.index(b)) for b in range(256)]


class Vocabulary:
    """Merge table of a vocabulary file as sorted arrays, with a bounded table of word counts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        specials = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        chars = _byte_chars()
        self.inner = np.array([ids[c] for c in chars], np.int64)
        self.last = np.array([ids[c + end] for c in chars], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([ids[a] << 20 | ids[b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order
        self.made = np.array([ids[a + b] for a, b in merges], np.int64)
        self.counts: dict[str, int] = {}

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 20 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], len(self.keys))

    def survivors(self, pieces: list[bytes]) -> np.ndarray:
        """Symbols left of each non-empty piece once no adjacent pair can merge."""
        size = np.array([len(p) for p in pieces], np.int64)
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        owner = np.repeat(np.arange(len(pieces)), size)
        symbols = self.inner[raw]
        ends = np.cumsum(size) - 1
        symbols[ends] = self.last[raw[ends]]
        total, none = size.copy(), len(self.keys)
        while len(symbols) > 1:
            rank = np.full(len(symbols), none, np.int64)
            inside = owner[1:] == owner[:-1]
            rank[:-1][inside] = self._rank(symbols[:-1][inside], symbols[1:][inside])
            starts = np.flatnonzero(np.concatenate([[True], ~inside]))
            least = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.append(starts, len(symbols)))
            low = np.repeat(least, lengths)
            hit = (rank == low) & (rank < none)
            if not hit.any():
                break
            # of overlapping occurrences (a run of one symbol) every other one merges
            before = np.concatenate([[False], hit[:-1]])
            index = np.arange(len(hit))
            since = index - np.maximum.accumulate(np.where(hit & ~before, index, 0))
            hit &= since % 2 == 0
            symbols[hit] = self.made[rank[hit]]
            gone = np.concatenate([[False], hit[:-1]])
            total -= np.bincount(owner[gone], minlength=len(total))
            live = np.repeat(least < none, lengths) & ~gone
            symbols, owner = symbols[live], owner[live]
        return total

    def _learn(self, words: list[str]) -> list[int]:
        """Token counts of distinct non-empty words without white space."""
        pieces = [_PIECES.findall(w) for w in words]
        flat = [p.encode("utf-8", "surrogatepass") for ps in pieces for p in ps]
        if not flat:
            return [0] * len(words)
        distinct = list(dict.fromkeys(flat))
        known = dict(zip(distinct, self.survivors(distinct).tolist()))
        sums = iter(flat)
        return [sum(known[next(sums)] for _ in ps) for ps in pieces]

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of every text. Special strings are one token each and end words around them."""
        per_text, extra = [], []
        for text in texts:
            specials = 0
            parts = [text]
            if self.special and "<|" in text:
                parts = self.special.split(text)
                specials = len(parts) - 1
            words: list[str] = []
            for part in parts:
                part = part if part.isascii() else unicodedata.normalize("NFC", part)
                # lower case by single characters: no word-final form of sigma
                part = part.replace("Σ", "σ").lower()
                words += [w for w in _SPLIT.split(part) if w] if _NOT_SPACE.search(part) \
                    else part.split()
            per_text.append(words)
            extra.append(specials)
        new = list(set().union(*per_text).difference(self.counts))
        short = [w for w in new if len(w) <= LONG_WORD]
        if len(self.counts) + len(short) > WORD_LIMIT:
            self.counts = {}
            new = list(set().union(*per_text))
            short = [w for w in new if len(w) <= LONG_WORD]
        found = dict(zip(new, self._learn(new)))
        self.counts.update((w, found[w]) for w in short)
        look = self.counts if len(short) == len(new) else _Either(self.counts, found)
        return [sum(map(look.__getitem__, ws)) + n for ws, n in zip(per_text, extra)]


class _Either:
    def __init__(self, first: dict, second: dict):
        self.first, self.second = first, second

    def __getitem__(self, key):
        value = self.first.get(key)
        return self.second[key] if value is None else value


@cache
def vocabulary(path: str) -> Vocabulary:
    """One per worker and file."""
    return Vocabulary(path)


def token_counts(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs(doc_id, text)``.

    Null texts count as empty: 0 bytes, 0 tokens. Rows are independent, so repeated rows and null
    ids come back as they are. Very long texts are counted whole, other columns ignored, whatever their
    names; an empty table gives no rows. Nothing is shuffled. ``path`` must exist on every worker.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocab = vocabulary(path)
        for pdf in batches:
            for at in range(0, len(pdf), 256):
                part = pdf.iloc[at:at + 256]
                texts = [t or "" for t in part["text"]]
                n = np.array(vocab.count(texts), np.int64)
                yield pd.DataFrame({
                    "doc_id": part["doc_id"], "n_bytes": [len(t.encode()) for t in texts],
                    "n_tokens": n, "over_limit": n > limit}, index=part.index)

    return tables.through_python(
        docs.select("doc_id", "text"), run,
        "doc_id string, n_bytes long, n_tokens long, over_limit boolean")
