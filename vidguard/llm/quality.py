"""Text quality: hashed word n-gram logistic regression trained with FTRL-proximal updates.

Features are hashed one- and two-word sequences, of the words themselves and of their shapes (runs
of letters, digits and other characters; a word equal to the one before has a shape of its own).
A text is a sparse unit vector; its score is the logistic of one sparse dot product.
The fit uses a bounded sample of labelled rows in one task; scoring is a map without a shuffle.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written
from . import tables
from .folds import held_out, sample
from .words import mix, word_hashes, words

BITS = 20
FIT_ROWS = 8000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
_LETTERS, _DIGITS = regex.compile(r"\p{L}+"), regex.compile(r"\p{N}+")
_MANY = regex.compile(r"(.)\1+")


class _Shapes(dict):
    """Word -> hash of its shape; emptied when full, so a worker's memory is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 300_000:
            self.clear()
        text = word.decode("utf-8", "replace")
        text = "a" if text.isalpha() else _DIGITS.sub("0", _LETTERS.sub("a", text))
        shape = b"\x00" + _MANY.sub(r"\1\1", text)[:12].encode()
        value = self[word] = xxhash.xxh3_64_intdigest(shape)
        return value


_shapes = _Shapes()


def _grams(h: np.ndarray) -> np.ndarray:
    two = mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])
    return np.concatenate([h, two])


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted feature numbers and values (a unit vector) of a whole text; nothing for no words."""
    tokens = words(text)
    h = word_hashes(tokens)
    s = np.fromiter(map(_shapes.__getitem__, tokens), np.uint64, len(tokens))
    s[1:][h[1:] == h[:-1]] = np.uint64(0x243F6A8885A308D3)
    hashed = mix(np.concatenate([_grams(h), _grams(s)])) >> np.uint64(64 - BITS)
    index, n = np.unique(hashed.astype(np.int32), return_counts=True)
    value = np.log1p(n)
    return index, (value / max(1e-9, np.sqrt((value ** 2).sum()))).astype(
        np.float32)


def _sparse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for at in range(0, len(pdf), 500):
            part = pdf.iloc[at:at + 500]
            made = [features(t) for t in part["text"]]
            yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(),
                                "label": part["label"].to_numpy(),
                                "index": [i for i, _ in made], "value": [v for _, v in made]})


def ftrl(rows: list[tuple[float, np.ndarray, np.ndarray]], prior: float) -> np.ndarray:
    """Weights after EPOCHS passes of per-coordinate FTRL-proximal; the last one is the intercept."""
    z, n = np.zeros(2 ** BITS), np.zeros(2 ** BITS)
    bias = np.log(prior / (1 - prior))

    def weights(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        shrunk = np.sign(zi) * np.maximum(0.0, np.abs(zi) - L1)
        return -shrunk / ((BETA + np.sqrt(ni)) / ALPHA + L2)

    for _ in range(EPOCHS):
        for label, index, value in rows:
            w = weights(z[index], n[index])
            p = 1 / (1 + np.exp(-np.clip(bias + 10 * (w @ value), -30, 30)))
            g = 10 * (p - label) * value
            sigma = (np.sqrt(n[index] + g * g) - np.sqrt(n[index])) / ALPHA
            z[index] += g - sigma * w
            n[index] += g * g
    return np.append(10 * weights(z, n), bias).astype(np.float32)


def _fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen = [(d, y, np.asarray(i, np.int64), np.asarray(v, np.float64)) for pdf in batches
            for d, y, i, v in zip(pdf["doc_id"], pdf["label"], pdf["index"], pdf["value"])]
    seen.sort(key=lambda r: (hash_order(r[0]), r[0], r[2].tobytes()))
    rows = [r[1:] for r in seen]
    prior = (sum(r[0] for r in rows) + 1) / (len(rows) + 2)
    w = ftrl(rows, prior)
    at = np.flatnonzero(w)
    yield pd.DataFrame({"index": at.astype(np.int32), "weight": w[at].astype(np.float64)})


def hash_order(key: int) -> int:
    return int(mix(np.array([key], np.int64).view(np.uint64))[0])


def fit_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> np.ndarray:
    """Weights from at most ``fit_rows`` labelled texts outside the held-out fold.

    Without a labelled text all weights are 0 and the intercept is that of even odds.
    """
    chosen = sample(labels, "quality", F.lit(True), fit_rows)
    # fit_rows ids bound the broadcast
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = written(texts.mapInPandas(
        _sparse, "doc_id long, label double, index array<int>, value array<float>"))
    model = rows.coalesce(1).mapInPandas(_fit, "index int, weight double").toPandas()
    weights = np.zeros(2 ** BITS + 1, np.float32)
    weights[model["index"].to_numpy(np.int64)] = model["weight"].to_numpy()
    return weights


def score_quality(docs: DataFrame, weights: np.ndarray, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs(doc_id, text)``.

    Null and empty texts have no feature and score as the intercept says, like an unknown text; very
    long ones are read whole. Rows are independent: repeated rows and null ids (held out) each give a
    row, an empty table none. Other columns are ignored, whatever their names.
    """
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = sent.value
        for pdf in batches:
            made = [features(t) for t in pdf["text"]]
            dot = np.array([float(w[i] @ v) for i, v in made]) + float(w[-1])
            yield pd.DataFrame({"doc_id": pdf["doc_id"],
                                "score": 1 / (1 + np.exp(-np.clip(dot, -30, 30)))})

    scored = tables.through_python(
        docs.select("doc_id", "text"), run, "doc_id string, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
