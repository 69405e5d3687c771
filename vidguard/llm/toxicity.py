"""Toxicity: gradient-boosted trees over dense text features, with isotonic calibration.

Features: densities of a stated lexicon and of a lexicon learned from labelled texts (word forms and
word beginnings whose log odds of toxicity are high), their nearness to second-person words, and
rates of capitals, punctuation and obfuscation. Three disjoint folds of the learnable rows serve the
lexicon, the trees and the calibration. Each fit uses a bounded sample; scoring is a map.
"""

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written
from . import tables
from .folds import held_out, sample, third

LEXICON_ROWS, TREE_ROWS, CALIBRATION_ROWS = 8000, 8000, 12000
LEXICON_TERMS = 20_000
TREES, DEPTH = 20, 3
NEAR = 5
STRONG, WEAK, FIRM = 3.0, 1.5, 3.3

# Lexicon of insults and second-person words in the four languages of the corpus (fixed values).
INSULTS = frozenset("""
asshole bastard bitch clown coward creep crap cretin damn degenerate disgusting dumb dumbass fool
freak fuck fucking garbage hate hateful horrible idiot idiotic imbecile jerk kill liar loser lunatic
moron nasty parasite pathetic pig psycho rat retard scum shit shut slut stupid trash ugly useless
vermin vile whore worthless
arschloch abschaum blöd dumm dummkopf drecksack hässlich hure idioten müll schwein trottel versager
wertlos widerlich
connard con conne débile dégueulasse idiote imbécile merde minable moche nul nulle ordure pathétique
pourriture pute salaud salope stupide
asqueroso basura cabrón despreciable estúpido gilipollas imbécil inútil mierda patético perdedor puta
""".split())
SECOND_PERSON = frozenset("""
you your yours yourself youre u ur du dich dir dein deine deiner ihr euch sie tu te toi ton ta tes
vous votre vos tú ti tuyo usted ustedes vosotros
""".split())
PUNCTUATION = ".,;:!?*#%&$@"
WORD_LIMIT = 100_000
_LEET = str.maketrans("013457@$!|", "oieastasil")
_NOT_LETTER = regex.compile(r"[^\p{L}]+")
_MIXED = regex.compile(r"\p{L}[\d@$!|*#]+\p{L}|^[\d@$!|]\p{L}{2,}")
_STRETCH = regex.compile(r"(\p{L})\1{2,}")
_WORD = regex.compile(r"[^\x20\x09-\x0D]+")

FEATURES = ("insults", "strong", "weak", "weight", "most", "kinds", "near_second", "second",
            "capitals", "shouted", "exclaims", "punctuation", "mixed", "stretched", "hidden")


def plain(word: str) -> str:
    """Letters of a word in lower case."""
    return _NOT_LETTER.sub("", word.lower())


def unmasked(word: str) -> str:
    """Letters of a word with look-alike digits and signs read as letters, stretches shortened."""
    return _STRETCH.sub(r"\1", _NOT_LETTER.sub("", word.lower().translate(_LEET)))


def terms(word: str) -> set[str]:
    """Lexicon terms of a plain word: the word, and its beginnings of 4, 5 and 6 letters."""
    return {word} | {word[:k] + "*" for k in (4, 5, 6) if len(word) >= k} if word else set()


class Lexicon:
    """Learned term weights, and a bounded table of what each word seen so far contributes."""

    COLUMNS = 12

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        starts = {t[:-1]: w for t, w in weights.items() if t.endswith("*")}
        self._whole = {t: w for t, w in weights.items() if not t.endswith("*")}
        self._starts = starts
        self._forget()

    def weight(self, p: str) -> float:
        """The largest weight among the terms of a plain word."""
        get = self._starts.get
        return max(self._whole.get(p, 0.0), get(p[:4], 0.0) if len(p) > 3 else 0.0,
                   get(p[:5], 0.0) if len(p) > 4 else 0.0, get(p[:6], 0.0) if len(p) > 5 else 0.0)

    def _forget(self) -> None:
        self._place: dict[bytes, int] = {}
        self._table = np.zeros((1024, self.COLUMNS), np.float32)

    def describe(self, raw: bytes) -> tuple:
        """(insult, weight, second person, shouted, mixed, stretched, hidden, letters, capitals,
        exclaims, punctuation, length) of a word as it stands."""
        word = raw.decode("utf-8", "replace")
        inner = word.strip(PUNCTUATION)
        outside = len(word) - len(inner)
        marks = word.count("!") + word.count("?") if outside else 0
        if inner.isalpha() and not _STRETCH.search(inner):
            # letters only and nothing stretched: nothing can be hidden in it
            p = inner.lower()
            capitals = 0 if p == inner else sum(map(str.isupper, inner))
            return (p in INSULTS, self.weight(p), p in SECOND_PERSON,
                    len(p) > 2 and capitals == len(inner), False, False, False, len(inner),
                    capitals, marks, outside, len(word))
        p, u = plain(word), unmasked(inner)
        weight, other = self.weight(p), self.weight(u) if u != p else 0.0
        hidden = u != p and (u in INSULTS or other >= STRONG)
        return (p in INSULTS or (hidden and u in INSULTS), max(weight, other), p in SECOND_PERSON,
                len(p) > 2 and word.isupper(), bool(_MIXED.search(word)),
                bool(_STRETCH.search(word)), hidden, sum(map(str.isalpha, word)),
                sum(map(str.isupper, word)), word.count("!") + word.count("?"),
                sum(map(word.count, PUNCTUATION)), len(word))

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        place = self._place
        new = set(words).difference(place)
        if len(place) + len(new) > WORD_LIMIT:
            self._forget()
            place, new = self._place, set(words)
        while len(place) + len(new) > len(self._table):
            self._table = np.vstack([self._table, np.zeros_like(self._table)])
        for w in new:
            self._table[len(place)] = self.describe(w)
            place[w] = len(place)
        return np.fromiter(map(place.__getitem__, words), np.int64, len(words))

    def features(self, text: str | None) -> list[float]:
        """FEATURES of a whole text; all 0 without words."""
        words = text.encode("utf-8", "surrogatepass").split() if text else []
        if not words:
            return [0.0] * len(FEATURES)
        number = self._numbers(words)
        d = self._table[number]
        n, weight, total = len(words), d[:, 1], d.sum(axis=0, dtype=np.float64)
        at = np.flatnonzero((d[:, 0] > 0) | (weight >= STRONG))
        you = np.flatnonzero(d[:, 2])
        near = 0
        if len(at) and len(you):
            right = np.searchsorted(you, at)
            gap = np.minimum(np.abs(you[np.minimum(right, len(you) - 1)] - at),
                             np.abs(at - you[np.maximum(right - 1, 0)]))
            near = int((gap <= NEAR).sum())
        weak = weight >= WEAK
        return [float(v) for v in (
            total[0] / n, (weight >= STRONG).sum() / n, weak.sum() / n, weight[weak].sum() / n,
            weight.max(), np.log1p(len(np.unique(number[at]))), near / n, total[2] / n,
            total[8] / max(1, total[7]), total[3] / n, total[9] / n, total[10] / total[11],
            total[4] / n, total[5] / n, total[6] / n)]


def _term_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts per term and label of a partition of the lexicon sample."""
    n: tuple[Counter, Counter] = (Counter(), Counter())
    for pdf in batches:
        for text, label in zip(pdf["text"], pdf["label"]):
            own = {plain(w) for w in _WORD.findall(text or "")}
            n[int(label)].update(set().union(*map(terms, own)))
            n[int(label)][""] += 1
    for label, counts in enumerate(n):
        if counts:
            yield pd.DataFrame({"term": list(counts), "label": label, "n": list(counts.values())})


def learn_lexicon(texts: DataFrame) -> Lexicon:
    """Terms of ``texts(text, label)`` with high log odds: at most LEXICON_TERMS, surest first.

    FIRM is how many standard deviations the toxic texts of a term exceed their expected number.
    """
    pairs = texts.mapInPandas(_term_counts, "term string, label int, n long")
    counts = written(pairs.groupBy("term").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("t"),
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("c")))
    total = counts.where("term = ''").first()
    if total is None:
        return Lexicon({})
    toxic, clean = total["t"], total["c"]
    t, c, n = F.col("t"), F.col("c"), F.col("t") + F.col("c")
    odds = F.log((t + 0.5) / (toxic + 1.0)) - F.log((c + 0.5) / (clean + 1.0))
    share = max(toxic, 0.5) / (toxic + clean + 1.0)
    surprise = (t - n * share) / F.sqrt(n * share * (1 - share))
    best = counts.where("term <> ''").withColumns({"w": odds, "z": surprise}).where(
        (F.col("w") >= WEAK) & (F.col("z") >= FIRM))
    rows = best.orderBy(F.desc("z"), "term").limit(LEXICON_TERMS).collect()
    return Lexicon({r["term"]: float(r["w"]) for r in rows})


@dataclass
class ToxicityModel:
    """Lexicon, trees and calibration; without both labels in the samples, a constant rate."""

    lexicon: Lexicon
    trees: GBTClassificationModel | None
    curve: IsotonicRegressionModel | None
    rate: float


def _featured(docs: DataFrame, lexicon: Lexicon, keep: tuple[str, ...]) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(lexicon.weights)
    types = {"doc_id": "string", "label": "double", "__id": "long", "__text": "long"}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lex = Lexicon(sent.value)
        for pdf in batches:
            made = [lex.features(t) for t in pdf["text"]]
            yield pdf[list(keep)].assign(features=made)

    schema = ", ".join(f"{c} {types[c]}" for c in keep) + ", features array<double>"
    return tables.through_python(
        docs.select(*keep, "text"), run, schema, tuple(c for c in keep if c == "doc_id")).withColumn(
        "features", array_to_vector("features"))


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Model from bounded samples of labelled texts outside the held-out fold.

    The lexicon and the trees see as many toxic as clean texts at most; the calibration sample has
    the natural share, so scores are probabilities.
    """
    texts = docs.select("doc_id", "text")
    toxic, clean = F.col("toxic") == 1, F.col("toxic") == 0

    def taken(part: int, rows: int, balanced: bool) -> DataFrame:
        sides = [sample(labels, "toxic", third(part) & c, rows // 2) for c in (toxic, clean)]
        ids = sides[0].unionByName(sides[1]) if balanced else \
            sample(labels, "toxic", third(part), rows)
        return written(texts.join(F.broadcast(ids), "doc_id"))  # at most ``rows`` ids

    lexicon = learn_lexicon(taken(0, LEXICON_ROWS, True))
    fit = written(_featured(taken(1, TREE_ROWS, True), lexicon, ("doc_id", "label")))
    kinds = {r["label"] for r in fit.select("label").distinct().collect()}
    calibration = taken(2, CALIBRATION_ROWS, False)
    seen = calibration.agg(F.count("*").alias("n"), F.sum("label").alias("t")).first()
    rate = ((seen["t"] or 0) + 0.1) / (seen["n"] + 1)
    if len(kinds) < 2 or not seen["n"]:
        return ToxicityModel(lexicon, None, None, rate)
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=TREES, maxDepth=DEPTH,
                          stepSize=0.3, minInstancesPerNode=5, seed=7).fit(fit)
    raw = _margin(trees, _featured(calibration, lexicon, ("doc_id", "label")))
    curve = IsotonicRegression(featuresCol="margin", labelCol="label").fit(written(
        raw.select("label", "margin")))
    return ToxicityModel(lexicon, trees, curve, rate)


def _margin(trees: GBTClassificationModel, featured: DataFrame) -> DataFrame:
    return trees.transform(featured).withColumn(
        "margin", vector_to_array("probability")[1]).drop("rawPrediction", "probability",
                                                          "prediction")


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs(doc_id, text)``.

    Null and empty texts have all features 0 and get the score of such a text; very long ones are read
    whole. Rows are independent: repeated rows and null ids (held out) each give a row, an empty table
    none. Other columns are ignored, whatever their names.
    """
    if model.trees is None:
        scored = docs.select("doc_id", F.lit(model.rate).alias("score"))
    else:
        raw = _margin(model.trees, _featured(docs, model.lexicon, ("doc_id",)))
        scored = model.curve.transform(raw).select(
            "doc_id", F.least(F.greatest("prediction", F.lit(0.0)), F.lit(1.0)).alias("score"))
    return scored.select(F.col("doc_id").cast("long").alias("doc_id"),
                         held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs`` that score below the threshold; all columns as they were."""
    if model.trees is None:
        return docs if model.rate < threshold else docs.limit(0)
    keyed = tables.row_key(docs.select("doc_id", "text"))
    raw = _margin(model.trees, _featured(keyed, model.lexicon, ("__id", "__text")))
    return tables.without(docs, model.curve.transform(raw).where(F.col("prediction") >= threshold))
