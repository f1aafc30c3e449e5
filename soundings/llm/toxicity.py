"""Toxicity by a weighted lexicon, matched in folded text and normalised by length."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soundings.llm.labelled import fold, labelled_sample

# Letters that look like Latin ones, and signs written for letters.
_LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ј": "j",
    "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g", "ł": "l", "ø": "o",
}
_SIGNS = {
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i",
}
#: Harmless phrases around words that are often abusive; more are learned.
_PHRASES = ("trash can", "trash bin", "clown fish", "pathetic fallacy", "sore loser award")

_SPLIT = re.compile(r"[\W\d_]+")
_FULLWIDTH = {0xFF41 + k: chr(ord("a") + k) for k in range(26)}
_HIDDEN = {0x200B: None, 0x200C: None, 0x200D: None, 0xAD: None, 0xFEFF: None}
_TABLE = str.maketrans(_LOOKALIKES | _SIGNS) | _FULLWIDTH | _HIDDEN


def folded(text: str) -> str:
    """Lower-case words between single spaces, look-alike letters and signs as letters."""
    return " " + _SPLIT.sub(" ", text.lower().translate(_TABLE)).strip() + " "


@dataclass
class ToxicityModel:
    """Weights of word beginnings (or of whole words, ending in a space), and a calibration."""

    lexicon: dict[str, float] = field(default_factory=dict)
    phrases: tuple[str, ...] = _PHRASES
    coefficients: tuple[float, float, float] = (-3.0, 1.0, 1.0)

    def automaton(self):
        import ahocorasick

        matcher = ahocorasick.Automaton()
        for term, weight in self.lexicon.items():
            matcher.add_word(" " + term, (len(term), weight))
        for phrase in self.phrases:
            if self.lexicon:
                matcher.add_word(f" {phrase} ", (len(phrase), None))
        if self.lexicon:
            matcher.make_automaton()
        return matcher

    def hits(self, text: str, matcher) -> dict[int, float]:
        """The weight of each word that begins like a term, by place in the folded text."""
        found: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        if not self.lexicon:
            return found
        for end, (size, weight) in matcher.iter(text):
            start = end - size if weight is not None else end - size - 1
            if weight is None:
                spared.append((start, end))
            else:
                found[start] = max(found.get(start, 0.0), weight)
        for start, end in spared:
            for at in range(start, end):
                found.pop(at, None)
        return found

    def features(self, text: str, matcher) -> tuple[float, float]:
        """The summed weights, and their share in a text of that length, both on a log scale."""
        text = folded(text)
        total = sum(self.hits(text, matcher).values())
        words = text.count(" ")
        return math.log1p(total), math.log1p(100 * total / (words + 20))

    def score(self, total: float, share: float) -> float:
        base, by_total, by_share = self.coefficients
        x = base + by_total * total + by_share * share
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    most_labelled: int = 20_000,
    most_terms: int = 2_000,
) -> ToxicityModel:
    """Learns the lexicon, the exception phrases and the calibration.

    A term is the beginning of a word, 4 to 8 letters long, or a whole word. Its weight is the
    lower end of its log odds ratio between toxic and other documents. Of the labelled rows at
    most `most_labelled` are used, of the terms the best `most_terms` are kept; these bounds also
    bound what reaches the driver. Without labels of both kinds nothing is learned and every
    document gets the share of toxic labels as its score (0 without any labels).
    """
    sample = labelled_sample(docs, labels, "toxic", usable, most_labelled)
    counts = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    positive, negative = counts.get(1, 0), counts.get(0, 0)
    if not positive or not negative:
        share = positive / (positive + negative) if positive + negative else 0.0
        odds = math.log(max(share, 1e-6) / max(1 - share, 1e-6))
        return ToxicityModel(coefficients=(odds, 0.0, 0.0))
    tallies = _tally(sample, _terms_of)
    ratio = F.log((F.col("yes") + 0.5) / (positive - F.col("yes") + 0.5)) - F.log(
        (F.col("no") + 0.5) / (negative - F.col("no") + 0.5)
    )
    spread = F.sqrt(1 / (F.col("yes") + 0.5) + 1 / (F.col("no") + 0.5))
    best = (
        tallies.filter("yes >= 3")
        .select("term", (ratio - 1.5 * spread).alias("weight"))
        .filter("weight >= 2")
        .orderBy(F.desc("weight"), F.length("term"), "term")
        .limit(most_terms)
        .collect()
    )
    lexicon: dict[str, float] = {}
    for term, weight in best:
        if not any(term[:k] in lexicon for k in range(4, len(term))):
            lexicon[term] = weight
    model = ToxicityModel(lexicon)
    phrases = (
        _tally(sample, _phrases_of(model))
        .filter("yes = 0 and no >= 5")
        .orderBy(F.desc("no"), "term")
        .limit(most_terms)
        .collect()
    )
    model.phrases = _PHRASES + tuple(r["term"] for r in phrases)

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = model.automaton()
        for batch in batches:
            rows = [model.features(text, matcher) for text in batch["text"]]
            yield pd.DataFrame(rows, columns=["total", "share"]).assign(y=batch["y"].to_numpy())

    points = sample.mapInPandas(measured, "total double, share double, y int").toPandas()
    model.coefficients = _logistic(points[["total", "share"]].to_numpy(), points["y"].to_numpy())
    return model


def _terms_of(text: str) -> set[str]:
    words = set(folded(text).split())
    terms = {word + " " for word in words if len(word) > 2}
    for size in range(4, 9):
        terms.update(word[:size] for word in words if len(word) >= size)
    return terms


def _phrases_of(model: ToxicityModel) -> Callable[[str], set[str]]:
    matcher: list = []

    def phrases(text: str) -> set[str]:
        if not matcher:
            matcher.append(model.automaton())
        text = folded(text)
        found = set()
        for at in model.hits(text, matcher[0]):
            before = text[text.rfind(" ", 0, at) + 1 : at]
            end = text.index(" ", at + 1)
            word, after = text[at + 1 : end], text[end + 1 : text.find(" ", end + 1)]
            if before:
                found.add(f"{before} {word}")
            if after:
                found.add(f"{word} {after}")
        return found

    return phrases


def _tally(sample: DataFrame, terms_of: Callable[[str], set[str]]) -> DataFrame:
    """(term, yes, no): in how many toxic and other documents a term is."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                tallies = (Counter(), Counter())
                for text, y in zip(part["text"], part["y"], strict=True):
                    tallies[int(y)].update(terms_of(text))
                terms = list(tallies[0].keys() | tallies[1].keys())
                if not terms:
                    continue
                yield pd.DataFrame({
                    "term": terms,
                    "yes": [tallies[1][t] for t in terms],
                    "no": [tallies[0][t] for t in terms],
                })

    found = sample.mapInPandas(counted, "term string, yes long, no long")
    return found.groupBy("term").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton steps, with slopes that are never negative."""
    design = np.column_stack([np.ones(len(x)), x])
    weights = np.zeros(3)
    ridge = np.diag([1e-3, 0.1, 0.1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        gradient = design.T @ (y - p) - ridge @ weights
        hessian = (design * (p * (1 - p))[:, None]).T @ design + ridge
        step = np.linalg.solve(hessian, gradient)
        weights += step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    for k in (1, 2):
        if weights[k] < 0:
            other = _logistic(np.column_stack([x[:, 2 - k], np.zeros(len(x))]), y)
            return (other[0], 0.0, max(0.0, other[1])) if k == 1 else (other[0], max(0.0, other[1]), 0.0)
    return tuple(float(w) for w in weights)


def toxicity_score(model: ToxicityModel, text: Column) -> Column:
    """Score of a text between 0 and 1; a null text scores as an empty one."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = model.automaton()
        for texts in batches:
            yield pd.Series([model.score(*model.features(t, matcher)) for t in texts], dtype=float)

    return scored(F.coalesce(text.cast("string"), F.lit("")))


def score_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, score and predicted (score of 0.5 or more) of every document.

    Labels are learned only where `fold(folds)` is not 0; held_out tells where it is 0. Repeated
    rows get equal scores. An empty table gives no rows; an empty `labels` the score 0.
    """
    model = fit_toxicity(docs, labels, fold(folds) != 0)
    scored = docs.select(
        "doc_id",
        (fold(folds) == 0).alias("held_out"),
        toxicity_score(model, F.col("text")).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """`docs` without the documents predicted to be toxic."""
    model = fit_toxicity(docs, labels, fold(folds) != 0)
    return docs.filter(toxicity_score(model, F.col("text")) < 0.5)
