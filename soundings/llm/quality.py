"""Quality of documents: ridge regression on random Fourier features, calibrated isotonically."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soundings.llm.labelled import fold, labelled_sample

_SETS = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789",
         b".,;:!?'\"()-", b"|*%$&#@~^_<>{}[]\\/=+", b" \t\r\n")
STATISTICS = 19


def text_statistics(text: str) -> list[float]:
    """Numbers that describe a text: lengths, kinds of characters, repetition, line structure."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    counts = np.bincount(raw, minlength=256).astype(float)
    total = max(1.0, counts.sum())
    words = text.split()
    n = max(1, len(words))
    tally = Counter(words)
    top = max(tally.values(), default=0)
    lines = text.split("\n")
    share = counts[counts > 0] / total
    lengths = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    return [
        math.log1p(len(text)),
        math.log1p(len(words)),
        float(lengths.mean()),
        float(lengths.std()),
        math.log1p(float(lengths.max())),
        len(tally) / n,
        len(tally) / math.sqrt(n),
        top / n,
        sum(map(eq, words, words[1:])) / n,
        *(float(counts[list(s)].sum() / total) for s in _SETS),
        float((counts[128:]).sum() / total),
        float(-(share * np.log(share)).sum()) if len(share) else 0.0,
        len(set(lines)) / len(lines),
        math.log1p(len(text) / len(lines)),
    ]


@dataclass
class QualityModel:
    mean: np.ndarray
    spread: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    levels: np.ndarray

    def fourier(self, statistics: np.ndarray) -> np.ndarray:
        """Features whose inner products approximate a Gaussian kernel, and a constant."""
        x = np.clip((statistics - self.mean) / self.spread, -8, 8)
        waves = np.cos(x @ self.directions + self.phases) * math.sqrt(2 / len(self.phases))
        return np.column_stack([waves, np.ones(len(x))])

    def raw(self, statistics: np.ndarray) -> np.ndarray:
        return self.fourier(statistics) @ self.weights

    def score(self, statistics: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(statistics), self.steps, self.levels), 0, 1)


def isotonic(value: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to `value` in squares weighted by `count`."""
    blocks: list[list[float]] = []
    for v, c in zip(value, count, strict=True):
        blocks.append([v, c, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, c2, n2 = blocks.pop()
            v1, c1, n1 = blocks.pop()
            blocks.append([(v1 * c1 + v2 * c2) / (c1 + c2), c1 + c2, n1 + n2])
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    most_labelled: int = 20_000,
    features: int = 256,
    width: float = 6.0,
    ridge: float = 1.0,
    seed: int = 5,
) -> QualityModel:
    """Fits on at most `most_labelled` labelled rows, three quarters of them for the ridge.

    Every partition sums its part of the normal equations; Spark adds the parts up and the driver
    solves one system of `features` unknowns. The other quarter gives the calibration, from score
    counts in at most a thousand steps. Without any labels every score is 0.5.
    """
    sample = labelled_sample(docs, labels, "quality", usable, most_labelled)

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = [text_statistics(text) for text in batch["text"]]
            yield pd.DataFrame({"x": x, "y": batch["y"].astype(float), "part": batch["part"]})

    part = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(4)).alias("part")
    table = sample.select("text", "y", part).mapInPandas(
        measured, "x array<double>, y double, part long"
    )
    moments = table.agg(
        F.count("*"),
        *[F.avg(F.col("x")[k]) for k in range(STATISTICS)],
        *[F.stddev_pop(F.col("x")[k]) for k in range(STATISTICS)],
    ).first()
    rng = np.random.default_rng(seed)
    model = QualityModel(
        mean=np.array([m or 0.0 for m in moments[1 : 1 + STATISTICS]]),
        spread=np.array([max(s or 0.0, 1e-6) for s in moments[1 + STATISTICS :]]),
        directions=rng.normal(0, 1 / width, (STATISTICS, features)) * math.sqrt(2),
        phases=rng.uniform(0, 2 * math.pi, features),
        weights=np.zeros(features + 1),
        steps=np.array([0.0]),
        levels=np.array([0.5]),
    )
    if not moments[0]:
        return model

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((features + 1, features + 2))
        for batch in batches:
            z = model.fourier(np.array(batch["x"].tolist()).reshape(-1, STATISTICS))
            total += z.T @ np.column_stack([z, batch["y"].to_numpy()])
        yield pd.DataFrame({"line": np.arange(len(total)), "sums": list(total)})

    def added(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"line": [key[0]], "sums": [np.sum(rows["sums"].tolist(), axis=0)]})

    kind = "line long, sums array<double>"
    parts = table.filter("part <> 0").mapInPandas(summed, kind)
    lines = parts.groupBy("line").applyInPandas(added, kind).collect()
    sums = np.zeros((features + 1, features + 2))
    for line, values in lines:
        sums[line] = values
    ridges = ridge * np.eye(features + 1)
    ridges[-1, -1] = 1e-6
    model.weights = np.linalg.solve(sums[:, :-1] + ridges, sums[:, -1])

    @F.pandas_udf("double")
    def raw(x: pd.Series) -> pd.Series:
        return pd.Series(model.raw(np.array(x.tolist()).reshape(-1, STATISTICS)))

    step = F.round(F.greatest(F.lit(-1.0), F.least(F.lit(2.0), raw("x"))) * 333).cast("int")
    held = table.filter("part = 0").groupBy(step.alias("step"))
    bins = sorted(held.agg(F.avg("y"), F.count("*")).collect())
    if bins:
        value = np.array([b[1] for b in bins])
        count = np.array([b[2] for b in bins], float)
        model.steps = np.array([b[0] for b in bins]) / 333
        model.levels = isotonic(value, count)
    else:
        model.steps, model.levels = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def quality_score(model: QualityModel, text: Column) -> Column:
    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype=float)
        return pd.Series(model.score(np.array([text_statistics(t) for t in texts])))

    return scored(F.coalesce(text.cast("string"), F.lit("")))


def score_quality(
    docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2
) -> DataFrame:
    """doc_id, held_out, score and predicted (score of 0.7 or more) of every document.

    Labels are learned only where `fold(folds)` is not `held`. Null texts score as empty ones;
    repeated rows get equal scores. An empty table gives no rows.
    """
    model = fit_quality(docs, labels, fold(folds) != held)
    scored = docs.select(
        "doc_id",
        (fold(folds) == held).alias("held_out"),
        quality_score(model, F.col("text")).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))
