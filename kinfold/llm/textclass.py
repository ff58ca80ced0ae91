"""What the two text classifiers share: a bounded training sample, a vocabulary of hashed words, sparse rows.

Training data is bounded by parameters (rows, vocabulary); scoring reads every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from kinfold.llm.common import batches, word_hashes
from kinfold.session import materialize


@dataclass(frozen=True)
class Vocabulary:
    """Sorted word hashes; a word is known by its place."""

    hashes: np.ndarray

    def places(self, words: np.ndarray) -> np.ndarray:
        if not len(self.hashes) or not len(words):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
        return at[self.hashes[at] == words]


def hashed_rows(sample: DataFrame) -> DataFrame:
    """(grade, words): the distinct word hashes of each sampled (grade, text) row, stored."""

    def step(grade, text):
        return {"grade": grade, "words": [np.unique(word_hashes(t)).view(np.int64) for t in text]}

    return materialize(batches(sample.select("grade", "text"), step, "grade int, words array<bigint>"), "sample")


def fit_vocabulary(rows: DataFrame, min_rows: int = 5, size: int = 1 << 12, min_z: float = 3.5) -> Vocabulary:
    """The up to ``size`` words whose sampled rows differ most in mean grade from all sampled rows.

    A word counts from ``min_rows`` rows and a difference of ``min_z`` standard errors on, so that a small sample does not teach
    the many words that are rare by nature.
    """
    n, mean, sd = rows.agg(F.count(F.lit(1)), F.avg("grade"), F.stddev_pop("grade")).first()
    if not n or not sd:
        return Vocabulary(np.zeros(0, np.uint64))
    counted = rows.select("grade", F.explode("words").alias("word")).groupBy("word")
    means = counted.agg(F.count(F.lit(1)).alias("n"), F.avg("grade").alias("mean")).filter(F.col("n") >= min_rows)
    error = F.lit(sd) * F.sqrt((1 - F.col("n") / F.lit(n + 1)) / F.col("n"))
    strong = means.withColumn("z", F.abs(F.col("mean") - mean) / error).filter(F.col("z") >= min_z)
    top = strong.orderBy(F.desc("z"), "word").limit(size).select("word").collect()
    return Vocabulary(np.sort(np.array([r[0] for r in top], dtype=np.int64).view(np.uint64)))


def collect_rows(rows: DataFrame, vocabulary: Vocabulary) -> tuple[np.ndarray, list[np.ndarray]]:
    """Grades and known word places of the sampled rows, in a fixed order. Bounded by sample and vocabulary."""

    def step(grade, words):
        places = [vocabulary.places(np.array(w, dtype=np.int64).view(np.uint64)).tolist() for w in words]
        return {"grade": grade, "places": places}

    made = [(r[0], r[1]) for r in batches(rows, step, "grade int, places array<int>").collect()]
    made.sort()
    return np.array([g for g, _ in made], dtype=np.int64), [np.array(p, dtype=np.int64) for _, p in made]


class Sparse:
    """Rows of word places with one weight per row, for products with a weight vector."""

    def __init__(self, rows: list[np.ndarray]):
        self.n = len(rows)
        self.columns = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        self.row = np.repeat(np.arange(self.n), [len(r) for r in rows])

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.columns], minlength=self.n)

    def spread(self, by_row: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.columns, by_row[self.row], minlength=size)


class Adam:
    """Adam steps over one vector (Kingma and Ba, 2015)."""

    def __init__(self, size: int, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(size), np.zeros(size), 0, rate

    def step(self, weights: np.ndarray, gradient: np.ndarray) -> None:
        self.t += 1
        self.m += 0.1 * (gradient - self.m)
        self.v += 0.001 * (gradient * gradient - self.v)
        weights -= self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))
