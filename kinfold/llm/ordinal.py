"""Quality by ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features is shared by all grades; ordered thresholds t_1 < t_2 < ... part the score axis:
P(grade <= k) = sigmoid(t_k - w x). A text's expected grade is the sum of its tail probabilities P(grade >= k), and the tail probability at the wanted
grade selects. Thresholds stay ordered because their gaps are exponentials.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from kinfold.llm.common import batches, hash_share, share, word_hashes
from kinfold.llm.textclass import Adam, Sparse, Vocabulary, collect_rows, fit_vocabulary, sigmoid
from kinfold.session import materialize

SIGNS = re.compile(r"[^\w\s]+")
BINS = 12  # steps of each share that is hashed as a feature


def shape_features(text: str) -> list[str]:
    """How the text looks: shares of capitals, signs, digits and repeated words, and its most frequent signs, each cut into steps."""
    n = max(1, len(text))
    words = text.split()
    byte = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    upper, lower, digits = (int(byte[ord(a) : ord(b) + 1].sum()) for a, b in ("AZ", "az", "09"))
    shares = {
        "upper": upper / max(1, upper + lower),
        "digit": digits / n,
        "again": 1 - len(set(words)) / max(1, len(words)),
        "length": min(1.0, n / max(1, len(words)) / 16),
    }
    counts: dict[str, int] = {}
    for run in SIGNS.findall(text):
        counts[run[:4]] = counts.get(run[:4], 0) + 1
    shares |= {f"sign {s}": min(1.0, 4 * c / max(1, len(words))) for s, c in counts.items() if c * 50 > len(words)}
    return [f"{name} {int(BINS * value)}" for name, value in shares.items()]


def feature_hashes(text: str | None) -> np.ndarray:
    """Distinct feature hashes of the whole text: its words and its shape. Null counts as empty."""
    shape = [hash_name(f) for f in shape_features(text or "")]
    return np.unique(np.concatenate([word_hashes(text), np.array(shape, dtype=np.uint64)]))


def hash_name(name: str) -> int:
    return xxhash.xxh64_intdigest(name.encode("utf-8", "surrogatepass"), 11)


@dataclass(frozen=True)
class OrdinalModel:
    vocabulary: Vocabulary
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one less than there are grades

    def tails(self, text: str | None) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..."""
        score = self.weights[self.vocabulary.places(feature_hashes(text))].sum()
        return sigmoid(score - self.thresholds)


def train_ordinal(
    grades: np.ndarray, rows: list[np.ndarray], n_grades: int, size: int,
    epochs: int = 40, batch: int = 512, rate: float = 0.02, decay: float = 1e-3,
) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) by maximum likelihood with Adam steps over mini-batches."""
    rng = np.random.default_rng(0)
    below = np.array([(grades < k).mean() for k in range(1, n_grades)]).clip(0.01, 0.99)
    start = np.maximum.accumulate(np.log(below / (1 - below)) + 1e-3 * np.arange(n_grades - 1))
    free = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    parameters = np.concatenate([np.zeros(size), free])
    adam = Adam(len(parameters), rate)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for part in np.array_split(order, max(1, len(rows) // batch)):
            x = Sparse([rows[i] for i in part])
            weights, free = parameters[:size], parameters[size:]
            gaps = np.exp(free[1:])
            edges = np.concatenate([[-np.inf], free[0] + np.concatenate([[0.0], np.cumsum(gaps)]), [np.inf]])
            score, grade = x.dot(weights), grades[part]
            upper, lower = sigmoid(edges[grade + 1] - score), sigmoid(edges[grade] - score)
            likely = np.maximum(upper - lower, 1e-9)
            d_upper, d_lower = upper * (1 - upper) / likely, lower * (1 - lower) / likely
            by_score = d_upper - d_lower
            by_edge = np.bincount(grade, -d_upper, n_grades)[: n_grades - 1] + np.bincount(grade, d_lower, n_grades)[1:]
            after = np.cumsum(by_edge[::-1])[::-1]  # a gap moves every later threshold
            by_free = np.concatenate([after[:1], after[1:] * gaps])
            gradient = np.concatenate([x.spread(by_score, size) / x.n + decay * weights, by_free / x.n])
            adam.step(parameters, gradient)
    free = parameters[size:]
    return parameters[:size], free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))])


def fit_ordinal(
    docs: DataFrame,
    ratings: DataFrame,
    train: Callable[[str], Column],
    id_col: str = "doc_id",
    text_col: str = "text",
    grade_col: str = "grade",
    max_rows: int = 12_000,
    max_grades: int = 20,
) -> OrdinalModel | None:
    """A model from about ``max_rows`` rated rows within ``train``, chosen by a hash of the id.

    Grades are integers from 0 to less than ``max_grades``; other and null grades say nothing, and of several grades of one id the lowest counts. None without
    two different grades.
    """
    rated = ratings.filter(F.col(id_col).isNotNull() & F.col(grade_col).between(0, max_grades - 1))
    rated = rated.groupBy(F.col(id_col).alias("key")).agg(F.min(F.col(grade_col).cast("int")).alias("grade")).filter(train("key"))
    n, low, high = rated.agg(F.count(F.lit(1)), F.min("grade"), F.max("grade")).first()
    if not n or low == high:
        return None
    chosen = rated.filter(hash_share("key", share(max_rows, n), "grade"))
    # At most about max_rows rows of 12 bytes: the filter above bounds it.
    sample = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "key")

    def step(grade, text):
        return {"grade": grade, "words": [feature_hashes(t).view(np.int64) for t in text]}

    stored = materialize(batches(sample.select("grade", "text"), step, "grade int, words array<bigint>"), "rated")
    vocabulary = fit_vocabulary(stored)
    grades, places = collect_rows(stored, vocabulary)
    if len(set(grades.tolist())) < 2:
        return None
    return OrdinalModel(vocabulary, *train_ordinal(grades, places, high + 1, len(vocabulary.hashes)))


def grade_documents(
    docs: DataFrame,
    model: OrdinalModel | None,
    id_col: str = "doc_id",
    text_col: str = "text",
    wanted: int = 1,
    min_tail: float = 0.5,
) -> DataFrame:
    """(doc_id, expected_grade, tail, kept) for every row of ``docs``: ``tail`` is P(grade >= wanted), ``kept`` whether it reaches ``min_tail``.

    Null and empty texts are graded by their shape alone. Without a model the expected grade and tail are null and every row is kept.
    Repeated rows stay; other columns are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the vocabulary size

    def step(id, text):
        tails = [held.value.tails(t) if held.value else None for t in text]
        tail = [None if t is None else float(t[min(wanted, len(t)) - 1]) for t in tails]
        return {
            "id": id,
            "expected_grade": [None if t is None else float(t.sum()) for t in tails],
            "tail": tail,
            "kept": [t is None or t >= min_tail for t in tail],
        }

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return batches(rows, step, f"id {kind}, expected_grade double, tail double, kept boolean").withColumnRenamed("id", "doc_id")
