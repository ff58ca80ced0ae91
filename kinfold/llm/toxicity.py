"""Toxicity by non-negative positive-unlabelled learning (Kiryo et al., 2017).

Confirmed toxic texts are positives; all other training text is unlabelled, toxic or not. With class prior p, the risk of a score g is
p * R_positive(g, +) + max(0, R_unlabelled(g, -) - p * R_positive(g, -)): the toxic share hidden in the unlabelled text is taken out again, and
when that difference falls below zero, which only over-fitting can cause, its gradient is reversed. Several linear models over the presence of
words, trained in numpy on different orders, are averaged.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from kinfold.llm.common import batches, hash_share, share, word_hashes
from kinfold.llm.textclass import Adam, Sparse, Vocabulary, collect_rows, fit_vocabulary, hashed_rows, sigmoid


@dataclass(frozen=True)
class ToxicityModel:
    vocabulary: Vocabulary
    weights: np.ndarray  # one row per model: the words, then the bias

    def score(self, text: str | None) -> float:
        places = self.vocabulary.places(np.unique(word_hashes(text)))
        return float(sigmoid(self.weights[:, places].sum(axis=1) + self.weights[:, -1]).mean())


def train_model(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, size: int, seed: int,
    epochs: int = 40, batch: int = 512, rate: float = 0.02, decay: float = 1e-4,
) -> np.ndarray:
    """Weights of one linear model (the last one is the bias) under the non-negative risk with logistic loss."""
    rng = np.random.default_rng(seed)
    weights = np.zeros(size + 1)
    weights[-1] = np.log(prior / (1 - prior))
    adam = Adam(size + 1, rate)

    def gradient(rows: Sparse, slope: np.ndarray) -> np.ndarray:
        return np.append(rows.spread(slope, size), slope.sum()) / max(1, rows.n)

    steps = max(1, -(-len(unlabelled) // batch))
    for _ in range(epochs):
        p_order, u_order = rng.permutation(len(positive)), rng.permutation(len(unlabelled))
        for p_part, u_part in zip(np.array_split(p_order, steps), np.array_split(u_order, steps)):
            if not len(p_part):
                p_part = rng.integers(len(positive), size=min(batch, len(positive)))
            p_rows, u_rows = Sparse([positive[i] for i in p_part]), Sparse([unlabelled[i] for i in u_part])
            p_score, u_score = p_rows.dot(weights[:-1]) + weights[-1], u_rows.dot(weights[:-1]) + weights[-1]
            as_negative = np.logaddexp(0, u_score).mean() - prior * np.logaddexp(0, p_score).mean()
            negative = gradient(u_rows, sigmoid(u_score)) - prior * gradient(p_rows, sigmoid(p_score))
            if as_negative >= 0:
                step = negative - prior * gradient(p_rows, sigmoid(-p_score))
            else:
                step = -negative
            adam.step(weights, step + decay * weights)
    return weights


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    train: Callable[[str], Column],
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_positive: int = 3000,
    max_unlabelled: int = 9000,
    models: int = 3,
) -> ToxicityModel | None:
    """A model from about ``max_positive`` confirmed toxic rows and ``max_unlabelled`` rows of any kind, both within ``train``,
    which makes the condition of a training row from the name of a key column.

    Rows are chosen by a hash of the id, so a repeated fit sees the same rows. The class prior is the toxic share among the labelled training rows. A row is confirmed
    when any label row of its id says 1; null labels say nothing. None when no toxic row or no other row is labelled.
    """
    marked = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = marked.groupBy(F.col(id_col).alias("key")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    known = known.filter(train("key"))
    n, toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < toxic < n:
        return None
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    chosen = known.filter((F.col("toxic") == 1) & hash_share("key", share(max_positive, toxic), "positive")).select("key")
    # At most about max_positive keys of 8 bytes: the filter above bounds it.
    positive = rows.join(F.broadcast(chosen), "key", "left_semi").select(F.lit(1).alias("grade"), "text")
    inside = rows.filter(train("key"))
    part = share(max_unlabelled, inside.count())
    unlabelled = inside.filter(hash_share("key", part, "unlabelled")).select(F.lit(0).alias("grade"), "text")
    stored = hashed_rows(positive.unionByName(unlabelled))
    vocabulary = fit_vocabulary(stored)
    grades, places = collect_rows(stored, vocabulary)
    positives = [p for g, p in zip(grades, places) if g == 1]
    others = [p for g, p in zip(grades, places) if g == 0]
    if not positives or not others:
        return None
    size = len(vocabulary.hashes)
    return ToxicityModel(vocabulary, np.array([train_model(positives, others, toxic / n, size, s) for s in range(models)]))


def score_toxicity(docs: DataFrame, model: ToxicityModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) for every row of ``docs``, from the whole text alone.

    Null and empty texts get the score of a text without known words. Without a model every score is 0. Repeated rows stay; other columns are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the vocabulary size

    def step(id, text):
        scores = [held.value.score(t) if held.value else 0.0 for t in text]
        return {"id": id, "score": scores, "predicted": [int(s >= 0.5) for s in scores]}

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return batches(rows, step, f"id {kind}, score double, predicted int").withColumnRenamed("id", "doc_id")
