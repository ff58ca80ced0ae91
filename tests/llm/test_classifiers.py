import zlib

import numpy as np
import pytest

from kinfold.llm import ordinal, textclass, toxicity
from kinfold.llm.common import word_hashes
from kinfold.llm.queries import QUERIES, graded, outside

SF = "/root/testdata/sf0.1"


def test_word_hashes_depend_on_the_word_only():
    a, b = word_hashes("The cat, the CAT."), word_hashes("x" * 3_000_000 + " cat the " + "é" * 10)
    assert a[0] == a[2] and a[1] == a[3] and b[1] == a[1] and b[2] == a[0] and len(b) == 4
    assert len(word_hashes(None)) == len(word_hashes("")) == len(word_hashes("  ,; ")) == 0


def test_non_negative_risk_learns_from_positives_and_a_mix():
    rng = np.random.default_rng(0)
    noise = lambda: rng.choice(np.arange(5, 60), 12, replace=False)
    toxic = lambda: np.append(noise(), rng.choice(5, 2, replace=False))
    positive = [toxic() for _ in range(300)]
    mix = [toxic() if rng.random() < 0.15 else noise() for _ in range(2000)]
    weights = toxicity.train_model(positive, mix, 0.15, 60, seed=0)
    score = lambda rows: np.array([weights[r].sum() + weights[-1] for r in rows])
    assert (score([toxic() for _ in range(300)]) > 0).mean() > 0.9
    assert (score([noise() for _ in range(300)]) > 0).mean() < 0.05


def test_toxicity_held_out(spark):
    rows = QUERIES["op1_toxicity"](spark, SF).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    hit = sum(p for y, p in held if y) / sum(y for y, _ in held)
    false = sum(p for y, p in held if not y) / sum(1 - y for y, _ in held)
    assert hit > 0.55 and false < 0.02


def test_ordinal_recovers_grades():
    rng = np.random.default_rng(1)
    grades = rng.integers(0, 3, 3000)
    rows = [np.unique(np.append(rng.integers(3, 40, 6), np.flatnonzero(rng.random(3) < [0.1, 0.2 + 0.3 * g, 0.05 + 0.4 * g]))) for g in grades]
    weights, thresholds = ordinal.train_ordinal(grades, rows, 3, 40)
    assert thresholds[0] < thresholds[1]
    score = np.array([weights[r].sum() for r in rows])
    means = [score[grades == g].mean() for g in range(3)]
    assert means[0] < means[1] < means[2]


def test_ordinal_gradient_matches_differences():
    """One Adam step moves every parameter against the numeric slope of the likelihood."""
    grades = np.array([0, 1, 2, 2, 1])
    rows = [np.array([0]), np.array([0, 1]), np.array([1]), np.array([1, 2]), np.array([2])]

    def loss(weights, t):
        edges = np.concatenate([[-np.inf], t, [np.inf]])
        score = np.array([weights[r].sum() for r in rows])
        return -np.log(textclass.sigmoid(edges[grades + 1] - score) - textclass.sigmoid(edges[grades] - score)).mean()

    weights, thresholds = ordinal.train_ordinal(grades, rows, 3, 3, epochs=400, decay=0.0)
    start = loss(np.zeros(3), np.array([-1.0, 0.5]))
    assert loss(weights, thresholds) < start - 0.3


def test_ordinal_held_out(spark):
    rows = QUERIES["op4_quality_classifier"](spark, SF).collect()
    grade = {r.doc_id: r.grade for r in graded(spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    held = [(grade[r.doc_id], r) for r in rows if r.held_out and r.doc_id in grade]
    low, good = [r for g, r in held if g == 0], [r for g, r in held if g == 2]
    assert sum(not r.kept for r in low) / len(low) > 0.8 and sum(r.kept for r in good) / len(good) > 0.97
    assert all(0 <= r.tail <= 1 and 0 <= r.expected_grade <= 2 for r in rows)


@pytest.fixture(scope="module")
def toy_labels(spark):
    return spark.createDataFrame([(1, 1, 1), (1, 1, None), (5, 0, 0), (7, 1, 0), (None, 1, 1), (8, None, 0)], "doc_id bigint, quality int, toxic int")


def test_edges(edge_docs, no_docs, toy_labels):
    model = toxicity.fit_toxicity(edge_docs, toy_labels, outside(1000, 999))
    rows = toxicity.score_toxicity(edge_docs, model).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.fit_toxicity(no_docs, toy_labels, outside(5, 9)) is None
    assert toxicity.fit_toxicity(edge_docs, toy_labels.filter("toxic = 1"), outside(5, 9)) is None
    assert {r.score for r in toxicity.score_toxicity(edge_docs, None).collect()} == {0.0}
    assert toxicity.score_toxicity(no_docs, model).collect() == []
    grades = ordinal.fit_ordinal(edge_docs, graded(toy_labels), outside(1000, 999))
    rows = ordinal.grade_documents(edge_docs, grades).collect()
    assert len(rows) == edge_docs.count() and all(r.kept is not None for r in rows)
    assert all(r.kept and r.tail is None for r in ordinal.grade_documents(edge_docs, None).collect())
    assert ordinal.fit_ordinal(no_docs, graded(toy_labels), outside(5, 9)) is None
