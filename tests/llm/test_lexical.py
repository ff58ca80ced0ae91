import math
import random
import re
from collections import Counter

import pytest

from kinfold.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def plain(docs, items, k):
    """Every document scored for every item."""
    counted = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        ranked = []
        for doc_id, c in counted:
            m = 10 + 90 * sum(c.values()) * n_docs // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                ranked.append((-score, doc_id is None, doc_id))
        ranked.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        out += [(item, rank, doc_id, -score) for rank, (score, _, doc_id) in enumerate(ranked[:k], 1)]
    return sorted(out, key=repr)


def rows(frame):
    return sorted([(r.item_id, r.rank, r.doc_id, r.score) for r in frame.collect()], key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_equals_scoring_every_document(spark, seed):
    rng = random.Random(seed)
    words = [f"{rng.choice(['Wörd', 'ABC', 'q', 'ñ'])}{i}" for i in range(60)]
    texts = [rng.choice([" ", ".", "_", "\n"]).join(rng.choices(words, weights=[1 / (i + 1) for i in range(60)], k=rng.choice([0, 1, 3, 9, 9, 40, 300]))) for _ in range(400)]
    docs = list(enumerate(texts + texts[:40]))
    rng.shuffle(docs)
    items = [(i, " ".join(rng.choices([*words, "nowhere"], k=rng.randrange(1, 9)))) for i in range(25)]
    index, n_docs, _ = lexical.build_index(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5), segment_docs=rng.choice([7, 30, 500]))
    got = lexical.search(index, n_docs, spark.createDataFrame(items, "item_id int, text string"), 10)
    assert rows(got) == plain(docs, items, 10)


def test_blocks_of_queries_meet_all_segments(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 8)
    monkeypatch.setattr(lexical, "GROUP_SEGMENTS", 2)
    rng = random.Random(9)
    docs = [(i, " ".join(rng.choices("abcdefgh", k=rng.randrange(1, 20)))) for i in range(120)]
    items = [(i, " ".join(rng.sample("abcdefgh", 3))) for i in range(20)]
    index, n_docs, _ = lexical.build_index(spark.createDataFrame(docs, "doc_id bigint, text string"), segment_docs=9)
    assert rows(lexical.search(index, n_docs, spark.createDataFrame(items, "item_id bigint, text string"), 4)) == plain(docs, items, 4)


def test_index_layout():
    """Documents by m, postings by term, stratum and tf, and an impact that is the same for a whole run."""
    segment = lexical.Segment()
    for i, text in enumerate(["a a b", "a b b b c c", "a", "b a a"]):
        segment.add(i, text)
    row = segment.row(4, 13)
    assert row["ms"].tolist() == sorted(row["ms"].tolist()) and row["terms"] == ["a", "b", "c"] and row["dfs"].tolist() == [4, 3, 1]


def test_terms():
    assert [t for part in lexical.terms_of("Don't STOP_it: 3x ÄÖ!") for t in part if t] == [b"don", b"t", b"stop", b"it", b"3x", "ÄÖ".encode()]
    assert lexical.term_count(None) == lexical.term_count("") == lexical.term_count("-- !") == 0
    assert lexical.term_count("ab " * 700_000) == 700_000


def test_edges(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "THE thing of"), (2, None), (3, ""), (4, "zzz"), (None, "the"), (5, "6789 x nicht"), (1, "le")], "item_id bigint, text string")
    docs = [(r.doc_id, r.text) for r in edge_docs.collect()]
    want = plain(docs, [(1, "THE thing of le"), (4, "zzz"), (5, "6789 x nicht")], 10)
    assert rows(lexical.top_documents(edge_docs, items)) == want and any(r[2] is None for r in want)
    assert lexical.top_documents(no_docs, items).collect() == []
    assert lexical.top_documents(edge_docs, items.limit(0)).collect() == []
