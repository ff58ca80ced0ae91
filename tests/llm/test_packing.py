import random
from collections import defaultdict

from kinfold.llm import packing
from kinfold.llm.queries import QUERIES


def plain_best_fit(sizes, sources, clusters, capacity):
    bins, placed = [], []
    for size, s, c in zip(sizes, sources, clusters):
        fits = [(b["room"], k) for k, b in enumerate(bins) if b["room"] >= max(size, 1) and s not in b["s"] and c not in b["c"]]
        k = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append({"room": capacity, "s": set(), "c": set()})
        bins[k]["room"] -= size
        bins[k]["s"].add(s)
        bins[k]["c"].add(c)
        placed.append(k)
    return placed


def test_best_fit_matches_brute_force():
    rng = random.Random(1)
    for _ in range(60):
        n = rng.randrange(1, 120)
        sizes = sorted((rng.choice([0, 1, rng.randrange(1, 40), 50]) for _ in range(n)), reverse=True)
        sources = [rng.choice("aaabcdef") for _ in range(n)]
        clusters = [rng.randrange(20) for _ in range(n)]
        assert packing.best_fit(sizes, sources, clusters, 50) == plain_best_fit(sizes, sources, clusters, 50)


def check(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.bin_id].append(r)
    for held in bins.values():
        total = sum(r.n_words for r in held)
        assert total <= capacity and {r.bin_words for r in held} == {total}
        assert len({r.source for r in held}) == len(held)


def test_query_keeps_every_word_once(spark, documents):
    rows = QUERIES["op10_packing"](spark, "/root/testdata/sf0.001").collect()
    check(rows, packing.CAPACITY)
    words = defaultdict(int)
    for r in rows:
        assert r.first_word == r.piece * packing.CAPACITY
        words[r.doc_id] += r.n_words
    assert dict(words) == {r.doc_id: len(r.text.split()) for r in documents.collect()}


def test_copies_and_a_hot_source(spark):
    rows = [(i, f"w{i % 40} " * (i % 7 + 1), "hot" if i % 3 else f"s{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string")
    packed = packing.pack(docs, capacity=20, shard_rows=100).collect()
    assert len(packed) == 300
    check(packed, 20)
    texts = {i: t for i, t, _ in rows}
    bins = defaultdict(list)
    for r in packed:
        bins[r.bin_id].append(texts[r.doc_id])
    assert all(len(set(b)) == len(b) for b in bins.values())
    assert len({r.bin_id.split("-")[0] for r in packed}) == 3


def test_edges(edge_docs, no_docs):
    rows = packing.pack(edge_docs).collect()
    check(rows, packing.CAPACITY)
    words = defaultdict(int)
    for r in rows:
        words[r.doc_id] += r.n_words
    assert words[5] == 42_000 and words[2] == words[3] == words[4] == 0 and words[None] == 6
    assert len([r for r in rows if r.doc_id == 1]) == 2
    assert packing.pack(no_docs).collect() == []
