import numpy as np
from hypothesis import given, settings, strategies as st

from kinfold.llm import tiling
from kinfold.llm.queries import QUERIES


def plain_tiles(item, doc, low):
    """Greedy string tiling by comparing every pair of places."""
    in_item, in_doc, tiles = [False] * len(item), [False] * len(doc), []
    while True:
        best, found = low - 1, []
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while i + n < len(item) and d + n < len(doc) and item[i + n] == doc[d + n] and not in_item[i + n] and not in_doc[d + n]:
                    n += 1
                if n > best:
                    best, found = n, [(i, d)]
                elif n == best:
                    found.append((i, d))
        if best < low:
            return tiles
        for i, d in found:
            if not any(in_item[i : i + best]) and not any(in_doc[d : d + best]):
                in_item[i : i + best] = [True] * best
                in_doc[d : d + best] = [True] * best
                tiles.append((i, d, best))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=14, unique=True), st.lists(st.integers(0, 60), max_size=40))
def test_tiles_match_brute_force(item, doc):
    got = tiling.tile(np.array(item, np.uint64), np.array(doc, np.uint64), min(3, len(item)))
    want = plain_tiles(item, doc, min(3, len(item)))
    assert sorted(n for *_, n in got) == sorted(n for *_, n in want)


@settings(max_examples=1500, deadline=None)
@given(st.integers(1, 4).flatmap(lambda top: st.tuples(*[st.lists(st.integers(0, top), min_size=1, max_size=n) for n in (14, 40)])))
def test_tiles_of_repeated_tokens_match_brute_force(drawn):
    item, doc = drawn
    low = min(3, len(item))
    assert sorted(tiling.tile(np.array(item, np.uint64), np.array(doc, np.uint64), low)) == sorted(plain_tiles(item, doc, low))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=14), st.lists(st.integers(0, 3), max_size=30))
def test_tiles_are_equal_runs_that_do_not_overlap(item, doc):
    used_item, used_doc = set(), set()
    for i, d, n in tiling.tile(np.array(item, np.uint64), np.array(doc, np.uint64), min(3, len(item))):
        assert item[i : i + n] == doc[d : d + n]
        assert not used_item & set(range(i, i + n)) and not used_doc & set(range(d, d + n))
        used_item |= set(range(i, i + n))
        used_doc |= set(range(d, d + n))


WORDS = [f"w{i}" for i in range(40)]


def test_reordered_passages_are_caught(spark):
    item = " ".join(WORDS)
    halves = " ".join(WORDS[20:]) + " and some other words between them " + " ".join(WORDS[:20]).upper()
    docs = spark.createDataFrame([(1, halves), (2, "x " * 50 + item), (3, " ".join(WORDS[:15])), (4, "nothing of it")], "doc_id int, text string")
    bench = spark.createDataFrame([(7, item)], "item_id int, text string")
    found = {r.doc_id: r for r in tiling.leaks(docs, bench).collect()}
    assert set(found) == {1, 2} and found[1].coverage == 1 and found[1].n_tiles == 2
    assert [r.doc_id for r in tiling.without_leaks(docs, bench).orderBy("doc_id").collect()] == [3, 4]


def test_blocks_give_what_one_block_gives(spark):
    items = [(i, " ".join(WORDS[i : i + 12])) for i in range(0, 28)]
    bench = spark.createDataFrame(items, "item_id int, text string")
    docs = spark.createDataFrame([(k, " ".join(WORDS[k : k + 20])) for k in range(0, 20, 3)], "doc_id int, text string")
    one = sorted(map(tuple, tiling.leaks(docs, bench).collect()))
    many = sorted(map(tuple, tiling.leaks(docs, bench, block_tokens=60).collect()))
    assert one == many and one
    left = sorted(r.doc_id for r in tiling.without_leaks(docs, bench, block_tokens=60).collect())
    assert left == sorted({r[0] for r in docs.collect()} - {r[0] for r in one})


def test_query_finds_every_item_that_stands_in_a_document(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    whole = {r.doc_id for r in docs if any(i in r.text for i in items)}
    got = QUERIES["op3_decontamination"](spark, folder).collect()
    assert len(got) == len(docs) and whole and whole <= {r.doc_id for r in got if r.contaminated}


def test_edges(spark, edge_docs, no_docs):
    bench = spark.createDataFrame([(1, "the thing of her"), (2, None), (None, "x"), (3, ""), (4, "x"), (4, "zz")], "item_id int, text string")
    found = tiling.leaks(edge_docs, bench)
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    assert got == {(1, 1), (5, 1), (8, 4)}
    verdicts = tiling.document_verdicts(edge_docs, found).collect()
    assert len(verdicts) == edge_docs.count() and sum(r.contaminated for r in verdicts) == 4
    none = bench.filter("item_id = 99")
    assert tiling.leaks(edge_docs, none).collect() == [] and tiling.leaks(no_docs, bench).collect() == []
    kept = tiling.without_leaks(edge_docs, bench)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count() - 4
