import random

import xxhash
from hypothesis import given, settings, strategies as st

from kinfold.llm import linededup


def sentence(rng):
    return " ".join(f"{rng.choice('abcdefghij')}{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 12))) + "."


def passage(rng, n):
    return "".join(sentence(rng) + rng.choice([" ", "\n"]) for _ in range(n))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab. \n?", max_size=80))
def test_lines_and_chunks_cover_the_text(text):
    lines = linededup.lines_of(text)
    assert "".join(text[a:b] for a, b in lines) == text
    for a, b, digest in zip(*linededup.chunks_of(text)):
        bare = linededup.bare_chunk(text[a:b])
        assert bare.count("\n") >= 1 and b - a >= linededup.MIN_CHARS
        assert digest % (1 << 64) == xxhash.xxh3_64_intdigest(bare.encode())


def test_boundaries_move_with_the_text():
    rng = random.Random(1)
    body = passage(rng, 60)
    bodies = [set(linededup.chunks_of(passage(rng, n) + body)[2]) for n in (0, 3, 10)]
    assert len(bodies[0] & bodies[1] & bodies[2]) >= len(bodies[0]) - 2


def test_shared_passages_stay_once(spark):
    rng = random.Random(2)
    shared = [passage(rng, 8) for _ in range(5)]
    rows = []
    for i in range(40):
        own = [passage(rng, rng.randrange(3, 9)) for _ in range(2)]
        rows.append((i, own[0] + "\n" + shared[i % 5] + "\n" + own[1], own))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id int, text string")
    got = {r.doc_id: r for r in linededup.dedup_lines(docs).collect()}
    for i, text, own in rows:
        # What is a document's own stays.
        assert all(s in got[i].text for o in own for s in o.replace("\n", " ").split(". ") if s.strip() and "\n" not in s)
        assert got[i].removed_chars == len(text) - len(got[i].text)
    for k, body in enumerate(shared):
        words = body.split()
        held = [i for i in range(40) if sum(w in got[i].text for w in words) > 0.9 * len(words)]
        assert held == [k]
        assert sum(sum(w in got[i].text for w in words) for i in range(5 + k, 40, 5)) <= 0.1 * len(words) * 7


def test_whole_copies_lose_all_text(spark):
    rng = random.Random(3)
    text = passage(rng, 30)
    docs = spark.createDataFrame([(2, text), (1, text), (3, "something else entirely. and more of it here.")], "doc_id int, text string")
    got = {r.doc_id: r.text for r in linededup.dedup_lines(docs).collect()}
    assert got[1] == text and got[2] == "" and got[3].startswith("something")


def test_single_lines_stay(spark):
    docs = spark.createDataFrame([(i, f"own words {i} of doc {i}.\nAll rights reserved.") for i in range(20)], "doc_id int, text string")
    assert all("All rights" in r.text for r in linededup.dedup_lines(docs).collect())


def test_repeats_within_one_document(spark):
    rng = random.Random(4)
    once = passage(rng, 12)
    got = linededup.dedup_lines(spark.createDataFrame([(1, once + once)], "doc_id int, text string")).first()
    assert len(got.text) < 1.3 * len(once)


def test_equal_hash_with_other_bytes_is_no_copy(spark):
    """The bytes are compared, so a collision of the chunk hash removes nothing."""
    runs = spark.createDataFrame([(2, 0, 0, 9, 1, 0, 0, 9)], "id int, content bigint, start int, end int, id1 int, content1 bigint, start1 int, end1 int")
    texts = [(1, 0, 0, 9, "a b.\nc d.", "", ""), (2, 0, 0, 9, "e f.\ng h.", "", "")]
    schema = "id int, content bigint, start int, end int, body string, left string, right string"
    assert linededup.removals(runs, spark.createDataFrame(texts, schema)).collect() == []
    texts[1] = (2, 0, 0, 9, "a b. c d.", "", "")
    assert [tuple(r) for r in linededup.removals(runs, spark.createDataFrame(texts, schema)).collect()] == [(2, 0, 0, 9)]


def test_edges(edge_docs, no_docs):
    out = linededup.dedup_lines(edge_docs)
    assert out.columns == [*edge_docs.columns, "removed_chars"]
    rows = out.collect()
    assert len(rows) == edge_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].text is None and by_id[3].text == "" and by_id[1].removed_chars == 0
    assert len(by_id[5].text) < 5000
    assert linededup.dedup_lines(no_docs).collect() == []
