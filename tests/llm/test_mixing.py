import random
from collections import defaultdict

import pytest

from kinfold.llm import mixing


def plain_targets(words, weights, most=3):
    """Water filling, one source at a time."""
    total, full = sum(words), set()
    while True:
        open_ = [i for i in range(len(words)) if i not in full]
        level = (total - sum(most * words[i] for i in full)) / sum(weights[i] for i in open_)
        over = {i for i in open_ if most * words[i] < level * weights[i]}
        if not over:
            return [most * words[i] if i in full else level * weights[i] for i in range(len(words))]
        full |= over


def plain_seats(claims, seats, limits):
    """Seat by seat to the highest quotient."""
    held = [0] * len(claims)
    for _ in range(seats):
        free = [(-claims[i] / (2 * held[i] + 1), i) for i in range(len(claims)) if held[i] < limits[i] and claims[i] > 0]
        if not free:
            break
        held[min(free)[1]] += 1
    return held


@pytest.mark.parametrize("seed", range(2))
def test_seats_go_to_the_highest_quotients(spark, seed):
    rng = random.Random(seed)
    groups = {}
    for g in range(6):
        claims = [rng.choice([0.0, 1.0, 1.0, 2.5, rng.uniform(0, 40), 300.0]) for _ in range(rng.randrange(1, 30))]
        limits = [max(1, int(3 * c)) for c in claims]
        groups[g] = (claims, int(sum(claims) * rng.choice([0.1, 0.5, 1, 1.3])), limits)
    rows = [(g, i, c, seats, limits[i]) for g, (claims, seats, limits) in groups.items() for i, c in enumerate(claims)]
    parties = spark.createDataFrame(rows, "g int, party bigint, claim double, seats bigint, most bigint")
    got = defaultdict(dict)
    for r in mixing.apportion(parties, ["g"], "party", "claim", "seats", "most", "won").collect():
        got[r.g][r.party] = r.won
    for g, (claims, seats, limits) in groups.items():
        assert [got[g][i] for i in range(len(claims))] == plain_seats(claims, seats, limits)


def test_mix_is_near_its_targets(spark):
    rng = random.Random(3)
    sources = [None, "", "hot", "ñ", "a", "Z", "tiny"]
    rows = [(i, " ".join("w" * (j % 3 + 1) for j in range(rng.choice([0, 3, 50, 900])))) for i in range(1500)]
    docs = [(i, t, "hot" if i % 3 == 0 else ("tiny" if i % 300 == 1 else rng.choice(sources[:6]))) for i, t in rows]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    out = mixing.mix(frame, shard_words=20_000, shard_rows=100).collect()
    again = mixing.mix(frame.repartition(7), shard_words=20_000, shard_rows=100).collect()
    assert sorted(out) == sorted(again)
    size = {i: len(t.split()) for i, t, _ in docs}
    order = sorted({s for *_, s in docs if s is not None}) + [None]
    words = [sum(size[i] for i, _, s in docs if s == source) for source in order]
    targets = dict(zip(order, plain_targets(words, [(5, 2, 1)[k % 3] for k in range(len(order))])))
    taken = defaultdict(int)
    for r in out:
        assert r.size == size[r.doc_id] and r.source_size == words[order.index(r.source)] and 0 <= r.taken <= 3 * r.size
        assert r.target == pytest.approx(targets[r.source])
        taken[r.source] += r.taken
    assert len(out) == len(docs) and len({(r.source, r.shard) for r in out if r.source == "hot"}) > 4
    for source in order:
        assert abs(taken[source] - targets[source]) <= 32 + 0.01 * targets[source]
    assert any(targets[s] == 3 * w for s, w in zip(order, words))


def test_edges(edge_docs, no_docs):
    rows = mixing.mix(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    nothing = [r for r in rows if r.size == 0]
    assert {r.doc_id for r in nothing} == {None, 2, 3, 4} and all(r.taken == 0 for r in nothing)
    assert all(r.taken <= 3 * r.size for r in rows)
    assert mixing.mix(no_docs).collect() == []
    assert [(r.size, r.target, r.taken) for r in mixing.mix(edge_docs.filter("text IS NULL OR doc_id = 3")).collect()] == [(0, 0.0, 0)] * 3
