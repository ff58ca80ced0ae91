import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from kinfold.llm import negatives


def plain(rows, anchors, positives=5, wanted=5):
    """All pairs. Rows: (id, label, vector)."""
    fine = [(i, l, [math.floor(256 * x) for x in v]) for i, l, v in rows if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    first = {}
    for i, l, v in fine:
        if anchors(i):
            first[i] = min(first.get(i, (l, v)), (l, v))
    out = []
    for a, (label, vector) in first.items():
        scored = sorted((-sum(x * y for x, y in zip(vector, v)), i, l) for i, l, v in fine if i != a)
        for ps, p, _ in [s for s in scored if s[2] == label][:positives]:
            hard = [(ns, n) for ns, n, l in scored if l != label and 80 * -ps <= 100 * -ns <= 100 * -ps]
            out += [(a, p, rank, n, -ps, -ns) for rank, (ns, n) in enumerate(hard[:wanted], 1)]
    return sorted(out)


def mined(rows, spark, mod, **options):
    frame = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>, ids string, chunk int, key int").repartition(3)
    return sorted(map(tuple, negatives.mine(frame, F.col("label"), F.col("vec_id") % mod == 0, **options).collect()))


@pytest.mark.parametrize("seed", range(3))
def test_equals_all_pairs(spark, seed, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 16)
    monkeypatch.setattr(negatives, "CHUNK_ANCHORS", 7)
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(6)] for _ in range(4)]
    rows = []
    for i in range(300):
        vector = [round(x + rng.choice([0, 0, rng.uniform(-0.3, 0.3)]), 2) for x in (centres[0] if i % 3 == 0 else rng.choice(centres))]
        rows.append((i - 20, rng.choice([0, 1, 1, 2]), [struct.unpack("f", struct.pack("f", x))[0] for x in vector], "", 0, 0))
    want = plain([r[:3] for r in rows], lambda i: i % 5 == 0)
    assert len(want) > 300
    assert mined(rows, spark, 5) == want


def test_windows_do_not_depend_on_one_score_for_all(spark):
    """A third of all rows are copies of one vector under several labels: equal scores go by id and no cell sends more than a few keys."""
    rows = [(i, i % 4, [1.0, 0.5], "", 0, 0) for i in range(200)] + [(i, i % 4, [0.9, 0.4], "", 0, 0) for i in range(200, 400)]
    assert mined(rows, spark, 50) == plain([r[:3] for r in rows], lambda i: i % 50 == 0)


def test_keys_sort_like_their_parts():
    rng = random.Random(1)
    ends = [-(1 << 63), (1 << 63) - 1, 0, 1, -1]
    parts = [(rng.choice(ends), rng.choice(ends), rng.randrange(2), rng.choice(ends)) for _ in range(300)]
    assert sorted(parts, key=lambda p: (p[0], -p[1], p[2], p[3])) == [negatives.parts_of(k) for k in sorted(negatives.key_of(*p) for p in parts)]


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 2, [0.9, 5.0]), (3, 2, [1.0, 0.0]), (3, 2, [1.0, 0.0]), (4, 1, [0.95]), (5, None, [1.0, 0.0]), (6, 2, None),
        (7, 2, [nan, 1.0]), (8, 2, [inf, 0.0]), (9, 2, [None, 1.0]), (None, 2, [1.0, 0.0]), (10, 3, []), (10, 1, [1.0]), (20, 7, [1.0, 1.0]), (30, 1, [1e30, -1e30]), (40, 1, [-1.0, 0.0]),
    ]
    rows = [(i, l, None if v is None else [None if x is None else struct.unpack("f", struct.pack("f", x))[0] for x in v]) for i, l, v in rows]
    got = mined([(*r, "x", 1, 1) for r in rows], spark, 10)
    end = (1 << 63) - 1
    held = lambda x: min(max(x, -end - 1), end)
    want = [r for r in plain(rows, lambda i: i % 10 == 0) if abs(r[4]) <= end]
    assert [r for r in got if abs(r[4]) < end] == want and want and all(held(r[4]) == r[4] for r in got)
    assert mined([], spark, 10) == []
    assert mined([(*r, "x", 1, 1) for r in rows if r[0] == 1], spark, 10) == []
