import random

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from kinfold.operators import monitor
from kinfold.operators.ordered import lagged, running, with_range
from kinfold.operators.skew import hot_keys, salted_join

SPLIT = {"buckets": 7, "min_rows": 1}


def brute_prefix(ranges, start):
    covered = start
    for low, high in sorted(ranges):
        if high <= start:
            continue
        if low > covered:
            break
        covered = max(covered, high)
    return covered


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 8)), min_size=1, max_size=25), st.integers(0, 12))
def test_commit_prefix_matches_brute_force(spark, drawn, start):
    ranges = [(low, low + width) for low, width in drawn]
    frame = spark.createDataFrame(ranges, "range_start bigint, range_end bigint")
    assert monitor.commit_prefix(frame, start, **SPLIT).first().committed == brute_prefix(ranges, start)


def test_commit_prefix_ignores_order_and_replay(spark):
    ranges = [(200, 300), (0, 100), (400, 500), (100, 200), (0, 100)]
    for seed in range(2):
        random.Random(seed).shuffle(ranges)
        frame = spark.createDataFrame(ranges, "range_start bigint, range_end bigint")
        assert tuple(monitor.commit_prefix(frame, 0, **SPLIT).first()) == (300, 1)
    empty = spark.createDataFrame([], "range_start bigint, range_end bigint")
    assert monitor.commit_prefix(empty, 5).first().committed == 5


def test_ordered_helpers_match_a_plain_scan(spark):
    rng = random.Random(7)
    rows = [(rng.choice("aaab"), i, rng.randint(0, 9)) for i in rng.sample(range(1000), 120)]
    frame = spark.createDataFrame(rows, "s string, at bigint, v int")
    ranged = with_range(frame, "at", **SPLIT)
    assert ranged.select("_range").distinct().count() > 3
    got_lag = {(r.s, r.at): r.prev_v for r in lagged(ranged, ["s"], ["at"], ["v"]).collect()}
    got_sum = {(r.s, r.at): r.total for r in running(ranged, ["s"], ["at"], F.col("v"), "sum", "total").collect()}
    got_max = {(r.s, r.at): r.top for r in running(ranged, ["s"], ["at"], F.col("v"), "max", "top", current=False).collect()}
    for series in "ab":
        before = []
        for _, at, v in sorted((r for r in rows if r[0] == series), key=lambda r: r[1]):
            assert got_lag[(series, at)] == (before[-1] if before else None)
            assert got_max[(series, at)] == (max(before) if before else None)
            before.append(v)
            assert got_sum[(series, at)] == sum(before)


def test_levels_carry_a_long_series_of_equal_positions(spark):
    """All positions are equal and a third of the rows has a null series: ranges stay bounded, and several levels give what a plain scan gives."""
    rng = random.Random(9)
    rows = [(rng.choice(["a", "a", None]), 7, i, rng.randint(-9, 9)) for i in rng.sample(range(1000), 230)]
    frame = spark.createDataFrame(rows, "s string, at bigint, tie bigint, v int")
    ranged = with_range(frame, ["at", "tie"], min_rows=3, fan=4)
    cut = ranged.schema["_range"].metadata
    assert cut == {"ranges": 77, "fan": 4} and ranged.groupBy("_range").count().agg(F.max("count")).first()[0] == 3
    order = ["at", "tie"]
    lag = {r.tie: r.prev_v for r in lagged(ranged, ["s"], order, ["v"]).collect()}
    total = {r.tie: r.total for r in running(ranged, ["s"], order, F.col("v"), "sum", "total").collect()}
    top = {r.tie: r.top for r in running(ranged, ["s"], order, F.col("v"), "max", "top", current=False).collect()}
    assert len(lag) == len(total) == len(top) == len(rows)
    for series in ("a", None):
        before = []
        for _, _, tie, v in sorted((r for r in rows if r[0] == series), key=lambda r: r[2]):
            assert (lag[tie], top[tie]) == ((before[-1], max(before)) if before else (None, None))
            before.append(v)
            assert total[tie] == sum(before)


def test_streaks_cross_ranges_and_reset(spark):
    outcomes = "ffsfffsfsffff"
    frame = spark.createDataFrame([("q", i, c) for i, c in enumerate(outcomes)], "s string, at bigint, c string")
    rows = monitor.failure_streaks(frame, ["s"], "at", F.col("c") == "f", 3, **SPLIT).collect()
    assert sorted((r.failures, r.first_at, r.last_at) for r in rows) == [(3, 3, 5), (4, 9, 12)]


def test_rates_are_zero_without_time(spark):
    samples = spark.createDataFrame([(10, 4, 1000), (30, 14, 3000), (30, 14, 3000 + 1)], "end_offset bigint, committed bigint, at_ms bigint")
    rows = {r.at_ms: (r.lag, r.rate) for r in monitor.lag_rates(samples, [], **SPLIT).collect()}
    assert rows == {1000: (6, 0.0), 3000: (16, 5.0), 3001: (16, 0.0)}
    flags = [r.throttle for r in monitor.throttled(samples, 16).orderBy("at_ms").collect()]
    assert flags == [False, True, True]


def test_salted_join_equals_plain_join(spark):
    left = spark.range(3000).selectExpr("case when id % 3 = 0 then 0 else id end as k", "id as v")
    right = spark.range(0, 3000, 2).selectExpr("id as k", "id * 10 as w")
    weights = left.groupBy("k").count().withColumnRenamed("count", "n")
    hot = hot_keys(weights, ["k"], floor=100)
    assert hot == [(0,)]
    for how in ("inner", "left"):
        plain = sorted(map(tuple, left.join(right, "k", how).select("k", "v", "w").collect()), key=str)
        salted = salted_join(left, right, ["k"], hot, how, salts=16)
        assert sorted(map(tuple, salted.select("k", "v", "w").collect()), key=str) == plain
    assert "_salt" in salted_join(left, right, ["k"], hot)._jdf.queryExecution().toString()
