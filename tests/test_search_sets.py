"""Search for the best entities where values are held by many."""

import random

from pyspark.sql import functions as F

from kinfold.operators import searching

ROW = "{} bigint, ftype string, value binary"


def rows(spark, name, held):
    return spark.createDataFrame([(i, *v) for i, values in held.items() for v in values], ROW.format(name))


def test_the_best_by_sets_are_the_best_one_by_one(spark):
    draw = random.Random(7)
    pool = [(t, bytes([i])) for i in range(9) for t in ("LINE", "PASSAGE", "EXACT_TEXT", "NAME")]
    often = [("LINE", b"a"), ("LINE", b"b"), ("PASSAGE", b"c"), ("NAME", b"d")]
    make = lambda n: {i: set(draw.sample(pool, draw.choice([0, 1, 2]))) | set(draw.sample(often, draw.choice([0, 1, 1, 2, 3]))) for i in range(n)}
    asked, held = rows(spark, "request_id", make(60)), rows(spark, "entity_id", make(150))
    want = sorted(map(tuple, searching.ranked_hits(asked, held).filter("rank <= 4").collect()))
    assert len(want) > 150
    for rare in (0, 3, 20, 200):
        assert sorted(map(tuple, searching.ranked_hits(asked, held, 4, rare=rare).collect())) == want, rare


def test_a_value_that_all_hold_costs_one_row(spark):
    asked = spark.range(2000).select(F.col("id").alias("request_id"), F.lit("LINE").alias("ftype"), F.lit(b"x").alias("value"))
    held = spark.range(3000).select(F.col("id").alias("entity_id"), F.lit("LINE").alias("ftype"), F.lit(b"x").alias("value"))
    sets = [searching._sets(f, o, n) for f, o, n in ((asked, "request_id", ("_r0", "_r1")), (held, "entity_id", ("_e0", "_e1")))]
    assert searching.set_pairs(asked, held, *sets).count() == 1
    found = searching.ranked_hits(asked, held, 3).groupBy("entity_id").count().collect()
    assert sorted(map(tuple, found)) == [(0, 2000), (1, 2000), (2, 2000)]
