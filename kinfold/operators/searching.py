"""Search by attributes over the feature values and link keys of entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kinfold.operators.features import RULES, search_values, with_features
from kinfold.operators.ordered import ranked_within
from kinfold.operators.relating import TYPES, level_of
from kinfold.operators.skew import HOT_FLOOR, hot_keys, salted_join
from kinfold.session import materialize

TOP = 100  # entities in a result list, unless the caller gives another number
RARE = 200  # holders of a value that are compared one by one where only the best are asked for
VALUE = ["ftype", "value"]


def request_features(requests: DataFrame) -> DataFrame:
    """(request_id, ftype, value) of (request_id, payload) requests."""
    shaped = requests.select(
        F.col("request_id").alias("record_seq"), F.lit("").alias("dataSource"), F.lit("").alias("recordId"), "payload"
    )
    return search_values(with_features(shaped)).withColumnRenamed("record_seq", "request_id")


def search(requests: DataFrame, values: DataFrame, top: int | None = None, floor: int = HOT_FLOOR) -> DataFrame:
    """``ranked_hits`` of (request_id, payload) requests over ``values`` (entity_id, ftype, value), those of ``features.search_values``."""
    asked = materialize(request_features(requests), "asked")
    held = values.join(asked.select("ftype", "value").distinct(), ["ftype", "value"], "left_semi")
    return ranked_hits(asked, held, top, floor)


def ranked_hits(asked: DataFrame, held: DataFrame, top: int | None = None, floor: int = HOT_FLOOR, rare: int = RARE) -> DataFrame:
    """(request_id, rank, entity_id, shared, match_level_code): the entities that share a value with a request, best first.

    ``asked`` (request_id, ftype, value) and ``held`` (entity_id, ftype, value), each row once, are stored or cheap. All holders of a value answer. An entity that shares a link key
    is RESOLVED: adding the request would merge it. ``top`` keeps the best ones of each request, see ``best_hits``: holders of values that more than ``rare`` entities have
    are then compared as sets, not one by one. Without it the ranks come from a range sort, so a request that everybody answers is not one task's work either.
    """
    held = materialize(held, "held")
    weights = materialize(held.groupBy(*VALUE).agg(F.count(F.lit(1)).alias("n")), "weights")
    hot = hot_keys(weights, VALUE, floor=floor)
    often = None if top is None else weights.filter(F.col("n") > rare)
    if often is None or often.isEmpty():
        counted = _counted(salted_join(held, asked, VALUE, hot), "request_id", "entity_id")
    else:
        counted = best_hits(asked, held, often.drop("n"), hot, top, floor)
    levelled = counted.select("request_id", "entity_id", *_level())
    if top is None:
        ranked = ranked_within(levelled, ["request_id"], _order("entity_id"))
    else:
        ranked = _first(levelled, ["request_id"], _order("entity_id"), top, "rank")
    return ranked.select("request_id", "rank", "entity_id", "shared", "match_level_code")


def _counted(hits: DataFrame, *by: str) -> DataFrame:
    """The number of shared values by type: link keys in `_merging`, all in `shared`."""
    return hits.groupBy(*by).agg(
        F.count(F.lit(1)).alias("shared"),
        F.count_if(F.col("ftype").isin([rule.code for rule in RULES])).alias("_merging"),
        *[F.count_if(F.col("ftype") == t).alias(f"_{t}") for t in TYPES],
    )


def _level() -> list[Column]:
    level, _ = level_of({t: F.col(f"_{t}") for t in TYPES})
    return [F.col("shared"), F.when(F.col("_merging") > 0, F.lit("RESOLVED")).otherwise(level).alias("match_level_code")]


def _order(entity: str) -> list[Column]:
    return [(F.col("match_level_code") == "RESOLVED").desc(), F.col("shared").desc(), F.col(entity)]


def _first(rows: DataFrame, by: list[str], order: list[Column], n: int, rank: str) -> DataFrame:
    """The first ``n`` rows of each group; every task passes on that many of a group at most."""
    return rows.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col(rank) <= n)


def _sets(rows: DataFrame, owner: str, names: tuple[str, str]) -> DataFrame:
    """(owner, names): two 64-bit digests of the set of values of each owner, which combine before the shuffle."""
    return rows.groupBy(owner).agg(*[F.bit_xor(F.xxhash64(*VALUE, F.lit(salt))).alias(name) for salt, name in enumerate(names)])


def set_pairs(asked: DataFrame, held: DataFrame, requests: DataFrame, entities: DataFrame) -> DataFrame:
    """(_r0, _r1, _e0, _e1, least, counts): every set of asked values with every set of held ones that it shares a value with, one row however many have these sets.

    ``least`` is the smallest entity of the set. ``requests`` and ``entities`` are the ``_sets`` of the two sides.
    """
    first = requests.groupBy("_r0", "_r1").agg(F.min("request_id").alias("request_id"))
    least = entities.groupBy("_e0", "_e1").agg(F.min("entity_id").alias("entity_id"))
    mine, other = asked.join(first, "request_id").drop("request_id"), held.join(least, "entity_id").withColumnRenamed("entity_id", "least")
    return _counted(mine.join(other, VALUE), "_r0", "_r1", "_e0", "_e1", "least")


def best_hits(asked: DataFrame, held: DataFrame, often: DataFrame, hot: list[tuple], top: int, floor: int = HOT_FLOOR) -> DataFrame:
    """(request_id, entity_id, counts): the ``top`` best entities of each request, and others.

    Holders of a value that is not in ``often`` (ftype, value) meet its requests one by one. An entity that shares only values of ``often`` with a request counts like all
    entities with the same set of these; of a set no more than its ``top`` smallest entities can be among the best, and of all sets no more than the ``top`` best
    by their smallest entity. So frequent values cost a row for each pair of sets, not for each request and holder, and nothing is left out.
    """
    flags = often.withColumn("_often", F.lit(True))
    held = materialize(salted_join(held, flags, VALUE, hot, "left"), "held-flagged")
    asked_hot = hot_keys(asked.groupBy(*VALUE).agg(F.count(F.lit(1)).alias("n")), VALUE, floor=floor)
    asked = materialize(salted_join(asked, flags, VALUE, asked_hot, "left"), "asked-flagged")
    few, many = [frame.filter("_often IS NULL").drop("_often") for frame in (asked, held)], [frame.filter("_often").drop("_often") for frame in (asked, held)]
    requests = materialize(_sets(many[0], "request_id", ("_r0", "_r1")), "request-sets")
    entities = materialize(_sets(many[1], "entity_id", ("_e0", "_e1")), "entity-sets")
    pairs = materialize(set_pairs(*many, requests, entities), "set-pairs")
    counts = [c for c in pairs.columns if c not in ("_r0", "_r1", "_e0", "_e1", "least")]

    single = _counted(salted_join(few[0], few[1], VALUE, asked_hot), "request_id", "entity_id").join(requests, "request_id", "left").join(entities, "entity_id", "left")
    also = pairs.select("_r0", "_r1", "_e0", "_e1", *[F.col(c).alias(f"_also{c}") for c in counts])
    single = single.join(also, ["_r0", "_r1", "_e0", "_e1"], "left").select(
        "request_id", "entity_id", *[(F.col(c) + F.coalesce(f"_also{c}", F.lit(0))).alias(c) for c in counts]
    )

    of_set = _first(entities, ["_e0", "_e1"], [F.col("entity_id")], top, "_n").drop("_n")
    kept = _first(pairs.select("*", _level()[1]), ["_r0", "_r1"], _order("least"), top, "_n").drop("_n", "match_level_code", "least")
    best = _first(kept.join(of_set, ["_e0", "_e1"]).select("*", _level()[1]), ["_r0", "_r1"], _order("entity_id"), top, "_n")
    shown = best.join(requests, ["_r0", "_r1"]).select("request_id", "entity_id", *counts)
    # An entity that comes both ways has the larger counts the first way.
    return single.unionByName(shown).groupBy("request_id", "entity_id").agg(*[F.max(c).alias(c) for c in counts])


def search_results(requests: DataFrame, hits: DataFrame) -> DataFrame:
    """(requestJson, resultJson), one row per request, an empty list when nothing was found. A list is one value: ``hits`` should be cut to the best ones."""
    entry = F.struct(
        F.struct(
            F.struct(F.col("entity_id").alias("ENTITY_ID")).alias("RESOLVED_ENTITY")
        ).alias("ENTITY"),
        F.struct(F.col("match_level_code").alias("MATCH_LEVEL_CODE"), F.col("shared").alias("SHARED")).alias("MATCH_INFO"),
    )
    lists = hits.groupBy("request_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", entry.alias("e")))).alias("_found")
    )
    joined = requests.join(lists, "request_id", "left")
    found = F.coalesce(F.transform("_found", lambda x: x["e"]), F.array().cast(
        "array<struct<ENTITY: struct<RESOLVED_ENTITY: struct<ENTITY_ID: bigint>>, "
        "MATCH_INFO: struct<MATCH_LEVEL_CODE: string, SHARED: bigint>>>"
    ))
    return joined.select(
        F.col("payload").alias("requestJson"), F.to_json(F.struct(found.alias("RESOLVED_ENTITIES"))).alias("resultJson")
    )
