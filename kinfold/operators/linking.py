"""From features to entities: star links per key, then connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kinfold.operators.features import MATCH_KEY_OF
from kinfold.operators.skew import HOT_FLOOR, hot_keys, salted_join
from kinfold.session import materialize


def match_key_of(rule: Column, match_keys: dict[str, str] = MATCH_KEY_OF) -> Column:
    table = F.create_map(*[F.lit(x) for pair in match_keys.items() for x in pair])
    return F.try_element_at(table, rule)


def star_links(keys: DataFrame, floor: int = HOT_FLOOR) -> DataFrame:
    """Link every record to the smallest record with the same (rule, key): n - 1 links for n records.

    The links join the same records as all pairs would, because the relation is an equality.
    """
    groups = materialize(
        keys.groupBy("rule", "key").agg(F.min("record_seq").alias("lo"), F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1),
        "groups",
    )
    hot = hot_keys(groups, ["rule", "key"], floor=floor)
    linked = salted_join(keys, groups.drop("n"), ["rule", "key"], hot)
    return linked.filter(F.col("record_seq") > F.col("lo")).select(
        "lo", F.col("record_seq").alias("hi"), "rule"
    )


def _is_star_forest(edges: DataFrame) -> bool:
    """Every node hangs on at most one other, and no node that others hang on hangs itself."""
    ends = edges.select(F.col("hi").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("lo").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    roles = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return roles.filter((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("down") == 1))).isEmpty()


def _hang(edges: DataFrame, node: str, other: str, floor: int, large: bool) -> tuple[DataFrame, DataFrame]:
    """Smallest neighbour per node, and every neighbour paired with it. Fewer edges than the floor
    cannot hold a hot node, which saves the count."""
    lows = edges.groupBy(node).agg(F.min(other).alias("low"), F.count(F.lit(1)).alias("n"))
    hot = hot_keys(lows, [node], floor=floor) if large else []
    return lows, salted_join(edges, lows.drop("n"), [node], hot)


def _round(edges: DataFrame, floor: int) -> DataFrame:
    """One large-star step and one small-star step (Kiveris et al., "Connected Components in
    MapReduce and Beyond", 2014)."""
    many = 2 * edges.count() >= floor
    both = edges.select("hi", "lo").unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
    _, paired = _hang(both, "hi", "lo", floor, many)
    root = F.least("low", "hi")
    large = paired.filter(F.col("lo") > F.col("hi")).select(F.col("lo").alias("hi"), root.alias("lo")).distinct()
    lows, paired = _hang(large, "hi", "lo", floor, many)
    small = paired.filter(F.col("lo") != F.col("low")).select(F.col("lo").alias("hi"), F.col("low").alias("lo"))
    return small.unionByName(lows.select("hi", F.col("low").alias("lo"))).distinct()


def components(links: DataFrame, floor: int = HOT_FLOOR) -> DataFrame:
    """(record_seq, entity_id) for every linked record that is not the smallest of its component.

    Each round writes its edges and reads them back, so the plan stays short and a lost executor
    costs one round. Chains halve at every round.
    """
    ordered = links.select(F.greatest("lo", "hi").alias("hi"), F.least("lo", "hi").alias("lo")).filter("hi > lo")
    edges = materialize(ordered.distinct(), "edges")
    while not _is_star_forest(edges):
        edges = materialize(_round(edges, floor), "edges")
    return edges.select(F.col("hi").alias("record_seq"), F.col("lo").alias("entity_id"))


def membership(records: DataFrame, moved: DataFrame) -> DataFrame:
    """(record_seq, dataSource, recordId, entity_id). A record without links is its own entity."""
    return records.select("record_seq", "dataSource", "recordId").join(moved, "record_seq", "left").withColumn(
        "entity_id", F.coalesce("entity_id", "record_seq")
    )
