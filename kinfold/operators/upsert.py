"""Mart changes as joins: upserts, the change gate, departed records and the tombstone cascade."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kinfold.operators.skew import HOT_FLOOR, hot_keys, salted_join


def monotonic_upsert(target: DataFrame, source: DataFrame, keys: list[str], seq: int) -> DataFrame:
    """Target rows replaced by source rows of the same key unless the target row is newer; source rows
    of unknown keys are added. The target carries `refresh_seq`; a key appears once on either side."""
    values = [c for c in target.columns if c not in keys]
    old = target.select(*keys, F.struct(*values).alias("_old"))
    new = source.withColumn("refresh_seq", F.lit(seq).cast("bigint")).select(*keys, F.struct(*values).alias("_new"))
    joined = old.join(new, keys, "full")
    take_new = F.col("_new").isNotNull() & (
        F.col("_old").isNull() | (F.col("_new.refresh_seq") >= F.col("_old.refresh_seq"))
    )
    row = F.when(take_new, F.col("_new")).otherwise(F.col("_old"))
    return joined.select(*keys, row.alias("_row")).select(*keys, "_row.*").select(*target.columns)


RELATION_KEY = ["entity_id_lo", "entity_id_hi"]
RELATION_VALUES = [
    "match_level_code", "match_key", "rev_match_key", "errule_code", "is_disclosed", "is_ambiguous",
]


def fold_relations(source: DataFrame) -> DataFrame:
    """One row per pair: when both ends of a pair are refreshed together, each gives its direction.

    The two reports agree on the other columns unless the documents are of different age; then the
    greater value counts, so that the result does not depend on row order.
    """
    return source.groupBy(*RELATION_KEY).agg(*[F.max(c).alias(c) for c in RELATION_VALUES])


def relationship_upsert(target: DataFrame, source: DataFrame, seq: int) -> DataFrame:
    """Column by column: a null in the new row keeps the stored value, so both directions add up."""
    old = target.select(*RELATION_KEY, F.struct(*RELATION_VALUES, "refresh_seq").alias("_old"))
    new = fold_relations(source).select(*RELATION_KEY, F.struct(*RELATION_VALUES).alias("_new"))
    joined = old.join(new, RELATION_KEY, "full")
    newer = F.col("_new").isNotNull() & (F.col("_old").isNull() | (F.lit(seq) >= F.col("_old.refresh_seq")))
    merged = [
        F.when(newer, F.coalesce(f"_new.{c}", f"_old.{c}")).otherwise(F.col(f"_old.{c}")).alias(c)
        for c in RELATION_VALUES
    ]
    stamp = F.when(newer, F.lit(seq).cast("bigint")).otherwise(F.col("_old.refresh_seq")).alias("refresh_seq")
    return joined.select(*RELATION_KEY, *merged, stamp)


def changed_entities(fresh: DataFrame, stored: DataFrame) -> DataFrame:
    """Entity ids with a page that is new, gone or has another hash. Both frames hold
    (entity_id, page, entity_hash); `stored` may cover more entities than `fresh`."""
    refreshed = fresh.select("entity_id").distinct()
    relevant = stored.join(refreshed, "entity_id", "left_semi").select(
        "entity_id", "page", F.col("entity_hash").alias("_stored")
    )
    joined = fresh.select("entity_id", "page", F.col("entity_hash").alias("_fresh")).join(
        relevant, ["entity_id", "page"], "full"
    )
    return joined.filter(~F.col("_fresh").eqNullSafe(F.col("_stored"))).select("entity_id").distinct()


def change_gate(parsed: DataFrame, stored: DataFrame) -> DataFrame:
    """The parsed documents of changed entities; the rest is dropped before any table is touched."""
    return parsed.join(changed_entities(parsed, stored), "entity_id", "left_semi")


def departed_records(
    stored: DataFrame, fresh: DataFrame, refreshed: DataFrame, floor: int = HOT_FLOOR
) -> DataFrame:
    """(data_source, record_id, entity_id) stored under a refreshed entity but absent from the fresh
    records. ``refreshed`` holds one (entity_id, n) row per refreshed entity, n its fresh records."""
    owned = salted_join(
        stored.select("data_source", "record_id", "entity_id"), refreshed.select("entity_id"), ["entity_id"],
        hot_keys(refreshed, ["entity_id"], floor=floor),
    )
    return owned.join(fresh.select("data_source", "record_id"), ["data_source", "record_id"], "left_anti")


def verify_departed(candidates: DataFrame, live: DataFrame) -> DataFrame:
    """Candidates that exist nowhere any more; one that only moved is kept out of the delete."""
    return candidates.distinct().join(live.select("data_source", "record_id"), ["data_source", "record_id"], "left_anti")


def cascade(tables: dict[str, DataFrame], gone: DataFrame) -> dict[str, DataFrame]:
    """The mart tables without the rows of gone entities. A relation goes when either end is gone;
    two anti-joins on one column each, since a join on `lo or hi` would compare all rows."""
    ids = gone.select("entity_id").distinct()
    left = {
        name: tables[name].join(ids, "entity_id", "left_anti") for name in ("entity", "entity_doc", "entity_record")
    }
    pairs = tables["relationship"]
    for end in RELATION_KEY:
        pairs = pairs.join(ids.withColumnRenamed("entity_id", end), end, "left_anti")
    return {**left, "relationship": pairs.select(*tables["relationship"].columns)}
