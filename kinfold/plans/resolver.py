"""Resolve, add, delete and redo as set operations over records and their membership."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from kinfold.operators.features import LinkRule, RULES, batch_values, link_keys, relating_values, with_features
from kinfold.operators.linking import components, membership, star_links
from kinfold.operators.relating import (
    anchored_pairs, block_index, deferred_blocks, entity_values, relations, score_pairs,
)
from kinfold.operators.skew import HOT_FLOOR
from kinfold.session import materialize

KEY = ["dataSource", "recordId"]


@dataclass(frozen=True)
class Resolution:
    """Stored products of a resolve: `keys` (record_seq, rule, key), `moved` (record_seq, entity_id),
    `members` with one row per record."""

    keys: DataFrame
    links: DataFrame
    moved: DataFrame
    members: DataFrame


def resolve(records: DataFrame, rules: list[LinkRule] = RULES, floor: int = HOT_FLOOR) -> Resolution:
    """Cluster (record_seq, dataSource, recordId, payload) records."""
    keys = materialize(link_keys(with_features(records), rules), "keys")
    links = star_links(keys, floor)
    moved = components(links, floor)
    return Resolution(keys, links, moved, membership(records, moved))


def relation_index(records: DataFrame, moved: DataFrame, floor: int = HOT_FLOOR) -> DataFrame:
    """Stored block index over the entities of a resolution."""
    values = materialize(entity_values(relating_values(with_features(records)), moved), "values")
    return materialize(block_index(values, floor), "blocks")


def relate(index: DataFrame, over: int, redo_done: DataFrame | None = None) -> DataFrame:
    """Scored entity pairs of the values with at most ``over`` holders, plus those whose redo is done."""
    evidence = anchored_pairs(index.filter(F.col("n") <= over))
    if redo_done is not None:
        done = index.join(redo_done.select("ftype", "value"), ["ftype", "value"], "left_semi")
        evidence = evidence.unionByName(anchored_pairs(done))
    return score_pairs(evidence)


def relate_all(index: DataFrame) -> DataFrame:
    """Scored entity pairs over all values, the result of a relate and a drained redo."""
    return score_pairs(anchored_pairs(index))


# --- affected entities -----------------------------------------------------------------------

def affected_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """(dataSource, recordId, entityId): both ids of every record whose entity differs."""
    old = before.select(*KEY, F.col("entity_id").alias("_old"))
    new = after.select(*KEY, F.col("entity_id").alias("_new"))
    changed = old.join(new, KEY, "full").filter(~F.col("_old").eqNullSafe(F.col("_new")))
    ids = F.filter(F.array("_old", "_new"), lambda i: i.isNotNull())
    return changed.select(*KEY, F.explode(ids).alias("entityId"))


def _affected(touches: DataFrame, op: str, run_id: str) -> DataFrame:
    """One row per entity, that of the smallest record key which touched it."""
    first = touches.groupBy("entityId").agg(F.min(F.struct(*KEY)).alias("_k"))
    return first.select(
        "_k.dataSource", "_k.recordId", "entityId", F.lit(op).alias("op"), F.lit(run_id).alias("runId")
    )


# --- incremental verbs -----------------------------------------------------------------------


class FrameState:
    """Resolver state held as two frames; every lookup is a semi join."""

    def __init__(self, keys: DataFrame, members: DataFrame):
        self.keys, self.members = keys, members

    def members_of(self, only: DataFrame) -> DataFrame:
        """Member rows that match ``only`` on its columns: the record key, `record_seq` or `entity_id`."""
        return self.members.select(*_MEMBER).join(only, only.columns, "left_semi")

    def keys_of(self, records: DataFrame) -> DataFrame:
        """(record_seq, rule, key) of the records (record_seq)."""
        return self.keys.select("record_seq", "rule", "key").join(records, "record_seq", "left_semi")

    def holders(self, wanted: DataFrame) -> DataFrame:
        """(rule, key, record_seq): one record for each (rule, key) that any record holds. One is enough: all holders are one entity."""
        held = self.keys.join(wanted, ["rule", "key"], "left_semi")
        return held.groupBy("rule", "key").agg(F.min("record_seq").alias("record_seq"))


@dataclass(frozen=True)
class Change:
    """What a verb did. ``members`` holds only the rows that changed or were added, with the entity
    before as `old_id`; ``lost`` the members that left with theirs; ``holders`` (rule, key, record_seq) the record that
    stands for each key of the batch and of lost records, where one is left, and ``free`` (rule, key) the others. All are stored frames."""

    members: DataFrame
    lost: DataFrame
    fresh_keys: DataFrame | None
    affected: DataFrame
    holders: DataFrame | None = None
    free: DataFrame | None = None

    def apply_to_members(self, members: DataFrame) -> DataFrame:
        gone = self.lost.select("record_seq").unionByName(self.members.select("record_seq"))
        return members.select(*_MEMBER).join(gone, "record_seq", "left_anti").unionByName(self.members.select(*_MEMBER))

    def apply_to_keys(self, keys: DataFrame) -> DataFrame:
        kept = keys.join(self.lost, "record_seq", "left_anti")
        return kept if self.fresh_keys is None else kept.unionByName(self.fresh_keys.select(*kept.columns))


_MEMBER = ["record_seq", *KEY, "entity_id"]
_INDEX = ["rule", "key", "record_seq"]


def _recluster(state, lost: DataFrame, floor: int) -> tuple[DataFrame, DataFrame]:
    """(members, keys): what is left of the entities that lost a record, clustered again, and its link keys; all other entities stay as
    they are. ``lost`` holds (record_seq, old_id)."""
    shaken = lost.select(F.col("old_id").alias("entity_id")).distinct()
    part = materialize(state.members_of(shaken).join(lost, "record_seq", "left_anti"), "shaken")
    if part.isEmpty():
        return part.withColumn("old_id", F.col("entity_id")), part.select(
            "record_seq", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("binary").alias("key")
        )
    keys = materialize(state.keys_of(part.select("record_seq")).select("record_seq", "rule", "key"), "shaken-keys")
    moved = components(star_links(keys, floor), floor)
    again = membership(part, moved).join(part.select("record_seq", F.col("entity_id").alias("old_id")), "record_seq")
    return materialize(again.select(*_MEMBER, "old_id"), "reclustered"), keys


def _lost(state, leaving: DataFrame) -> DataFrame:
    """(record_seq, key, old_id) of the records (by key, a stored frame) that are known."""
    found = state.members_of(leaving)
    return materialize(found.select("record_seq", *KEY, F.col("entity_id").alias("old_id")), "lost")


def _standing(state, wanted: DataFrame, lost: DataFrame, left_keys: DataFrame) -> DataFrame:
    """(rule, key, record_seq) for the ``wanted`` keys: the record that stands for the key, or, where that one is lost, another of its old entity."""
    stays = state.holders(wanted).join(lost, "record_seq", "left_anti").select(*_INDEX)
    other = left_keys.join(wanted, ["rule", "key"], "left_semi").select(*_INDEX)
    return stays.unionByName(other).groupBy("rule", "key").agg(F.min("record_seq").alias("record_seq")).select(*_INDEX)


def add_records(
    keys: DataFrame, members: DataFrame, batch: DataFrame, run_id: str,
    rules: list[LinkRule] = RULES, floor: int = HOT_FLOOR,
) -> tuple[DataFrame, Change]:
    """``add_to`` on state held as frames."""
    numbered, _, change = add_to(FrameState(keys, members), batch, run_id, rules, floor)
    return numbered, change


def add_to(
    state, batch: DataFrame, run_id: str, rules: list[LinkRule] = RULES, floor: int = HOT_FLOOR
) -> tuple[DataFrame, DataFrame, Change]:
    """Add or replace ``batch``; returns the batch with its final record numbers, its values (``features.batch_values``), and the change.

    ``batch`` has a free `record_seq` for new records; a record known by its key keeps its number.
    Entities already resolved enter the clustering as single nodes, found through one holder for each key. So what is asked of ``state`` depends on the batch,
    the keys it meets, and the entities that lose a replaced record or are merged into another one.
    """
    lost, numbered = known_numbers(state, batch)
    values, change = add_numbered(state, lost, numbered, run_id, rules, floor)
    return numbered, values, change


def known_numbers(state, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The records of ``batch`` that are known already, and the batch with the numbers of these. Both are stored frames; ``batch`` need not be one."""
    lost = _lost(state, materialize(batch.select(*KEY), "batch-records"))
    known = lost.select(*KEY, F.col("record_seq").alias("_old"))
    numbered = batch.join(known, KEY, "left").select(F.coalesce("_old", "record_seq").alias("record_seq"), *KEY, "payload")
    return lost, materialize(numbered, "batch")


def add_numbered(
    state, lost: DataFrame, numbered: DataFrame, run_id: str, rules: list[LinkRule] = RULES, floor: int = HOT_FLOOR
) -> tuple[DataFrame, Change]:
    """``add_to`` from the batch with its final numbers on; returns its values and the change. Of the texts only digests are stored."""
    values = materialize(batch_values(with_features(numbered), rules), "batch-values")
    fresh_keys = materialize(values.filter("linking").select("record_seq", F.col("ftype").alias("rule"), F.col("value").alias("key")), "batch-keys")
    again, left_keys = _recluster(state, lost, floor)

    # Entities reachable by a key of the batch, as nodes next to the batch records.
    of_lost = materialize(state.keys_of(lost.select("record_seq")).select("rule", "key").distinct(), "lost-keys")
    wanted = materialize(fresh_keys.select("rule", "key").unionByName(of_lost).distinct(), "wanted")
    standing = materialize(_standing(state, wanted, lost, left_keys), "standing")
    met = standing.join(fresh_keys.select("rule", "key"), ["rule", "key"], "left_semi")
    settled = state.members_of(materialize(met.select("record_seq").distinct(), "met")).select("record_seq", "entity_id")
    current = settled.join(again.select("record_seq", F.col("entity_id").alias("_new")), "record_seq", "left").select(
        "record_seq", F.coalesce("_new", "entity_id").alias("entity_id")
    )
    nodes = met.join(current, "record_seq").select(F.col("entity_id").alias("record_seq"), "rule", "key").distinct()
    roots = components(star_links(nodes.unionByName(fresh_keys.select("record_seq", "rule", "key")), floor), floor)

    root_of = materialize(roots.select(F.col("record_seq").alias("entity_id"), F.col("entity_id").alias("_root")), "roots")

    def rooted(frame: DataFrame) -> DataFrame:
        return frame.join(root_of, "entity_id", "left").withColumn("entity_id", F.coalesce("_root", "entity_id")).drop("_root")

    merging = state.members_of(root_of.select("entity_id"))
    untouched = merging.join(again.select("record_seq").unionByName(lost.select("record_seq")), "record_seq", "left_anti")
    merged = rooted(untouched.withColumn("old_id", F.col("entity_id")))
    landed = membership(numbered, roots).join(lost.select("record_seq", "old_id"), "record_seq", "left")
    columns = [*_MEMBER, "old_id"]
    changed = materialize(
        rooted(again).select(*columns).unionByName(merged.select(*columns)).unionByName(landed.select(*columns)), "changed"
    )
    holders = standing.unionByName(fresh_keys.select(*_INDEX)).groupBy("rule", "key").agg(F.min("record_seq").alias("record_seq"))
    holders = materialize(holders.select(*_INDEX), "holders")
    own = changed.join(numbered.select("record_seq"), "record_seq", "left_semi").select(*KEY, F.col("entity_id").alias("entityId"))
    touches = own.unionByName(_moves(changed))
    free = of_lost.join(holders, ["rule", "key"], "left_anti")
    return values, Change(changed, lost, fresh_keys, _affected(touches, "ADD", run_id), holders, free)


def _moves(changed: DataFrame) -> DataFrame:
    """(dataSource, recordId, entityId): both ids of every changed row whose entity differs."""
    moved = changed.filter(~F.col("entity_id").eqNullSafe(F.col("old_id")))
    ids = F.filter(F.array("old_id", "entity_id"), lambda i: i.isNotNull())
    return moved.select(*KEY, F.explode(ids).alias("entityId"))


def delete_records(keys: DataFrame, members: DataFrame, batch: DataFrame, run_id: str, floor: int = HOT_FLOOR) -> Change:
    """``delete_from`` on state held as frames."""
    return delete_from(FrameState(keys, members), batch, run_id, floor)


def delete_from(state, batch: DataFrame, run_id: str, floor: int = HOT_FLOOR) -> Change:
    """Remove ``batch`` (by record key); an absent record is a no-op without an error row."""
    lost = _lost(state, materialize(batch.select(*KEY), "batch-records"))
    again, left_keys = _recluster(state, lost, floor)
    of_lost = materialize(state.keys_of(lost.select("record_seq")).select("rule", "key").distinct(), "lost-keys")
    holders = materialize(_standing(state, of_lost, lost, left_keys), "holders")
    touches = _moves(again).unionByName(lost.select(*KEY, F.col("old_id").alias("entityId")))
    return Change(again, lost, None, _affected(touches, "DELETE", run_id), holders, of_lost.join(holders, ["rule", "key"], "left_anti"))


# --- redo ------------------------------------------------------------------------------------

def take_redo(deferred: DataFrame, limit: int) -> DataFrame:
    """The next deferred blocks, largest first."""
    return deferred.orderBy(F.col("n").desc(), "ftype", "value").limit(limit)


def redo_affected(index: DataFrame, taken: DataFrame, run_id: str) -> DataFrame:
    """Entities that processing the taken blocks relates to another one."""
    touched = index.join(taken.select("ftype", "value"), ["ftype", "value"], "left_semi")
    return touched.select(F.col("entity_id").alias("entityId")).distinct().select(
        "entityId", F.lit("REDO").alias("op"), F.lit(run_id).alias("runId")
    )


def drain_redo(index: DataFrame, limit: int, over: int) -> tuple[DataFrame, int]:
    """Process deferred blocks batch by batch until none is left *now*; returns the processed blocks
    and the number of batches. A batch leaves the queue only after its result is stored."""
    waiting = materialize(deferred_blocks(index, over), "deferred")
    done, batches = None, 0
    while True:
        taken = materialize(take_redo(waiting, limit), "redo")
        if taken.isEmpty():
            return (taken if done is None else done), batches
        done = taken if done is None else done.unionByName(taken)
        waiting = materialize(waiting.join(taken.select("ftype", "value"), ["ftype", "value"], "left_anti"), "deferred")
        batches += 1


def entity_relations(index: DataFrame) -> DataFrame:
    return relations(relate_all(index))
