"""The entity mart: its tables, one sync pass, and the reports on it."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from kinfold.functions.docs import (
    document_frame, entity_frame, parse_documents, record_frame, relation_frame,
)
from kinfold.operators.documents import quarantine_rows, tombstones
from kinfold.operators.upsert import (
    RELATION_KEY, change_gate, departed_records, fold_relations, verify_departed,
)
from kinfold.plans.keyed_table import BUCKETS, KeyedTable, VersionedTables
from kinfold.schemas import MART
from kinfold.session import in_parallel, materialize, temporary

# Keys that place a row, and lookups. Records are found by their entity and relations by either end without a scan.
LAYOUT = {
    "entity": (("entity_id",), ()),
    "entity_doc": (("entity_id",), ()),
    "entity_record": ((), (("entity_id",),)),
    "relationship": (("entity_id_lo",), (("entity_id_hi",),)),
    "_quarantine": (("entity_id",), ()),
}


class EntityMart(VersionedTables):
    """Four replicated tables plus `_sync_state` and `_quarantine`."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        super().__init__(spark, path, MART, accumulate=("relationship",), layout=LAYOUT, buckets=buckets)

    def sync(self, fetched: DataFrame | Callable[[], DataFrame], live: DataFrame | None = None, whole_relations: bool = False) -> int:
        """Apply one batch of fetched entities; returns the sequence number of the pass.

        ``fetched`` may be a function that fetches them: what it stores on its way is removed before the rows are parsed.
        ``live`` lists the (data_source, record_id) keys that exist anywhere: without it a record that
        left a refreshed entity counts as gone, and its new entity's own refresh brings it back. ``whole_relations``: a document
        lists all relations of its entity, so a stored one that a refreshed entity no longer has is ended.

        All reads are restricted to the buckets of the batch's entities and of the records and relations they hold. In the first pass nothing is
        stored yet: each document is new and no row can end, so nothing is read, compared or stored a second time.
        """
        with temporary(self.spark):
            state = self.state()
            tables, before = self.current(state), int(state.get(self.SEQ, 0))
            seq = before + 1
            with temporary(self.spark) as keep:
                fetched = keep(materialize(fetched() if callable(fetched) else fetched, "fetched"))
            gone = materialize(tombstones(fetched).distinct(), "gone")
            rows = {"_quarantine": (quarantine_rows(fetched), None)}
            with temporary(self.spark) as keep:
                # Parsed once and stored: four tables and the gate read from it.
                documents = fetched.filter(F.col("kind") == "ENTITY").select("json", "page")
                parsed = materialize(parse_documents(documents, page="page"), "parsed")
                fresh = keep(self._changed(tables, before, parsed) if before else parsed)
            if before:
                rows |= self._differences(tables, before, fresh, gone, live, whole_relations)
            else:
                pairs = fold_relations(relation_frame(fresh))
                for end in RELATION_KEY:
                    pairs = pairs.join(gone.withColumnRenamed("entity_id", end), end, "left_anti")
                of = {"entity": entity_frame(fresh), "entity_doc": document_frame(fresh), "entity_record": one_owner(record_frame(fresh)), "relationship": pairs}
                rows |= {name: (frame, None) for name, frame in of.items()}
            in_parallel(self.spark, *[partial(tables[name].write, seq, *frames) for name, frames in rows.items()])
            self.commit(seq)
            return seq

    def _changed(self, tables: dict[str, KeyedTable], before: int, parsed: DataFrame) -> DataFrame:
        """The parsed documents that differ from what is stored as of pass ``before``, stored."""
        stored_hash = tables["entity"].read(before, ["entity_hash"], only=parsed.select("entity_id").distinct())
        return materialize(change_gate(parsed, stored_hash), "changed")

    def _differences(
        self, tables: dict[str, KeyedTable], before: int, changed: DataFrame, gone: DataFrame, live: DataFrame | None, whole_relations: bool
    ) -> dict[str, tuple[DataFrame, DataFrame | None]]:
        """Per table the rows that the changed documents of a batch write and those that they end, against what is stored as of pass ``before``."""
        refreshed = materialize(changed.groupBy("entity_id").agg(F.sum("record_count").alias("n")), "refreshed")
        touched = materialize(refreshed.select("entity_id").unionByName(gone), "touched")

        def lapsed(table: str) -> DataFrame:
            """Stored pages of refreshed entities that the fresh document no longer has, and all pages
            of gone entities."""
            stored = tables[table].read(before, [], only=touched).select("entity_id", "page")
            return stored.join(changed.select("entity_id", "page"), ["entity_id", "page"], "left_anti")

        fresh = record_frame(changed)
        owned = materialize(tables["entity_record"].read(before, ["entity_id"], only=touched), "owned")
        departed = departed_records(owned, fresh, refreshed).select("data_source", "record_id")
        if live is not None:
            departed = verify_departed(departed, live)
        of_gone = owned.join(gone, "entity_id", "left_semi").select("data_source", "record_id")

        pairs = fold_relations(relation_frame(changed))
        ended = None
        for end in RELATION_KEY:
            at_end = gone.withColumnRenamed("entity_id", end)
            pairs = pairs.join(at_end, end, "left_anti")
            hit = tables["relationship"].read(before, [], only=at_end).select(*RELATION_KEY)
            ended = hit if ended is None else ended.unionByName(hit)
        if whole_relations:
            pairs = materialize(pairs, "pairs")
            for end in RELATION_KEY:
                at_end = materialize(refreshed.select(F.col("entity_id").alias(end)), "refreshed-ends")
                held = tables["relationship"].read(before, [], only=at_end).select(*RELATION_KEY)
                ended = ended.unionByName(held.join(pairs, RELATION_KEY, "left_anti"))

        return {
            "entity": (entity_frame(changed), lapsed("entity")),
            "entity_doc": (document_frame(changed), lapsed("entity_doc")),
            "entity_record": (one_owner(fresh), departed.unionByName(of_gone)),
            "relationship": (pairs, ended),
        }


def one_owner(records: DataFrame) -> DataFrame:
    """One row per record key. Two documents of different age may both list a record that moved; the
    entity with the greater number counts until the older document is refreshed."""
    values = [c for c in records.columns if c not in ("data_source", "record_id")]
    newest = records.groupBy("data_source", "record_id").agg(F.max_by(F.struct(*values), "entity_id").alias("_row"))
    return newest.select("data_source", "record_id", "_row.*").select(*records.columns)


# --- reports ---------------------------------------------------------------------------------

def source_summary(records: DataFrame) -> DataFrame:
    return records.groupBy("data_source").agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct("entity_id").alias("entities")
    )


def source_overlap(records: DataFrame) -> DataFrame:
    """Entities per pair of sources. Entities with the same set of sources are counted first, so pairs
    are formed once per distinct set and not per entity."""
    held = records.select("entity_id", "data_source").distinct()
    sets = held.groupBy("entity_id").agg(F.array_sort(F.collect_set("data_source")).alias("sources"))
    counted = sets.filter(F.size("sources") > 1).groupBy("sources").agg(F.count(F.lit(1)).alias("n"))
    pairs = F.flatten(F.transform("sources", lambda a, i: F.transform(
        F.slice("sources", i + 2, F.size("sources")), lambda b: F.struct(a.alias("source_a"), b.alias("source_b"))
    )))
    return counted.select("n", F.inline(pairs)).groupBy("source_a", "source_b").agg(F.sum("n").alias("entities"))


def entity_sizes(records: DataFrame) -> DataFrame:
    sizes = records.groupBy("entity_id").agg(F.count(F.lit(1)).alias("size"))
    return sizes.groupBy("size").agg(F.count(F.lit(1)).alias("entities"))


def match_keys(records: DataFrame) -> DataFrame:
    return records.groupBy("match_key").agg(F.count(F.lit(1)).alias("records"))
