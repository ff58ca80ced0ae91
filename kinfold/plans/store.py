"""Stored resolver state and the jobs on it: register, add or update, delete, search, redo."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from kinfold.operators import gates, outcomes as out, relating, searching
from kinfold.operators.features import search_values, relating_values, with_features
from kinfold.operators.ordered import number_rows
from kinfold.plans import resolver
from kinfold.plans.keyed_table import BUCKETS, KeyedTable, VersionedTables
from kinfold.schemas import struct
from kinfold.session import in_parallel, materialize, temporary

KEY = ["dataSource", "recordId"]

SHAPES = {
    "record": (struct("dataSource string, recordId string, record_seq bigint, payload string"), KEY),
    "member": (struct("record_seq bigint, dataSource string, recordId string, entity_id bigint"), ["record_seq"]),
    "link_key": (
        struct("record_seq bigint, rule string, key nested", key=T.BinaryType()), ["record_seq", "rule", "key"],
    ),
    "holder": (struct("rule string, key nested, record_seq bigint", key=T.BinaryType()), ["rule", "key"]),
    "value": (struct("ftype string, value nested, record_seq bigint", value=T.BinaryType()), ["ftype", "value", "record_seq"]),
    "registry": (struct("data_source string, note string"), ["data_source"]),
}


# Keys that place a row, and lookups; see ``plans/keyed_table.py``.
LAYOUT = {
    "member": ((), (tuple(KEY), ("entity_id",))),
    "link_key": (("record_seq",), ()),
    "value": (("ftype", "value"), ()),
}


class StoredState:
    """What ``resolver.add_to`` and ``delete_from`` ask, answered from the buckets of the rows asked for."""

    def __init__(self, tables: dict[str, KeyedTable], seq: int):
        self.tables, self.seq = tables, seq

    def members_of(self, only: DataFrame) -> DataFrame:
        return self.tables["member"].read(self.seq, only=only).drop("refresh_seq")

    def keys_of(self, records: DataFrame) -> DataFrame:
        return self.tables["link_key"].read(self.seq, only=records).drop("refresh_seq")

    def holders(self, wanted: DataFrame) -> DataFrame:
        return self.tables["holder"].read(self.seq, only=wanted).drop("refresh_seq")


class ResolverStore(VersionedTables):
    """Records, their entities, link keys and search values, moved forward batch by batch.

    `holder` is the inverted index of the link keys: one record for each (rule, key), since all records with one key are one entity. `value` has the postings of the
    search. A batch reads the buckets of its own records and keys, and of the entities it takes apart or merges.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, shapes: dict = {}, layout: dict = {}):
        """``shapes`` and ``layout`` add tables of a subclass."""
        super().__init__(spark, path, SHAPES | shapes, layout=LAYOUT | layout, buckets=buckets)

    def _next(self) -> tuple[int, int, int, dict[str, KeyedTable]]:
        state = self.state()
        seq = int(state.get(self.SEQ, 0))
        return seq, seq + 1, int(state.get("next_record", 0)), self.current(state)

    def register(self, sources: DataFrame) -> int:
        """Add data sources (`data_source`). Running jobs see them with their next batch."""
        seq, now, number, tables = self._next()
        tables["registry"].write(now, sources.select("data_source", F.lit("").alias("note")).distinct())
        self.commit(now, next_record=number)
        return now

    def check(self, records: DataFrame, op: str) -> DataFrame:
        """Both gates over input records."""
        return gates.gate_registered_source(gates.gate_required_keys(records, op), self.read("registry", columns=[]))

    def _values_of(self, seq: int, tables: dict[str, KeyedTable], records: DataFrame) -> DataFrame:
        """(ftype, value, record_seq) that stored records (by key) have put into the postings."""
        held = tables["record"].read(seq, only=records.select(*KEY).distinct())
        return search_values(with_features(held.select("record_seq", *KEY, "payload"))).select("ftype", "value", "record_seq")

    def _advance(self, seq: int, now: int, number: int, tables: dict, change: resolver.Change, batch: DataFrame | None, values: DataFrame | None) -> None:
        """Store what changed: records, members, and the keys and values of new, replaced and lost records."""
        lost = change.lost
        old_keys = materialize(tables["link_key"].read(seq, only=lost.select("record_seq")).select("record_seq", "rule", "key"), "old-keys")
        old_values = materialize(self._values_of(seq, tables, lost), "old-values")
        gone = lost.select(*KEY) if batch is None else None
        left = lost if batch is None else lost.join(batch, "record_seq", "left_anti")
        in_parallel(
            self.spark,
            partial(tables["record"].write, now, batch, gone),
            partial(tables["member"].write, now, change.members, left),
            partial(tables["link_key"].write, now, change.fresh_keys, old_keys),
            partial(tables["holder"].write, now, change.holders, change.free),
            partial(tables["value"].write, now, values, old_values),
            *self._along(seq, now, tables, change, values, old_values),
        )
        self.commit(now, next_record=number)

    def _along(self, seq: int, now: int, tables: dict, change: resolver.Change, values: DataFrame | None, old_values: DataFrame) -> list:
        """Further writes of a subclass in the same pass."""
        return []

    def add(self, records: DataFrame, run_id: str, number: str | None = None) -> DataFrame:
        """Add or update input records; returns outcome rows. Of one key given twice in a batch one row
        counts: the later one where both come from the same input file. ``number`` names a column with record numbers of the caller's own, which must be
        free or the record's number already; without it new records are numbered here."""
        with temporary(self.spark) as keep:
            seq, now, first, tables = self._next()
            state = StoredState(tables, seq)
            with temporary(self.spark) as numbered_alone:
                checked = materialize(self.check(records, "ADD"), "checked")
                rejected = numbered_alone(materialize(gates.rejected(checked), "rejected"))
                order = F.monotonically_increasing_id()
                kept = ["payload", *([number] if number else [])]
                latest = gates.passed(checked).withColumn("_at", order).groupBy(*KEY).agg(F.max_by(F.struct(*kept), "_at").alias("_row")).select(*KEY, "_row.*")
                batch = latest.withColumnRenamed(number, "record_seq") if number else number_rows(latest, first)
                lost, numbered = map(numbered_alone, resolver.known_numbers(state, batch.select("record_seq", *KEY, "payload")))
            top, rows = numbered.agg(F.max("record_seq"), F.count(F.lit(1))).first()
            values, change = resolver.add_numbered(state, lost, numbered, run_id)
            self._advance(seq, now, max(first + rows, (top or 0) + 1), tables, change, numbered, values.select("ftype", "value", "record_seq"))
            return keep(materialize(out.outcome_union(affected=change.affected, errors=rejected), "outcomes"))

    def delete(self, records: DataFrame, run_id: str) -> DataFrame:
        """Delete input records by key; absent ones are a no-op."""
        with temporary(self.spark) as keep:
            seq, now, number, tables = self._next()
            checked = materialize(gates.gate_required_keys(records, "DELETE"), "checked")
            leaving = materialize(gates.passed(checked).select(*KEY).distinct(), "leaving")
            change = resolver.delete_from(StoredState(tables, seq), leaving, run_id)
            self._advance(seq, now, number, tables, change, None, None)
            return keep(materialize(out.outcome_union(affected=change.affected, errors=gates.rejected(checked)), "outcomes"))

    def hits(self, asked: DataFrame) -> DataFrame:
        """(entity_id, ftype, value): the entities that hold the values of ``asked`` (request_id, ftype, value), read from the buckets of these values and of their holders."""
        seq, _, _, tables = self._next()
        wanted = materialize(asked.select("ftype", "value").distinct(), "wanted")
        postings = materialize(tables["value"].read(seq, only=wanted).drop("refresh_seq"), "postings")
        owners = tables["member"].read(seq, ["entity_id"], only=materialize(postings.select("record_seq").distinct(), "asked-records"))
        return postings.join(owners.select("record_seq", "entity_id"), "record_seq").select("entity_id", "ftype", "value").distinct()

    def find(self, requests: DataFrame, top: int | None = None) -> DataFrame:
        """Ranked entities for (request_id, payload) requests, see ``searching.ranked_hits``; reads only."""
        asked = materialize(searching.request_features(requests), "asked")
        return searching.ranked_hits(asked, self.hits(asked), top)

    def search(self, requests: DataFrame, top: int = searching.TOP) -> DataFrame:
        """Search rows for requests given as input records, the ``top`` best entities for each; reads only."""
        asked = number_rows(requests.select("payload"), 0, "request_id")
        return out.outcome_union(search=searching.search_results(asked, self.find(asked, top)))

    def block_index(self) -> DataFrame:
        """Blocks for relations and redo, see ``resolver.relate`` and ``resolver.drain_redo``."""
        values = relating_values(with_features(self.read("record")))
        moved = self.read("member", columns=["entity_id"]).select("record_seq", "entity_id")
        return materialize(relating.block_index(materialize(relating.entity_values(values, moved), "values")), "blocks")
