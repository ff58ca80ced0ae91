import json
import random

import pytest
from pyspark.sql import functions as F

from kinfold.functions import docs
from kinfold.operators.features import with_features
from kinfold.plans import resolver
from kinfold.plans.mart import EntityMart
from kinfold.plans.related import RelatedStore, profiles
from kinfold.schemas import MART_TABLES
from kinfold.streaming.marts import start_mart_sync

INPUT = "dataSource string, recordId string, payload string"


def record(key, **attributes):
    return ("S", str(key), json.dumps({"DATA_SOURCE": "S", "RECORD_ID": str(key), **attributes}))


def someone(rng, key):
    """Few distinct values, so that records merge, split, and are related in many ways."""
    return record(
        key, NAME_FULL=f"name {rng.randrange(4)}", ADDR_FULL=f"road {rng.randrange(5)}", PHONE_NUMBER=str(rng.randrange(9)),
        EMAIL_ADDRESS=f"m{rng.randrange(12)}", SSN_NUMBER=str(rng.randrange(14)),
    )


@pytest.fixture()
def store(spark, folder):
    made = RelatedStore(spark, f"{folder}/store", buckets=4)
    made.create()
    made.register(spark.createDataFrame([("S",)], "data_source string"))
    return made


def rebuilt(store):
    """(resolution, relations, features) of one resolve of all stored records."""
    records = store.read("record").select("record_seq", "dataSource", "recordId", "payload")
    resolution = resolver.resolve(records)
    return resolution, resolver.entity_relations(resolver.relation_index(records, resolution.moved)), with_features(records)


def rows(frame):
    return sorted(map(str, frame.collect()))


def test_relations_and_mart_follow_the_store(spark, folder, store):
    rng = random.Random(5)
    mart = EntityMart(spark, f"{folder}/mart", buckets=4)
    mart.create()
    body = lambda some: spark.createDataFrame(some, INPUT)
    steps = [
        lambda: store.add(body([someone(rng, k) for k in range(14)]), "a"),
        lambda: store.add(body([someone(rng, k) for k in (2, 3, 14, 15, 16)]), "b"),
        lambda: store.delete(body([record(k) for k in (0, 4, 5, 16, 99)]), "c"),
    ]
    for limit, step in zip((None, 25, None), steps):
        step().write.mode("append").parquet(f"{folder}/feed")
        redone, passes = store.drain("redo", limit)
        assert passes == 1 if limit is None else passes > 1
        redone.write.mode("append").parquet(f"{folder}/feed")
        start_mart_sync(spark, f"{folder}/feed", mart, store.fetch, f"{folder}/cp", whole_relations=True).awaitTermination()
        assert store.due().isEmpty() and store.redo("none") is None
    resolution, relations, featured = rebuilt(store)
    assert rows(store.relations()) == rows(relations) and not relations.isEmpty()
    again = EntityMart(spark, f"{folder}/again", buckets=2)
    again.create()
    documents = profiles(resolution.members, resolution.links, featured, relations)
    again.sync(documents.select(
        F.col("entity_id").alias("entityId"), "page", F.lit("ENTITY").alias("kind"), "json",
        *[F.lit(None).cast("string").alias(c) for c in ("category", "errorCode", "message")],
    ))
    for table in MART_TABLES:
        assert rows(mart.read(table).drop("refresh_seq")) == rows(again.read(table).drop("refresh_seq")), table


def test_due_values_outlive_a_redo_that_breaks_off(spark, store, monkeypatch):
    store.add(spark.createDataFrame([record(1, PHONE_NUMBER="5"), record(2, PHONE_NUMBER="5"), record(3, EMAIL_ADDRESS="x")], INPUT), "a")
    due = rows(store.due())
    assert len(due) == 2 and store.relations().isEmpty()
    with monkeypatch.context() as broken:
        broken.setattr(store, "commit", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            store.redo("r")
    assert rows(store.due()) == due and store.relations().isEmpty()
    affected = store.redo("r")
    assert sorted(r.entityId for r in affected.collect()) == [0, 1] or len(affected.collect()) == 2
    assert {(r.op, r.runId) for r in affected.collect()} == {("REDO", "r")} and rows(store.redone(store.seq)) == rows(affected)
    pair = store.relations().collect()
    assert [(r.match_key, r.match_level_code) for r in pair] == [("+PHONE", "POSSIBLY_RELATED")]
    # The fetch reads the asked entities alone, with relations to others.
    ids = spark.createDataFrame([(pair[0].entity_id_hi,), (12345,)], "entityId bigint")
    kinds = {r.entityId: (r.kind, r.json) for r in store.fetch(ids).collect()}
    assert kinds[12345] == ("GONE", None) and json.loads(kinds[pair[0].entity_id_hi][1])["RELATED_ENTITIES"][0]["ENTITY_ID"] == pair[0].entity_id_lo
    assert len(kinds) == 2


def test_a_partner_is_told_when_a_pair_becomes_ambiguous(spark, store):
    """3 comes to share much with 2; 1 shares with 2 as before, but that pair is now one of several."""
    both = dict(PHONE_NUMBER="5", EMAIL_ADDRESS="x")
    more = dict(PHONE_NUMBER="6", ADDR_FULL="elm")
    body = lambda *some: spark.createDataFrame(some, INPUT)
    store.add(body(record(1, **both)), "a")
    store.add(body(record(2, ADDR_FULL="elm", **both)), "a")
    store.drain("r")
    assert [r.is_ambiguous for r in store.relations().collect()] == [False]
    at = {r.recordId: r.entity_id for r in store.read("member").collect()}
    store.add(body(record(3, ADDR_FULL="elm", PHONE_NUMBER="5")), "a")
    redone, _ = store.drain("r")
    at |= {r.recordId: r.entity_id for r in store.read("member").collect()}
    assert rows(store.relations()) == rows(rebuilt(store)[1])
    asked = store.relations(spark.createDataFrame([(at["1"],)], "entity_id bigint"))
    whole = store.relations().filter((F.col("entity_id_lo") == at["1"]) | (F.col("entity_id_hi") == at["1"]))
    assert rows(asked) == rows(whole) and any(r.is_ambiguous for r in asked.collect())
    assert set(at.values()) <= {r.entityId for r in redone.collect()}


def test_header_counts_for_all_pages(spark):
    """An entity of several pages has whole counts on page 0 and none on the others."""
    sizes = [(n, f"s{n % 3}", str(n), 0 if n < 50 else n) for n in range(55)]
    members = spark.createDataFrame(sizes, "record_seq bigint, dataSource string, recordId string, entity_id bigint")
    pairs = [(0, n, "POSSIBLY_SAME", "+A", "+A", "R", False, True) for n in range(50, 55)]
    shape = "entity_id_lo bigint, entity_id_hi bigint, match_level_code string, match_key string, rev_match_key string, errule_code string, is_disclosed boolean, is_ambiguous boolean"
    none = spark.createDataFrame([], "lo bigint, hi bigint, rule string")
    featured = with_features(spark.createDataFrame([(n, s, r, "{}") for n, s, r, _ in sizes], "record_seq bigint, dataSource string, recordId string, payload string"))
    for page_size, floor in ((1000, 100), (10, 100), (10, 5)):
        made = profiles(members, none, featured, spark.createDataFrame(pairs, shape), page_size=page_size, floor=floor)
        parsed = docs.parse_documents(made, page="page").collect()
        first = next(r for r in parsed if r.entity_id == 0 and r.page == 0)
        assert (first.record_count, first.relation_count, first.record_summary) == (50, 5, {"s0": 17, "s1": 17, "s2": 16})
        later = [r for r in parsed if r.page > 0]
        assert bool(later) == (page_size == 10) and all((r.record_count, r.relation_count, r.record_summary) == (0, 0, {}) for r in later)
        assert sum(len(r.records) for r in parsed if r.entity_id == 0) == 50 and {r.entity_name for r in later} <= {"s0:0"}
