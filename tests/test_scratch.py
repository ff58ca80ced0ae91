"""Scratch data of the jobs on the store and the mart goes when the job is done, and the mart takes a large batch in parts."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from kinfold.operators.outcomes import outcome_union
from kinfold.plans.mart import EntityMart
from kinfold.plans.related import RelatedStore
from kinfold.schemas import MART_TABLES
from kinfold.session import materialize, temporary
from kinfold.streaming.marts import start_mart_sync
from test_mart import doc, fetched


def record(key, **attributes):
    return ("S", str(key), json.dumps({"DATA_SOURCE": "S", "RECORD_ID": str(key), **attributes}))


def someone(rng, key):
    return record(key, NAME_FULL=f"name {rng.randrange(4)}", PHONE_NUMBER=str(rng.randrange(9)), SSN_NUMBER=str(rng.randrange(14)))


@pytest.fixture()
def scratch_left(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(base))
    return lambda: sorted(name.rsplit("-", 1)[0] for name in set(os.listdir(base)) - before)


@pytest.fixture()
def store(spark, folder):
    made = RelatedStore(spark, f"{folder}/store", buckets=2)
    made.create()
    made.register(spark.createDataFrame([("S",)], "data_source string"))
    return made


def body(spark, rows):
    return spark.createDataFrame(rows, "dataSource string, recordId string, payload string")


def test_a_block_removes_what_it_stored_and_hands_on_what_is_kept(spark, scratch_left):
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup)
    with temporary(spark):
        with temporary(spark) as keep:
            rows = materialize(spark.range(5), "source")
            doubled = keep(materialize(rows.select(F.col("id") * 2), "doubled"))
            assert scratch_left() == ["doubled", "source"] and spark.conf.get(cleanup) == "true"
        assert scratch_left() == ["doubled"] and doubled.count() == 5
    assert scratch_left() == [] and spark.conf.get(cleanup) == before
    with pytest.raises(Exception, match="broken"), temporary(spark):
        materialize(spark.range(5), "source")
        materialize(spark.range(5).select(F.raise_error(F.lit("broken")).cast("string").alias("x")), "failed")
    assert scratch_left() == []
    with temporary(spark) as keep:
        rows = keep(materialize(spark.range(5), "rows"))
    assert scratch_left() == ["rows"] and rows.count() == 5


def test_jobs_on_store_and_mart_leave_no_scratch_data(spark, folder, store, scratch_left):
    rng = random.Random(3)
    mart = EntityMart(spark, f"{folder}/mart", buckets=2)
    mart.create()
    steps = [
        lambda: store.add(body(spark, [someone(rng, k) for k in range(8)] + [("S", "", "{}")]), "a"),
        lambda: store.delete(body(spark, [record(k) for k in (0, 4, 99)]), "b"),
    ]
    for step in steps:
        affected, (redone, _) = step(), store.drain("redo")
        affected.write.mode("append").parquet(f"{folder}/feed")
        redone.write.mode("append").parquet(f"{folder}/feed")
        start_mart_sync(spark, f"{folder}/feed", mart, store.fetch, f"{folder}/cp", whole_relations=True).awaitTermination()
    # What add and delete return may be read at any time.
    assert scratch_left() == ["outcomes"] * 2
    assert spark.read.parquet(f"{folder}/feed").filter("kind = 'ERROR'").count() == 1
    assert mart.read("entity_record").count() == store.read("member").count() == 6


def test_texts_of_a_batch_are_stored_once_beside_the_input(spark, store, monkeypatch):
    """A load stored the texts in the checked input, the batch without and with numbers, and its features, until after the job."""
    from kinfold.plans import resolver, store as stores

    word, held = "quite unlike any other line", {}

    def stored(frame, label):
        kept = materialize(frame, label)
        held[label] = any(word in str(row) for row in kept.collect())
        return kept

    monkeypatch.setattr(resolver, "materialize", stored)
    monkeypatch.setattr(stores, "materialize", stored)
    store.add(body(spark, [record(k, TEXT=f"{word} {k}\nand a second one of some length") for k in range(3)]), "a")
    assert sorted(label for label, whole in held.items() if whole) == ["batch", "checked"]


def test_a_due_value_settled_with_all_others_is_not_stored_again(spark, store):
    store.add(body(spark, [record(k, PHONE_NUMBER="5") for k in range(3)]), "a")
    store.drain("redo")
    now = store.seq
    assert store.due().isEmpty() and store.tables["due"].versions(now, since=now).isEmpty()
    store.add(body(spark, [record(9, PHONE_NUMBER="5")]), "b")
    assert store.due().count() == 1


def test_a_large_batch_enters_the_mart_in_parts(spark, folder):
    """The parts of a batch add up to one pass over all of it, also where a record or the end of a relation is in another part."""
    batches = [
        {1: doc(1, ["a", "b"], [(2, "+F"), (4, "+F")]), 2: doc(2, ["c"], [(1, "+B")]), 3: doc(3, ["d"]), 4: doc(4, ["e"], [(1, "+B")])},
        {1: doc(1, ["a"], [(3, "+G")]), 2: None, 3: doc(3, ["d", "b", "c"], [(1, "+H")]), 4: doc(4, ["e"])},
    ]
    asked, tables = [], {}
    for name, size in (("whole", 250_000), ("parts", 2)):
        mart = EntityMart(spark, f"{folder}/{name}", buckets=1)
        mart.create()
        for batch in batches:
            documents = fetched(spark, *batch.items())

            def fetch(ids):
                asked.append((name, sorted(r.entityId for r in ids.collect())))
                return documents.join(ids, "entityId", "left_semi")

            ids = documents.select("entityId", F.lit("ADD").alias("op"), F.lit("r").alias("runId"), *[F.lit("x").alias(c) for c in ("dataSource", "recordId")])
            outcome_union(affected=ids).write.mode("append").parquet(f"{folder}/feed-{name}")
            start_mart_sync(
                spark, f"{folder}/feed-{name}", mart, fetch, f"{folder}/cp-{name}", whole_relations=True, pass_entities=size
            ).awaitTermination()
        tables[name] = {t: sorted(map(str, mart.read(t).drop("refresh_seq").collect())) for t in MART_TABLES}
    assert [ids for name, ids in asked if name == "whole"] == [[1, 2, 3, 4]] * 2
    parts = [ids for name, ids in asked if name == "parts"]
    assert len(parts) > 2 and sorted(sum(parts, [])) == sorted([1, 2, 3, 4] * 2)
    assert tables["parts"] == tables["whole"] and len(tables["whole"]["entity_record"]) == 5 and len(tables["whole"]["relationship"]) == 1
