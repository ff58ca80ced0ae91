import itertools
import json

import pytest
from pyspark.sql import functions as F

from kinfold.operators import upsert
from kinfold.plans import mart as mart_module
from kinfold.plans.keyed_table import KeyedTable
from kinfold.plans.mart import EntityMart
from kinfold.schemas import struct


def doc(entity, records=(), related=(), name="n"):
    return json.dumps({
        "RESOLVED_ENTITY": {
            "ENTITY_ID": entity, "ENTITY_NAME": name,
            "RECORDS": [{"DATA_SOURCE": "S", "RECORD_ID": r} for r in records],
        },
        "RELATED_ENTITIES": [{"ENTITY_ID": e, "MATCH_KEY": k, "MATCH_LEVEL_CODE": "POSSIBLY_SAME"} for e, k in related],
    })


def fetched(spark, *rows):
    shape = "entityId bigint, page int, kind string, json string, category string, errorCode string, message string"
    full = [(e, 0, "GONE" if j is None else "ENTITY", j, None, None, None) for e, j in rows]
    return spark.createDataFrame(full, shape)


@pytest.fixture()
def mart(spark, folder):
    made = EntityMart(spark, folder)
    made.create()
    return made


def records_of(mart):
    return {r.record_id: r.entity_id for r in mart.read("entity_record").collect()}


def pairs_of(mart):
    return {(r.entity_id_lo, r.entity_id_hi): (r.match_key, r.rev_match_key) for r in mart.read("relationship").collect()}


def test_both_directions_add_up(spark, mart):
    mart.sync(fetched(spark, (1, doc(1, ["a"], [(2, "+FORWARD")]))))
    assert pairs_of(mart) == {(1, 2): ("+FORWARD", None)}
    mart.sync(fetched(spark, (2, doc(2, ["b"], [(1, "+BACK")]))))
    assert pairs_of(mart) == {(1, 2): ("+FORWARD", "+BACK")}


def test_both_ends_in_one_pass_give_one_row(spark, mart):
    mart.sync(fetched(spark, (1, doc(1, ["a"], [(2, "+F")])), (2, doc(2, ["b"], [(1, "+B")]))))
    assert pairs_of(mart) == {(1, 2): ("+F", "+B")}


def test_gone_entity_leaves_all_tables(spark, mart):
    mart.sync(fetched(spark, (1, doc(1, ["a"], [(2, "+F")])), (2, doc(2, ["b"])), (3, doc(3, ["c"]))))
    mart.sync(fetched(spark, (2, None)))
    assert {r.entity_id for r in mart.read("entity").collect()} == {1, 3}
    assert {r.entity_id for r in mart.read("entity_doc").collect()} == {1, 3}
    assert records_of(mart) == {"a": 1, "c": 3} and pairs_of(mart) == {}
    # A pair that comes back later starts anew, without the keys from before.
    mart.sync(fetched(spark, (2, doc(2, ["b"], [(1, "+B")]))))
    assert pairs_of(mart) == {(1, 2): (None, "+B")}


def test_record_that_moved_and_record_that_is_gone(spark, mart):
    mart.sync(fetched(spark, (1, doc(1, ["moves", "leaves", "stays"])), (2, doc(2, ["b"]))))
    live = spark.createDataFrame([("S", "moves"), ("S", "stays"), ("S", "b")], "data_source string, record_id string")
    mart.sync(fetched(spark, (1, doc(1, ["stays"]))), live)
    assert records_of(mart) == {"moves": 1, "stays": 1, "b": 2}
    mart.sync(fetched(spark, (2, doc(2, ["b", "moves"]))), live)
    assert records_of(mart) == {"moves": 2, "stays": 1, "b": 2}


def test_unchanged_documents_write_nothing(spark, mart):
    body = doc(1, ["a"])
    mart.sync(fetched(spark, (1, body)))
    mart.sync(fetched(spark, (1, body), (4, doc(4))))
    assert {r.entity_id: r.refresh_seq for r in mart.read("entity").collect()} == {1: 1, 4: 2}


def test_unfinished_pass_is_invisible_and_repeatable(spark, mart, monkeypatch):
    mart.sync(fetched(spark, (1, doc(1, ["a"]))))
    monkeypatch.setattr(mart, "commit", lambda seq: (_ for _ in ()).throw(RuntimeError("stopped")), raising=False)
    second = fetched(spark, (1, doc(1, ["a", "b"])), (9, doc(9, ["z"])))
    with pytest.raises(RuntimeError):
        mart.sync(second)
    assert records_of(mart) == {"a": 1} and mart.seq == 1
    monkeypatch.undo()
    assert mart.sync(second) == 2
    assert records_of(mart) == {"a": 1, "b": 1, "z": 9}


def test_errors_go_to_quarantine(spark, mart):
    bad = spark.createDataFrame(
        [(5, 0, "ERROR", None, "BAD_INPUT", "E5", "no")],
        "entityId bigint, page int, kind string, json string, category string, errorCode string, message string",
    )
    mart.sync(bad)
    assert [tuple(r)[:4] for r in mart.read("_quarantine").select("entity_id", "category", "message", "raw").collect()] == [(5, "BAD_INPUT", "no", "E5")]


def test_any_order_of_passes_gives_the_same_table(spark, folder):
    row = struct("k bigint, v string")
    passes = {1: [(1, "a"), (2, "a")], 2: [(2, "b"), (3, "b")], 3: [(1, "c")]}
    seen = set()
    for number, order in enumerate(itertools.permutations(passes)):
        table = KeyedTable(spark, f"{folder}/t{number}", row, ("k",))
        table.create()
        for seq in order:
            removed = spark.createDataFrame([(3,)], "k bigint") if seq == 3 else None
            table.write(seq, spark.createDataFrame(passes[seq], row), removed)
        table.write(2, spark.createDataFrame(passes[2], row))  # a replay
        seen.add(tuple(sorted(map(tuple, table.read(3).collect()))))
        if number == 0:
            assert sorted(map(tuple, table.read(2).collect())) == [(1, "a", 1), (2, "b", 2), (3, "b", 2)]
            base = table.compact(3)
            assert sorted((r.k, r.v) for r in table.read(3, base=base).collect()) == [(1, "c"), (2, "b")]
    assert seen == {((1, "c", 3), (2, "b", 2))}


def test_stale_source_cannot_override(spark):
    target = spark.createDataFrame([(1, "new", 9), (2, "old", 3)], "k int, v string, refresh_seq bigint")
    source = spark.createDataFrame([(1, "late"), (2, "late"), (3, "late")], "k int, v string")
    rows = sorted(map(tuple, upsert.monotonic_upsert(target, source, ["k"], 5).collect()))
    assert rows == [(1, "new", 9), (2, "late", 5), (3, "late", 5)]
    again = upsert.monotonic_upsert(upsert.monotonic_upsert(target, source, ["k"], 5), source, ["k"], 5)
    assert sorted(map(tuple, again.collect())) == rows


def test_gate_sees_vanished_pages(spark):
    shape = "entity_id bigint, page int, entity_hash string"
    stored = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "c"), (7, 0, "x")], shape)
    fresh = spark.createDataFrame([(1, 0, "a"), (2, 0, "c"), (3, 0, "d")], shape)
    assert {r.entity_id for r in upsert.changed_entities(fresh, stored).collect()} == {1, 3}


def test_departed_records_of_a_hot_entity(spark):
    stored = spark.range(1000).selectExpr("'S' as data_source", "cast(id as string) as record_id", "case when id < 600 then 1L else id end as entity_id")
    fresh = stored.filter("entity_id = 1 and record_id % 2 = 0")
    refreshed = spark.createDataFrame([(1, 300)], "entity_id bigint, n bigint")
    gone = upsert.departed_records(stored, fresh, refreshed, floor=10)
    assert gone.count() == 300 and gone.filter(F.col("entity_id") != 1).isEmpty()


def test_a_first_pass_compares_nothing_and_stores_documents_once(spark, mart, monkeypatch):
    """Comparing all documents with tables that hold nothing, and storing them again, took a part of the time of a load."""
    labels = []

    def stored(frame, label):
        labels.append(label)
        return materialize(frame, label)

    materialize = mart_module.materialize
    monkeypatch.setattr(mart_module, "materialize", stored)
    first = fetched(spark, (1, doc(1, ["a", "b"])), (2, doc(2, ["c"])), (3, None))
    mart.sync(first)
    assert sorted(labels) == ["fetched", "gone", "parsed"]
    assert records_of(mart) == {"a": 1, "b": 1, "c": 2}
