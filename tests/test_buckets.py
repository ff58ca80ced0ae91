import json
import re

import pytest
from pyspark.sql import functions as F

from kinfold.plans.keyed_table import KeyedTable
from kinfold.plans.store import ResolverStore
from kinfold.schemas import struct

ROW = struct("k bigint, owner bigint, v string")


@pytest.fixture()
def table(spark, folder):
    made = KeyedTable(spark, f"{folder}/t", ROW, ("k",), lookups=(("owner",),), buckets=64)
    made.create()
    made.write(1, spark.range(4000).select(F.col("id").alias("k"), (F.col("id") % 500).alias("owner"), F.lit("a").alias("v")))
    return made


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_a_read_of_some_keys_opens_their_buckets_only(spark, table):
    only = spark.createDataFrame([(7,), (8,), (-1,)], "k int")
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)  # else the printed plan is cut
    found = table.read(1, only=only)
    assert sorted((r.k, r.owner) for r in found.collect()) == [(7, 7), (8, 8)]
    filters = re.search(r"PartitionFilters: (.*?), PushedFilters", plan_of(found)).group(1)
    assert re.search(r"bucket#\d+ (IN|INSET|=)", filters), filters
    files = lambda rows: rows.select(F.input_file_name()).distinct().count()
    assert files(table.versions(1, buckets=table.touched(only, ("k",)))) <= 3
    assert files(table.versions(1)) >= 60


def test_a_lookup_finds_rows_where_they_are_now(spark, table):
    table.write(2, spark.createDataFrame([(7, 9999, "b"), (508, 8, "b")], ROW), spark.createDataFrame([(1007,)], "k bigint"))
    owned = lambda seq, *owners: sorted((r.k, r.v) for r in table.read(seq, ["v"], only=spark.createDataFrame([(o,) for o in owners], "owner bigint")).collect())
    assert owned(1, 7) == [(k, "a") for k in range(7, 4000, 500)]
    assert owned(2, 7) == [(k, "a") for k in range(7, 4000, 500) if k not in (7, 1007)]
    assert owned(2, 9999) == [(7, "b")] and (508, "b") in owned(2, 8) and owned(2, 12345) == []
    plan = plan_of(table.read(2, ["v"], only=spark.createDataFrame([(9999,)], "owner bigint")))
    assert "bucket" in plan and plan.count("left_semi") + plan.count("LeftSemi") >= 2


def test_compaction_keeps_the_rows_and_their_lookups(spark, table):
    table.write(2, spark.createDataFrame([(7, 9999, "b")], ROW))
    before = sorted(map(tuple, table.read(2).drop("refresh_seq").collect()))
    base = table.compact(2, buckets=5)
    new = KeyedTable(spark, table.path, ROW, ("k",), lookups=(("owner",),), buckets=5, base=base)
    assert sorted(map(tuple, new.read(2).drop("refresh_seq").collect())) == before
    new.write(3, spark.createDataFrame([(8, 9999, "c")], ROW))
    assert sorted(r.k for r in new.read(3, only=spark.createDataFrame([(9999,)], "owner bigint")).collect()) == [7, 8]


def records(spark, *rows):
    body = [("S", key, json.dumps({"DATA_SOURCE": "S", "RECORD_ID": key, **values})) for key, values in rows]
    return spark.createDataFrame(body, "dataSource string, recordId string, payload string")


def test_store_after_compaction(spark, folder):
    """The standing holder of a key leaves, an entity splits and merges again, and search follows; all after a change of the number of buckets."""
    store = ResolverStore(spark, folder, buckets=4)
    store.create()
    store.register(spark.createDataFrame([("S",)], "data_source string"))
    store.add(records(spark, *[(str(n), {"NAME_FULL": f"n{n // 2}", "SSN_NUMBER": str(n // 2), "PHONE_NUMBER": "5"}) for n in range(8)]), "a")
    groups = lambda: sorted(sorted(r.ids) for r in store.read("member").groupBy("entity_id").agg(F.collect_list("recordId").alias("ids")).collect())
    assert groups() == [["0", "1"], ["2", "3"], ["4", "5"], ["6", "7"]]
    store.compact(bucket_rows=2)
    assert groups() == [["0", "1"], ["2", "3"], ["4", "5"], ["6", "7"]]
    holder = store.read("holder").filter("rule = 'SSN'").orderBy("record_seq").first().record_seq
    key = store.read("member").filter(F.col("record_seq") == holder).first().recordId
    store.delete(records(spark, (key, {})), "b")
    mate = next(r for g in [["0", "1"], ["2", "3"], ["4", "5"], ["6", "7"]] if key in g for r in g if r != key)
    assert [mate] in groups()
    store.add(records(spark, ("x", {"SSN_NUMBER": str(int(mate) // 2)})), "c")
    assert sorted([mate, "x"]) in groups()
    # The record that held two entities together is replaced, and they part.
    store.add(records(spark, ("x", {"NAME_FULL": "n9", "SSN_NUMBER": "99"})), "d")
    assert [mate] in groups() and ["x"] in groups()
    hits = store.find(spark.createDataFrame([(1, '{"SSN_NUMBER":"99"}'), (2, '{"PHONE_NUMBER":"5"}'), (3, f'{{"SSN_NUMBER":"{int(mate) // 2}"}}')], "request_id int, payload string"))
    found = {r: [h.match_level_code for h in hits.collect() if h.request_id == r] for r in (1, 2, 3)}
    assert found == {1: ["RESOLVED"], 2: ["POSSIBLY_RELATED"] * 4, 3: ["RESOLVED"]}
    ranks = [h.rank for h in hits.collect() if h.request_id == 2]
    assert sorted(ranks) == [1, 2, 3, 4]


def test_a_batch_reads_the_same_however_much_is_stored(spark, folder):
    """Rows of the link-key holders that a batch of one record opens, with ten times the state and buckets to match."""
    opened = []
    for n in (300, 3000):
        table = KeyedTable(spark, f"{folder}/holder{n}", struct("k bigint, owner bigint, v string"), ("k",), buckets=4)
        table.create()
        table.write(1, spark.range(n).select(F.col("id").alias("k"), F.col("id").alias("owner"), F.lit("a").alias("v")))
        buckets = n // 25
        base = table.compact(1, buckets=buckets)
        now = KeyedTable(spark, table.path, table.row, ("k",), buckets=buckets, base=base)
        only = spark.createDataFrame([(5,)], "k bigint")
        opened.append(now.versions(1, buckets=now.touched(only, ("k",))).count())
        assert now.read(1, only=only).count() == 1
    assert max(opened) <= 60
