"""Work per record is done once, and on all cores."""

import re

from kinfold.operators import features as ft
from kinfold.queries import routing
from kinfold.queries.registry import Tables


def test_values_of_a_record_come_from_one_parse(spark):
    records = spark.createDataFrame([(1, "A", "1", '{"TEXT": "a line of more than twenty characters"}')], "record_seq bigint, dataSource string, recordId string, payload string")
    for rows in (ft.relating_values, ft.search_values):
        plan = rows(ft.with_features(records))._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall("from_json", plan)) == 1


def test_search_values_are_relating_values_and_link_keys(spark):
    text = "\\n".join(f"line {i} of more than twenty characters" for i in range(4))
    body = '{"TEXT": "%s", "NAME_FULL": "Ann B", "DATE_OF_BIRTH": "2000", "PHONE_NUMBER": "1", "ADDR_FULL": "x 1"}' % text
    featured = ft.with_features(spark.createDataFrame([(1, "A", "1", body), (2, "A", "2", "{}")], "record_seq bigint, dataSource string, recordId string, payload string"))
    both = ft.relating_values(featured).union(ft.link_keys(featured))
    assert sorted(map(tuple, ft.search_values(featured).collect())) == sorted(map(tuple, both.collect()))


def test_calls_for_one_file_run_on_all_cores(spark):
    called = routing._called(Tables(spark, "/root/testdata/sf0.001"))
    assert called.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
