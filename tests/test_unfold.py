"""Arrays made from parsed JSON become rows without a second parse."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  (registers the queries)
from kinfold.functions import docs
from kinfold.queries.registry import QUERIES
from kinfold.session import unfold

FULL = """{"RESOLVED_ENTITY":{"ENTITY_ID":1,"FEATURES":{"NAME":[{"FEAT_DESC":"a","LIB_FEAT_ID":7}]},"RECORDS":[{"DATA_SOURCE":"s","RECORD_ID":"r"}]},
"RELATED_ENTITIES":[{"ENTITY_ID":2,"MATCH_KEY":"+X"}]}"""
BARE = '{"RESOLVED_ENTITY":{"ENTITY_ID":3}}'


def _optimized(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("rows", [docs.record_frame, docs.relation_frame, docs.feature_frame])
def test_a_document_is_parsed_once(spark, rows):
    frame = rows(docs.parse_documents(spark.createDataFrame([(FULL,), (BARE,)], "json string")))
    assert _optimized(frame).count("from_json(") == 1
    assert frame.count() == 1


def test_unfold_has_no_row_for_empty_and_null_arrays(spark):
    frame = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "id bigint, xs array<string>")
    rows = unfold(frame, F.transform("xs", lambda x: F.struct(x.alias("x"), F.lit(None).cast("string").alias("y"))), "x", "id")
    assert sorted(map(tuple, rows.collect())) == [(1, "a", None), (1, "b", None)]


def test_documents_of_one_file_are_parsed_by_all_cores(spark):
    frame = QUERIES["doc_features"](spark, "/root/testdata/sf0.001")
    assert frame.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
