"""An entity whose document has several pages is one row of the query over the mart."""

from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  (registers the queries)
from kinfold.operators.documents import assemble_documents, fetch_entities
from kinfold.operators.outcomes import outcome_union
from kinfold.queries import resolving
from kinfold.queries.registry import QUERIES


def test_mart_from_store_has_one_row_for_an_entity_of_several_pages(spark, monkeypatch):
    names = spark.createDataFrame([(1, "one"), (2, "two")], "entity_id bigint, entity_name string")
    shape = ("data_source string, record_id string, entity_id bigint, match_key string, match_level_code string, errule_code string, "
             "first_seen_dt timestamp, last_seen_dt timestamp")
    members = spark.createDataFrame([("s", str(i), 1 if i < 9 else 2, None, None, None, None, None) for i in range(10)], shape)
    documents = assemble_documents(names, members, page_size=3)
    assert documents.filter("entity_id = 1").count() > 1

    class Store:
        fetch = staticmethod(lambda ids: fetch_entities(ids, documents))

    affected = outcome_union(affected=names.select(
        F.lit("s").alias("dataSource"), F.lit("0").alias("recordId"), F.col("entity_id").alias("entityId"), F.lit("ADD").alias("op"), F.lit("r").alias("runId"),
    ))
    monkeypatch.setattr(resolving, "_moved_store", lambda t, on_step: on_step(Store, affected))
    rows = QUERIES["mart_from_store"](spark, "unused").collect()
    assert sorted((r["entity_id"], r["entity_name"], r["record_count"], r["records"]) for r in rows) == [(1, "one", 9, 10), (2, "two", 1, 10)]
