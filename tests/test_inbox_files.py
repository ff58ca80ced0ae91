"""The inbox of a streamed resolve has as many files as its input, so no task holds a whole batch."""

import pytest

import __spark_entry__  # noqa: F401  (registers the queries)
from kinfold.queries import resolving
from kinfold.queries.registry import QUERIES

SF = "/root/testdata/sf0.001"


class Written(Exception):
    pass


def test_the_inbox_is_not_written_by_one_task(spark, folder, monkeypatch):
    spark.read.parquet(f"{SF}/documents.parquet").repartition(4).write.parquet(f"{folder}/documents.parquet")

    def write_inbox(records, *_):
        raise Written(records.select("dataSource", "recordId", "payload").rdd.getNumPartitions())

    monkeypatch.setattr(resolving, "write_inbox", write_inbox)
    with pytest.raises(Written) as seen:
        QUERIES["stream_resolve"](spark, folder)
    assert seen.value.args[0] > 1
