import pytest
from hypothesis import given, settings, strategies as st

from kinfold.operators import gates
from kinfold.operators.skew import bounded_broadcast
from kinfold.sources import changefeed, inbox, log, messages, records


def write_lines(folder, *lines):
    path = f"{folder}/in.jsonl"
    with open(path, "w") as out:
        out.write("\n".join(lines) + "\n")
    return path


def test_records_tolerate_bad_lines(spark, folder):
    path = write_lines(
        folder, '{"DATA_SOURCE":"A","RECORD_ID":"1","N":1}', "", "   ", "\t", '{"DATA_SOURCE":"A","RECORD_ID":7}',
        '{"DATA_SOURCE":null,"RECORD_ID":"2"}', "{broken", '{"RECORD_ID":"3"}',
    )
    rows = {(r.dataSource, r.recordId) for r in records.read_records(spark, path).collect()}
    assert rows == {("A", "1"), ("A", "7"), ("", "2"), ("", ""), ("", "3")}
    assert records.read_records(spark, path).count() == 5
    bodies = [r.payload for r in records.read_records(spark, path).collect()]
    assert "{broken" in bodies


def test_gate_reports_source_first_and_spares_search(spark):
    rows = spark.createDataFrame(
        [("", " ", "p"), ("A", None, "p"), (None, "1", "p"), ("A", "1", "p"), ("\t", "1", "p")],
        "dataSource string, recordId string, payload string",
    )
    messages_of = {(r.dataSource, r.recordId): r.message for r in gates.gate_required_keys(rows).collect()}
    assert messages_of[("", " ")] == "record missing required DATA_SOURCE"
    assert messages_of[("A", None)] == "record missing required RECORD_ID"
    assert messages_of[("\t", "1")] == "record missing required DATA_SOURCE"
    assert messages_of[("A", "1")] is None
    assert gates.rejected(gates.gate_required_keys(rows, "SEARCH")).count() == 0
    error = gates.rejected(gates.gate_required_keys(rows)).first()
    assert (error.category, error.attempts, error.errorCode) == ("BAD_INPUT", 0, "")


def test_registry_gate_keeps_earlier_verdict_and_has_a_large_path(spark, monkeypatch):
    rows = spark.createDataFrame([("", "1", "p"), ("B", "1", "p"), ("A", "1", "p")], "dataSource string, recordId string, payload string")
    known = spark.createDataFrame([("A",)], "data_source string")
    expect = {"": "BAD_INPUT", "B": "CONFIG_RELEVANT", "A": None}
    for small in (True, False):
        if not small:
            monkeypatch.setattr(gates, "bounded_broadcast", lambda frame: None)
        checked = gates.gate_registered_source(gates.gate_required_keys(rows), known)
        assert {r.dataSource: r.category for r in checked.collect()} == expect
    assert bounded_broadcast(spark.range(5), 4) is None


def test_range_arithmetic():
    assert log.next_range(0, 0, 10) is None
    assert log.next_range(5, 8, 10) == (5, 8)
    assert log.next_range(0, 100, 10) == (0, 10)
    assert log.next_version_window(3, 2, 5) is None
    assert log.next_version_window(2, 2, 5) == (2, 3)
    assert log.next_version_window(0, 100, 5) == (0, 5)
    assert log.start_position("latest", 3, 9) == 9
    assert log.start_position("17", 3, 9) == 17
    assert inbox.files_per_trigger(100, 5000) == 1
    assert inbox.files_per_trigger(5001, 5000) == 2


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 500), st.integers(0, 500), st.integers(1, 60))
def test_ranges_tile_the_log(start, latest, size):
    at, seen = start, []
    while (chunk := log.next_range(at, latest, size)) is not None:
        seen.append(chunk)
        at = chunk[1]
    assert at == max(start, latest) if seen else start >= latest
    assert all(0 < e - s <= size for s, e in seen)


def test_message_frame_keeps_spaces_and_index_is_dense(spark, folder):
    path = write_lines(folder, "a", "", "  ", "b")
    assert sorted(r.value for r in messages.message_frame(spark, path).collect()) == ["  ", "a", "b"]
    numbered = messages.with_row_index(spark.read.text(path)).orderBy("gidx").collect()
    assert [(r.gidx, r.value) for r in numbered] == [(0, "a"), (1, ""), (2, "  "), (3, "b")]


@settings(max_examples=8, deadline=None)
@given(st.integers(0, 40), st.integers(1, 5))
def test_shards_are_disjoint_and_gapless(spark, skip, shards):
    rows = spark.range(60).withColumnRenamed("id", "gidx")
    parts = [{r.gidx for r in messages.select_shard(rows, "gidx", skip, shards, i).collect()} for i in range(shards)]
    assert sum(len(p) for p in parts) == len(set().union(*parts))
    assert set().union(*parts) == set(range(skip, 60))


def test_snapshot_diff_types(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, "c", 1)], "k int, v string, w int")
    new = spark.createDataFrame([(1, "a", None), (2, "b", None), (4, "d", 1)], "k int, v string, w int")
    rows = {(r.k, r._change_type, r.w) for r in changefeed.snapshot_diff(old, new, ["k"]).collect()}
    assert rows == {(2, "update_preimage", 1), (2, "update_postimage", None), (3, "delete", 1), (4, "insert", 1)}


def test_bad_bounds_fail(spark):
    from pyspark.sql import functions as F

    from kinfold.functions.docs import range_end, range_start

    rows = spark.createDataFrame([("-5-10",)], "b string").select(range_start(F.col("b")).alias("s"), range_end(F.col("b")).alias("e"))
    assert tuple(rows.first()) == (-5, 10)
    with pytest.raises(Exception, match="bad range"):
        spark.createDataFrame([("7",)], "b string").select(range_start(F.col("b"))).collect()
