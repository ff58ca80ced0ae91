"""Queries over sources, sinks and record gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kinfold.operators import gates, outcomes as out
from kinfold.queries import fixtures as fx
from kinfold.queries.registry import Tables, query
from kinfold.session import read_if_exists, scratch
from kinfold.sources import changefeed, inbox, log as logs, messages, records as rec
from kinfold.schemas import INPUT, OUTCOME, struct
from kinfold.streaming.feeder import affected_feed, drain, run_sharded, start_feeder, write_batch

_RAW_OUT = f"WITH {fx.RAW_SQL} SELECT ds AS \"dataSource\", rid AS \"recordId\", md5(text) AS text_md5 FROM raw"


def _record_lines(t: Tables) -> str:
    """The raw records as a JSON-lines folder, with a line of spaces and an empty line per label."""
    path = scratch(t.spark, "lines")
    fx.raw_records(t).select(F.col("payload").alias("value")).write.text(path)
    t.labels.select(F.explode(F.array(F.lit("   "), F.lit(""))).alias("value")).write.mode("append").text(path)
    return path


@query("src_jsonl_records", _RAW_OUT)
def src_jsonl_records(t: Tables) -> DataFrame:
    return fx.md5_of_text(rec.read_records(t.spark, _record_lines(t)))


@query("src_search_requests", "SELECT '' AS \"dataSource\", '' AS \"recordId\", md5(text) AS text_md5 FROM benchmark")
def src_search_requests(t: Tables) -> DataFrame:
    path = scratch(t.spark, "requests")
    t.benchmark.select(F.to_json(F.struct(F.col("text").alias("TEXT"))).alias("value")).write.text(path)
    return fx.md5_of_text(rec.read_search_requests(t.spark, path))


@query("sink_inbox_roundtrip", _RAW_OUT)
def sink_inbox_roundtrip(t: Tables) -> DataFrame:
    path = scratch(t.spark, "inbox")
    inbox.jsonl_to_inbox(t.spark, _record_lines(t), path)
    return fx.md5_of_text(t.spark.read.schema(INPUT).parquet(path))


def _inbox(t: Tables) -> str:
    path = scratch(t.spark, "inbox")
    inbox.write_inbox(fx.raw_records(t), path)
    return path


@query("stream_inbox_rows", _RAW_OUT)
def stream_inbox_rows(t: Tables) -> DataFrame:
    output = scratch(t.spark, "stream")
    frame = inbox.stream_inbox(t.spark, _inbox(t), inbox.files_per_trigger(5000, 1000))
    done = (
        frame.writeStream.format("parquet").option("path", output)
        .option("checkpointLocation", scratch(t.spark, "checkpoint")).trigger(availableNow=True).start()
    )
    drain([done])
    return fx.md5_of_text(t.spark.read.schema(INPUT).parquet(output))


@query("src_log_range", """
SELECT event_type AS "dataSource", CAST(user_id AS VARCHAR) AS "recordId", props FROM events
WHERE event_id >= (SELECT min(event_id) + 1 FROM events) AND event_id < (SELECT max(event_id) FROM events)""")
def src_log_range(t: Tables) -> DataFrame:
    bounds = logs.log_bounds(t.events.select(F.col("event_id").alias("offset"))).first()
    found = logs.read_range(fx.log(t), bounds["earliest"] + 1, bounds["latest"] - 1)
    return found.select("dataSource", "recordId", F.get_json_object("payload", "$.PROPS").alias("props"))


@query("log_range_plan", """
WITH b AS (SELECT min(event_id) AS s, max(event_id) + 1 AS e FROM events)
SELECT CAST(floor((event_id - s) / 1000) AS BIGINT) AS batch,
  CAST(s + floor((event_id - s) / 1000) * 1000 AS BIGINT) AS range_start,
  CAST(least(s + floor((event_id - s) / 1000) * 1000 + 1000, max(e)) AS BIGINT) AS range_end, count(*) AS rows
FROM events, b GROUP BY floor((event_id - s) / 1000), s""")
def log_range_plan(t: Tables) -> DataFrame:
    log = t.events.select(F.col("event_id").alias("offset"))
    start = logs.log_bounds(log).first()["earliest"]
    return logs.plan_ranges(log, start, 1000)


_V1, _V2 = "o_orderstatus <> 'O'", "NOT (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')"


@query("src_change_feed", f"""
SELECT o_orderpriority AS "dataSource", CAST(o_orderkey AS VARCHAR) AS "recordId",
  CASE WHEN o_orderstatus = 'P' THEN 'PAID' ELSE o_orderstatus END AS status
FROM orders WHERE {_V2} AND o_orderstatus IN ('O', 'P')""")
def src_change_feed(t: Tables) -> DataFrame:
    """Version 1 lacks the open orders; version 2 pays the pending ones and drops some finished ones."""
    def snapshot(rows: DataFrame, status) -> DataFrame:
        body = F.to_json(F.struct(
            F.col("o_orderpriority").alias("DATA_SOURCE"), F.col("o_orderkey").alias("RECORD_ID"), status.alias("STATUS")
        ))
        return rows.select("o_orderkey", body.alias("value"))

    status = F.col("o_orderstatus")
    before = snapshot(t.orders.filter(_V1), status)
    after = snapshot(t.orders.filter(_V2), F.when(status == "P", "PAID").otherwise(status))
    changed = changefeed.changed_records(changefeed.snapshot_diff(before, after, ["o_orderkey"]))
    return changed.select("dataSource", "recordId", F.get_json_object("payload", "$.STATUS").alias("status"))


@query("version_window_plan", """
WITH v AS (SELECT CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT) AS version FROM events)
SELECT CAST(floor(version / 7) AS BIGINT) AS batch, CAST(floor(version / 7) * 7 AS BIGINT) AS range_start,
  CAST(least(floor(version / 7) * 7 + 7, (SELECT max(version) + 1 FROM v)) AS BIGINT) AS range_end, count(*) AS rows
FROM v GROUP BY floor(version / 7)""")
def version_window_plan(t: Tables) -> DataFrame:
    """One version per day of events, seven versions per window."""
    day = F.date_diff(F.to_date("ts"), F.lit("2024-01-01")).cast("bigint")
    return logs.plan_ranges(t.events.select(day.alias("version")), 0, 7, position="version")


@query("log_start_position", """
WITH b AS (SELECT event_type, min(event_id) AS e, max(event_id) + 1 AS l FROM events GROUP BY event_type)
SELECT event_type, 'earliest' AS spec, e AS position FROM b
UNION ALL SELECT event_type, 'latest', l FROM b UNION ALL SELECT event_type, '500', 500 FROM b""")
def log_start_position(t: Tables) -> DataFrame:
    log = t.events.select("event_type", F.col("event_id").alias("offset"))
    return logs.start_positions(log, ["event_type"], ["earliest", "latest", "500"])


@query("log_bounds", """
SELECT min(event_id) AS earliest, max(event_id) + 1 AS latest,
  CAST(max(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE))) AS BIGINT) AS latest_version FROM events""")
def log_bounds(t: Tables) -> DataFrame:
    day = F.date_diff(F.to_date("ts"), F.lit("2024-01-01"))
    version = logs.latest_version(t.events.select(day.alias("version")))
    return logs.log_bounds(t.events.select(F.col("event_id").alias("offset"))).withColumn("latest_version", version.scalar())


@query("sink_message_frame", """
SELECT md5(props) AS value_md5, count(*) AS n FROM events GROUP BY 1
UNION ALL SELECT md5('   '), count(*) FROM labels""")
def sink_message_frame(t: Tables) -> DataFrame:
    path = scratch(t.spark, "lines")
    t.events.select(F.col("props").alias("value")).write.text(path)
    t.labels.select(F.explode(F.array(F.lit("   "), F.lit(""))).alias("value")).write.mode("append").text(path)
    return messages.message_frame(t.spark, path).groupBy(F.md5("value").alias("value_md5")).agg(F.count(F.lit(1)).alias("n"))


@query("sink_message_log", "SELECT event_id AS \"offset\", props AS value FROM events")
def sink_message_log(t: Tables) -> DataFrame:
    path = scratch(t.spark, "log")
    messages.write_message_log(t.events.select(F.col("event_id").alias("offset"), F.col("props").alias("value")), path)
    return t.spark.read.schema("offset bigint, value string").parquet(path)


@query("shard_select", """
SELECT event_id AS gidx, CAST(event_id % 3 AS INTEGER) AS shard FROM events WHERE event_id >= 250""")
def shard_select(t: Tables) -> DataFrame:
    """All three shards behind the resume point, side by side."""
    rows = t.events.select(F.col("event_id").alias("gidx"))
    shards = [messages.select_shard(rows, "gidx", 250, 3, i).withColumn("shard", F.lit(i)) for i in range(3)]
    return shards[0].unionByName(shards[1]).unionByName(shards[2])


@query("message_index", """
SELECT count(*) AS n, count(*) AS distinct_n, CAST(0 AS BIGINT) AS first_index, count(*) - 1 AS last_index FROM events""")
def message_index(t: Tables) -> DataFrame:
    """The row numbers of a message folder are dense, unique and start at 0."""
    path = scratch(t.spark, "lines")
    t.events.select(F.col("props").alias("value")).write.text(path)
    numbered = messages.with_row_index(t.spark.read.text(path))
    return numbered.agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("gidx").alias("distinct_n"), F.min("gidx").alias("first_index"),
        F.max("gidx").alias("last_index"),
    )


# --- gates and outcome rows ------------------------------------------------------------------

_GATED = f"WITH {fx.RAW_SQL}"


@query("gate_required_keys", f"""{_GATED}
SELECT ds AS "dataSource", rid AS "recordId", CASE WHEN missing IS NOT NULL THEN 'BAD_INPUT' END AS category,
  CASE WHEN missing IS NOT NULL THEN concat('record missing required ', missing) END AS message FROM gated""")
def gate_required_keys(t: Tables) -> DataFrame:
    return gates.gate_required_keys(fx.raw_records(t)).select("dataSource", "recordId", "category", "message")


@query("gate_registered_source", f"""{_GATED}
SELECT ds AS "dataSource", rid AS "recordId",
  CASE WHEN missing IS NOT NULL THEN 'BAD_INPUT' WHEN ds = '{fx.UNREGISTERED}' THEN 'CONFIG_RELEVANT' END AS category
FROM gated""")
def gate_registered_source(t: Tables) -> DataFrame:
    checked = gates.gate_registered_source(gates.gate_required_keys(fx.raw_records(t)), fx.registry(t))
    return checked.select("dataSource", "recordId", "category")


def _outcomes(t: Tables) -> DataFrame:
    """Records that pass both gates touch an entity of their own number; requests give an empty result."""
    checked = gates.gate_registered_source(gates.gate_required_keys(fx.raw_records(t)), fx.registry(t))
    good = gates.passed(checked).select(
        "dataSource", "recordId", F.col("record_seq").alias("entityId"), F.lit("ADD").alias("op"), F.lit("run").alias("runId")
    )
    search = t.benchmark.select(F.col("text").alias("requestJson"), F.lit("{}").alias("resultJson"))
    return out.outcome_union(good, search, gates.rejected(checked))


_OUTCOMES = f"""{_GATED},
errs AS (
  SELECT ds, rid, CASE WHEN missing IS NOT NULL THEN 'BAD_INPUT' ELSE 'CONFIG_RELEVANT' END AS category,
    CASE WHEN missing IS NOT NULL THEN concat('record missing required ', missing) ELSE concat('unknown data source ', ds) END AS message
  FROM gated WHERE missing IS NOT NULL OR ds = '{fx.UNREGISTERED}'),
good AS (SELECT ds, rid, doc_id FROM gated WHERE missing IS NULL AND ds <> '{fx.UNREGISTERED}')"""


@query("outcome_union", f"""{_OUTCOMES}
SELECT 'AFFECTED' AS kind, ds AS "dataSource", rid AS "recordId", doc_id AS "entityId", 'ADD' AS op, NULL AS request_md5,
  NULL AS category, NULL AS message, CAST(NULL AS INTEGER) AS attempts FROM good
UNION ALL SELECT 'SEARCH', NULL, NULL, NULL, NULL, md5(text), NULL, NULL, NULL FROM benchmark
UNION ALL SELECT 'ERROR', ds, rid, NULL, NULL, NULL, category, message, 0 FROM errs""")
def outcome_union(t: Tables) -> DataFrame:
    return _outcomes(t).select(
        "kind", "dataSource", "recordId", "entityId", "op", F.md5("requestJson").alias("request_md5"), "category", "message",
        "attempts",
    )


@query("outcome_split", f"""{_OUTCOMES}
SELECT 'good' AS sink, 'AFFECTED' AS kind, count(*) AS n FROM good
UNION ALL SELECT 'good', 'SEARCH', count(*) FROM benchmark
UNION ALL SELECT 'error', category, count(*) FROM errs GROUP BY category""")
def outcome_split(t: Tables) -> DataFrame:
    path = scratch(t.spark, "split")
    out.write_split(_outcomes(t), f"{path}/good", f"{path}/error")
    good = t.spark.read.schema(OUTCOME).parquet(f"{path}/good").select(F.lit("good").alias("sink"), "kind")
    bad = t.spark.read.parquet(f"{path}/error").select(F.lit("error").alias("sink"), F.col("category").alias("kind"))
    return good.unionByName(bad).groupBy("sink", "kind").agg(F.count(F.lit(1)).alias("n"))


@query("affected_ids", f"{_OUTCOMES} SELECT DISTINCT doc_id AS \"entityId\" FROM good")
def affected_ids(t: Tables) -> DataFrame:
    path = scratch(t.spark, "feed")
    _outcomes(t).write.parquet(path)
    return out.affected_ids(t.spark.read.schema(OUTCOME).parquet(path))


@query("affected_dedup", """
SELECT CAST(floor(event_id / 1000) AS BIGINT) AS batch, user_id AS "entityId", min(event_id) AS "recordId",
  arg_min(event_type, event_id) AS "dataSource" FROM events GROUP BY 1, 2""")
def affected_dedup(t: Tables) -> DataFrame:
    """Every event touches the entity of its user."""
    rows = t.events.select(
        F.floor(F.col("event_id") / 1000).cast("bigint").alias("batch"), F.col("user_id").alias("entityId"),
        F.col("event_id").alias("recordId"), F.col("event_type").alias("dataSource"),
    )
    return out.affected_dedup(rows)


@query("affected_feed_dedup", """
SELECT DISTINCT event_type AS "dataSource", props AS "recordId", user_id AS "entityId" FROM events""")
def affected_feed_dedup(t: Tables) -> DataFrame:
    rows = t.events.select(
        F.col("event_type").alias("dataSource"), F.col("props").alias("recordId"), F.col("user_id").alias("entityId")
    )
    return out.affected_feed_dedup(rows)


@query("output_stats", f"""{_OUTCOMES}
SELECT (SELECT count(*) FROM good) + (SELECT count(*) FROM benchmark) + (SELECT count(*) FROM errs) AS rows,
  (SELECT count(DISTINCT doc_id) FROM good) AS entities""")
def output_stats(t: Tables) -> DataFrame:
    return out.output_stats(_outcomes(t))


@query("slow_records", """
SELECT event_id, CAST(value * 10000 AS BIGINT) AS elapsed FROM events
WHERE event_type <> 'error' AND CAST(value * 10000 AS BIGINT) > 300000""")
def slow_records(t: Tables) -> DataFrame:
    calls = t.events.select(
        "event_id", F.when(F.col("event_type") == "error", "BAD_INPUT").alias("category"),
        F.round(F.col("value") * 10000).cast("bigint").alias("elapsedMs"),
    )
    return out.slow_records(calls).select("event_id", F.col("elapsedMs").alias("elapsed"))


@query("affected_feed_stream", """
SELECT DISTINCT event_type AS "dataSource", CAST(event_id // 2 AS VARCHAR) AS "recordId", user_id AS "entityId" FROM events""")
def affected_feed_stream(t: Tables) -> DataFrame:
    """A feeder's output in two batches, the second of which is repeated after the stream ended; the stream goes on from its checkpoint."""
    path = scratch(t.spark, "affected")
    rows = t.events.select(
        F.lit("AFFECTED").alias("kind"), F.col("event_type").alias("dataSource"), F.floor(F.col("event_id") / 2).cast("string").alias("recordId"),
        F.col("user_id").alias("entityId"), (F.col("event_id") % 2).alias("batch"),
    )
    for batch in (0, 1, 1):
        write_batch(rows.filter(F.col("batch") == batch).drop("batch"), f"{path}/output", batch)
        feed = affected_feed(t.spark, f"{path}/output").select("dataSource", "recordId", "entityId")
        writer = feed.writeStream.format("parquet").option("path", f"{path}/once").option("checkpointLocation", f"{path}/checkpoint")
        drain([writer.trigger(availableNow=True).start()])
    return t.spark.read.parquet(f"{path}/once")


# --- streams ---------------------------------------------------------------------------------


def _process(t: Tables):
    known = fx.registry(t)

    def run(batch: DataFrame, _: int) -> DataFrame:
        checked = gates.gate_registered_source(gates.gate_required_keys(batch), known)
        good = gates.passed(checked).select(
            "dataSource", "recordId", F.lit(None).cast("bigint").alias("entityId"), F.lit("ADD").alias("op"),
            F.lit("stream").alias("runId"),
        )
        return out.outcome_union(affected=good, errors=gates.rejected(checked))

    return run


_STREAM_OUT = f"""{_OUTCOMES}
SELECT 'AFFECTED' AS kind, ds AS "dataSource", rid AS "recordId", NULL AS category FROM good
UNION ALL SELECT 'ERROR', ds, rid, category FROM errs"""
_GOOD = struct("kind string, dataSource string, recordId string, category string")
_BAD = struct("dataSource string, recordId string, category string")


def _sinks(t: Tables, output: str, dead: str) -> DataFrame:
    good = read_if_exists(t.spark, output, _GOOD).select("kind", "dataSource", "recordId", "category")
    bad = read_if_exists(t.spark, dead, _BAD).select(F.lit("ERROR").alias("kind"), "dataSource", "recordId", "category")
    return good.unionByName(bad)


@query("stream_feeder_outcomes", _STREAM_OUT)
def stream_feeder_outcomes(t: Tables) -> DataFrame:
    path = scratch(t.spark, "feeder")
    drain([start_feeder(t.spark, _inbox(t), _process(t), f"{path}/cp", f"{path}/out", f"{path}/dead", max_files=4)])
    return _sinks(t, f"{path}/out", f"{path}/dead")


@query("stream_dead_letter", f"""{_OUTCOMES}
SELECT ds AS "dataSource", rid AS "recordId", category, message, 'stream' AS source, true AS stamped FROM errs""")
def stream_dead_letter(t: Tables) -> DataFrame:
    """Only the dead letter is wired; the unset good sink writes nothing."""
    path = scratch(t.spark, "dead")
    drain([start_feeder(t.spark, _inbox(t), _process(t), f"{path}/cp", dead_letter=f"{path}/dead")])
    shape = "dataSource string, recordId string, category string, message string, source string, failedAt timestamp"
    rows = t.spark.read.schema(shape).parquet(f"{path}/dead")
    return rows.select("dataSource", "recordId", "category", "message", "source", F.col("failedAt").isNotNull().alias("stamped"))


@query("stream_sharded_outcomes", _STREAM_OUT)
def stream_sharded_outcomes(t: Tables) -> DataFrame:
    path = scratch(t.spark, "shards")
    inbox.write_sharded_inbox(fx.raw_records(t), f"{path}/inbox", 3)
    drain(run_sharded(t.spark, f"{path}/inbox", 3, _process(t), f"{path}/cp", f"{path}/out", f"{path}/dead", path[-8:]))
    return _sinks(t, f"{path}/out", f"{path}/dead")


@query("stream_restart", _STREAM_OUT)
def stream_restart(t: Tables) -> DataFrame:
    """The English records first; the others arrive after the query ended. The restart reads only those."""
    path = scratch(t.spark, "restart")
    rows = fx.raw_records(t).withColumn("lang", F.get_json_object("payload", "$.LANG"))
    for part in (rows.filter("lang = 'en'"), rows.filter("lang <> 'en'")):
        inbox.write_inbox(part, f"{path}/inbox", "append")
        drain([start_feeder(t.spark, f"{path}/inbox", _process(t), f"{path}/cp", f"{path}/out", f"{path}/dead")])
    return _sinks(t, f"{path}/out", f"{path}/dead")


@query("stream_replay_dedup", _STREAM_OUT)
def stream_replay_dedup(t: Tables) -> DataFrame:
    """A batch fails after its good sink was written; the restart repeats it and each row shows once."""
    path = scratch(t.spark, "replay")
    source, process, broken = _inbox(t), _process(t), []

    def first_try_fails(batch: DataFrame, batch_id: int) -> DataFrame:
        outcomes = process(batch, batch_id)
        if not broken:
            broken.append(batch_id)
            outcomes.filter(F.col("kind") != "ERROR").write.mode("overwrite").parquet(f"{path}/out/batch_id={batch_id}")
            raise RuntimeError("injected failure")
        return outcomes

    for _ in range(2):
        feeder = start_feeder(t.spark, source, first_try_fails, f"{path}/cp", f"{path}/out", f"{path}/dead", max_files=4)
        try:
            drain([feeder])
        except Exception as failure:  # the first run is meant to stop here
            if "injected failure" not in str(failure):
                raise
    return _sinks(t, f"{path}/out", f"{path}/dead")
