"""Queries over error routing, the dead letter and monitoring."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, functions as F

from kinfold.operators import deadletter as dl, errors as er, gates, monitor, outcomes as out
from kinfold.operators.ordered import running, with_range
from kinfold.queries import fixtures as fx
from kinfold.queries.registry import Tables, query
from kinfold.session import scratch, spread

# --- classes and dispositions ----------------------------------------------------------------

_CLASSES = {
    "click": "UNKNOWN_DATA_SOURCE", "view": "NOT_FOUND", "purchase": "RETRY_TIMEOUT", "signup": "REPLACE_CONFLICT",
    "error": "OUT_OF_MEMORY",
}
_CATEGORIES = {
    "click": "CONFIG_RELEVANT", "view": "NOT_FOUND", "purchase": "RETRY_EXHAUSTED", "signup": "REPLACE_CONFLICT",
    "error": "SYSTEMIC",
}
_WRITTEN = {**_CATEGORIES, "view": "BAD_INPUT", "error": "RETRY_EXHAUSTED"}


@query("error_classify", f"SELECT event_id, {fx.cases('event_type', _CATEGORIES)} AS category FROM events")
def error_classify(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", F.expr(fx.cases("event_type", _CLASSES)).alias("error_class"))
    return rows.select("event_id", er.classify(F.col("error_class")).alias("category"))


@query("error_disposition", f"SELECT event_id, {fx.cases('event_type', _WRITTEN)} AS written FROM events")
def error_disposition(t: Tables) -> DataFrame:
    """Here the last event type is a retryable failure whose budget ran out."""
    classes = {**_CLASSES, "error": "RETRYABLE"}
    rows = t.events.select("event_id", F.expr(fx.cases("event_type", classes)).alias("error_class"))
    category = er.fail_on_systemic(er.classify(F.col("error_class")))
    return rows.select("event_id", er.disposition(category).alias("written"))


def _verb(source: str, record: str, payload: str, attempt: int) -> str:
    """A stand-in verb: views and clicks fail for good, signups at the first attempt only."""
    if source == "view":
        raise er.VerbError("NOT_FOUND", "no such record", "33")
    if source == "click":
        raise er.VerbError("UNKNOWN_DATA_SOURCE", "unknown source", "27")
    if source == "signup" and attempt == 0:
        raise er.VerbError("RETRYABLE", "lock")
    number = json.loads(payload)["RECORD_ID"]
    return json.dumps({"AFFECTED_ENTITIES": [{"ENTITY_ID": int(number)}, {"ENTITY_ID": "no"}]})


def _called(t: Tables) -> DataFrame:
    """Events as records, over all cores: one file may be one task, and calls are work per row."""
    from kinfold.sources.records import as_records

    return as_records(spread(fx.log(t), "offset"))


@query("route_errors", """
SELECT CASE WHEN event_type IN ('view', 'click') THEN 'ERROR' ELSE 'AFFECTED' END AS kind, event_type AS "dataSource",
  CAST(user_id AS VARCHAR) AS "recordId", CASE WHEN event_type NOT IN ('view', 'click') THEN user_id END AS "entityId",
  CASE event_type WHEN 'view' THEN 'BAD_INPUT' WHEN 'click' THEN 'CONFIG_RELEVANT' END AS category,
  CASE event_type WHEN 'view' THEN '33' WHEN 'click' THEN '27' END AS "errorCode", count(*) AS n
FROM events GROUP BY 1, 2, 3, 4, 5, 6""")
def route_errors(t: Tables) -> DataFrame:
    policy = er.RetryPolicy(budget_ms=5_000, base_ms=0, cap_ms=0)
    routed = er.route_errors(_called(t), _verb, "ADD", "run", policy)
    return routed.groupBy("kind", "dataSource", "recordId", "entityId", "category", "errorCode").agg(F.count(F.lit(1)).alias("n"))


def _uneven_verb(source: str, record: str, payload: str, attempt: int) -> str:
    """As above, but views are absent, errors conflict, and a purchase affects as many entities as the record's number leaves by 4."""
    if source == "error":
        raise er.VerbError("REPLACE_CONFLICT", "changed meanwhile")
    if source == "purchase":
        return json.dumps({"AFFECTED_ENTITIES": [{"ENTITY_ID": i} for i in range(int(record) % 4)]})
    return _verb(source, record, payload, attempt)


@query("outcome_counters", """
SELECT event_type AS "dataSource", count(*) FILTER (event_type IN ('purchase', 'signup')) AS succeeded, count(*) FILTER (event_type IN ('click', 'error')) AS errored,
  count(*) FILTER (event_type = 'view') AS "notFound", count(*) FILTER (event_type = 'error') AS "replaceConflict",
  count(*) FILTER (event_type = 'signup') AS retried, CAST(0 AS BIGINT) AS long FROM events GROUP BY 1""")
def outcome_counters(t: Tables) -> DataFrame:
    """Records, not rows: calls that affect no entity, one or several, that pass at the second attempt, and absences that are benign."""
    policy = er.RetryPolicy(budget_ms=60_000, base_ms=0, cap_ms=0)
    routed = er.route_errors(_called(t), _uneven_verb, "ADD", "run", policy, not_found_is_benign=True, ledger=True)
    return out.outcome_counters(routed, ["dataSource"])


# --- dead letter -----------------------------------------------------------------------------


@query("dead_letter_dedup", f"""WITH {fx.ERRORS_SQL}
SELECT ds AS "dataSource", rid AS "recordId", category, epoch_us(max(ts)) AS failed_at, arg_max(payload, ts) AS payload FROM errors GROUP BY ds, rid, category""")
def dead_letter_dedup(t: Tables) -> DataFrame:
    return out.dead_letter_dedup(fx.errors(t)).select(
        "dataSource", "recordId", "category", F.unix_micros("failedAt").alias("failed_at"), "payload"
    )


@query("dead_letter_reprocessable", f"""WITH {fx.ERRORS_SQL}
SELECT ds AS "dataSource", rid AS "recordId", payload FROM errors WHERE category IN ('RETRY_EXHAUSTED', 'CONFIG_RELEVANT', 'REPLACE_CONFLICT')""")
def dead_letter_reprocessable(t: Tables) -> DataFrame:
    return dl.reprocessable(fx.errors(t))


@query("dead_letter_sweep", f"""WITH {fx.ERRORS_SQL}
SELECT 1 AS pass, count(*) AS emitted FROM errors WHERE category = 'CONFIG_RELEVANT'
UNION ALL SELECT 2, 0
UNION ALL SELECT 3, count(*) FROM errors WHERE category IN ('RETRY_EXHAUSTED', 'REPLACE_CONFLICT')""")
def dead_letter_sweep(t: Tables) -> DataFrame:
    """The configuration errors first; nothing new for the second pass; then all others."""
    path = scratch(t.spark, "sweep")
    rows, emitted = fx.errors(t), []
    run = lambda: emitted.append(dl.sweep(t.spark, f"{path}/dead", f"{path}/feed", f"{path}/ledger"))
    dl.write_dead_letter(rows.filter("category = 'CONFIG_RELEVANT'"), f"{path}/dead")
    run()
    run()
    dl.write_dead_letter(rows.filter("category <> 'CONFIG_RELEVANT'"), f"{path}/dead")
    run()
    again = t.spark.createDataFrame([(2, emitted[1])], "pass int, emitted bigint")
    passes = t.spark.read.parquet(f"{path}/feed").groupBy("sweep").agg(F.count(F.lit(1)).alias("emitted"))
    # The empty second pass used no sweep number of its own.
    return passes.select((2 * F.col("sweep") + 1).cast("int").alias("pass"), "emitted").unionByName(again)


def _fail_again(rows: DataFrame) -> DataFrame:
    """Records whose payload number is below 40 fail again, below 10 with a terminal category."""
    number = F.get_json_object("payload", "$.k").cast("int")
    good = rows.filter(number >= 40).select(
        "dataSource", "recordId", F.lit(1).alias("entityId"), F.lit("ADD").alias("op"), F.lit("redrive").alias("runId")
    )
    bad = rows.filter(number < 40).select(
        "dataSource", "recordId", "payload", F.when(number < 10, "BAD_INPUT").otherwise("CONFIG_RELEVANT").alias("category"),
        F.lit("").alias("errorCode"), F.lit("again").alias("message"), F.lit(0).alias("attempts"),
    )
    return out.outcome_union(affected=good, errors=bad)


_CONVERGE = f"""WITH {fx.ERRORS_SQL},
swept AS (SELECT * FROM errors WHERE category IN ('RETRY_EXHAUSTED', 'CONFIG_RELEVANT', 'REPLACE_CONFLICT')),
stuck AS (SELECT * FROM swept WHERE attempts >= 10 AND attempts < 40)"""


def _converged(t: Tables) -> tuple[dl.Redrive, str]:
    path = scratch(t.spark, "converge")
    dl.write_dead_letter(fx.errors(t), f"{path}/dead")
    return dl.converge(t.spark, f"{path}/dead", f"{path}/work", f"{path}/quarantine", _fail_again), f"{path}/quarantine"


@query("dead_letter_converge", f"""{_CONVERGE}
SELECT 2 AS rounds, (SELECT count(*) FROM swept) + (SELECT count(*) FROM stuck) AS re_fed, (SELECT count(*) FROM stuck) AS quarantined, false AS drained""")
def dead_letter_converge(t: Tables) -> DataFrame:
    """Round 2 frees nothing: the loop stops there and quarantines what is left."""
    done, _ = _converged(t)
    # The counts are read back from the written generations; the driver holds only the four results.
    return t.spark.createDataFrame(
        [(done.rounds, done.re_fed, done.quarantined, done.drained)], "rounds int, re_fed bigint, quarantined bigint, drained boolean"
    )


@query("dead_letter_quarantine", f"""{_CONVERGE}
SELECT ds AS "dataSource", rid AS "recordId", payload, 'CONFIG_RELEVANT' AS category, 'redrive-1' AS source FROM stuck""")
def dead_letter_quarantine(t: Tables) -> DataFrame:
    _, path = _converged(t)
    return t.spark.read.schema(dl.DEAD_LETTER).parquet(path).select("dataSource", "recordId", "payload", "category", "source")


@query("registry_retry", f"""WITH {fx.RAW_SQL}
SELECT ds AS "dataSource", rid AS "recordId" FROM gated WHERE missing IS NULL AND ds = '{fx.UNREGISTERED}'""")
def registry_retry(t: Tables) -> DataFrame:
    """Records of an unknown source fail, the source is registered, and a re-drive passes them."""
    path = scratch(t.spark, "registry")
    known = fx.registry(t)
    checked = gates.gate_registered_source(gates.gate_required_keys(fx.raw_records(t)), known)
    failed = gates.rejected(checked).withColumns({"failedAt": F.current_timestamp(), "source": F.lit("load")})
    dl.write_dead_letter(failed, f"{path}/dead")
    wider = t.documents.select(F.col("source").alias("data_source")).distinct()

    def redrive(rows: DataFrame) -> DataFrame:
        again = gates.gate_registered_source(gates.gate_required_keys(rows), wider)
        good = gates.passed(again).select(
            "dataSource", "recordId", F.lit(None).cast("bigint").alias("entityId"), F.lit("ADD").alias("op"), F.lit("retry").alias("runId")
        )
        return out.outcome_union(affected=good, errors=gates.rejected(again))

    dl.converge(
        t.spark, f"{path}/dead", f"{path}/work", f"{path}/quarantine", redrive,
        on_success=lambda rows: rows.write.mode("append").parquet(f"{path}/good"),
    )
    return t.spark.read.parquet(f"{path}/good").select("dataSource", "recordId")


# --- monitoring ------------------------------------------------------------------------------


def _progress(t: Tables) -> DataFrame:
    """One sample per hour and event type: events so far, and when the last one came."""
    hourly = t.events.groupBy("event_type", F.date_trunc("hour", "ts").alias("h")).agg(
        F.count(F.lit(1)).alias("n"), F.unix_millis(F.max("ts")).alias("at_ms")
    )
    counted = running(with_range(hourly, "at_ms"), ["event_type"], ["at_ms"], F.col("n"), "sum", "total")
    return counted.select("event_type", "total", "at_ms")


@query("progress_rates", """
WITH h AS (SELECT event_type, date_trunc('hour', ts) AS h, count(*) AS n, epoch_us(max(ts)) // 1000 AS at_ms FROM events GROUP BY 1, 2),
p AS (SELECT event_type, CAST(sum(n) OVER (PARTITION BY event_type ORDER BY at_ms) AS BIGINT) AS total, at_ms FROM h),
q AS (SELECT *, lag(total) OVER w AS pt, lag(at_ms) OVER w AS pa, min(at_ms) OVER (PARTITION BY event_type) AS s FROM p WINDOW w AS (PARTITION BY event_type ORDER BY at_ms))
SELECT event_type, total, at_ms, CASE WHEN at_ms - pa > 0 THEN (total - pt) * 1000.0::DOUBLE / (at_ms - pa) ELSE 0.0::DOUBLE END AS interval_rate,
  CASE WHEN at_ms - s > 0 THEN total * 1000.0::DOUBLE / (at_ms - s) ELSE 0.0::DOUBLE END AS cumulative_rate FROM q""")
def progress_rates(t: Tables) -> DataFrame:
    return monitor.progress_rates(_progress(t), ["event_type"])


def _lag_samples(t: Tables) -> DataFrame:
    return t.events.groupBy(F.date_trunc("hour", "ts").alias("h")).agg(
        (F.max("event_id") + 1).alias("end_offset"), (F.max("event_id") + 1 - F.min("user_id")).alias("committed"),
        F.unix_millis(F.max("ts")).alias("at_ms"),
    ).drop("h")


_LAG_SQL = """WITH s AS (
  SELECT max(event_id) + 1 AS end_offset, max(event_id) + 1 - min(user_id) AS committed, epoch_us(max(ts)) // 1000 AS at_ms
  FROM events GROUP BY date_trunc('hour', ts))"""


@query("lag_rates", f"""{_LAG_SQL},
q AS (SELECT *, lag(committed) OVER (ORDER BY at_ms) AS pc, lag(at_ms) OVER (ORDER BY at_ms) AS pa FROM s)
SELECT end_offset, committed, at_ms, end_offset - committed AS lag,
  CASE WHEN at_ms - pa > 0 THEN (committed - pc) * 1000.0::DOUBLE / (at_ms - pa) ELSE 0.0::DOUBLE END AS rate FROM q""")
def lag_rates(t: Tables) -> DataFrame:
    return monitor.lag_rates(_lag_samples(t), [])


@query("lag_throttle", f"{_LAG_SQL} SELECT *, end_offset - committed AS lag, end_offset - committed >= 20 AS throttle FROM s")
def lag_throttle(t: Tables) -> DataFrame:
    return monitor.throttled(_lag_samples(t), 20)


@query("commit_prefix", f"""WITH {fx.COMMITS_SQL},
o AS (SELECT range_start, coalesce(max(range_end) OVER (ORDER BY range_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS reach, range_end FROM commits)
SELECT coalesce(min(reach) FILTER (WHERE range_start > reach), max(range_end)) AS committed, count(*) FILTER (WHERE range_start > reach) AS gaps FROM o""")
def commit_prefix(t: Tables) -> DataFrame:
    return monitor.commit_prefix(fx.commits(t), 0)


@query("commit_stalls", f"""WITH {fx.COMMITS_SQL},
o AS (SELECT *, epoch_us(committed_at) // 1000 - epoch_us(lag(committed_at) OVER (ORDER BY committed_at)) // 1000 AS gap_ms FROM commits)
SELECT range_start, gap_ms FROM o WHERE gap_ms > 30000000""")
def commit_stalls(t: Tables) -> DataFrame:
    """Commits after more than 30,000 s without one."""
    return monitor.commit_stalls(fx.commits(t), [], "committed_at", 30_000_000).select("range_start", "gap_ms")


@query("failure_streaks", """
WITH f AS (SELECT user_id, event_id, event_type IN ('error', 'view') AS failed FROM events),
r AS (SELECT *, sum(CASE WHEN failed THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM f)
SELECT user_id, count(*) AS failures, min(event_id) AS first_at, max(event_id) AS last_at FROM r WHERE failed GROUP BY user_id, run HAVING count(*) >= 3""")
def failure_streaks(t: Tables) -> DataFrame:
    failed = F.col("event_type").isin("error", "view")
    return monitor.failure_streaks(t.events, ["user_id"], "event_id", failed, 3)
