import os
import random
import time

import pytest
from pyspark.sql import Observation, functions as F

from kinfold.operators import deadletter as dl, errors as er, outcomes as out
from kinfold.streaming.feeder import drain

INPUT = "dataSource string, recordId string, payload string"


def letters(spark, *rows):
    full = [(f"r{i}", c) for i, c in enumerate(rows)]
    return spark.createDataFrame(full, "recordId string, category string").withColumns({
        "dataSource": F.lit("S"), "payload": F.lit("{}"), "errorCode": F.lit(""), "message": F.lit(""), "attempts": F.lit(0),
        "failedAt": F.current_timestamp(), "source": F.lit("t"),
    })


def again(rows, keep):
    """Outcome rows in which the records of ``keep`` fail again."""
    failing = rows.filter(F.col("recordId").isin(keep)).withColumns({
        "category": F.lit("REPLACE_CONFLICT"), "errorCode": F.lit(""), "message": F.lit(""), "attempts": F.lit(0),
    })
    good = rows.filter(~F.col("recordId").isin(keep)).select(
        "dataSource", "recordId", F.lit(1).alias("entityId"), F.lit("ADD").alias("op"), F.lit("x").alias("runId")
    )
    return out.outcome_union(affected=good, errors=failing)


def test_sweep_is_repeatable(spark, folder):
    paths = [f"{folder}/{p}" for p in ("dead", "feed", "ledger")]
    assert dl.sweep(spark, *paths) == 0
    dl.write_dead_letter(letters(spark, "BAD_INPUT", "CONFIG_RELEVANT", "RETRY_EXHAUSTED"), paths[0])
    assert dl.sweep(spark, *paths) == 2
    assert dl.sweep(spark, *paths) == 0
    dl.write_dead_letter(letters(spark, "REPLACE_CONFLICT"), paths[0])
    assert dl.sweep(spark, *paths) == 1
    assert spark.read.parquet(paths[1]).count() == 3


def test_sweep_reads_new_files_only(spark, folder):
    """Swept files may go; folders of a feeder's batches and shards are read; a sweep that broke off is repeated as a whole."""
    paths = [f"{folder}/{p}" for p in ("dead", "feed", "ledger")]
    dl.write_dead_letter(letters(spark, "RETRY_EXHAUSTED", "CONFIG_RELEVANT"), f"{paths[0]}/shard=0/batch_id=0")
    assert dl.sweep(spark, *paths) == 2
    for name in os.listdir(f"{paths[0]}/shard=0/batch_id=0"):
        os.remove(f"{paths[0]}/shard=0/batch_id=0/{name}")
    dl.write_dead_letter(letters(spark, "REPLACE_CONFLICT", "BAD_INPUT", "RETRY_EXHAUSTED"), f"{paths[0]}/shard=1/batch_id=0")
    with open(f"{folder}/in-the-way", "w"):
        pass
    with pytest.raises(Exception):
        dl.sweep(spark, paths[0], f"{folder}/in-the-way", paths[2])
    dl.write_dead_letter(letters(spark, "REPLACE_CONFLICT"), f"{paths[0]}/shard=1/batch_id=1")
    assert dl.sweep(spark, *paths) == 3
    assert dl.sweep(spark, *paths) == 0
    found = spark.read.parquet(paths[1]).groupBy("sweep").count().collect()
    assert sorted(map(tuple, found)) == [(0, 2), (1, 2), (2, 1)]


@pytest.mark.parametrize(
    "keep, rounds, want",
    [
        (lambda n: [], 3, (1, 4, 0, True)),
        (lambda n: ["r0", "r1", "r2", "r3"], 3, (1, 4, 4, False)),
        (lambda n: ["r0", "r1", "r2", "r3"][: 3 - n], 2, (2, 7, 2, False)),
        (lambda n: ["r0", "r1", "r2", "r3"][: 3 - n], 9, (4, 10, 0, True)),
    ],
)
def test_converge_stops(spark, folder, keep, rounds, want):
    dl.write_dead_letter(letters(spark, *["CONFIG_RELEVANT"] * 4, "BAD_INPUT"), f"{folder}/dead")
    calls = []

    def redrive(rows):
        calls.append(1)
        return again(rows, keep(len(calls) - 1))

    done = dl.converge(spark, f"{folder}/dead", f"{folder}/work", f"{folder}/q", redrive, rounds)
    assert (done.rounds, done.re_fed, done.quarantined, done.drained) == want
    if want[2]:
        assert spark.read.parquet(f"{folder}/q").count() == want[2]


def test_converge_without_work(spark, folder):
    dl.write_dead_letter(letters(spark, "BAD_INPUT"), f"{folder}/dead")
    done = dl.converge(spark, f"{folder}/dead", f"{folder}/work", f"{folder}/q", lambda rows: rows)
    assert (done.rounds, done.re_fed, done.drained) == (1, 0, True)


def test_converge_after_a_crash(spark, folder):
    """A re-drive that fails loses nothing, and a finished folder drives new letters only."""
    paths = (f"{folder}/dead", f"{folder}/work", f"{folder}/q")
    dl.write_dead_letter(letters(spark, *["CONFIG_RELEVANT"] * 4), paths[0])

    def crash(rows):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        dl.converge(spark, *paths, crash)
    done = dl.converge(spark, *paths, lambda rows: again(rows, []))
    assert (done.re_fed, done.drained) == (4, True)
    assert dl.converge(spark, *paths, lambda rows: again(rows, [])).re_fed == 0
    dl.write_dead_letter(letters(spark, "CONFIG_RELEVANT"), paths[0])
    assert dl.converge(spark, *paths, lambda rows: again(rows, ["r0"])).quarantined == 1
    assert spark.read.parquet(paths[2]).count() == 1


def test_backoff_bounds():
    policy = er.RetryPolicy()
    for number, step in [(0, 1000), (1, 2000), (4, 16000), (5, 30000), (2000, 30000)]:
        assert all(step / 2 <= policy.delay_ms(number) <= step for _ in range(50))


def route(spark, verb, **options):
    rows = spark.createDataFrame([("S", str(i), "{}") for i in range(30)], INPUT).coalesce(1)
    return er.route_errors(rows, verb, "ADD", "run", **options)


def test_retry_then_success_and_budget(spark):
    def flaky(source, record, payload, attempt):
        if int(record) % 2 and attempt < 2:
            raise er.VerbError("RETRYABLE", "busy")
        return '{"AFFECTED_ENTITIES":[{"ENTITY_ID":1}]}'

    quick = er.RetryPolicy(budget_ms=60_000, base_ms=0, cap_ms=0)
    assert route(spark, flaky, policy=quick).filter("kind = 'AFFECTED'").count() == 30
    spent = er.RetryPolicy(budget_ms=0, base_ms=0, cap_ms=0)
    rows = route(spark, flaky, policy=spent).groupBy("kind", "category").count().collect()
    assert {(r.kind, r.category): r["count"] for r in rows} == {("AFFECTED", None): 15, ("ERROR", "RETRY_EXHAUSTED"): 15}


def test_breaker_and_systemic_stop_the_task(spark):
    def down(source, record, payload, attempt):
        raise er.VerbError("RETRYABLE", "down")

    with pytest.raises(Exception, match="down"):
        route(spark, down, policy=er.RetryPolicy(budget_ms=0)).collect()

    def broken(source, record, payload, attempt):
        raise er.VerbError("OUT_OF_MEMORY", "no memory")

    with pytest.raises(Exception, match="no memory"):
        route(spark, broken).collect()


def test_not_found_and_refresh(spark):
    def missing(source, record, payload, attempt):
        raise er.VerbError("NOT_FOUND", "none", "33")

    row = route(spark, missing).first()
    assert (row.category, row.errorCode, row.attempts) == ("BAD_INPUT", "33", 0)
    assert route(spark, missing, not_found_is_benign=True).count() == 0

    def unknown_once():
        seen = set()

        def verb(source, record, payload, attempt):
            if record not in seen:
                seen.add(record)
                raise er.VerbError("UNKNOWN_DATA_SOURCE", "unknown")
            return "{}"

        return verb

    assert route(spark, unknown_once(), refresh=lambda: True).filter("kind = 'ERROR'").count() == 0
    assert route(spark, unknown_once()).filter("category = 'CONFIG_RELEVANT'").count() == 30


def test_disposition_and_systemic_column(spark):
    rows = spark.createDataFrame([("NOT_FOUND",), ("RETRYABLE",), ("BAD_INPUT",)], "c string")
    written = {r.c: (r.w, r.b) for r in rows.select("c", er.disposition(F.col("c")).alias("w"), er.disposition(F.col("c"), True).alias("b")).collect()}
    assert written == {"NOT_FOUND": ("BAD_INPUT", "SKIP"), "RETRYABLE": ("RETRY_EXHAUSTED",) * 2, "BAD_INPUT": ("BAD_INPUT",) * 2}
    with pytest.raises(Exception, match="systemic"):
        spark.createDataFrame([("X",)], "c string").select(er.fail_on_systemic(er.classify(F.col("c")))).collect()


def uneven_verb():
    def uneven(source, record, payload, attempt):
        """Records 0-3 affect as many entities; 4 conflicts, 5 is absent, 6 passes at the third attempt, 7 is bad; 8 takes its time."""
        number = int(record)
        if number in (4, 5, 7):
            raise er.VerbError({4: "REPLACE_CONFLICT", 5: "NOT_FOUND", 7: "BAD_INPUT"}[number], "no")
        if number == 6 and attempt < 2:
            raise er.VerbError("RETRYABLE", "busy")
        if number == 8:
            time.sleep(0.2)
        return '{"AFFECTED_ENTITIES":[%s]}' % ",".join('{"ENTITY_ID":%d}' % i for i in range(number if number < 4 else 1))

    return uneven


CALM = er.RetryPolicy(budget_ms=60_000, base_ms=1, cap_ms=1)


@pytest.mark.parametrize("benign", [True, False])
def test_counters_count_records(spark, benign):
    routed = route(spark, uneven_verb(), policy=CALM, ledger=True, not_found_is_benign=benign)
    seen = Observation("calls")
    rows = out.observe_counters(routed, seen, slow_ms=150).collect()
    want = {"succeeded": 27, "errored": 2 if benign else 3, "notFound": int(benign), "replaceConflict": 1, "retried": 2, "long": 1}
    assert seen.get == want
    assert out.outcome_counters(routed, slow_ms=150).collect()[0].asDict() == want
    assert sum(r.kind == "CALL" for r in rows) == 30 and sum(r.kind == "AFFECTED" for r in rows) == 6 + 23
    plain = route(spark, uneven_verb(), policy=CALM, not_found_is_benign=benign)
    outcomes, calls = out.split_calls(routed)
    assert outcomes.columns == plain.columns and outcomes.drop("elapsedMs").exceptAll(plain.drop("elapsedMs")).count() == 0
    assert [r.recordId for r in out.slow_records(calls, 150).collect()] == ["8"]
    assert {r.recordId: r.affected for r in calls.collect() if int(r.recordId) < 6} == {"0": 0, "1": 1, "2": 2, "3": 3, "4": 0, "5": 0}


def test_a_conflict_counts_even_if_the_refresh_cures_it(spark):
    tried = []

    def verb(source, record, payload, attempt):
        tried.append(record)
        if tried.count(record) == 1:
            raise er.VerbError("REPLACE_CONFLICT", "old")
        return "{}"

    counted = out.outcome_counters(route(spark, verb, policy=CALM, ledger=True, refresh=lambda: True)).collect()[0]
    assert (counted.succeeded, counted.errored, counted.replaceConflict) == (30, 0, 30)


def test_counters_of_no_calls(spark):
    none = route(spark, uneven_verb(), policy=CALM, ledger=True).limit(0)
    assert set(out.outcome_counters(none).collect()[0]) == {0}


def test_a_stream_observes_its_counters_and_writes_its_ledger(spark, folder):
    shape = "dataSource string, recordId string, payload string"
    spark.createDataFrame([("S", str(i), "{}") for i in range(30)], shape).write.parquet(f"{folder}/in")
    routed = er.route_errors(spark.readStream.schema(shape).parquet(f"{folder}/in"), uneven_verb(), "ADD", "run", CALM, ledger=True)
    writer = out.observe_counters(routed, "calls").writeStream.format("parquet").option("path", f"{folder}/out")
    stream = writer.option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start()
    drain([stream])
    seen = [p.observedMetrics["calls"] for p in stream.recentProgress if "calls" in p.observedMetrics]
    assert (sum(m.succeeded for m in seen), sum(m.errored for m in seen), sum(m.retried for m in seen)) == (27, 3, 2)
    out.write_split(spark.read.parquet(f"{folder}/out"), f"{folder}/good", f"{folder}/bad")
    assert {r.kind for r in spark.read.parquet(f"{folder}/good").select("kind").distinct().collect()} == {"AFFECTED"}
    assert spark.read.parquet(f"{folder}/bad").count() == 3


def test_stream_dedup_forgets_keys_behind_the_watermark(spark, folder):
    """Within the span repeats go, over a restart too; rows behind the watermark are late; a key comes again when its span is over."""
    shape = "dataSource string, recordId string, entityId long, at timestamp"
    rounds = [
        [("S", "a", 1, 0), ("S", "a", 1, 1), ("S", "b", 1, 2), ("S", None, 1, 2), ("S", None, 1, 3)],
        [("S", "a", 1, 8), ("S", "c", 1, 100)],
        [("S", "late", 1, 5), ("S", "c", 1, 101)],
        [("S", "a", 1, 102)],
    ]
    got = []
    for number, rows in enumerate(rounds):
        timed = spark.createDataFrame(rows, "dataSource string, recordId string, entityId long, s long")
        timed.withColumn("at", F.timestamp_seconds("s")).drop("s").coalesce(1).write.mode("append").parquet(f"{folder}/in")
        once = out.affected_feed_dedup(spark.readStream.schema(shape).parquet(f"{folder}/in"), "at", "10 seconds")
        writer = once.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/cp")
        drain([writer.trigger(availableNow=True).start()])
        got.append(spark.read.parquet(f"{folder}/out").count())
    assert got == [3, 4, 4, 5]
    with pytest.raises(ValueError, match="time column"):
        out.affected_feed_dedup(spark.readStream.schema(shape).parquet(f"{folder}/in"))


def test_a_batch_may_take_longer_than_one_record_s_budget(spark):
    """The budget is each record's own: the last one fails once after all others took their time, and is retried."""

    def slow(source, record, payload, attempt):
        time.sleep(0.02)
        if record == "29" and attempt == 0:
            raise er.VerbError("RETRYABLE", "busy")
        return '{"AFFECTED_ENTITIES":[{"ENTITY_ID":1}]}'

    assert route(spark, slow, policy=er.RetryPolicy(budget_ms=300, base_ms=1, cap_ms=1)).filter("kind = 'AFFECTED'").count() == 30


def test_a_blip_does_not_open_the_breaker(spark):
    """Every record fails once, or none passes for a while: with waits in between the failures in a row stay few."""

    def once(source, record, payload, attempt):
        if attempt == 0:
            raise er.VerbError("RETRYABLE", "blip")
        return '{"AFFECTED_ENTITIES":[{"ENTITY_ID":1}]}'

    quick = er.RetryPolicy(budget_ms=60_000, base_ms=4, cap_ms=50, breaker=20)
    assert route(spark, once, policy=quick).filter("kind = 'AFFECTED'").count() == 30

    def outage():
        began = []

        def verb(source, record, payload, attempt):
            began.append(time.monotonic())
            if began[-1] - began[0] < 0.3:
                raise er.VerbError("RETRYABLE", "outage")
            return '{"AFFECTED_ENTITIES":[{"ENTITY_ID":1}]}'

        return verb

    assert route(spark, outage(), policy=quick).filter("kind = 'AFFECTED'").count() == 30


def test_one_failing_record_does_not_hold_up_the_others():
    order = []

    def verb(source, record, payload, attempt):
        order.append((record, attempt))
        if record == "0":
            raise er.VerbError("RETRYABLE", "always")
        return "{}"

    line = er._Line(verb, er.RetryPolicy(budget_ms=400, base_ms=10, cap_ms=200), None)
    rows = [{"dataSource": "S", "recordId": str(i), "payload": "{}"} for i in range(20)]
    done = [c.row["recordId"] for c in line.settled(rows)] + [c.row["recordId"] for c in line.rest()]
    assert sorted(done, key=int) == [str(i) for i in range(20)] and done[-1] == "0"
    assert order[0] == ("0", 0) and order[1] == ("0", 1) and [r for r, _ in order].index("1") < len(order) - 1
    attempts = [a for r, a in order if r == "0"]
    assert attempts == list(range(len(attempts))) and len(attempts) > 3


def test_each_record_lands_in_one_sink(spark, folder):
    """The verb answers at random, so a second evaluation would differ: outcomes are stored before they are split."""

    def moody(source, record, payload, attempt):
        if random.random() < 0.5:
            raise er.VerbError("BAD_INPUT", "no")
        return '{"AFFECTED_ENTITIES":[{"ENTITY_ID":1}]}'

    scratch = spark.conf.get("spark.checkpoint.dir")
    out.write_split(route(spark, moody), f"{folder}/good", f"{folder}/bad")
    good, bad = ({r.recordId for r in spark.read.parquet(f"{folder}/{x}").collect()} for x in ("good", "bad"))
    assert good.isdisjoint(bad) and good | bad == {str(i) for i in range(30)}
    assert not [f for f in os.listdir(scratch) if f.startswith("outcomes-")]
