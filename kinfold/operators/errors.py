"""Error classes, what each one leads to, and the row function that routes failures."""

from __future__ import annotations

import heapq
import json
import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kinfold.schemas import CALL, OUTCOME

# Error class -> category (fixed values). The narrowest class of a failure decides.
CATEGORY_OF = {
    "UNKNOWN_DATA_SOURCE": "CONFIG_RELEVANT",
    "NOT_FOUND": "NOT_FOUND",
    "CONFIGURATION": "CONFIG_RELEVANT",
    "REPLACE_CONFLICT": "REPLACE_CONFLICT",
    "BAD_INPUT": "BAD_INPUT",
    "RETRY_TIMEOUT": "RETRY_EXHAUSTED",
    "RETRYABLE": "RETRYABLE",
}
REPROCESSABLE = ["RETRY_EXHAUSTED", "CONFIG_RELEVANT", "REPLACE_CONFLICT"]
SYSTEMIC = "SYSTEMIC"


def classify(error_class: Column) -> Column:
    """Category of an error class; an unknown class is systemic."""
    table = F.create_map(*[F.lit(x) for pair in CATEGORY_OF.items() for x in pair])
    return F.coalesce(F.try_element_at(table, error_class), F.lit(SYSTEMIC))


def disposition(category: Column, not_found_is_benign: bool = False) -> Column:
    """What is written for a failed record: a category, or SKIP for nothing. RETRYABLE means its
    budget ran out. SYSTEMIC is left for :func:`fail_on_systemic`."""
    return (
        F.when(category == "NOT_FOUND", F.lit("SKIP" if not_found_is_benign else "BAD_INPUT"))
        .when(category == "RETRYABLE", F.lit("RETRY_EXHAUSTED"))
        .otherwise(category)
    )


def fail_on_systemic(category: Column) -> Column:
    """The category itself; a systemic one stops the job instead of filling the dead letter."""
    stop = F.raise_error(F.lit("systemic error: the job must stop")).cast("string")
    return F.when(category == SYSTEMIC, stop).otherwise(category)


class VerbError(Exception):
    """A failure raised by a row function, with its class and an optional code."""

    def __init__(self, error_class: str, message: str = "", code: str = ""):
        super().__init__(message or error_class)
        self.error_class, self.code = error_class, code


@dataclass(frozen=True)
class RetryPolicy:
    """Retry budget per record and the number of failures in a row that stops the task."""

    budget_ms: int = 60_000
    base_ms: int = 1_000
    cap_ms: int = 30_000
    breaker: int = 20

    def delay_ms(self, round_number: int) -> float:
        """A uniform draw from the upper half of the step, which doubles each round up to the cap."""
        step = min(self.base_ms * 2.0 ** min(round_number, 30), self.cap_ms)
        return random.uniform(step / 2, step)


# What a category leads to within a task. RETRY waits and calls again, REFRESH calls again once after the configuration was re-read.
ACTIONS = {
    "RETRYABLE": "RETRY", "CONFIG_RELEVANT": "REFRESH", "REPLACE_CONFLICT": "REFRESH", "NOT_FOUND": "ABSENT",
    "BAD_INPUT": "REJECT", "RETRY_EXHAUSTED": "REJECT", SYSTEMIC: "STOP",
}


@dataclass
class _Call:
    """One record's way through its calls. The budget runs from its own first call on."""

    row: dict
    began: float | None = None
    attempts: int = 0
    elapsed_ms: int = 0
    response: str | None = None
    error: VerbError | None = None
    refreshed: bool = False
    conflicts: int = 0

    @property
    def category(self) -> str | None:
        return CATEGORY_OF.get(self.error.error_class, SYSTEMIC) if self.error else None


class _Line:
    """The calls of one task, one at a time: new records in order, and failed ones again when they are due.

    After a failure that is due again nothing is called for a while, which doubles with each failure in a row up to the cap; the record that failed first comes next then. So in
    an outage a task waits like a single record would, and a short one passes before the breaker opens, whatever the number of records. A record that fails on its
    own does not hold up the others while it waits.
    """

    def __init__(self, verb: Callable[[str, str, str, int], str], policy: RetryPolicy, refresh: Callable[[], bool] | None):
        self.verb, self.policy, self.refresh = verb, policy, refresh
        self.waiting: list[tuple[float, int, _Call]] = []  # heap by due time
        self.resume, self.in_a_row, self.pushed = 0.0, 0, 0

    def settled(self, rows: list[dict]) -> Iterator[_Call]:
        """Calls that are done, of ``rows`` and of records that were waiting; some may go on waiting."""
        for row in rows:
            yield from self.due(time.monotonic())
            yield from self.once(_Call(row))

    def rest(self) -> Iterator[_Call]:
        while self.waiting:
            yield from self.due(self.waiting[0][0])

    def due(self, now: float) -> Iterator[_Call]:
        """Call the records due until ``now``, or until the end of the pause if one is on."""
        while self.waiting and self.waiting[0][0] <= max(now, self.resume):
            due, _, record = heapq.heappop(self.waiting)
            time.sleep(max(0.0, due - time.monotonic()))
            yield from self.once(record)

    def once(self, record: _Call) -> Iterator[_Call]:
        started = time.monotonic()
        if started < self.resume:
            time.sleep(self.resume - started)
            started = time.monotonic()
        record.began = started if record.began is None else record.began
        try:
            record.response = self.verb(record.row["dataSource"], record.row["recordId"], record.row["payload"], record.attempts)
            record.error = None
        except VerbError as error:
            record.error = error
        now = time.monotonic()
        record.elapsed_ms = int((now - started) * 1000)
        record.conflicts += record.category == "REPLACE_CONFLICT"
        action = ACTIONS.get(record.category)
        if action is None:
            self.in_a_row = 0
        elif action == "STOP":
            raise record.error
        elif action == "RETRY":
            self.in_a_row += 1
            if self.in_a_row >= self.policy.breaker:
                raise record.error
            if (now - record.began) * 1000 < self.policy.budget_ms:
                pause = self.policy.delay_ms(self.in_a_row - 1) / 1000
                own = pause if record.attempts == 0 else self.policy.delay_ms(record.attempts) / 1000
                record.attempts += 1
                self.resume = now + pause
                self._wait(record, now + own)
                return
        elif action == "REFRESH" and self.refresh and not record.refreshed and self.refresh():
            record.refreshed = True
            yield from self.once(record)
            return
        yield record

    def _wait(self, record: _Call, due: float) -> None:
        self.pushed += 1
        heapq.heappush(self.waiting, (due, self.pushed, record))


ROUTED = T.StructType([*OUTCOME.fields, T.StructField("elapsedMs", T.LongType())])
LEDGERED = T.StructType([*ROUTED.fields, T.StructField("conflicts", T.IntegerType()), T.StructField("affected", T.IntegerType())])


def route_errors(
    records: DataFrame,
    verb: Callable[[str, str, str, int], str],
    op: str,
    run_id: str,
    policy: RetryPolicy = RetryPolicy(),
    not_found_is_benign: bool = False,
    refresh: Callable[[], bool] | None = None,
    ledger: bool = False,
) -> DataFrame:
    """Apply ``verb(dataSource, recordId, payload, attempt)`` to every row and route what fails.

    Calls go out one at a time in a task. A record that may go again waits in a heap by its due time, over the end of its Arrow batch if need be, for at most its budget.
    ``refresh`` re-reads the configuration after a config-relevant failure; if it returns true the
    record is tried once more. The gate on required keys runs before this, as a column expression.

    A record has as many outcome rows as entities it affected: none, one or many. With ``ledger`` the same pass also gives one row of kind CALL for
    each record, with the category that is written for it, or NOT_FOUND where that is passed over as benign, its retries and conflicts, the entities it affected
    and the time of its last call. `outcomes.split_calls` takes the two apart again.
    """

    def entries(record: _Call) -> list[dict]:
        rows = outcomes(record)
        if ledger:
            key = {"dataSource": record.row["dataSource"], "recordId": record.row["recordId"], "op": op, "runId": run_id}
            affected = sum(row["kind"] == "AFFECTED" for row in rows)
            counts = {"attempts": record.attempts, "conflicts": record.conflicts, "affected": affected, "elapsedMs": record.elapsed_ms}
            rows.append({"kind": CALL, **key, "category": written_category(record), **counts})
        return rows

    def written_category(record: _Call) -> str | None:
        if record.category == "NOT_FOUND":
            return "NOT_FOUND" if not_found_is_benign else "BAD_INPUT"
        return "RETRY_EXHAUSTED" if record.category == "RETRYABLE" else record.category

    def outcomes(record: _Call) -> list[dict]:
        row, ms = record.row, {"elapsedMs": record.elapsed_ms}
        if record.error:
            if record.category == "NOT_FOUND" and not_found_is_benign:
                return []
            error = {"category": written_category(record), "errorCode": record.error.code, "message": str(record.error), "attempts": record.attempts}
            return [{"kind": "ERROR", **row, **error, **ms}]
        if op == "SEARCH":
            return [{"kind": "SEARCH", "requestJson": row["payload"], "resultJson": record.response, **ms}]
        ids = [item.get("ENTITY_ID") for item in json.loads(record.response).get("AFFECTED_ENTITIES") or []]
        key = {"dataSource": row["dataSource"], "recordId": row["recordId"], "op": op, "runId": run_id}
        return [{"kind": "AFFECTED", **key, "entityId": i, **ms} for i in ids if type(i) is int]

    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        line = _Line(verb, policy, refresh)
        for batch in batches:
            yield written(line.settled(batch.to_pylist()))
        yield written(line.rest())

    def written(done: Iterator[_Call]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([row for record in done for row in entries(record)], schema=shape)

    columns = LEDGERED if ledger else ROUTED
    shape = to_arrow_schema(columns)
    return records.select("dataSource", "recordId", "payload").mapInArrow(partition, columns)
