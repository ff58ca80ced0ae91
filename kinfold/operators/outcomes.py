"""Outcome rows: one tagged union of affected, search and error rows, its split, dedup and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from kinfold.schemas import AFFECTED_COLUMNS, CALL, CALL_COLUMNS, ERROR_COLUMNS, LEDGER_ONLY, OUTCOME, SEARCH_COLUMNS
from kinfold.session import stored

ERROR_KEY = ["dataSource", "recordId", "category"]
AFFECTED_KEY = ["dataSource", "recordId", "entityId"]


def _tagged(rows: DataFrame, kind: str, columns: list[str]) -> DataFrame:
    """Rows of one kind in the full outcome shape, absent columns null."""
    return rows.select(*[
        F.lit(kind).alias("kind") if field.name == "kind"
        else (F.col(field.name) if field.name in columns else F.lit(None)).cast(field.dataType).alias(field.name)
        for field in OUTCOME
    ])


def outcome_union(
    affected: DataFrame | None = None, search: DataFrame | None = None, errors: DataFrame | None = None
) -> DataFrame:
    parts = []
    if affected is not None:
        parts.append(_tagged(affected, "AFFECTED", AFFECTED_COLUMNS))
    if search is not None:
        parts.append(_tagged(search, "SEARCH", SEARCH_COLUMNS))
    if errors is not None:
        parts.append(_tagged(errors, "ERROR", ERROR_COLUMNS))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def affected_rows(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter(F.col("kind") == "AFFECTED").select(*AFFECTED_COLUMNS)


def search_rows(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter(F.col("kind") == "SEARCH").select(*SEARCH_COLUMNS)


def error_rows(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter(F.col("kind") == "ERROR").select(*ERROR_COLUMNS)


def good_rows(outcomes: DataFrame) -> DataFrame:
    """Outcome rows of calls that passed; rows of the ledger are no outcomes."""
    return outcomes.filter(~F.col("kind").isin("ERROR", CALL)).drop(*LEDGER_ONLY)


def split_calls(routed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(outcome rows, one row for each record called) of ``route_errors`` with a ledger.

    Both are filters over the same rows: store them first if the verb may answer differently when it is called again.
    """
    outcomes = routed.filter(F.col("kind") != CALL).drop(*LEDGER_ONLY)
    return outcomes, routed.filter(F.col("kind") == CALL).select(*CALL_COLUMNS)


def stamp_failure(errors: DataFrame, source: str) -> DataFrame:
    return errors.withColumns({"failedAt": F.current_timestamp(), "source": F.lit(source)})


def write_split(outcomes: DataFrame, good_path: str, error_path: str) -> None:
    """Both batch sinks from one pass: the rows are computed and stored once, so each is in one of the sinks and not in both."""
    with stored(outcomes, "outcomes") as kept:
        good_rows(kept).write.mode("overwrite").parquet(good_path)
        error_rows(kept).write.mode("overwrite").parquet(error_path)


def affected_dedup(affected: DataFrame, batch: str = "batch", order: str = "recordId") -> DataFrame:
    """One row per (batch, entity): that of the first record which touched it.

    ``min`` over the rows combines before the shuffle, so an entity that most records touch costs one
    row per map task.
    """
    rest = [c for c in affected.columns if c not in (batch, "entityId", order)]
    first = affected.groupBy(batch, "entityId").agg(
        F.min(F.struct(F.col(order), *rest)).alias("_first")
    )
    return first.select(batch, "entityId", "_first.*").select(*affected.columns)


def dead_letter_dedup(rows: DataFrame, at: str = "failedAt") -> DataFrame:
    """The latest row of each (source, record, category); ties go to the greatest row."""
    rest = [c for c in rows.columns if c not in ERROR_KEY and c != at]
    latest = rows.groupBy(*ERROR_KEY).agg(F.max(F.struct(F.col(at), *rest)).alias("_row"))
    return latest.select(*ERROR_KEY, "_row.*").select(*rows.columns)


def affected_feed_dedup(affected: DataFrame, at: str | None = None, within: str = "1 day") -> DataFrame:
    """One row per (dataSource, recordId, entityId).

    A stream needs ``at``, a time column without nulls: its state holds a key until the watermark, ``within`` behind the latest time, has passed the key's
    first row by as much again, so it is bounded by the rows of that span. A repeat within the span is dropped; rows behind the watermark are dropped as late.
    """
    if not affected.isStreaming:
        return affected.dropDuplicates(AFFECTED_KEY)
    if at is None:
        raise ValueError("the dedup of a stream needs a time column, which bounds its state")
    return affected.withWatermark(at, within).dropDuplicatesWithinWatermark(AFFECTED_KEY)


def affected_ids(feed: DataFrame) -> DataFrame:
    """Distinct entity ids of a feed of outcome rows."""
    named = feed.filter((F.col("kind") == "AFFECTED") & F.col("entityId").isNotNull())
    return named.select("entityId").distinct()


# Counter name -> condition over calls, that is, one row for each record whatever its outcome rows. An absence that is benign is neither
# succeeded nor errored; one that is not is bad input.
COUNTERS = {
    "succeeded": "category IS NULL",
    "errored": "category <> 'NOT_FOUND'",
    "notFound": "category = 'NOT_FOUND'",
}


def _counters(slow_ms: int) -> list:
    """Aggregates over the CALL rows among all rows."""
    call, none = F.col("kind") == CALL, F.lit(0)
    counts = [F.count_if(call & F.expr(test)).alias(name) for name, test in COUNTERS.items()]
    sums = {"replaceConflict": "conflicts", "retried": "attempts"}
    counts += [F.coalesce(F.sum(F.when(call, F.col(c))), none).cast("bigint").alias(name) for name, c in sums.items()]
    return [*counts, F.count_if(call & _slow(slow_ms)).alias("long")]


def _slow(slow_ms: int) -> Column:
    return F.col("category").isNull() & (F.col("elapsedMs") > slow_ms)


def outcome_counters(routed: DataFrame, by: list[str] = (), slow_ms: int = 300_000) -> DataFrame:
    """Counters over the calls among the rows of ``route_errors`` with a ledger, in all or by some columns of them."""
    return routed.filter(F.col("kind") == CALL).groupBy(*by).agg(*_counters(slow_ms))


def observe_counters(routed: DataFrame, seen: Observation | str, slow_ms: int = 300_000) -> DataFrame:
    """``routed`` as it is; the same counters are collected while another action runs over it, without a pass of their own.

    A batch reads them from an ``Observation``. A stream takes a name, and each of its progress reports has the counters of its batch below that name.
    """
    return routed.observe(seen, *_counters(slow_ms))


def output_stats(outcomes: DataFrame) -> DataFrame:
    return outcomes.agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("entityId").alias("entities")
    )


def slow_records(calls: DataFrame, slow_ms: int = 300_000) -> DataFrame:
    """Calls of ``split_calls`` that passed and took longer than the limit, once each. They are reported, never aborted."""
    return calls.filter(_slow(slow_ms))
