"""Progress, lag, stall and streak reports over progress tables and commit logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kinfold.operators.ordered import lagged, running, with_range


def per_second(count: Column, millis: Column) -> Column:
    """Rows per second, 0 when no time has passed."""
    return F.when(millis > 0, count * 1000.0 / millis).otherwise(F.lit(0.0))


def progress_rates(progress: DataFrame, series: list[str], **ranges) -> DataFrame:
    """(`total`, `at_ms`) samples with the rate since the sample before and since the first one."""
    ranged = with_range(progress, "at_ms", **ranges)
    start = ranged.groupBy(*series).agg(F.min("at_ms").alias("_start")) if series else ranged.agg(F.min("at_ms").alias("_start"))
    steps = lagged(ranged, series, ["at_ms"], ["total", "at_ms"])
    # One row per series; without a series it is a single value.
    began = F.col("_start")
    based = steps.join(start, series) if series else steps.withColumn("_start", start.scalar())
    first = F.col("prev_at_ms").isNull()
    interval = per_second(F.col("total") - F.col("prev_total"), F.col("at_ms") - F.col("prev_at_ms"))
    return based.select(
        *progress.columns,
        F.when(first, F.lit(0.0)).otherwise(interval).alias("interval_rate"),
        per_second(F.col("total"), F.col("at_ms") - began).alias("cumulative_rate"),
    )


def lag_rates(samples: DataFrame, series: list[str], **ranges) -> DataFrame:
    """(`end_offset`, `committed`, `at_ms`) samples with lag and commit rate, 0 for the first."""
    ranged = with_range(samples, "at_ms", **ranges)
    steps = lagged(ranged, series, ["at_ms"], ["committed", "at_ms"])
    rate = per_second(F.col("committed") - F.col("prev_committed"), F.col("at_ms") - F.col("prev_at_ms"))
    return steps.select(
        *samples.columns,
        (F.col("end_offset") - F.col("committed")).alias("lag"),
        F.when(F.col("prev_at_ms").isNull(), F.lit(0.0)).otherwise(rate).alias("rate"),
    )


def throttled(samples: DataFrame, max_lag: int) -> DataFrame:
    lag = F.col("end_offset") - F.col("committed")
    return samples.select("*", lag.alias("lag"), (lag >= max_lag).alias("throttle"))


def commit_prefix(commits: DataFrame, start: int, **ranges) -> DataFrame:
    """Where a restart may resume: the end of the gap-free run of committed ranges from ``start``.

    Ranges may be committed in any order, repeat, or overlap; whatever lies behind the prefix changes
    nothing.
    """
    ahead = commits.filter(F.col("range_end") > start)
    ranged = with_range(ahead, ["range_start", "range_end"], **ranges)
    reach = running(ranged, [], ["range_start", "range_end"], F.col("range_end"), "max", "_reach", current=False)
    before = F.greatest(F.lit(start), F.coalesce("_reach", F.lit(start)))
    gap = F.col("range_start") > before
    return reach.agg(
        F.coalesce(
            F.min(F.when(gap, before)), F.greatest(F.max("range_end"), F.lit(start)), F.lit(start)
        ).cast("bigint").alias("committed"),
        F.count_if(gap).alias("gaps"),
    )


def commit_stalls(commits: DataFrame, series: list[str], at: str, window_ms: int, order: list[str] | None = None, **ranges) -> DataFrame:
    """Commits that came more than ``window_ms`` after the one before."""
    order = order or [at]
    steps = lagged(with_range(commits, order, **ranges), series, order, [at])
    gap = F.unix_millis(at) - F.unix_millis(f"prev_{at}")
    return steps.select(*commits.columns, gap.alias("gap_ms")).filter(F.col("gap_ms") > window_ms)


def failure_streaks(log: DataFrame, series: list[str], order: str, failed: Column, at_least: int, **ranges) -> DataFrame:
    """Runs of at least ``at_least`` failures with no success between them."""
    flagged = log.select(*series, order, failed.alias("_failed"))
    ranged = with_range(flagged, order, **ranges)
    resets = running(ranged, series, [order], F.when(F.col("_failed"), 0).otherwise(1), "sum", "_run")
    runs = resets.filter("_failed").groupBy(*series, "_run").agg(
        F.count(F.lit(1)).alias("failures"), F.min(order).alias("first_at"), F.max(order).alias("last_at")
    )
    return runs.filter(F.col("failures") >= at_least).drop("_run")
