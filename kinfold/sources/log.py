"""Offset logs: bounded reads, range planning, start positions and boundaries.

A log is any frame of (`offset` bigint, `value` string). The Kafka readers at the end give the same
shape and need the Kafka connector on the classpath.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kinfold.sources.records import as_records


def read_range(log: DataFrame, start: int, end: int) -> DataFrame:
    """Records of the half-open offset range ``[start, end)``."""
    span = log.filter((F.col("offset") >= start) & (F.col("offset") < end))
    return as_records(span.withColumn("value", F.col("value").cast("string")))


def log_bounds(log: DataFrame) -> DataFrame:
    """One row: the earliest offset and the exclusive end of the log."""
    return log.agg(
        F.coalesce(F.min("offset"), F.lit(0)).cast("bigint").alias("earliest"),
        F.coalesce(F.max("offset") + 1, F.lit(0)).cast("bigint").alias("latest"),
    )


def latest_version(history: DataFrame) -> DataFrame:
    return history.agg(F.max("version").cast("bigint").alias("latest"))


def next_range(start: int, latest: int, size: int) -> tuple[int, int] | None:
    """The next log chunk, none once caught up. ``latest`` is exclusive."""
    return None if start >= latest else (start, min(start + size, latest))


def next_version_window(start: int, latest: int, versions: int) -> tuple[int, int] | None:
    """The next change-feed chunk. ``latest`` is a version that exists, so it can still be read."""
    return None if start > latest else (start, min(start + versions, latest + 1))


def start_position(spec: str, earliest: int, latest: int) -> int:
    """``earliest``, ``latest`` (exclusive end) or an explicit number."""
    named = {"earliest": earliest, "latest": latest}
    return named[spec] if spec in named else int(spec)


def start_positions(log: DataFrame, by: list[str], specs: list[str]) -> DataFrame:
    """:func:`start_position` for several logs kept in one table."""
    bounds = log.groupBy(*by).agg(
        F.min("offset").alias("_earliest"), (F.max("offset") + 1).alias("_latest")
    )
    spec = F.explode(F.array(*[F.lit(s) for s in specs]))
    position = (
        F.when(F.col("spec") == "earliest", F.col("_earliest"))
        .when(F.col("spec") == "latest", F.col("_latest"))
        .otherwise(F.col("spec").try_cast("bigint"))
    )
    return bounds.withColumn("spec", spec).select(*by, "spec", position.alias("position"))


def plan_ranges(log: DataFrame, start: int, size: int, position: str = "offset") -> DataFrame:
    """All chunks from ``start`` to the end of the log with the rows each one holds.

    One aggregation over the position column; empty chunks between two offsets do not appear.
    """
    bounds = log.agg(F.max(position) + 1)
    batch = F.floor((F.col(position) - start) / size)
    chunks = log.filter(F.col(position) >= start).groupBy(batch.alias("batch")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    begin = F.lit(start) + F.col("batch") * size
    return chunks.select(
        F.col("batch").cast("bigint").alias("batch"),
        begin.cast("bigint").alias("range_start"),
        F.least(begin + size, bounds.scalar()).cast("bigint").alias("range_end"),
        "rows",
    )


def read_kafka_range(
    spark: SparkSession, servers: str, topic: str, start: int, end: int, min_partitions: int = 1
) -> DataFrame:
    """Same as :func:`read_range` over partition 0 of a topic."""
    frame = (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", f'{{"{topic}":{{"0":{start}}}}}')
        .option("endingOffsets", f'{{"{topic}":{{"0":{end}}}}}')
        .option("minPartitions", min_partitions)
        .load()
    )
    return as_records(frame.select("offset", F.col("value").cast("string").alias("value")))


def stream_kafka(
    spark: SparkSession, servers: str, topic: str, start: str = "earliest", per_trigger: int = 100_000
) -> DataFrame:
    offsets = start if start in ("earliest", "latest") else f'{{"{topic}":{{"0":{int(start)}}}}}'
    frame = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", offsets)
        .option("maxOffsetsPerTrigger", per_trigger)
        .load()
    )
    return as_records(frame.select(F.col("value").cast("string").alias("value")))
