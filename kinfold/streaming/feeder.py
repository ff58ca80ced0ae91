"""Structured Streaming feeders over the inbox.

A batch is written to a folder named by its batch id, as a whole. When Spark repeats a batch after a
failure, the repeat replaces the folder, so each batch shows exactly once in the sinks.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from kinfold.operators.outcomes import affected_feed_dedup, affected_rows, error_rows, good_rows, split_calls, stamp_failure
from kinfold.schemas import CALL_COLUMNS, OUTCOME
from kinfold.session import stored
from kinfold.sources.inbox import stream_inbox

Process = Callable[[DataFrame, int], DataFrame]


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """An unset path turns the sink off."""
    if path:
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def start_feeder(
    spark: SparkSession,
    inbox: str,
    process: Process,
    checkpoint: str,
    output: str = "",
    dead_letter: str = "",
    calls: str = "",
    source: str = "stream",
    max_files: int = 100,
    archive: str | None = None,
    once: bool = True,
    interval: str = "10 seconds",
    pool: str | None = None,
) -> StreamingQuery:
    """Feed the inbox through ``process`` (input rows and batch id to outcome rows).

    ``once`` drains what is there and ends; otherwise the query keeps running. The outcome frame is
    computed and stored once per batch and feeds all sinks. The batch is committed after they are written. ``calls`` gets the ledger, if the outcome
    rows come with one.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        with stored(process(batch, batch_id), "outcomes") as outcomes:
            write_batch(good_rows(outcomes), output, batch_id)
            write_batch(stamp_failure(error_rows(outcomes), source), dead_letter, batch_id)
            if set(CALL_COLUMNS) <= set(outcomes.columns):
                write_batch(split_calls(outcomes)[1], calls, batch_id)

    if pool:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
    frame = stream_inbox(spark, inbox, max_files, archive)
    writer = frame.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint).queryName(source)
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    try:
        return writer.trigger(**trigger).start()
    finally:
        if pool:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)


def affected_feed(spark: SparkSession, output: str, within: str = "1 day", max_files: int = 100) -> DataFrame:
    """The affected rows below a feeder's ``output`` as a stream, each key once.

    A batch that is repeated replaces its folder by new files, whose rows then come a second time; the dedup drops them. Times are those of the files.
    """
    shape = T.StructType([*OUTCOME.fields, T.StructField("batch_id", T.LongType())])
    rows = spark.readStream.schema(shape).option("maxFilesPerTrigger", max_files).parquet(output)
    timed = rows.filter("kind = 'AFFECTED'").select("*", F.col("_metadata.file_modification_time").alias("at"))
    return affected_rows(affected_feed_dedup(timed, "at", within))


def run_sharded(
    spark: SparkSession, inbox: str, shards: int, process: Process, checkpoint: str, output: str,
    dead_letter: str, label: str, **options,
) -> list[StreamingQuery]:
    """One query per inbox shard, each with its own checkpoint and FAIR pool: a slow batch holds back
    its own shard only. Pools need ``spark.scheduler.mode=FAIR``, which is fixed when a session starts; without it
    the shards give the same rows but wait for each other, and a warning says so."""
    if spark.sparkContext.getConf().get("spark.scheduler.mode", "FIFO").upper() != "FAIR":
        warnings.warn("spark.scheduler.mode is not FAIR: shards share one queue of jobs", stacklevel=2)
    return [
        start_feeder(
            spark, f"{inbox}/shard={i}", process, f"{checkpoint}/shard={i}", f"{output}/shard={i}",
            f"{dead_letter}/shard={i}", source=f"{label}-{i}", pool=f"{label}-{i}", **options,
        )
        for i in range(shards)
    ]


def drain(queries: list[StreamingQuery]) -> None:
    for query in queries:
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
