"""Message frames, stable row numbers, shard selection and the message-log sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# Producer settings of the message sink (fixed values).
KAFKA_SINK = {
    "kafka.acks": "all",
    "kafka.compression.type": "zstd",
    "kafka.max.request.size": str(512 * 1024 * 1024),
    "kafka.buffer.memory": str(512 * 1024 * 1024),
}


def message_frame(spark: SparkSession, path: str) -> DataFrame:
    """Every non-empty line as a message. Lines are not trimmed: one of only spaces is a message."""
    lines = spark.read.text(path)
    return lines.filter(F.length("value") > 0).select(F.col("value").cast("string").alias("value"))


def with_row_index(frame: DataFrame, name: str = "gidx") -> DataFrame:
    """A stable 0-based row number in file order, without sorting the rows.

    The input must come straight from files. Each input block counts its own rows; the running total
    over blocks (one row per block of input) gives the base of each block.
    """
    tagged = frame.withColumns({
        "_file": F.col("_metadata.file_path"),
        "_block": F.col("_metadata.file_block_start"),
        "_mid": F.monotonically_increasing_id(),
    })
    blocks = tagged.groupBy("_file", "_block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first")
    )
    order = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    based = blocks.withColumn("_base", F.coalesce(F.sum("_n").over(order), F.lit(0)))
    index = F.col("_base") + F.col("_mid") - F.col("_first")
    return (
        tagged.join(based, ["_file", "_block"])
        .withColumn(name, index.cast("bigint"))
        .drop("_file", "_block", "_mid", "_n", "_first", "_base")
    )


def shard_of(index: Column, shards: int) -> Column:
    return F.pmod(index, F.lit(shards)).cast("int")


def select_shard(frame: DataFrame, index: str, skip: int, shards: int, shard: int) -> DataFrame:
    """Rows one producer has to send: past the resume point and of its own shard."""
    column = F.col(index)
    return frame.filter((column >= skip) & (shard_of(column, shards) == shard))


def write_message_log(messages: DataFrame, path: str) -> None:
    """Batch sink of (offset, value) rows where no message connector is installed."""
    messages.select(F.col("offset").cast("bigint"), "value").write.mode("overwrite").parquet(path)


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Batch sink to a topic; needs the Kafka connector."""
    (
        messages.select("value").write.format("kafka").options(**KAFKA_SINK)
        .option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    )
