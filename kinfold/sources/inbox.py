"""The parquet inbox: batch writer and file-stream reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kinfold.schemas import INPUT
from kinfold.sources.records import read_records


def write_inbox(records: DataFrame, inbox: str, mode: str = "overwrite") -> None:
    records.select(*INPUT.names).write.mode(mode).parquet(inbox)


def jsonl_to_inbox(spark: SparkSession, path: str, inbox: str) -> None:
    write_inbox(read_records(spark, path), inbox)


def write_sharded_inbox(records: DataFrame, inbox: str, shards: int) -> None:
    """One sub-folder per shard, split by a hash of the record key, so that several streams can each
    read only their own files."""
    shard = F.pmod(F.xxhash64("dataSource", "recordId"), F.lit(shards)).cast("int")
    records.select(*INPUT.names, shard.alias("shard")).write.mode("overwrite").partitionBy(
        "shard"
    ).parquet(inbox)


def files_per_trigger(records_per_batch: int, records_per_shard: int) -> int:
    return max(1, -(-records_per_batch // records_per_shard))


def stream_inbox(
    spark: SparkSession, inbox: str, max_files: int = 100, archive: str | None = None
) -> DataFrame:
    """The inbox as a stream. With ``archive`` a file moves there once its batch is committed."""
    reader = spark.readStream.schema(INPUT).option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.parquet(inbox)
