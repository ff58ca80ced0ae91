"""Change feeds: the difference of two snapshots, and a thin Delta reader."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from kinfold.sources.records import as_records

FEED_TYPES = ["insert", "update_postimage"]


def snapshot_diff(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Row changes from ``before`` to ``after``: one full outer join on the key, all columns compared
    null-safe. An update gives its old row as preimage and its new row as postimage."""
    values = [c for c in after.columns if c not in keys]
    joined = before.select(*keys, F.struct(*values).alias("_old")).join(
        after.select(*keys, F.struct(*values).alias("_new")), keys, "full"
    )
    same = [F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in values]
    equal = reduce(lambda a, b: a & b, same, F.lit(True))
    image = lambda kind, row: F.struct(F.lit(kind).alias("t"), F.col(row).alias("r"))
    images = (
        F.when(F.col("_old").isNull(), F.array(image("insert", "_new")))
        .when(F.col("_new").isNull(), F.array(image("delete", "_old")))
        .when(~equal, F.array(image("update_preimage", "_old"), image("update_postimage", "_new")))
    )
    rows = joined.select(*keys, F.explode(images).alias("_c"))
    return rows.select(
        *keys, *[F.col(f"_c.r.{c}").alias(c) for c in values], F.col("_c.t").alias("_change_type")
    )


def changed_records(changes: DataFrame, body: str = "value") -> DataFrame:
    """The records a feed has to process again: inserted rows and the new side of updates."""
    return as_records(changes.filter(F.col("_change_type").isin(FEED_TYPES)), body)


def read_delta_changes(spark: SparkSession, table: str, start: int, end: int, body: str) -> DataFrame:
    """Versions ``[start, end)`` of a Delta change feed; needs the Delta package."""
    feed = (
        spark.read.format("delta")
        .option("readChangeFeed", "true")
        .option("startingVersion", start)
        .option("endingVersion", end - 1)
        .table(table)
    )
    return changed_records(feed, body)
