"""Joins that hold when one key carries a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

HOT_KEYS = 256  # at most this many keys are salted; any other key has under 1/256 of the rows
SALTS = 256
HOT_FLOOR = 100_000  # a key with fewer rows is never worth salting


def hot_keys(weighted: DataFrame, on: list[str], rows: str = "n", floor: int = HOT_FLOOR) -> list[tuple]:
    """The keys with the most rows, from a frame with one (key, row count) row per key.

    One small job. At most HOT_KEYS keys of at least ``floor`` rows come back to the driver, so the list
    is bounded whatever the size of the data.
    """
    top = weighted.filter(F.col(rows) >= floor).orderBy(F.col(rows).desc()).limit(HOT_KEYS)
    return [tuple(row) for row in top.select(*on).collect()]


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    hot: list[tuple],
    how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Join with the rows of hot left keys spread over ``salts`` tasks; a plain join if none is hot.

    Only the right rows of hot keys are repeated. The salt is a hash of the left row, so a task that
    runs again places its rows where the first run did.
    """
    if not hot:
        return left.join(right, on, how)
    key = T.StructType([T.StructField(c, left.schema[c].dataType) for c in on])
    listed = left.sparkSession.createDataFrame(hot, key).withColumn("_hot", F.lit(True))
    flags = F.broadcast(listed)  # at most HOT_KEYS rows
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*left.columns), F.lit(salts))).otherwise(F.lit(0))
    spread = left.join(flags, on, "left").withColumn("_salt", salt.cast("int")).drop("_hot")
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeated = right.join(flags, on, "left").withColumn("_salt", F.explode(every)).drop("_hot")
    return spread.join(repeated, [*on, "_salt"], how).drop("_salt")


def bounded_broadcast(frame: DataFrame, max_rows: int = 100_000) -> DataFrame | None:
    """``frame`` marked for broadcast when it really is small, else None so that the caller can take
    a shuffle join."""
    return F.broadcast(frame) if frame.limit(max_rows + 1).count() <= max_rows else None
