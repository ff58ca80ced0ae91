"""Record gates. A gate adds a nullable (`category`, `message`) verdict; null means the record passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kinfold.operators.skew import bounded_broadcast, hot_keys, salted_join
from kinfold.sources.records import has_text

KEYED_OPS = {"ADD", "DELETE"}  # search and redo address no single record


def _verdict(checked: DataFrame, failed: Column, category: str, message: Column) -> DataFrame:
    """Set a verdict where none stands yet."""
    columns = checked.columns
    earlier = F.col("category") if "category" in columns else F.lit(None).cast("string")
    earlier_text = F.col("message") if "message" in columns else F.lit(None).cast("string")
    fresh = earlier.isNull() & failed
    return checked.withColumns({
        "category": F.when(fresh, F.lit(category)).otherwise(earlier),
        "message": F.when(fresh, message).otherwise(earlier_text),
    })


def gate_required_keys(records: DataFrame, op: str = "ADD") -> DataFrame:
    """BAD_INPUT for a keyed operation on a record without data source or record id."""
    missing = F.when(~has_text(F.col("dataSource")), "DATA_SOURCE").when(
        ~has_text(F.col("recordId")), "RECORD_ID"
    )
    failed = missing.isNotNull() & F.lit(op in KEYED_OPS)
    return _verdict(records, failed, "BAD_INPUT", F.concat(F.lit("record missing required "), missing))


def gate_registered_source(records: DataFrame, registry: DataFrame) -> DataFrame:
    """CONFIG_RELEVANT for a source the registry (`data_source`) does not list.

    A registry of checked size is broadcast. A larger one goes through a join that salts the sources
    holding a large share of the records.
    """
    known = registry.select(F.col("data_source").alias("dataSource")).distinct().withColumn("_known", F.lit(True))
    small = bounded_broadcast(known)
    if small is not None:
        joined = records.join(small, "dataSource", "left")
    else:
        per_source = records.groupBy("dataSource").agg(F.count(F.lit(1)).alias("n"))
        joined = salted_join(records, known, ["dataSource"], hot_keys(per_source, ["dataSource"]), "left")
    checked = _verdict(
        joined, F.col("_known").isNull(), "CONFIG_RELEVANT",
        F.concat(F.lit("unknown data source "), F.col("dataSource")),
    )
    return checked.drop("_known").select(*records.columns, *[c for c in ("category", "message") if c not in records.columns])


def passed(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("category").isNull()).drop("category", "message")


def rejected(checked: DataFrame) -> DataFrame:
    """Failed records as error rows; no attempt was made on them."""
    return checked.filter(F.col("category").isNotNull()).select(
        "dataSource", "recordId", "payload", "category", F.lit("").alias("errorCode"), "message",
        F.lit(0).alias("attempts"),
    )
