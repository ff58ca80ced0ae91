"""Record and search-request sources (JSON lines)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kinfold.session import configure

_KEYS = "struct<DATA_SOURCE: string, RECORD_ID: string>"

# A line or key counts as blank when it holds nothing above U+0020.
VISIBLE = r"[^\x00-\x20]"


def has_text(value: Column) -> Column:
    return F.coalesce(value.rlike(VISIBLE), F.lit(False))


def as_records(bodies: DataFrame, body: str = "value", *carry: str) -> DataFrame:
    """Project both keys out of a JSON body; the body itself stays opaque.

    A malformed body, an absent key and a JSON null all give an empty key, which the required-key
    gate then routes to the dead letter.
    """
    keys = F.from_json(F.col(body), _KEYS)
    return bodies.select(
        *carry,
        F.coalesce(keys["DATA_SOURCE"], F.lit("")).alias("dataSource"),
        F.coalesce(keys["RECORD_ID"], F.lit("")).alias("recordId"),
        F.col(body).alias("payload"),
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    lines = configure(spark).read.text(path)
    return as_records(lines.filter(has_text(F.col("value"))))


def read_search_requests(spark: SparkSession, path: str) -> DataFrame:
    lines = configure(spark).read.text(path)
    return lines.filter(has_text(F.col("value"))).select(
        F.lit("").alias("dataSource"), F.lit("").alias("recordId"), F.col("value").alias("payload")
    )
