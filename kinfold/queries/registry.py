"""Registration of queries and the tables they read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kinfold.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Lazy access to the input tables: ``t.orders`` reads `<dir>/orders.parquet`, its footer once."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        frame = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        # The files hold zone-less timestamps; the session zone is UTC.
        local = [c for c, kind in frame.dtypes if kind == "timestamp_ntz"]
        frame = frame.withColumns({c: frame[c].cast("timestamp") for c in local}) if local else frame
        setattr(self, name, frame)
        return frame


def query(name: str, oracle: str | None = None):
    def register(plan: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plan(Tables(configure(spark), folder))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return plan

    return register
