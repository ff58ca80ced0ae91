"""The mart as a stream over the affected feed."""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from kinfold.operators.outcomes import affected_ids
from kinfold.plans.mart import EntityMart
from kinfold.schemas import OUTCOME
from kinfold.session import materialize, temporary

PASS_ENTITIES = 250_000  # fetched and parsed at a time


def start_mart_sync(
    spark: SparkSession,
    feed: str,
    mart: EntityMart,
    fetch: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    live: Callable[[], DataFrame] | None = None,
    once: bool = True,
    interval: str = "60 seconds",
    max_files: int = 1000,
    whole_relations: bool = False,
    pass_entities: int = PASS_ENTITIES,
) -> StreamingQuery:
    """Apply each batch of newly affected ids as one sync pass. The checkpoint remembers what was
    read, so a pass does not reread the whole feed. ``fetch`` maps ids to fetch results, such as ``RelatedStore.fetch``, whose documents list
    all relations (``whole_relations``).

    A batch of more than ``pass_entities`` ids takes several passes, each with its share of the ids by their hash, so documents on their way to the mart take
    disk for about that many entities and not for the batch. Every pass leaves whole entities; a batch that breaks off is applied again from its first one."""

    def on_batch(batch: DataFrame, _: int) -> None:
        with temporary(mart.spark):
            ids = materialize(affected_ids(batch), "feed-ids")
            parts = ceil(ids.count() / pass_entities)
            for part in range(parts):
                share = ids.filter(F.pmod(F.xxhash64("entityId"), F.lit(parts)) == part)
                mart.sync(lambda: fetch(share), live() if live else None, whole_relations)

    frame = spark.readStream.schema(OUTCOME).option("maxFilesPerTrigger", max_files).parquet(feed)
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return frame.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint).trigger(**trigger).start()
