"""Progress samples of running queries, in the shape ``monitor.progress_rates`` reads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener


class ProgressLog(StreamingQueryListener):
    """Collects one small row per finished batch; ``frame`` hands them over and starts anew."""

    SCHEMA = "query string, batch_id bigint, rows bigint, at_ms bigint"

    def __init__(self):
        self._rows: list[tuple] = []

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        at = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00"))
        self._rows.append((p.name or str(p.id), p.batchId, p.numInputRows, int(at.timestamp() * 1000)))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def frame(self, spark: SparkSession) -> DataFrame:
        rows, self._rows = self._rows, []
        return spark.createDataFrame(rows, self.SCHEMA)
