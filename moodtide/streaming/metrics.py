"""Metrics of every micro-batch in a table.

Streams count as rows pass (``operators.alerts.observe``) and report the counts with each batch's progress. This listener
keeps them: a small file per query, batch and metric name, published by a rename that never replaces one. A
query keeps its id over restarts, so a batch that is reported again is there already and counts once.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from moodtide.sources import files


class MetricsLog(StreamingQueryListener):
    """Add it with ``spark.streams.addListener``; it logs every query of the session from then on."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end_of(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        for name, row in progress.observedMetrics.items():
            for metric, value in row.asDict().items():
                line = {
                    "query_id": str(progress.id), "query_name": progress.name, "batch_id": progress.batchId, "name": name,
                    "metric": metric, "value": None if value is None else float(value),
                }
                file = f"{self.path}/{progress.id}-{progress.batchId:020d}-{name}-{metric}.json"
                if not files.exists(self.spark, file):
                    files.publish_text(self.spark, file, json.dumps(line))

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._end_of(str(event.runId)).set()

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Until all that the ended query reported is logged; whether that came in time."""
        return self._end_of(str(query.runId)).wait(seconds)


METRICS = "query_id STRING, query_name STRING, batch_id BIGINT, name STRING, metric STRING, value DOUBLE"


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """``query_id, query_name, batch_id, name, metric, value``: what the listener has logged."""
    if not any(name.endswith(".json") for name in files.names(spark, path)):
        return spark.createDataFrame([], METRICS)
    return spark.read.schema(METRICS).json(path)
