"""What running queries say of their batches: rows, rates and the time of each step, as rows for the latency reports."""

from __future__ import annotations

from collections import deque
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = "query string, batch long, started string, input_rows long, rows_per_second double, total_ms long, add_batch_ms long, planning_ms long, commit_ms long, state_rows long"
#: Batches that are remembered; the oldest go first.
KEPT = 10_000


class Progress(StreamingQueryListener):
    def __init__(self, kept: int = KEPT) -> None:
        self.rows: deque[tuple] = deque(maxlen=kept)
        self.ended: dict[str, str | None] = {}
        self.lock = Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        ms = p.durationMs
        row = (p.name, p.batchId, p.timestamp, p.numInputRows, p.processedRowsPerSecond, ms.get("triggerExecution"), ms.get("addBatch"), ms.get("queryPlanning"), ms.get("walCommit"), sum(s.numRowsTotal for s in p.stateOperators))
        with self.lock:
            self.rows.append(row)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            self.ended[str(event.id)] = event.exception

    def table(self, spark: SparkSession) -> DataFrame:
        """A row for each remembered batch."""
        with self.lock:
            return spark.createDataFrame(list(self.rows), SCHEMA)
