"""Progress of streaming queries as a table, without a job of its own.

The engine reports every trigger to a listener: rows, rates and the time of each
step. The listener appends the report as one line of JSON in a file of its own
below ``path``, named by query and batch, so that a replayed batch replaces its
report. Nothing runs on the executors for it.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS_SCHEMA = ("query_id string, batch_id long, at string, rows long, rows_per_sec double, "
                   "arriving_per_sec double, trigger_ms long, write_ms long, plan_ms long, "
                   "offsets_ms long")
#: steps of a trigger, by the engine's names
STEPS = {"trigger_ms": "triggerExecution", "write_ms": "addBatch", "plan_ms": "queryPlanning",
         "offsets_ms": "latestOffset"}


class ProgressLog(StreamingQueryListener):
    """Writes every trigger's progress below ``path``; ``read`` gives the table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.seen: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = {"query_id": str(p.id), "batch_id": p.batchId, "at": p.timestamp,
               "rows": p.numInputRows, "rows_per_sec": _number(p.processedRowsPerSecond),
               "arriving_per_sec": _number(p.inputRowsPerSecond)}
        row |= {name: p.durationMs.get(step) for name, step in STEPS.items()}
        if p.numInputRows:  # an idle trigger reports the next batch without rows
            self._write(f"{row['query_id']}-{p.batchId:09d}.json", json.dumps(row) + "\n")
        self.seen[row["query_id"]] = p.batchId

    def _write(self, name: str, text: str) -> None:
        jvm = self.spark._jvm
        file = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        out = file.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(file, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def wait_for(self, query: StreamingQuery, seconds: float = 30.0) -> None:
        """Reports come from a thread of their own: wait for a stopped query's last one."""
        last, until = query.lastProgress, time.monotonic() + seconds
        if last is None:
            return
        wanted = last["batchId"]
        while self.seen.get(str(query.id), -1) < wanted and time.monotonic() < until:
            time.sleep(0.05)

    def read(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS_SCHEMA).json(self.path)


def _number(v: float | None) -> float | None:
    """Rates are not numbers while no time has passed."""
    return v if v is not None and v == v and abs(v) != float("inf") else None
