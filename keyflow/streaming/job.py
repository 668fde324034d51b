"""The streaming job: parse -> enrich -> keyed upsert, with metrics.

Per micro-batch the reference ran four actions (count, count, percentiles,
write), each re-reading the source. Here the batch is read and written once; the
metrics, and whether it was empty, ride along on that single pass through
``DataFrame.observe``.

Delivery is at-least-once from the source (offsets are committed after the
batch returns) and the sink is idempotent per epoch (``KeyedUpsertTable``
overwrites the epoch's partition), so a replayed batch leaves the table as
it was: effectively once.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from keyflow.operators.aggregates import DEFAULT_ACCURACY, SKETCH_K
from keyflow.operators.messages import enrich, parse_messages
from keyflow.operators.tables import KeyedUpsertTable, ParquetTable
from keyflow.schemas import BATCH_METRICS
from keyflow.streaming.progress import ProgressLog

log = logging.getLogger("keyflow.stream")

TRIGGER_INTERVAL = "500 milliseconds"
SINK_ATTEMPTS = 4


def write_with_retry(write: Callable[[], None], attempts: int = SINK_ATTEMPTS,
                     base_wait_s: float = 1.0,
                     sleep: Callable[[float], None] = time.sleep) -> int:
    """Run ``write``; on failure wait 1, 2, 4 ... s and try again (K6).

    Returns the attempt that succeeded. After the last attempt the error is
    raised, so the engine fails the batch and replays it on restart.
    """
    for attempt in range(1, attempts + 1):
        try:
            write()
            return attempt
        except Exception as exc:  # the sink's error type is connector specific
            if attempt >= attempts:
                log.error("sink write failed permanently after %d attempts: %s", attempts, exc)
                raise
            wait = base_wait_s * 2 ** (attempt - 1)
            log.warning("sink write failed (attempt %d/%d), retry in %.0fs: %s",
                        attempt, attempts, wait, exc)
            sleep(wait)
    raise AssertionError("unreachable")


def wall_clock_ms() -> int:
    return int(time.time() * 1000)


@dataclass
class BatchProcessor:
    """``foreachBatch`` handler: enrich, upsert with retry, record metrics."""

    sink: KeyedUpsertTable
    metrics: ParquetTable | None = None
    clock_ms: Callable[[], int] = wall_clock_ms
    accuracy: int = DEFAULT_ACCURACY
    attempts: int = SINK_ATTEMPTS
    sleep: Callable[[float], None] = time.sleep
    ts_col: str = "event_ts_ms"
    last_metrics: dict = field(default_factory=dict)

    def __call__(self, batch: DataFrame, epoch_id: int) -> None:
        started = time.monotonic()
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if query_id and hasattr(self.sink, "use_run"):
            self.sink.use_run(query_id)
        batch_start_ms = self.clock_ms()
        enriched = enrich(batch, batch_start_ms, ts_col=self.ts_col)
        obs = Observation(f"batch_{epoch_id}_{int(started * 1e6)}")
        lat = F.col("latency_ms")
        observed = enriched.observe(
            obs,
            F.count(F.lit(1)).alias("rows"),
            F.count(lat).alias("measured"),
            F.percentile_approx(lat, 0.5, self.accuracy).alias("p50"),
            F.percentile_approx(lat, 0.95, self.accuracy).alias("p95"),
            F.max(lat).alias("p_max"),
            # kept with the epoch: percentiles over any epochs merge these
            F.kll_sketch_agg_double(lat, SKETCH_K).alias("sketch"),
        )
        write_with_retry(lambda: self.sink.write_epoch(observed, epoch_id),
                         self.attempts, sleep=self.sleep)
        m = obs.get
        elapsed_ms = int((time.monotonic() - started) * 1000)
        rows = int(m["rows"])
        if not rows:
            log.info("[batch %d] empty micro-batch", epoch_id)
            return
        row = {
            "epoch_id": int(epoch_id), "rows": rows, "measured": int(m["measured"]),
            "elapsed_ms": elapsed_ms,
            "rows_per_sec": rows / (elapsed_ms / 1000) if elapsed_ms > 0 else 0.0,
            "p50": _opt_float(m["p50"]), "p95": _opt_float(m["p95"]),
            "p_max": _opt_float(m["p_max"]), "sketch": bytes(m["sketch"]),
        }
        self.last_metrics = row
        log.info("[batch %d] rows=%d measured=%d elapsed=%dms p50=%s p95=%s max=%s",
                 epoch_id, rows, row["measured"], elapsed_ms, row["p50"], row["p95"], row["p_max"])
        if self.metrics is not None:
            spark = batch.sparkSession
            frame = spark.createDataFrame([row], BATCH_METRICS)
            # one row per epoch; overwrite-by-epoch keeps a replay from double counting
            (frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                  .partitionBy("epoch_id").parquet(self.metrics.path))


def _opt_float(v) -> float | None:
    return None if v is None else float(v)


def build_stream(frame: DataFrame, schema: StructType, key_field: str = "id",
                 offset_col: str | None = None) -> DataFrame:
    """Message frame -> parsed records with a key (P1, F1); works on streams and batches.

    ``offset_col`` carries the message offset along as ``_offset`` (for a
    sink that orders versions by it).
    """
    if offset_col is None:
        return parse_messages(frame, schema, key_field)
    parsed = parse_messages(frame, schema, key_field, keep=[offset_col])
    return parsed.withColumnRenamed(offset_col, "_offset")


def start_stream(records: DataFrame, processor: BatchProcessor, checkpoint: str,
                 trigger: str | None = TRIGGER_INTERVAL, available_now: bool = False,
                 name: str | None = None, progress: ProgressLog | None = None) -> StreamingQuery:
    """Start the ``foreachBatch`` query.

    ``available_now`` processes what is there in bounded batches and stops;
    otherwise a processing-time trigger runs forever. ``progress`` listens to the
    session's queries from before the first batch.
    """
    if progress:
        records.sparkSession.streams.addListener(progress)
    writer = records.writeStream.foreachBatch(processor).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def run_available_now(spark: SparkSession, records: DataFrame, processor: BatchProcessor,
                      checkpoint: str, progress: ProgressLog | None = None) -> StreamingQuery:
    """Process what is there, however long it takes, and stop."""
    query = start_stream(records, processor, checkpoint, available_now=True, progress=progress)
    query.awaitTermination()
    if progress:
        progress.wait_for(query)
        spark.streams.removeListener(progress)
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query
