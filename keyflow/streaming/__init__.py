"""Structured Streaming job: foreachBatch upsert with retry and metrics."""

from keyflow.streaming.job import (
    BatchProcessor,
    build_stream,
    run_available_now,
    start_stream,
    write_with_retry,
)

__all__ = ["BatchProcessor", "build_stream", "run_available_now", "start_stream",
           "write_with_retry"]
