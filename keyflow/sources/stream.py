"""Streaming sources.

The production source is the message bus (``format("kafka")``); the
offline twin is a file stream with the same shape. Both apply admission
control so one trigger never takes more than a bounded slice of input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TOPIC = "users_created"
MAX_OFFSETS_PER_TRIGGER = 10_000


def kafka_source_options(bootstrap: str, topic: str = TOPIC,
                         starting_offsets: str = "earliest",
                         max_offsets_per_trigger: int = MAX_OFFSETS_PER_TRIGGER,
                         min_partitions: int | None = None,
                         **extra: str) -> dict[str, str]:
    """Source options; ``min_partitions`` splits each topic partition's
    offset range over several tasks (no shuffle), so a topic with few
    partitions still parses on many cores."""
    opts = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "maxOffsetsPerTrigger": str(max_offsets_per_trigger),
        # a lost broker or deleted segment must fail loudly, not skip data
        "failOnDataLoss": "true",
    }
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    opts.update(extra)
    return opts


def kafka_stream(spark: SparkSession, bootstrap: str, **kwargs) -> DataFrame:
    """``key, value, topic, partition, offset, timestamp`` rows from the bus."""
    return spark.readStream.format("kafka").options(
        **kafka_source_options(bootstrap, **kwargs)).load()


def file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None,
                max_bytes_per_trigger: int | None = None) -> DataFrame:
    """File twin of the bus: new files under ``path`` become micro-batches of at
    most so many files, or of about so many bytes (at least one file)."""
    if max_files_per_trigger and max_bytes_per_trigger:
        raise ValueError("a trigger is bounded by files or by bytes")
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    return reader.load(path)
