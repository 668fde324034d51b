"""How the pipeline's tables map onto the driver's TPC-H-like tables.

=================  =====================================================
pipeline           driver table
=================  =====================================================
fact (users_raw)   customer: id ``c_custkey``, username ``c_name``,
                   FK ``c_nationkey``, flat code ``c_mktsegment``
dimension          nation: label ``n_name`` (25 rows)
outbox             orders: unsent = ``o_orderstatus = 'O'``
message stream     events: id ``event_id``, key ``user_id``, stamp ``ts``
delivery log       events: failed attempts ``floor(value/20)`` held to
                   0..3 (3 = gave up), invalid = ``event_type='signup'``
=================  =====================================================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from keyflow.functions.scalars import epoch_ms
from keyflow.operators.messages import to_message
from keyflow.session import default_parallelism

# the fixed processing clock of the oracle-checked queries (2024-02-01T00:00:00Z)
BATCH_START_MS = 1706745600000
BUS_PARTITIONS = 6
RECORD_FIELDS = ["id", "username", "event_type", "value", "props", "event_ts_ms"]


def event_records(events: DataFrame, drop_ts_when: Column | None = None) -> DataFrame:
    """events -> message records (text id and username, producer stamp in ms)."""
    stamp = epoch_ms(F.col("ts"))
    if drop_ts_when is not None:
        stamp = F.when(~drop_ts_when, stamp)
    return events.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("user_id").cast("string").alias("username"),
        F.col("event_type"),
        F.col("value"),
        F.from_json(F.col("props"), "k long").alias("props"),
        stamp.alias("event_ts_ms"),
        F.pmod(F.col("user_id"), F.lit(BUS_PARTITIONS)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )


def event_frame(events: DataFrame, drop_ts_when: Column | None = None) -> DataFrame:
    """events -> bus frame ``key, value, partition, offset``.

    The key is the user, the partition ``user_id mod 6`` and the offset the
    event sequence.
    """
    recs = event_records(events, drop_ts_when)
    return to_message(recs, "username", RECORD_FIELDS, keep=["partition", "offset"])


BUS_SCHEMA = StructType([
    StructField("key", BinaryType()), StructField("value", BinaryType()),
    StructField("offset", LongType()), StructField("partition", IntegerType()),
])


def publish_bus(events: DataFrame, path: str, drop_ts_when: Column | None = None,
                tasks: int | None = None) -> None:
    """Offline twin of publishing to the topic.

    One folder per bus partition (``partition=<n>``); inside it, segment
    files that each hold a contiguous, ordered offset range. All messages of
    a user sit in one bus partition, like a keyed topic. The write is range
    partitioned by ``(bus partition, offset)`` over ``tasks`` tasks (default:
    the cluster's cores), so encoding and writing scale with the cluster,
    not with the six bus partitions.
    """
    spark = events.sparkSession
    tasks = tasks or max(BUS_PARTITIONS, default_parallelism(spark))
    bus_part = F.pmod(F.col("user_id"), F.lit(BUS_PARTITIONS))
    ranged = events.repartitionByRange(tasks, bus_part, F.col("event_id"))
    frame = event_frame(ranged, drop_ts_when)
    (frame.sortWithinPartitions("partition", "offset")
          .write.partitionBy("partition").parquet(path))


def truncate_payloads(frame: DataFrame, when: Column) -> DataFrame:
    """Cut the payloads where ``when`` holds in half: malformed messages on the wire."""
    text = F.col("value").cast("string")
    cut = F.substring(text, 1, (F.length(text) / 2).cast("int")).cast("binary")
    return frame.withColumn("value", F.when(when, cut).otherwise(F.col("value")))


def delivery_log(events: DataFrame) -> DataFrame:
    """events -> delivery log ``id, failures, valid``."""
    failures = F.least(F.greatest(F.floor(F.col("value") / 20).cast("long"), F.lit(0)), F.lit(3))
    return events.select(F.col("event_id").cast("string").alias("id"),
                         failures.cast("int").alias("failures"),
                         (F.col("event_type") != "signup").alias("valid"))
