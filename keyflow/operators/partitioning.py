"""Union, key partitioning and the per-key order check.

The order check compares each message with the previous one of the same
key. A plain ``lag`` window over ``partitionBy(key)`` would put a key that
holds a third of all rows into one task. Instead rows are windowed within
``(key, chunk)`` where ``chunk = seq div chunk_size``; only the first row of
each chunk needs the previous chunk's last row, and that comes from a small
per-chunk summary (one row per key and chunk), so no task ever holds more
than one chunk of a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_CHUNK = 1 << 16


def union_sources(*frames: DataFrame) -> DataFrame:
    """Bag union of record sources with the same columns."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def key_partition(df: DataFrame, key: str, num_partitions: int, *order: str) -> DataFrame:
    """All rows of a key in one partition, in order within it."""
    out = df.repartition(num_partitions, F.col(key))
    return out.sortWithinPartitions(key, *order) if order else out


def spread(df: DataFrame, num_partitions: int) -> DataFrame:
    """Even split over ``num_partitions`` tasks for parallel sending."""
    return df.repartition(num_partitions)


def order_violations(df: DataFrame, key: str, seq: str, ts: str,
                     chunk_size: int = DEFAULT_CHUNK) -> DataFrame:
    """Per key: ``n`` rows and ``out_of_order`` = rows whose ``ts`` is earlier
    than the ``ts`` of the previous row by ``seq`` (U2 check)."""
    chunk = F.floor(F.col(seq) / F.lit(chunk_size)).alias("__chunk")
    rows = df.select(F.col(key), F.col(seq), F.col(ts), chunk)
    w = Window.partitionBy(key, "__chunk").orderBy(seq)
    rows = rows.withColumn("__prev", F.lag(ts).over(w))
    per_chunk = rows.groupBy(key, "__chunk").agg(
        F.count(F.lit(1)).alias("__n"),
        F.count_if(F.col("__prev") > F.col(ts)).alias("__inner"),
        F.min_by(F.col(ts), F.col(seq)).alias("__first"),
        F.max_by(F.col(ts), F.col(seq)).alias("__last"),
    )
    wc = Window.partitionBy(key).orderBy("__chunk")
    per_chunk = per_chunk.withColumn("__prev_last", F.lag("__last").over(wc))
    return per_chunk.groupBy(key).agg(
        F.sum("__n").alias("n"),
        (F.sum("__inner") + F.count_if(F.col("__prev_last") > F.col("__first"))).alias("out_of_order"),
    )
