"""What a crash leaves behind, for the replay queries and tests."""

from __future__ import annotations

from pyspark.sql import SparkSession


def forget_last_commit(spark: SparkSession, checkpoint: str) -> None:
    """Remove the newest commit of a stopped query's checkpoint, as a crash just
    before it would leave things: a restart replays that batch from the source."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    last = max((n for n in names if n.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        fs.delete(jvm.org.apache.hadoop.fs.Path(folder, name), False)
