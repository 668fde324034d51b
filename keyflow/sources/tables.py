"""Batch scans.

Reads are lazy and narrow: callers name the columns they need so the
Parquet scan's ReadSchema carries only those, and filters placed after the
read are pushed into the scan by Catalyst.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def jdbc_options(url: str, table: str, partition_column: str | None = None,
                 lower: int | None = None, upper: int | None = None,
                 num_partitions: int | None = None, fetch_size: int = 10_000,
                 **extra: str) -> dict[str, str]:
    """Options for a parallel JDBC scan of an RDBMS fact table.

    With a partition column the scan splits into ``num_partitions`` range
    queries, one per task; without one it is a single task, which is only
    acceptable for small dimension tables.
    """
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if partition_column is not None:
        if None in (lower, upper, num_partitions):
            raise ValueError("partitioned JDBC scan needs lower, upper and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower),
                    upperBound=str(upper), numPartitions=str(num_partitions))
    opts.update(extra)
    return opts


def read_jdbc(spark: SparkSession, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()


def jdbc_write_options(url: str, table: str, batch_size: int = 500,
                       **extra: str) -> dict[str, str]:
    """Bulk write in pages (the reference pages inserts by 500)."""
    opts = {"url": url, "dbtable": table, "batchsize": str(batch_size)}
    opts.update(extra)
    return opts


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               batch_size: int = 500, **extra: str) -> None:
    """Bulk insert into an RDBMS table, ``batch_size`` rows per round trip,
    one connection per task (the tasks' partitions are the write's
    parallelism)."""
    df.write.format("jdbc").options(**jdbc_write_options(url, table, batch_size, **extra)) \
        .mode(mode).save()
