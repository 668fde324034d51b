"""Key lookups and whole-table answers from what Parquet stores beside the rows.

* ``write_indexed`` sorts a table by its key and gives its row groups Bloom filters:
  a lookup reads the row groups whose range and filter admit the key (F8).
* ``footer_reader`` reads counts, minima and maxima from footers alone (A1, A10).
* ``statistics_session``: plans by the statistics that ``tables.analyze`` collects (K11).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

#: bytes of a row group of an indexed table: what one lookup reads at most per file
ROW_GROUP_BYTES = 16 << 20


def write_indexed(df: DataFrame, path: str, key: str, files: int | None = None,
                  distinct: int | None = None, row_group: int = ROW_GROUP_BYTES,
                  mode: str = "error") -> None:
    """Write ``df`` range partitioned and sorted by ``key``, with Bloom filters on it.

    Ranges alone find the file and row group of a key in a table written at once;
    the filters spare the other files after many such writes (``append``), whose
    ranges overlap. ``distinct``: expected keys of a row group, sizes the filter.
    """
    ranged = df.repartitionByRange(files, key) if files else df.repartitionByRange(key)
    w = (ranged.sortWithinPartitions(key).write.mode(mode)
         .option(f"parquet.bloom.filter.enabled#{key}", "true")
         .option("parquet.block.size", str(row_group)))
    if distinct:
        w = w.option(f"parquet.bloom.filter.expected.ndv#{key}", str(distinct))
    w.parquet(path)


def lookup(spark: SparkSession, path: str, key: str, keys: Sequence, columns: Sequence[str]
           ) -> DataFrame:
    """The rows of some keys; the comparison reaches the row groups' statistics and
    filters (``spark.sql.parquet.pushdown.inFilterThreshold`` keys at a time)."""
    from pyspark.sql import functions as F

    table = spark.read.parquet(path).select(*dict.fromkeys([key, *columns]))
    condition = F.col(key) == keys[0] if len(keys) == 1 else F.col(key).isin(list(keys))
    return table.filter(condition).select(*columns)


def footer_reader(spark: SparkSession) -> SparkSession:
    """A session of the same application whose Parquet scans take counts, minima
    and maxima from the footers where no filter on rows is asked for (grouping by
    folder columns included)."""
    own = spark.newSession()
    sources = [s for s in spark.conf.get("spark.sql.sources.useV1SourceList").split(",")
               if s.strip() != "parquet"]
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(sources))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def statistics_session(spark: SparkSession) -> SparkSession:
    """A session that collects histograms and plans by cost: filters and joins
    are estimated from column statistics, and joins reordered by them."""
    own = spark.newSession()
    for name in ("cbo.enabled", "cbo.planStats.enabled", "cbo.joinReorder.enabled",
                 "statistics.histogram.enabled"):
        own.conf.set(f"spark.sql.{name}", "true")
    return own
