"""Incremental rollup: counts per key, kept up by the counts of each batch."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.operators.aggregates import order_by_count
from keyflow.operators.tables import key_join
from keyflow.session import child_folders, delete_path

Fresh = tuple[str | None, list[str]]


class IncrementalRollup:
    """Row counts per key of an insert-only table, without reading that table again.

    ``delta/<batch>`` holds one batch's counts (a few rows), written with the
    batch: a replayed batch replaces its own folder. ``fold`` sums the newest
    snapshot and the batches it does not cover into a new snapshot, and notes which
    batches it covers; a batch that comes late or again is counted once. Readers
    take the newest complete snapshot and the batches beyond it, so they are never
    behind. Counts are kept by key, not by label: a dimension may change its
    labels.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, keep: int = 3):
        self.spark, self.path, self.key, self.keep = spark, path, key, keep

    def add(self, batch: str, rows: DataFrame) -> None:
        """The counts of one ingest batch."""
        self._sum(rows.select(self.key, F.lit(1).cast("long").alias("cnt"))) \
            .write.mode("overwrite").parquet(f"{self.path}/delta/{batch}")

    def _sum(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(self.key).agg(F.sum("cnt").alias("cnt"))

    def _fresh(self) -> Fresh:
        """The newest complete snapshot, and the batches beyond it."""
        bases = child_folders(self.spark, f"{self.path}/base", complete=True)
        batches = child_folders(self.spark, f"{self.path}/delta", complete=True)
        if not bases:
            return None, batches
        covered = self.spark.read.schema("batch string").parquet(f"{self.path}/covers/{bases[-1]}")
        known = {r["batch"] for r in covered.collect()}  # a name per ingest batch
        return bases[-1], [b for b in batches if b not in known]

    def _parts(self, fresh: Fresh) -> DataFrame | None:
        base, batches = fresh
        paths = [f"{self.path}/base/{base}"] if base else []
        paths += [f"{self.path}/delta/{b}" for b in batches]
        return self._sum(self.spark.read.parquet(*paths)) if paths else None

    def counts(self) -> DataFrame:
        """``key, cnt`` of every batch so far."""
        out = self._parts(self._fresh())
        if out is None:
            raise ValueError(f"no batch was counted at {self.path}")
        return out

    def fold(self) -> None:
        """A new snapshot from the last one and the batches since; no new batch,
        no new snapshot. The last ``keep`` snapshots stay for their readers."""
        base, batches = fresh = self._fresh()
        if not batches:
            return
        name = f"{int(time.time() * 1000):013d}-{uuid.uuid4().hex[:8]}"
        covers = self.spark.createDataFrame([(b,) for b in batches], "batch string")
        if base:
            covers = covers.unionByName(
                self.spark.read.schema("batch string").parquet(f"{self.path}/covers/{base}"))
        covers.coalesce(1).write.parquet(f"{self.path}/covers/{name}")
        self._parts(fresh).write.parquet(f"{self.path}/base/{name}")  # complete with this
        for old in child_folders(self.spark, f"{self.path}/base", complete=True)[:-self.keep]:
            delete_path(self.spark, f"{self.path}/base/{old}")
            delete_path(self.spark, f"{self.path}/covers/{old}")

    def read(self, dim: DataFrame, dim_pk: str, label_col: str, label: str = "label",
             alias: str = "cnt") -> DataFrame:
        """``label, cnt`` ordered by count; keys without a dimension row drop out."""
        joined = key_join(self.counts(), dim.select(dim_pk, label_col), self.key, dim_pk, "inner")
        counts = joined.groupBy(F.col(label_col).alias(label)).agg(
            F.sum("cnt").cast("long").alias(alias))
        return order_by_count(counts, label, alias)
