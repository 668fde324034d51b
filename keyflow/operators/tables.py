"""Table maintenance on plain Parquet.

* insert-if-absent: dedupe the batch to one row per key (first by arrival),
  anti join against the target's keys, append.
* flat refresh: derive the flat layout from fact + dimension and append only
  ids it does not hold yet; old flat rows are never updated.
* keyed upsert: each micro-batch is written into its own run and epoch
  partition with dynamic partition overwrite, so replaying an epoch replaces
  exactly that epoch's files. Readers take the last version per key
  (``max_by``), a partial+final aggregate that tolerates hot keys. Each epoch
  writes O(batch), never O(table).
* rollup: a snapshot table; readers see it unchanged until ``refresh``.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from keyflow.operators.aggregates import order_by_count
from keyflow.operators.joins import anti_join, dim_join
from keyflow.operators.keyfilter import key_filter, may_hold
from keyflow.session import child_folders, delete_path, path_exists


class ParquetTable:
    """A Parquet folder on shared storage, read and written by Spark only.

    The schema of what this object wrote is remembered, so later reads skip
    Parquet schema inference (a footer-reading job per read).
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType | None = None):
        self.spark = spark
        self.path = path
        self.schema = schema

    def _reader(self):
        reader = self.spark.read
        return reader.schema(self.schema) if self.schema is not None else reader

    def exists(self) -> bool:
        return path_exists(self.spark, self.path)

    def read(self) -> DataFrame:
        df = self._reader().parquet(self.path)
        if self.schema is None:
            self.schema = df.schema
        return df

    def read_if_exists(self) -> DataFrame | None:
        """The table, or None before its first write. A table that is there but
        cannot be read raises."""
        return self.read() if self.exists() else None

    def _remember(self, df: DataFrame, partition_cols: Sequence[str] = ()) -> None:
        if self.schema is None:
            fields = [f for f in df.schema.fields if f.name not in partition_cols]
            fields += [df.schema[c] for c in partition_cols]
            self.schema = StructType(fields)

    def append(self, df: DataFrame, partition_cols: Sequence[str] = ()) -> None:
        w = df.write.mode("append")
        (w.partitionBy(*partition_cols) if partition_cols else w).parquet(self.path)
        self._remember(df, partition_cols)

    def overwrite(self, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(self.path)
        self.schema = None
        self._remember(df)


class BucketedTable:
    """A catalog table bucketed (and sorted) by its key, data under ``path``.

    Two tables bucketed by the same key into the same number of buckets join
    without a shuffle: the fact table and the sent ledger, or the fact and
    flat layouts, keep their partitioning across every claim, flag or
    refresh instead of re-shuffling the big side each time.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, key: str,
                 buckets: int):
        self.spark = spark
        self.name = name
        self.path = path
        self.key = key
        self.buckets = buckets

    def _write(self, df: DataFrame, mode: str) -> None:
        (df.write.mode(mode).format("parquet").option("path", self.path)
           .bucketBy(self.buckets, self.key).sortBy(self.key).saveAsTable(self.name))

    def overwrite(self, df: DataFrame) -> None:
        self._write(df, "overwrite")

    def append(self, df: DataFrame) -> None:
        self._write(df, "append")

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def read_if_exists(self) -> DataFrame | None:
        return self.read() if self.exists() else None


def first_per_key(df: DataFrame, key: str | Sequence[str], order_col: str) -> DataFrame:
    """One row per key: the one with the smallest ``order_col`` (arrival order).

    ``min_by`` is an aggregate, so a key holding a third of all rows is
    combined inside each task before the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.col(order_col)).alias("__row"))
    return picked.select(*keys, *[F.col("__row")[c].alias(c) for c in rest])


def last_per_key(df: DataFrame, key: str | Sequence[str], order_cols: Sequence[str],
                 value_cols: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the one with the largest ``(order_cols...)``.

    ``value_cols`` limits the carried row to those columns (the rest never
    enters the shuffle); by default every non-key column is kept.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = list(value_cols) if value_cols is not None else [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*order_cols)).alias("__row"))
    return picked.select(*keys, *[F.col("__row")[c].alias(c) for c in rest])


def insert_if_absent(target: DataFrame, incoming: DataFrame, key: str,
                     order_col: str | None = None, filter_blocks: int | None = None) -> DataFrame:
    """Rows of ``incoming`` to append so that existing keys stay untouched (K1, K2).

    ``INSERT ... ON CONFLICT (key) DO NOTHING``: the first row per key in the
    batch wins (by ``order_col``), a key already in the target is skipped. With
    ``filter_blocks`` a Bloom filter of the load's keys (``keyfilter``) stands
    above the target's scan: whatever the load's size, only target keys that may
    be in it go on to the join. The load is then read several times: store it.
    """
    batch = first_per_key(incoming, key, order_col) if order_col else incoming.dropDuplicates([key])
    if order_col and order_col not in target.columns:
        batch = batch.drop(order_col)
    # the load's keys that already exist: the target's key column is probed with
    # the load's keys, broadcast by the planner if their bytes allow; then the
    # load is reduced by what was found, which is no larger than the load
    held = target.select(key)
    if filter_blocks:
        held = may_hold(held, key, key_filter(incoming, key, filter_blocks), filter_blocks)
    existing = held.join(batch.select(key), key, "left_semi")
    return anti_join(batch, existing, key)


def key_join(fact: DataFrame, dim: DataFrame, fact_fk: str, dim_pk: str,
             how: str) -> DataFrame:
    """Fact-dimension join on FK = PK; a shared key name joins USING it."""
    on = fact_fk if fact_fk == dim_pk else F.col(fact_fk) == F.col(dim_pk)
    return dim_join(fact, dim, on, how)


def flat_rows(fact: DataFrame, dim: DataFrame, fact_fk: str, dim_pk: str,
              columns: Sequence) -> DataFrame:
    """The flat layout: fact left join dimension, dimension code inlined."""
    return key_join(fact, dim, fact_fk, dim_pk, "left").select(*columns)


def flat_refresh(flat: DataFrame, fact: DataFrame, dim: DataFrame, fact_fk: str,
                 dim_pk: str, columns: Sequence, key: str = "id") -> DataFrame:
    """New flat rows: ids of the fact not yet in the flat table (K3)."""
    return anti_join(flat_rows(fact, dim, fact_fk, dim_pk, columns), flat.select(key), key)


class KeyedUpsertTable:
    """Last-write-wins table keyed by ``key``; replay of an epoch is harmless (K5).

    ``versions/_run=<run>/_epoch=<n>`` holds what one micro-batch wrote: a run
    is one checkpoint (a new checkpoint counts its epochs from 0 again), so
    neither a replay nor a new checkpoint can replace other rows. ``base/<id>``
    holds compacted rows with their run, epoch and order; the newest complete
    base is read together with the epochs it does not cover.
    """

    EPOCH = "_epoch"
    RUN = "_run"

    def __init__(self, spark: SparkSession, path: str, key: str,
                 order_cols: Sequence[str], global_order: bool = False, run: str = "0"):
        """``order_cols`` order versions inside one epoch (later wins). With
        ``global_order`` they order versions across epochs and runs too, before
        the epoch: use it when they carry the source's own order (a message
        offset), so that last-write-wins holds even if input segments reach
        the stream out of order. Else later runs (by name) and epochs win."""
        if not order_cols:
            raise ValueError("the versions of a key need an order")
        self.spark = spark
        self.path = path
        self.key = key
        self.order_cols = list(order_cols)
        self.global_order = global_order
        self.run = run

    def use_run(self, query_id: str) -> None:
        """Write into the run of a streaming query; its id lives as long as its
        checkpoint, and its name starts with the time of its first write."""
        names = [n.removeprefix(f"{self.RUN}=") for n in
                 child_folders(self.spark, f"{self.path}/versions")]
        mine = [n for n in names if n.endswith(query_id)]
        self.run = mine[0] if mine else f"{int(time.time() * 1000):013d}-{query_id}"

    def write_epoch(self, batch: DataFrame, epoch: int) -> None:
        """Write one micro-batch as its epoch's partition (replaces a replay)."""
        self._write(batch.withColumn(self.EPOCH, F.lit(int(epoch)).cast("long")))

    def write_epochs(self, rows: DataFrame) -> None:
        """Write rows carrying an ``_epoch`` column; each epoch's partition is
        replaced as a whole, so a backfill of many epochs is one job. Rows are
        dealt by epoch (large ones over several tasks), so that an epoch gets
        few files."""
        self._write(rows.withColumn(self.EPOCH, F.col(self.EPOCH).cast("long"))
                    .hint("rebalance", self.EPOCH))

    def _write(self, rows: DataFrame) -> None:
        if not self.global_order:  # else the read orders every version: no shuffle here
            rows = last_per_key(rows, [self.key, self.EPOCH], self.order_cols)
        (rows.withColumn(self.RUN, F.lit(self.run)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic")
             .partitionBy(self.RUN, self.EPOCH).parquet(f"{self.path}/versions"))

    def exists(self) -> bool:
        return (bool(child_folders(self.spark, f"{self.path}/versions"))
                or bool(child_folders(self.spark, f"{self.path}/base", complete=True)))

    def versions(self) -> DataFrame:
        """Every version that is read: the base and the epochs it does not cover."""
        bases = child_folders(self.spark, f"{self.path}/base", complete=True)
        parts = []
        if child_folders(self.spark, f"{self.path}/versions"):
            rows = self.spark.read.parquet(f"{self.path}/versions").withColumns(
                {self.RUN: F.col(self.RUN).cast("string"),
                 self.EPOCH: F.col(self.EPOCH).cast("long")})
            for run, top in self._covered(bases[-1]) if bases else ():  # prunes partitions
                rows = rows.filter((F.col(self.RUN) != run) | (F.col(self.EPOCH) > top))
            parts.append(rows)
        if bases:
            parts.append(self.spark.read.parquet(f"{self.path}/base/{bases[-1]}"))
        out = parts[0]
        return out.unionByName(parts[1], allowMissingColumns=True) if len(parts) > 1 else out

    def _covered(self, base: str) -> list[tuple[str, int]]:
        """Last epoch of each run in a base: one row per checkpoint ever used."""
        covers = self.spark.read.parquet(f"{self.path}/covers/{base}")
        return [(r[self.RUN], r["top"]) for r in covers.toLocalIterator()]

    def read(self, columns: Sequence[str] | None = None) -> DataFrame:
        """Current table: the latest version of each key (``columns`` only,
        if given, besides the key)."""
        latest = last_per_key(self.versions(), self.key, self._order(), columns)
        return latest.drop(self.EPOCH, self.RUN) if columns is None else latest

    def _order(self) -> list[str]:
        place = [self.RUN, self.EPOCH]
        return [*self.order_cols, *place] if self.global_order else [*place, *self.order_cols]

    def compact(self) -> None:
        """Write the current table as a new base; readers move to it when it is
        complete. Rows keep their run, epoch and order, so replays, later epochs
        and later runs compare with them as before. It may run beside the stream:
        a run's newest epoch may be half written or be replayed, so it is not
        covered and stays to be read beside the base (its rows in the base are
        versions like others)."""
        self.compact_to(self.path)

    def compact_to(self, path: str) -> None:
        """Write the current table as the base of the table at ``path``."""
        name = f"{int(time.time() * 1000):013d}-{uuid.uuid4().hex[:8]}"
        versions = self.versions()
        # epochs of a run arrive in order: all below the last one seen are whole
        tops = versions.groupBy(self.RUN).agg((F.max(self.EPOCH) - 1).alias("top"))
        tops.write.parquet(f"{path}/covers/{name}")
        last_per_key(versions, self.key, self._order()).write.parquet(f"{path}/base/{name}")


def rollup(fact: DataFrame, dim: DataFrame, fact_fk: str, dim_pk: str,
           label_col: str, label: str = "label", alias: str = "cnt") -> DataFrame:
    """``SELECT label, COUNT(*) FROM fact JOIN dim GROUP BY label`` (A4, K9 body).

    Aggregated before the join: the fact collapses to one count per FK
    (partial + final aggregate on the key), so the join probes one row per
    FK instead of one per fact row, and a hot FK is combined map-side. Facts
    whose FK has no dimension row drop out in the inner join.
    """
    per_fk = fact.groupBy(fact_fk).agg(F.count(F.lit(1)).alias("__c"))
    labels = dim.select(dim_pk, label_col)
    joined = key_join(per_fk, labels, fact_fk, dim_pk, "inner")
    counts = joined.groupBy(F.col(label_col).alias(label)).agg(
        F.sum("__c").cast("long").alias(alias))
    return order_by_count(counts, label, alias)


class RollupTable:
    """Materialized rollup: a stored snapshot, refreshed in full on demand.

    Every refresh writes a folder of its own; the newest complete one is the
    snapshot. A reader that opened an older one goes on reading it, and a
    refresh that fails changes nothing. The last ``keep`` snapshots stay.
    """

    def __init__(self, spark: SparkSession, path: str, label: str = "label",
                 alias: str = "cnt", keep: int = 3):
        self.spark = spark
        self.path = path
        self.label = label
        self.alias = alias
        self.keep = keep

    def refresh(self, rollup_df: DataFrame) -> None:
        name = f"{int(time.time() * 1000):013d}-{uuid.uuid4().hex[:8]}"
        rollup_df.write.parquet(f"{self.path}/{name}")
        for old in child_folders(self.spark, self.path, complete=True)[:-self.keep]:
            delete_path(self.spark, f"{self.path}/{old}")

    def snapshot(self) -> DataFrame:
        newest = child_folders(self.spark, self.path, complete=True)[-1]
        return self.spark.read.parquet(f"{self.path}/{newest}")

    def read(self) -> DataFrame:
        """``SELECT * FROM mv ORDER BY cnt DESC`` (ties by label)."""
        return order_by_count(self.snapshot(), self.label, self.alias)


def duplicate_keys(df: DataFrame, key: str | Sequence[str], alias: str = "dup") -> DataFrame:
    """Number of keys held by more than one row; 0 is what a unique index asserts."""
    keys = [key] if isinstance(key, str) else list(key)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return per_key.agg(F.count_if(F.col("__n") > 1).alias(alias))


def analyze(spark: SparkSession, table: str, columns: Sequence[str] | None = None) -> None:
    """Collect table and column statistics for the cost-based planner."""
    what = f"FOR COLUMNS {', '.join(columns)}" if columns else "FOR ALL COLUMNS"
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS {what}")
