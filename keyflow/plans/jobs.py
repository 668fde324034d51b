"""The pipeline's composite jobs (ingest, publish, layout compare), each a
plain function over tables that Spark reads and writes.

* ``ingest``: payload users and generated users -> FK resolved -> inserted
  into the fact table if absent.
* ``publish``: claim a bounded batch of unsent rows, mark them in the
  ledger, validate, stamp, encode and hand them to the bus; delivery
  counters come back as a one-row DataFrame.
* ``layout_compare``: the same three questions (count, filtered count,
  group count) over the flat layout, the fact/dimension layout and the rollup.
"""

from __future__ import annotations

import hashlib
import time
import uuid
import zlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.operators import aggregates as agg
from keyflow.operators import audits, joins, messages, outbox, tables
from keyflow.operators.keyfilter import MOST_BLOCKS
from keyflow.operators.partitioning import spread, union_sources
from keyflow.operators.rollups import IncrementalRollup
from keyflow.schemas import MESSAGE_TEXT_FIELDS, USERS_RAW, create_tables
from keyflow.session import child_folders, path_exists, scratch_dir
from keyflow.sources.api import flatten_results
from keyflow.sources.generator import generate_user_batch
from keyflow.sources.tables import write_jdbc
from keyflow.streaming.job import write_with_retry

CLAIM_BATCH = 5000
SEND_ATTEMPTS = 3
SYNTHETIC_BATCH = 5000


Table = tables.ParquetTable | tables.BucketedTable


@dataclass
class Layout:
    """Where the pipeline's tables live."""

    fact: Table                      # users_raw
    dim: DataFrame                   # dim_gender (gender_id, gender_code, gender_label)
    ledger: Table                    # sent ledger (id, claim_id)
    flat: Table                      # users_baseline
    rollup: tables.RollupTable       # mv_gender_counts
    delivery: tables.ParquetTable    # delivery log (id, failures, valid, claim_id)
    counts: IncrementalRollup        # rows per gender_id, by ingest batch


def new_layout(spark: SparkSession, root: str, dim: DataFrame) -> Layout:
    return Layout(
        fact=tables.ParquetTable(spark, f"{root}/users_raw"),
        dim=dim,
        ledger=tables.ParquetTable(spark, f"{root}/sent_ledger"),
        flat=tables.ParquetTable(spark, f"{root}/users_baseline"),
        rollup=tables.RollupTable(spark, f"{root}/mv_gender_counts", label="gender_label"),
        delivery=tables.ParquetTable(spark, f"{root}/delivery_log"),
        counts=IncrementalRollup(spark, f"{root}/mv_deltas", "gender_id"),
    )


def new_bucketed_layout(spark: SparkSession, root: str, dim: DataFrame, buckets: int,
                        prefix: str = "kf") -> Layout:
    """Fact, ledger and flat table bucketed by ``id`` into the same buckets:
    the claim's anti join, the sent flag and the flat refresh run without
    shuffling the big tables."""
    def bucketed(name: str) -> tables.BucketedTable:
        return tables.BucketedTable(spark, f"{prefix}_{name}", f"{root}/{name}", "id", buckets)

    return Layout(fact=bucketed("users_raw"), dim=dim, ledger=bucketed("sent_ledger"),
                  flat=bucketed("users_baseline"),
                  rollup=tables.RollupTable(spark, f"{root}/mv_gender_counts",
                                            label="gender_label"),
                  delivery=tables.ParquetTable(spark, f"{root}/delivery_log"),
                  counts=IncrementalRollup(spark, f"{root}/mv_deltas", "gender_id"))


def declared_layout(spark: SparkSession, root: str, dim: DataFrame, buckets: int = 8) -> Layout:
    """The deployed layout: every table declared at job start (K8), those that
    are looked up by id bucketed by it, so that a claim, the sent flag and the
    flat refresh shuffle none of them.

    The files lie below ``root/buckets=<n>``; a root that has files keeps its
    number of buckets, whatever is asked for.
    """
    there = [int(n.removeprefix("buckets=")) for n in child_folders(spark, root)
             if n.startswith("buckets=")]
    n = there[0] if there else buckets
    place = f"{root}/buckets={n}"
    database = f"keyflow_{zlib.crc32(root.encode()):08x}"
    create_tables(spark, database, place, n)

    def by_id(name: str) -> tables.BucketedTable:
        return tables.BucketedTable(spark, f"{database}.{name}", f"{place}/{name}", "id", n)

    return Layout(fact=by_id("users_raw"), dim=dim, ledger=by_id("sent_ledger"),
                  flat=by_id("users_baseline"),
                  rollup=tables.RollupTable(spark, f"{place}/mv_gender_counts",
                                            label="gender_label"),
                  delivery=tables.ParquetTable(spark, f"{place}/delivery_log"),
                  counts=IncrementalRollup(spark, f"{place}/mv_deltas", "gender_id"))


def _fact_rows(users: DataFrame, dim: DataFrame) -> DataFrame:
    resolved = joins.resolve_key(users, dim, "gender", "gender_code", "gender_id", "gender_id")
    cols = []
    for f in USERS_RAW.fields:
        if f.name == "ingested_at":
            cols.append(F.current_timestamp().alias("ingested_at"))
        elif f.name == "kafka_sent":
            cols.append(F.lit(False).alias("kafka_sent"))
        else:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return resolved.select(*cols, "__seq")


def ingest(spark: SparkSession, layout: Layout, payloads: DataFrame | None = None,
           n_synthetic: int = SYNTHETIC_BATCH, seed: int | None = None,
           now_ms: int | None = None, offset: int = 0,
           run_id: str | None = None, records: DataFrame | None = None) -> DataFrame:
    """S4 U S5 -> J3 -> K1. Returns the rows that were inserted (read back).

    ``records`` are users from elsewhere (a relational table, S2) with the
    generator's columns; columns they lack are null.

    Every run generates new users: the seed comes from ``run_id`` (a fresh one
    by default). Give the ``run_id`` of a failed run, or a ``seed``, to repeat it.
    """
    run_id = run_id or uuid.uuid4().hex
    if seed is None:
        seed = int(hashlib.sha1(run_id.encode()).hexdigest()[:8], 16) >> 1
    # the run's batch, stored under its name: a repeated run goes on from it
    batch = f"{layout.counts.path}_batches/{run_id}"
    existing = layout.fact.read_if_exists()
    if not path_exists(spark, f"{batch}/_SUCCESS"):
        parts = []
        if payloads is not None:
            api = flatten_results(payloads, seed=seed, now_ms=now_ms)
            parts.append(api.withColumn("__seq", F.monotonically_increasing_id() - F.lit(2**62)))
        synth = generate_user_batch(spark, n_synthetic, seed=seed, now_ms=now_ms, offset=offset)
        synth = synth.withColumn("__seq", F.monotonically_increasing_id())
        parts.append(synth)
        if records is not None:
            known = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in records.columns
                     else F.lit(None).cast(f.dataType).alias(f.name)
                     for f in synth.schema if f.name != "__seq"]
            parts.append(records.select(*known).withColumn(
                "__seq", F.monotonically_increasing_id() + F.lit(2**61)))
        users = union_sources(*parts).drop("event_ts_ms")
        loaded = scratch_dir(spark, "load")
        tables.first_per_key(_fact_rows(users, layout.dim), "id", "__seq").drop("__seq") \
            .write.parquet(loaded)
        rows = spark.read.parquet(loaded)
        if existing is not None:  # the load is stored: its keys filter the table's scan
            rows = tables.insert_if_absent(existing, rows, "id", filter_blocks=MOST_BLOCKS)
        rows.write.mode("overwrite").parquet(batch)
    fixed = spark.read.parquet(batch)
    layout.counts.add(run_id, fixed)
    # what a run that broke off has appended already is not appended again
    new = fixed if existing is None else tables.insert_if_absent(existing, fixed, "id")
    part = scratch_dir(spark, "ingest_batch")
    new.write.parquet(part)  # the append and the return agree
    inserted = spark.read.parquet(part)
    layout.fact.append(inserted)
    return inserted


def publish(spark: SparkSession, layout: Layout, send: Callable[[DataFrame], None],
            batch_size: int = CLAIM_BATCH, now_ms: int | None = None,
            mark_before_send: bool = True, attempts: int = SEND_ATTEMPTS,
            sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """O2 (F3, J1, P3) -> K7 -> F7 -> P4 -> K4 -> A8/A9.

    ``send`` receives the ``key, value`` frame (``messages.publish`` for the
    bus, a Parquet write for the offline twin) and is tried ``attempts`` times.
    The ledger is the only truth about what is claimed: the batch is what the
    fact table holds and the ledger does not, whenever it landed. The claimed
    batch is stored before anything is sent, so marking, sending and counting
    all see the same rows. With ``mark_before_send`` (the reference's order) the
    claimed rows are written straight into the ledger as partition
    ``claim_id=<id>``: one durable write both records and marks the batch, and
    a crash after it loses the batch (at most once). Without it the batch goes
    to a scratch folder and the ledger is written after sending (at least once:
    a crash re-sends it).

    What happened to each record goes to the delivery log; the counters are
    an aggregate of this batch's part of it. A send that fails for good raises
    after its log is written.
    """
    fact = layout.fact.read()
    ledger = layout.ledger.read_if_exists()
    projection = ([F.col("id"), F.col("first_name"), F.col("last_name"),
                   F.col("gender_code").alias("gender")]
                  + [F.col(c) for c in MESSAGE_TEXT_FIELDS[4:]] + [F.col("ingested_at")])
    dim = layout.dim.select("gender_id", "gender_code")
    rows = outbox.claim(fact, ledger, batch_size, ["ingested_at", "id"], projection,
                        dim=dim, dim_on="gender_id", key="id",
                        unsent_condition=F.col("kafka_sent") == F.lit(False))
    claim_id = f"{int(time.time() * 1000):013d}-{uuid.uuid4().hex[:12]}"
    partitioned = isinstance(layout.ledger, tables.ParquetTable)

    def mark(claimed_rows: DataFrame) -> None:
        """Record the claim in the ledger (K7): a ``claim_id=<id>`` partition
        of a Parquet ledger, or ``(id, claim_id)`` rows of a bucketed one."""
        if partitioned:
            layout.ledger.append(claimed_rows.withColumn("claim_id", F.lit(claim_id)),
                                 ["claim_id"])
        else:
            layout.ledger.append(outbox.ledger_rows(claimed_rows, claim_id))

    part = scratch_dir(spark, "claim")
    rows.write.parquet(part)  # fixes the batch
    batch = spark.read.schema(rows.schema).parquet(part)
    valid_flag = messages.is_valid()
    elapsed_s, failures, error = 0.0, 0, None
    if not batch.isEmpty():
        if mark_before_send:
            mark(batch)
        valid, _ = messages.validity_split(batch.drop("ingested_at"))
        stamped = messages.stamp_send_time(valid, now_ms)
        started = time.monotonic()
        try:
            failures = write_with_retry(lambda: send(messages.to_message(stamped, "username")),
                                        attempts, sleep=sleep) - 1
        except Exception as exc:  # noqa: BLE001  raised below, once it is logged
            failures, error = attempts, exc
        elapsed_s = time.monotonic() - started
        if not mark_before_send and error is None:
            mark(batch)
    layout.delivery.append(batch.select(
        "id", F.when(valid_flag, failures).otherwise(0).cast("int").alias("failures"),
        valid_flag.alias("valid"), F.lit(claim_id).alias("claim_id")), ["claim_id"])
    log = layout.delivery.read().filter(F.col("claim_id") == claim_id)  # one folder
    if error is not None:
        raise error
    return agg.delivery_ratios(agg.delivery_counters(log, max_attempts=attempts),
                               elapsed_s=elapsed_s, keep_counters=True)


def file_bus_sender(path: str) -> Callable[[DataFrame], None]:
    """Offline twin of the bus for ``publish``: each call appends the
    ``key, value`` frame as new files under ``path``, which a file stream
    picks up on its next trigger."""
    def send(frame: DataFrame) -> None:
        frame.write.mode("append").parquet(path)
    return send


def mirror_flat(layout: Layout, url: str, table: str, tasks: int) -> None:
    """Copy the flat table into a relational one in pages (K3's target there);
    as many connections as ``tasks``."""
    write_jdbc(spread(layout.flat.read(), tasks), url, table, mode="overwrite", truncate="true")


#: ranges that a copy audit compares, the bound of what it broadcasts
AUDIT_RANGES = 4096


def audit_copy(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str] | None = None,
               ranges: int = AUDIT_RANGES) -> dict[str, int]:
    """Are two tables copies of each other? One digest pass over each, then
    rows only of the key ranges that differ. Columns: those both have, but the key."""
    spark = left.sparkSession
    cols = list(columns or [c for c in left.columns if c in right.columns and c != key])
    kind = left.schema[key].dataType
    right = right.withColumn(key, F.col(key).cast(kind))
    leaf = audits.token_range(key, ranges)
    trees = []
    for rows in (left, right):
        tree = audits.DigestTree(spark, scratch_dir(spark, "audit"))
        tree.build(rows, key, cols, leaf)
        trees.append(tree)
    found = scratch_dir(spark, "audit-ranges")
    trees[0].differing(trees[1]).write.parquet(found)
    wanted = spark.read.parquet(found)
    n = wanted.count()
    if not n:  # equal digests everywhere: no row has to be looked at again
        return {"changed": 0, "only_left": 0, "only_right": 0, "ranges": 0}
    row = audits.table_diff_in_ranges(left, right, key, cols, leaf, wanted).first()
    return {**row.asDict(), "ranges": n}


def audit_loss(produced: DataFrame, consumed: DataFrame, partition: str = "partition",
               offset: str = "offset", lost_path: str | None = None) -> list[dict[str, int]]:
    """D3 per bus partition; with ``lost_path`` every lost offset is written there."""
    rows = audits.loss_audit_bitmaps(produced, consumed, partition, offset)
    if lost_path:
        audits.lost_offsets(produced, consumed, partition, offset).write.parquet(lost_path)
    return sorted((r.asDict() for r in rows.collect()), key=lambda r: str(r["part"]))


def refresh_flat(layout: Layout) -> DataFrame:
    """K3: append fact ids missing from the flat table, codes inlined.

    ``ingested_at`` of a flat row is the time it entered the flat table.
    """
    cols = ["id", F.col("gender_code").alias("gender"), "email", "username",
            F.current_timestamp().alias("ingested_at")]
    fact = layout.fact.read().select("id", "gender_id", "email", "username")
    if layout.flat.exists():
        rows = tables.flat_refresh(layout.flat.read(), fact, layout.dim, "gender_id",
                                   "gender_id", cols)
    else:
        rows = tables.flat_rows(fact, layout.dim, "gender_id", "gender_id", cols)
    layout.flat.append(rows)
    return layout.flat.read()


def layout_compare(layout: Layout, code: str = "female") -> dict[str, DataFrame]:
    """A1-A4 and S7 over the three layouts (flat, fact/dimension, rollup)."""
    flat = layout.flat.read()
    fact = layout.fact.read()
    dim = layout.dim
    on_dim = joins.dim_join(fact.select("gender_id"), dim, "gender_id", "inner")
    return {
        "flat_count": agg.count_all(flat),
        "flat_filtered": agg.count_filtered(flat, F.col("gender") == code),
        "flat_group": agg.group_count(flat, "gender"),
        "fact_count": agg.count_all(fact),
        "fact_filtered": agg.count_filtered(on_dim, F.col("gender_code") == code),
        "fact_group": tables.rollup(fact, dim, "gender_id", "gender_id", "gender_label",
                                    label="gender_label"),
        "rollup_read": layout.rollup.read(),
    }


def refresh_rollup(layout: Layout, rescan: bool = False) -> None:
    """K9: renew the rollup from the counts that the ingest batches left, or with
    ``rescan`` from the whole fact table."""
    if rescan:
        rows = tables.rollup(layout.fact.read(), layout.dim, "gender_id", "gender_id",
                             "gender_label", label="gender_label")
    else:
        layout.counts.fold()
        rows = layout.counts.read(layout.dim, "gender_id", "gender_label", label="gender_label")
    layout.rollup.refresh(rows)
