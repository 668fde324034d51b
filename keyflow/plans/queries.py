"""Registered queries: one per operator group of the inventory, each with a
DuckDB oracle over the same Parquet tables.

Every query reads the driver tables at ``sf_dir`` (or tables Spark derives
from them) in full. Queries that exercise writes (tables, ledgers, stream
sinks) write below the session's checkpoint folder, into a fresh folder per
call, and return a read of what they wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.operators import aggregates as agg
from keyflow.operators import (audits, checks, indexed, joins, keyfilter, messages, outbox,
                               partitioning, rollups, tables)
from keyflow.plans.crash import forget_last_commit
from keyflow.plans.mapping import (
    BATCH_START_MS,
    BUS_PARTITIONS,
    BUS_SCHEMA,
    RECORD_FIELDS,
    delivery_log,
    event_frame,
    event_records,
    publish_bus,
    truncate_payloads,
)
from keyflow.schemas import EVENT_MESSAGE, USER_MESSAGE
from keyflow.session import scratch_dir
from keyflow.sources.api import flatten_results, parse_payloads
from keyflow.sources.generator import GENDERS, generate_users, layout_rows
from keyflow.sources.stream import file_stream
from keyflow.sources.tables import read_table
from keyflow.streaming.job import BatchProcessor, build_stream, run_available_now
from keyflow.streaming.progress import ProgressLog

Query = Callable[[SparkSession, str], DataFrame]

CLAIM_SIZE = 500
PAGE_SIZE = 10  # results per API payload page
LOOKUP_KEY = 1000


def _t(spark: SparkSession, sf: str, name: str, *cols: str) -> DataFrame:
    return read_table(spark, sf, name, cols or None)


def _segment_dim(customer: DataFrame, exclude: str | None = "BUILDING") -> DataFrame:
    """A code dimension derived from the fact: ``dim_id`` = smallest customer
    of the segment; ``exclude`` leaves one code out (unknown code -> NULL FK)."""
    src = customer if exclude is None else customer.filter(F.col("c_mktsegment") != exclude)
    return src.groupBy(F.col("c_mktsegment").alias("code")).agg(
        F.min("c_custkey").alias("dim_id"))


# ---------------------------------------------------------------- scans / sources

def scan_fact(spark, sf):
    """Fact scan, narrow projection."""
    return _t(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("username"),
        F.col("c_nationkey").alias("dim_id"))


def api_flatten(spark, sf):
    """Nested ``{"results": [...]}`` pages parsed and flattened back to rows.

    Pages hold at most ``PAGE_SIZE`` turns of one conversation, so a page is
    bounded however long a conversation gets; each turn takes the place of a
    user, its text that of the e-mail.
    """
    conv = _t(spark, sf, "conversations", "conv_id", "turn", "role", "text")
    result = F.struct(
        F.struct(F.col("role").alias("first")).alias("name"),
        F.col("text").alias("email"),
        F.struct(F.col("conv_id").cast("string").alias("username")).alias("login"),
        F.col("turn").cast("string").alias("phone"))
    pages = (conv.groupBy("conv_id", F.floor(F.col("turn") / PAGE_SIZE).alias("page"))
             .agg(F.to_json(F.struct(F.collect_list(result).alias("results"))).alias("value")))
    users = flatten_results(parse_payloads(pages), now_ms=BATCH_START_MS)
    return users.select(F.col("username").cast("long").alias("conv_id"),
                        F.col("phone").cast("long").alias("turn"),
                        F.col("first_name").alias("role"), F.col("email").alias("text"))


def gen_users(spark, sf):
    """One generated user per customer key; id is checked against its UUIDv4."""
    keys = _t(spark, sf, "customer", "c_custkey")
    users = generate_users(keys, "c_custkey", seed=42, now_ms=BATCH_START_MS, keep_key="key")
    return users.select(F.col("key").alias("id"), F.col("id").alias("uuid"))


def gen_expectations(spark, sf):
    """S5 + D1: the generator's record rules checked over one user per
    customer key (the reference's generator tests, as one distributed pass)."""
    keys = _t(spark, sf, "customer", "c_custkey")
    users = generate_users(keys, "c_custkey", seed=42, now_ms=BATCH_START_MS)
    rules = checks.record_violations(
        [f.name for f in USER_MESSAGE.fields], domain={"gender": GENDERS},
        ts_col="event_ts_ms", ts_range=(BATCH_START_MS, BATCH_START_MS))
    suite = checks.expectations(users, "id", rules)
    return suite.select("n", "missing_field", "bad_uuid", "bad_gender", "ts_out_of_range",
                        F.col("dup_id").alias("dup_id"))


def gen_fact_series(spark, sf):
    """The benchmark's columns for the key of every order."""
    return layout_rows(_t(spark, sf, "orders", "o_orderkey"), "o_orderkey")


# ---------------------------------------------------------------- counts (layouts)

def count_all(spark, sf):
    """A1."""
    return agg.count_all(_t(spark, sf, "customer"))


def count_filtered_flat(spark, sf):
    """F4 + A2 on the flat column."""
    return agg.count_filtered(_t(spark, sf, "customer", "c_mktsegment"),
                              F.col("c_mktsegment") == "BUILDING")


def count_filtered_dim(spark, sf):
    """F5 + J2 + A2: filter on a dimension attribute, pushed into its scan."""
    fact = _t(spark, sf, "customer", "c_nationkey")
    dim = _t(spark, sf, "nation", "n_nationkey", "n_regionkey").filter(F.col("n_regionkey") == 1)
    joined = joins.dim_join(fact, dim.select("n_nationkey"),
                            F.col("c_nationkey") == F.col("n_nationkey"), "inner")
    return agg.count_all(joined)


def _flat_layout(spark, sf) -> DataFrame:
    """Flat table: fact with the segment code inlined; a code the dimension
    lacks resolves to a NULL FK and so to a NULL code (J3 then J1)."""
    customer = _t(spark, sf, "customer", "c_custkey", "c_mktsegment")
    dim = _segment_dim(customer)
    fact = joins.resolve_key(customer, dim, "c_mktsegment", "code", "dim_id", "seg_id")
    return tables.flat_rows(fact.drop("c_mktsegment"), dim, "seg_id", "dim_id",
                            [F.col("c_custkey").alias("id"), F.col("code").alias("seg")])


def count_by_flat(spark, sf):
    """A3 + O1: group count on a flat column; NULL is its own group."""
    return agg.group_count(_flat_layout(spark, sf), "seg")


def count_by_dim(spark, sf):
    """J2 + A4 + O1: group count on the dimension label; facts without a
    dimension row drop out."""
    fact = _t(spark, sf, "customer", "c_nationkey")
    dim = _t(spark, sf, "nation", "n_nationkey", "n_name", "n_regionkey").filter(
        F.col("n_regionkey") != 0)
    return tables.rollup(fact, dim, "c_nationkey", "n_nationkey", "n_name")


def fact_dim_left(spark, sf):
    """Left join, unmatched facts keep a NULL label."""
    fact = _t(spark, sf, "customer", "c_custkey", "c_nationkey")
    dim = _t(spark, sf, "nation", "n_nationkey", "n_name", "n_regionkey").filter(
        F.col("n_regionkey") != 0).select("n_nationkey", "n_name")
    return joins.dim_join(fact, dim, F.col("c_nationkey") == F.col("n_nationkey"), "left") \
        .select(F.col("c_custkey").alias("id"), F.col("n_name").alias("label"))


def resolve_dim_key(spark, sf):
    """Natural code -> surrogate key, unknown code -> NULL."""
    customer = _t(spark, sf, "customer", "c_custkey", "c_mktsegment")
    dim = _segment_dim(customer)
    return joins.resolve_key(customer, dim, "c_mktsegment", "code", "dim_id", "dim_id") \
        .select(F.col("c_custkey").alias("id"), "dim_id")


def point_lookup(spark, sf):
    """F8: key lookup; the equality is pushed into the Parquet scan."""
    return _t(spark, sf, "orders", "o_orderkey", "o_orderstatus") \
        .filter(F.col("o_orderkey") == LOOKUP_KEY) \
        .select(F.col("o_orderkey").alias("id"), "o_orderstatus")


def union_sources(spark, sf):
    """Bag union of two record sources."""
    a = _t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("nm"))
    b = _t(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("nm"))
    return partitioning.union_sources(a, b)


# ---------------------------------------------------------------- table maintenance

def insert_if_absent(spark, sf):
    """First row per key from the batch, existing keys untouched."""
    events = _t(spark, sf, "events", "user_id", "event_id")
    target = tables.ParquetTable(spark, scratch_dir(spark, "users_raw"))
    existing = events.filter(F.col("user_id") % 2 == 0).select(
        F.col("user_id").alias("id")).distinct().withColumn("event_id", F.lit(-1).cast("long"))
    target.overwrite(existing)
    incoming = events.select(F.col("user_id").alias("id"), "event_id")
    target.append(tables.insert_if_absent(target.read(), incoming, "id", "event_id"))
    return target.read()


def dim_seed(spark, sf):
    """K2: seed a dimension by natural key; codes already there keep their label."""
    customer = _t(spark, sf, "customer", "c_mktsegment")
    dim = tables.ParquetTable(spark, scratch_dir(spark, "dim"))
    dim.overwrite(customer.filter(F.col("c_mktsegment") != "BUILDING")
                  .select(F.col("c_mktsegment").alias("code")).distinct()
                  .withColumn("label", F.lit("old")))
    seed = customer.select(F.col("c_mktsegment").alias("code")).withColumn("label", F.lit("new"))
    dim.append(tables.insert_if_absent(dim.read(), seed, "code"))
    return dim.read()


def flat_refresh(spark, sf):
    """K3: append new ids to the flat table; existing flat rows never change."""
    customer = _t(spark, sf, "customer", "c_custkey", "c_mktsegment")
    flat = tables.ParquetTable(spark, scratch_dir(spark, "flat"))
    flat.overwrite(customer.filter(F.col("c_custkey") % 2 == 0).select(
        F.col("c_custkey").alias("id"), F.lit("old").alias("seg")))
    dim = _segment_dim(customer, exclude=None)
    fact = joins.resolve_key(customer, dim, "c_mktsegment", "code", "dim_id", "seg_id") \
        .select("c_custkey", "seg_id")
    new_rows = tables.flat_refresh(flat.read(), fact, dim, "seg_id", "dim_id",
                                   [F.col("c_custkey").alias("id"), F.col("code").alias("seg")])
    flat.append(new_rows)
    return flat.read()


def upsert_latest(spark, sf):
    """K5: events applied as weekly epochs; the latest version per user wins."""
    events = _t(spark, sf, "events", "user_id", "event_type", "value", "ts", "event_id")
    # (ts, event_id) is the source's own order: epochs are written as they
    # come (no per-epoch shuffle) and the read keeps the latest per user
    sink = tables.KeyedUpsertTable(spark, scratch_dir(spark, "created_users"), "id",
                                   order_cols=["ts", "event_id"], global_order=True)
    week = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / F.lit(7 * 86400))
    sink.write_epochs(events.select(F.col("user_id").alias("id"), "event_type", "value",
                                    "ts", "event_id", week.alias(sink.EPOCH)))
    return sink.read(["event_type", "value"])


def upsert_compacted(spark, sf):
    """The same events with a compaction half way, the last epoch before
    it replayed, and the rest written under a new checkpoint."""
    events = _t(spark, sf, "events", "user_id", "event_type", "value", "ts", "event_id")
    path = scratch_dir(spark, "created_users")

    def sink(run: str) -> tables.KeyedUpsertTable:
        return tables.KeyedUpsertTable(spark, path, "id", order_cols=["ts", "event_id"],
                                       global_order=True, run=run)

    rows = events.select(F.col("user_id").alias("id"), "event_type", "value", "ts", "event_id",
                         F.pmod(F.col("event_id"), F.lit(8)).alias("_epoch"))
    first, second = sink("run-0"), sink("run-1")
    first.write_epochs(rows.filter("_epoch < 4"))
    first.compact()
    first.write_epochs(rows.filter("_epoch = 3"))
    second.write_epochs(rows.filter("_epoch >= 4").withColumn("_epoch", F.col("_epoch") - 4))
    return second.read(["event_type", "value"])


def _rollup_table(spark, sf) -> tables.RollupTable:
    fact = _t(spark, sf, "customer", "c_nationkey")
    dim = _t(spark, sf, "nation", "n_nationkey", "n_name")
    mv = tables.RollupTable(spark, scratch_dir(spark, "mv_counts"))
    mv.refresh(tables.rollup(fact, dim, "c_nationkey", "n_nationkey", "n_name"))
    return mv


def mv_build(spark, sf):
    """K9: build the rollup snapshot."""
    return _rollup_table(spark, sf).snapshot()


def mv_read(spark, sf):
    """Read the stored rollup ordered by count."""
    return _rollup_table(spark, sf).read()


def mv_unique_check(spark, sf):
    """The rollup's label is unique (0 duplicated labels)."""
    return tables.duplicate_keys(_rollup_table(spark, sf).snapshot(), "label")


def mv_incremental(spark, sf):
    """K9, S7 without a rescan: counts of eight ingest batches; the snapshot is
    folded half way, one folded batch is replayed, and a late one comes after it."""
    fact = _t(spark, sf, "customer", "c_custkey", "c_nationkey")
    mv = rollups.IncrementalRollup(spark, scratch_dir(spark, "mv_deltas"), "c_nationkey")

    def ingest(*batches: int) -> None:
        for b in batches:
            mv.add(f"batch-{b}", fact.filter(F.col("c_custkey") % 8 == b))

    ingest(0, 1, 2, 4)
    mv.fold()
    ingest(2, 3, 5)
    mv.fold()
    ingest(6, 7)
    return mv.read(_t(spark, sf, "nation", "n_nationkey", "n_name"), "n_nationkey", "n_name")


def insert_filtered(spark, sf):
    """K1/J4 behind a Bloom filter: users of the newest events inserted into a
    table of all customers and earlier users; the filter stands above its scan."""
    events = _t(spark, sf, "events", "user_id", "event_id")
    target = tables.ParquetTable(spark, scratch_dir(spark, "users_raw"))
    known = _t(spark, sf, "customer", "c_custkey").select((-F.col("c_custkey")).alias("id"))
    target.overwrite(known.unionByName(events.filter(F.col("user_id") % 3 == 0)
                                       .select(F.col("user_id").alias("id")).distinct())
                     .withColumn("event_id", F.lit(-1).cast("long")))
    load = tables.ParquetTable(spark, scratch_dir(spark, "load"))  # it is read three times
    load.overwrite(events.filter(F.col("event_id") % 4 == 1)
                   .select(F.col("user_id").alias("id"), "event_id"))
    target.append(tables.insert_if_absent(target.read(), load.read(), "id", "event_id",
                                          filter_blocks=keyfilter.MOST_BLOCKS))
    return target.read()


def point_lookup_indexed(spark, sf):
    """F8 on a table sorted by its key with Bloom filters: three keys' rows."""
    orders = _t(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_totalprice")
    path = scratch_dir(spark, "orders_indexed")
    indexed.write_indexed(orders, path, "o_orderkey")
    found = indexed.lookup(spark, path, "o_orderkey", [1, LOOKUP_KEY, -7],
                           ["o_orderkey", "o_orderstatus", "o_totalprice"])
    return found.withColumnRenamed("o_orderkey", "id")


def count_footer(spark, sf):
    """A1 from Parquet footers: no row group is read."""
    reader = indexed.footer_reader(spark)
    return agg.count_all(reader.read.parquet(f"{sf}/customer.parquet"))


def offset_totals_footer(spark, sf):
    """A10 from Parquet footers of the bus twin: per partition folder the largest
    offset, without a row."""
    bus = scratch_dir(spark, "bus")
    publish_bus(_t(spark, sf, "events"), bus)
    return agg.offset_totals(indexed.footer_reader(spark).read.parquet(bus))


def join_by_statistics(spark, sf):
    """A join over analyzed catalog tables, planned by their histograms."""
    own = indexed.statistics_session(spark)
    name = scratch_dir(spark, "stat").rsplit("-", 1)[1]
    for table, cols in (("orders", ["o_orderkey", "o_custkey", "o_totalprice"]),
                        ("customer", ["c_custkey", "c_nationkey", "c_acctbal"])):
        (own.read.parquet(f"{sf}/{table}.parquet").select(*cols)
         .write.option("path", scratch_dir(spark, table)).saveAsTable(f"{table}_{name}"))
        tables.analyze(own, f"{table}_{name}", cols)
    rich = own.table(f"customer_{name}").filter(F.col("c_acctbal") > 9000)
    return (own.table(f"orders_{name}")
            .join(rich, F.col("o_custkey") == F.col("c_custkey"))
            .groupBy(F.col("c_nationkey").alias("nation")).agg(
                F.count(F.lit(1)).alias("orders"), F.max("o_totalprice").alias("largest")))


# ---------------------------------------------------------------- outbox

def _claim_orders(spark, sf, ledger):
    """The oldest unsent orders: a top-k over the orders, then its rows joined."""
    orders = _t(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    customer = _t(spark, sf, "customer", "c_custkey", "c_name", "c_nationkey")
    nation = _t(spark, sf, "nation", "n_nationkey", "n_name")
    claimed = outbox.claim(
        orders.withColumnRenamed("o_orderkey", "id"), ledger, CLAIM_SIZE,
        order_by=["o_orderdate", "id"], projection=["id", "c_name", "c_nationkey"], key="id",
        dim=customer, dim_on=F.col("o_custkey") == F.col("c_custkey"),
        unsent_condition=F.col("o_orderstatus") == "O")
    return joins.dim_join(claimed, nation, F.col("c_nationkey") == F.col("n_nationkey"), "left") \
        .select("id", F.col("c_name").alias("username"), F.col("n_name").alias("gender"))


def outbox_claim(spark, sf):
    """O2 (J1, P3): the oldest unsent rows, gender label restored by a left join."""
    return _claim_orders(spark, sf, None)


def outbox_claim_ledger(spark, sf):
    """The claim against a ledger that holds every third order."""
    ledger = tables.ParquetTable(spark, scratch_dir(spark, "sent_ledger"))
    sent = _t(spark, sf, "orders", "o_orderkey").filter(F.col("o_orderkey") % 3 == 0)
    ledger.overwrite(outbox.ledger_rows(sent, "claim-0", key="o_orderkey"))
    return _claim_orders(spark, sf, ledger.read())


def mark_sent(spark, sf):
    """K7 + F6/J5: claimed ids go to the ledger; the flag is a join with it.

    The ledger already holds an earlier claim: every tenth order.
    """
    orders = _t(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_orderdate") \
        .withColumnRenamed("o_orderkey", "id")
    ledger = tables.ParquetTable(spark, scratch_dir(spark, "sent_ledger"))
    ledger.overwrite(outbox.ledger_rows(orders.filter(F.col("id") % 10 == 0), "claim-0"))
    claimed = outbox.claim(orders, ledger.read(), CLAIM_SIZE, ["o_orderdate", "id"], [F.col("id")], key="id",
                           unsent_condition=F.col("o_orderstatus") == "O")
    ledger.append(outbox.ledger_rows(claimed, "claim-1"))
    return outbox.with_sent_flag(orders, ledger.read(), key="id").select("id", "sent")


def validity_split(spark, sf):
    """NULL or empty id (or username) is invalid."""
    events = _t(spark, sf, "events", "event_id", "event_type", "user_id")
    rid = (F.when(F.col("event_id") % 5 == 0, F.lit(None).cast("string"))
            .when(F.col("event_id") % 5 == 1, F.lit("")).otherwise(F.col("event_type")))
    recs = events.select(rid.alias("id"), F.col("user_id").cast("string").alias("username"))
    return messages.validity_counts(recs)


def rejected_records(spark, sf):
    """one pass parses and validates; what is refused is written with its
    reason beside what is accepted, and counted by reason."""
    i = F.col("offset")
    records = event_records(_t(spark, sf, "events"))
    records = records.withColumn("id", F.when(i % 10 == 5, F.lit(None).cast("string"))
                                 .when(i % 10 == 7, F.lit("")).otherwise(F.col("id")))
    records = records.withColumn("username", F.when(i % 20 == 9, F.lit("")).otherwise(F.col("username")))
    frame = messages.to_message(records, "username", RECORD_FIELDS, keep=["partition", "offset"])
    frame = truncate_payloads(frame, i % 10 == 3)
    frame = frame.withColumn("value", F.when(i % 20 != 11, F.col("value")))
    checked = messages.parse_with_reasons(frame, EVENT_MESSAGE, keep=["partition", "offset"])
    accepted, rejected = messages.write_split(checked, scratch_dir(spark, "checked"))
    return (rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("cnt"))
            .unionByName(accepted.select(F.lit("accepted").alias("reason")).groupBy("reason")
                         .agg(F.count(F.lit(1)).alias("cnt"))))


# ---------------------------------------------------------------- messages

def to_message(spark, sf):
    """Keyed JSON messages stamped at a fixed send time; the key is the user."""
    stamped = messages.stamp_send_time(event_records(_t(spark, sf, "events")), BATCH_START_MS)
    frame = messages.to_message(stamped, "username", RECORD_FIELDS)
    parsed = messages.parse_messages(frame, EVENT_MESSAGE, keep=["key"])
    return parsed.select(F.col("key").cast("string").alias("k"),
                         F.col("id").cast("long").alias("id"), "event_type", "event_ts_ms")


def json_parse(spark, sf):
    """Truncated payloads (every 10th from 3) parse to a NULL key and drop."""
    frame = truncate_payloads(event_frame(_t(spark, sf, "events")), F.col("offset") % 10 == 3)
    parsed = messages.parse_messages(frame, EVENT_MESSAGE)
    return parsed.select(F.col("id").cast("long").alias("id"), F.col("props.k").alias("k"))


def json_roundtrip(spark, sf):
    """to_json -> from_json keeps every column of the events."""
    out = checks.json_roundtrip(_t(spark, sf, "events", "event_id", "user_id", "event_type",
                                   "value", "ts", "props"))
    return out.withColumnRenamed("__same", "same")


def latency_enrich(spark, sf):
    """latency = batch start - producer stamp."""
    parsed = messages.parse_messages(event_frame(_t(spark, sf, "events")), EVENT_MESSAGE)
    return messages.enrich(parsed, BATCH_START_MS).select(
        F.col("id").cast("long").alias("id"), "latency_ms")


def latency_stats(spark, sf):
    """Per event type; every 7th message carries no stamp."""
    frame = event_frame(_t(spark, sf, "events"), drop_ts_when=F.col("event_id") % 7 == 0)
    parsed = messages.parse_messages(frame, EVENT_MESSAGE)
    enriched = messages.enrich(parsed, BATCH_START_MS)
    return agg.latency_stats(enriched, "latency_ms", ["event_type"], accuracy=None)


#: epochs whose sketches are stored one by one and merged
SKETCH_EPOCHS = 16


def latency_sketch(spark, sf):
    """A5/A7 by stored sketches: one per event type and epoch, merged over the
    epochs; the exact rank of each merged percentile is held against the bound."""
    frame = event_frame(_t(spark, sf, "events"), drop_ts_when=F.col("event_id") % 7 == 0)
    parsed = messages.parse_messages(frame, EVENT_MESSAGE, keep=["offset"])
    rows = messages.enrich(parsed, BATCH_START_MS).select(
        "event_type", "latency_ms", F.pmod("offset", F.lit(SKETCH_EPOCHS)).alias("epoch"))
    path = scratch_dir(spark, "latency_sketches")
    agg.latency_sketches(rows, "latency_ms", ["event_type", "epoch"]).write.parquet(path)
    merged = agg.merged_latency(spark.read.parquet(path), ["event_type"])
    lat, bound = F.col("latency_ms"), F.lit(agg.sketch_rank_error())
    # share of the measured rows below, and up to, each percentile
    ranked = (rows.join(merged.select(F.col("event_type").alias("t"), "p50", "p95"),
                        F.col("event_type") == F.col("t"))
              .groupBy("event_type").agg(*(
                  f(lat, F.col(p)).alias(f"{p}_{side}") for p in ("p50", "p95")
                  for side, f in (("low", lambda v, q: F.count_if(v < q) / F.count(v)),
                                  ("high", lambda v, q: F.count_if(v <= q) / F.count(v))))))
    near = [((F.col(f"{p}_low") - bound <= w) & (F.col(f"{p}_high") + bound >= w)).alias(f"{p}_near")
            for p, w in (("p50", 0.5), ("p95", 0.95))]
    return (merged.select("event_type", "n", "measured", "p_max")
            .join(ranked.select("event_type", *near), "event_type"))


def key_partition_check(spark, sf):
    """Per user, messages whose stamp goes back in time, over rows dealt by
    key as the bus does; every 7th message is stamped ten days early."""
    events = _t(spark, sf, "events", "user_id", "event_id", "ts")
    late = events.withColumn("ts", F.when(F.col("event_id") % 7 == 0,
                                          F.col("ts") - F.expr("interval 10 days"))
                             .otherwise(F.col("ts")))
    path = scratch_dir(spark, "dealt")
    partitioning.key_partition(late, "user_id", BUS_PARTITIONS, "event_id").write.parquet(path)
    # the check deals the written rows anew, by key and chunk
    return partitioning.order_violations(spark.read.parquet(path), "user_id", "event_id", "ts")


#: tasks that a batch is dealt over to be sent
SEND_TASKS = 8


def spread_chunks(spark, sf):
    """The events dealt evenly over the sending tasks, whatever their files."""
    dealt = partitioning.spread(_t(spark, sf, "events", "event_id"), SEND_TASKS)
    sizes = dealt.groupBy(F.spark_partition_id().alias("task")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("d"))
    # the deal starts anew in every split of the scan
    even = F.max("n") - F.min("n") <= F.greatest(F.lit(SEND_TASKS), F.avg("n") / 100)
    return sizes.agg(F.count(F.lit(1)).alias("tasks"), F.sum("n").alias("n"),
                     F.sum("d").alias("ids"), even.alias("even"))


def offset_totals(spark, sf):
    """A10: sum of end offsets over the bus partitions."""
    # only partition and offset are read: no payload is encoded
    return agg.offset_totals(event_frame(_t(spark, sf, "events")))


# ---------------------------------------------------------------- delivery metrics

def delivery_counters(spark, sf):
    """A8."""
    return agg.delivery_counters(delivery_log(_t(spark, sf, "events", "event_id", "value",
                                                 "event_type")))


def delivery_ratios(spark, sf):
    """A9."""
    return agg.delivery_ratios(delivery_counters(spark, sf))


def delivery_expected(spark, sf):
    """Expected rates for p = nationkey / 25."""
    p = _t(spark, sf, "nation", "n_nationkey").select(
        (F.col("n_nationkey").cast("double") / 25).alias("p"))
    return agg.expected_rates(p)


# ---------------------------------------------------------------- checks / audits

def expectations(spark, sf):
    """Row count, null and duplicate keys, value domain."""
    events = _t(spark, sf, "events", "event_id", "event_type")
    out = checks.expectations(events, "event_id",
                              {"bad_domain": ~F.col("event_type").isin("view", "click")})
    return out.select("n", F.col("null_event_id").alias("null_id"),
                      F.col("dup_event_id").alias("dup_id"), "bad_domain")


def loss_audit(spark, sf):
    """D3: produced vs consumed ids, every fifth consumed twice."""
    events = _t(spark, sf, "events", "event_id")
    produced = events.filter(F.col("event_id") % 10 != 3)
    consumed = events.filter(F.col("event_id") % 7 != 2)
    again = consumed.filter(F.col("event_id") % 5 == 0)
    return checks.loss_audit(produced, consumed.unionByName(again), "event_id")


def table_diff(spark, sf):
    """Primary vs copy; on the copy some prices changed, some keys are gone,
    some are new and some rows are there twice."""
    orders = _t(spark, sf, "orders", "o_orderkey", "o_totalprice").select(
        F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"))
    k = F.col("k")
    copy = orders.filter(k % 97 != 0).withColumn(
        "v", F.when(k % 100 == 0, F.col("v") + 1).otherwise(F.col("v")))
    extra = orders.filter(k % 89 == 0).withColumn("k", -k - 1)
    return checks.table_diff(orders, copy.unionByName(extra).unionByName(
        copy.filter(k % 83 == 0)), "k", ["v"])


#: key ranges that two copies of a table are compared in
DIFF_RANGES = 256


def _copies(spark, sf):
    """Orders and a copy that went wrong in two stretches of keys: prices changed,
    keys gone, keys new, rows there twice."""
    orders = _t(spark, sf, "orders", "o_orderkey", "o_totalprice").select(
        F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"))
    k = F.col("k")
    bad = F.floor(k / 100) % 31 == 7
    copy = orders.filter(~bad | (k % 7 != 0)).withColumn(
        "v", F.when(bad & (k % 5 == 0), F.col("v") + 1).otherwise(F.col("v")))
    extra = orders.filter(bad & (k % 11 == 0)).withColumn("k", -k - 1)
    return orders, copy.unionByName(extra).unionByName(copy.filter(bad & (k % 13 == 0)))


def _compared(spark, sf):
    """The two copies, their range expression and the ranges that differ."""
    left, right = _copies(spark, sf)
    low, high = left.agg(F.min("k"), F.max("k")).first()
    leaf = audits.key_range("k", low or 0, high or 0, DIFF_RANGES)
    trees = []
    for rows in (left, right):
        tree = audits.DigestTree(spark, scratch_dir(spark, "digests"))
        tree.build(rows, "k", ["v"], leaf)
        trees.append(tree)
    return left, right, leaf, trees[0].differing(trees[1])


def table_diff_tree(spark, sf):
    """D4 by a digest tree: the copies' ranges are compared from wide to narrow,
    rows are compared only in the ranges that differ."""
    left, right, leaf, ranges = _compared(spark, sf)
    return audits.table_diff_in_ranges(left, right, "k", ["v"], leaf, ranges)


def diff_ranges(spark, sf):
    """The key ranges in which the two copies differ."""
    return _compared(spark, sf)[3]


def _produced_consumed(spark, sf):
    """Events as (bus partition, offset): some never consumed, some never
    produced, some on both sides more than once."""
    log = _t(spark, sf, "events", "event_id", "user_id").select(
        F.pmod(F.col("user_id"), F.lit(BUS_PARTITIONS)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"))
    o = F.col("offset")
    produced = log.filter(o % 10 != 3)
    consumed = log.filter(o % 7 != 2)
    return (produced.unionByName(produced.filter(o % 11 == 4)),
            consumed.unionByName(consumed.filter(o % 5 == 0))
            .unionByName(consumed.filter(o % 55 == 15)))


def loss_audit_bitmaps(spark, sf):
    """D3 by bitmaps of offsets, per bus partition."""
    out = audits.loss_audit_bitmaps(*_produced_consumed(spark, sf))
    return out.withColumnRenamed("part", "partition")


def lost_offsets(spark, sf):
    """D3: every offset that was produced and never consumed, read off the bitmaps."""
    return audits.lost_offsets(*_produced_consumed(spark, sf)).withColumnRenamed("part", "partition")


# ---------------------------------------------------------------- streaming

#: segment files that a micro-batch of the bus twin takes at most
FILES_PER_TRIGGER = 4


class _Flaky(tables.KeyedUpsertTable):
    """A sink that is down for the first two writes of every epoch."""

    def write_epoch(self, batch, epoch):
        self.failed = getattr(self, "failed", {})
        self.failed[epoch] = self.failed.get(epoch, 0) + 1
        if self.failed[epoch] <= 2:
            raise OSError("sink down")
        super().write_epoch(batch, epoch)


def _stream_into(spark, sf, lose_commit: bool = False, progress: ProgressLog | None = None,
                 sink_type: type = tables.KeyedUpsertTable):
    """Events published to the bus twin, then streamed: parse -> foreachBatch upsert.

    With ``lose_commit`` the checkpoint loses its last commit, as in a crash
    between the batch's writes and its commit, and the job starts again: the
    engine replays that batch from the source.
    """
    bus = scratch_dir(spark, "bus")
    publish_bus(_t(spark, sf, "events"), bus)

    def records():
        src = file_stream(spark, bus, BUS_SCHEMA, max_files_per_trigger=FILES_PER_TRIGGER)
        return build_stream(src, EVENT_MESSAGE, offset_col="offset")

    # versions are ordered by the message offset: segments may arrive in any order
    sink = sink_type(spark, scratch_dir(spark, "created_users"), "id",
                     order_cols=["_offset"], global_order=True)
    metrics = tables.ParquetTable(spark, scratch_dir(spark, "batch_metrics"))
    proc = BatchProcessor(sink, metrics, clock_ms=lambda: BATCH_START_MS, sleep=lambda s: None)
    ckpt = scratch_dir(spark, "stream_ckpt")
    run_available_now(spark, records(), proc, ckpt, progress)
    if lose_commit:
        forget_last_commit(spark, ckpt)
        run_available_now(spark, records(), proc, ckpt)
    return sink, metrics


def stream_enrich(spark, sf):
    """The streaming job over the published events."""
    sink, _ = _stream_into(spark, sf)
    return sink.read(["event_type", "value", "event_ts_ms", "spark_processed_at", "latency_ms"]) \
        .withColumn("spark_processed_at", F.col("spark_processed_at").isNotNull())


def stream_replay(spark, sf):
    """The last commit is lost, the job restarts and replays that batch."""
    sink, _ = _stream_into(spark, sf, lose_commit=True)
    return sink.read(["event_type", "value", "event_ts_ms", "latency_ms"])


def stream_retry(spark, sf):
    """K6: every epoch's write fails twice and succeeds at the third attempt."""
    sink, metrics = _stream_into(spark, sf, sink_type=_Flaky)
    counted = metrics.read().agg(F.sum("rows")).first()[0]
    return sink.read(["event_type", "value"]).withColumn(
        "counted", F.lit(counted).cast("long"))


def batch_metrics(spark, sf):
    """Per-epoch metrics of the streaming job, summed; a replay counts once."""
    _, metrics = _stream_into(spark, sf, lose_commit=True)
    return metrics.read().agg(F.sum("rows").cast("long").alias("rows"),
                              F.sum("measured").cast("long").alias("measured"),
                              F.max("p_max").alias("p_max"))


def stream_progress(spark, sf):
    """The listener's table of the streaming job: rows and triggers."""
    progress = ProgressLog(spark, scratch_dir(spark, "progress"))
    _stream_into(spark, sf, progress=progress)
    timed = (F.col("trigger_ms") > 0) & (F.col("write_ms") <= F.col("trigger_ms")) \
        & (F.col("rows_per_sec") > 0)
    return progress.read().agg(F.sum("rows").alias("rows"),
                               (F.count_if(timed) == F.count(F.lit(1))).alias("timed"))


QUERIES: dict[str, Query] = {
    "api_flatten": api_flatten,
    "batch_metrics": batch_metrics,
    "count_all": count_all,
    "count_footer": count_footer,
    "count_by_dim": count_by_dim,
    "count_by_flat": count_by_flat,
    "count_filtered_dim": count_filtered_dim,
    "count_filtered_flat": count_filtered_flat,
    "delivery_counters": delivery_counters,
    "delivery_expected": delivery_expected,
    "delivery_ratios": delivery_ratios,
    "diff_ranges": diff_ranges,
    "dim_seed": dim_seed,
    "expectations": expectations,
    "fact_dim_left": fact_dim_left,
    "flat_refresh": flat_refresh,
    "gen_expectations": gen_expectations,
    "gen_fact_series": gen_fact_series,
    "gen_users": gen_users,
    "insert_filtered": insert_filtered,
    "insert_if_absent": insert_if_absent,
    "join_by_statistics": join_by_statistics,
    "json_parse": json_parse,
    "json_roundtrip": json_roundtrip,
    "key_partition_check": key_partition_check,
    "latency_enrich": latency_enrich,
    "latency_sketch": latency_sketch,
    "latency_stats": latency_stats,
    "loss_audit": loss_audit,
    "loss_audit_bitmaps": loss_audit_bitmaps,
    "lost_offsets": lost_offsets,
    "mark_sent": mark_sent,
    "mv_build": mv_build,
    "mv_incremental": mv_incremental,
    "mv_read": mv_read,
    "mv_unique_check": mv_unique_check,
    "offset_totals": offset_totals,
    "offset_totals_footer": offset_totals_footer,
    "outbox_claim": outbox_claim,
    "outbox_claim_ledger": outbox_claim_ledger,
    "point_lookup": point_lookup,
    "point_lookup_indexed": point_lookup_indexed,
    "rejected_records": rejected_records,
    "resolve_dim_key": resolve_dim_key,
    "scan_fact": scan_fact,
    "spread_chunks": spread_chunks,
    "stream_enrich": stream_enrich,
    "stream_progress": stream_progress,
    "stream_replay": stream_replay,
    "stream_retry": stream_retry,
    "table_diff": table_diff,
    "table_diff_tree": table_diff_tree,
    "to_message": to_message,
    "union_sources": union_sources,
    "upsert_compacted": upsert_compacted,
    "upsert_latest": upsert_latest,
    "validity_split": validity_split,
}
