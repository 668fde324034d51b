"""Operators: every one a function from DataFrames to a DataFrame."""

from keyflow.operators.aggregates import (
    count_all,
    count_filtered,
    delivery_counters,
    delivery_ratios,
    expected_rates,
    group_count,
    latency_stats,
    offset_totals,
)
from keyflow.operators.checks import (
    expectation_suite,
    expectations,
    json_roundtrip,
    loss_audit,
    record_violations,
    table_diff,
)
from keyflow.operators.audits import (
    DigestTree,
    loss_audit_bitmaps,
    lost_offsets,
    offset_bitmaps,
    table_diff_in_ranges,
)
from keyflow.operators.indexed import footer_reader, lookup, write_indexed
from keyflow.operators.joins import anti_join, dim_join, resolve_key, semi_join
from keyflow.operators.messages import (
    enrich,
    is_valid,
    kafka_sink_options,
    parse_messages,
    stamp_send_time,
    to_message,
    validity_counts,
    validity_split,
)
from keyflow.operators.outbox import claim, ledger_rows, unsent, with_sent_flag
from keyflow.operators.partitioning import key_partition, order_violations, spread, union_sources
from keyflow.operators.rollups import IncrementalRollup
from keyflow.operators.tables import (
    KeyedUpsertTable,
    ParquetTable,
    RollupTable,
    analyze,
    duplicate_keys,
    first_per_key,
    flat_refresh,
    flat_rows,
    insert_if_absent,
    last_per_key,
    rollup,
)

__all__ = [
    "DigestTree", "IncrementalRollup", "KeyedUpsertTable", "ParquetTable", "RollupTable", "analyze", "anti_join", "claim",
    "count_all", "count_filtered", "delivery_counters", "delivery_ratios", "dim_join",
    "duplicate_keys", "enrich", "expectation_suite", "expectations", "expected_rates",
    "first_per_key", "flat_refresh", "flat_rows", "footer_reader", "group_count",
    "insert_if_absent", "is_valid", "json_roundtrip", "kafka_sink_options", "key_partition",
    "last_per_key", "latency_stats", "ledger_rows", "lookup", "loss_audit", "loss_audit_bitmaps", "lost_offsets",
    "offset_bitmaps", "offset_totals",
    "order_violations", "parse_messages", "record_violations", "resolve_key", "rollup",
    "semi_join", "spread", "stamp_send_time", "table_diff", "table_diff_in_ranges", "to_message", "union_sources",
    "unsent", "validity_counts", "validity_split", "with_sent_flag",
    "write_indexed",
]
