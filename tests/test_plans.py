"""Plan shape of the headline queries: the scale properties, locked in."""

from __future__ import annotations

import contextlib
import io

import pytest

from __spark_entry__ import queries

from .conftest import SF_SMALL


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    keys = ["count_all", "count_filtered_dim", "point_lookup", "offset_totals",
            "key_partition_check", "outbox_claim", "api_flatten", "count_by_dim",
            "fact_dim_left"]
    return {k: _plan(queries()[k](spark, SF_SMALL)) for k in keys}


def test_count_reads_no_columns(plans):
    assert "ReadSchema: struct<>" in plans["count_all"]


def test_filters_reach_the_scan(plans):
    assert "EqualTo(n_regionkey,1)" in plans["count_filtered_dim"]
    assert "EqualTo(o_orderkey,1000)" in plans["point_lookup"]


def test_dimensions_are_broadcast(plans):
    for k in ("count_filtered_dim", "count_by_dim", "fact_dim_left", "outbox_claim"):
        assert "BroadcastHashJoin" in plans[k], k
        assert "SortMergeJoin" not in plans[k], k


def test_rollup_aggregates_before_the_join(plans):
    plan = plans["count_by_dim"]
    join_at = plan.index("BroadcastHashJoin")
    assert "HashAggregate(keys=[c_nationkey#" in plan[join_at:]


def test_claim_is_a_top_k(plans):
    assert "TakeOrderedAndProject" in plans["outbox_claim"]


def test_order_check_spreads_hot_keys(plans):
    assert "hashpartitioning(user_id#" in plans["key_partition_check"]
    assert "__chunk" in plans["key_partition_check"].split("hashpartitioning(user_id")[2]


def test_no_needless_work(plans):
    assert "RoundRobinPartitioning" not in plans["offset_totals"]
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in plans["offset_totals"]
    assert all("RoundRobinPartitioning" not in p for p in plans.values())


def test_a_flagged_bucketed_fact_is_not_shuffled(spark, tmp):
    """The sent flag and the claim over tables bucketed by the key."""
    from pyspark.sql import functions as F

    from keyflow.operators import outbox, tables

    rows = spark.range(1000).select("id", F.lit(False).alias("kafka_sent"))
    fact = tables.BucketedTable(spark, "plan_fact", f"{tmp}/fact", "id", 4)
    ledger = tables.BucketedTable(spark, "plan_ledger", f"{tmp}/ledger", "id", 4)
    fact.overwrite(rows)
    ledger.overwrite(rows.filter("id % 3 = 0").select("id", F.lit("c").alias("claim_id")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (outbox.unsent(fact.read(), ledger.read()),
                   outbox.with_sent_flag(fact.read(), ledger.read())):
            assert "Exchange hashpartitioning" not in _plan(df)
            df.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table plan_fact")
        spark.sql("drop table plan_ledger")


def test_no_size_probes():
    """No plan is chosen by counting rows first."""
    import pathlib

    for path in pathlib.Path("keyflow").rglob("*.py"):
        text = path.read_text()
        assert "limit(" not in text or ".count() <=" not in text, path
