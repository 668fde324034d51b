"""Incremental rollup, key filter, indexed tables, footer aggregates, used statistics,
rejected messages."""

from __future__ import annotations

import random
import uuid

import pytest
from pyspark.sql import functions as F

from keyflow.operators import indexed, keyfilter, messages, rollups, tables
from keyflow.schemas import EVENT_MESSAGE

from .test_plans import _plan


# ------------------------------------------------------------------ rollup

def _keys(spark, *keys):
    return spark.createDataFrame([(k,) for k in keys], "fk int")


def _counts(mv):
    return {r.fk: r.cnt for r in mv.counts().collect()}


def test_incremental_counts_equal_a_full_count(spark, tmp):
    rng = random.Random(5)
    mv = rollups.IncrementalRollup(spark, f"{tmp}/mv", "fk")
    with pytest.raises(ValueError):
        mv.counts()
    rows, done = [], {}
    for step in range(12):
        name = f"b{rng.randrange(6)}" if step % 3 == 2 else f"c{step}"
        batch = done.setdefault(name, [rng.choice([None, 1, 2, 3]) for _ in range(rng.randrange(9))])
        mv.add(name, _keys(spark, *batch))  # again: the same batch is replayed
        if step % 4 == 1:
            mv.fold()
        rows = [k for b in done.values() for k in b]
        assert _counts(mv) == {k: rows.count(k) for k in set(rows)}
    mv.fold()
    mv.fold()
    assert _counts(mv) == {k: rows.count(k) for k in set(rows)}


def test_a_fold_reads_new_batches_only(spark, tmp):
    mv = rollups.IncrementalRollup(spark, f"{tmp}/mv", "fk", keep=2)
    for b in ("x", "y"):
        mv.add(b, _keys(spark, 1, 1, 2))
    mv.fold()
    mv.add("a-late-one", _keys(spark, 3))
    files = mv.counts().inputFiles()
    assert any("/delta/a-late-one/" in f for f in files) and any("/base/" in f for f in files)
    assert not any("/delta/x/" in f or "/delta/y/" in f for f in files)
    for b in ("p", "q", "r"):
        mv.fold()
        mv.add(b, _keys(spark, 2))
    assert _counts(mv) == {1: 4, 2: 5, 3: 1}
    dim = spark.createDataFrame([(1, "one"), (2, "two")], "pk int, name string")
    assert mv.read(dim, "pk", "name").collect() == [("two", 5), ("one", 4)]


# ------------------------------------------------------------------ key filter

@pytest.mark.parametrize("kind", ["long", "string"])
def test_the_key_filter_loses_no_key(spark, kind):
    keys = spark.range(20_000).select((F.col("id") * 7919).cast(kind).alias("k"))
    keys = keys.unionByName(spark.createDataFrame([(None,)], f"k {kind}"))
    blocks = keyfilter.blocks_for(20_000)
    f = keyfilter.key_filter(keys, "k", blocks)
    assert f.count() <= blocks
    held = keyfilter.may_hold(keys, "k", f, blocks)
    assert held.filter("k is not null").count() == 20_000 and held.filter("k is null").count() == 0
    others = spark.range(50_000).select((-F.col("id") - 1).cast(kind).alias("k"))
    assert keyfilter.may_hold(others, "k", f, blocks).count() < 0.03 * 50_000
    none = keyfilter.key_filter(keys.limit(0), "k", blocks)
    assert keyfilter.may_hold(keys, "k", none, blocks).count() == 0
    with pytest.raises(ValueError):
        keyfilter.key_filter(keys, "k", keyfilter.MOST_BLOCKS + 1)
    assert keyfilter.blocks_for(10**12) == keyfilter.MOST_BLOCKS


def test_a_filtered_insert_gives_the_same_rows(spark, tmp):
    rng = random.Random(8)
    target = spark.createDataFrame([(f"u{i}", -1) for i in rng.sample(range(5000), 2000)],
                                   "id string, n int")
    load = spark.createDataFrame([(f"u{rng.randrange(5000)}", i) for i in range(800)]
                                 + [(None, 1), (None, 2)], "id string, n int")
    target.write.parquet(f"{tmp}/t")
    load.write.parquet(f"{tmp}/l")
    target, load = spark.read.parquet(f"{tmp}/t"), spark.read.parquet(f"{tmp}/l")
    plain = tables.insert_if_absent(target, load, "id", "n")
    quick = tables.insert_if_absent(target, load, "id", "n", filter_blocks=64)
    assert sorted(map(str, plain.collect())) == sorted(map(str, quick.collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(tables.insert_if_absent(target, load, "id", "n", filter_blocks=64))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # above the target's scan: the filter's join, and only then the shuffle by id
    scan = plan.index("/t]")
    above = plan[:scan]
    assert above.rindex("Exchange hashpartitioning(id") < above.rindex("BroadcastHashJoin")
    assert "getbit" in above[above.rindex("BroadcastHashJoin"):]


# ------------------------------------------------------------------ indexed table

def _rows_read(df):
    """What the scan handed on (its row groups' rows), from the plan's own metrics."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []
    while True:
        if plan.nodeName().startswith("Scan parquet"):
            return plan.metrics().apply("numOutputRows").value()
        found.append(plan.nodeName())
        plan = plan.children().apply(0)


def test_a_lookup_reads_one_row_group(spark, tmp):
    n = 200_000
    rows = spark.range(n).select((F.col("id") * 2).alias("k"), F.sha2(F.col("id").cast("string"), 256)
                                 .alias("v")).orderBy(F.rand(3))
    indexed.write_indexed(rows, f"{tmp}/t", "k", files=4, distinct=5000, row_group=1 << 19)
    one = indexed.lookup(spark, f"{tmp}/t", "k", [123_456], ["k", "v"])
    assert 0 < _rows_read(one) <= n / 10
    assert [r.k for r in one.collect()] == [123_456]
    # an odd key lies inside the ranges, but no filter admits it
    assert _rows_read(indexed.lookup(spark, f"{tmp}/t", "k", [123_457], ["k"])) == 0
    # later writes overlap in their ranges: the filters tell the files apart
    odd = rows.select((F.col("k") + 1).alias("k"), "v")
    indexed.write_indexed(odd, f"{tmp}/t", "k", files=4, distinct=5000, row_group=1 << 19, mode="append")
    two = indexed.lookup(spark, f"{tmp}/t", "k", [123_456], ["k", "v"])
    assert 0 < _rows_read(two) <= n / 10
    many = indexed.lookup(spark, f"{tmp}/t", "k", [4, 5, 399_999, -1], ["k"])
    assert sorted(r.k for r in many.collect()) == [4, 5, 399_999]


# ------------------------------------------------------------------ footers, statistics

def test_counts_and_maxima_come_from_footers(spark, tmp):
    (spark.range(1000).select("id", (F.col("id") % 3).alias("part"))
     .write.partitionBy("part").parquet(f"{tmp}/t"))
    table = indexed.footer_reader(spark).read.parquet(f"{tmp}/t")
    count = table.agg(F.count(F.lit(1)).alias("n"))
    ends = table.groupBy("part").agg((F.max("id") + 1).alias("end"))
    for df, what in ((count, "PushedAggregation: [COUNT(*)]"), (ends, "PushedAggregation: [MAX(id)]")):
        assert what in df._jdf.queryExecution().toString()
    assert count.collect() == [(1000,)]
    assert sorted(ends.collect()) == [(0, 1000), (1, 998), (2, 999)]
    # the session at hand goes on as it was
    assert "PushedAggregation" not in spark.read.parquet(f"{tmp}/t").agg(
        F.count(F.lit(1)))._jdf.queryExecution().toString()


def test_analyze_changes_the_plan_of_a_join(spark, tmp):
    """Most values lie far from the filter's: only the histogram knows that few rows pass."""
    own = indexed.statistics_session(spark)
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "200k")
    own.conf.set("spark.sql.adaptive.enabled", "false")
    name = uuid.uuid4().hex[:8]
    own.range(60_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"),
                             F.when(F.col("id") < 100, F.col("id") + 10**6)
                             .otherwise(F.col("id") % 1000).alias("x")) \
        .write.option("path", f"{tmp}/d").saveAsTable(f"dim_{name}")
    own.range(100_000).select((F.col("id") % 60_000).alias("k"), F.uuid().alias("w")) \
        .write.option("path", f"{tmp}/f").saveAsTable(f"fact_{name}")

    def join():
        return own.table(f"fact_{name}").join(own.table(f"dim_{name}").filter("x >= 1000000"), "k")

    before, rows = _plan(join()), sorted(map(tuple, join().collect()))
    assert "SortMergeJoin" in before
    for t, cols in (("dim", ["k", "v", "x"]), ("fact", ["k", "w"])):
        tables.analyze(own, f"{t}_{name}", cols)
    after = _plan(join())
    assert "BroadcastHashJoin" in after and "SortMergeJoin" not in after
    assert sorted(map(tuple, join().collect())) == rows and len(rows) > 0
    for t in ("dim", "fact"):
        own.sql(f"drop table {t}_{name}")


# ------------------------------------------------------------------ rejected messages

def test_every_message_is_accepted_or_refused_with_its_reason(spark, tmp):
    cases = [('{"id":"1","username":"u","value":2.5}', None), (None, "no payload"),
             ('{"id":"1","usern', "malformed"), ("not json", "malformed"), ("[1,2]", "malformed"),
             ('{"username":"u"}', "no key"), ("{}", "no key"), ('{"id":"","username":"u"}', "empty key"),
             ('{"id":"3"}', "no user"), ('{"id":"3","username":""}', "no user"),
             ('{"id":"4","username":"u","value":"text"}', None)]
    frame = spark.createDataFrame([(v, i) for i, (v, _) in enumerate(cases)], "value string, offset long")
    frame = frame.withColumn("value", F.col("value").cast("binary"))
    checked = messages.parse_with_reasons(frame, EVENT_MESSAGE, keep=["offset"])
    assert [r.reason for r in checked.orderBy("offset").collect()] == [why for _, why in cases]
    accepted, rejected = messages.write_split(checked, f"{tmp}/checked")
    assert {r.offset: (r.payload, r.reason) for r in rejected.collect()} == {
        i: c for i, c in enumerate(cases) if c[1]}
    # accepted rows are what the plain parse and the validity split let through
    plain, _ = messages.validity_split(messages.parse_messages(frame, EVENT_MESSAGE, keep=["offset"]))
    assert sorted(map(str, accepted.collect())) == sorted(map(str, plain.collect()))
    assert "Generate inline" in _plan(checked) and _plan(checked).count("from_json") == 1
