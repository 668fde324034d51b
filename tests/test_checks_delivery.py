"""Checks and audits (D1-D4), delivery metrics (A8-A11), partitioning (U1-U3),
nested payloads (S4)."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from keyflow.operators import aggregates as agg
from keyflow.operators import checks, partitioning
from keyflow.sources.api import flatten_results, parse_payloads


def test_loss_audit_counts_duplicates(spark):
    produced = spark.createDataFrame([(i,) for i in range(10)], "id long")
    consumed = spark.createDataFrame([(i,) for i in [0, 1, 1, 2, 3, 3, 3, 11]], "id long")
    r = checks.loss_audit(produced, consumed, "id").first()
    assert (r.missing, r.extra, r.duplicated) == (6, 1, 3)


def test_table_diff_null_safe(spark):
    a = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0), (4, None), (5, 5.0)], "k long, v double")
    b = spark.createDataFrame([(1, 1.0), (2, None), (3, 4.0), (4, 4.0), (6, 6.0)], "k long, v double")
    r = checks.table_diff(a, b, "k", ["v"]).first()
    assert (r.changed, r.only_left, r.only_right) == (2, 1, 1)


def test_expectations(spark):
    df = spark.createDataFrame([(1, "view"), (1, "click"), (None, "x"), (2, None)],
                               "event_id long, event_type string")
    r = checks.expectations(df, "event_id",
                            {"bad_domain": ~F.col("event_type").isin("view", "click")}).first()
    assert (r.n, r.null_event_id, r.dup_event_id, r.bad_domain) == (4, 1, 1, 1)


def test_check_rows(spark):
    df = spark.createDataFrame([(1, "view"), (None, "x")], "event_id long, event_type string")
    suite = checks.expectations(df, "event_id",
                                {"bad_domain": ~F.col("event_type").isin("view", "click")})
    rows = {r.check: r.violations for r in checks.as_check_rows(suite).collect()}
    assert rows == {"null_event_id": 1, "bad_domain": 1, "dup_event_id": 0}


def test_json_roundtrip_same(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, 2.5)], "a long, b string, c double")
    out = checks.json_roundtrip(df)
    assert all(r["__same"] for r in out.collect())


def test_delivery_counters_and_ratios(spark):
    log = spark.createDataFrame(
        [("a", 0, True), ("b", 1, True), ("c", 3, True), ("d", 2, True), ("e", 0, False)],
        "id string, failures int, valid boolean")
    c = agg.delivery_counters(log).first()
    assert (c.sent, c.failed, c.retries, c.retried, c.invalid) == (3, 1, 6, 3, 1)
    r = agg.delivery_ratios(agg.delivery_counters(log), elapsed_s=2.0).first()
    assert r.total == 4 and r.success_pct == 75.0
    assert r.recovery_pct == pytest.approx(100 * 2 / 3) and r.avg_retries == 2.0
    assert r.throughput == 1.5


def test_nothing_retried(spark):
    log = spark.createDataFrame([("a", 0, True)], "id string, failures int, valid boolean")
    r = agg.delivery_ratios(agg.delivery_counters(log)).first()
    assert (r.recovery_pct, r.avg_retries, r.success_pct) == (100.0, 0.0, 100.0)
    empty = agg.delivery_ratios(agg.delivery_counters(log.limit(0))).first()
    assert (empty.total, empty.success_pct) == (0, 0.0)


def test_expected_rates(spark):
    r = agg.expected_rates(spark.createDataFrame([(0.35,)], "p double")).first()
    assert round(100 * r.success, 1) == 95.7 and round(100 * r.recovery, 1) == 87.8
    assert round(r.retries, 2) == 1.47


def test_offset_totals(spark):
    frame = spark.createDataFrame([(0, 0), (0, 1), (0, 2), (1, 0), (1, 1)], "partition int, offset long")
    assert agg.offset_totals(frame).first().total == 5


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 1000])
def test_order_violations_match_brute_force(spark, chunk):
    rnd = random.Random(chunk)
    rows = [(rnd.choice([1, 1, 1, 2, 3]), seq, rnd.randint(0, 20)) for seq in range(60)]
    df = spark.createDataFrame(rows, "k long, seq long, ts long")
    got = {r.k: (r.n, r.out_of_order)
           for r in partitioning.order_violations(df, "k", "seq", "ts", chunk).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        ts = [t for kk, _, t in sorted(rows, key=lambda r: r[1]) if kk == k]
        want[k] = (len(ts), sum(1 for a, b in zip(ts, ts[1:]) if a > b))
    assert got == want


def test_key_partition_keeps_keys_together(spark):
    df = spark.createDataFrame([(i % 5, i) for i in range(100)], "k long, seq long")
    parted = partitioning.key_partition(df, "k", 3, "seq")
    placed = parted.select("k", F.spark_partition_id().alias("p")).distinct()
    assert placed.groupBy("k").count().filter("count > 1").count() == 0
    assert partitioning.spread(df, 4).rdd.getNumPartitions() == 4


def test_union_sources(spark):
    a = spark.createDataFrame([(1, "x")], "id long, nm string")
    b = spark.createDataFrame([(1, "x"), (2, "y")], "id long, nm string")
    assert partitioning.union_sources(a, b).count() == 3


def test_api_flatten_number_and_text_fields(spark):
    person = {
        "name": {"first": "Ana", "last": "Lima"}, "gender": "female",
        "location": {"street": {"number": 12, "name": "Rua A"}, "city": "São Paulo",
                     "state": "SP", "country": "Brazil", "postcode": 1234},
        "email": "ana@x", "login": {"username": "ana1"}, "dob": {"date": "1990-01-01"},
        "registered": {"date": "2020-01-01"}, "phone": "1", "picture": {"medium": "p"},
    }
    other = dict(person, location=dict(person["location"], postcode="AB-1"))
    payloads = [json.dumps({"results": [person, other]}), "not json"]
    df = parse_payloads(spark.createDataFrame([(p,) for p in payloads], "value string"))
    out = flatten_results(df, now_ms=5).collect()
    assert len(out) == 2
    assert out[0].address == "12 Rua A, São Paulo, SP, Brazil"
    assert sorted(r.post_code for r in out) == ["1234", "AB-1"]
    assert out[0].username == "ana1" and out[0].event_ts_ms == 5
    assert out[0].id != out[1].id


@pytest.mark.parametrize("groups", [[], ["g"]])
def test_exact_percentiles_match_brute_force(spark, groups):
    import math

    rnd = random.Random(7)
    rows = [(rnd.choice(["a", "a", "a", "b", None]), float(rnd.choice([rnd.randint(0, 50), 7])))
            for _ in range(400)] + [("b", None), ("c", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = agg.exact_percentiles(df, "v", {"p10": 0.1, "p50": 0.5, "p95": 0.95, "p100": 1.0},
                                groups, num_partitions=5).collect()
    def want(vals):
        vals = sorted(v for v in vals if v is not None)
        return {name: vals[max(1, math.ceil(p * len(vals))) - 1]
                for name, p in (("p10", 0.1), ("p50", 0.5), ("p95", 0.95), ("p100", 1.0))}
    if groups:
        expect = {}
        for g in {r[0] for r in rows}:
            vals = [v for gg, v in rows if gg == g and v is not None]
            if vals:
                expect[g] = want(vals)
        assert {r.g: {k: r[k] for k in ("p10", "p50", "p95", "p100")} for r in got} == expect
    else:
        assert {k: got[0][k] for k in ("p10", "p50", "p95", "p100")} == want([v for _, v in rows])


def test_latency_stats_exact_paths_agree(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["x", "y"]), float(rnd.randint(0, 1000)) if rnd.random() > 0.1 else None)
            for _ in range(3000)]
    df = spark.createDataFrame(rows, "t string, latency_ms double")
    # a sketch wider than the groups is exact, too
    fast = sorted(map(tuple, agg.latency_stats(df, group_cols=["t"], accuracy=1_000_000).collect()))
    slow = sorted(map(tuple, agg.latency_stats(df, group_cols=["t"], accuracy=None).collect()))
    assert fast == slow
    one = agg.latency_stats(df, accuracy=None).first()
    assert one.n == 3000 and one.measured == sum(1 for _, v in rows if v is not None)


def test_hot_group_and_hot_value(spark, tmp):
    """One group holds 60% of the rows, most of them one identical value."""
    import math

    from keyflow.operators import tables

    rows = [("hot", 5.0)] * 500 + [("hot", float(i)) for i in range(100)] + \
           [(f"k{i % 40}", float(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.p50, r.p95) for r in
           agg.exact_percentiles(df, "v", {"p50": 0.5, "p95": 0.95}, ["g"], num_partitions=6).collect()}
    for g in {r[0] for r in rows}:
        vals = sorted(v for gg, v in rows if gg == g)
        want = tuple(vals[max(1, math.ceil(p * len(vals))) - 1] for p in (0.5, 0.95))
        assert got[g] == want
    # the tiebreak spreads the hot value over several range partitions
    spread = (df.filter("g = 'hot' and v = 5.0")
                .withColumn("t", F.xxhash64(F.monotonically_increasing_id()))
                .repartitionByRange(6, "g", "v", "t")
                .select(F.spark_partition_id().alias("p")).distinct().count())
    assert spread > 1

    # keyed upsert and insert-if-absent under a hot key
    sink = tables.KeyedUpsertTable(spark, f"{tmp}/sink", "id", order_cols=["seq"])
    ev = spark.createDataFrame([("hot", i, f"v{i}") for i in range(600)] +
                               [(f"c{i}", i, "x") for i in range(50)], "id string, seq long, v string")
    sink.write_epoch(ev, 0)
    assert {r.id: r.v for r in sink.read().collect()}["hot"] == "v599"
    target = spark.createDataFrame([("c1", 0, "old")], "id string, seq long, v string")
    new = tables.insert_if_absent(target, ev, "id", "seq")
    got_new = {r.id: r.v for r in new.collect()}
    assert got_new["hot"] == "v0" and "c1" not in got_new and len(got_new) == 50


def test_table_diff_counts_rows_and_nulls(spark):
    from keyflow.operators.checks import table_diff

    sch = "k long, v string, w string"
    left = spark.createDataFrame([(1, "a", None), (1, "b", None), (2, None, "x"), (3, "c", "c"),
                                  (4, "d", "d"), (5, "e", "e")], sch)
    right = spark.createDataFrame([(1, "b", None), (1, "b", None), (2, "x", None), (3, "c", "c"),
                                   (5, "e", "e"), (5, "e", "e"), (6, "f", "f")], sch)
    r = table_diff(left, right, "k", ["v", "w"]).first()
    assert (r.changed, r.only_left, r.only_right) == (3, 1, 1)
