"""Message building, parsing, enrichment and validity."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from keyflow.operators.aggregates import latency_stats
from keyflow.operators.messages import (
    enrich,
    kafka_sink_options,
    parse_messages,
    stamp_send_time,
    to_message,
    validity_counts,
    validity_split,
)
from keyflow.schemas import USER_MESSAGE
from keyflow.sources.generator import generate_user_batch


def _frame(spark, payloads):
    rows = [(None if p is None else p.encode("utf-8"),) for p in payloads]
    return spark.createDataFrame(rows, "value binary")


def _user(**over):
    rec = {f.name: f"{f.name}-x" for f in USER_MESSAGE.fields}
    rec["event_ts_ms"] = 1000
    rec.update(over)
    return json.dumps(rec)


def test_malformed_payloads_dropped(spark):
    good = _user(id="a")
    bad = ["garbage", good[: len(good) // 2], "[1, 2]", "1", "", None, "{}"]
    out = parse_messages(_frame(spark, [good, *bad]), USER_MESSAGE).collect()
    assert [r.id for r in out] == ["a"]


def test_missing_timestamp_kept_with_null_latency(spark):
    rec = json.loads(_user(id="b"))
    del rec["event_ts_ms"]
    out = enrich(parse_messages(_frame(spark, [json.dumps(rec)]), USER_MESSAGE), 5000).collect()
    assert out[0].id == "b" and out[0].event_ts_ms is None and out[0].latency_ms is None


def test_bad_timestamp_types_null_but_row_kept(spark):
    variants = ['"12"', "1.5", "1e3", "123456789012345678901234"]
    payloads = [_user(id=f"v{i}").replace('"event_ts_ms": 1000', f'"event_ts_ms": {v}')
                for i, v in enumerate(variants)]
    out = parse_messages(_frame(spark, payloads), USER_MESSAGE).orderBy("id").collect()
    assert [r.id for r in out] == ["v0", "v1", "v2", "v3"]
    assert all(r.event_ts_ms is None for r in out)


def test_empty_id_kept_by_parse_rejected_by_validity(spark):
    payloads = [_user(id=""), _user(id="ok"), _user(id="n1", username=None),
                _user(id="n2", username="")]
    parsed = parse_messages(_frame(spark, payloads), USER_MESSAGE)
    assert parsed.count() == 4
    valid, invalid = validity_split(parsed)
    assert [r.id for r in valid.collect()] == ["ok"]
    assert invalid.count() == 3
    counts = {r.valid: r.cnt for r in validity_counts(parsed).collect()}
    assert counts == {True: 1, False: 3}


def test_number_and_object_ids_become_text(spark):
    out = parse_messages(_frame(spark, ['{"id": 5}', '{"id": {"a": 1}}']), USER_MESSAGE)
    assert sorted(r.id for r in out.collect()) == ['5', '{"a":1}']


def test_to_message_round_trip_and_nulls(spark):
    users = generate_user_batch(spark, 20, now_ms=99).withColumn(
        "phone", F.when(F.col("post_code") > "50000", F.lit(None)).otherwise(F.col("phone")))
    frame = to_message(users, "username")
    row = frame.first()
    rec = json.loads(row.value.decode("utf-8"))
    assert set(rec) == {f.name for f in USER_MESSAGE.fields}  # nulls written, not dropped
    assert row.key.decode("utf-8") == rec["username"]
    back = parse_messages(frame, USER_MESSAGE)
    assert back.exceptAll(users).count() == 0 and users.exceptAll(back).count() == 0


def test_enrich_latency_and_stamp(spark):
    df = spark.createDataFrame([("a", 1000), ("b", None)], "id string, event_ts_ms long")
    out = {r.id: r for r in enrich(df, 1500).collect()}
    assert out["a"].latency_ms == 500.0 and out["b"].latency_ms is None
    assert out["a"].spark_processed_at == "1970-01-01T00:00:01.500000+00:00"


def test_stamp_send_time(spark):
    df = stamp_send_time(spark.range(3), 42)
    assert {r.event_ts_ms for r in df.collect()} == {42}
    now = stamp_send_time(spark.range(1)).first().event_ts_ms
    assert now > 1_600_000_000_000


def test_latency_stats_semantics(spark):
    df = spark.createDataFrame([(10.0,), (20.0,), (30.0,), (40.0,), (None,)], "latency_ms double")
    r = latency_stats(df, accuracy=1_000_000).first()
    assert (r.n, r.measured, r.p50, r.p95, r.p_max) == (5, 4, 20.0, 40.0, 40.0)
    none = latency_stats(df.filter("latency_ms is null")).first()
    assert none.measured == 0 and none.p50 is None and none.p_max is None


def test_kafka_sink_options():
    o = kafka_sink_options("b:9092")
    assert o["kafka.acks"] == "all" and o["kafka.compression.type"] == "gzip"
    assert o["kafka.batch.size"] == "65536" and o["kafka.linger.ms"] == "20"
    assert o["topic"] == "users_created"
