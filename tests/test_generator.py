"""The reference's eight generator tests, on the distributed generator, plus
determinism across partitionings."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import functions as F

from keyflow.operators.checks import expectation_suite, record_violations
from keyflow.schemas import USER_MESSAGE
from keyflow.sources.generator import GENDERS, fact_series, generate_user_batch, generate_users

REQUIRED = [f.name for f in USER_MESSAGE.fields]


def test_batch_count(spark):
    for n in (1, 10, 5000):
        assert generate_user_batch(spark, n, now_ms=0).count() == n


def test_schema_has_all_13_fields(spark):
    df = generate_user_batch(spark, 50, now_ms=1)
    assert df.columns == REQUIRED
    nulls = df.select([F.count_if(F.col(c).isNull()).alias(c) for c in REQUIRED]).first()
    assert all(v == 0 for v in nulls)


def test_uuid_v4_valid(spark):
    for r in generate_user_batch(spark, 50, now_ms=1).select("id").collect():
        assert uuid.UUID(r.id).version == 4


def test_uuid_unique(spark):
    df = generate_user_batch(spark, 500, now_ms=1)
    assert df.select("id").distinct().count() == 500


def test_gender_domain(spark):
    vals = {r.gender for r in generate_user_batch(spark, 100, now_ms=1).select("gender").collect()}
    assert vals <= set(GENDERS)


def test_event_ts_ms_recent_int(spark):
    before = int(time.time() * 1000)
    df = generate_user_batch(spark, 5)
    after = int(time.time() * 1000)
    assert dict(df.dtypes)["event_ts_ms"] == "bigint"
    for r in df.select("event_ts_ms").collect():
        assert before <= r.event_ts_ms <= after


def test_json_round_trip(spark):
    for row in generate_user_batch(spark, 20, now_ms=7).collect():
        rec = row.asDict()
        back = json.loads(json.dumps(rec).encode("utf-8").decode("utf-8"))
        for k in ("id", "event_ts_ms", "username", "gender"):
            assert back[k] == rec[k]


def test_latency_non_negative(spark):
    df = generate_user_batch(spark, 10)
    start = int(time.time() * 1000)
    assert df.filter(F.lit(start) - F.col("event_ts_ms") < 0).count() == 0


def test_same_rows_for_any_partitioning(spark):
    keys1 = spark.range(0, 300, numPartitions=1).withColumnRenamed("id", "key")
    keys7 = spark.range(0, 300, numPartitions=7).withColumnRenamed("id", "key")
    a = {tuple(r) for r in generate_users(keys1, now_ms=5).collect()}
    b = {tuple(r) for r in generate_users(keys7, now_ms=5).collect()}
    assert a == b


def test_value_rules(spark):
    df = generate_user_batch(spark, 2000, now_ms=1)
    rows = df.collect()
    for r in rows[:200]:
        y, m, d = r.dob[:10].split("-")
        assert 1950 <= int(y) <= 2000 and 1 <= int(m) <= 12 and 1 <= int(d) <= 28
        assert r.dob.endswith("T00:00:00.000Z")
        assert 10000 <= int(r.post_code) <= 99999
        assert r.email == r.email.lower() and "@" in r.email
        assert r.username.startswith(r.first_name.lower()) and len(r.username) == len(r.first_name) + 4
        assert r.phone[0] == "(" and r.phone[4:6] == ") " and r.phone[9] == "-"
    suite = expectation_suite(df, record_violations(REQUIRED, domain={"gender": GENDERS})).first()
    assert suite.n == 2000 and suite.missing_field == 0 and suite.bad_uuid == 0 and suite.bad_gender == 0


def test_fact_series(spark):
    rows = fact_series(spark, 6).orderBy("g").collect()
    assert [r.dim_id for r in rows] == [2, 1, 2, 1, 2, 1]
    assert rows[1].gender == "male" and rows[0].gender == "female"
    assert rows[2].email == "u3@x.com" and rows[2].username == "user3"
