"""Composite jobs: ingest, publish, layout compare."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from keyflow.operators import aggregates as agg
from keyflow.plans import jobs
from keyflow.schemas import USER_MESSAGE
from keyflow.operators.messages import parse_messages
from keyflow.sources.api import parse_payloads
from keyflow.sources.generator import gender_dimension


def _payloads(spark):
    person = {
        "name": {"first": "Ana", "last": "Lima"}, "gender": "female",
        "location": {"street": {"number": 12, "name": "Rua A"}, "city": "Rio", "state": "RJ",
                     "country": "Brazil", "postcode": 20000},
        "email": "ana@x", "login": {"username": "ana1"}, "dob": {"date": "1990-01-01"},
        "registered": {"date": "2020-01-01"}, "phone": "1", "picture": {"medium": "p"},
    }
    odd = dict(person, gender="unknown", login={"username": "odd1"})
    return parse_payloads(spark.createDataFrame([(json.dumps({"results": [person, odd]}),)],
                                                "value string"))


@pytest.mark.parametrize("bucketed", [False, True])
def test_ingest_publish_compare(spark, tmp, bucketed):
    dim = gender_dimension(spark)
    layout = (jobs.new_bucketed_layout(spark, tmp, dim, 4, prefix=f"kf{abs(hash(tmp))}")
              if bucketed else jobs.new_layout(spark, tmp, dim))
    first = jobs.ingest(spark, layout, _payloads(spark), n_synthetic=300, now_ms=1, run_id="one")
    assert first.count() == 302
    assert layout.fact.read().filter(F.col("gender_id").isNull()).count() == 1  # unknown code
    again = jobs.ingest(spark, layout, _payloads(spark), n_synthetic=300, now_ms=1, run_id="one")
    assert again.count() == 0 and layout.fact.read().count() == 302  # same ids: nothing new

    sent_frames = []
    report = jobs.publish(spark, layout, sent_frames.append, batch_size=200, now_ms=77).first()
    assert (report.sent, report.invalid, report.failed, report.total) == (200, 0, 0, 200)
    assert report.success_pct == 100.0 and report.recovery_pct == 100.0 and report.avg_retries == 0.0
    assert report.throughput >= 0
    msgs = parse_messages(sent_frames[0], USER_MESSAGE)
    assert msgs.count() == 200 and {r.event_ts_ms for r in msgs.collect()} == {77}
    assert layout.ledger.read().count() == 200

    second = jobs.publish(spark, layout, sent_frames.append, batch_size=200, now_ms=78).first()
    assert second.sent + second.invalid == 102  # only the rest is claimed
    ids1 = {r.id for r in parse_messages(sent_frames[0], USER_MESSAGE).collect()}
    ids2 = {r.id for r in parse_messages(sent_frames[1], USER_MESSAGE).collect()}
    assert not ids1 & ids2 and len(ids1 | ids2) == 302
    # the unknown-gender row is sent with a NULL gender (left join keeps it)
    genders = [r.gender for r in parse_messages(sent_frames[1], USER_MESSAGE).collect()] + \
              [r.gender for r in parse_messages(sent_frames[0], USER_MESSAGE).collect()]
    assert genders.count(None) == 1

    jobs.refresh_flat(layout)
    jobs.refresh_rollup(layout)
    out = {k: [tuple(r) for r in v.collect()] for k, v in jobs.layout_compare(layout).items()}
    assert out["flat_count"] == out["fact_count"] == [(302,)]
    assert out["flat_filtered"] == out["fact_filtered"]
    flat = dict(out["flat_group"])
    dimg = dict(out["fact_group"])
    assert flat[None] == 1 and None not in dimg
    assert flat["male"] == dimg["Male"] and flat["female"] == dimg["Female"]
    assert out["rollup_read"] == out["fact_group"]


def test_publish_at_least_once_marks_after_send(spark, tmp):
    layout = jobs.new_layout(spark, tmp, gender_dimension(spark))
    jobs.ingest(spark, layout, None, n_synthetic=20, now_ms=1)

    def broken(frame):
        raise OSError("bus down")

    waits = []
    try:
        jobs.publish(spark, layout, broken, batch_size=10, mark_before_send=False,
                     sleep=waits.append)
    except OSError:
        pass
    assert not layout.ledger.exists()  # nothing marked: the next run sends them
    assert waits == [1.0, 2.0]
    failed = agg.delivery_counters(layout.delivery.read()).first()
    assert (failed.sent, failed.failed, failed.retries) == (0, 10, 30)
    try:
        jobs.publish(spark, layout, broken, batch_size=10, mark_before_send=True,
                     sleep=waits.append)
    except OSError:
        pass
    assert layout.ledger.read().count() == 10  # marked first: at most once


def test_late_rows_are_published(spark, tmp):
    """Rows that land with an older time than what was already sent are sent too."""
    layout = jobs.new_layout(spark, tmp, gender_dimension(spark))
    jobs.ingest(spark, layout, None, n_synthetic=10, now_ms=1)
    frames = []
    assert jobs.publish(spark, layout, frames.append, batch_size=60).first().sent == 10
    late = jobs.ingest(spark, jobs.new_layout(spark, f"{tmp}/late", layout.dim), None,
                       n_synthetic=10, now_ms=1)
    layout.fact.append(late.withColumn("ingested_at",
                                       F.col("ingested_at") - F.expr("interval 1 hour")))
    assert jobs.publish(spark, layout, frames.append, batch_size=60).first().sent == 10
    assert jobs.publish(spark, layout, frames.append, batch_size=60).first().sent == 0
    sent = [r.id for f in frames for r in parse_messages(f, USER_MESSAGE).collect()]
    assert len(sent) == len(set(sent)) == 20


def test_every_run_adds_new_users(spark, tmp):
    layout = jobs.new_layout(spark, tmp, gender_dimension(spark))
    for _ in range(2):
        assert jobs.ingest(spark, layout, None, n_synthetic=30, now_ms=1).count() == 30
    assert layout.fact.read().select("id").distinct().count() == 60
    # a run can be repeated by its id: nothing new
    assert jobs.ingest(spark, layout, None, n_synthetic=30, now_ms=1, run_id="r").count() == 30
    assert jobs.ingest(spark, layout, None, n_synthetic=30, now_ms=1, run_id="r").count() == 0


def test_a_send_that_fails_twice(spark, tmp):
    layout = jobs.new_layout(spark, tmp, gender_dimension(spark))
    jobs.ingest(spark, layout, None, n_synthetic=5, now_ms=1)
    calls = []

    def flaky(frame):
        calls.append(1)
        if len(calls) < 3:
            raise OSError("bus down")

    r = jobs.publish(spark, layout, flaky, batch_size=5, sleep=lambda s: None).first()
    assert (r.sent, r.failed, r.retries, r.retried) == (5, 0, 10, 5)
    row = r.asDict()
    assert [v for k, v in row.items() if "recover" in k] == [100.0]


def test_the_deployed_layout_shuffles_no_big_table(spark, tmp):
    """What the command line declares: the claim, the sent flag and the flat refresh."""
    from keyflow.operators import outbox, tables

    from .test_plans import _plan

    layout = jobs.declared_layout(spark, f"{tmp}/t", gender_dimension(spark), buckets=4)
    assert layout.fact.read().count() == 0  # declared, not yet written
    jobs.ingest(spark, layout, None, n_synthetic=60, now_ms=1)
    jobs.publish(spark, layout, lambda frame: frame.count(), batch_size=20)
    jobs.refresh_flat(layout)
    jobs.ingest(spark, layout, None, n_synthetic=30, now_ms=1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact, ledger = layout.fact.read(), layout.ledger.read()
        cols = ["id", F.col("gender_id").alias("g")]
        refresh = tables.anti_join(fact.select(*cols), layout.flat.read().select("id"), "id")
        claim = outbox.claim(fact, ledger, 10, ["ingested_at", "id"], [F.col("id")], key="id")
        for df in (outbox.unsent(fact, ledger), refresh, claim):
            assert "Exchange hashpartitioning" not in _plan(df)
        flagged = outbox.with_sent_flag(fact, ledger)
        assert "Exchange hashpartitioning" not in _plan(flagged)
        assert flagged.filter("sent").count() == 20 and refresh.count() == 30
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # another session declares the same tables over the same files
    again = jobs.declared_layout(spark, f"{tmp}/t", layout.dim, buckets=16)
    assert again.fact.buckets == 4 and again.fact.read().count() == 90


@pytest.mark.parametrize("crash", ["before", "during", "after"])
def test_a_repeated_run_is_counted_once(spark, tmp, crash, monkeypatch):
    """An ingest that breaks off around its append is run again under its name."""
    layout = jobs.declared_layout(spark, f"{tmp}/t", gender_dimension(spark), buckets=2)
    jobs.ingest(spark, layout, None, n_synthetic=20, now_ms=1)
    append = layout.fact.append

    def broken(rows):
        if crash != "before":
            append(rows if crash == "after" else rows.limit(7))
        raise OSError("lost")

    monkeypatch.setattr(layout.fact, "append", broken)
    with pytest.raises(OSError):
        jobs.ingest(spark, layout, None, n_synthetic=30, now_ms=1, run_id="run")
    monkeypatch.setattr(layout.fact, "append", append)
    left = {"before": 30, "during": 23, "after": 0}[crash]
    assert jobs.ingest(spark, layout, None, n_synthetic=30, now_ms=1, run_id="run").count() == left
    assert layout.fact.read().count() == layout.fact.read().select("id").distinct().count() == 50
    jobs.refresh_rollup(layout)
    quick = layout.rollup.read().collect()
    jobs.refresh_rollup(layout, rescan=True)
    assert layout.rollup.read().collect() == quick and sum(r.cnt for r in quick) == 50


def test_relational_users_and_mirror(spark, tmp, monkeypatch):
    """The command line's relational source and mirror; no database here, so the
    options and the rows that would cross are looked at."""
    from keyflow import __main__ as cli

    asked, written = [], []
    users = spark.createDataFrame([("r1", "Ana", "Lima", "female", "a@x"), ("r2", "Bo", "Li", "male", None)],
                                  "id string, first_name string, last_name string, gender string, email string")
    monkeypatch.setattr(cli, "read_jdbc", lambda s, **kw: asked.append(kw) or users)
    monkeypatch.setattr(jobs, "write_jdbc", lambda df, url, table, **kw: written.append(
        (sorted(r.id for r in df.collect()), url, table, kw)))
    monkeypatch.setattr(cli, "build_session", lambda **kw: spark)
    split = ["--jdbc-split", "n", "0", "99", "4"]
    out = cli.main(["ingest", "--root", tmp, "--n", "3", "--jdbc", "jdbc:x", "--jdbc-table", "u", *split])
    assert out["inserted"] == 5
    assert asked == [{"url": "jdbc:x", "table": "u", "partition_column": "n", "lower": 0, "upper": 99,
                      "num_partitions": 4}]
    cli.main(["compare", "--root", tmp, "--jdbc", "jdbc:x"])
    ids, url, table, kw = written[0]
    assert len(ids) == 5 and {"r1", "r2"} <= set(ids) and (url, table) == ("jdbc:x", "users_baseline")


def test_file_stream_takes_files_or_bytes(spark, tmp):
    from keyflow.sources.stream import file_stream

    schema = spark.createDataFrame([], "v long").schema
    spark.range(10).toDF("v").repartition(5).write.parquet(f"{tmp}/in")
    with pytest.raises(ValueError):
        file_stream(spark, f"{tmp}/in", schema, max_files_per_trigger=1, max_bytes_per_trigger=1000)
    sizes = []
    q = (file_stream(spark, f"{tmp}/in", schema, max_bytes_per_trigger=1).writeStream
         .foreachBatch(lambda df, e: sizes.append(df.count())).trigger(availableNow=True)
         .option("checkpointLocation", f"{tmp}/c").start())
    q.awaitTermination()
    assert len(sizes) >= 3 and sum(sizes) == 10  # a file at a time, not all at once
