"""The streaming job: foreachBatch upsert, metrics, retry, restart and replay
(W1-W4, K5, K6, A7)."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from keyflow.operators.tables import KeyedUpsertTable, ParquetTable
from keyflow.schemas import USER_MESSAGE
from keyflow.sources.stream import file_stream, kafka_source_options
from keyflow.streaming.job import BatchProcessor, build_stream, run_available_now, write_with_retry


def _write_batch(spark, folder, name, recs):
    lines = [(json.dumps(r),) for r in recs]
    spark.createDataFrame(lines, "value string").coalesce(1).write.mode("overwrite") \
        .parquet(f"{folder}/{name}")


def _rec(i, ts=1000, **over):
    r = {f.name: f"{f.name}{i}" for f in USER_MESSAGE.fields}
    r["id"] = f"id{i}"
    r["event_ts_ms"] = ts
    r.update(over)
    return r


def _stream(spark, src, proc, ckpt):
    frame = file_stream(spark, f"{src}/*", spark.createDataFrame([], "value string").schema,
                        max_files_per_trigger=1)
    return run_available_now(spark, build_stream(frame, USER_MESSAGE), proc, ckpt)


def test_stream_upsert_metrics_restart(spark, tmp):
    src = f"{tmp}/in"
    _write_batch(spark, src, "b0", [_rec(1, 900), _rec(2, None), _rec(3, 800)])
    _write_batch(spark, src, "b1", [_rec(1, 950, first_name="changed"), "garbage-row"])
    sink = KeyedUpsertTable(spark, f"{tmp}/sink", "id", order_cols=["event_ts_ms"])
    metrics = ParquetTable(spark, f"{tmp}/metrics")
    proc = BatchProcessor(sink, metrics, clock_ms=lambda: 1000, accuracy=1_000_000)
    _stream(spark, src, proc, f"{tmp}/ckpt")
    rows = {r.id: r for r in sink.read().collect()}
    assert set(rows) == {"id1", "id2", "id3"}
    assert rows["id1"].first_name == "changed" and rows["id1"].latency_ms == 50.0
    assert rows["id2"].latency_ms is None and rows["id3"].latency_ms == 200.0
    m = {r.epoch_id: r for r in metrics.read().collect()}
    assert (m[0].rows, m[0].measured, m[0].p50, m[0].p95, m[0].p_max) == (3, 2, 100.0, 200.0, 200.0)
    assert (m[1].rows, m[1].measured) == (1, 1)

    # restart on the same checkpoint without new input: no batch, no new metrics
    _stream(spark, src, proc, f"{tmp}/ckpt")
    assert metrics.read().count() == 2
    # new input continues at the next epoch
    _write_batch(spark, src, "b2", [_rec(4, 990)])
    _stream(spark, src, proc, f"{tmp}/ckpt")
    assert sorted(r.epoch_id for r in metrics.read().collect()) == [0, 1, 2]
    assert sink.read().count() == 4


def test_empty_batch_skipped_and_unmeasured_batch(spark, tmp):
    sink = KeyedUpsertTable(spark, f"{tmp}/sink", "id", order_cols=["event_ts_ms"])
    metrics = ParquetTable(spark, f"{tmp}/metrics")
    proc = BatchProcessor(sink, metrics, clock_ms=lambda: 1000)
    empty = spark.createDataFrame([], USER_MESSAGE)
    proc(empty, 0)
    assert not sink.exists() and not metrics.exists()
    unmeasured = spark.createDataFrame([tuple(_rec(1, None).values())], USER_MESSAGE)
    proc(unmeasured, 1)
    m = metrics.read().first()
    assert m.rows == 1 and m.measured == 0 and m.p50 is None and m.p95 is None and m.p_max is None


def test_replay_same_epoch_keeps_table(spark, tmp):
    sink = KeyedUpsertTable(spark, f"{tmp}/sink", "id", order_cols=["event_ts_ms"])
    proc = BatchProcessor(sink, None, clock_ms=lambda: 1000)
    batch = spark.createDataFrame([tuple(_rec(i, 900).values()) for i in range(5)], USER_MESSAGE)
    proc(batch, 7)
    before = sorted(map(tuple, sink.read().collect()))
    proc(batch, 7)
    assert sorted(map(tuple, sink.read().collect())) == before
    assert sink.versions().count() == 5


def test_retry_waits_then_succeeds():
    calls, waits = [], []

    def flaky():
        calls.append(1)
        if len(calls) <= 3:
            raise OSError("sink down")

    assert write_with_retry(flaky, sleep=waits.append) == 4
    assert waits == [1.0, 2.0, 4.0]


def test_retry_gives_up_after_four():
    waits = []

    def down():
        raise OSError("sink down")

    with pytest.raises(OSError):
        write_with_retry(down, sleep=waits.append)
    assert waits == [1.0, 2.0, 4.0]


def test_failing_sink_fails_the_stream(spark, tmp):
    class Broken(KeyedUpsertTable):
        def write_epoch(self, batch, epoch):
            raise OSError("no sink")

    src = f"{tmp}/in"
    _write_batch(spark, src, "b0", [_rec(1)])
    proc = BatchProcessor(Broken(spark, f"{tmp}/sink", "id", order_cols=["event_ts_ms"]), None, sleep=lambda s: None)
    with pytest.raises(Exception, match="no sink"):
        _stream(spark, src, proc, f"{tmp}/ckpt")


def test_kafka_source_options():
    o = kafka_source_options("b:9092")
    assert o["subscribe"] == "users_created" and o["startingOffsets"] == "earliest"
    assert o["maxOffsetsPerTrigger"] == "10000"


def test_cassandra_sink_values():
    from keyflow.schemas import CREATED_USERS
    from keyflow.streaming.sinks import CassandraSink, cassandra_session_conf, cassandra_table_ddl

    conf = cassandra_session_conf(["c1", "c2", "c3"])
    assert conf["spark.cassandra.connection.host"] == "c1,c2,c3"
    assert conf["spark.cassandra.output.consistency.level"] == "QUORUM"
    cols = [(f.name, "bigint" if f.dataType.simpleString() == "bigint" else
             "double" if f.dataType.simpleString() == "double" else "text")
            for f in CREATED_USERS.fields]
    ddl = cassandra_table_ddl("spark_streams", "created_users", cols, "id",
                              {"class": "NetworkTopologyStrategy", "datacenter1": "3"})
    assert ddl[0].startswith("CREATE KEYSPACE IF NOT EXISTS spark_streams")
    assert "'datacenter1': '3'" in ddl[0]
    assert ddl[1].endswith("PRIMARY KEY (id))") and "latency_ms double" in ddl[1]
    assert CassandraSink("ks", "t").write_options() == {"keyspace": "ks", "table": "t"}


def test_processing_time_trigger_picks_up_new_files(spark, tmp):
    from keyflow.streaming.job import start_stream

    src = f"{tmp}/in"
    _write_batch(spark, src, "b0", [_rec(1, 900)])
    sink = KeyedUpsertTable(spark, f"{tmp}/sink", "id", order_cols=["event_ts_ms"])
    proc = BatchProcessor(sink, None, clock_ms=lambda: 1000)
    frame = file_stream(spark, f"{src}/*", spark.createDataFrame([], "value string").schema)
    query = start_stream(build_stream(frame, USER_MESSAGE), proc, f"{tmp}/ckpt",
                         trigger="500 milliseconds")
    try:
        query.processAllAvailable()
        _write_batch(spark, src, "b1", [_rec(2, 950)])
        query.processAllAvailable()
    finally:
        query.stop()
    assert sorted(r.id for r in sink.read().collect()) == ["id1", "id2"]


def test_flaky_sink_inside_the_stream(spark, tmp):
    class Flaky(KeyedUpsertTable):
        calls = 0

        def write_epoch(self, batch, epoch):
            Flaky.calls += 1
            if Flaky.calls <= 2:
                raise OSError("temporarily down")
            super().write_epoch(batch, epoch)

    src = f"{tmp}/in"
    _write_batch(spark, src, "b0", [_rec(1, 900), _rec(2, 800)])
    waits = []
    sink = Flaky(spark, f"{tmp}/sink", "id", order_cols=["event_ts_ms"])
    metrics = ParquetTable(spark, f"{tmp}/metrics")
    proc = BatchProcessor(sink, metrics, clock_ms=lambda: 1000, sleep=waits.append)
    _stream(spark, src, proc, f"{tmp}/ckpt")
    assert waits == [1.0, 2.0] and sink.read().count() == 2
    m = metrics.read().first()
    assert (m.rows, m.measured, m.p_max) == (2, 2, 200.0)


def test_compaction_beside_a_running_stream(spark, tmp):
    """Compacted between and during batches, even while an epoch is half written."""
    from keyflow.plans.crash import forget_last_commit

    want = KeyedUpsertTable(spark, f"{tmp}/plain", "id", order_cols=["event_ts_ms"])
    sink = KeyedUpsertTable(spark, f"{tmp}/sink", "id", order_cols=["event_ts_ms"])

    class Compacting(KeyedUpsertTable):
        def write_epoch(self, batch, epoch):
            if epoch == 1:  # a part of the epoch is visible when the table is compacted
                super().write_epoch(batch.limit(1), epoch)
                self.compact()
            super().write_epoch(batch, epoch)
            want.run = self.run
            want.write_epoch(batch, epoch)

    src = f"{tmp}/in"
    for b in range(4):
        _write_batch(spark, src, f"b{b}", [_rec(i, 900 + b, first_name=f"n{b}")
                                           for i in range(b, b + 4)])
    proc = BatchProcessor(Compacting(spark, sink.path, "id", order_cols=["event_ts_ms"]), None,
                          clock_ms=lambda: 1000)
    _stream(spark, src, proc, f"{tmp}/ckpt")
    rows = lambda t: sorted(map(str, t.read().collect()))
    assert rows(sink) == rows(want) and len(rows(sink)) == 7
    sink.compact()
    assert rows(sink) == rows(want)
    forget_last_commit(spark, f"{tmp}/ckpt")
    _stream(spark, src, proc, f"{tmp}/ckpt")  # the newest epoch once more
    assert rows(sink) == rows(want)


def test_progress_is_logged_without_a_job(spark, tmp):
    from keyflow.plans.crash import forget_last_commit
    from keyflow.streaming.progress import ProgressLog

    src = f"{tmp}/in"
    for b in range(3):
        _write_batch(spark, src, f"b{b}", [_rec(i) for i in range(5 + b)])
    metrics = ParquetTable(spark, f"{tmp}/metrics")
    proc = BatchProcessor(KeyedUpsertTable(spark, f"{tmp}/sink", "id", order_cols=["event_ts_ms"]),
                          metrics, clock_ms=lambda: 2000)
    progress = ProgressLog(spark, f"{tmp}/progress")

    def run():
        frame = file_stream(spark, f"{src}/*", spark.createDataFrame([], "value string").schema,
                            max_files_per_trigger=1)
        run_available_now(spark, build_stream(frame, USER_MESSAGE), proc, f"{tmp}/ckpt", progress)

    run()
    forget_last_commit(spark, f"{tmp}/ckpt")
    run()  # the last batch again: its report is replaced
    got = progress.read().orderBy("batch_id").collect()
    assert [(r.batch_id, r.rows) for r in got] == [(0, 5), (1, 6), (2, 7)]
    assert all(r.trigger_ms > 0 and r.write_ms <= r.trigger_ms and r.rows_per_sec > 0 for r in got)
    assert len({r.query_id for r in got}) == 1

    # the epochs' sketches merge to the percentiles over all of them
    from keyflow.operators.aggregates import merged_latency
    merged = merged_latency(metrics.read(), rows="rows").first()
    assert (merged.n, merged.measured, merged.p50, merged.p95) == (18, 18, 1000.0, 1000.0)
