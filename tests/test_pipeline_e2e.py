"""The whole pipeline on Spark: ingest -> publish -> stream -> keyed sink,
checked with the loss audit (nothing lost, nothing extra) and the metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from keyflow.operators.checks import loss_audit
from keyflow.operators.tables import KeyedUpsertTable, ParquetTable
from keyflow.plans import jobs
from keyflow.schemas import USER_MESSAGE
from keyflow.sources.generator import gender_dimension
from keyflow.sources.stream import file_stream
from keyflow.streaming.job import BatchProcessor, build_stream, run_available_now

FRAME = "key binary, value binary"


def test_end_to_end(spark, tmp):
    layout = jobs.new_layout(spark, f"{tmp}/tables", gender_dimension(spark))
    jobs.ingest(spark, layout, None, n_synthetic=700, now_ms=1_000)
    bus = f"{tmp}/bus"
    send = jobs.file_bus_sender(bus)
    r1 = jobs.publish(spark, layout, send, batch_size=500, now_ms=2_000).first()
    assert r1.sent == 500

    sink = KeyedUpsertTable(spark, f"{tmp}/created_users", "id", order_cols=["event_ts_ms"])
    metrics = ParquetTable(spark, f"{tmp}/metrics")
    proc = BatchProcessor(sink, metrics, clock_ms=lambda: 2_500, accuracy=1_000_000)
    schema = spark.createDataFrame([], FRAME).schema

    def run():
        src = file_stream(spark, bus, schema)
        run_available_now(spark, build_stream(src, USER_MESSAGE), proc, f"{tmp}/ckpt")

    run()
    r2 = jobs.publish(spark, layout, send, batch_size=500, now_ms=3_000).first()
    assert r2.sent == 200
    run()  # the second publish arrives as the next epoch

    sent_ids = layout.ledger.read().select("id")
    audit = loss_audit(sent_ids, sink.read().select("id"), "id").first()
    assert (audit.missing, audit.extra, audit.duplicated) == (0, 0, 0)
    rows = sink.read()
    assert rows.count() == 700
    lat = {r.latency_ms for r in rows.select("latency_ms").distinct().collect()}
    assert lat == {500.0, -500.0}  # stamped at 2000 and 3000, processed at 2500
    m = sorted((r.epoch_id, r.rows, r.measured) for r in metrics.read().collect())
    assert m == [(0, 500, 500), (1, 200, 200)]
    # sink rows carry the message fields of the fact rows they came from
    fact = layout.fact.read().select("id", "email")
    assert rows.join(fact, ["id", "email"], "left_anti").count() == 0
    assert rows.filter(F.col("spark_processed_at").isNull()).count() == 0


def test_command_line_jobs(spark, tmp, capsys):
    from keyflow.__main__ import main

    root = f"{tmp}/app"
    # every scheduled run adds new users
    assert main(["ingest", "--root", root, "--n", "70"])["inserted"] == 70
    assert main(["ingest", "--root", root, "--n", "50"])["inserted"] == 50
    pub = main(["publish", "--root", root, "--bus", f"{root}/bus", "--batch-size", "100"])
    assert pub["sent"] == 100 and pub["invalid"] == 0
    out = main(["stream", "--root", root, "--bus", f"{root}/bus", "--available-now"])
    assert out["last_batch"]["rows"] == 100
    cmp_ = main(["compare", "--root", root])
    assert cmp_["flat_count"] == cmp_["fact_count"] == [{"cnt": 120}]
    assert sum(r["cnt"] for r in cmp_["rollup_read"]) == 120
    # the dimension is seeded once: running again adds no second copy
    assert spark.read.parquet(f"{root}/dim_gender").count() == 2
