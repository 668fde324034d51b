"""Command line for the pipeline's jobs (each one a Spark application).

    python -m keyflow ingest  --root DIR [--payloads PATH] [--n 5000]
                              [--jdbc URL --jdbc-table T [--jdbc-split COLUMN LOW HIGH TASKS]]
    python -m keyflow publish --root DIR (--bus DIR | --kafka HOST:PORT) [--batch-size 5000]
    python -m keyflow stream  --root DIR (--bus DIR | --kafka HOST:PORT)
                              [--cassandra HOSTS --keyspace KS --table T] [--available-now]
    python -m keyflow compare --root DIR [--jdbc URL --jdbc-table T]
    python -m keyflow audit-copy LEFT RIGHT --key COLUMN [--columns A,B]
    python -m keyflow audit-loss PRODUCED CONSUMED [--partition C] [--offset C] [--lost DIR]

``--root`` is a folder on shared storage holding the tables. A scheduler
runs ``ingest`` then ``publish`` then ``compare``; ``stream`` runs
continuously (or drains what is there with ``--available-now``). The audits take
Parquet folders: two copies of a table, or what was produced and consumed.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from keyflow.operators.partitioning import spread
from keyflow.operators.tables import ParquetTable, insert_if_absent
from keyflow.plans import jobs
from keyflow.schemas import DIM_GENDER, USER_MESSAGE
from keyflow.session import build_session, default_parallelism
from keyflow.sources.api import read_payloads
from keyflow.sources.generator import gender_dimension
from keyflow.sources.stream import file_stream, kafka_stream
from keyflow.sources.tables import read_jdbc
from keyflow.streaming.job import BatchProcessor, build_stream, run_available_now, start_stream
from keyflow.streaming.sinks import CassandraSink, cassandra_session_conf


def ensure_dimension(spark: SparkSession, root: str) -> DataFrame:
    """The gender dimension, seeded insert-if-absent on its code (K2)."""
    dim = ParquetTable(spark, f"{root}/dim_gender")
    seed = gender_dimension(spark)
    if dim.exists():
        dim.append(insert_if_absent(dim.read(), seed, "gender_code"))
    else:
        dim.overwrite(seed)
    return spark.read.schema(DIM_GENDER).parquet(dim.path)


def _send(args) -> object:
    if args.kafka:
        from keyflow.operators.messages import publish as kafka_publish
        # a claim is one file: its messages are dealt over all cores to be sent
        return lambda frame: kafka_publish(
            spread(frame, default_parallelism(frame.sparkSession)), args.kafka)
    return jobs.file_bus_sender(args.bus)


def _relational(spark: SparkSession, args) -> DataFrame | None:
    if not args.jdbc:
        return None
    split = {}
    if args.jdbc_split:
        column, low, high, tasks = args.jdbc_split
        split = {"partition_column": column, "lower": int(low), "upper": int(high),
                 "num_partitions": int(tasks)}
    return read_jdbc(spark, url=args.jdbc, table=args.jdbc_table or "users_raw", **split)


def _audit(spark: SparkSession, args) -> dict:
    if args.cmd == "audit-copy":
        columns = args.columns.split(",") if args.columns else None
        return jobs.audit_copy(spark.read.parquet(args.left), spark.read.parquet(args.right),
                               args.key, columns)
    rows = jobs.audit_loss(spark.read.parquet(args.produced), spark.read.parquet(args.consumed),
                           args.partition, args.offset, args.lost)
    return {"partitions": rows}


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="keyflow")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("ingest", "publish", "stream", "compare"):
        p = sub.add_parser(name)
        p.add_argument("--root", required=True)
        p.add_argument("--buckets", type=int, default=8,
                       help="buckets of the tables keyed by id, when the root is new")
        if name in ("ingest", "compare"):
            p.add_argument("--jdbc", help="relational source of users; mirror of the flat table")
            p.add_argument("--jdbc-table")
        if name == "ingest":
            p.add_argument("--jdbc-split", nargs=4, metavar=("COLUMN", "LOW", "HIGH", "TASKS"))
            p.add_argument("--payloads")
            p.add_argument("--n", type=int, default=jobs.SYNTHETIC_BATCH)
        if name in ("publish", "stream"):
            p.add_argument("--bus")
            p.add_argument("--kafka")
        if name == "publish":
            p.add_argument("--batch-size", type=int, default=jobs.CLAIM_BATCH)
        if name == "stream":
            p.add_argument("--cassandra")
            p.add_argument("--keyspace", default="spark_streams")
            p.add_argument("--table", default="created_users")
            p.add_argument("--available-now", action="store_true")
            p.add_argument("--max-files", type=int,
                           help="files that a micro-batch of --bus takes at most")
            p.add_argument("--max-bytes", type=int, default=1 << 30,
                           help="bytes that it takes at most, where no --max-files is given")
    for name, sides in (("audit-copy", ("left", "right")), ("audit-loss", ("produced", "consumed"))):
        p = sub.add_parser(name)
        for side in sides:
            p.add_argument(side)
    sub.choices["audit-copy"].add_argument("--key", required=True)
    sub.choices["audit-copy"].add_argument("--columns")
    for option in ("partition", "offset"):
        sub.choices["audit-loss"].add_argument(f"--{option}", default=option)
    sub.choices["audit-loss"].add_argument("--lost", help="folder for the lost offsets")
    args = ap.parse_args(argv)

    spark = build_session(app=f"keyflow-{args.cmd}")
    if args.cmd.startswith("audit-"):
        out = {"cmd": args.cmd, **_audit(spark, args)}
        print(json.dumps(out, default=str))
        return out
    layout = jobs.declared_layout(spark, f"{args.root}/tables", ensure_dimension(spark, args.root),
                                  args.buckets)
    out: dict = {"cmd": args.cmd}
    if args.cmd == "ingest":
        payloads = read_payloads(spark, args.payloads) if args.payloads else None
        out["inserted"] = jobs.ingest(spark, layout, payloads, n_synthetic=args.n,
                                      records=_relational(spark, args)).count()
    elif args.cmd == "publish":
        if not (args.bus or args.kafka):
            ap.error("publish needs --bus or --kafka")
        out.update(jobs.publish(spark, layout, _send(args), args.batch_size).first().asDict())
    elif args.cmd == "stream":
        if args.kafka:
            source = kafka_stream(spark, args.kafka,
                                  min_partitions=default_parallelism(spark))
        elif args.bus:
            source = file_stream(spark, args.bus, spark.createDataFrame(
                [], "key binary, value binary").schema, max_files_per_trigger=args.max_files,
                max_bytes_per_trigger=None if args.max_files else args.max_bytes)
        else:
            ap.error("stream needs --bus or --kafka")
        if args.cassandra:
            sink = CassandraSink(args.keyspace, args.table,
                                 cassandra_session_conf(args.cassandra.split(",")))
        else:
            from keyflow.operators.tables import KeyedUpsertTable
            # a key stays in one bus partition, so its offsets give its order; the
            # file twin has none and is ordered by send time
            sink = KeyedUpsertTable(spark, f"{args.root}/tables/created_users", "id",
                                    order_cols=["_offset" if args.kafka else "event_ts_ms"],
                                    global_order=True)
        proc = BatchProcessor(sink, ParquetTable(spark, f"{args.root}/tables/batch_metrics"))
        # the wide-column sink takes the message's own columns only
        offset = "offset" if args.kafka and not args.cassandra else None
        records = build_stream(source, USER_MESSAGE, offset_col=offset)
        ckpt = f"{args.root}/checkpoints/stream"
        if args.available_now:
            run_available_now(spark, records, proc, ckpt)
            out["last_batch"] = proc.last_metrics
        else:
            start_stream(records, proc, ckpt).awaitTermination()
    elif args.cmd == "compare":
        jobs.refresh_flat(layout)
        jobs.refresh_rollup(layout)
        if args.jdbc:
            jobs.mirror_flat(layout, args.jdbc, args.jdbc_table or "users_baseline",
                             default_parallelism(spark))
        out.update({k: [r.asDict() for r in v.collect()]
                    for k, v in jobs.layout_compare(layout).items()})
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
