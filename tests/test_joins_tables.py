"""Joins (J1-J5), layout counts (A1-A4) and table maintenance."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from keyflow.operators import aggregates as agg
from keyflow.operators import joins, tables
from keyflow.schemas import TABLES, create_tables
from keyflow.sources.generator import gender_dimension


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def fact(spark):
    # 'other' is an unknown code: its FK must resolve to NULL
    return spark.createDataFrame(
        [("u1", "male"), ("u2", "female"), ("u3", "female"), ("u4", "other")],
        "id string, gender string")


def test_resolve_key_unknown_is_null(spark, fact):
    dim = gender_dimension(spark)
    out = {r.id: r.gender_id for r in joins.resolve_key(
        fact, dim, "gender", "gender_code", "gender_id", "gender_id").collect()}
    assert out == {"u1": 1, "u2": 2, "u3": 2, "u4": None}


def test_flat_null_group_vs_dim_drop(spark, fact):
    dim = gender_dimension(spark)
    resolved = joins.resolve_key(fact, dim, "gender", "gender_code", "gender_id", "gender_id")
    flat = tables.flat_rows(resolved.drop("gender"), dim, "gender_id", "gender_id",
                            ["id", F.col("gender_code").alias("gender")])
    flat_counts = [tuple(r) for r in agg.group_count(flat, "gender").collect()]
    assert flat_counts == [("female", 2), ("male", 1), (None, 1)]
    dim_counts = [tuple(r) for r in tables.rollup(resolved, dim, "gender_id", "gender_id",
                                                   "gender_label").collect()]
    assert dim_counts == [("Female", 2), ("Male", 1)]


def test_dim_join_broadcasts_small_side_only(spark, fact, tmp):
    gender_dimension(spark).write.parquet(f"{tmp}/dim")
    dim = spark.read.parquet(f"{tmp}/dim")  # the planner knows a table's bytes
    on = F.col("gender") == F.col("gender_code")
    small = joins.dim_join(fact, dim, on, "left")
    assert "BroadcastHashJoin" in _plan(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = joins.dim_join(fact, dim, on, "left")
        assert "BroadcastHashJoin" not in _plan(big)
        assert sorted(map(tuple, small.collect())) == sorted(map(tuple, big.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_semi_anti(spark, fact):
    keys = spark.createDataFrame([("u1",), ("u3",), ("zz",)], "id string")
    assert sorted(r.id for r in joins.semi_join(fact, keys, "id").collect()) == ["u1", "u3"]
    assert sorted(r.id for r in joins.anti_join(fact, keys, "id").collect()) == ["u2", "u4"]


def test_counts(spark, fact):
    assert agg.count_all(fact).first().cnt == 4
    assert agg.count_filtered(fact, F.col("gender") == "female").first().cnt == 2


def test_insert_if_absent_first_row_stays(spark, tmp):
    t = tables.ParquetTable(spark, f"{tmp}/users")
    t.overwrite(spark.createDataFrame([("a", "old")], "id string, v string"))
    load1 = spark.createDataFrame([("a", "new", 1), ("b", "first", 2), ("b", "second", 3)],
                                  "id string, v string, seq long")
    t.append(tables.insert_if_absent(t.read(), load1, "id", "seq"))
    load2 = spark.createDataFrame([("b", "later", 1), ("c", "c1", 2)], "id string, v string, seq long")
    t.append(tables.insert_if_absent(t.read(), load2, "id", "seq"))
    assert sorted(map(tuple, t.read().collect())) == [("a", "old"), ("b", "first"), ("c", "c1")]


def test_flat_refresh_never_updates(spark, tmp):
    dim = gender_dimension(spark)
    fact_v1 = spark.createDataFrame([("a", 1), ("b", 2)], "id string, gender_id int")
    flat = tables.ParquetTable(spark, f"{tmp}/flat")
    cols = ["id", F.col("gender_code").alias("gender")]
    flat.overwrite(tables.flat_rows(fact_v1, dim, "gender_id", "gender_id", cols))
    fact_v2 = spark.createDataFrame([("a", 2), ("b", 2), ("c", 1)], "id string, gender_id int")
    flat.append(tables.flat_refresh(flat.read(), fact_v2, dim, "gender_id", "gender_id", cols))
    assert sorted(map(tuple, flat.read().collect())) == [
        ("a", "male"), ("b", "female"), ("c", "male")]


def test_upsert_last_wins_and_replay_is_harmless(spark, tmp):
    sink = tables.KeyedUpsertTable(spark, f"{tmp}/created", "id", order_cols=["seq"])
    sch = "id string, v string, seq long"
    sink.write_epoch(spark.createDataFrame([("a", "a0", 1), ("b", "b0", 1), ("a", "a1", 2)], sch), 0)
    sink.write_epoch(spark.createDataFrame([("a", "a2", 1)], sch), 1)
    first = sorted(map(tuple, sink.read().collect()))
    assert first == [("a", "a2", 1), ("b", "b0", 1)]
    # replay epoch 1 with the same rows, then epoch 0 again: same table
    sink.write_epoch(spark.createDataFrame([("a", "a2", 1)], sch), 1)
    sink.write_epoch(spark.createDataFrame([("a", "a0", 1), ("b", "b0", 1), ("a", "a1", 2)], sch), 0)
    assert sorted(map(tuple, sink.read().collect())) == first
    assert sink.versions().count() == 3


def test_rollup_stale_until_refresh(spark, tmp):
    dim = gender_dimension(spark)
    fact = tables.ParquetTable(spark, f"{tmp}/fact")
    fact.overwrite(spark.createDataFrame([("a", 1), ("b", 2), ("c", 2)], "id string, gender_id int"))
    mv = tables.RollupTable(spark, f"{tmp}/mv")
    mv.refresh(tables.rollup(fact.read(), dim, "gender_id", "gender_id", "gender_label"))
    assert [tuple(r) for r in mv.read().collect()] == [("Female", 2), ("Male", 1)]
    fact.append(spark.createDataFrame([("d", 1), ("e", 1)], "id string, gender_id int"))
    assert [tuple(r) for r in mv.read().collect()] == [("Female", 2), ("Male", 1)]
    mv.refresh(tables.rollup(fact.read(), dim, "gender_id", "gender_id", "gender_label"))
    assert [tuple(r) for r in mv.read().collect()] == [("Male", 3), ("Female", 2)]
    assert tables.duplicate_keys(mv.snapshot(), "label").first().dup == 0


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), ("c",), ("c",)], "k string")
    assert tables.duplicate_keys(df, "k").first().dup == 2


def test_create_tables_idempotent_and_analyze(spark, tmp):
    made = create_tables(spark, "kf_test", tmp)
    assert made == list(TABLES)
    create_tables(spark, "kf_test", tmp)  # second call is a no-op
    assert spark.table("kf_test.created_users").schema.fieldNames()[-1] == "latency_ms"
    spark.createDataFrame([(1, "male", "Male"), (2, "female", "Female")], TABLES["dim_gender"]) \
        .write.mode("append").insertInto("kf_test.dim_gender")
    tables.analyze(spark, "kf_test.dim_gender")
    stats = spark.sql("DESCRIBE EXTENDED kf_test.dim_gender").collect()
    assert any("2 rows" in (r.data_type or "") for r in stats if r.col_name == "Statistics")


def test_bucketed_tables_join_without_shuffle(spark, tmp):
    facts = spark.range(0, 2000).select(F.col("id").cast("string").alias("id"),
                                        (F.col("id") % 7).alias("v"))
    fact = tables.BucketedTable(spark, "kf_fact_b", f"{tmp}/fact_b", "id", 8)
    ledger = tables.BucketedTable(spark, "kf_ledger_b", f"{tmp}/ledger_b", "id", 8)
    fact.overwrite(facts)
    ledger.overwrite(facts.filter("v = 3").select("id", F.lit("c1").alias("claim_id")))
    ledger.append(facts.filter("v = 4").select("id", F.lit("c2").alias("claim_id")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        unsent = fact.read().join(ledger.read(), "id", "left_anti")
        plan = _plan(unsent)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert unsent.count() == facts.filter("v not in (3, 4)").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_jdbc_options():
    from keyflow.sources.tables import jdbc_options, jdbc_write_options

    o = jdbc_options("jdbc:postgresql://db/x", "users_raw", "n", 0, 1000, 16)
    assert (o["partitionColumn"], o["lowerBound"], o["upperBound"], o["numPartitions"]) == \
        ("n", "0", "1000", "16")
    assert "partitionColumn" not in jdbc_options("jdbc:x", "dim_gender")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", "n")
    assert jdbc_write_options("jdbc:x", "users_raw")["batchsize"] == "500"


def test_upsert_global_order_survives_out_of_order_segments(spark, tmp):
    sink = tables.KeyedUpsertTable(spark, f"{tmp}/s", "id", order_cols=["_offset"],
                                   global_order=True)
    sch = "id string, v string, _offset long"
    sink.write_epoch(spark.createDataFrame([("a", "newer", 10), ("b", "b", 3)], sch), 0)
    sink.write_epoch(spark.createDataFrame([("a", "older", 5)], sch), 1)
    assert {r.id: r.v for r in sink.read().collect()} == {"a": "newer", "b": "b"}
    epoch_first = tables.KeyedUpsertTable(spark, f"{tmp}/s", "id", order_cols=["_offset"])
    assert {r.id: r.v for r in epoch_first.read().collect()}["a"] == "older"


def test_sizing_for_100tb():
    from keyflow.session import sizing_conf

    conf = sizing_conf(100 * 10**12, cores=8000)
    width = int(conf["spark.sql.shuffle.partitions"])
    assert 700_000 < width < 800_000  # ~128 MB per shuffle partition
    assert conf["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
    assert int(sizing_conf(10**6, cores=8)["spark.sql.shuffle.partitions"]) == 16


def test_claim_skips_null_flag_and_ledgered_ids(spark):
    from keyflow.operators import outbox

    fact = spark.createDataFrame(
        [("a", False, 1), ("b", None, 2), ("c", False, 3), ("d", False, 4), ("e", True, 5)],
        "id string, kafka_sent boolean, seq int")
    ledger = spark.createDataFrame([("c", "x")], "id string, claim_id string")
    got = outbox.claim(fact, ledger, 10, ["seq"], [F.col("id")], key="id",
                       unsent_condition=F.col("kafka_sent") == F.lit(False)).collect()
    assert [r.id for r in got] == ["a", "d"]
    top1 = outbox.claim(fact, ledger, 1, ["seq"], [F.col("id")], key="id",
                        unsent_condition=F.col("kafka_sent") == F.lit(False)).collect()
    assert [r.id for r in top1] == ["a"]
    flagged = {r.id: r.sent for r in outbox.with_sent_flag(fact, ledger).collect()}
    assert flagged == {"a": False, "b": False, "c": True, "d": False, "e": False}


def test_global_order_batch_with_duplicates(spark, tmp):
    sink = tables.KeyedUpsertTable(spark, f"{tmp}/g", "id", order_cols=["_offset"],
                                   global_order=True)
    sch = "id string, v string, _offset long"
    batch = spark.createDataFrame([("a", "1", 1), ("a", "3", 3), ("a", "2", 2)], sch)
    sink.write_epoch(batch, 0)
    sink.write_epoch(batch, 0)  # replay: same partition replaced
    assert [tuple(r) for r in sink.read().collect()] == [("a", "3", 3)]
    assert sink.versions().count() == 3


def test_upsert_compaction_keeps_current_rows(spark, tmp):
    sink = tables.KeyedUpsertTable(spark, f"{tmp}/c", "id", order_cols=["seq"])
    sch = "id string, v string, seq long"
    sink.write_epoch(spark.createDataFrame([("a", "a0", 1), ("b", "b0", 1)], sch), 0)
    sink.write_epoch(spark.createDataFrame([("a", "a1", 1)], sch), 1)
    sink.compact_to(f"{tmp}/snap")
    snap = tables.KeyedUpsertTable(spark, f"{tmp}/snap", "id", order_cols=["seq"])
    assert sorted(map(tuple, snap.read().collect())) == sorted(map(tuple, sink.read().collect()))
    assert snap.versions().count() == 2
    # the snapshot continues as a table: later epochs still win
    snap.write_epoch(spark.createDataFrame([("b", "b2", 1)], sch), 2)
    assert {r.id: r.v for r in snap.read().collect()} == {"a": "a1", "b": "b2"}


def test_small_load_never_shuffles_the_target(spark, tmp):
    target = tables.ParquetTable(spark, f"{tmp}/big")
    target.overwrite(spark.range(0, 5000).select(F.col("id").cast("string").alias("id"),
                                                  F.lit("x").alias("v")))
    spark.createDataFrame([("1", "new"), ("99999", "new")], "id string, v string") \
        .write.parquet(f"{tmp}/load")
    load = spark.read.parquet(f"{tmp}/load")
    rows = tables.insert_if_absent(target.read(), load, "id")
    plan = _plan(rows)
    # the target's key column is probed by a broadcast of the load's keys
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    # the only exchange is the load's own dedupe: the target is never shuffled
    target_side = plan[plan.index("LeftSemi"):]
    assert "Exchange hashpartitioning" not in target_side.split("BroadcastExchange")[0]
    assert plan.count("Exchange hashpartitioning") <= 2  # load dedupe + load key set
    assert sorted(r.id for r in rows.collect()) == ["99999"]


def test_compaction_then_replay_loses_nothing(spark, tmp):
    sink = tables.KeyedUpsertTable(spark, f"{tmp}/c", "id", order_cols=["seq"])
    sch = "id string, v string, seq long"
    sink.write_epoch(spark.createDataFrame([("a", "a0", 1), ("b", "b0", 1)], sch), 0)
    last = spark.createDataFrame([("c", "c1", 2)], sch)
    sink.write_epoch(last, 1)
    want = sorted(map(tuple, sink.read().collect()))
    sink.compact()
    sink.write_epoch(last, 1)  # an at-least-once replay of the newest epoch
    assert sorted(map(tuple, sink.read().collect())) == want
    sink.compact()
    sink.write_epoch(spark.createDataFrame([("b", "b2", 1)], sch), 2)
    assert {r.id: r.v for r in sink.read().collect()} == {"a": "a0", "b": "b2", "c": "c1"}


def test_a_new_checkpoint_replaces_nothing(spark, tmp):
    sch = "id string, v string, seq long"
    first = tables.KeyedUpsertTable(spark, f"{tmp}/r", "id", order_cols=["seq"])
    first.use_run("query-one")
    first.write_epoch(spark.createDataFrame([("a", "a0", 1), ("b", "b0", 1)], sch), 0)
    again = tables.KeyedUpsertTable(spark, f"{tmp}/r", "id", order_cols=["seq"])
    again.use_run("query-one")
    assert again.run == first.run
    again.use_run("query-two")
    again.write_epoch(spark.createDataFrame([("z", "z0", 1), ("a", "a9", 0)], sch), 0)
    assert {r.id: r.v for r in again.read().collect()} == {"a": "a9", "b": "b0", "z": "z0"}


def test_versions_need_an_order(spark, tmp):
    import pytest

    with pytest.raises(ValueError):
        tables.KeyedUpsertTable(spark, tmp, "id", order_cols=[])


def test_backfill_writes_few_files(spark, tmp):
    import glob

    sink = tables.KeyedUpsertTable(spark, f"{tmp}/f", "id", order_cols=["seq"], global_order=True)
    rows = spark.range(10000).repartition(16).select(
        F.col("id").cast("string").alias("id"), F.col("id").alias("seq"),
        (F.col("id") % 50).alias("_epoch"))
    sink.write_epochs(rows)
    assert len(glob.glob(f"{tmp}/f/versions/*/*/part-*")) <= 100
    assert sink.read().count() == 10000


def test_rollup_reader_survives_a_refresh(spark, tmp):
    mv = tables.RollupTable(spark, f"{tmp}/mv2")
    mv.refresh(spark.createDataFrame([("a", 1)], "label string, cnt long"))
    opened = mv.read()
    mv.refresh(spark.createDataFrame([("a", 2)], "label string, cnt long"))
    assert opened.collect()[0].cnt == 1 and mv.read().collect()[0].cnt == 2


def test_unreadable_table_is_not_an_absent_one(spark, tmp):
    import pathlib

    import pytest

    bad = pathlib.Path(tmp) / "bad"
    bad.mkdir()
    (bad / "part-0.parquet").write_bytes(b"no parquet")
    assert tables.ParquetTable(spark, f"{tmp}/absent").read_if_exists() is None
    with pytest.raises(Exception):
        tables.ParquetTable(spark, str(bad)).read_if_exists().count()
