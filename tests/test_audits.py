"""Audits by digest tree and by offset bitmaps against the row-by-row forms."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from keyflow.operators import audits, checks

from .test_plans import _plan


def _tables(spark, seed):
    """A table and a copy that differs in a few keys; null keys, several rows a key."""
    rng = random.Random(seed)
    rows = [(k, rng.choice([None, 1.5, float(k)]), rng.choice(["a", None])) for k in range(4000)]
    rows += [(k, 0.5, "again") for k in range(0, 4000, 40)] + [(None, 1.0, "n"), (None, None, None)]
    copy = [r for r in rows if r[0] != 77]
    copy = [(k, v, "changed") if k in (1500, 1501) else (k, v, w) for k, v, w in copy]
    copy += [(9_999, 1.0, "new"), (-5, 1.0, "new"), (2600, 0.5, "again")]
    schema = "k long, v double, w string"
    return (spark.createDataFrame(rows, schema).repartition(3),
            spark.createDataFrame(rng.sample(copy, len(copy)), schema).repartition(5))


def _trees(spark, tmp, left, right, leaf):
    trees = []
    for name, rows in (("l", left), ("r", right)):
        tree = audits.DigestTree(spark, f"{tmp}/{name}", levels=3, fanout=4)
        tree.build(rows, "k", ["v", "w"], leaf)
        trees.append(tree)
    return trees


@pytest.mark.parametrize("kind", ["key", "token"])
def test_the_tree_finds_what_the_full_comparison_finds(spark, tmp, kind):
    left, right = _tables(spark, 1)
    leaf = audits.key_range("k", 0, 3999, 200) if kind == "key" else audits.token_range("k", 200)
    a, b = _trees(spark, tmp, left, right, leaf)
    ranges = a.differing(b)
    assert 0 < ranges.count() <= 6
    got = audits.table_diff_in_ranges(left, right, "k", ["v", "w"], leaf, ranges).first()
    want = checks.table_diff(left, right, "k", ["v", "w"]).first()
    assert got == want and want == (3, 1, 2)
    # equal tables: no range, no row
    assert a.differing(_trees(spark, f"{tmp}/2", left, left, leaf)[1]).count() == 0


def test_equal_ranges_are_not_shuffled_by_key(spark, tmp):
    left, right = _tables(spark, 2)
    left.write.parquet(f"{tmp}/left")
    right.write.parquet(f"{tmp}/right")
    left, right = spark.read.parquet(f"{tmp}/left"), spark.read.parquet(f"{tmp}/right")
    leaf = audits.key_range("k", 0, 3999, 200)
    a, b = _trees(spark, tmp, left, right, leaf)
    ranges = spark.createDataFrame(a.differing(b).collect(), "range long")
    plan = _plan(audits.table_diff_in_ranges(left, right, "k", ["v", "w"], leaf, ranges))
    # read from the top: the shuffle by key stands above both semi joins
    assert plan.count("Exchange hashpartitioning(k#") == 1
    assert plan.index("Exchange hashpartitioning(k#") < plan.index("BroadcastHashJoin")
    assert plan.count("LeftSemi, BuildRight") == 2
    opened = left.join(ranges, leaf == F.col("range"), "left_semi").count()
    assert opened <= 0.05 * left.count()


def test_a_replaced_tree_and_an_empty_table(spark, tmp):
    left, _ = _tables(spark, 3)
    leaf = audits.token_range("k", 16)
    a, b = _trees(spark, tmp, left, left.limit(0), leaf)
    assert a.differing(b).count() == a.level(0).count()
    b.build(left, "k", ["v", "w"], leaf)
    assert a.differing(b).count() == 0


def _log(spark, rows):
    return spark.createDataFrame(rows, "partition int, offset long")


def _by_key(produced, consumed):
    """The row-by-row audit of every partition."""
    parts = {r.partition for df in (produced, consumed) for r in df.select("partition").collect()}
    out = {}
    for p in parts:
        one = [df.filter(F.col("partition").eqNullSafe(F.lit(p))) for df in (produced, consumed)]
        out[p] = tuple(checks.loss_audit(*one, "offset").first())
    return out


@pytest.mark.parametrize("seed", range(3))
def test_bitmaps_count_what_the_group_by_counts(spark, seed):
    rng = random.Random(seed)
    spots = [*range(0, 60), 32767, 32768, 65535, 65536, 70_000, 10**12]

    def side(n):
        return [(rng.choice([0, 1, 2]), rng.choice(spots)) for _ in range(n)]

    # repeats on both sides, on one side, and rows without an offset
    produced = _log(spark, [*side(60), (1, None), (1, None), (3, 5)])
    consumed = _log(spark, [*side(60), (1, None), (1, None), (1, None), (4, 6), (4, 6)])
    got = {r.part: (r.missing, r.extra, r.duplicated)
           for r in audits.loss_audit_bitmaps(produced, consumed).collect()}
    want = _by_key(produced, consumed)
    assert got == want
    lost = {tuple(r) for r in audits.lost_offsets(produced, consumed).collect()}
    rows = lambda df: {tuple(r) for r in df.filter("offset is not null").collect()}
    assert lost == rows(produced) - rows(consumed)


def test_bitmaps_of_nothing(spark):
    none = _log(spark, [])
    some = _log(spark, [(0, 1), (0, 2)])
    assert audits.loss_audit_bitmaps(none, none).count() == 0
    assert audits.loss_audit_bitmaps(some, none).collect() == [(0, 2, 0, 0)]
    assert audits.loss_audit_bitmaps(none, some).collect() == [(0, 0, 2, 0)]
    assert audits.lost_offsets(none, some).count() == 0


def test_only_blocks_are_shuffled(spark, tmp):
    """The bitmaps meet by (partition, block); offsets only in opened blocks."""
    spark.range(100_000).select((F.col("id") % 3).cast("int").alias("partition"),
                                F.col("id").alias("offset")).write.parquet(f"{tmp}/log")
    log = spark.read.parquet(f"{tmp}/log")
    assert audits.offset_bitmaps(log).count() == 3 * 4
    plan = _plan(audits.lost_offsets(log, log.filter("offset % 9 <> 1")))
    assert "hashpartitioning(offset" not in plan
    assert audits.lost_offsets(log, log.filter("offset % 9 <> 1")).count() == 11_111


def test_audits_from_the_command_line(spark, tmp, monkeypatch):
    from keyflow import __main__ as cli

    monkeypatch.setattr(cli, "build_session", lambda **kw: spark)
    left, right = _tables(spark, 4)
    left.write.parquet(f"{tmp}/l")
    right.withColumn("k", F.col("k").cast("int")).withColumn("own", F.lit(1)).write.parquet(f"{tmp}/r")
    out = cli.main(["audit-copy", f"{tmp}/l", f"{tmp}/r", "--key", "k"])
    ranges = out.pop("ranges")
    assert out == {"cmd": "audit-copy", "changed": 3, "only_left": 1, "only_right": 2}
    assert 0 < ranges <= 6
    same = cli.main(["audit-copy", f"{tmp}/l", f"{tmp}/l", "--key", "k", "--columns", "v"])
    assert same == {"cmd": "audit-copy", "changed": 0, "only_left": 0, "only_right": 0, "ranges": 0}
    _log(spark, [(0, i) for i in range(50)] + [(1, 5)]).write.parquet(f"{tmp}/p")
    _log(spark, [(0, i) for i in range(0, 50, 2)] * 2 + [(1, 6)]).write.parquet(f"{tmp}/c")
    out = cli.main(["audit-loss", f"{tmp}/p", f"{tmp}/c", "--lost", f"{tmp}/lost"])
    assert out["partitions"] == [{"part": 0, "missing": 25, "extra": 0, "duplicated": 25},
                                 {"part": 1, "missing": 1, "extra": 1, "duplicated": 0}]
    assert spark.read.parquet(f"{tmp}/lost").count() == 26
