"""Counts, group counts, latency distribution, delivery metrics.

All are single ``agg`` calls: Spark plans them as partial aggregation per
task, one shuffle of the partial rows, final aggregation. A hot group key
is combined map-side, so skew costs one row per task, not one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyflow.operators.joins import dim_join

# Spark's default; rank error is n/accuracy and the sketch is O(accuracy) per group
DEFAULT_ACCURACY = 10_000


def count_all(df: DataFrame, alias: str = "cnt") -> DataFrame:
    """``COUNT(*)`` (A1); reads no columns from Parquet."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def count_filtered(df: DataFrame, condition: Column, alias: str = "cnt") -> DataFrame:
    """``COUNT(*) WHERE condition`` (A2); the filter lands in the scan."""
    return count_all(df.filter(condition), alias)


def order_by_count(df: DataFrame, name: str, alias: str = "cnt") -> DataFrame:
    """``ORDER BY count DESC`` with ties broken by the key (O1)."""
    return df.orderBy(F.col(alias).desc(), F.col(name).asc_nulls_last())


def group_count(df: DataFrame, key: str | Column, alias: str = "cnt",
                label: str | None = None) -> DataFrame:
    """``GROUP BY key ORDER BY count DESC`` (A3/A4, O1).

    NULL keys form their own group. Ties are broken by the key so that the
    order is fully determined.
    """
    k = F.col(key) if isinstance(key, str) else key
    name = label or (key if isinstance(key, str) else "label")
    counts = df.groupBy(k.alias(name)).agg(F.count(F.lit(1)).alias(alias))
    return order_by_count(counts, name, alias)


def _keys_equal(keys: Sequence[str], renamed: Sequence[str]) -> Column | None:
    """Null-safe equality of ``keys`` with their renamed copies (NULL is a group)."""
    cond = None
    for k, r in zip(keys, renamed):
        c = F.col(k).eqNullSafe(F.col(r))
        cond = c if cond is None else (cond & c)
    return cond


def value_counts(df: DataFrame, value_col: str, group_cols: Sequence[str],
                 num_partitions: int | None = None) -> DataFrame:
    """``group, __v, __c, __pid``: rows per group and distinct value, range
    partitioned and sorted by (group, value), stored below the checkpoint folder.

    A value held by a third of all rows is one row here (counted inside each task
    first), and a group of many distinct values is spread over tasks by value.
    """
    from keyflow.session import scratch_dir

    keys = list(group_cols)
    spark = df.sparkSession
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_dir(spark, "value_counts")
    (df.groupBy(*keys, F.col(value_col).alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
       .repartitionByRange(parts, *keys, "__v").sortWithinPartitions(*keys, "__v")
       .withColumn("__pid", F.spark_partition_id()).write.parquet(path))
    return spark.read.parquet(path)


def percentiles_of_counts(counts: DataFrame, percentiles: Mapping[str, float],
                          group_cols: Sequence[str]) -> DataFrame:
    """Exact discrete percentiles from ``value_counts``.

    A task's run of a group is a block; a small aggregate over blocks (tasks x
    groups rows) gives every block's starting rank, and a running count is taken
    only in the blocks that hold a wanted rank.
    """
    keys = list(group_cols)
    ordered = counts.filter(F.col("__v").isNotNull())
    blocks = ordered.groupBy("__pid", *keys).agg(F.sum("__c").alias("__bn"))
    before = Window.partitionBy(*keys).orderBy("__pid") \
        .rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("__before", F.coalesce(F.sum("__bn").over(before), F.lit(0)))
    blocks = blocks.withColumn("__n", F.sum("__bn").over(Window.partitionBy(*keys)))
    n = F.col("__n")
    ranks = [F.struct(F.lit(name).alias("__name"),
                      F.greatest(F.lit(1), n - F.floor(n - F.lit(p) * n)).cast("long").alias("__rank"))
             for name, p in percentiles.items()]
    renamed = [f"__k{i}" for i in range(len(keys))]
    located = (blocks.select("*", F.explode(F.array(*ranks)).alias("__w")).select("*", "__w.*")
               .filter((F.col("__rank") > F.col("__before"))
                       & (F.col("__rank") <= F.col("__before") + F.col("__bn")))
               .select("__name", (F.col("__rank") - F.col("__before")).alias("__at"),
                       F.col("__pid").alias("__block"),
                       *[F.col(k).alias(r) for k, r in zip(keys, renamed)]))
    on = (F.col("__pid") == F.col("__block")) & _keys_equal(keys, renamed)
    upto = Window.partitionBy("__name", *keys).orderBy("__v")
    picked = (dim_join(ordered, located, on, "inner")
              .withColumn("__upto", F.sum("__c").over(upto))
              .filter((F.col("__upto") >= F.col("__at"))
                      & (F.col("__upto") - F.col("__c") < F.col("__at"))))
    aggs = [F.max(F.when(F.col("__name") == name, F.col("__v"))).alias(name) for name in percentiles]
    return picked.groupBy(*keys).agg(*aggs)


def exact_percentiles(df: DataFrame, value_col: str, percentiles: Mapping[str, float],
                      group_cols: Sequence[str] = (),
                      num_partitions: int | None = None) -> DataFrame:
    """Exact discrete percentiles: per group, the value at 1-based rank
    ``ceil(p * n)`` among the non-null values (SQL ``percentile_disc``).

    Distributed without collecting a group anywhere: only distinct values are
    ordered, each with its count (``value_counts``), and their one written table
    cuts the lineage: every later pass reads stored rows.
    """
    if not group_cols:
        one = df.withColumn("__all", F.lit(0))
        return exact_percentiles(one, value_col, percentiles, ["__all"], num_partitions) \
            .drop("__all")
    counts = value_counts(df, value_col, group_cols, num_partitions)
    return percentiles_of_counts(counts, percentiles, group_cols)


#: size of a stored quantile sketch
SKETCH_K = 1024


def sketch_rank_error(k: int = SKETCH_K) -> float:
    """Share of the rows by which a percentile of a KLL sketch of size ``k`` may
    miss its rank (at 99 % confidence); merging sketches does not widen it."""
    # fixed values of the published error model
    return 2.296 / k ** 0.9021


def latency_sketches(df: DataFrame, value_col: str, group_cols: Sequence[str],
                     k: int = SKETCH_K) -> DataFrame:
    """Per group a mergeable summary of its values: ``n, measured, p_max, sketch``.

    Rows of any number of groups, epochs or days are merged later without the
    values (``merged_latency``); a sketch holds O(k) values however many it saw.
    """
    v = F.col(value_col).cast("double")
    return df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n"), F.count(v).alias("measured"), F.max(v).alias("p_max"),
        F.kll_sketch_agg_double(v, k).alias("sketch"))


def merged_latency(sketches: DataFrame, group_cols: Sequence[str] = (),
                   percentiles: Mapping[str, float] | None = None,
                   rows: str = "n") -> DataFrame:
    """``latency_stats`` of any stored sketches: counts add up, sketches merge;
    percentiles are null where nothing was measured."""
    wanted = percentiles or {"p50": 0.5, "p95": 0.95}
    merged = sketches.groupBy(*group_cols) if group_cols else sketches.groupBy()
    merged = merged.agg(
        F.sum(rows).cast("long").alias("n"), F.sum("measured").cast("long").alias("measured"),
        F.max("p_max").alias("p_max"), F.kll_merge_agg_double("sketch").alias("__sketch"))
    some = F.col("measured") > 0
    return merged.select(*group_cols, "n", "measured", *[
        F.when(some, F.kll_sketch_get_quantile_double("__sketch", F.lit(p))).alias(name)
        for name, p in wanted.items()], "p_max")


def latency_stats(df: DataFrame, latency_col: str = "latency_ms",
                  group_cols: Sequence[str] = (), accuracy: int | None = DEFAULT_ACCURACY) -> DataFrame:
    """Row count, measured count, p50, p95 and max of latency.

    Null latencies are counted in ``n`` but skipped by the other aggregates,
    so no separate filter pass is needed. With ``accuracy`` the percentiles
    come from ``percentile_approx`` in the same single aggregate (rank error
    n/accuracy; exact while a group has fewer values than ``accuracy``, which
    holds for a micro-batch bounded by the source's admission control). With
    ``accuracy=None`` they are exact at any size (``exact_percentiles``).
    """
    lat = F.col(latency_col)
    base = [F.count(F.lit(1)).alias("n"), F.count(lat).alias("measured")]
    if accuracy is not None:
        aggs = base + [
            F.percentile_approx(lat, 0.5, accuracy).alias("p50"),
            F.percentile_approx(lat, 0.95, accuracy).alias("p95"),
            F.max(lat).alias("p_max"),
        ]
        return df.groupBy(*group_cols).agg(*aggs) if group_cols else df.agg(*aggs)
    keys = list(group_cols) or ["__all"]
    rows = df if group_cols else df.withColumn("__all", F.lit(0))
    # counted by distinct value and stored once: every pass below reads that table
    counts = value_counts(rows.withColumn("__lat", lat), "__lat", keys)
    main = counts.groupBy(*keys).agg(
        F.sum("__c").alias("n"),
        F.coalesce(F.sum(F.when(F.col("__v").isNotNull(), F.col("__c"))), F.lit(0)).alias("measured"),
        F.max("__v").alias("p_max"))
    pct = percentiles_of_counts(counts, {"p50": 0.5, "p95": 0.95}, keys)
    pk = [f"__pk{i}" for i in range(len(keys))]
    pct = pct.select(*[F.col(k).alias(r) for k, r in zip(keys, pk)], "p50", "p95")
    # one row per group on each side: a shuffle join, turned into a
    # broadcast by AQE from the measured size when small
    out = main.join(pct, _keys_equal(keys, pk), "left")
    out = out.select(*keys, "n", "measured", "p50", "p95", "p_max")
    return out.drop("__all") if "__all" in keys else out


def delivery_counters(log: DataFrame, failures_col: str = "failures",
                      valid_col: str = "valid", max_attempts: int = 3) -> DataFrame:
    """Producer counters from a delivery log.

    One log row per record: ``failures`` failed attempts (``max_attempts``
    means it gave up), ``valid`` false for records rejected before sending.
    Every failed attempt counts as a retry, the last one of a give-up too.
    """
    f = F.col(failures_col)
    v = F.col(valid_col)
    return log.agg(
        F.count_if(v & (f < max_attempts)).alias("sent"),
        F.count_if(v & (f == max_attempts)).alias("failed"),
        F.coalesce(F.sum(F.when(v, f).otherwise(F.lit(0))), F.lit(0)).cast("long").alias("retries"),
        F.count_if(v & (f >= 1)).alias("retried"),
        F.count_if(~v).alias("invalid"),
    )


def delivery_ratios(counters: DataFrame, elapsed_s: float | None = None,
                    keep_counters: bool = False) -> DataFrame:
    """Success %, recovery % and average retries from the counters.

    ``total`` excludes invalid records. Recovery is 100 and average retries
    0 when nothing was retried; success is 0 when nothing was attempted.
    """
    sent, failed = F.col("sent"), F.col("failed")
    retried, retries = F.col("retried"), F.col("retries")
    total = sent + failed
    cols = [
        total.alias("total"),
        F.when(total > 0, F.lit(100) * sent.cast("double") / total)
         .otherwise(F.lit(0.0)).alias("success_pct"),
        F.when(retried > 0, F.lit(100) * (retried - failed).cast("double") / retried)
         .otherwise(F.lit(100.0)).alias("recovery_pct"),
        F.when(retried > 0, retries.cast("double") / retried)
         .otherwise(F.lit(0.0)).alias("avg_retries"),
    ]
    if elapsed_s is not None:
        cols.append((sent.cast("double") / F.lit(elapsed_s) if elapsed_s > 0 else F.lit(0.0))
                    .alias("throughput"))
    if keep_counters:
        cols = [F.col(c) for c in counters.columns] + cols
    return counters.select(*cols)


def expected_rates(df: DataFrame, p_col: str = "p") -> DataFrame:
    """Expected rates for failure probability p and three attempts.

    success ``1 - p^3``, recovery among retried ``1 - p^2``, average retries
    among retried ``1 + p + p^2``.
    """
    p = F.col(p_col)
    return df.select(p.alias("p"),
                     (F.lit(1) - p * p * p).alias("success"),
                     (F.lit(1) - p * p).alias("recovery"),
                     (F.lit(1) + p + p * p).alias("retries"))


def offset_totals(frame: DataFrame, partition_col: str = "partition",
                  offset_col: str = "offset") -> DataFrame:
    """Sum over partitions of the end offset ``max(offset) + 1`` (A10)."""
    ends = frame.groupBy(partition_col).agg((F.max(offset_col) + 1).alias("end"))
    return ends.agg(F.sum("end").cast("long").alias("total"))
