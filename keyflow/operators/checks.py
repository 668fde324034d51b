"""Data expectations, round trip, loss and copy audits.

Audits never join raw rows pairwise: both sides are tagged, unioned and
grouped by key once, so duplicates cannot multiply rows, a hot key is
combined map-side, and there is exactly one shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

UUID4_PATTERN = r"^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"


def expectation_suite(df: DataFrame, violations: Mapping[str, Column],
                      row_count: str | None = "n") -> DataFrame:
    """One row: ``row_count`` plus, per named check, the count of violating rows."""
    aggs = [F.count(F.lit(1)).alias(row_count)] if row_count else []
    aggs += [F.count_if(F.coalesce(cond, F.lit(False))).alias(name)
             for name, cond in violations.items()]
    return df.agg(*aggs)


def as_check_rows(suite: DataFrame, row_count: str | None = "n") -> DataFrame:
    """The one-row suite as ``(check, violations)`` rows (an unpivot)."""
    checks = [c for c in suite.columns if c != row_count]
    return suite.unpivot([], checks, "check", "violations")


def record_violations(required: Sequence[str], id_col: str = "id",
                      domain: Mapping[str, Sequence[str]] | None = None,
                      ts_col: str | None = None, ts_range: tuple[int, int] | None = None,
                      latency_col: str | None = None) -> dict[str, Column]:
    """The reference's record tests as violation predicates."""
    checks: dict[str, Column] = {}
    missing = None
    for c in required:
        cond = F.col(c).isNull()
        missing = cond if missing is None else (missing | cond)
    if missing is not None:
        checks["missing_field"] = missing
    checks["bad_uuid"] = ~F.coalesce(F.col(id_col).rlike(UUID4_PATTERN), F.lit(False))
    for c, allowed in (domain or {}).items():
        checks[f"bad_{c}"] = ~F.coalesce(F.col(c).isin(*allowed), F.lit(False))
    if ts_col and ts_range:
        lo, hi = ts_range
        checks["ts_out_of_range"] = ~F.coalesce(F.col(ts_col).between(lo, hi), F.lit(False))
    if latency_col:
        checks["negative_latency"] = F.col(latency_col) < 0
    return checks


def expectations(df: DataFrame, key: str, violations: Mapping[str, Column]) -> DataFrame:
    """Suite row plus key uniqueness: ``dup_<key>`` = non-null keys beyond the first.

    One aggregate: Spark plans the distinct count as a two-level aggregation
    keyed by ``key``, so it shares the scan with the other checks.
    """
    k = F.col(key)
    aggs = [F.count(F.lit(1)).alias("n"), F.count_if(k.isNull()).alias("null_" + key)]
    aggs += [F.count_if(F.coalesce(cond, F.lit(False))).alias(name)
             for name, cond in violations.items()]
    aggs.append((F.count(k) - F.count_distinct(k)).alias("dup_" + key))
    return df.agg(*aggs)


#: JSON's own time formats stop at milliseconds
FULL_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
              "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def json_roundtrip(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Encode each row to JSON text and parse it back with the same schema.

    Adds ``__same``: every column equal (null-safe) to its original.
    """
    cols = list(columns) if columns else df.columns
    schema = StructType([df.schema[c] for c in cols])
    text = F.to_json(F.struct(*cols), {"ignoreNullFields": "false", **FULL_TIMES})
    back = df.select(*cols, F.from_json(text, schema, FULL_TIMES).alias("__back"))
    same = None
    for c in cols:
        eq = F.col(c).eqNullSafe(F.col("__back")[c])
        same = eq if same is None else (same & eq)
    return back.select(*[F.col("__back")[c].alias(c) for c in cols], same.alias("__same"))


def loss_audit(produced: DataFrame, consumed: DataFrame, key: str) -> DataFrame:
    """``missing`` (produced, never consumed), ``extra`` (consumed, never
    produced) and ``duplicated`` (consumed copies beyond the produced ones) (D3)."""
    tagged = (produced.select(F.col(key).alias("k"), F.lit(1).alias("p"), F.lit(0).alias("c"))
              .unionByName(consumed.select(F.col(key).alias("k"), F.lit(0).alias("p"),
                                           F.lit(1).alias("c"))))
    per_key = tagged.groupBy("k").agg(F.sum("p").alias("p"), F.sum("c").alias("c"))
    return per_key.agg(
        F.count_if(F.col("c") == 0).alias("missing"),
        F.count_if(F.col("p") == 0).alias("extra"),
        F.coalesce(F.sum(F.greatest(F.col("c") - F.greatest(F.col("p"), F.lit(1)), F.lit(0))),
                   F.lit(0)).cast("long").alias("duplicated"),
    )


def row_digest(cols: Sequence[str]) -> Column:
    """A 64-bit digest of a row's columns; null is a value of its own."""
    # the position keeps nulls of different columns apart
    return F.xxhash64(*[x for i, c in enumerate(cols)
                        for x in (F.col(c), F.col(c).isNull(), F.lit(i))])


def table_diff(left: DataFrame, right: DataFrame, key: str,
               value_cols: Sequence[str]) -> DataFrame:
    """Copy audit between two tables keyed by ``key``.

    ``changed``: keys on both sides whose rows differ as bags (a key may have
    several rows; null equals null); ``only_left`` / ``only_right``: keys on one
    side only. Rows are compared by their number and a sum of 64-bit digests,
    both of fixed width, so everything is a hash aggregate.
    """
    digest = row_digest(value_cols)

    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(F.col(key).alias("k"), F.lit(sign).alias("s"),
                         (digest.cast("decimal(20,0)") * sign).alias("d"))

    both = side(left, 1).unionByName(side(right, -1))
    per_key = both.groupBy("k").agg(
        F.sum("d").alias("d"), F.count_if(F.col("s") == 1).alias("nl"),
        F.count_if(F.col("s") == -1).alias("nr"))
    on_both = (F.col("nl") > 0) & (F.col("nr") > 0)
    return per_key.agg(
        F.count_if(on_both & ((F.col("nl") != F.col("nr")) | (F.col("d") != 0))).alias("changed"),
        F.count_if(F.col("nr") == 0).alias("only_left"),
        F.count_if(F.col("nl") == 0).alias("only_right"),
    )
