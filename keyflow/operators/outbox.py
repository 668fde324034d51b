"""Outbox: claim a bounded batch of unsent rows and mark them sent.

Parquet has no UPDATE, so the ``sent`` flag lives in an append-only ledger
of ids. "Unsent" is an anti join with the ledger; the flag view is a left
join. Writing the ledger *before* publishing keeps the at-most-once
behaviour (a crash after marking loses the batch); writing it after
publishing gives at-least-once (a crash re-sends it).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.operators.joins import dim_join


def unsent(fact: DataFrame, ledger: DataFrame, key: str = "id") -> DataFrame:
    """Fact rows whose id is not in the sent ledger.

    The ledger grows without bound, so it gets no broadcast: the join is a
    sort-merge join (shuffle-free when fact and ledger are bucketed alike),
    which AQE may still turn into a broadcast from the ledger's measured size.
    """
    return fact.join(ledger.select(key), key, "left_anti")


def claim(fact: DataFrame, ledger: DataFrame | None, batch_size: int,
          order_by: Sequence[str | Column], projection: Sequence[Column],
          dim: DataFrame | None = None, dim_on: str | list[str] | Column | None = None,
          key: str = "id", unsent_condition: Column | None = None) -> DataFrame:
    """Up to ``batch_size`` unsent rows, joined to the dimension, projected (O2).

    The order makes the claim deterministic; Spark plans ``orderBy + limit``
    as a per-task top-k plus one merge, so no full sort happens. Only the
    claimed rows meet the dimension.
    """
    rows = fact
    if unsent_condition is not None:
        rows = rows.filter(unsent_condition)
    if ledger is not None:
        rows = unsent(rows, ledger, key)
    top = rows.orderBy(*order_by).limit(batch_size)
    if dim is not None:
        top = dim_join(top, dim, dim_on, "left")
    return top.select(*projection)


def ledger_rows(claimed: DataFrame, claim_id: str, key: str = "id") -> DataFrame:
    """Rows to append to the sent ledger for one claim (K7); ids keep their type,
    so that a ledger bucketed like its fact table meets it without a cast."""
    return claimed.select(F.col(key).alias("id"),
                          F.lit(claim_id).alias("claim_id"))


def with_sent_flag(fact: DataFrame, ledger: DataFrame, key: str = "id",
                   flag: str = "sent", fact_key: str | None = None) -> DataFrame:
    """The fact table with a boolean ``sent`` flag from the ledger.

    The ledger is reduced to distinct ids first, so a replayed claim cannot
    duplicate fact rows; its ids are compared in the fact's own type, so a fact
    bucketed by its key is not shuffled.
    """
    fk = fact_key or key
    kind = fact.schema[fk].dataType
    ids = (ledger.select(F.col(key).cast(kind).alias("__sent_id")).distinct()
           .withColumn("__hit", F.lit(True)))
    # unbounded ledger: planner's join (see ``unsent``)
    joined = fact.join(ids, F.col(fk) == F.col("__sent_id"), "left")
    return joined.withColumn(flag, F.coalesce(F.col("__hit"), F.lit(False))).drop("__sent_id", "__hit")
