"""Fact-to-dimension joins.

The planner chooses the strategy: it broadcasts a side whose statistics are
under ``spark.sql.autoBroadcastJoinThreshold`` bytes, and adaptive execution one
whose measured bytes are; everything else is a sort-merge join with hot keys
split. No count is taken to decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dim_join(fact: DataFrame, dim: DataFrame, on: str | list[str] | Column,
             how: str = "inner") -> DataFrame:
    """Join a fact table to a dimension on its key.

    ``inner`` drops facts without a dimension row (J2), ``left`` keeps them
    with NULL attributes (J1), ``left_semi``/``left_anti`` are the EXISTS /
    NOT EXISTS forms (J5, J4).
    """
    return fact.join(dim, on, how)


def resolve_key(fact: DataFrame, dim: DataFrame, code_col: str, dim_code_col: str,
                dim_key_col: str, out_col: str) -> DataFrame:
    """Replace a natural code by the dimension's surrogate key.

    Unknown codes get a NULL key, like a dictionary ``get``. The dimension is
    reduced to one key per code first, so a duplicated code can never
    multiply fact rows.
    """
    lookup = (dim.groupBy(F.col(dim_code_col).alias("__code"))
              .agg(F.min(dim_key_col).alias(out_col)))
    joined = dim_join(fact, lookup, F.col(code_col) == F.col("__code"), "left")
    return joined.drop("__code")


def semi_join(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys`` (``= ANY(list)``, J5)."""
    return dim_join(df, keys, on, "left_semi")


def anti_join(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``keys``."""
    return dim_join(df, keys, on, "left_anti")
