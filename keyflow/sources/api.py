"""Nested API payload source (S4), re-aimed from an HTTP call to payload data.

A payload is ``{"results": [ {...nested user...}, ... ]}``. Parsing is
``from_json`` with a declared schema, flattening is ``explode`` plus struct
field access; both stay in the JVM. Payloads are pages of bounded size (the
API returns a handful of results per call), so an exploded page never
becomes a large in-memory array.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow.functions.scalars import seeded_uuid4
from keyflow.schemas import API_PAYLOAD


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """JSON payload files (one payload object per line) -> ``results`` column."""
    return spark.read.schema(API_PAYLOAD).json(path)


def parse_payloads(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Payload text -> ``results`` array column (null when malformed)."""
    parsed = F.from_json(F.col(value_col).cast("string"), API_PAYLOAD)
    return df.withColumn("results", parsed.getField("results"))


def flatten_results(payloads: DataFrame, seed: int = 42, now_ms: int | None = None,
                    id_key: str | None = None) -> DataFrame:
    """Explode ``results`` and flatten each user into the 13-field message.

    ``id`` is a UUIDv4 derived from ``id_key`` (or else the page's content) and
    the position in the page, so that reruns are reproducible and two equal
    results of a page stay two rows.
    """
    now_ms = int(time.time() * 1000) if now_ms is None else now_ms
    ex = payloads.select(*( [F.col(id_key)] if id_key else []),
                         F.xxhash64("results").alias("page"),
                         F.posexplode("results").alias("pos", "r"))
    r = F.col("r")
    loc = r["location"]
    # namespaced so payload ids never coincide with generated ones; without a
    # page key the content of page and result decides, so re-ingesting the same
    # page gives the same ids
    key = (F.concat_ws(":", F.lit("api"), F.col(id_key).cast("string"), F.col("pos").cast("string"))
           if id_key else F.concat_ws(":", F.lit("api"), F.col("page"), F.col("pos"), F.to_json(F.col("r"))))
    return ex.select(
        seeded_uuid4(key, seed).alias("id"),
        r["name"]["first"].alias("first_name"),
        r["name"]["last"].alias("last_name"),
        r["gender"].alias("gender"),
        F.concat(loc["street"]["number"], F.lit(" "), loc["street"]["name"], F.lit(", "),
                 loc["city"], F.lit(", "), loc["state"], F.lit(", "),
                 loc["country"]).alias("address"),
        loc["postcode"].alias("post_code"),
        r["email"].alias("email"),
        r["login"]["username"].alias("username"),
        r["dob"]["date"].alias("dob"),
        r["registered"]["date"].alias("registered_date"),
        r["phone"].alias("phone"),
        r["picture"]["medium"].alias("picture"),
        F.lit(now_ms).cast("long").alias("event_ts_ms"),
    )


def explode_pages(df: DataFrame, value_col: str, result_schema: T.StructType,
                  fields: dict[str, str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Generic form: parse ``{"results": [...]}`` text and flatten dotted paths.

    Only the named paths are kept, so Spark prunes the parse to them.
    """
    schema = T.StructType([T.StructField("results", T.ArrayType(result_schema))])
    parsed = df.select(*keep, F.from_json(F.col(value_col), schema)["results"].alias("results"))
    ex = parsed.select(*keep, F.explode("results").alias("r"))
    return ex.select(*keep, *[F.col("r." + path).alias(name) for name, path in fields.items()])
