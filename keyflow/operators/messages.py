"""Keyed JSON messages: build, publish, parse, enrich, validate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from keyflow.functions.scalars import iso_utc

TOPIC = "users_created"

# nulls are written as JSON null, like a plain JSON dump of the record
_JSON_OPTS = {"ignoreNullFields": "false"}


def stamp_send_time(df: DataFrame, now_ms: int | Column | None = None,
                    col: str = "event_ts_ms") -> DataFrame:
    """Send-time stamp in epoch ms (P4); defaults to the query's current time."""
    if now_ms is None:
        value = F.unix_millis(F.current_timestamp())
    elif isinstance(now_ms, Column):
        value = now_ms
    else:
        value = F.lit(now_ms)
    return df.withColumn(col, value.cast("long"))


def to_message(df: DataFrame, key_col: str, value_cols: Sequence[str] | None = None,
               keep: Sequence[str] = ()) -> DataFrame:
    """``key`` = UTF-8 bytes of the key column, ``value`` = JSON of the record (K4).

    The key decides the bus partition, so all messages of one key stay in
    order relative to each other. ``keep`` passes extra columns through.
    """
    cols = list(value_cols) if value_cols else [c for c in df.columns if c not in keep]
    return df.select(
        F.col(key_col).cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*cols), _JSON_OPTS).cast("binary").alias("value"),
        *keep,
    )


def kafka_sink_options(bootstrap: str, topic: str = TOPIC, acks: str = "all",
                       compression: str = "gzip", batch_size: int = 65536,
                       linger_ms: int = 20, retries: int = 5, retry_backoff_ms: int = 300,
                       max_block_ms: int = 5000, request_timeout_ms: int = 30000,
                       **extra: str) -> dict[str, str]:
    """Producer settings of the publish step for ``write.format("kafka")``."""
    opts = {
        "kafka.bootstrap.servers": bootstrap,
        "topic": topic,
        "kafka.acks": acks,
        "kafka.compression.type": compression,
        "kafka.batch.size": str(batch_size),
        "kafka.linger.ms": str(linger_ms),
        "kafka.retries": str(retries),
        "kafka.retry.backoff.ms": str(retry_backoff_ms),
        "kafka.max.block.ms": str(max_block_ms),
        "kafka.request.timeout.ms": str(request_timeout_ms),
        "kafka.enable.idempotence": "true" if acks == "all" else "false",
    }
    opts.update(extra)
    return opts


def publish(messages: DataFrame, bootstrap: str, **kwargs) -> None:
    messages.write.format("kafka").options(**kafka_sink_options(bootstrap, **kwargs)).save()


def parse_messages(frame: DataFrame, schema: StructType, key_field: str = "id",
                   keep: Sequence[str] = ()) -> DataFrame:
    """``CAST(value AS STRING)`` -> ``from_json`` -> flatten -> drop null keys.

    Malformed, truncated, array or bare-number payloads parse to a null key
    and are dropped. An empty-string key is kept (the validity split rejects
    it later). ``keep`` carries frame columns (e.g. partition, offset) along.
    """
    # ``inline`` of a one-element array flattens the parsed struct in a
    # Generate node: the payload is parsed once per row, and the key filter
    # (on the generator's output) cannot be pushed below it, where it would
    # re-parse each payload and pull the parse in front of an earlier
    # repartition. A plain ``data.*`` projection parses once per field.
    parsed = F.from_json(F.col("value").cast("string"), schema)
    rows = frame.select(*keep, F.inline(F.array(parsed)))
    return rows.filter(F.col(key_field).isNotNull())


#: why a message is refused, in the order in which the reasons are looked at
REASONS = ("no payload", "malformed", "no key", "empty key", "no user")
_BROKEN = "__broken"


def parse_with_reasons(frame: DataFrame, schema: StructType, key_field: str = "id",
                       user_field: str = "username", keep: Sequence[str] = ()) -> DataFrame:
    """Parsed records with ``reason`` (null: accepted) and, of refused ones, the
    payload as it came (F1 and F7 in one parse).

    ``parse_messages`` drops what has no key and ``validity_split`` refuses empty
    keys and users; here every message gives one row. A payload that is broken in
    a field but still has its key is accepted with that field null, as there.
    """
    wanted = StructType([*schema.fields, StructField(_BROKEN, StringType())])
    text = F.col("value").cast("string")
    parsed = F.from_json(F.coalesce(text, F.lit("{}")), wanted, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN})
    rows = frame.select(*keep, text.alias("__text"), F.inline(F.array(parsed)))
    key, user = F.col(key_field), F.col(user_field)
    conditions = (F.col("__text").isNull(), key.isNull() & F.col(_BROKEN).isNotNull(), key.isNull(),
                  key.cast("string") == "", F.coalesce(user.cast("string"), F.lit("")) == "")
    reason = F.lit(None).cast("string")
    for name, condition in reversed(list(zip(REASONS, conditions))):
        reason = F.when(condition, F.lit(name)).otherwise(reason)
    rows = rows.withColumn("reason", reason)
    return rows.withColumn("payload", F.when(F.col("reason").isNotNull(), F.col("__text"))) \
        .drop("__text", _BROKEN)


def write_split(checked: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Write ``parse_with_reasons`` once, accepted and refused rows in folders of
    their own; returns reads of both (accepted records, refused ones with reasons)."""
    spark = checked.sparkSession
    (checked.withColumn("refused", F.col("reason").isNotNull())
     .write.partitionBy("refused").parquet(path))
    kinds = StructType([*checked.schema.fields, StructField("refused", BooleanType())])
    rows = spark.read.schema(kinds).parquet(path)
    return (rows.filter(~F.col("refused")).drop("refused", "reason", "payload"),
            rows.filter("refused").drop("refused"))


def enrich(df: DataFrame, batch_start_ms: int, processed_at: str | None = None,
           ts_col: str = "event_ts_ms") -> DataFrame:
    """Processing stamp and latency.

    ``spark_processed_at`` is one ISO UTC value per batch; ``latency_ms`` is
    batch start minus the producer stamp, NULL when the stamp is missing.
    """
    stamp = (F.lit(processed_at) if processed_at is not None
             else iso_utc(F.timestamp_millis(F.lit(batch_start_ms))))
    return (df.withColumn("spark_processed_at", stamp)
              .withColumn("latency_ms", (F.lit(batch_start_ms) - F.col(ts_col)).cast("double")))


def is_valid(id_col: str = "id", username_col: str = "username") -> Column:
    """A record can be keyed and routed: id and username present and non-empty."""
    return ((F.coalesce(F.col(id_col).cast("string"), F.lit("")) != "")
            & (F.coalesce(F.col(username_col).cast("string"), F.lit("")) != ""))


def validity_split(df: DataFrame, id_col: str = "id",
                   username_col: str = "username") -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) rows (F7); invalid ones are counted, never sent."""
    flag = is_valid(id_col, username_col)
    return df.filter(flag), df.filter(~flag)


def validity_counts(df: DataFrame, id_col: str = "id",
                    username_col: str = "username") -> DataFrame:
    """``valid, cnt`` in one pass over the records."""
    return (df.groupBy(is_valid(id_col, username_col).alias("valid"))
              .agg(F.count(F.lit(1)).alias("cnt")))
