"""All record and table schemas, declared once (K8).

Types follow the reference's data model: ids and ISO dates are text, the
producer stamp is epoch milliseconds, latency is a double. Declared
``nullable=False`` is documentation only; ``from_json`` yields nullable
fields and malformed payloads become null rows (dropped by the key filter).
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

MESSAGE_TEXT_FIELDS = [
    "id", "first_name", "last_name", "gender", "address", "post_code",
    "email", "username", "dob", "registered_date", "phone", "picture",
]

# the 13-field user message on the wire
USER_MESSAGE = T.StructType(
    [T.StructField(name, T.StringType(), False) for name in MESSAGE_TEXT_FIELDS]
    + [T.StructField("event_ts_ms", T.LongType(), True)]
)

# what the keyed sink holds: message + processing stamp + latency
CREATED_USERS = T.StructType(
    USER_MESSAGE.fields
    + [T.StructField("spark_processed_at", T.StringType(), True),
       T.StructField("latency_ms", T.DoubleType(), True)]
)

# nested API payload; postcode and street number arrive as number or string,
# declared string so both parse
_s = T.StringType()
API_RESULT = T.StructType([
    T.StructField("name", T.StructType([T.StructField("first", _s), T.StructField("last", _s)])),
    T.StructField("gender", _s),
    T.StructField("location", T.StructType([
        T.StructField("street", T.StructType([T.StructField("number", _s), T.StructField("name", _s)])),
        T.StructField("city", _s),
        T.StructField("state", _s),
        T.StructField("country", _s),
        T.StructField("postcode", _s),
    ])),
    T.StructField("email", _s),
    T.StructField("login", T.StructType([T.StructField("username", _s)])),
    T.StructField("dob", T.StructType([T.StructField("date", _s)])),
    T.StructField("registered", T.StructType([T.StructField("date", _s)])),
    T.StructField("phone", _s),
    T.StructField("picture", T.StructType([T.StructField("medium", _s)])),
])
API_PAYLOAD = T.StructType([T.StructField("results", T.ArrayType(API_RESULT))])

DIM_GENDER = T.StructType([
    T.StructField("gender_id", T.IntegerType(), False),
    T.StructField("gender_code", T.StringType(), False),
    T.StructField("gender_label", T.StringType(), False),
])

USERS_RAW = T.StructType(
    [T.StructField("id", T.StringType(), False),
     T.StructField("first_name", T.StringType(), False),
     T.StructField("last_name", T.StringType(), False),
     T.StructField("gender_id", T.IntegerType(), True)]
    + [T.StructField(n, T.StringType(), True) for n in MESSAGE_TEXT_FIELDS[4:]]
    + [T.StructField("ingested_at", T.TimestampType(), True),
       T.StructField("kafka_sent", T.BooleanType(), True)]
)

USERS_BASELINE = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("gender", T.StringType(), True),
    T.StructField("email", T.StringType(), True),
    T.StructField("username", T.StringType(), True),
    T.StructField("ingested_at", T.TimestampType(), True),
])

MV_GENDER_COUNTS = T.StructType([
    T.StructField("gender_label", T.StringType(), False),
    T.StructField("cnt", T.LongType(), False),
])

# our replacements for UPDATE / log lines
# one row per record handed to the producer: failed attempts (3 = gave up)
# and whether it passed validation; "sent" is valid and failures < 3
DELIVERY_LOG = T.StructType([
    T.StructField("id", T.StringType(), True),
    T.StructField("failures", T.IntegerType(), True),
    T.StructField("valid", T.BooleanType(), True),
])

SENT_LEDGER = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("claim_id", T.StringType(), False),
])

BATCH_METRICS = T.StructType([
    T.StructField("epoch_id", T.LongType(), False),
    T.StructField("rows", T.LongType(), False),
    T.StructField("measured", T.LongType(), False),
    T.StructField("elapsed_ms", T.LongType(), False),
    T.StructField("rows_per_sec", T.DoubleType(), False),
    T.StructField("p50", T.DoubleType(), True),
    T.StructField("p95", T.DoubleType(), True),
    T.StructField("p_max", T.DoubleType(), True),
    T.StructField("sketch", T.BinaryType(), True),
])

# the event message used with the driver's ``events`` table: same envelope as
# the user message (text id and username, producer stamp), event payload
EVENT_MESSAGE = T.StructType([
    T.StructField("id", T.StringType(), True),
    T.StructField("username", T.StringType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("props", T.StructType([T.StructField("k", T.LongType(), True)]), True),
    T.StructField("event_ts_ms", T.LongType(), True),
])

# key/value frame of the message bus
MESSAGE_FRAME = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])

TABLES = {
    "dim_gender": DIM_GENDER,
    "users_raw": USERS_RAW,
    "users_baseline": USERS_BASELINE,
    "mv_gender_counts": MV_GENDER_COUNTS,
    "created_users": CREATED_USERS,
    "delivery_log": DELIVERY_LOG,
    "sent_ledger": SENT_LEDGER,
    "batch_metrics": BATCH_METRICS,
}


def ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


#: tables whose rows are looked up by id: bucketed by it, they meet without a shuffle
BY_ID = ("users_raw", "users_baseline", "sent_ledger")


def create_tables(spark: SparkSession, database: str, location: str,
                  buckets: int | None = None) -> list[str]:
    """Idempotent ``CREATE DATABASE/TABLE IF NOT EXISTS`` for every table (K8).

    With ``buckets`` the ``BY_ID`` tables are bucketed and sorted by id. A catalog
    that does not outlive the session gets the same tables declared again over
    the same files; the number of buckets must then be the same.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    made = []
    for name, schema in TABLES.items():
        by_id = (f"CLUSTERED BY (id) SORTED BY (id) INTO {int(buckets)} BUCKETS "
                 if buckets and name in BY_ID else "")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({ddl(schema)}) "
            f"USING parquet {by_id}LOCATION '{location}/{name}'"
        )
        made.append(name)
    return made
