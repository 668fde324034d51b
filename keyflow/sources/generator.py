"""Synthetic record generators.

Both are pure projections over a key column, so they run fully distributed:
``spark.range`` or any key table gives the rows, hash arithmetic gives the
values. The same key and seed give the same record on any partitioning.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.functions.scalars import iso_utc, pick, random_letters, seeded_uuid4, uniform_int

# The generator's value pools.
FIRST_NAMES = ["James", "Mary", "John", "Patricia", "Robert", "Jennifer",
               "Michael", "Linda", "William", "Barbara", "David", "Susan",
               "Liam", "Emma", "Noah", "Olivia", "Aiden", "Sophia",
               "Lucas", "Mia", "Ethan", "Charlotte", "Mason", "Amelia"]
LAST_NAMES = ["Smith", "Johnson", "Williams", "Brown", "Jones", "Garcia",
              "Miller", "Davis", "Martinez", "Hernandez", "Lopez", "Wilson",
              "Anderson", "Thomas", "Taylor", "Moore", "Jackson", "Lee"]
CITIES = ["New York", "Los Angeles", "Chicago", "Houston", "Phoenix",
          "Toronto", "London", "Sydney", "Berlin", "Paris", "Tokyo",
          "Mumbai", "São Paulo", "Seoul", "Mexico City", "Cairo"]
STATES = ["California", "Texas", "New York", "Florida", "Illinois",
          "Ontario", "England", "New South Wales", "Bavaria", "Île-de-France"]
COUNTRIES = ["US", "CA", "GB", "AU", "DE", "FR", "JP", "IN", "BR", "KR"]
GENDERS = ["male", "female"]
DOMAINS = ["gmail.com", "yahoo.com", "outlook.com", "hotmail.com", "icloud.com"]
STREETS = ["Main", "Oak", "Maple", "Cedar", "Pine", "Elm", "Washington",
           "Park", "Lake", "Hill", "River", "Forest", "Sunset", "Highland"]
PICTURE = "https://randomuser.me/api/portraits/placeholder.jpg"
# dob range: years 1950-2000, months 1-12, days 1-28

DEFAULT_SEED = 42


def generate_users(keys: DataFrame, key_col: str = "key", seed: int = DEFAULT_SEED,
                   now_ms: int | None = None, keep_key: str | None = None) -> DataFrame:
    """One 13-field user record per key.

    ``now_ms`` stamps ``registered_date`` and ``event_ts_ms``; pass it for
    reproducible output, leave it out to use the wall clock at plan time.
    """
    now_ms = int(time.time() * 1000) if now_ms is None else now_ms
    k = F.col(key_col)
    first = pick(FIRST_NAMES, k, seed, "first")
    last = pick(LAST_NAMES, k, seed, "last")
    u = lambda salt, lo, hi: uniform_int(k, seed, salt, lo, hi)
    now_ts = F.timestamp_millis(F.lit(now_ms))
    cols = [
        seeded_uuid4(k, seed).alias("id"),
        first.alias("first_name"),
        last.alias("last_name"),
        pick(GENDERS, k, seed, "gender").alias("gender"),
        F.concat(u("house", 1, 9999).cast("string"), F.lit(" "), pick(STREETS, k, seed, "street"),
                 F.lit(" St, "), pick(CITIES, k, seed, "city"), F.lit(", "),
                 pick(STATES, k, seed, "state"), F.lit(", "),
                 pick(COUNTRIES, k, seed, "country")).alias("address"),
        u("post", 10000, 99999).cast("string").alias("post_code"),
        F.concat(F.lower(first), F.lit("."), F.lower(last), u("mailno", 1, 999).cast("string"),
                 F.lit("@"), pick(DOMAINS, k, seed, "domain")).alias("email"),
        F.concat(F.lower(first), random_letters(k, seed, "user", 4)).alias("username"),
        F.concat(u("year", 1950, 2000).cast("string"), F.lit("-"),
                 F.lpad(u("month", 1, 12).cast("string"), 2, "0"), F.lit("-"),
                 F.lpad(u("day", 1, 28).cast("string"), 2, "0"),
                 F.lit("T00:00:00.000Z")).alias("dob"),
        iso_utc(now_ts).alias("registered_date"),
        F.concat(F.lit("("), u("ph1", 100, 999).cast("string"), F.lit(") "),
                 u("ph2", 100, 999).cast("string"), F.lit("-"),
                 u("ph3", 1000, 9999).cast("string")).alias("phone"),
        F.lit(PICTURE).alias("picture"),
        F.lit(now_ms).cast("long").alias("event_ts_ms"),
    ]
    if keep_key:
        cols.insert(0, k.alias(keep_key))
    return keys.select(*cols)


def generate_user_batch(spark: SparkSession, n: int, seed: int = DEFAULT_SEED,
                        now_ms: int | None = None, offset: int = 0) -> DataFrame:
    """``n`` users keyed ``offset .. offset+n-1``; ``spark.range`` splits the work."""
    keys = spark.range(offset, offset + n).withColumnRenamed("id", "key")
    return generate_users(keys, "key", seed, now_ms)


def fact_series(spark: SparkSession, n: int, num_partitions: int | None = None) -> DataFrame:
    """Sequence rows ``g = 1..n`` in both layouts' columns.

    ``dim_id = g % 2 + 1`` is the fact layout's key; ``gender`` the flat
    layout's text (even g is male).
    """
    return layout_rows(spark.range(1, n + 1, numPartitions=num_partitions), "id")


def layout_rows(keys: DataFrame, key: str) -> DataFrame:
    """The columns of ``fact_series`` for the integer keys of any table."""
    g = F.col(key)
    return keys.select(
        g.alias("g"), (g % 2 + 1).cast("int").alias("dim_id"),
        F.concat(F.lit("u"), g.cast("string"), F.lit("@x.com")).alias("email"),
        F.concat(F.lit("user"), g.cast("string")).alias("username"),
        F.when(g % 2 == 0, F.lit("male")).otherwise(F.lit("female")).alias("gender"))


def gender_dimension(spark: SparkSession) -> DataFrame:
    """The two-row gender dimension (``gender_id`` 1 = male, 2 = female)."""
    return spark.createDataFrame(
        [(1, "male", "Male"), (2, "female", "Female")],
        "gender_id int, gender_code string, gender_label string")
