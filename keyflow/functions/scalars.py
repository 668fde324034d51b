"""Scalar column expressions.

Randomness is derived from a hash of (seed, salt, key) instead of
``rand(seed)``: ``rand`` depends on partitioning, so the same seed would give
different rows on a different cluster size. A hash of the row key gives the
same row on 1 or 1000 executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX = "0123456789abcdef"


def hash_int(key: Column, seed: int, salt: str) -> Column:
    """A non-negative 63-bit integer, independent per ``salt``."""
    return F.abs(F.xxhash64(F.lit(seed), F.lit(salt), key) % F.lit(2**62))


def uniform_int(key: Column, seed: int, salt: str, lo: int, hi: int) -> Column:
    """Deterministic integer in ``[lo, hi]`` for each key."""
    return (hash_int(key, seed, salt) % F.lit(hi - lo + 1) + F.lit(lo)).cast("int")


def pick(pool: Sequence[str], key: Column, seed: int, salt: str) -> Column:
    """Deterministic choice from a literal pool (``element_at`` is 1-based)."""
    arr = F.array(*[F.lit(v) for v in pool])
    return F.element_at(arr, uniform_int(key, seed, salt, 1, len(pool)))


def random_letters(key: Column, seed: int, salt: str, n: int) -> Column:
    letters = "abcdefghijklmnopqrstuvwxyz"
    return F.concat(*[pick(list(letters), key, seed, f"{salt}{i}") for i in range(n)])


def seeded_uuid4(key: Column, seed: int) -> Column:
    """UUID version 4 text from md5(seed:key): version nibble 4, variant 8-b.

    Same digits in any SQL engine with md5/substr/instr, so it can be checked
    against an oracle.
    """
    h = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    variant_idx = (F.instr(F.lit(HEX), F.substring(h, 17, 1)) - 1) % 4 + 1
    return F.lower(F.concat(
        F.substring(h, 1, 8), F.lit("-"),
        F.substring(h, 9, 4), F.lit("-4"),
        F.substring(h, 14, 3), F.lit("-"),
        F.substring(F.lit("89ab"), variant_idx, 1), F.substring(h, 18, 3), F.lit("-"),
        F.substring(h, 21, 12),
    ))


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text with microseconds and ``+00:00`` (session zone UTC)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def epoch_ms(ts: Column) -> Column:
    """Epoch milliseconds of a ``timestamp_ntz`` read as UTC wall time.

    ``timestamp_diff`` on two zone-less values does not consult the session
    time zone, so the result is the same on any cluster configuration.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MILLISECOND", epoch, ts.cast("timestamp_ntz"))


def epoch_ms_ltz(ts: Column) -> Column:
    """Epoch milliseconds of an instant (``timestamp``)."""
    return F.unix_millis(ts)
