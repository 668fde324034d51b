"""Column-level helpers; all built-in Spark expressions (JVM side, codegen)."""

from keyflow.functions.scalars import (
    epoch_ms,
    hash_int,
    iso_utc,
    pick,
    seeded_uuid4,
    uniform_int,
)

__all__ = ["epoch_ms", "hash_int", "iso_utc", "pick", "seeded_uuid4", "uniform_int"]
