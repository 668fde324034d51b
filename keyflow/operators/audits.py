"""Audits that compare summaries first and open only what differs.

* ``DigestTree``: digests of a table by key range, at several widths. Two copies
  are compared from the widest ranges down; only the leaf ranges that differ are
  read row by row, so equal ranges are never shuffled by key.
* ``offset_bitmaps``: one bitmap per bus partition and block of offsets. What was
  lost or is too much is a count of bits; single offsets are listed only for
  blocks that lost some.

Both are partial aggregates: a hot range or block is combined inside each task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.operators.checks import row_digest, table_diff

#: bits of one bitmap, fixed by the bitmap functions
BLOCK_BITS = 32768


def key_range(key: str | Column, low: int, high: int, leaves: int) -> Column:
    """Number of the range that an integer key falls into: ``low..high`` cut into
    at most ``leaves`` ranges of one width; keys outside belong to the end ranges,
    null keys to range -1."""
    k = F.col(key) if isinstance(key, str) else key
    width = max(1, -(-(high - low + 1) // leaves))
    at = F.floor((k - F.lit(low)) / F.lit(width)).cast("long")
    return F.coalesce(F.greatest(F.least(at, F.lit(leaves - 1)), F.lit(0)), F.lit(-1)).cast("long")


def token_range(key: str | Column, leaves: int) -> Column:
    """Number of the range of hash tokens that a key of any type falls into."""
    return F.pmod(F.xxhash64(key), F.lit(leaves)).cast("long")


class DigestTree:
    """Digests of a table by key range, stored as Parquet, one folder per level.

    Level 0 holds the leaf ranges; a range of the next level covers ``fanout`` of
    them. A digest is the number of rows and two sums of halves of their 64-bit
    digests: any order and any split over tasks gives the same. There are at most
    as many ranges as the leaf expression has values, whatever the table's size.
    """

    def __init__(self, spark: SparkSession, path: str, levels: int = 3, fanout: int = 16):
        self.spark, self.path, self.levels, self.fanout = spark, path, levels, fanout

    def build(self, rows: DataFrame, key: str, value_cols: Sequence[str], leaf: Column) -> None:
        """One pass over the table; the upper levels sum up the level below."""
        digest = row_digest([key, *value_cols])
        leaves = (rows.select(leaf.alias("range"), digest.alias("h")).groupBy("range").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.shiftright("h", 32)).alias("high"),
            F.sum(F.col("h").bitwiseAND(F.lit(0xFFFFFFFF))).alias("low")))
        leaves.write.mode("overwrite").parquet(f"{self.path}/level=0")
        for level in range(1, self.levels):
            up = F.floor(F.col("range") / self.fanout).alias("range")
            (self.level(level - 1).groupBy(up).agg(*(F.sum(c).alias(c) for c in ("n", "high", "low")))
             .write.mode("overwrite").parquet(f"{self.path}/level={level}"))

    def level(self, level: int) -> DataFrame:
        return (self.spark.read.schema("range long, n long, high long, low long")
                .parquet(f"{self.path}/level={level}"))

    def differing(self, other: DigestTree) -> DataFrame:
        """Leaf ranges whose digests differ (``range``), found from the top level
        down: below a range that agrees nothing is compared."""
        found: DataFrame | None = None
        for level in range(self.levels - 1, -1, -1):
            a, b = self.level(level), other.level(level)
            if found is not None:
                up = F.floor(F.col("range") / self.fanout)
                a, b = (x.join(found, up == F.col("parent"), "left_semi") for x in (a, b))
            b = b.select(*[F.col(c).alias(f"r_{c}") for c in b.columns])
            both = a.join(b, F.col("range") == F.col("r_range"), "full")
            same = None
            for c in ("n", "high", "low"):
                eq = F.col(c).eqNullSafe(F.col(f"r_{c}"))
                same = eq if same is None else same & eq
            found = both.filter(~same).select(
                F.coalesce("range", "r_range").alias("parent" if level else "range"))
        return found


def table_diff_in_ranges(left: DataFrame, right: DataFrame, key: str, value_cols: Sequence[str],
                         leaf: Column, ranges: DataFrame) -> DataFrame:
    """``table_diff`` of the rows in ``ranges`` (D4). The ranges are as many as
    the leaf expression has values at most, so they may be broadcast; the rows of
    all other ranges leave the plan before the shuffle by key."""
    wanted = F.broadcast(ranges.select(F.col("range").alias("__range")))
    sides = [df.join(wanted, leaf == F.col("__range"), "left_semi") for df in (left, right)]
    return table_diff(*sides, key, value_cols)


def offset_bitmaps(frame: DataFrame, partition: str = "partition",
                   offset: str = "offset") -> DataFrame:
    """``part, block, bits, n``: which offsets a bus partition holds, and how many
    rows. Rows without an offset form the block null of their partition."""
    o = F.col(offset).cast("long")
    at = F.when(o.isNotNull(), F.pmod(o, F.lit(BLOCK_BITS))).otherwise(0)
    return (frame.select(F.col(partition).alias("part"),
                         F.floor(o / BLOCK_BITS).cast("long").alias("block"), at.alias("at"))
            .groupBy("part", "block")
            .agg(F.bitmap_construct_agg("at").alias("bits"), F.count(F.lit(1)).alias("n")))


def _both_sides(produced: DataFrame, consumed: DataFrame) -> DataFrame:
    """Bitmaps of both sides by block: ``p, c`` (bits), ``np, nc`` (rows), ``either``."""
    none = F.lit(bytearray(BLOCK_BITS // 8))

    def side(df: DataFrame, own: str, other: str) -> DataFrame:
        return df.select("part", "block", F.col("bits").alias(own), none.alias(other),
                         F.col("n").alias(f"n{own}"), F.lit(0).cast("long").alias(f"n{other}"))

    tagged = side(produced, "p", "c").unionByName(side(consumed, "c", "p"))
    return tagged.withColumn("either", F.coalesce(
        F.when(F.col("np") > 0, F.col("p")), F.col("c"))).groupBy("part", "block").agg(
        F.bitmap_or_agg("p").alias("p"), F.bitmap_or_agg("c").alias("c"),
        F.bitmap_or_agg("either").alias("either"), F.sum("np").alias("np"), F.sum("nc").alias("nc"))


def loss_audit_bitmaps(produced: DataFrame, consumed: DataFrame, partition: str = "partition",
                       offset: str = "offset") -> DataFrame:
    """Per bus partition: ``missing``, ``extra`` and ``duplicated`` offsets, as
    ``loss_audit`` counts them (D3), from bitmaps.

    Bitmaps forget how often an offset stands there. Where no offset of a block
    was produced twice, the consumed rows beyond the bits are the duplicates; only
    blocks that were produced *and* consumed with repeats are opened and counted
    by offset.
    """
    blocks = _both_sides(offset_bitmaps(produced, partition, offset),
                         offset_bitmaps(consumed, partition, offset))
    p, c = F.bitmap_count("p"), F.bitmap_count("c")
    blocks = blocks.select(
        "part", "block", (F.bitmap_count("either") - c).alias("missing"),
        (F.bitmap_count("either") - p).alias("extra"), (F.col("nc") - c).alias("again"),
        ((F.col("np") > p) & (F.col("nc") > c)).alias("open"))
    opened = blocks.filter("open").select(F.col("part").alias("__p"), F.col("block").alias("__b"))

    def rows(df: DataFrame, own: int) -> DataFrame:
        o = F.col(offset).cast("long")
        at = df.select(F.col(partition).alias("part"), o.alias("o"),
                       F.floor(o / BLOCK_BITS).cast("long").alias("block"))
        hit = at.join(opened, F.col("part").eqNullSafe(F.col("__p"))
                      & F.col("block").eqNullSafe(F.col("__b")), "left_semi")
        return hit.select("part", "block", "o", F.lit(own).alias("p"), F.lit(1 - own).alias("c"))

    counted = (rows(produced, 1).unionByName(rows(consumed, 0)).groupBy("part", "block", "o")
               .agg(F.sum("p").alias("p"), F.sum("c").alias("c"))
               .select("part", F.greatest(F.col("c") - F.greatest(F.col("p"), F.lit(1)), F.lit(0))
                       .alias("again")))
    simple = blocks.select("part", "missing", "extra",
                           F.when(~F.col("open"), F.col("again")).otherwise(0).alias("again"))
    zero = F.lit(0).cast("long")
    return (simple.unionByName(counted.select("part", zero.alias("missing"), zero.alias("extra"),
                                              F.col("again")))
            .groupBy("part").agg(*(F.sum(a).cast("long").alias(b) for a, b in (
                ("missing", "missing"), ("extra", "extra"), ("again", "duplicated")))))


def lost_offsets(produced: DataFrame, consumed: DataFrame, partition: str = "partition",
                 offset: str = "offset") -> DataFrame:
    """``part, offset`` of what was produced and never consumed (D3). Only blocks
    that lost something are opened, byte by byte of their bitmaps."""
    blocks = _both_sides(offset_bitmaps(produced.filter(F.col(offset).isNotNull()), partition, offset),
                         offset_bitmaps(consumed.filter(F.col(offset).isNotNull()), partition, offset))
    lossy = blocks.filter(F.bitmap_count("either") > F.bitmap_count("c"))
    byte = lossy.select("part", "block", "c", "either",
                        F.explode(F.sequence(F.lit(0), F.lit(BLOCK_BITS // 8 - 1))).alias("i"))

    def value(bits: str) -> Column:
        return F.conv(F.hex(F.substring(bits, F.col("i") + 1, F.lit(1))), 16, 10).cast("int")

    gone = value("either").bitwiseAND(F.bitwise_not(value("c")))
    return (byte.select("part", "block", "i", gone.alias("gone")).filter("gone <> 0")
            .select("part", "block", "i", "gone", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("j"))
            .filter("(gone >> j) & 1 = 1")
            .select("part", (F.col("block") * BLOCK_BITS + F.col("i") * 8 + F.col("j")).alias("offset")))
