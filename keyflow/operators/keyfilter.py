"""A Bloom filter of keys as a small table, from built-in functions only.

A load's keys set bits in ``blocks`` bitmaps of 32,768 bits each: a key's hash
names its block, further hashes the bits in it. A row of a large table is kept if
all bits of its key are set: every row whose key is in the load, and a few
others. The filter has at most ``MOST_BLOCKS`` rows of 4 KB whatever the load, so
it may be broadcast; the large table's rows leave the plan right above its scan,
before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 32768
#: 16 MB of bits: some 13 million keys at a hundredth of false hits
MOST_BLOCKS = 4096
HASHES = 5


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _bits(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(BLOCK_BITS)).cast("int") for i in range(HASHES)]


def blocks_for(keys: int) -> int:
    """Blocks for a number of keys (ten bits a key), within the bound."""
    return max(1, min(MOST_BLOCKS, -(-10 * keys // BLOCK_BITS)))


def key_filter(keys: DataFrame, key: str, blocks: int = MOST_BLOCKS) -> DataFrame:
    """``block, words``: the bitmaps of the keys, as 512 longs each. Null keys set no bit."""
    if not 0 < blocks <= MOST_BLOCKS:
        raise ValueError(f"1 to {MOST_BLOCKS} blocks")
    k = F.col(key)
    bitmaps = (keys.filter(k.isNotNull())
               .select(_block(k, blocks).alias("block"), F.explode(F.array(*_bits(k))).alias("bit"))
               .groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits")))
    word = lambda i: F.conv(F.hex(F.substring("bits", i * 8 + 1, F.lit(8))), 16, -10).cast("long")
    return bitmaps.select("block", F.transform(F.sequence(F.lit(0), F.lit(BLOCK_BITS // 64 - 1)), word)
                          .alias("words"))


def may_hold(df: DataFrame, key: str, filtered: DataFrame, blocks: int = MOST_BLOCKS) -> DataFrame:
    """Rows whose key may be in the filter (``blocks`` as it was built with)."""
    k = F.col(key)
    f = filtered.select(F.col("block").alias("__block"), F.col("words").alias("__words"))
    hit = _block(k, blocks) == F.col("__block")
    for bit in _bits(k):
        # a word holds 8 bytes, the first one highest; inside a byte the first bit is lowest
        place = (7 - F.floor(bit / 8) % 8) * 8 + bit % 8
        word = F.get("__words", F.floor(bit / 64).cast("int"))
        hit &= F.getbit(word, place.cast("int")) == 1
    return df.join(F.broadcast(f), hit, "left_semi")
