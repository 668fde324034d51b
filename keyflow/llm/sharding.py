"""Shard assignment by vector bin packing: bytes, tokens and rows together.

The unit of placement is a *cell*: equal texts hash to one cell, so a group of
copies moves together. Cells are summed by Spark to (bytes, tokens, rows) and
placed, largest first, where the dot product of the cell's vector with the
shard's residual capacity is highest; all three dimensions weigh the same. Then
units move one at a time from the shard that is fullest to the one that is emptiest
in some dimension, as long as the sum of squared unevenness falls (bytes, the law,
count four times in it). The number of cells is a parameter, so
what the driver places has a fixed bound whatever the input holds. Groups
larger than a small share of a shard are taken out of their cells: they get
their own unit, and those over ``split_over`` of a shard are dealt over several
units, because no whole placement of them could be even. At most
``shards * FINE * 3`` groups can be over that share, which bounds this list too.

Slots come from counts: a cell's place in its shard is the sum of the cells
before it, and each cell is dealt over strips of about ``STRIP`` rows by a hash
of the row. Rows are numbered inside strips only, so what one task orders does
not grow with the input, and no task sees a shard or a cell.

Defined results: a null text has no bytes and no tokens; a text larger than its
shard's share stands alone there as far as the others allow; rows repeated with
one id are separate rows with slots of their own; an empty table gives an
empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, text_or_empty

#: cells per table, the bound of what the driver places
CELLS = 16384
#: groups over 1 / FINE of a shard leave their cell
FINE = 32
#: groups over this share of a shard are dealt over several units
SPLIT_OVER = 0.5
#: rows that are numbered together, about
STRIP = 1 << 16
#: weight of bytes, tokens and rows in the dot product
WEIGHTS = (1.0, 1.0, 1.0)
#: weight of their unevenness while units are moved afterwards: bytes are the law
EVEN_WEIGHTS = (4.0, 1.0, 1.0)
#: units that are moved at most
MOVES = 4000


def measured(docs: DataFrame, cells: int) -> DataFrame:
    """doc_id, size, text_crc32, tokens, grp, row and cell of every row."""
    text = text_or_empty()
    words = F.size(F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " "))
    return docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.when(text == "", F.lit(0)).otherwise(words).cast("long").alias("tokens"),
        F.xxhash64(text).alias("grp"), F.monotonically_increasing_id().alias("row"),
    ).withColumn("cell", F.pmod("grp", F.lit(cells)).cast("int"))


def place(vectors: np.ndarray, shards: int, weights: tuple[float, ...] = WEIGHTS) -> np.ndarray:
    """Shard of each row of ``vectors``: largest first, each to the shard whose
    residual capacity has the highest dot product with it."""
    share = vectors / np.maximum(vectors.sum(axis=0) / shards, 1e-12)
    weighted = share * np.asarray(weights)
    residual = np.ones((shards, share.shape[1]))
    out = np.zeros(len(share), dtype=np.int64)
    for i in np.argsort(-(weighted.sum(axis=1)), kind="stable"):
        best = int(np.argmax(residual @ weighted[i]))
        out[i] = best
        residual[best] -= share[i]
    return out


def even_out(vectors: np.ndarray, home: np.ndarray, shards: int,
             weights: tuple[float, ...] = EVEN_WEIGHTS, moves: int = MOVES) -> np.ndarray:
    """``home`` with single units moved between shards while that makes the
    weighted squares of the shards' deviations smaller."""
    share = vectors / np.maximum(vectors.sum(axis=0) / shards, 1e-12)
    w, home = np.asarray(weights), home.copy()
    load = np.zeros((shards, share.shape[1]))
    np.add.at(load, home, share)
    done: set[tuple[int, int]] = set()  # pairs of shards that no move improves any more
    for _ in range(moves):
        best = (-1e-12, -1, -1, -1)
        for d in range(share.shape[1]):
            a, b = int(np.argmax(load[:, d])), int(np.argmin(load[:, d]))
            if a == b or (a, b) in done:
                continue
            own = np.flatnonzero(home == a)
            gap = load[b] - load[a]
            # change of the squares when a unit u goes from a to b: 2 u (load_b - load_a + u)
            change = (2 * share[own] * (gap + share[own])) @ w
            k = int(np.argmin(change)) if len(own) else -1
            if k < 0 or change[k] >= -1e-12:
                done.add((a, b))
            elif change[k] < best[0]:
                best = (float(change[k]), int(own[k]), a, b)
        if best[1] < 0:
            break
        _, unit, a, b = best
        load[a] -= share[unit]
        load[b] += share[unit]
        home[unit] = b
        done = {p for p in done if a not in p and b not in p}
    return home


def vector_shards(docs: DataFrame, shards: int = 24, cells: int = CELLS,
                  split_over: float = SPLIT_OVER, strip: int = STRIP) -> DataFrame:
    """doc_id, size, text_crc32, tokens, shard and slot (gapless from 0) per row."""
    spark: SparkSession = docs.sparkSession
    rows = materialize(measured(docs, cells), "shard-sizes")
    dims = ("size", "tokens", "rows")
    totals = rows.agg(F.sum("size"), F.sum("tokens"), F.count(F.lit(1))).first()
    totals = [float(x or 0) for x in totals]

    # groups with more than 1/FINE of a shard in any dimension: a bounded list
    fine = [max(t / (shards * FINE), 1e-9) for t in totals]
    sums = rows.groupBy("grp").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"),
                                   F.count(F.lit(1)).alias("rows"))
    over = F.greatest(*(F.col(d) / F.lit(f) for d, f in zip(dims, fine, strict=True)))
    heavy = [(r["grp"], max(1, int(np.ceil(r["over"])) if r["rows"] > 1 else 1),
              r["over"] > split_over * FINE)
             for r in sums.filter("rows > 1").withColumn("over", over).filter("over > 1")
             .select("grp", "rows", "over").collect()]
    # chunk ids follow the cells; chunks of a whole group share their placement unit
    first, listed = cells, []
    for grp, n, split in sorted(heavy):
        listed.append((grp, first, n, split))
        first += n
    unit_of = {}
    for _, base, n, split in listed:
        for k in range(n):
            unit_of[base + k] = base + k if split else base
    heavy_df = spark.createDataFrame([(g, b, n) for g, b, n, _ in listed],
                                     "grp long, base int, n int")
    chunk = F.when(F.col("base").isNull(), F.col("cell")).otherwise(
        F.col("base") + F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                                          F.lit(7)), F.col("n")).cast("int"))
    rows = rows.join(F.broadcast(heavy_df), "grp", "left").withColumn("chunk", chunk)

    parts = (rows.groupBy("chunk")
             .agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"),
                  F.count(F.lit(1)).alias("rows")).orderBy("chunk").collect())
    units: dict[int, np.ndarray] = {}
    for r in parts:
        u = unit_of.get(r["chunk"], r["chunk"])
        units[u] = units.get(u, np.zeros(3)) + np.array([r["size"], r["tokens"], r["rows"]], float)
    names = sorted(units)
    vectors = np.array([units[u] for u in names]).reshape(-1, 3)
    homes = even_out(vectors, place(vectors, shards), shards)
    shard_of = dict(zip(names, homes.tolist(), strict=True))
    offset, used = [], [0] * shards
    for r in parts:
        s = shard_of[unit_of.get(r["chunk"], r["chunk"])]
        offset.append((r["chunk"], int(s), used[s], max(1, -(-r["rows"] // strip))))
        used[s] += r["rows"]
    where = spark.createDataFrame(offset, "chunk int, shard int, before long, strips long")

    strip_of = F.pmod(F.xxhash64("row"), F.col("strips"))
    placed = rows.join(F.broadcast(where), "chunk").withColumn("strip", strip_of)
    earlier = (Window.partitionBy("chunk").orderBy("strip")
               .rowsBetween(Window.unboundedPreceding, -1))
    starts = (placed.groupBy("chunk", "strip").agg(F.count(F.lit(1)).alias("n"))
              .select("chunk", "strip", F.coalesce(F.sum("n").over(earlier), F.lit(0))
                      .alias("start")))
    inside = Window.partitionBy("chunk", "strip").orderBy("doc_id", "text_crc32", "size", "row")
    return (placed.withColumn("rank", F.row_number().over(inside))
            .join(starts, ["chunk", "strip"])
            .select("doc_id", "size", "text_crc32", "tokens", "shard",
                    (F.col("before") + F.col("start") + F.col("rank") - 1).alias("slot")))
