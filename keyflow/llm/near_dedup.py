"""Near-duplicate groups with SetSketch registers.

Sketch: register i of a set is ``floor(1 - log_b(min x))`` over exponentially
distributed values ``x`` of its elements, truncated to 16 bits. Registers merge
by maximum and two sets agree in a register with about their Jaccard
similarity; ``BANDS`` bands of ``ROWS`` registers are the keys of the candidate
search (a pair at 0.85 meets in no band with probability 4e-7).

Equal sets are one node from the start, so copies cost nothing further. In each
bucket every node is compared with one hub, a pair per node; the links give
components. Buckets that then still hold several components are gone through in
blocks: nodes outside the bucket's largest component against all its nodes, two
blocks of rows at a time. A pair goes on if the joint likelihood of its
registers does not rule the similarity out, and is a link if the full sets
confirm it; only links leave a task. So no pair that meets in a band is lost,
groups of near copies cost one comparison a node, and no task holds a bucket.

Defined results: null texts and texts without words have an empty set, are
linked with nothing and stay; rows repeated with one id are judged each by its
text; a component without any id has component_id null and its rows stay (ids
are the tie break, so without them there is none). An empty table gives an
empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_or_empty
from .components import components
from .shingles import mixed, shingle_set

BANDS = 20
ROWS = 4
REGISTERS = BANDS * ROWS
BASE = 1.001
RATE = 20.0
LARGEST = (1 << 16) - 1
#: rows of one side of a block
BLOCK = 256
#: a pair is dropped unread only if its registers are e^-14 as likely at the
#: threshold as at their best similarity
MARGIN = 14.0
_RNG = np.random.default_rng(10)
_SALT = _RNG.integers(1, 1 << 63, size=REGISTERS, dtype=np.uint64)
_MULTIPLY = _RNG.integers(1, 1 << 62, size=REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def registers_of(sets: list[np.ndarray]) -> np.ndarray:
    """One row of registers per (non-empty) set."""
    values = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    least = np.empty((len(sets), REGISTERS), dtype=np.uint64)
    v, shifted = np.empty_like(values), np.empty_like(values)
    for i in range(REGISTERS):
        np.add(values, _SALT[i], out=v)
        v *= _MULTIPLY[i]
        np.right_shift(v, np.uint64(31), out=shifted)
        v ^= shifted
        v *= np.uint64(0x9FB21C651E98DF25)
        least[:, i] = np.minimum.reduceat(v, starts)
    return truncated((least.astype(np.float64) + 0.5) / 2.0 ** 64)


def truncated(u: np.ndarray) -> np.ndarray:
    """Registers from the least uniform value of each."""
    x = -np.log1p(-np.minimum(u, 1 - 1e-16)) / RATE
    return np.clip(np.floor(1 - np.log(x) / math.log(BASE)), 0, LARGEST).astype("<u2")


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def likely(greater: np.ndarray, less: np.ndarray, n_a: np.ndarray, n_b: np.ndarray,
           similarity: float, margin: float = MARGIN) -> np.ndarray:
    """Whether the registers leave room for ``similarity`` or more.

    ``greater`` and ``less`` count registers in which a is above or below b.
    With u, v the shares of the set sizes, a register is greater with
    probability p(u - vJ) and less with p(v - uJ), p(x) = -log_b(1 - x(b-1)/b).
    The likelihood has one peak in J; a pair stays if the peak is at or above
    the threshold, or the threshold is at most ``margin`` below it.
    """
    equal = REGISTERS - greater - less
    u = n_a / (n_a + n_b)
    v = 1 - u
    top = np.minimum(u / v, v / u)

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-x * (BASE - 1) / BASE) / math.log(BASE)

    def log_likelihood(j: np.ndarray) -> np.ndarray:
        g = np.clip(p(u - v * j), 1e-12, 1)
        w = np.clip(p(v - u * j), 1e-12, 1)
        e = np.clip(1 - g - w, 1e-12, 1)
        return greater * np.log(g) + less * np.log(w) + equal * np.log(e)

    at = log_likelihood(np.minimum(similarity, top))
    best = at
    for j in np.linspace(0, 1, 21)[:-1]:
        best = np.maximum(best, np.where(j < similarity, log_likelihood(np.minimum(j, top)), best))
    return at >= best - margin


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n, sig and bands (the registers, four to a long) of every row."""

    def sketch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                sets = [shingle_set(t) for t in part.column(2).to_pylist()]
                full = [s for s in sets if len(s)]
                regs = iter(registers_of(full).view("<i8") if full else ())
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([signature(s) for s in sets], pa.binary()),
                    pa.array([next(regs) if len(s) else None for s in sets],
                             pa.list_(pa.int64()))],
                    names=["doc_id", "text_key", "n", "sig", "bands"])

    kind = dict(docs.dtypes)["doc_id"]
    text = text_or_empty()
    return docs.select("doc_id", F.xxhash64(text).alias("text_key"), text.alias("text")).mapInArrow(
        sketch, f"doc_id {kind}, text_key long, n long, sig binary, bands array<long>")


def signature(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(sig, elements) for the (text_key, sig) rows of ``wanted``."""

    def sets(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for at in range(0, batch.num_rows, 128):
                sigs, out = [], []
                for sig, text in zip(*(c.to_pylist() for c in batch.slice(at, 128).columns),
                                     strict=True):
                    s = shingle_set(text)
                    if signature(s) == sig:  # else another text with this key
                        sigs.append(sig)
                        out.append(s.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(sigs, pa.binary()),
                                                  pa.array(out, pa.large_binary()).cast(pa.binary())],
                                                 names=["sig", "elements"])

    text = text_or_empty()
    return (docs.select(F.xxhash64(text).alias("text_key"), text.alias("text"))
            .join(wanted.select("text_key", "sig"), "text_key").select("sig", "text")
            .mapInArrow(sets, "sig binary, elements binary")
            .groupBy("sig").agg(F.first("elements").alias("elements")))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""

    def confirm(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                s, t = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                both = np.concatenate((s, t))
                both.sort()
                n = int((both[1:] == both[:-1]).sum())
                keep.append(100 * n >= percent * (len(s) + len(t) - n))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)],
                                             names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_a = pairs.join(sets.select(F.col("sig").alias("a"), F.col("elements").alias("x")), "a")
    both = with_a.join(sets.select(F.col("sig").alias("b"), F.col("elements").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(confirm, "a binary, b binary")


def plausible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and registers leave room for the similarity."""
    for end in "ab":
        pairs = pairs.join(nodes.select(F.col("sig").alias(end), F.col("n").alias(f"n_{end}"),
                                        F.col("bands").alias(f"bands_{end}")), end)
    fits = pairs.filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))

    def keep(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            if batch.num_rows:
                x, y = (np.stack([np.asarray(v, "<i8") for v in batch.column(i).to_pylist()])
                        .view("<u2") for i in (4, 5))
                n, m = (batch.column(i).to_numpy().astype(float) for i in (2, 3))
                ok = likely((x > y).sum(1), (x < y).sum(1), n, m, percent / 100)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)],
                                                 names=["a", "b"]).filter(pa.array(ok))

    return (fits.select("a", "b", "n_a", "n_b", "bands_a", "bands_b")
            .mapInArrow(keep, "a binary, b binary"))


def _block_links(percent: int):
    """Links between different components within runs of equal (band, key, i, j)."""

    def columns(rows: list[dict]) -> tuple[np.ndarray, ...]:
        return (np.stack([np.asarray(r["bands"], "<i8") for r in rows]),
                np.array([r["n"] for r in rows], dtype=float),
                np.array([r["group"] for r in rows], dtype=object),
                np.array([r["sig"] for r in rows], dtype=object))

    def links_of(rows: list[dict]) -> Iterator[tuple[bytes, bytes]]:
        band, hub = rows[0]["band"], rows[0]["hub"]
        left = [r for r in rows if r["left"] and r["sig"] != hub]
        right = [r for r in rows if not r["left"] and r["sig"] != hub]
        if not left or not right:
            return
        (x_bands, x_n, x_group, x_sig), (y_bands, y_n, y_group, y_sig) = map(columns,
                                                                           (left, right))
        last = np.array([r["last"] for r in right])
        ok = x_group[:, None] != y_group
        # both sides outside the largest component: once, by order
        ok &= last | (x_sig[:, None] < y_sig)
        ok &= (100 * np.minimum(x_n[:, None], y_n) >= percent * np.maximum(x_n[:, None], y_n))
        for earlier in range(band):  # a pair that met in an earlier band is handled there
            ok &= x_bands[:, None, earlier] != y_bands[:, earlier]
        i, j = np.nonzero(ok)
        x_words, y_words = x_bands.view("<u2").astype(np.int32), y_bands.view("<u2").astype(np.int32)
        for at in range(0, len(i), 8192):
            p, q = i[at:at + 8192], j[at:at + 8192]
            diff = x_words[p] - y_words[q]
            keep = likely((diff > 0).sum(1), (diff < 0).sum(1), x_n[p], y_n[q], percent / 100)
            p, q = p[keep], q[keep]
            cut = np.flatnonzero(np.diff(p)) + 1
            for own, partners in zip(p[np.r_[0:min(1, len(p)), cut]], np.split(q, cut),
                                     strict=False):
                mine = np.frombuffer(left[own]["elements"], "<u8")
                sets = [np.frombuffer(right[k]["elements"], "<u8") for k in partners]
                theirs = np.concatenate(sets)
                spot = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
                starts = np.cumsum([0, *map(len, sets[:-1])])
                both = np.add.reduceat((mine[spot] == theirs).astype(np.int64), starts)
                union = x_n[own] + y_n[partners] - both
                for k in partners[100 * both >= percent * union]:
                    yield x_sig[own], y_sig[k]

    def body(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, run = None, []

        def found() -> Iterator[pa.RecordBatch]:
            out = list(links_of(run)) if run else []
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p[k] for p in out], pa.binary()) for k in (0, 1)],
                    names=["a", "b"])

        for batch in it:
            for at in range(0, batch.num_rows, 256):
                for r in batch.slice(at, 256).to_pylist():
                    now = (r["band"], r["key"], r["i"], r["j"])
                    if now != key:
                        yield from found()
                        key, run = now, []
                    run.append(r)
        yield from found()

    return body


def remaining_links(members: DataFrame, sets: DataFrame, percent: int,
                    block: int = BLOCK) -> DataFrame:
    """Links (a, b) between different components of one bucket.

    ``members``: band, key, hub, sig, n, bands, group (its component); ``sets``:
    sig, elements.
    """
    in_bucket = ["band", "key"]
    counts = members.groupBy(*in_bucket, "group").agg(F.count(F.lit(1)).alias("own"))
    largest = (counts.groupBy(*in_bucket)
               .agg(F.max(F.struct("own", "group")).alias("top"), F.sum("own").alias("all"))
               .select(*in_bucket, F.col("top.group").alias("top"),
                       F.ceil(F.col("all") / block).cast("int").alias("blocks"),
                       F.ceil((F.col("all") - F.col("top.own")) / block).cast("int")
                       .alias("left_blocks")))
    largest = materialize(largest, "near-largest")
    rows = (members.join(largest, in_bucket).join(sets, "sig")
            .withColumn("last", F.col("group") == F.col("top")))
    place = F.xxhash64("sig")
    run = [*in_bucket, "i", "j"]
    cols = [*run, "hub", "sig", "n", "bands", "elements", "group", "last", "left"]
    left = (rows.filter("not last").withColumn("i", F.pmod(place, F.col("left_blocks")).cast("int"))
            .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("left", F.lit(True)).select(cols))
    right = (rows.withColumn("j", F.pmod(place, F.col("blocks")).cast("int"))
             .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("left_blocks") - 1)))
             .withColumn("left", F.lit(False)).select(cols))
    return (left.unionByName(right).repartition(*run).sortWithinPartitions(*run)
            .mapInArrow(_block_links(percent), "a binary, b binary"))


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    rows = materialize(sketches(docs), "near-sketches")
    nodes = materialize(rows.filter("n > 0").groupBy("sig")
                        .agg(F.min("doc_id").alias("id"), F.min("text_key").alias("text_key"),
                             F.first("n").alias("n"), F.first("bands").alias("bands")),
                        "near-nodes")
    members = nodes.select("sig", F.posexplode("bands").alias("band", "key"))
    # small aggregates are written before they are joined: the join then shuffles
    # both sides itself, and adaptive execution splits a hot bucket
    sizes = materialize(members.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size"))
                        .filter("size > 1"), "near-sizes")
    members = materialize(members.join(sizes, ["band", "key"]), "near-members")
    # the node that meets most others is nearest to the middle of its group
    met = members.groupBy("sig").agg(F.sum("size").alias("met"))
    hubs = materialize(members.join(met, "sig").groupBy("band", "key")
                       .agg(F.max(F.struct("met", "sig"))["sig"].alias("hub")), "near-hubs")

    stars = (members.join(hubs, ["band", "key"]).filter("sig <> hub")
             .select(F.col("sig").alias("a"), F.col("hub").alias("b")).distinct())
    # the texts are read again once, for the nodes that meet another
    meeting = nodes.join(members.select("sig").distinct(), "sig", "left_semi")
    sets = materialize(full_sets(docs, meeting), "near-sets")
    links = materialize(confirmed(plausible(stars, nodes, percent), sets, percent), "near-links")
    groups = components(links)

    labelled = (members.filter("size > 2").join(hubs, ["band", "key"])
                .join(groups.withColumnRenamed("node", "sig"), "sig", "left")
                .withColumn("group", F.coalesce("component", "sig")).drop("component"))
    labelled = materialize(labelled, "near-buckets")
    mixed_ = materialize(labelled.groupBy("band", "key")
                         .agg(F.min("group").alias("lo"), F.max("group").alias("hi"))
                         .filter("lo <> hi").select("band", "key"), "near-open")
    left_over = materialize(labelled.join(mixed_, ["band", "key"], "left_semi")
                            .join(nodes.select("sig", "n", "bands"), "sig"), "near-mixed")
    more = materialize(remaining_links(left_over, sets, percent), "near-more")
    if not more.isEmpty():
        groups = components(links.unionByName(more))

    # smallest id of each component, by node; then by row
    named = nodes.join(groups, F.col("sig") == F.col("node"), "left").select(
        "sig", "id", F.coalesce("component", "sig").alias("component"))
    least = materialize(named.groupBy("component").agg(F.min("id").alias("component_id")),
                        "near-names")
    by_node = named.join(least, "component").select("sig", "component_id")
    return (rows.select("doc_id", "n", "sig").join(by_node, "sig", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
                    .alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def drop_near_copies(docs: DataFrame, percent: int = 85) -> DataFrame:
    """``docs`` with one row of each component, columns unchanged.

    The row with the smallest id stays (null ids last, then by a hash of the
    text); rows repeated with one id and one text are one row.
    """
    text = text_or_empty()
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                      F.xxhash64(text), F.crc32(text))
    named = docs.select(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id",
                                 key.alias("key")).alias("doc_id"), "text")
    kept = (near_duplicates(named, percent).filter("kept")
            .select(F.col("doc_id.key").alias("__kf_key")).distinct())
    return (docs.withColumn("__kf_key", key).join(kept, "__kf_key", "left_semi")
            .dropDuplicates(["__kf_key"]).select(*[f"`{c}`" for c in docs.columns]))
