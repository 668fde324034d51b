"""Exact duplicate removal by progressive refinement (DataFrame functions only).

Rows are grouped by the length of their normalised text, the survivors by a
hash of its first characters, and only what still shares both is grouped by
the full hash. Each text is read once: the scan reduces it to a narrow row of
digests, which is written to the shared folder; no shuffle ever carries a text.
The full digest is part of every result row (``text_sha256``), so the scan
takes it while it holds the text; the refinement decides which of them are
shuffled and compared.

Skew: counts are partially aggregated before their shuffle, so a group of
copies arrives as one row per task. The two joins of the narrow rows are plain
sort-merge joins with one row per key on the other side, which adaptive
execution splits when one key is hot.

Defined results: a null text counts as empty; all empty texts are one group.
Of equal texts the row with most code points stays, then the smallest doc_id
(null ids last), then, among rows repeated with one id, any one of them. An
empty table gives an empty result. Other columns are not read, so their names
cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, materialize, text_or_empty

#: code points of the normalised text that the second refinement looks at
PREFIX_CHARS = 64


def normalised(text: Column) -> Column:
    """The text without any character of ``[\\x20\\x09-\\x0D]``."""
    return F.translate(text, ASCII_SPACE, "")


def fingerprints(docs: DataFrame, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    norm = normalised(text_or_empty())
    return docs.select(
        "doc_id",
        F.length(text_or_empty()).cast("long").alias("n_orig"),
        F.length(norm).cast("long").alias("n_norm"),
        F.xxhash64(F.substring(norm, 1, prefix_chars)).alias("prefix"),
        F.sha2(norm, 256).alias("sha"),
        F.monotonically_increasing_id().alias("row"))


def exact_dedup(docs: DataFrame, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, n_orig."""
    rows = materialize(fingerprints(docs, prefix_chars), "exact-digests")

    # 1 and 2: lengths, then prefixes that occur more than once
    prefixes = rows.groupBy("n_norm", "prefix").agg(F.count(F.lit(1)).alias("n"))
    lengths = (prefixes.groupBy("n_norm").agg(F.sum("n").alias("m"))
               .filter("m > 1").select("n_norm"))
    suspects = prefixes.filter("n > 1").join(lengths, "n_norm", "left_semi")

    # 3: full hashes of the survivors only
    best = F.min(F.struct((-F.col("n_orig")).alias("shorter"),
                          F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    groups = (rows.join(suspects, ["n_norm", "prefix"], "left_semi")
              .groupBy("sha").agg(F.count(F.lit(1)).alias("n"), best.alias("best"))
              .filter("n > 1"))
    # written, so that the last join shuffles both sides itself and a hot group is split
    groups = materialize(groups, "exact-groups")

    alone = F.col("n").isNull()
    return rows.join(groups, "sha", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("best.row"))).alias("kept"),
        F.col("sha").alias("text_sha256"), "n_orig")


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, columns unchanged.

    The decisions are narrow; the texts are shuffled once, to meet them.
    """
    def key(doc_id: str, n: Column, sha: Column) -> Column:
        return F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), n, sha)

    kept = (exact_dedup(docs).filter("kept")
            .select(key("doc_id", F.col("n_orig"), F.col("text_sha256")).alias("__kf_key")))
    mine = key("doc_id", F.length(text_or_empty()), F.sha2(normalised(text_or_empty()), 256))
    # a row repeated with one id has one key: the last step leaves one of them
    return (docs.withColumn("__kf_key", mine).join(kept, "__kf_key", "left_semi")
            .dropDuplicates(["__kf_key"]).select(*[f"`{c}`" for c in docs.columns]))
