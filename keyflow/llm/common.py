"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.session import scratch_dir

#: letters only, in any script
LETTERS = re.compile(r"[^\W\d_]+")
#: ASCII white space, as the contracts define it
ASCII_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_written: list[list[str]] = []


@contextmanager
def noting_written() -> Iterator[list[str]]:
    """The folders that ``materialize`` writes meanwhile, in order: whoever knows
    when they are read no more may delete them."""
    _written.append([])
    try:
        yield _written[-1]
    finally:
        _written.pop()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: the
    lineage ends there, later steps survive lost executors and nothing is
    computed twice."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    for paths in _written:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def in_fold(doc_id: str, folds: int, fold: int) -> Column:
    """crc32 of the id as text, modulo ``folds``, equals ``fold``."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.pmod(F.crc32(key), F.lit(folds)) == fold


def by_bytes(batch: pa.RecordBatch, text: int, rows: int, size: int = 2 << 20
             ) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows whose texts (column number ``text``) have
    ``size`` bytes together; a longer text is a slice of its own."""
    lengths = pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    at = 0
    while at < batch.num_rows:
        before = ends[at] - lengths[at]
        end = int(np.searchsorted(ends, before + size, "right"))
        end = min(max(end, at + 1), at + rows, batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def pieces(text: str, size: int, cut: re.Pattern) -> Iterator[str]:
    """The text in pieces of about ``size`` characters that begin where ``cut`` matches."""
    at = 0
    while len(text) - at > size:
        found = cut.search(text, at + size)
        if not found:
            break
        yield text[at:found.start()]
        at = found.start()
    if at < len(text):
        yield text[at:] if at else text


#: bytes of a labelled text that is learned from, and of all of them, at most
EXAMPLE_BYTES, SAMPLE_BYTES = 4 << 20, 64 << 20


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int,
                    bound: int) -> list[tuple]:
    """At most ``bound`` labelled (doc_id, text, y) rows outside the held-out fold,
    in the order of a hash of their id, as long as their texts fit ``SAMPLE_BYTES``.

    The ids are drawn first from the narrow label table and sent to the scan
    of the documents: ``bound`` ids, so the broadcast has a known size. Labels that
    are null, not 0/1, or contradictory for one id are no labels; labelled texts of
    over ``EXAMPLE_BYTES`` are not learned from.
    """
    ids = (labels.select(F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("__y"))
           .filter(F.col("__y").isin(0, 1) & F.col("__id").isNotNull())
           .filter(~in_fold("__id", folds, held))
           .groupBy("__id").agg(F.min("__y").alias("__y"), F.max("__y").alias("__z"))
           .filter("__y = __z")
           .orderBy(F.xxhash64("__id"), "__id").limit(bound).select("__id", "__y"))
    rows = (docs.select("doc_id", text_or_empty().alias("__text"))
            .filter(F.octet_length("__text") <= EXAMPLE_BYTES)
            .join(F.broadcast(ids), F.col("doc_id") == F.col("__id"))
            .select(F.xxhash64("__id").alias("__h"), "__id", "__text", "__y")
            .orderBy("__h", "__id", "__text").limit(bound))
    out, size = [], 0
    for r in rows.toLocalIterator():
        size += len(r["__text"].encode("utf-8", "surrogatepass"))
        if size > SAMPLE_BYTES:
            break
        out.append((r["__id"], r["__text"], r["__y"]))
    return out
