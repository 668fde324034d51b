"""Registered queries: thin applications of the operators to whole tables."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, exact_dedup, line_templates, maxent_lm, near_dedup, packing,
               periodic_runs, quality, sharding, toxicity, url_filter, warc, whitening)
from .common import table, text_or_empty

ROOT = str(Path(__file__).resolve().parents[2])


_SHIPPED: set[str] = set()


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package where it is not installed: it goes to
    every executor as a zip, once an application."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        _SHIPPED.add(sc.applicationId)
        place = tempfile.mkdtemp(prefix="keyflow-package-")  # the driver's; Spark sends the file
        sc.addPyFile(shutil.make_archive(f"{place}/keyflow", "zip", ROOT, "keyflow"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item and the place."""
    return decontaminate.find_items(table(spark, sf_dir, "documents"),
                                    table(spark, sf_dir, "benchmark"))


def op2_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))


def op3_vector_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.vector_shards(table(spark, sf_dir, "documents"), shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         "slot", F.lit(None).cast("int").alias("grown_shard"), "tokens")


def op4_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).drop("n_orig")


def op6_toxicity_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"),
                                   table(spark, sf_dir, "labels"))


def op7_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.drop_template_lines(table(spark, sf_dir, "documents"))


def op8_url_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (url_filter.filter_urls(table(spark, sf_dir, "pages"))
            .withColumn("n_strict", F.size("strict_hits")).withColumn("n_soft", F.size("soft_hits"))
            .drop("strict_hits", "soft_hits"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (warc.round_trip(table(spark, sf_dir, "pages"))
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op11_qdwh_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.score_documents(table(spark, sf_dir, "documents"))


def with_repeats(doc_id: Column, text: Column) -> Column:
    """The text that the run query looks at: where h = crc32(id) is divisible by
    10, the words from a = g % n on (g = h div 10) repeat the p = 1 + (n - a) div
    (3 + g % 8) words that start there. Texts of rows without an id stay."""
    h = F.crc32(doc_id.cast("string"))
    g = (h / 10).cast("long")

    def repeat(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        unit = F.slice(words, a + 1, p)
        tail = F.flatten(F.array_repeat(unit, F.ceil((n - a) / p).cast("int")))
        return F.when(n > 0, F.concat_ws(
            " ", F.slice(words, F.lit(1), a), F.slice(tail, F.lit(1), n - a))).otherwise("")

    words = F.regexp_extract_all(text, F.lit("([^\\x20\\x09-\\x0D]+)"), F.lit(1))
    # bound once by the lambda, or every use of the words would extract them again
    changed = F.transform(F.array(words), repeat)[0]
    return F.when(h % 10 == 0, changed).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = periodic_runs.periodic_runs(
        docs, text=with_repeats(F.col("doc_id"), text_or_empty()))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return (found.withColumn("__longest", longest)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"),
                    (-F.col("__longest.start")).alias("start"),
                    F.col("__longest.length").alias("length"),
                    (-F.col("__longest.period")).alias("period"),
                    F.expr("(1000 * __longest.length) div -__longest.period")
                    .alias("exponent_milli"),
                    F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""),
                           256).alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words"))


def _ready(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return f(spark, sf_dir)

    run.__name__, run.__doc__ = f.__name__, f.__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _ready(f) for f in (
        op1_decontaminate, op2_quality_crf, op3_vector_shards, op4_harmonic_packing,
        op5_exact_dedup, op6_toxicity_knn, op7_line_templates, op8_url_vocabulary, op9_warc,
        op10_near_dedup, op11_qdwh_whitening, op12_maxent_lm, op13_periodic_runs)}
