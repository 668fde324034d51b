"""Training-corpus pipeline: quality, copies, near copies, benchmark text, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from keyflow.llm import decontaminate, exact_dedup, near_dedup, packing, quality
from keyflow.llm.common import materialize, noting_written, table
from keyflow.llm.queries import importable, tokenizer_path
from keyflow.session import delete_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field does not reject.

    The field is fitted on labelled rows of the stage's own input."""
    importable(spark)
    return quality.drop_rejected(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    importable(spark)
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies; documents without words stay.

    Copies share 85 of 100 shingles, as in the operator's own query: at that bar
    the bands lose a pair in some millions, and clean texts stay apart."""
    importable(spark)
    return near_dedup.drop_near_copies(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    importable(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all remaining documents, placed in sequences."""
    importable(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("decontaminate", benchmark_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is written and reread.

    What a stage wrote on its way, and its input, go once its result stands."""
    docs = table(spark, sf_dir, "documents")
    before: list[str] = []
    for name, stage in STAGES[:-1]:
        with noting_written() as written:
            docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        *own, result = written
        for path in before + own:
            delete_path(spark, path)
        before = [result]
    return STAGES[-1][1](spark, docs, sf_dir)


#: a tokenizer's ids and trained weights are not SQL: see tests/llm/test_pipeline.py
ORACLE_SQL = None
