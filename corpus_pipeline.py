"""A training corpus from raw documents: five stages, each an operator over all its predecessor kept.

Every stage is written as Parquet in the session's shared folder and read back
as the next one's documents, so a lost executor costs its own tasks and the
plan of a stage never holds the one before.

Defined results are those of the operators; see their modules. A stage keeps
all columns of the documents; only the last returns its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tideferry.llm import decontamination, jaccard_join, line_dedup, packing, quality_rules
from tideferry.sources.shared import scratch_path
from tideferry.sources.tables import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the standard policy."""
    return quality_rules.filtered(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand earlier, and without those that lost all their lines."""
    return line_dedup.deduplicated(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id."""
    return jaccard_join.deduplicated(docs)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    return decontamination.decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents left, in length buckets and batches."""
    return packing.packed(docs)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("ngram_jaccard_join", near_copies),
    ("benchmark_decontamination", benchmarks),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


def _kept_in_sql() -> str:
    """The documents that reach the last stage, as DuckDB SQL."""
    judged = quality_rules.sql("SELECT doc_id, text FROM documents")
    passed = f"SELECT doc_id, text FROM ({judged}) AS quality WHERE failed = 0"
    cleaned = line_dedup.sql("SELECT * FROM passed")
    shortened = f"SELECT doc_id, text FROM ({cleaned}) AS lines WHERE n_lines = 0 OR n_lines > n_equal + n_near"
    grouped = jaccard_join.sql("SELECT * FROM shortened")
    alone = f"SELECT doc_id, text FROM shortened JOIN ({grouped}) AS groups USING (doc_id) WHERE doc_id = component_id"
    found = decontamination.sql("SELECT * FROM alone", "SELECT * FROM benchmark")
    clean = f"SELECT doc_id, text FROM ({found}) AS hits WHERE NOT contaminated"
    steps = {"passed": passed, "shortened": shortened, "alone": alone, "clean": clean}
    return "WITH " + ", ".join(f"{name} AS MATERIALIZED ({step})" for name, step in steps.items())


ORACLE_SQL = f"{_kept_in_sql()} SELECT * FROM ({packing.sql('SELECT * FROM clean')}) AS packed"
