"""Label query texts by workload."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideferry.functions.text import bare_statement
from tideferry.operators.statements import bare_words

CATEGORIES = ("ETL", "REPORTING", "AD_HOC", "MAINTENANCE")

_ETL = (
    r"(?is)^\s*(?:insert|copy|unload|merge|update|delete)\b"
    r"|^\s*create\s+(?:or\s+replace\s+)?(?:temp\s+|temporary\s+)?table\b[^;]*?\bas\s*\(?\s*(?:select|with)\b"
    r"|^\s*select\b[^;]*?\binto\s+\w"
    r"|^\s*with\b[^;]*?\b(?:insert\s+into|delete\s+from|merge\s+into|update\s+\w)"
)
_MAINTENANCE = (
    r"(?i)^\s*(?:vacuum|analyze|create|alter|drop|truncate|grant|revoke|comment|refresh)\b"
)
_QUERY = r"(?i)^\s*(?:select|with)\b"
_SUMMARY = r"(?i)\bgroup\s+by\b|\b(?:count|sum|avg|min|max)\s*\("
_JOIN = r"(?i)\bjoin\b"
_SORT = r"(?i)\border\s+by\b"
_INSPECT = r"(?i)^\s*(?:select|with|show|describe|explain)\b"


def rule_label(text: Column) -> Column:
    """Workload of a statement by its shape; the first rule that matches wins.

    Moving data is ETL; definitions, grants and housekeeping are MAINTENANCE;
    summaries and sorted joins are REPORTING; any other look at data is AD_HOC.
    Brackets before the statement don't count, and neither do words in its
    comments, strings and quoted names. The bare words are made once.
    """
    return F.transform(F.array(bare_statement(bare_words(text))), _label)[0]


def _label(text: Column) -> Column:
    return (
        F.when(F.rlike(text, F.lit(_ETL)), F.lit("ETL"))
        .when(F.rlike(text, F.lit(_MAINTENANCE)), F.lit("MAINTENANCE"))
        .when(
            F.rlike(text, F.lit(_QUERY))
            & (
                F.rlike(text, F.lit(_SUMMARY))
                | (F.rlike(text, F.lit(_JOIN)) & F.rlike(text, F.lit(_SORT)))
            ),
            F.lit("REPORTING"),
        )
        .when(F.rlike(text, F.lit(_INSPECT)), F.lit("AD_HOC"))
    )


def normalised_category(answer: Column) -> Column:
    """Map a free-text answer to a category: first name it mentions, else UNKNOWN."""
    said = F.upper(F.trim(answer))
    return (
        F.when(F.contains(said, F.lit("ETL")), F.lit("ETL"))
        .when(F.contains(said, F.lit("REPORTING")), F.lit("REPORTING"))
        .when(
            F.contains(said, F.lit("AD_HOC")) | F.contains(said, F.lit("ADHOC")), F.lit("AD_HOC")
        )
        .when(F.contains(said, F.lit("MAINTENANCE")), F.lit("MAINTENANCE"))
        .otherwise(F.lit("UNKNOWN"))
    )


def confidence(category: Column) -> Column:
    return F.when(category == "UNKNOWN", F.lit("LOW")).otherwise(F.lit("HIGH"))


def normalise_labels(answers: DataFrame, column: str) -> DataFrame:
    labelled = answers.withColumn("query_category", normalised_category(F.col(column)))
    return labelled.withColumn("confidence", confidence(F.col("query_category")))


def classify(
    queries: DataFrame,
    column: str = "query_text",
    scorer: Callable[[pd.Series], pd.Series] | None = None,
) -> DataFrame:
    """Add ``query_category`` and ``confidence`` to every query text.

    ``scorer`` may replace the built-in rules: it gets Arrow batches of texts
    and returns free-text answers, which are normalised like any other answer.
    """
    if scorer is None:
        answer = rule_label(F.col(column))
    else:

        def answers(texts: pd.Series) -> pd.Series:
            return scorer(texts)

        answer = F.pandas_udf(answers, "string")(F.col(column))
    return normalise_labels(queries.withColumn("_answer", answer), "_answer").drop("_answer")
