"""Parquet tables of one folder, by name."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_tables(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Open several tables at once; opening one waits for a job that reads its footer."""
    names = list(names)
    with ThreadPoolExecutor(max_workers=8) as pool:
        return dict(zip(names, pool.map(lambda name: read_table(spark, folder, name), names)))
