"""Small DataFrame helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A column name as it is written in an expression."""
    return "`" + name.replace("`", "``") + "`"


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name, pairwise, so that many frames make a shallow plan."""
    frames = list(frames)
    while len(frames) > 1:
        pairs = [frames[i : i + 2] for i in range(0, len(frames), 2)]
        frames = [p[0].unionByName(p[1]) if len(p) == 2 else p[0] for p in pairs]
    return frames[0]


def computed_once(columns: Sequence[Column]) -> Column:
    """Columns as a one-row generator.

    Filters are not pushed through a generator, and its output is read as
    plain attributes: an expensive expression used both in a filter and in
    the output is evaluated once per row.
    """
    return F.inline(F.array(F.struct(*columns)))


def dealt(rows: DataFrame) -> DataFrame:
    """Rows dealt to all cores, for work that costs far more than moving them.

    A Parquet row group is read by one task, whatever is made of its rows. Only
    equal rows go together, so no key can fill a task.
    """
    spark = rows.sparkSession
    parts = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(parts, *[F.col(quoted(name)) for name in rows.columns])
