"""Current state out of append-only rows: the newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideferry.functions.frames import quoted


def latest_rows(rows: DataFrame, keys: Sequence[str | Column], order: Sequence[str]) -> DataFrame:
    """The whole newest row of every key.

    A grouped ``max_by`` combines before the shuffle, so at most one row per
    key leaves a task: a key that holds a third of all rows costs no more
    than any other. (A ranking window would move every row.)
    """
    newest = F.max_by(F.struct(*[F.col(quoted(c)) for c in rows.columns]), F.struct(*order))
    named = [
        (F.col(k) if isinstance(k, str) else k).alias(f"_key{i}") for i, k in enumerate(keys)
    ]
    return rows.groupBy(*named).agg(newest.alias("_row")).select("_row.*")


def latest_value(rows: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """Newest ``value`` per key with the number of changes seen."""
    return rows.groupBy(*keys).agg(
        F.max_by(value, F.struct(*order)).alias(value),
        F.count(F.lit(1)).alias("changes"),
    )


def matching(current: DataFrame, matched: DataFrame, on: Sequence[str]) -> DataFrame:
    """Current rows whose key occurs in ``matched``, whatever the letter case.

    ``matched`` only decides which rows change, so it is a semi join: a
    duplicate on that side cannot multiply state rows.
    """
    keys = matched.select(*[F.upper(c).alias(f"_{c}") for c in on])
    condition = [F.upper(current[c]) == keys[f"_{c}"] for c in on]
    return current.join(keys, condition, "left_semi")


def advance(rows: DataFrame, **values) -> DataFrame:
    """New versions of rows with some values changed."""
    changed = {
        name: value if isinstance(value, Column) else F.lit(value) for name, value in values.items()
    }
    return rows.withColumns(changed | {"change_no": F.col("change_no") + 1})
