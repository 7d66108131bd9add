"""Rows a target does not hold yet."""

from __future__ import annotations

import functools
from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideferry.functions.frames import quoted


def new_rows(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    changed_at: str | None = None,
    overlap: timedelta = timedelta(0),
) -> DataFrame:
    """Source rows whose key is absent from the target; a null key is a key like any other.

    With ``changed_at`` the target's newest value, less ``overlap``, bounds
    both sides before they meet: the bound is one value, read first, so it
    reaches both scans as a pushed filter and the join is as large as the
    increment. Rows without a change time always take part. Rows that arrive
    later than the overlap need the form without; rows that changed under a
    key the target holds are not new, they are for ``operators.merge``.
    """
    if changed_at is not None:
        time = F.col(quoted(changed_at))
        mark = target.agg(F.max(time)).first()[0]
        if mark is not None:
            recent = time >= F.lit(mark - overlap).cast(target.schema[changed_at].dataType)
            recent = recent | time.isNull()
            source, target = source.filter(recent), target.filter(recent)
    known = target.select(*[F.col(quoted(k)).alias(f"_known{i}") for i, k in enumerate(keys)])
    same = [F.col(quoted(k)).eqNullSafe(F.col(f"_known{i}")) for i, k in enumerate(keys)]
    return source.join(known, functools.reduce(lambda a, b: a & b, same), "left_anti")
