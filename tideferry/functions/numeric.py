"""Rates, variances and their rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round4(value: Column) -> Column:
    """Round to four decimals, halves towards positive infinity."""
    return F.floor(value * F.lit(10000.0) + F.lit(0.5)) / F.lit(10000.0)


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100``; null when ``whole`` is zero."""
    return part / F.nullif(whole, F.lit(0)) * F.lit(100.0)


def variance_percent(source: Column, target: Column) -> Column:
    """Distance of target from source in percent of source; 0 when source is 0."""
    distance = F.abs(source - target) / F.nullif(source, F.lit(0)) * F.lit(100.0)
    return F.when(source > 0, distance).otherwise(F.lit(0.0))


def pass_percent(passed: Column, total: Column) -> Column:
    """Guarded pass rate with one decimal, 0 for an empty group."""
    return F.when(
        total > 0, F.round(passed / F.nullif(total, F.lit(0)) * F.lit(100.0), 1)
    ).otherwise(F.lit(0.0))


# Cents are added up in two pieces, so that sums of longs cannot overflow
# below 2**43 rows.
_PIECE_BITS = 20


def cents(value: Column) -> Column:
    """An amount as whole cents."""
    return F.floor(value * F.lit(100.0) + F.lit(0.5)).cast("bigint")


def exact_total(amount_in_cents: Column) -> Column:
    """Sum of cents as a decimal amount, the same in whatever order rows are added.

    Longs add several times faster than decimals made from doubles.
    """
    mask = F.lit((1 << _PIECE_BITS) - 1).cast("bigint")
    high = F.sum(F.shiftright(amount_in_cents, _PIECE_BITS)).cast("decimal(20,0)")
    low = F.sum(amount_in_cents.bitwiseAND(mask)).cast("decimal(20,0)")
    total = high * F.lit(1 << _PIECE_BITS).cast("decimal(8,0)") + low
    return (total * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(30,2)")


def as_whole_number(value: Column) -> Column:
    """Integer display of a number: halves round up (a bare cast truncates)."""
    return F.floor(value + F.lit(0.5)).cast("int")
