"""Keyed sample checksum: do the same keys carry the same rows on both sides?

The sample is chosen by a hash of the key, so both sides pick the same keys.
Rows are hashed on their own side; only (key, hashes) is shuffled, combined
first, and never joined: copies of a key add up instead of pairing.
"""

from __future__ import annotations

import copy
import functools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideferry.functions.frames import quoted
from tideferry.functions.numeric import percent, round4
from tideferry.operators.reconcile import CHECKSUM, verdict

# Number of hexadecimal digits of the key hash that decide on sampling.
_DIGITS = 16

# Two 64-bit hashes of a row, added up in pieces of 20 bits: sums of longs
# that cannot overflow below 2**43 rows of one key.
_SEEDS = (1, 2)
_PIECE_BITS = 20
_PIECES = [f"_sum{seed}_{shift}" for seed in _SEEDS for shift in range(0, 64, _PIECE_BITS)]

# Hashed as JSON text: a hash of the value itself passes over nulls inside it.
_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


def in_sample(keys: Sequence[Column], fraction: float) -> Column:
    """True for about ``fraction`` of all keys, given as texts, the same keys everywhere."""
    if fraction >= 1.0:
        return F.lit(True)
    bound = format(min(round(fraction * 16**_DIGITS), 16**_DIGITS - 1), f"0{_DIGITS}x")
    return F.substr(F.md5(F.concat_ws("\u0001", *keys)), F.lit(1), F.lit(_DIGITS)) < F.lit(bound)


def _named(rows: DataFrame, schema: T.StructType) -> dict[str, str]:
    """The columns of ``rows`` by the target's names, whatever the letter case; exact names first."""
    folded = {name.upper(): name for name in rows.columns}
    found = {f.name: f.name if f.name in rows.columns else folded.get(f.name.upper()) for f in schema.fields}
    absent = [name for name, own in found.items() if own is None]
    if absent:
        raise ValueError(f"the source has no column {', '.join(absent)}")
    return found


def _hashed_values(rows: DataFrame, schema: T.StructType) -> list[Column]:
    """Values to hash, in the target's types, each with whether it is null.

    The flag is that of the original value: a value lost in conversion must
    not look like a null that was always there.
    """
    values = []
    for field in schema.fields:
        value = F.col(quoted(field.name))
        aligned = value
        if rows.schema[field.name].dataType != field.dataType:
            aligned = value.try_cast(field.dataType)
        if isinstance(field.dataType, _NESTED):
            aligned = F.to_json(aligned, {"ignoreNullFields": "false"})
        values += [aligned, value.isNull()]
    return values


def _aligned(rows: DataFrame, keys: Sequence[str], keyed: T.StructType) -> tuple[list[Column], list[Column]]:
    """The keys in the target's types, and the texts of those that have no value there, else null.

    Equal keys must look equal on both sides; a key that does not convert is
    still a key, and not the null key.
    """
    own = _named(rows, keyed)
    typed, texts = [], []
    for key in keys:
        value, kind = F.col(quoted(own[key])), keyed[key].dataType
        if rows.schema[own[key]].dataType == kind:
            typed.append(value.alias(key))
            texts.append(F.lit(None).cast("string"))
        else:
            typed.append(value.try_cast(kind).alias(key))
            texts.append(F.when(value.try_cast(kind).isNull(), value.cast("string")))
    return typed, texts


UNCONVERTED = "unconverted"


def _hashed(
    rows: DataFrame, keys: Sequence[str], keyed: T.StructType, schema: T.StructType, fraction: float, side: int
) -> DataFrame:
    typed, texts = _aligned(rows, keys, keyed)
    lost = [f"_text{i}" for i in range(len(keys))]
    rows = rows.select(
        *typed,
        *[text.alias(name) for text, name in zip(texts, lost)],
        *[F.col(quoted(n)).alias(f.name) for n, f in zip(_named(rows, schema).values(), schema.fields) if f.name not in keys],
    )
    values, sign = _hashed_values(rows, schema), F.lit(1 - 2 * side).cast("bigint")
    hashes = [F.xxhash64(F.lit(seed), *values).alias(f"_hash{seed}") for seed in _SEEDS]
    pieces = [
        F.shiftrightunsigned(F.col(f"_hash{seed}"), shift).bitwiseAND(
            F.lit((1 << _PIECE_BITS) - 1).cast("bigint")
        )
        for seed in _SEEDS
        for shift in range(0, 64, _PIECE_BITS)
    ]
    any_lost = functools.reduce(lambda a, b: a | b, [F.col(name).isNotNull() for name in lost])
    unconverted = F.when(any_lost, F.to_json(F.struct(*[F.col(name).alias(key) for name, key in zip(lost, keys)])))
    sampled = [F.coalesce(F.col(quoted(key)).cast("string"), name) for key, name in zip(keys, lost)]
    return (
        rows.filter(in_sample(sampled, fraction))
        .select(*map(quoted, keys), unconverted.alias(UNCONVERTED), *hashes)
        .select(
            *map(quoted, keys),
            UNCONVERTED,
            F.lit(1 - side).alias("_source"),
            F.lit(side).alias("_target"),
            *[(piece * sign).alias(name) for piece, name in zip(pieces, _PIECES)],
        )
    )


class _Sides:
    """Both sides of a comparison, with the keys and columns by the target's names."""

    def __init__(self, source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str] | None) -> None:
        folded = {name.upper(): name for name in target.columns}
        self.frames = (source, target)
        self.keys = [k if k in target.columns else folded[k.upper()] for k in keys]
        names = [c if c in target.columns else folded[c.upper()] for c in columns or target.columns]
        self.schema = T.StructType([target.schema[name] for name in names])
        self.keyed = T.StructType([target.schema[k] for k in self.keys])

    def hashed(self, fraction: float) -> DataFrame:
        """Signed row hashes of both sides: those of equal rows add up to zero."""
        source, target = (_hashed(rows, self.keys, self.keyed, self.schema, fraction, side) for side, rows in enumerate(self.frames))
        return source.unionByName(target)

    def summed(self, rows: DataFrame, *by: Column | str) -> DataFrame:
        sums = [F.sum("_source").alias("source_rows"), F.sum("_target").alias("target_rows"), *[F.sum(name).alias(name) for name in _PIECES]]
        return rows.groupBy(*by).agg(*sums)


def _equal() -> Column:
    same = F.col("source_rows") == F.col("target_rows")
    for name in _PIECES:
        same = same & (F.col(name) == 0)
    return same


def compare_sample(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    fraction: float = 0.10,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Status per sampled key: MATCH, CHANGED, MISSING_IN_TARGET or EXTRA_IN_TARGET.

    Source hashes are added and target hashes subtracted; a key matches when
    the row counts agree and every sum is zero. Source keys that have no value
    in the target's types are keys of their own; ``unconverted`` shows them.
    """
    return _compared(_Sides(source, target, keys, columns), fraction)


def _compared(sides: _Sides, fraction: float) -> DataFrame:
    status = (
        F.when(F.col("target_rows") == 0, F.lit("MISSING_IN_TARGET"))
        .when(F.col("source_rows") == 0, F.lit("EXTRA_IN_TARGET"))
        .when(_equal(), F.lit("MATCH"))
        .otherwise(F.lit("CHANGED"))
    )
    by = [*map(quoted, sides.keys), UNCONVERTED]
    return sides.summed(sides.hashed(fraction), *by).select(*by, "source_rows", "target_rows", status.alias("status"))


def differences(compared: DataFrame) -> DataFrame:
    return compared.filter(F.col("status") != "MATCH")


def sample_checksum(
    table: str, compared: DataFrame, threshold: float | Column = 0.0
) -> DataFrame:
    """The comparison as one check row: sampled keys against matching keys.

    Nothing sampled proves nothing, so that is the status NO_SAMPLE.
    """
    counted = compared.agg(
        F.count(F.lit(1)).alias("sampled"),
        F.count_if(F.col("status") == "MATCH").alias("matching"),
    )
    distance = F.coalesce(
        percent(F.col("sampled") - F.col("matching"), F.col("sampled")), F.lit(0.0)
    )
    return counted.select(
        F.lit(CHECKSUM).alias("check_type"),
        F.lit(table.upper()).alias("table_name"),
        F.lit(None).cast("string").alias("column_name"),
        F.lit(f"{CHECKSUM}:{table.upper()}").alias("check_name"),
        F.col("sampled").cast("double").alias("source_value"),
        F.col("matching").cast("double").alias("target_value"),
        round4(distance).alias("variance_pct"),
        F.when(F.col("sampled") == 0, F.lit("NO_SAMPLE")).otherwise(verdict(distance, threshold)).alias("status"),
        F.lit(None).cast("string").alias("note"),
    )


# -- where tables differ --------------------------------------------------

# Key ranges of a level; the sample that cuts them has 16 keys for each.
RANGES = 256

# Ranges with no more rows than this are compared key by key.
FEW_ROWS = 1 << 20
_LEVELS = 8


@dataclass(frozen=True)
class KeyRanges:
    """Ranges ``[low, high)`` of the first key, open where None, and whether null keys belong to them."""

    spans: tuple[tuple[object, object], ...] = ((None, None),)
    nulls: bool = True

    def holds(self, key: Column, kind: T.DataType) -> Column:
        """A condition that reaches the scan."""
        found = key.isNull() if self.nulls else F.lit(False)
        for low, high in self.spans:
            inside = key.isNotNull() if low is None and high is None else F.lit(True)
            if low is not None:
                inside = inside & (key >= _literal(low, kind))
            if high is not None:
                inside = inside & (key < _literal(high, kind))
            found = found | inside
        return found

    def whole(self) -> bool:
        return self.nulls and self.spans == ((None, None),)


def _literal(value: object, kind: T.DataType) -> Column:
    return F.lit(bytes(value) if isinstance(value, bytearray) else value).cast(kind)


def _range_of(key: Column, cuts: Sequence[object], kind: T.DataType, first: int = 0) -> Column:
    """The number of cuts up to a key, by halving them."""
    if not cuts:
        return F.lit(first)
    half = len(cuts) // 2
    below = _range_of(key, cuts[:half], kind, first)
    return F.when(key < _literal(cuts[half], kind), below).otherwise(_range_of(key, cuts[half + 1 :], kind, first + half + 1))


def _within(sides: _Sides, ranges: KeyRanges) -> _Sides:
    """The sides with only the rows in some ranges."""
    if ranges.whole():
        return sides
    inside, key = copy.copy(sides), sides.keys[0]
    kept = []
    for rows in sides.frames:
        typed, _ = _aligned(rows, [key], T.StructType([sides.keyed[0]]))
        kept.append(rows.filter(ranges.holds(typed[0], sides.keyed[0].dataType)))
    inside.frames = tuple(kept)
    return inside


def _cuts(sides: _Sides, ranges: int) -> list:
    """Keys that cut the rows into ranges of about equal size: quantiles of those with the least hashes."""
    key = sides.keys[0]
    keys = [rows.select(_aligned(rows, [key], T.StructType([sides.keyed[0]]))[0][0].alias("k")) for rows in sides.frames]
    least = keys[0].unionByName(keys[1]).filter("k IS NOT NULL").orderBy(F.xxhash64("k"), "k").limit(16 * ranges)
    sample = [row.k for row in least.orderBy("k").collect()]
    return list(dict.fromkeys(sample[len(sample) * i // ranges] for i in range(1, ranges))) if sample else []


def differing_ranges(
    source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, ranges: int = RANGES, few: int = FEW_ROWS
) -> KeyRanges:
    """Ranges of the first key that hold all differences, by a tree of digests from the root down.

    A level cuts the ranges found so far into ``ranges`` smaller ones, adds up
    the signed hashes of both sides' rows in each, and keeps those that are not
    zero. Only these are read for the next level, until they hold ``few`` rows,
    or no longer shrink. What a level brings back is one row per range.
    """
    return _differing(_Sides(source, target, keys, columns), ranges, few)


def _differing(sides: _Sides, ranges: int, few: int) -> KeyRanges:
    found, before, kind = KeyRanges(), None, sides.keyed[0].dataType
    for _ in range(_LEVELS):
        inside = _within(sides, found)
        cuts = _cuts(inside, ranges)
        key = F.col(quoted(sides.keys[0]))
        number = F.when(key.isNotNull(), _range_of(key, cuts, kind)).otherwise(-1)
        digests = sides.summed(inside.hashed(1.0), number.alias("number"))
        rows = digests.filter(~_equal()).select("number", (F.col("source_rows") + F.col("target_rows")).alias("n")).collect()
        spans: list[tuple] = []
        edges = [None, *cuts, None]
        last = None
        for at in sorted(row.number for row in rows if row.number >= 0):
            low, high = edges[at], edges[at + 1]
            if last == at - 1:
                low = spans.pop()[0]
            spans.append((low, high))
            last = at
        if not found.whole():
            spans = _overlap(spans, found.spans)
        found = KeyRanges(tuple(spans), any(row.number < 0 for row in rows))
        left = sum(row.n for row in rows)
        if left <= few or (before is not None and left > before // 2):
            break
        before = left
    return found


def _overlap(spans: Sequence[tuple], others: Sequence[tuple]) -> list[tuple]:
    """The parts that two sorted lists of ranges share; a level's outermost ranges reach beyond what it read."""
    shared = []
    for low, high in spans:
        for other_low, other_high in others:
            begin = low if other_low is None or (low is not None and low > other_low) else other_low
            end = high if other_high is None or (high is not None and high < other_high) else other_high
            if begin is None or end is None or begin < end:
                shared.append((begin, end))
    return shared


def locate(source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, ranges: int = RANGES, few: int = FEW_ROWS) -> DataFrame:
    """Every key that differs, as a full comparison lists it, read only from the ranges that differ."""
    sides = _Sides(source, target, keys, columns)
    return differences(_compared(_within(sides, _differing(sides, ranges, few)), 1.0))
