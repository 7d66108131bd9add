"""Delimited text files as typed rows, with the rejected lines kept.

The format has no quoting and no header, so a line is split at every
separator. Each field is trimmed, null tokens become null, and the text is
cast with ``try_cast``; a line that breaks any rule of its dataset goes to the
rejects with the first reason found. The text reader keeps blank lines and
lets large files split, so good plus bad lines are always the line count.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideferry.functions.frames import computed_once, quoted

# Field texts that stand for null, after trimming (fixed values).
NULL_TOKENS = ("NULL", "null", "")


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    required: bool = False
    max_length: int | None = None


@dataclass(frozen=True)
class Dataset:
    """One table's files: where they are, how they are separated, what they hold."""

    table: str
    location: str
    fields: tuple[Field, ...]
    sep: str = "|"

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"{quoted(f.name)} {f.type}" for f in self.fields))


class UnknownDataset(LookupError):
    """No file mapping exists for a table."""


def dataset_for(datasets: dict[str, Dataset], table: str, schema: str | None = None) -> Dataset:
    """Look a table up in a file map whose keys are lower-case names, with their schema or without."""
    names = ([f"{schema}.{table}"] if schema else []) + [table]
    for name in names:
        if name.lower() in datasets:
            return datasets[name.lower()]
    raise UnknownDataset(f"the file map has no entry for {' or '.join(names)}")


def read_lines(spark: SparkSession, location: str) -> DataFrame:
    """Lines with their file, where their split of it begins, and an id that ascends within the split."""
    return spark.read.text(location).select(
        F.col("value").alias("_line"),
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_block_start").alias("_split_start"),
        F.monotonically_increasing_id().alias("_line_id"),
    )


def _field_text(trimmed: Column, sep: str) -> Column:
    """A field without outer blanks; null when it is a null token.

    Trimming of tabs is slow, so only fields that have one at an end get it.
    """
    plain = F.when(~trimmed.isin(*NULL_TOKENS), trimmed)
    if sep == "\t":
        return plain
    bare = F.btrim(trimmed, F.lit(" \t"))
    tabbed = F.startswith(trimmed, F.lit("\t")) | F.endswith(trimmed, F.lit("\t"))
    return F.when(tabbed, F.when(~bare.isin(*NULL_TOKENS), bare)).otherwise(plain)


def _typed(text: Column, field: Field) -> Column:
    kind = T.StructType.fromDDL(f"v {field.type}")[0].dataType
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.BooleanType):
        lowered = F.lower(text)
        return (
            F.when(lowered == "on", F.lit(True))
            .when(lowered == "off", F.lit(False))
            .otherwise(text.try_cast(kind))
        )
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        # Files of one data set mix ISO and month/day/year; bring both to ISO.
        iso = F.regexp_replace(text, r"^(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$1-$2")
        return F.when(F.contains(text, F.lit("/")), iso).otherwise(text).try_cast(kind)
    return text.try_cast(kind)


def _problem(index: int, field: Field) -> Column:
    text, value = F.col(f"_text_{index}"), F.col(quoted(field.name))
    found = F.when(text.isNotNull() & value.isNull(), F.lit(f"TYPE:{field.name}"))
    if field.max_length is not None:
        found = found.when(F.char_length(text) > field.max_length, F.lit(f"LENGTH:{field.name}"))
    if field.required:
        found = found.when(text.isNull(), F.lit(f"REQUIRED:{field.name}"))
    return found


def _separator_pattern(sep: str) -> str:
    if len(sep) != 1:
        raise ValueError("the separator is a single character")
    return sep if sep.isalnum() or sep.isspace() else "\\" + sep


def parse_lines(lines: DataFrame, dataset: Dataset) -> DataFrame:
    """Every line with its typed fields and the ``_reason`` it is bad, if it is."""
    fields = dataset.fields
    pattern = _separator_pattern(dataset.sep)
    parts = lines.withColumn("_parts", F.split("_line", pattern, -1))
    trimmed = parts.select(
        "*",
        computed_once(
            [F.trim(F.get("_parts", F.lit(i))).alias(f"_trim_{i}") for i in range(len(fields))]
        ),
    )
    texts = trimmed.select(
        *parts.columns,
        computed_once(
            [
                _field_text(F.col(f"_trim_{i}"), dataset.sep).alias(f"_text_{i}")
                for i in range(len(fields))
            ]
        ),
    )
    typed = texts.select(
        "*", computed_once([_typed(F.col(f"_text_{i}"), f).alias(f.name) for i, f in enumerate(fields)])
    )
    arity = F.when(F.size("_parts") != len(fields), F.lit("ARITY"))
    reason = F.coalesce(arity, *[_problem(i, f) for i, f in enumerate(fields)])
    return typed.select(
        *lines.columns, *[F.col(quoted(f.name)) for f in fields], reason.alias("_reason")
    )

