"""Words, batches and SQL fragments the text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space, as a Java and an RE2 character class: blank and the controls 9 to 13.
BLANKS = r"[\x20\x09-\x0D]"
PLAIN_WORD = r"[^\x20\x09-\x0D]+"
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Every ASCII byte that is no digit and no lower-case letter becomes a blank.
_ITEM_TABLE = bytes(b if b >= 128 or chr(b).isdigit() or chr(b).islower() else 32 for b in range(256))


def plain_words(text: bytes) -> list[bytes]:
    """Words between ASCII white space. ``bytes.split`` knows exactly those six characters."""
    return text.split()


def item_words(text: bytes) -> list[bytes]:
    """Runs of letters and digits, ASCII letters in lower case; other characters beyond ASCII count as letters."""
    return text.lower().translate(_ITEM_TABLE).split()


def words_of(text: Column) -> Column:
    """``plain_words`` as a column expression; null has none."""
    return F.coalesce(F.array_remove(F.split(text, BLANKS + "+"), ""), F.array().cast("array<string>"))


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """A batch's texts as UTF-8; null is empty."""
    return [value or b"" for value in batch.column(column).cast(pa.binary()).to_pylist()]


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns the operators read; whatever else the table holds stays out of their way."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def parts(batches: Iterator[pa.RecordBatch], text: Callable[[pa.RecordBatch], pa.Array] | None = None, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches in parts of about ``most`` bytes of text, so that a worker holds little; a larger row stands alone."""
    for batch in batches:
        column = text(batch) if text else batch.column("text")
        sizes = pc.fill_null(pc.binary_length(column.cast(pa.binary())), 0).to_pylist()
        begin = total = 0
        for row, size in enumerate(sizes):
            if row > begin and total + size > most:
                yield batch.slice(begin, row - begin)
                begin, total = row, 0
            total += size
        if begin < batch.num_rows:
            yield batch.slice(begin)


def spans(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers of all ranges ``first .. first + count - 1``, one after another."""
    total = int(count.sum())
    starts = np.cumsum(count) - count
    return np.arange(total, dtype=np.int64) + np.repeat(first - starts, count)


def sql_words(text: str, word: str, lower: bool = False) -> str:
    """DuckDB's list of the words of a text column. Only A to Z change case."""
    if lower:
        text = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all(coalesce({text}, ''), '{word}')"
