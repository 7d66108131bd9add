"""Text expressions: regular-expression and literal replacement, previews.

Everything here stays inside Catalyst (``regexp_replace``, ``replace``,
``left``), so a rewrite of any number of rules is one projection without
Python workers.
"""

from __future__ import annotations

import re

from py4j.protocol import Py4JJavaError
from pyspark import SparkContext
from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as part of a word, and as white space, in the rule
# language (fixed values). Java's own \b is Unicode-aware and its \s covers
# ASCII only; rules are written with the opposite of both.
WORD = "[A-Za-z0-9_]"
SPACE = (
    r"[\s\x0B\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}"
    r"\x{202F}\x{205F}\x{3000}\x{FEFF}]"
)

_PLAIN_WORDS = re.compile(r"[A-Za-z0-9_]+(?:\|[A-Za-z0-9_]+)*")


def whole_word(pattern: str) -> str:
    """Anchor ``pattern`` at ASCII word boundaries on both sides.

    For plain words (``a`` or ``a|b``) the look-behind follows the word and
    spans it, so it is tried where a word was found and not at every position
    of the text.
    """
    if _PLAIN_WORDS.fullmatch(pattern):
        words = "|".join(f"{word}(?<!{WORD}{word})" for word in pattern.split("|"))
        return f"(?:{words})(?!{WORD})"
    edge = f"(?:(?<!{WORD})(?={WORD})|(?<={WORD})(?!{WORD}))"
    return f"{edge}(?:{pattern}){edge}"


def group_count(pattern: str) -> int:
    """Groups of a Java pattern, by the JVM's own pattern class; a pattern that does not compile raises."""
    context = SparkContext._active_spark_context
    if context is None:
        raise RuntimeError("patterns are compiled by the JVM; start a session first")
    try:
        return context._jvm.java.util.regex.Pattern.compile(pattern).matcher("").groupCount()
    except (Py4JJavaError, IllegalArgumentException) as error:
        raise ValueError(f"not a Java pattern: {pattern}") from error


def replacement(target: str, groups: int = 0) -> str:
    """Turn a rule's target into a Java replacement string.

    ``$1``..``$9`` refer to existing groups, ``$&`` to the whole match and
    ``$$`` is a dollar sign; any other ``$`` and every ``\\`` is literal.
    """

    def dollar(match: re.Match) -> str:
        mark = match.group(1)
        if mark == "&":
            return "$0"
        if mark.isdigit() and 1 <= int(mark) <= groups:
            return f"${mark}"
        return r"\$" if mark in ("", "$") else r"\$" + mark

    return re.sub(r"\$([$&0-9]?)", dollar, target.replace("\\", "\\\\"))


def replace_pattern(text: Column, pattern: str, target: str = "", ignore_case: bool = True) -> Column:
    flags = "(?i)" if ignore_case else ""
    return F.regexp_replace(text, flags + pattern, replacement(target, group_count(pattern)))


def replace_literal(text: Column, old: str, new: str) -> Column:
    """Replace every occurrence of a fixed string, minding case."""
    if not old:
        raise ValueError("a literal rule needs a non-empty source")
    return F.replace(text, F.lit(old), F.lit(new))


def bare_statement(text: Column) -> Column:
    """A statement without the blanks, comments and opening brackets before it."""
    return F.regexp_replace(text, r"(?s)^(?:\s++|--[^\n]*+|/\*.*?\*/|\()++", "")


def preview(text: Column, length: int) -> Column:
    return F.left(text, F.lit(length))


def part(text: Column, separator: str, index: int) -> Column:
    """The ``index``-th piece of a separated string, empty when absent."""
    return F.split_part(text, F.lit(separator), F.lit(index))
