"""Which tables a statement reads and writes, and with how many joins.

A statement is cut into tokens by one regular expression, so that comments,
strings and quoted names are told apart from left to right, as they stand. The
tokens are then folded once, with a small state: what the next name would be,
the clause at every open bracket, the names that ``WITH`` defines, and what was
found so far. Everything is a column expression.

Names come in lower case, without quotes, each part as written otherwise. A
name defined by ``WITH`` is no table, a function in a table's place neither.
Every further table of a list counts as a join, whether it stands behind
``JOIN`` or a comma. A null statement has nothing; an open comment, string or
quoted name reaches to the statement's end.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideferry.functions.frames import computed_once

_COMMENT = r"--[^\n]*+|/\*(?s:.*?)(?:\*/|\z)"
_STRING = r"'[^']*+'?+|\$(\w*+)\$(?s:.*?)(?:\$\{tag}\$|\z)"
_QUOTED = r'"[^"]*+"?+'
_PART = rf"(?:[\p{{L}}_][\p{{L}}\p{{N}}_$]*+|{_QUOTED})"
_NAME = rf"{_PART}(?:\s*+\.\s*+{_PART})*+"

# One token: comment, string, number, name of any parts, or one of the signs that matter.
_TOKEN = rf"{_COMMENT}|{_STRING.format(tag=1)}|\d[\w.]*+|{_NAME}|[(),;]"


def bare_words(text: Column) -> Column:
    """A statement without comments, strings and quoted names, for rules that look for words."""
    return F.regexp_replace(text, f"{_COMMENT}|{_STRING.format(tag=1)}|{_QUOTED}", " ")


def tokens(text: Column) -> Column:
    """A statement's tokens in order, without comments."""
    found = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))
    return F.filter(found, lambda token: ~(F.startswith(token, F.lit("--")) | F.startswith(token, F.lit("/*"))))


# What the next name is, and what the clause at an open bracket is; one letter each.
NOTHING, READ, USING, WRITE, DEFINED = "-", "r", "u", "w", "d"
START, SELECT, TABLES, CALL, DEFINITIONS, OTHER = "s", "c", "t", "(", "d", "o"

# Words of the language (fixed values): statements, ends of a table list, words that may stand
# before a name that is due, and others that are no names.
_VERBS = ("select", "insert", "update", "delete", "merge", "copy", "create", "drop", "alter", "vacuum", "analyze", "truncate", "unload")
_ENDS = ("where", "group", "order", "having", "limit", "union", "except", "intersect", "minus", "set", "values", "qualify", "window", "returning")
_BETWEEN = ("if", "not", "exists", "only", "lateral", "recursive", "full", "sort", "reindex", "compression", "verbose", "overwrite")
_BEFORE_BRACKET = ("exists", "in", "any", "all", "some", "values", "as", "and", "or", "not", "on", "using", "when", "then", "else")
_WORDS = (
    *("from", "join", "with", "into", "table", "view", "inner", "left", "right", "outer", "cross", "natural", "is", "between", "like"),
    *("case", "end", "distinct", "by", "for", "do", "replace"),
)

_NAMES = "cast(array() AS array<string>)"
_BEGIN = f"named_struct('due', '{NOTHING}', 'clauses', '{START}', 'before', '', 'verb', '', 'joins', 0, 'defined', {_NAMES}, 'reads', {_NAMES}, 'writes', {_NAMES})"

# What stood before: a table that was read, any other name, or else the word or sign itself.
_A_READ, _A_NAME = "a read", "a name"


def _worded(token: Column) -> Column:
    sign = F.when(token.isin("(", ")", ",", ";"), token)
    return F.struct(sign.alias("sign"), F.when(sign.isNull() & F.rlike(token, F.lit(rf"\A{_PART}")), F.lower(token)).alias("word"))


def _classed(token: Column) -> Column:
    """A token's sign or word, and which kind of word it is. Made once, as a fold makes anew whatever its step asks for."""
    sign, word = token["sign"], token["word"]
    kind = (
        F.when(word.isNull(), "")
        .when(~word.isin(*_VERBS, *_ENDS, *_BETWEEN, *_BEFORE_BRACKET, *_WORDS), "name")
        .when(word.isin(*_ENDS), "end")
        .when(word.isin(*_BETWEEN), "between")
        .when(word.isin(*_VERBS), "verb")
        .otherwise("word")
    )
    return F.struct(sign.alias("sign"), word.alias("word"), kind.alias("kind"))


def _state(state: Column, **changed: Column | str) -> Column:
    """A state with some fields changed; unless it is said what is due next, nothing is."""
    fields = ("due", "clauses", "before", "verb", "joins", "defined", "reads", "writes")
    values = {name: state[name] for name in fields} | {"due": F.lit(NOTHING), "before": F.lit("")} | changed
    return F.struct(*[(F.lit(values[name]) if isinstance(values[name], str) else values[name]).alias(name) for name in fields])


def _within(state: Column, letter: str) -> Column:
    """The clauses with another one at the innermost bracket."""
    return F.concat(F.left(state["clauses"], F.length(state["clauses"]) - 1), F.lit(letter))


def _behind_name(state: Column, word: Column) -> Column:
    name = F.replace(F.regexp_replace(word, r"\s*+\.\s*+", "."), F.lit('"'), F.lit(""))
    due = state["due"]
    read = due.isin(READ, USING) & ~F.array_contains(state["defined"], name)

    def added(names: str, condition: Column) -> Column:
        return F.when(condition, F.concat(state[names], F.array(name))).otherwise(state[names])

    return F.when(due == NOTHING, _state(state, before=_A_NAME)).otherwise(
        _state(
            state,
            before=F.when(read, _A_READ).otherwise(_A_NAME),
            defined=added("defined", due == DEFINED),
            reads=added("reads", read),
            writes=added("writes", due == WRITE),
        )
    )


def _behind_sign(state: Column, sign: Column) -> Column:
    clauses, before, due = state["clauses"], state["before"], state["due"]
    clause, reads = F.right(clauses, F.lit(1)), state["reads"]
    nothing = F.array().cast("array<string>")
    # A bracket behind a table that was just read makes it a function.
    others = F.when(before == _A_READ, F.slice(reads, 1, F.greatest(F.size(reads) - 1, F.lit(0)))).otherwise(reads)
    inner = F.when(due == READ, TABLES).when(before.isin(_A_READ, _A_NAME), CALL).otherwise(START)
    opened = _state(state, due=F.when(due == READ, READ).otherwise(NOTHING), before="(", clauses=F.concat(clauses, inner), reads=others)
    closed = _state(state, before=")", clauses=F.when(F.length(clauses) > 1, F.left(clauses, F.length(clauses) - 1)).otherwise(clauses))
    ended = _state(state, before=";", clauses=START, verb="", defined=nothing)
    return (
        F.when(sign == "(", opened)
        .when(sign == ")", closed)
        .when(sign == ";", ended)
        .when(clause == TABLES, _state(state, due=READ, before=",", joins=state["joins"] + 1))
        .when(clause == DEFINITIONS, _state(state, due=DEFINED, before=","))
        .otherwise(_state(state, before=","))
    )


def _behind_word(state: Column, word: Column, kind: Column) -> Column:
    clauses, due, before, verb = state["clauses"], state["due"], state["before"], state["verb"]
    clause = F.right(clauses, F.lit(1))
    # Also the USING of a join in such a statement, but no name stands in its bracket's place.
    using = (word == "using") & verb.isin("delete", "merge")
    source = (word == "from") & (before != "distinct") & (verb != "copy")
    target = (
        word.isin("into", "table", "view")
        | ((verb == "") & word.isin("vacuum", "analyze", "truncate", "copy"))
        | ((word == "update") & ~before.isin("for", "do", "then"))
        | (source & (before == "delete"))
    )
    defining = (word == "with") & ~clause.isin(SELECT, TABLES)
    due_next = (
        F.when(kind == "end", NOTHING)
        .when((kind == "between") | ((word == "delete") & (due == WRITE)), due)
        .when(target, WRITE)
        .when(using, USING)
        .when(source | (word == "join"), READ)
        .when(defining, DEFINED)
        .otherwise(NOTHING)
    )
    clauses_next = (
        F.when(kind == "end", _within(state, OTHER))
        .when(word == "select", _within(state, SELECT))
        .when(source | (word == "join") | using, _within(state, TABLES))
        .when(defining, _within(state, DEFINITIONS))
        .otherwise(clauses)
    )
    is_verb = ((kind == "verb") | (word == "with")) & verb.isin("", "with") & (F.length(clauses) == 1)
    verb_next = F.when(is_verb, word).otherwise(verb)
    joins = F.when(word == "join", state["joins"] + 1).otherwise(state["joins"])
    outside = _state(state, due=due_next, clauses=clauses_next, before=word, verb=verb_next, joins=joins)
    # Between the arguments of a function only a query inside means something.
    inside = _state(state, clauses=F.when(word == "select", _within(state, SELECT)).otherwise(clauses), before=word)
    return F.when(clause != CALL, outside).otherwise(inside)


def _step(state: Column, token: Column) -> Column:
    """The state behind one token."""
    kind = token["kind"]
    return (
        F.when(kind == "name", _behind_name(state, token["word"]))
        .when(token["sign"].isNotNull(), _behind_sign(state, token["sign"]))
        .when(kind == "", _state(state))
        .otherwise(_behind_word(state, token["word"], kind))
    )


def tables_of(text: Column) -> Column:
    """A struct of the tables a statement reads and writes, each once, and its joins."""
    read = F.aggregate(F.transform(F.transform(tokens(text), _worded), _classed), F.expr(_BEGIN), _step)
    return F.transform(
        F.array(read), lambda found: F.struct(F.array_distinct(found["reads"]).alias("reads"), F.array_distinct(found["writes"]).alias("writes"), found["joins"].alias("joins"))
    )[0]


def _used(use: Column, name: Column) -> Column:
    return F.struct(name.alias("table_name"), use.alias("usage"))


def query_tables(queries: DataFrame, key: str = "query_id", column: str = "query_text") -> DataFrame:
    """One row per statement, table and use of it (READ or WRITE), with the statement's joins."""
    found = queries.select(F.col(key), computed_once([tables_of(F.col(column)).alias("found")]))
    read, written = (
        F.transform(f"found.{names}", functools.partial(_used, F.lit(use))) for names, use in (("reads", "READ"), ("writes", "WRITE"))
    )
    return found.select(key, F.col("found.joins").alias("joins"), F.inline(F.concat(read, written))).select(key, "table_name", "usage", "joins")
