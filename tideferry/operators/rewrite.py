"""Rewrite text columns by an ordered rule table.

Rules are configuration: rows read once that become one expression, so any
number of texts is rewritten in a single JVM-side projection over the scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideferry.functions.text import (
    SPACE,
    WORD,
    group_count,
    replace_pattern,
    replacement,
    whole_word,
)

TYPE_MAP = "DATA_TYPE_MAP"
CLAUSE_STRIP = "CLAUSE_STRIP"
FUNCTION_MAP = "FUNCTION_MAP"
STAGES = (TYPE_MAP, CLAUSE_STRIP, FUNCTION_MAP)


@dataclass(frozen=True)
class Rule:
    kind: str
    source: str
    target: str = ""
    is_regex: bool = False
    priority: int = 100
    rule_id: str = ""
    is_active: bool = True
    notes: str = ""

    def __post_init__(self) -> None:
        if not self.source:
            raise ValueError("a rule needs a non-empty source")

    def pattern(self) -> tuple[str, str]:
        """The rule as a Java pattern and replacement."""
        if self.kind == TYPE_MAP:
            return "(?i)" + whole_word(self.source), replacement(self.target, group_count(self.source))
        if self.kind == CLAUSE_STRIP:
            return "(?i)" + self.source, ""
        if self.is_regex:
            return "(?i)" + self.source, replacement(self.target, group_count(self.source))
        return "\\Q" + self.source.replace("\\E", "\\E\\\\E\\Q") + "\\E", replacement(
            self.target.replace("$", "$$")
        )


def required_text(rule: Rule) -> str | None:
    """What a text must hold, in any letter case, for the rule's pattern to match; None if nothing can be told.

    The longest run of plain characters that every match has.
    Brackets, classes, escapes of classes and optional characters end a run;
    a choice at the top, and what this reading does not know, tell nothing.
    """
    runs, run, depth, i, pattern = [], "", 0, 0, rule.source

    def end() -> None:
        nonlocal run
        runs.append(run)
        run = ""

    while i < len(pattern):
        sign, i = pattern[i], i + 1
        if sign == "\\":
            escaped, i = pattern[i : i + 1], i + 1
            if escaped and not escaped.isalnum() and escaped.isascii():
                run += escaped if depth == 0 else ""
                continue
            if escaped not in set("sSdDwWbB"):
                return None
            end()
        elif sign == "[":
            # A class may hold brackets of its own only as escapes here.
            close = re.compile(r"\[\^?\]?(?:\\.|[^\[\]\\])*\]").match(pattern, i - 1)
            if close is None:
                return None
            end()
            i = close.end()
        elif sign == "(":
            if pattern.startswith("?", i) and not pattern.startswith(("?:", "?=", "?!", "?<=", "?<!"), i):
                return None
            end()
            depth += 1
        elif sign == ")":
            depth -= 1
        elif sign in "?*{":
            if depth == 0:
                run = run[:-1]
                end()
            close = pattern.find("}", i) if sign == "{" else i - 1
            if close < 0:
                return None
            i = close + 1
            i += pattern.startswith(("?", "+"), i)
        elif sign == "+":
            end()
            i += pattern.startswith(("?", "+"), i)
        elif sign in ".^$":
            end()
        elif sign == "|":
            if depth == 0:
                return None
        elif depth == 0:
            run += sign
    end()
    found = max(runs, key=len).lower()
    return found if found and found.isascii() and depth == 0 else None


# Default rules (fixed values). TOP is a pattern, so that it leaves words that
# end in it alone.
DEFAULT_RULES = (
    Rule(TYPE_MAP, "TIMESTAMP", "TIMESTAMP_NTZ", rule_id="t1", notes="no time zone"),
    Rule(TYPE_MAP, "TIMESTAMPTZ", "TIMESTAMP_TZ", rule_id="t2", notes="with time zone"),
    Rule(TYPE_MAP, "SUPER", "VARIANT", rule_id="t3", notes="semi-structured"),
    Rule(TYPE_MAP, "HLLSKETCH", "VARCHAR", rule_id="t4", notes="sketch, kept as text"),
    Rule(TYPE_MAP, "FLOAT4", "FLOAT4", rule_id="t5", notes="same"),
    Rule(TYPE_MAP, "FLOAT8", "FLOAT8", rule_id="t6", notes="same"),
    Rule(TYPE_MAP, "BOOL", "BOOLEAN", rule_id="t7", notes="same"),
    Rule(CLAUSE_STRIP, r"DISTKEY\([^)]+\)", rule_id="c1", notes="distribution key"),
    Rule(CLAUSE_STRIP, r"(?:INTERLEAVED\s+)?SORTKEY\s*\([^)]*\)", rule_id="c2", notes="sort key"),
    Rule(CLAUSE_STRIP, r"DISTSTYLE\s+\w+", rule_id="c3", notes="distribution style"),
    Rule(CLAUSE_STRIP, r"ENCODE\s+\w+", rule_id="c4", notes="column encoding"),
    Rule(FUNCTION_MAP, "GETDATE()", "CURRENT_TIMESTAMP()", rule_id="f1", notes="current time"),
    Rule(FUNCTION_MAP, "ISNULL(", "NVL(", rule_id="f2", notes="null default"),
    Rule(FUNCTION_MAP, f"(?<!{WORD})TOP ", "LIMIT ", is_regex=True, rule_id="f3", notes="row limit"),
)


def ordered(rules: Iterable[Rule]) -> list[Rule]:
    """Active rules, one per (kind, source), by priority and id within each kind."""
    ranked = sorted(
        (r for r in rules if r.is_active), key=lambda r: (r.priority, r.rule_id, r.source)
    )
    unique = {(r.kind, r.source): r for r in reversed(ranked)}
    return [r for r in ranked if unique[(r.kind, r.source)] is r]


def rules_from(config: DataFrame) -> list[Rule]:
    """Read the active rules of a rule table: configuration, which becomes part of the plan."""
    rows = config.filter("is_active").collect()
    return ordered(
        Rule(
            row.config_type,
            row.source_value,
            row.target_value or "",
            bool(row.is_regex),
            row.priority,
            row.config_id,
        )
        for row in rows
    )


def deduplicated(config: DataFrame, keys: Sequence[str], rule_id: str) -> DataFrame:
    """Rule rows whose id is the smallest of its (type, source) group.

    Ids are unique, so this is the row of the smallest id per group: one
    aggregation, instead of a grouped minimum joined back to the table.
    """
    columns = F.struct(*[F.col(c) for c in config.columns])
    return (
        config.groupBy(*keys).agg(F.min_by(columns, rule_id).alias("_row")).select("_row.*")
    )


# From so many rules on, a text is first asked for what a pattern requires; for fewer, running all patterns costs no more.
MANY_RULES = 32


def apply_rules(text: Column, rules: Sequence[Rule]) -> Column:
    """Apply the rules to the text, in the order given. Literal rules are plain replacements.

    A few rules are expressions one inside the other, each with a fixed pattern
    that a task compiles once. Many travel as one array and are folded over the
    text; a pattern then runs only over a text that holds, as the rules before
    have left it, the plain part that the pattern requires.
    """
    if len(rules) < MANY_RULES:
        for rule in rules:
            if _is_literal(rule):
                text = F.replace(text, F.lit(rule.source), F.lit(rule.target))
            else:
                pattern, target = rule.pattern()
                text = F.regexp_replace(text, pattern, target)
        return text
    steps = []
    for rule in rules:
        pattern, target = rule.pattern()
        literal = _is_literal(rule)
        required = None if literal else required_text(rule)
        texts = {"literal": rule.source if literal else None, "pattern": pattern, "target": rule.target if literal else target, "required": required}
        steps.append(F.struct(*[F.lit(value).cast("string").alias(name) for name, value in texts.items()]))

    def applied(done: Column, step: Column) -> Column:
        replaced = F.regexp_replace(done, step["pattern"], step["target"])
        absent = step["required"].isNotNull() & ~F.contains(F.lower(done), step["required"])
        return F.when(step["literal"].isNotNull(), F.replace(done, step["literal"], step["target"])).when(absent, done).otherwise(replaced)

    return F.aggregate(F.array(*steps), text, applied)


def _is_literal(rule: Rule) -> bool:
    return rule.kind == FUNCTION_MAP and not rule.is_regex


def apply_kind(text: Column, rules: Iterable[Rule], kind: str) -> Column:
    return apply_rules(text, [rule for rule in ordered(rules) if rule.kind == kind])


def clean_up(text: Column, schema_prefix: str | None = None) -> Column:
    """Fixed final pass: leftovers of storage clauses, schema prefix, layout."""
    # The eight patterns.
    text = replace_pattern(text, f"ENCODE{SPACE}+\\w+")
    text = replace_pattern(text, f"DISTSTYLE{SPACE}+(?:KEY|ALL|EVEN)")
    text = replace_pattern(text, f"DISTKEY{SPACE}*\\([^)]++\\)")
    text = replace_pattern(text, f"SORTKEY{SPACE}*\\([^)]++\\)")
    if schema_prefix:
        text = replace_pattern(text, f"\\Q{schema_prefix}.\\E")
    text = replace_pattern(text, f"CREATE{SPACE}+TABLE", "CREATE OR REPLACE TABLE")
    # A comma, spaces with a line break among them, and a closing bracket. The
    # possessive parts keep a long run of blank lines linear.
    text = replace_pattern(
        text, f",(?:(?!\\n){SPACE})*+\\n{SPACE}*+\\)", "\n)", ignore_case=False
    )
    return replace_pattern(text, f"\\n{SPACE}*\\n", "\n", ignore_case=False)


def rewrite_text(text: Column, rules: Iterable[Rule] = DEFAULT_RULES, schema_prefix: str | None = None) -> Column:
    """Types, then clauses, then functions, then the fixed clean-up."""
    rules = ordered(rules)
    staged = [rule for kind in STAGES for rule in rules if rule.kind == kind]
    return clean_up(apply_rules(text, staged), schema_prefix)


def rewrite(
    texts: DataFrame,
    column: str,
    rules: Iterable[Rule] = DEFAULT_RULES,
    schema_prefix: str | None = None,
    out: str = "rewritten",
) -> DataFrame:
    """All columns of ``texts`` plus the rewritten text."""
    return texts.withColumn(out, rewrite_text(F.col(column), rules, schema_prefix))


def qualify(text: Column, qualifier: str, table: Column | str) -> Column:
    """Put ``qualifier.`` and the table name into the first definition that has no qualifier yet."""
    head = f"(?is)\\A(.*?)CREATE{SPACE}+OR{SPACE}+REPLACE{SPACE}+TABLE{SPACE}+\\w+"
    name = F.upper(F.lit(table) if isinstance(table, str) else table)
    escaped = F.replace(F.replace(name, F.lit("\\"), F.lit(r"\\")), F.lit("$"), F.lit(r"\$"))
    named = F.concat(F.lit("$1CREATE OR REPLACE TABLE " + replacement(f"{qualifier}.")), escaped)
    return F.when(F.contains(text, F.lit(f"{qualifier}.")), text).otherwise(
        F.regexp_replace(text, F.lit(head), named)
    )
