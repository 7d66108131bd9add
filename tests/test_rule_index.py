"""What patterns require of a text, and folding many rules with and without asking for it."""

import re

import pytest
from pyspark.sql import functions as F

from tideferry.operators import rewrite
from tideferry.operators.rewrite import CLAUSE_STRIP, DEFAULT_RULES, FUNCTION_MAP, TYPE_MAP, Rule, apply_rules, required_text


@pytest.mark.parametrize(
    ("pattern", "required"),
    [
        ("TIMESTAMP", "timestamp"),
        (r"ENCODE\s+\w+", "encode"),
        (r"DISTKEY\([^)]+\)", "distkey("),
        (r"(?:INTERLEAVED\s+)?SORTKEY\s*\([^)]*\)", "sortkey"),
        (r"abcd?ef", "abc"),
        (r"abc*defg", "defg"),
        (r"abc+d", "abc"),
        (r"ab{2,3}cde", "cde"),
        (r"a\.b", "a.b"),
        (r"[xy]long[z]", "long"),
        (r"[\]x]tail", "tail"),
        (r"(hidden)shown", "shown"),
        (r"(?<!x)word(?=y)", "word"),
        (r"der|die", None),
        (r"(der|die)", None),
        (r"\p{L}+x", None),
        (r"\Qa+\E", None),
        (r"(?x) a b", None),
        (r"[a-z&&[def]]x", None),
        (r"größe", None),
        (r"\s+", None),
        (r"a\1", None),
    ],
)
def test_required_text(pattern, required):
    assert required_text(Rule(CLAUSE_STRIP, pattern)) == required


def test_no_match_without_what_is_required():
    texts = ["encode x", "ENCODE  lzo, Sortkey (a)", "interleaved sortkey()", "distkey (x)", "DISTKEY(x)", "diststyle all", "stop", "", "timestamptz SUPER bool"]
    for rule in DEFAULT_RULES:
        required = required_text(rule)
        if required and (rule.kind != FUNCTION_MAP or rule.is_regex):
            for text in texts:
                if re.search(rule.source, text, re.IGNORECASE):
                    assert required in text.lower(), (rule.source, text)


PATTERNS = [Rule(CLAUSE_STRIP if i % 2 else TYPE_MAP, f"w{i}\\s+x" if i % 2 else f"W{i}", f"w{i + 1} x", rule_id=f"{i:03}") for i in range(150)]
TEXTS = ["w0 X w1  x w3 x", "nothing here that any rule touches, é", "W148", "prefix w10 w11 x w12", "", None, "w" * 5000]


def test_many_patterns_with_and_without_asking(spark, monkeypatch):
    rows = spark.createDataFrame([(i, text) for i, text in enumerate(TEXTS)], "i int, text string")
    asked = rows.select("i", apply_rules(F.col("text"), PATTERNS).alias("done")).collect()
    monkeypatch.setattr(rewrite, "MANY_RULES", 10_000)
    plain = rows.select("i", apply_rules(F.col("text"), PATTERNS).alias("done")).collect()
    assert sorted(asked) == sorted(plain)
    done = {row.i: row.done for row in asked}
    assert done[1] == TEXTS[1] and done[5] is None and done[6] == TEXTS[6]
    # A rule's result is what the next one looks at.
    assert done[2] == ""


def test_literal_rules_mind_case_and_take_their_target_as_it_is(spark):
    rules = [Rule(FUNCTION_MAP, "a$1", "$1\\b", rule_id="1"), Rule(FUNCTION_MAP, "B", "c", rule_id="2"), Rule(FUNCTION_MAP, "é", "", rule_id="3")]
    done = spark.createDataFrame([("xa$1B b é",)], "t string").select(apply_rules(F.col("t"), rules)).first()[0]
    assert done == "x$1\\bc b "
