import pytest
from pyspark.sql import functions as F

from tideferry.model import TRANSLATION_RULES, with_defaults
from tideferry.operators.rewrite import (
    CLAUSE_STRIP,
    DEFAULT_RULES,
    FUNCTION_MAP,
    TYPE_MAP,
    Rule,
    apply_rules,
    clean_up,
    ordered,
    qualify,
    rewrite,
    rewrite_text,
    rules_from,
)


def run(spark, text, expression):
    return spark.createDataFrame([(text,)], "t string").select(expression(F.col("t"))).first()[0]


def apply(spark, text, *rules):
    return run(spark, text, lambda t: apply_rules(t, rules))


def test_types_are_whole_ascii_words(spark):
    rule = Rule(TYPE_MAP, "TOP", "LIMIT")
    assert apply(spark, "STOP top TOPS éTOP TOP_ 1TOP (TOP)", rule) == "STOP LIMIT TOPS éLIMIT TOP_ 1TOP (LIMIT)"


def test_type_alternatives_and_patterns(spark):
    assert apply(spark, "der oder die Die_", Rule(TYPE_MAP, "der|die", "d")) == "d oder d Die_"
    assert apply(spark, "float8 float16x float4", Rule(TYPE_MAP, r"float\d+", "DOUBLE")) == "DOUBLE float16x DOUBLE"
    assert apply(spark, "a(b) (b)", Rule(TYPE_MAP, r"\(b\)", "x")) == "a(b) (b)"


def test_targets_may_hold_dollars_and_backslashes(spark):
    assert apply(spark, "a", Rule(TYPE_MAP, "a", r"$1\n$$ $&")) == r"$1\n$ a"
    assert apply(spark, "ab", Rule(FUNCTION_MAP, "(a)(b)", "$2$1$3", is_regex=True)) == "ba$3"
    assert apply(spark, "f(x)", Rule(FUNCTION_MAP, "f(", r"\$1(")) == r"\$1(x)"


def test_literal_functions_mind_case(spark):
    rule = Rule(FUNCTION_MAP, "GETDATE()", "CURRENT_TIMESTAMP()")
    assert apply(spark, "GETDATE() getdate()", rule) == "CURRENT_TIMESTAMP() getdate()"
    with pytest.raises(ValueError):
        Rule(FUNCTION_MAP, "", "x")


def test_many_rules_fold_to_the_same_text(spark):
    rules = [Rule(TYPE_MAP, f"w{i}", f"w{i + 1}", rule_id=f"{i:03}") for i in range(150)]
    rules += [Rule(FUNCTION_MAP, "w1(", r"$E\Q[", rule_id="x"), Rule(CLAUSE_STRIP, r"gone\s+\w+", rule_id="y")]
    text = "w0 w149 w1( W7 gone  away"
    nested = text
    for start in range(0, len(rules), 50):
        nested = apply(spark, nested, *rules[start : start + 50])
    assert apply(spark, text, *rules) == nested == r"w150 w150 w150( w150 "


def test_rule_order_and_duplicates():
    rules = [
        Rule(TYPE_MAP, "b", "late", priority=200, rule_id="1"),
        Rule(TYPE_MAP, "b", "early", priority=50, rule_id="9"),
        Rule(TYPE_MAP, "a", "first", priority=50, rule_id="2"),
        Rule(TYPE_MAP, "c", is_active=False),
    ]
    assert [(r.source, r.target) for r in ordered(rules)] == [("a", "first"), ("b", "early")]


def test_rules_from_a_table(spark):
    config = spark.createDataFrame(
        [("2", TYPE_MAP, "A", "B", None), ("1", TYPE_MAP, "A", "C", None), ("3", CLAUSE_STRIP, "x", None, False)],
        "config_id string, config_type string, source_value string, target_value string, is_active boolean",
    )
    rules = rules_from(with_defaults(config, TRANSLATION_RULES))
    assert [(r.rule_id, r.target) for r in rules] == [("1", "C")]


DEFINITION = """CREATE TABLE shop.users (
    userid INTEGER NOT NULL ENCODE az64,
    joined TIMESTAMP ENCODE raw,
    PRIMARY KEY (userid),
)
DISTSTYLE KEY
DISTKEY (userid)
SORTKEY (userid);"""


def test_whole_definition(spark):
    found = run(spark, DEFINITION, lambda t: rewrite_text(t, DEFAULT_RULES, "SHOP"))
    assert found.split("\n") == [
        "CREATE OR REPLACE TABLE users (",
        "    userid INTEGER NOT NULL ,",
        "    joined TIMESTAMP_NTZ ,",
        "    PRIMARY KEY (userid)",
        ")",
        ";",
    ]
    again = run(spark, found, lambda t: rewrite_text(t, DEFAULT_RULES, "SHOP"))
    assert again == found


def test_sort_key_rules_do_not_collide(spark):
    found = run(spark, "x INTERLEAVED SORTKEY(a, b) y", lambda t: rewrite_text(t))
    assert found == "x  y"


def test_row_limit_rule_leaves_longer_words(spark):
    assert run(spark, "STOP TOP 5", lambda t: rewrite_text(t)) == "STOP LIMIT 5"


def test_java_patterns_keep_their_groups(spark):
    for pattern in (r"(\p{L}+)\(\)", r"(?<n>\w+)\(\)", r"([a-z]+)\(\)"):
        assert apply(spark, "now()", Rule(FUNCTION_MAP, pattern, "f_$1", is_regex=True)) == "f_now"
    with pytest.raises(ValueError, match="not a Java pattern"):
        apply(spark, "x", Rule(FUNCTION_MAP, "(", "y", is_regex=True))


def test_clean_up_knows_all_spaces(spark):
    assert run(spark, "a ENCODE lzo,\n )\n　\nb", lambda t: clean_up(t)) == "a \n)\nb"


def test_long_blank_runs_stay_linear(spark):
    blank = "\n \t" * 100_000
    for text in ("," + blank + "x", "," + blank + ")", "a" + " \n" * 100_000):
        assert len(run(spark, text, lambda t: clean_up(t))) < 10
    assert run(spark, ",  )", lambda t: clean_up(t)) == ",  )"


def test_prefix_is_literal(spark):
    assert run(spark, "s.x sax", lambda t: clean_up(t, "s")) == "x sax"


def test_null_and_empty_texts(spark):
    rows = spark.createDataFrame([(None,), ("",)], "t string")
    assert [row.rewritten for row in rewrite(rows, "t").collect()] == [None, ""]


def test_qualify(spark):
    def named(text, table="users"):
        return run(spark, text, lambda t: qualify(t, "db.TARGET", table))

    assert named("create or replace\n table a (x)") == "CREATE OR REPLACE TABLE db.TARGET.USERS (x)"
    assert named("x\nCREATE OR REPLACE TABLE a; CREATE OR REPLACE TABLE b") == (
        "x\nCREATE OR REPLACE TABLE db.TARGET.USERS; CREATE OR REPLACE TABLE b"
    )
    assert named("CREATE OR REPLACE TABLE db.TARGET.a") == "CREATE OR REPLACE TABLE db.TARGET.a"
    assert named("CREATE OR REPLACE TABLE a", r"p$1\x") == r"CREATE OR REPLACE TABLE db.TARGET.P$1\X"
    assert named("SELECT 1") == "SELECT 1"
