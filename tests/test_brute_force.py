"""Random small inputs against plain Python."""

import random
import re
from collections import Counter, defaultdict

from tideferry.operators.checksum import compare_sample
from tideferry.operators.incremental import new_rows
from tideferry.operators.registry import register_new
from tideferry.operators.rewrite import CLAUSE_STRIP, DEFAULT_RULES, FUNCTION_MAP, TYPE_MAP, ordered, rewrite
from tideferry.operators.state import latest_rows
from tideferry.sources.delimited import Dataset, Field, parse_lines

WORDS = [
    "CREATE", "TABLE", "create  table", "shop.", "SHOP.a", "TIMESTAMP", "timestamptz", "Timestamp_x", "BOOL", "bool8",
    "éSUPER", "SUPERé", "SUPER", "HLLSKETCH,", "FLOAT4", "ENCODE", "encode lzo", "ENCODE\naz64", "DISTSTYLE KEY",
    "diststyle all", "DISTSTYLE odd", "DISTKEY(a)", "DISTKEY (a, b)", "DISTKEY ()", "SORTKEY(a)", "INTERLEAVED",
    "INTERLEAVED SORTKEY (a)", "INTERLEAVEDSORTKEY(", "GETDATE()", "getdate()", "ISNULL(x", "XISNULL(", "TOP ", ",",
    ")", "(", "\n", "\n\n", ",\n)", ", \n \n )", " ", "\t", "$1", "\\d", "x",
]


def rewritten(text: str) -> str:
    """The rules and the clean-up, one after the other, with Python's re."""
    flags = re.IGNORECASE | re.ASCII
    for kind in (TYPE_MAP, CLAUSE_STRIP, FUNCTION_MAP):
        for rule in ordered(DEFAULT_RULES):
            if rule.kind != kind:
                continue
            if kind == FUNCTION_MAP and not rule.is_regex:
                text = text.replace(rule.source, rule.target)
            else:
                pattern = rf"\b{rule.source}\b" if kind == TYPE_MAP else rule.source
                text = re.sub(pattern, rule.target, text, flags=flags)
    for pattern, target in [
        (r"ENCODE\s+\w+", ""), (r"DISTSTYLE\s+(KEY|ALL|EVEN)", ""), (r"DISTKEY\s*\([^)]+\)", ""),
        (r"SORTKEY\s*\([^)]+\)", ""), (r"shop\.", ""), (r"CREATE\s+TABLE", "CREATE OR REPLACE TABLE"),
        (r",\s*\n\s*\)", "\n)"), (r"\n\s*\n", "\n"),
    ]:
        text = re.sub(pattern, target, text, flags=flags)
    return text


def test_rewriting(spark):
    chance = random.Random(1)
    texts = ["".join(chance.choice(WORDS) + chance.choice(["", " ", "\n"]) for _ in range(chance.randint(0, 25)))
             for _ in range(3000)]
    rows = spark.createDataFrame([(text,) for text in texts], "t string")
    for row in rewrite(rows, "t", schema_prefix="shop").collect():
        assert row.rewritten == rewritten(row.t), row.t


PIECES = ["1", "-7", "300", "40000", "3.5", "abc", "abcdef", "", " ", "NULL", " null ", "Null", "\t2\t", " x\t ", "true", "F", "on", "0", "maybe"]
FIELDS = (Field("a", "smallint", required=True), Field("b", "string", max_length=4), Field("c", "boolean"))


def parsed_line(line: str):
    """(values, reason) of a line, straight from the rules."""
    parts = [part.strip(" \t") for part in line.split("|")]
    if len(parts) != 3:
        return None, "ARITY"
    a, b, c = (None if part in ("NULL", "null", "") else part for part in parts)
    number = int(a) if a and re.fullmatch(r"-?\d+", a) and -32768 <= int(a) <= 32767 else None
    truth = {"true": True, "t": True, "on": True, "1": True, "f": False, "0": False}.get((c or "").lower())
    if a and number is None:
        return None, "TYPE:a"
    if a is None:
        return None, "REQUIRED:a"
    if b and len(b) > 4:
        return None, "LENGTH:b"
    if c and truth is None:
        return None, "TYPE:c"
    return (number, b, truth), None


def test_parsing(spark):
    chance = random.Random(2)
    lines = ["|".join(chance.choice(PIECES) for _ in range(chance.choice([2, 3, 3, 3, 3, 3, 3, 4]))) for _ in range(4000)]
    rows = spark.createDataFrame([(line, "f") for line in lines], "_line string, _source_file string")
    found = parse_lines(rows, Dataset("t", "", FIELDS)).collect()
    assert sorted(row["_line"] for row in found) == sorted(lines)
    for row in found:
        values, reason = parsed_line(row["_line"])
        assert row["_reason"] == reason, row["_line"]
        assert reason or (row.a, row.b, row.c) == values, row["_line"]


def test_checksum(spark):
    chance = random.Random(3)

    def side():
        return [(chance.randrange(60), chance.choice("xy"), chance.choice([None, 1])) for _ in range(100)]

    source, target = side(), side()
    target += [row for row in source if row[0] < 20 and row not in target]
    expected = {}
    for key in {row[0] for row in source + target}:
        s, t = (Counter(row for row in rows if row[0] == key) for rows in (source, target))
        expected[key] = "MATCH" if s == t else "CHANGED"
        if not t:
            expected[key] = "MISSING_IN_TARGET"
        if not s:
            expected[key] = "EXTRA_IN_TARGET"
    schema = "k int, v string, w int"
    found = compare_sample(spark.createDataFrame(source, schema), spark.createDataFrame(target, schema), ["k"], 1.0)
    assert {row.k: row.status for row in found.collect()} == expected
    assert len(set(expected.values())) == 4


def test_latest_and_new_rows_with_a_hot_key(spark):
    chance = random.Random(4)
    rows = [(0 if chance.random() < 0.4 else chance.randrange(50), chance.randrange(30), i) for i in range(3000)]
    frame = spark.createDataFrame(rows, "k int, at int, seq int").repartition(8)
    best = defaultdict(tuple)
    for row in rows:
        best[row[0]] = max(best[row[0]], row[1:])
    found = latest_rows(frame, ["k"], ["at", "seq"]).collect()
    assert {row.k: (row["at"], row.seq) for row in found} == best

    held = [row for row in rows if row[0] in (0, 7, 9)]
    target = spark.createDataFrame(held, frame.schema).repartition(8)
    fresh = sorted(tuple(row) for row in new_rows(frame, target, ["k"]).collect())
    assert fresh == sorted(row for row in rows if row[0] not in (0, 7, 9))


def test_registering(spark):
    chance = random.Random(5)
    names = ["".join(chance.choice((letter, letter.upper())) for letter in chance.choice(["users", "sales", "venue"]))
             + str(chance.randrange(40)) for _ in range(400)]
    rows = [(chance.choice(["s", "S", "t"]), name, i, i) for i, name in enumerate(names)]
    inventory = spark.createDataFrame(rows, "source_schema string, source_table string, row_count_est long, size_bytes_est long")
    known = [(row[0], row[1].swapcase()) for row in rows[:120]]
    fresh = register_new(inventory, spark.createDataFrame(known, "source_schema string, source_table string"))
    taken = {(schema.upper(), table.upper()) for schema, table in known}
    expected = {(row[0].upper(), row[1].upper()) for row in rows} - taken
    found = [(row.source_schema.upper(), row.target_table) for row in fresh.collect()]
    assert sorted(found) == sorted(expected)
