"""Tables of statements: what words and names mean depends on where they stand."""

import pytest
from pyspark.sql import functions as F

from tideferry.operators.classify import rule_label
from tideferry.operators.profile import complexity_tier, query_profile
from tideferry.operators.statements import bare_words, query_tables, tables_of, tokens

# statement: (reads, writes, joins)
STATEMENTS = {
    "SELECT * FROM store.t -- from old_t, x\nWHERE n = 'moved into archive'": (["store.t"], [], 0),
    "SELECT 1 /* FROM a\n, b */ FROM c": (["c"], [], 0),
    "SELECT sum(q) FROM l, store.o AS o, (SELECT 1 AS one) x WHERE extract(year FROM d) > 1": (["l", "store.o"], [], 2),
    'SELECT "group by" FROM "Sales"."Order Lines" WHERE "copy" = 1': (["sales.order lines"], [], 0),
    "WITH a AS (SELECT * FROM s.t), b (k, n) AS (SELECT c, count(*) FROM a, n GROUP BY c) DELETE FROM seen USING b WHERE k = 1": (["s.t", "n"], ["seen"], 1),
    "UPDATE m.seen SET note = 'it''s from b, c' FROM s.a, s.b WHERE x IN (SELECT y FROM listed(3), s.n)": (["s.a", "s.b", "s.n"], ["m.seen"], 2),
    "DELETE FROM a WHERE x IN (SELECT y FROM b JOIN c USING (y, z) JOIN d ON f(x, y) = 1, e)": (["b", "c", "d", "e"], ["a"], 3),
    "DELETE FROM a USING b, (SELECT * FROM c) d WHERE a.x = b.x": (["b", "c"], ["a"], 1),
    "COPY a.b FROM 's3://x' CREDENTIALS 'y' DELIMITER ',', gzip": ([], ["a.b"], 0),
    "UNLOAD ('select * from x') TO 's3'": ([], [], 0),
    "VACUUM FULL a.b": ([], ["a.b"], 0),
    "ANALYZE a (x, y)": ([], ["a"], 0),
    "TRUNCATE TABLE IF EXISTS q": ([], ["q"], 0),
    "CREATE TEMP TABLE IF NOT EXISTS x.y AS (SELECT * FROM a CROSS JOIN b)": (["a", "b"], ["x.y"], 1),
    "CREATE TABLE t (id INT, other TEXT DEFAULT 'from x')": ([], ["t"], 0),
    "CREATE OR REPLACE VIEW v AS WITH q AS (SELECT * FROM r) SELECT * FROM q, r2": (["r", "r2"], ["v"], 1),
    "MERGE INTO t USING (SELECT * FROM s) u ON t.a = u.a WHEN MATCHED THEN UPDATE SET b = 1 WHEN NOT MATCHED THEN INSERT (a, b) VALUES (u.a, u.b)": (["s"], ["t"], 0),
    "INSERT INTO t (a, b) SELECT a, b FROM (x JOIN y ON true), z WHERE a IS DISTINCT FROM b; SELECT 1 FROM w": (["x", "y", "z", "w"], ["t"], 2),
    "INSERT INTO a VALUES (1, 'from b'), (2, 'x')": ([], ["a"], 0),
    "SELECT trim(both ' ' FROM n) FROM a . b WHERE exists(SELECT 1 FROM c) ORDER BY x, y": (["a.b", "c"], [], 0),
    "SELECT CASE WHEN a THEN b ELSE c END, d FROM t1, t2 tt LIMIT 5": (["t1", "t2"], [], 1),
    "SELECT * FROM $q$ from x, $q$ , y": (["y"], [], 1),
    "SELECT x INTO temp_copy FROM a a1 LEFT OUTER JOIN a a2 ON a1.x = a2.x": (["a"], ["temp_copy"], 1),
    "WITH a AS (SELECT 1) SELECT * FROM a; SELECT * FROM a": (["a"], [], 0),
    "ALTER TABLE a.b RENAME TO c": ([], ["a.b"], 0),
    "SELECT * FROM größe, \"Größe\".x": (["größe", "größe.x"], [], 1),
    "/* open FROM x": ([], [], 0),
    "SELECT 'open FROM x": ([], [], 0),
    'SELECT "open FROM x': ([], [], 0),
    "SELECT ) ) ( FROM x, ( y": (["x", "y"], [], 1),
    "": ([], [], 0),
}


def test_tables_of_statements(spark):
    rows = spark.createDataFrame([(text,) for text in STATEMENTS], "text string").select("text", tables_of(F.col("text")).alias("found"))
    found = {row.text: (row.found.reads, row.found.writes, row.found.joins) for row in rows.collect()}
    assert found == STATEMENTS


def test_null_long_and_repeated(spark):
    long = "SELECT '" + "x, FROM y " * 100_000 + "' FROM a, " + ", ".join(f"t{i}" for i in range(300))
    rows = spark.createDataFrame([(1, None), (2, long), (3, "SELECT * FROM a, a"), (3, "SELECT * FROM a, a")], "id int, q string")
    uses = query_tables(rows.withColumn("found", F.lit("clash")), "id", "q").collect()
    assert sorted((row.id, row.table_name, row.usage, row.joins) for row in uses if row.id != 2) == [(3, "a", "READ", 1)] * 2
    assert sum(row.id == 2 for row in uses) == 301 and max(row.joins for row in uses) == 300
    assert query_tables(rows.limit(0), "id", "q").collect() == []


def test_tokens_leave_comments_out(spark):
    text = "SELECT a--b\n/* c */, 'd--e' /**/ FROM \"f.g\" . h"
    assert spark.range(1).select(tokens(F.lit(text))).first()[0] == ["SELECT", "a", ",", "'d--e'", "FROM", '"f.g" . h']


@pytest.mark.parametrize(
    ("statement", "label", "tier"),
    [
        ("SELECT * FROM t WHERE note = 'moved into archive'", "AD_HOC", "GREEN"),
        ("SELECT * FROM t -- getdate() \nWHERE x = 'distkey'", "AD_HOC", "GREEN"),
        ('SELECT "group by", "sum(" FROM t', "AD_HOC", "GREEN"),
        ("/* insert */ (SELECT sum(x) FROM t)", "REPORTING", "GREEN"),
        ("WITH a AS (SELECT 1) DELETE FROM t USING a", "ETL", "GREEN"),
        ("SELECT getdate() /* x */", "AD_HOC", "YELLOW"),
        ("-- note\nVACUUM t", "MAINTENANCE", "RED"),
    ],
)
def test_labels_and_tiers_pass_over_what_is_no_word(spark, statement, label, tier):
    rows = spark.createDataFrame([(statement,)], "query_text string")
    assert rows.select(rule_label(F.col("query_text"))).first()[0] == label
    assert complexity_tier(rows).first().complexity_level == tier


def test_bare_words(spark):
    text = "a 'b' \"c\" -- d\n$$e$$ f"
    assert spark.range(1).select(bare_words(F.lit(text))).first()[0].split() == ["a", "f"]


def test_profile_counts_reads_and_writes_once(spark):
    rows = spark.createDataFrame([("INSERT INTO t SELECT * FROM t, u",), ("SELECT * FROM u",), (None,)], "query_text string")
    assert {tuple(row) for row in query_profile(rows).collect()} == {("t", 1, 1, 1), ("u", 2, 1, 1)}
