import pandas as pd
import pytest

from tideferry.operators.classify import classify, normalise_labels
from tideferry.operators.profile import column_inventory, complexity_tier, query_profile
from tideferry.plans import reports

CASES = {
    "insert into a select * from b": "ETL",
    "  COPY a FROM 's3://x'": "ETL",
    "create temp table a as (select 1)": "ETL",
    "CREATE TABLE x.y\nAS\nWITH q AS (SELECT 1) SELECT * FROM q": "ETL",
    "create table a (assets int)": "MAINTENANCE",
    "VACUUM a": "MAINTENANCE",
    "analyze a": "MAINTENANCE",
    "GRANT SELECT ON a TO b": "MAINTENANCE",
    "select state, count ( distinct id ) from a": "REPORTING",
    "with q as (select 1) select x from q group\nby x": "REPORTING",
    "select * from a join b on a.x = b.x\nwhere y > 1 order by y limit 50": "REPORTING",
    "select * from a where x = 42 limit 100": "AD_HOC",
    "select discount from a order by discount": "AD_HOC",
    "show tables": "AD_HOC",
    "good morning": "UNKNOWN",
}


def test_rules(spark):
    rows = spark.createDataFrame([(text,) for text in CASES], "query_text string")
    found = {row.query_text: row for row in classify(rows).collect()}
    assert {text: row.query_category for text, row in found.items()} == CASES
    assert {row.confidence for row in found.values() if row.query_category != "UNKNOWN"} == {"HIGH"}
    assert found["good morning"].confidence == "LOW"


def test_scorer(spark):
    def shout(texts: pd.Series) -> pd.Series:
        return "I think: " + texts.str.split().str[0]

    rows = spark.createDataFrame([("etl it",), ("adhoc it",), ("x",)], "query_text string")
    found = [(r.query_category, r.confidence) for r in classify(rows, scorer=shout).collect()]
    assert found == [("ETL", "HIGH"), ("AD_HOC", "HIGH"), ("UNKNOWN", "LOW")]


@pytest.mark.parametrize(
    "answer, category",
    [(" etl\n", "ETL"), ("Reporting, not ETL", "ETL"), ("ad_hoc", "AD_HOC"), ("AdHoc.", "AD_HOC"),
     ("maintenance", "MAINTENANCE"), ("ad hoc", "UNKNOWN"), ("", "UNKNOWN"), (None, "UNKNOWN")],
)
def test_answers(spark, answer, category):
    rows = spark.createDataFrame([(answer,)], "a string")
    assert normalise_labels(rows, "a").first().query_category == category


def test_profile_and_tiers(spark):
    rows = spark.createDataFrame(
        [("SELECT * FROM s.a JOIN s.b ON 1 = 1 JOIN s.A x ON 2 = 2",), ("select isnull(x, 1) from s.b",),
         ("copy s.a from 'x'",), ("nothing",)],
        "query_text string",
    )
    found = {r.table_name: r[1:] for r in query_profile(rows).collect()}
    assert found == {"s.a": (2, 1, 2), "s.b": (2, 1, 2)}  # COPY writes its table
    tiers = [r.complexity_level for r in complexity_tier(rows).collect()]
    assert tiers == ["GREEN", "YELLOW", "RED", "GREEN"]


def test_distinct_estimates(spark):
    rows = spark.range(10000).selectExpr("id", "id % 10 AS digit", "if(id < 2500, null, 'x') AS text")
    found = {r.column_name: r for r in column_inventory({"t": rows}, estimate_distinct=True).collect()}
    assert abs(found["id"].distinct_estimate - 10000) < 1000
    assert (found["digit"].distinct_estimate, found["text"].distinct_estimate) == (10, 1)
    assert (found["text"].null_count, found["text"].data_type, found["text"].position) == (2500, "string", 3)


def test_pass_rate_of_nothing(spark):
    empty = spark.createDataFrame([], "run_id string, status string")
    assert reports.pass_rate(empty).first().pass_rate == 0.0


def test_comments_and_brackets_before_a_statement(spark):
    texts = {
        "-- nightly\nINSERT INTO a SELECT 1": "ETL",
        "/* x; y */ (select * from t)": "AD_HOC",
        "select a into b from c": "ETL",
        "with x as (select 1) insert into y select * from x": "ETL",
        "with x as (select 1) select * from x": "AD_HOC",
        "/* a */ -- b\n vacuum t": "MAINTENANCE",
        "-- only a comment": "UNKNOWN",
    }
    rows = spark.createDataFrame([(text,) for text in texts], "query_text string")
    assert {row.query_text: row.query_category for row in classify(rows).collect()} == texts
