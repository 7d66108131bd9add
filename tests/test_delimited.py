import datetime
from decimal import Decimal

import pytest

from tideferry.operators.load import load_dataset, open_loaded
from tideferry.sources.delimited import (
    Dataset,
    Field,
    UnknownDataset,
    dataset_for,
    parse_lines,
    read_lines,
)
from tideferry.sources.sample_tables import sample_datasets

FIELDS = (
    Field("id", "int", required=True),
    Field("name", "string", max_length=5),
    Field("price", "decimal(8,2)"),
    Field("ok", "boolean"),
    Field("at", "timestamp_ntz"),
    Field("day", "date"),
)

GOOD = [
    "1|abc|1.5|t|2008-01-24 06:43:29|2008-01-24",
    " 2 |  NULL |null|no|2/8/2008 02:36:48|12/31/2008",
    "3|été|||| ",
    "\t5 \t| \tNULL\t|\t|\t\tyes| \t|\t2008-01-02",
    '4|"a"|-0.01|on|2008-02-29 00:00:00|2008-02-29',
]
BAD = {
    "x|abc|1|t||": "TYPE:id",
    "5|abc|1|t|": "ARITY",
    "6|abc|1|t|||more": "ARITY",
    "": "ARITY",
    "7|abcdef|1|t||": "LENGTH:name",
    " NULL |abc|1|t||": "REQUIRED:id",
    "8|abc|1234567.89|t||": "TYPE:price",
    "9|abc|1|maybe||": "TYPE:ok",
    "10|abc|1|t|2008-13-01 00:00:00|": "TYPE:at",
    "11|abc|1|t||2008-02-30": "TYPE:day",
    "3000000000|abc|1|t||": "TYPE:id",
    "12.5|abc|1|t||": "TYPE:id",
}


@pytest.fixture(scope="module")
def dataset(tmp_path_factory):
    path = tmp_path_factory.mktemp("text")
    (path / "a.txt").write_text("\n".join(GOOD + list(BAD)) + "\n", encoding="utf-8")
    return Dataset("things", str(path), FIELDS)


def test_reasons(spark, dataset):
    parsed = parse_lines(read_lines(spark, dataset.location), dataset)
    reasons = {row['_line']: row['_reason'] for row in parsed.collect()}
    assert reasons == dict.fromkeys(GOOD) | BAD


def test_load_keeps_good_and_rejects(spark, dataset, tmp_path):
    target, rejects = str(tmp_path / "t"), str(tmp_path / "r")
    result = load_dataset(spark, dataset, target, rejects)
    assert (result.lines, result.rows, result.rejected) == (len(GOOD) + len(BAD), len(GOOD), len(BAD))
    table = open_loaded(spark, dataset, target)
    assert table.schema == dataset.schema
    rows = {row.id: row for row in table.collect()}
    assert rows[1].price == Decimal("1.50") and rows[1].ok is True
    assert rows[2][1:] == (
        None, None, False, datetime.datetime(2008, 2, 8, 2, 36, 48), datetime.date(2008, 12, 31),
    )
    assert rows[3].name == "été" and rows[3].day is None
    assert rows[5][1:] == (None, None, True, None, datetime.date(2008, 1, 2))
    assert rows[4].name == '"a"' and rows[4].ok is True
    kept = spark.read.parquet(rejects)
    assert {row.line: row.reason for row in kept.collect()} == BAD
    assert all("a.txt" in row.source_file for row in kept.collect())


def test_load_replaces_and_needs_no_rejects(spark, dataset, tmp_path):
    clean = tmp_path / "clean.txt"
    clean.write_text(GOOD[0] + "\n")
    target = str(tmp_path / "t")
    for location in (dataset.location, str(clean)):
        result = load_dataset(spark, Dataset("things", location, FIELDS), target, str(tmp_path / "r"))
    assert (result.rows, result.rejected, result.rejects_path) == (1, 0, None)


def test_round_trip_with_tabs(spark, tmp_path):
    rows = spark.range(50).selectExpr("cast(id as int) id", "if(id % 7 = 0, null, concat('n|', id)) name")
    lines = rows.selectExpr("concat_ws('\t', id, coalesce(name, '')) AS value")
    lines.write.text(str(tmp_path / "text"))
    dataset = Dataset("t", str(tmp_path / "text"), (Field("id", "int"), Field("name", "string")), "\t")
    load_dataset(spark, dataset, str(tmp_path / "t"))
    loaded = open_loaded(spark, dataset, str(tmp_path / "t"))
    assert sorted(loaded.collect(), key=lambda r: r.id) == sorted(rows.collect(), key=lambda r: r.id)


def test_fields_named_like_reject_columns(spark, tmp_path):
    (tmp_path / "x.txt").write_text("1|a b\nx|c\n")
    dataset = Dataset("t", str(tmp_path / "x.txt"), (Field("line", "int"), Field("reason", "string")))
    result = load_dataset(spark, dataset, str(tmp_path / "t"), str(tmp_path / "r"))
    assert open_loaded(spark, dataset, result.path).collect() == [(1, "a b")]
    assert [tuple(r)[::2] for r in spark.read.parquet(result.rejects_path).collect()] == [("x|c", "TYPE:line")]


def test_a_clean_reload_leaves_no_old_rejects(spark, tmp_path):
    dataset = Dataset("t", str(tmp_path / "x.txt"), (Field("id", "int"), Field("name", "string")))
    for text, rejected in (("1|a\nx|c\n", 1), ("1|a\n2|b\n", 0)):
        (tmp_path / "x.txt").write_text(text)
        result = load_dataset(spark, dataset, str(tmp_path / "t"), str(tmp_path / "r"))
        assert result.rejected == rejected
        assert spark.read.parquet(str(tmp_path / "r")).count() == rejected


def test_unknown_dataset():
    datasets = sample_datasets("/data")
    assert dataset_for(datasets, "SALES").sep == "\t"
    with pytest.raises(UnknownDataset, match="the file map has no entry for orders"):
        dataset_for(datasets, "orders")


def test_sample_tables_declare_their_columns():
    datasets = sample_datasets("/data/")
    widths = {name: len(d.fields) for name, d in datasets.items()}
    assert widths == {
        "users": 18, "venue": 5, "category": 4, "date": 8, "event": 6, "listing": 8, "sales": 10,
    }
    assert datasets["users"].fields[1] == Field("username", "string", False, 8)
    assert datasets["listing"].schema["totalprice"].dataType.simpleString() == "decimal(8,2)"
    assert datasets["date"].fields[2].required
