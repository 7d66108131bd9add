"""Small splits of large files are read by few tasks, and every line keeps its split and its number."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from tideferry.operators import load
from tideferry.operators.load import load_into, rejected_lines
from tideferry.queries import files
from tideferry.session import settings
from tideferry.sources.delimited import Dataset, Field

SMALL = {"spark.sql.files.maxPartitionBytes": "7k", "spark.sql.files.openCostInBytes": "0"}


def test_reject_lines_of_many_splits(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "scratch_path", lambda spark, name: str(tmp_path / name))
    rows = spark.range(120_000).selectExpr(
        "id DIV 4 AS l_orderkey", "cast(id % 4 AS int) AS l_linenumber", "id % 77 AS l_partkey", "id % 7 AS l_suppkey",
        "if(id % 101 = 0, null, cast(id % 50 + 1 AS double)) AS l_quantity",
    )
    rows = rows.unionByName(rows.limit(500))
    rows.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    with settings(spark, {"spark.sql.shuffle.partitions": "8"}):
        found = files.delimited_reject_lines(spark, str(tmp_path))
    table = tmp_path / "numbered" / "table"
    splits = spark.read.parquet(str(table)).select("_source_file", "_split_start").distinct().collect()
    # Each file is cut at every 16 KB, and none of the cuts has a task of its own.
    sizes = {path.name: path.stat().st_size for path in (tmp_path / "numbered" / "text").glob("part-*")}
    assert len(sizes) == 3 and sum(sizes.values()) > 64 * 16384
    cuts = {(name, start) for name, size in sizes.items() for start in range(0, size, 16384)}
    starts = {(Path(row._source_file).name, row._split_start) for row in splits}
    assert starts <= cuts and len(starts) >= len(cuts) - len(sizes)
    tasks = max(4 * spark.sparkContext.defaultParallelism, 8)
    for part in (load.GOOD, load.BAD):
        assert len(list((table / part).glob("*.parquet"))) <= tasks + 8 < len(cuts)
    expected = rows.filter("l_quantity >= 45").select("l_orderkey", F.lit("TYPE:number"), F.lit(True), F.lit(True))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))


def test_line_numbers_when_a_task_reads_many_splits(spark, tmp_path):
    folder, expected = tmp_path / "text", set()
    folder.mkdir()
    for file, lines in (("a.txt", 9000), ("b.txt", 1), ("c.txt", 4000)):
        bad = {n for n in range(1, lines + 1) if n % 97 == 0 or n in (1, lines)}
        (folder / file).write_text("\n".join(f"{'x' if n in bad else n}|{'é' * (n % 50)}" for n in range(1, lines + 1)), encoding="utf-8")
        expected |= {(file, n) for n in bad}
    dataset = Dataset("t", str(folder), (Field("id", "int", required=True), Field("name", "string")))
    load_into(spark, dataset, str(tmp_path / "t"), SMALL | {"spark.sql.files.maxPartitionNum": "3"})
    rows = spark.read.parquet(str(tmp_path / "t"))
    assert rows.select("_source_file", "_split_start").distinct().count() > 30
    assert len(list((tmp_path / "t" / load.GOOD).glob("*.parquet"))) <= 6
    found = {(Path(row.source_file).name, row.line_number) for row in rejected_lines(spark, str(tmp_path / "t")).collect()}
    assert found == expected


def test_settings_for_the_text_are_for_the_text_alone(spark, tmp_path, monkeypatch):
    (tmp_path / "x.txt").write_text("1|a\nx|b\n" * 1000)
    seen, opened = [], load.open_loaded

    def watched(*args):
        seen.append({name: spark.conf.get(name) for name in SMALL})
        return opened(*args)

    monkeypatch.setattr(load, "open_loaded", watched)
    before = {name: spark.conf.get(name) for name in SMALL}
    dataset = Dataset("t", str(tmp_path / "x.txt"), (Field("id", "int"), Field("name", "string")))
    result = load_into(spark, dataset, str(tmp_path / "t"), SMALL)
    assert (result.lines, result.rows, result.rejected) == (2000, 1000, 1000)
    assert spark.read.parquet(str(tmp_path / "t")).select("_split_start").distinct().count() > 1
    assert seen == [before] and {name: spark.conf.get(name) for name in SMALL} == before
