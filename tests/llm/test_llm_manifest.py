"""The manifest's digests against plain Python, its proofs against a plain verifier, and its edge cases."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tideferry.llm import merkle_manifest
from tideferry.llm.ordering import sorted_rows

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, number string, tree string, id string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return h(*["-" if v is None else f"{len(v.encode())}:{v}" for v in values])


def tree(digests):
    """The levels of one tree, lowest first."""
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i : i + 3]) for i in range(0, len(below), 3)])
    return levels


def climb(levels, place, digest):
    """The siblings on the way up, and what the digest folds to."""
    siblings = []
    for level in levels[:-1]:
        run = level[place - place % 3 : place - place % 3 + 3]
        siblings += run[: place % 3] + run[place % 3 + 1 :]
        digest = h(*run[: place % 3], digest, *run[place % 3 + 1 :])
        place //= 3
    return siblings, digest


def plain(rows):
    """The whole manifest, row by row."""
    sources = {}
    for row in rows:
        sources.setdefault(row[1], []).append(row)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        sources[source].sort(key=lambda row: (row[0] is not None, row[0] or 0, leaf(*row)))
        trees[source] = tree([leaf(*row) for row in sources[source]])
    top = tree([trees[source][-1][0] for source in order])
    found = []
    for ordinal, source in enumerate(order):
        for place, row in enumerate(sources[source]):
            changed = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                changed = (*row[:4], row[4].replace("\n", ""))
            low, subroot = climb(trees[source], place, leaf(*changed))
            high, root = climb(top, ordinal, subroot)
            found.append((row[0], leaf(*row), trees[source][-1][0], top[-1][0], h(*low, *high), root, root == top[-1][0]))
    return sorted(found, key=str)


def rows_of(frame):
    return sorted((tuple(row) for row in frame.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*row, "clash", "clash", "clash") for row in rows], SCHEMA).repartition(parts)


EDGES = [
    (1, "a", "en", 5, "one\ntwo"),
    (1, "a", "en", 5, "one\ntwo"),
    (1, "a", "fr", None, "other"),
    (None, "a", None, None, None),
    (None, None, None, None, "no id\nbut lines"),
    (3, None, "en", 0, ""),
    (2, "é", "en", 1, "é\n" * 50_000),
    (4, "Z", "en", 1, None),
    (5, "", "", 1, "\n"),
    (-6, "\U0001f600", "en", -1, "below zero\n"),
]


def test_edges_equal_plain_python(spark):
    assert rows_of(merkle_manifest.report(table(spark, EDGES))) == plain(EDGES)


@pytest.mark.parametrize("sizes", [(1,), (2,), (3,), (4,), (1, 1), (28, 1, 9), (10, 3, 1, 81, 2)])
def test_all_shapes_of_trees(spark, sizes):
    rows = [(100 * s + i, f"src{s}", "en", i, f"text {i}\nof {s}") for s, size in enumerate(sizes) for i in range(size)]
    assert rows_of(merkle_manifest.report(table(spark, rows, 5))) == plain(rows)


def test_one_source_over_many_parts(spark):
    rows = [(i, "hot" if i % 3 else f"s{i % 9}", "en", i, f"{i}\n") for i in range(700)]
    assert rows_of(merkle_manifest.report(table(spark, rows, 16))) == plain(rows)


def test_untampered_rows_all_verify(spark):
    found = merkle_manifest.manifest(table(spark, EDGES)).collect()
    assert len(found) == len(EDGES) and all(row.verified for row in found)


def test_any_change_is_found(spark):
    changed = F.when(F.col("doc_id") == 2, F.concat("text", F.lit(" ")))
    found = {(row.doc_id, row.verified) for row in merkle_manifest.manifest(table(spark, EDGES), changed).collect()}
    assert (2, False) in found and all(verified for doc_id, verified in found if doc_id != 2)


def test_empty_table(spark):
    empty = table(spark, [])
    assert merkle_manifest.report(empty).collect() == []
    assert merkle_manifest.report(empty).columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_the_row_limit_of_the_session_stays(spark):
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name)
    merkle_manifest.report(table(spark, EDGES[:2]))
    assert spark.conf.get(name) == before


def test_sorted_rows_are_numbered_in_order(spark):
    rows = sorted_rows(spark.range(1000).repartition(7).select((F.col("id") * 7919 % 1000).alias("x")), ["x"])
    found = [row.x for row in rows.orderBy("id").collect()]
    assert found == sorted(found) and len(found) == 1000
    for part in rows.groupBy("part").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count(F.lit(1)).alias("n")).collect():
        assert part.b - part.a + 1 == part.n and part.a == part.part << 33
