"""Merkle manifest of a table: a digest tree per source, one over the sources, and a proof for every row.

A row's leaf is the digest of its fields. The leaves of a source, in the order
of their ids, are taken in runs of ``ARITY``; each run's digest is a node, and
so on until one is left, the source's subroot. The subroots, in the order of
their sources, make the root the same way.

Built levels are stored as node rows, linked to their parents: the digests
below a node, its parent, and its place there. Positions say everything about
a tree's shape, so links are arithmetic and a level is one grouping of the
level below. A recursive query then climbs from every leaf at once: each step
joins the node above, folds the tampered digest in its place and appends a row
with the siblings met there; the rows of a leaf, in order, are its proof. A
step carries one digest per leaf, however long the proof is. A node has at most
``ARITY`` children, so no key of any join is hot, whatever the sources' sizes.

Defined results: null fields are a dash; a null source is a source, the first.
Rows without an id come first in their source, and are not tampered with. Rows
that agree in source and id are ordered by their digests. A single leaf is its
source's subroot, a single source's subroot the root; their proofs are empty.
Texts of any length are hashed whole. An empty table has no rows. Only the five
fields are read, whatever else the table holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideferry.llm.checksums import sql_crc32
from tideferry.llm.ordering import sorted_rows
from tideferry.sources.shared import scratch_path

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3

# A node's number is 64 times the first leaf below it, plus its height; the heights of the tree over the sources begin at TOP.
HEIGHTS = 64
TOP = 32
DIGEST_BYTES = 32


def _field(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def _leaf(text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[_field(text if name == "text" else F.col(name)) for name in FIELDS]), 256))


def tampered_text() -> Column:
    """The text without its line feeds where the id's checksum is even, else null."""
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return F.when(even & F.contains("text", F.lit("\n")), F.replace("text", F.lit("\n"), F.lit("")))


def leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """doc_id, source and leaf of every row, and the leaf of its tampered text, null where ``tampered`` is null."""
    kinds = {"doc_id": "bigint", "n_chars": "bigint"}
    fields = docs.select(*[F.col(name).cast(kinds.get(name, "string")).alias(name) for name in FIELDS])
    changed = F.lit(None).cast("string") if tampered is None else tampered
    fields = fields.withColumn("_changed", changed)
    other = F.when(F.col("_changed").isNotNull(), _leaf(F.col("_changed")))
    return fields.select("doc_id", "source", _leaf(F.col("text")).alias("leaf"), other.alias("tampered"))


def _placed(rows: DataFrame) -> DataFrame:
    """Every leaf's number over all, its source's ordinal, first number and size, and its position there.

    Rows arrive sorted and numbered part by part. A source is a run of rows in
    one part or in several; the runs, not the rows, are put in order.
    """
    start = F.shiftleft("part", 33)
    runs = rows.groupBy("part", "source").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = runs.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    of_source = Window.partitionBy("source")
    runs = runs.join(parts, "part").withColumn("first", F.col("before") + F.col("low") - start)
    runs = runs.select("part", "source", "before", "first", F.min("first").over(of_source).alias("base"), F.sum("n").over(of_source).alias("size"))
    # A source is counted in the part where it begins.
    heads = runs.filter(F.col("first") == F.col("base"))
    counts = heads.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("sources"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy("base")) - 1
    heads = heads.select("part", "base", rank.alias("rank")).join(counts, "part")
    heads = heads.select("base", (F.col("sources") + F.col("rank")).alias("tree"))
    runs = runs.join(heads, "base").withColumnRenamed("part", "run_part").withColumnRenamed("source", "run_source")
    rows = rows.join(runs, (F.col("part") == F.col("run_part")) & F.col("source").eqNullSafe(F.col("run_source")))
    number = F.col("before") + F.col("id") - start
    return rows.select(number.alias("number"), "doc_id", "leaf", "tampered", "tree", "base", "size", (number - F.col("base")).alias("position"))


def _linked(rows: DataFrame, height: int, top: int, trees: int, arity: int) -> DataFrame:
    """Parent and place of nodes at a height of their tree; ``size`` is the number of nodes there."""
    above = (F.col("base") + F.expr(f"position div {arity}") * F.lit(arity ** (height + 1))) * HEIGHTS + height + 1 + top
    parent, place = F.when(F.col("size") > 1, above), F.when(F.col("size") > 1, F.col("position") % arity)
    if not top and trees > 1:
        over = F.expr(f"tree div {arity}") * (arity * HEIGHTS) + TOP + 1
        parent, place = parent.otherwise(over), place.otherwise(F.col("tree") % arity)
    return rows.withColumn("parent", parent.cast("bigint")).withColumn("place", place.cast("int"))


class Levels:
    """Stored levels of the trees: node rows by height, and the last digest of every tree."""

    def __init__(self, spark: SparkSession, path: str, trees: int, arity: int) -> None:
        self.spark, self.path, self.trees, self.arity = spark, path, trees, arity
        self.heights: list[str] = []

    def build(self, rows: DataFrame, largest: int, top: int = 0) -> DataFrame:
        """Store all levels above ``rows`` (tree, base, size, position, digest); returns tree and digest of the trees' ends."""
        ends = [rows.filter("size = 1").select("tree", "digest")]
        height, arity = 0, self.arity
        while largest > 1:
            member = F.struct((F.col("position") % arity).alias("place"), "digest")
            joined = F.array_join(F.transform(F.sort_array(F.collect_list(member)), lambda x: F.lower(F.hex(x["digest"]))), "")
            runs = rows.filter("size > 1").groupBy("tree", "base", "size", F.expr(f"position div {arity}").alias("run")).agg(joined.alias("below"))
            node = (F.col("base") + F.col("run") * F.lit(arity ** (height + 1))) * HEIGHTS + height + 1 + top
            runs = runs.select(
                node.alias("node"),
                F.unhex("below").alias("children"),
                F.unhex(F.sha2("below", 256)).alias("digest"),
                "tree",
                "base",
                F.expr(f"(size + {arity - 1}) div {arity}").alias("size"),
                F.col("run").alias("position"),
            )
            height, largest = height + 1, -(-largest // arity)
            folder = f"{self.path}/height={height + top}"
            _linked(runs, height, top, self.trees, arity).write.parquet(folder)
            self.heights.append(folder)
            rows = self.spark.read.parquet(folder)
            ends.append(rows.filter("size = 1").select("tree", "digest"))
        found = ends[0]
        for end in ends[1:]:
            found = found.unionByName(end)
        return found

    def nodes(self) -> DataFrame:
        if not self.heights:
            return self.spark.createDataFrame([], "node bigint, children binary, parent bigint, place int")
        return self.spark.read.schema("node bigint, children binary, parent bigint, place int").parquet(*self.heights)


@contextmanager
def _any_number_of_rows(spark: SparkSession) -> Iterator[None]:
    """A recursive query stops at a million rows unless told otherwise."""
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


# Each step adds, for every leaf that is not yet at the root, the row of the node above.
CLIMB = f"""
WITH RECURSIVE climb(number, step, node, place, folded, siblings, subroot) AS (
    SELECT number, 0, parent, place, start, X'', CAST(NULL AS BINARY) FROM {{leaves}}
    UNION ALL
    SELECT c.number, c.step + 1, n.parent, n.place,
           unhex(sha2(lower(hex(overlay(n.children PLACING c.folded FROM c.place * {DIGEST_BYTES} + 1 FOR {DIGEST_BYTES}))), 256)),
           concat(substring(n.children, 1, c.place * {DIGEST_BYTES}), substring(n.children, (c.place + 1) * {DIGEST_BYTES} + 1)),
           IF(n.node % {HEIGHTS} = {TOP + 1}, substring(n.children, c.place * {DIGEST_BYTES} + 1, {DIGEST_BYTES}), NULL)
    FROM climb AS c JOIN {{nodes}} AS n ON c.node = n.node
)
SELECT number, max_by(folded, step) AS folded, max(subroot) AS subroot,
       sha2(array_join(transform(sort_array(collect_list(struct(step, siblings))), s -> lower(hex(s.siblings))), ''), 256) AS proof
FROM (SELECT number, step, IF(node IS NULL, folded, NULL) AS folded, siblings, subroot FROM climb) AS steps GROUP BY number"""


def manifest(docs: DataFrame, tampered: Column | None = None, arity: int = ARITY) -> DataFrame:
    """Leaf, subroot, root and hashed proof of every row, and the root its tampered leaf folds to.

    ``tampered`` is an expression over the fields that yields a changed text,
    or null for a row that is left as it is.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "leaves")
    leaves(docs, tampered).write.parquet(path)
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), "leaf"]
    rows = sorted_rows(spark.read.parquet(path), order)

    path = scratch_path(spark, "placed-leaves")
    placed = _placed(rows)
    placed.write.parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path)
    shape = placed.agg(F.max("size").alias("largest"), F.max("tree").alias("last")).first()
    largest, trees = shape.largest or 0, (-1 if shape.last is None else shape.last) + 1

    levels = Levels(spark, scratch_path(spark, "levels"), trees, arity)
    ends = levels.build(placed.select("tree", "base", "size", "position", F.col("leaf").alias("digest")), largest)
    sources = ends.select(F.lit(0).alias("tree"), F.lit(0).cast("bigint").alias("base"), F.lit(trees).cast("bigint").alias("size"), F.col("tree").alias("position"), "digest")
    last = levels.build(sources, trees, TOP).select(F.lower(F.hex("digest")).alias("digest")).first()

    started = _linked(placed, 0, 0, trees, arity).select("number", "parent", "place", F.coalesce("tampered", "leaf").alias("start"))
    path = scratch_path(spark, "proofs")
    with _any_number_of_rows(spark):
        climbed = spark.sql(CLIMB, leaves=started, nodes=levels.nodes().select("node", "children", "parent", "place"))
        climbed.write.parquet(path)
    climbed = spark.read.schema(climbed.schema).parquet(path)

    root = F.lit(last.digest if last else None).cast("string")
    folded = F.lower(F.hex("folded"))
    return placed.join(climbed, "number").select(
        "doc_id",
        F.lower(F.hex("leaf")).alias("leaf"),
        F.coalesce(F.lower(F.hex("subroot")), root).alias("subroot"),
        root.alias("root"),
        F.col("proof").alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == root).alias("verified"),
    )


def report(docs: DataFrame) -> DataFrame:
    """The manifest of a table, checked against texts that lost their line feeds."""
    return manifest(docs, tampered_text())


def _sql_levels(name: str, start: str) -> str:
    """Recursive DuckDB levels over ``start`` (tree, size, position, digest); a level is one step."""
    return f"""{name} AS (
        SELECT tree, 0 AS height, size, position, digest FROM ({start}) AS start
        UNION ALL
        SELECT tree, height + 1, (size + {ARITY - 1}) // {ARITY}, position // {ARITY}, sha256(string_agg(digest, '' ORDER BY position))
        FROM {name} WHERE size > 1 GROUP BY tree, height, size, position // {ARITY})"""


def sql(documents: str) -> str:
    """The same manifest in DuckDB."""

    def leaf(text: str) -> str:
        values = [text if name == "text" else f"CAST({name} AS VARCHAR)" for name in FIELDS]
        return "sha256(" + " || ".join(f"coalesce(octet_length(encode({v})) || ':' || {v}, '-')" for v in values) + ")"

    subroots = "SELECT -1 AS tree, (SELECT count(*) FROM levels WHERE size = 1) AS size, tree AS position, digest FROM levels WHERE size = 1"
    return f"""
    WITH RECURSIVE source_rows AS (
        SELECT *, {sql_crc32("CAST(doc_id AS VARCHAR)")} % 2 = 0 AS even FROM ({documents}) AS source_rows),
    leaves AS MATERIALIZED (
        SELECT doc_id, source, {leaf("text")} AS leaf, CASE WHEN even THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS start
        FROM source_rows),
    placed AS MATERIALIZED (
        SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY source) AS size,
               row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS position
        FROM leaves),
    {_sql_levels("levels", "SELECT tree, size, position, leaf AS digest FROM placed")},
    {_sql_levels("over", subroots)},
    linked AS MATERIALIZED (
        SELECT *, CASE WHEN size > 1 THEN {{'t': tree, 'h': height + 1, 'p': position // {ARITY}}}
                       WHEN tree >= 0 AND (SELECT count(*) FROM over) > 1 THEN {{'t': -1, 'h': 1, 'p': tree // {ARITY}}} END AS above,
               CASE WHEN size > 1 THEN position ELSE tree END % {ARITY} + 1 AS place
        FROM (SELECT * FROM levels UNION ALL SELECT * FROM over WHERE height > 0) AS nodes),
    runs AS MATERIALIZED (
        SELECT below.above AS node, any_value(own.above) AS above, any_value(own.place) AS place, list(below.digest ORDER BY below.place) AS children
        FROM linked AS below JOIN linked AS own ON below.above = {{'t': own.tree, 'h': own.height, 'p': own.position}} GROUP BY below.above),
    climb AS (
        SELECT p.tree, p.position, l.above, l.place, p.start AS folded, '' AS siblings
        FROM placed AS p JOIN linked AS l ON l.tree = p.tree AND l.height = 0 AND l.position = p.position
        UNION ALL
        SELECT c.tree, c.position, r.above, r.place, sha256(array_to_string(list_transform(r.children, lambda x, i: CASE WHEN i = c.place THEN c.folded ELSE x END), '')),
               c.siblings || array_to_string(list_filter(r.children, lambda x, i: i <> c.place), '')
        FROM climb AS c JOIN runs AS r ON c.above = r.node)
    SELECT p.doc_id, p.leaf, s.digest AS subroot, t.digest AS root, sha256(c.siblings) AS proof_sha256, c.folded AS folded_root, c.folded = t.digest AS verified
    FROM placed AS p JOIN climb AS c ON c.tree = p.tree AND c.position = p.position AND c.above IS NULL
    JOIN levels AS s ON s.tree = p.tree AND s.size = 1 JOIN over AS t ON t.size = 1"""


QUERY_SQL = sql("SELECT * FROM documents")
