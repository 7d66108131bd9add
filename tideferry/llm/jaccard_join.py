"""Near copies of documents: an exact Jaccard join of their sets of word shingles.

Prefix filter with adaptive length. Shingles have one order for the whole
corpus, frequent ones last. Two similar sets must share at least ``l`` shingles
among the first ones of both, and these prefixes grow by one with ``l``. Every
document chooses its own ``l``: a longer prefix where its next shingles are
rare, so that many candidates fall to the stricter count, a short one where
reading their lists costs more than it saves. The larger set of a pair is read
to its probing prefix, the smaller to its shorter indexing prefix.

Equal sets are one node. ``pairs`` and ``counted`` run this join over all nodes
and return every link; a cluster of n nodes has up to n squared of them. For
components (``grouped``, ``report``) only connections matter, so there lists of
nodes that share a shingle are not expanded into pairs at once: first every node meets the most
central node of its lists, the one with the fewest rarer shingles. What that
connects is merged, lists inside one component are dropped, and only pairs of
different components are looked for in the rest, all of them. Before sets are
compared, a parity sketch gives a bound on what they share; no pair is lost to
it. Shingles and sets are told apart by 64-bit hashes.

Defined results: texts of fewer words than a shingle are one shingle; empty and
null texts have none, link with nothing and are their own component. Equal rows
are in one component. A component's id is the smallest id it holds, null if it
holds none. An empty table gives an empty result. Only ``doc_id`` and ``text``
are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideferry.llm.components import components
from tideferry.llm.hashing import BASE, Powers, mixed, word_hashes
from tideferry.llm.joins import with_index
from tideferry.llm.words import PLAIN_WORD, id_and_text, parts, sql_words, texts
from tideferry.sources.shared import scratch_path

WORDS = 5
PERCENT = 80

# Counts are kept for so many groups of shingles; the order needs no more.
COUNTERS = 1 << 17
LONGEST = 4
SKETCH_BITS = 1024
PART_BYTES = 2 << 20

# Bits that find the rows of wanted documents: so many for each, in groups as `bitmap_construct_agg` makes them, 8 MB at most.
BITS_EACH = 64
GROUP_BITS = 1 << 15
MOST_GROUPS = 1 << 11

_MULTIPLIER = np.uint64(BASE)


class _Shingler:
    """Texts to sorted distinct 64-bit shingles."""

    def __init__(self) -> None:
        self.powers = Powers()

    def __call__(self, found: list[bytes]) -> Iterator[np.ndarray]:
        for hashed in word_hashes([text.lower() for text in found], self.powers):
            width = min(WORDS, len(hashed))
            total = np.full(len(hashed) - width + (width > 0), width, dtype=np.uint64)
            for place in range(width):
                total = (total ^ (total >> np.uint64(29))) * _MULTIPLIER + hashed[place : len(hashed) - width + 1 + place]
            yield np.unique(mixed(total * _MULTIPLIER).view(np.int64))


def _needed(size: int) -> int:
    """Shingles a set must share with a smaller one."""
    return -(-PERCENT * size // 100)


def _indexed(size: int) -> int:
    """Shingles a set must share with one at least as large."""
    return -(-2 * PERCENT * size // (100 + PERCENT))


def _shared(one: str, other: str) -> Column:
    """Shingles two sets of these sizes must share."""
    return F.expr(f"ceil({PERCENT} * ({one} + {other}) / {100 + PERCENT})")


def _counters(docs: DataFrame) -> np.ndarray:
    """How many shingles of all documents fall to each counter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, total = _Shingler(), np.zeros(COUNTERS, dtype=np.int64)
        for part in parts(batches, most=PART_BYTES):
            for held in shingles(texts(part)):
                np.add.at(total, held & (COUNTERS - 1), 1)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"counter": pa.array(held, pa.int64()), "n": pa.array(total[held], pa.int64())})

    rows = docs.select("text").mapInArrow(count, "counter bigint, n bigint").groupBy("counter").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(COUNTERS, dtype=np.int64)
    for row in rows:
        total[row.counter] = row.n
    return total


class _Order:
    """The corpus order of shingles: how far their counter exceeds an ordinary one, then their hash."""

    def __init__(self, counters: np.ndarray):
        mean = counters.mean()
        self.excess = np.maximum(counters - mean - 3 * mean**0.5, 1.0)
        self.rank = np.floor(np.log2(self.excess)).astype(np.int8)

    def prefix(self, shingles: np.ndarray) -> tuple[int, np.ndarray]:
        """A set's own ``l``, and the shingles of its probing prefix in order."""
        size = len(shingles)
        counter = shingles & (COUNTERS - 1)
        order = np.lexsort((shingles, self.rank[counter]))
        shortest = size - _needed(size) + 1
        longest = min(size, shortest + LONGEST - 1)
        # Cost of a prefix: the lists it reads, and comparing what it finds often enough.
        lists = np.cumsum(self.excess[counter[order[:longest]]])[shortest - 1 :]
        cost = lists + lists / np.arange(1, len(lists) + 1) * np.log2(size + 1)
        chosen = int(cost.argmin()) + 1
        return chosen, shingles[order[: shortest + chosen - 1]]


def _sketch(shingles: np.ndarray) -> bytes:
    """One parity bit per group of shingles: two sketches differ in no more bits than the sets in shingles."""
    odd = np.bincount((shingles >> 40) & (SKETCH_BITS - 1), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


_PREFIXES = "doc_id bigint, digest bigint, node bigint, size bigint, chosen bigint, sketch binary, prefix array<bigint>"


def _prefixes(docs: DataFrame) -> DataFrame:
    """Every document's node, set size, sketch and prefix, as a table."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(_Order(_counters(docs)))  # COUNTERS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, order = _Shingler(), sent.value
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
        for part in parts(batches, most=PART_BYTES):
            rows = []
            for held in shingles(texts(part)):
                node = int(np.uint64(xxhash.xxh3_64_intdigest(held.tobytes())).view(np.int64)) if len(held) else 0
                chosen, prefix = order.prefix(held) if len(held) else (1, held)
                rows.append((node, len(held), chosen, _sketch(held), prefix))
            columns = (pa.array(list(c), k) for c, k in zip(zip(*rows), kinds))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("digest"), *columns], names=[f.split()[0] for f in _PREFIXES.split(", ")])

    path = scratch_path(spark, "prefixes")
    docs.select("doc_id", F.xxhash64("text").alias("digest"), "text").mapInArrow(run, _PREFIXES).write.parquet(path)
    return spark.read.schema(_PREFIXES).parquet(path)


def _lists(prefixes: DataFrame) -> DataFrame:
    """Nodes by the shingles of their prefixes: lists that can hold a pair, each node once.

    Every shingle of every prefix moves here, once: what is asked of a whole list is
    asked of a window over it. All that follows from a row itself is computed behind the move.
    """
    rows = prefixes.filter("size > 0").select("node", "size", "chosen", F.posexplode("prefix").alias("place", "shingle")).repartition("shingle")
    indexed = F.expr(f"place < size - cast(ceil({2 * PERCENT} * size / {100 + PERCENT}) as bigint) + chosen")
    rows = rows.select("shingle", "node", "size", "chosen", "place", indexed.alias("indexed"))
    whole = Window.partitionBy("shingle")
    least = F.min(F.when(F.col("indexed"), F.col("size"))).over(whole)
    rows = rows.select("*", F.min("node").over(whole).alias("low"), F.max("node").over(whole).alias("high"), least.alias("least")).filter("low <> high")
    # The least any smaller partner in the list asks for; the first LONGEST common shingles of a similar pair keep to it.
    floor = _shared("size", f"greatest(least, cast(ceil({PERCENT} * size / 100) as bigint))")
    probing = (F.col("least") <= F.col("size")) & (F.col("size") - F.col("place") + LONGEST - 1 >= floor)
    return rows.filter(F.col("indexed") | probing).drop("low", "high", "least").distinct()


def _postings(prefixes: DataFrame) -> DataFrame:
    """The lists as a table."""
    spark = prefixes.sparkSession
    path = scratch_path(spark, "postings")
    _lists(prefixes).write.parquet(path)
    return spark.read.parquet(path)


def _fitting(one: str, other: str) -> Column:
    """Whether two postings' sizes, and what can follow their common shingle, allow a similar pair."""
    sizes = f"least(size_{one}, size_{other}) * 100 >= greatest(size_{one}, size_{other}) * {PERCENT}"
    follow = F.least(F.expr(f"size_{one} - place_{one}"), F.expr(f"size_{other} - place_{other}"))
    return F.expr(sizes) & (follow + LONGEST - 1 >= _shared(f"size_{one}", f"size_{other}"))


def _renamed(rows: DataFrame, suffix: str) -> DataFrame:
    return rows.select("shingle", *(F.col(c).alias(f"{c}_{suffix}") for c in rows.columns if c != "shingle"))


def _with_central(postings: DataFrame) -> DataFrame:
    """Pairs of nodes with the central node of their lists: the one with the fewest rarer shingles."""
    central = postings.filter("indexed").groupBy("shingle").agg(F.min(F.struct("place", "size", "node")).alias("c"))
    central = central.select("shingle", F.col("c.node").alias("node_b"), F.col("c.size").alias("size_b"), F.col("c.place").alias("place_b"))
    rows = _renamed(postings.select("shingle", "node", "size", "place"), "a").join(central, "shingle")
    rows = rows.filter((F.col("node_a") != F.col("node_b")) & _fitting("a", "b"))
    return rows.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), "size_a", "size_b").distinct()


def _across(postings: DataFrame, labels: DataFrame) -> DataFrame:
    """All candidate pairs of different components."""
    rows = postings.join(labels.withColumnRenamed("root", "label"), "node", "left").withColumn("label", F.coalesce("label", "node"))
    open_ = rows.groupBy("shingle").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
    return _candidates(rows.join(open_.select("shingle"), "shingle", "left_semi"), F.col("label_a") != F.col("label_b"))


def _candidates(rows: DataFrame, wanted: Column) -> DataFrame:
    """Pairs with enough common shingles in their prefixes, the larger set probing, the smaller indexed."""
    ahead = F.expr("size_a > size_b OR (size_a = size_b AND node_a > node_b)")
    pairs = _renamed(rows, "a").join(_renamed(rows.filter("indexed"), "b"), "shingle").filter(ahead & wanted & _fitting("a", "b"))
    pairs = pairs.groupBy("node_a", "node_b", "size_a", "size_b").agg(
        F.count(F.lit(1)).alias("common"), F.min("chosen_a").alias("chosen_a"), F.min("chosen_b").alias("chosen_b"), F.min("place_a").alias("place_a"), F.min("place_b").alias("place_b")
    )
    follow = F.least(F.expr("size_a - place_a"), F.expr("size_b - place_b"))
    pairs = pairs.filter((F.col("common") >= F.least("chosen_a", "chosen_b")) & (follow >= _shared("size_a", "size_b")))
    return pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), "size_a", "size_b")


def _possible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs whose sketches allow them to be similar, with the bits in which they differ."""
    own = nodes.select("node", "sketch")
    pairs = pairs.join(own.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a")), "a")
    pairs = pairs.join(own.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b")), "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketches = [np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(-1, SKETCH_BITS // 8) for c in ("sketch_a", "sketch_b")]
            apart = np.unpackbits(sketches[0] ^ sketches[1], axis=1).sum(axis=1, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("a", "b", "size_a", "size_b")), pa.array(apart)], names=["a", "b", "size_a", "size_b", "apart"])

    rows = pairs.select("a", "b", "size_a", "size_b", "sketch_a", "sketch_b").mapInArrow(compare, "a bigint, b bigint, size_a bigint, size_b bigint, apart bigint")
    return rows.filter((F.col("size_a") + F.col("size_b") - F.col("apart")) / 2 >= _shared("size_a", "size_b"))


def _possibly(rows: DataFrame, wanted: DataFrame, keys: list[str], n_wanted: int) -> DataFrame:
    """All rows whose keys are wanted, and few others, without moving any: a join must follow.

    Every wanted key sets one bit; there are ``BITS_EACH`` for each of them, at most
    ``MOST_GROUPS`` groups. Beyond that more rows pass in vain, up to all of them.
    """
    n_groups = max(1, min(MOST_GROUPS, -(-BITS_EACH * n_wanted // GROUP_BITS)))
    at = F.pmod(F.xxhash64(*keys), F.lit(n_groups * GROUP_BITS))
    place = [F.floor(at / GROUP_BITS).alias("_group"), F.pmod(at, F.lit(GROUP_BITS)).alias("_bit")]
    bits = wanted.select(*place).groupBy("_group").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    byte = "cast(conv(hex(substring(_bits, cast(_bit div 8 as int) + 1, 1)), 16, 10) as int)"
    rows = rows.select("*", *place).join(F.broadcast(bits), "_group")
    return rows.filter(F.expr(f"getbit({byte}, cast(_bit % 8 as int)) = 1")).drop("_group", "_bit", "_bits")


def _linked(pairs: DataFrame, docs: DataFrame, members: DataFrame) -> DataFrame:
    """The pairs that are similar: their sets are made again from one document of each node and compared."""
    spark = docs.sparkSession
    path = scratch_path(spark, "pairs")
    pairs.select("a", "b").write.parquet(path)
    pairs = spark.read.schema("a bigint, b bigint").parquet(path)
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    # One document of a node is enough; its id and its text's digest find it.
    chosen = members.groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest")).alias("of")).join(wanted, "node")
    chosen = chosen.select("node", F.coalesce("of.doc_id", F.lit(-1)).alias("doc_id"), F.col("of.digest").alias("digest"))

    # Texts move, as they are shorter than their shingles, and only those of the pairs.
    rows = docs.select(F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), F.xxhash64("text").alias("digest"), "text")
    rows = _possibly(rows, chosen, ["doc_id", "digest"], 2 * pairs.count()).join(chosen, ["doc_id", "digest"])
    # Equal rows give equal sets; one of them is enough.
    held = rows.select("node", "text").dropDuplicates(["node"])

    def longer(batch: pa.RecordBatch) -> pa.Array:
        one, other = batch.column("text_a"), batch.column("text_b")
        return pc.if_else(pc.greater(pc.binary_length(one), pc.binary_length(other)), one, other)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = _Shingler()
        for part in parts(batches, longer, PART_BYTES):
            nodes = [part.column(c).to_pylist() for c in "ab"]
            found = dict(zip(nodes[0] + nodes[1], texts(part, "text_a") + texts(part, "text_b")))
            sets = dict(zip(found, shingles(list(found.values()))))
            similar = []
            for one, other in zip(*nodes):
                one, other = sets[one], sets[other]
                common = len(np.intersect1d(one, other, assume_unique=True))
                similar.append(100 * common >= PERCENT * (len(one) + len(other) - common))
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], names=["a", "b"]).filter(pa.array(similar, pa.bool_()))

    pairs = pairs.join(held.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    pairs = pairs.join(held.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    path = scratch_path(spark, "links")
    pairs.select("a", "b", "text_a", "text_b").mapInArrow(compare, "a bigint, b bigint").write.parquet(path)
    return spark.read.schema("a bigint, b bigint").parquet(path)


def _all_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents with their nodes, and all links between nodes, each once."""
    docs = id_and_text(docs)
    prefixes = _prefixes(docs)
    members = prefixes.select("doc_id", "digest", "node", "size")
    nodes = prefixes.filter("size > 0").groupBy("node").agg(F.min("sketch").alias("sketch"))
    return members, _linked(_possible(_candidates(_postings(prefixes), F.lit(True)), nodes), docs, members)


def pairs(docs: DataFrame) -> DataFrame:
    """All links between different sets, each once: the smallest ids that hold them (null if none does), the smaller one first.

    Documents with equal sets are linked by that alone and share the links of their set.
    """
    members, links = _all_links(docs)
    ids = members.filter("size > 0").groupBy("node").agg(F.min("doc_id").alias("id"))
    for side in "ab":
        links = links.join(ids.withColumnsRenamed({"node": side, "id": f"id_{side}"}), side)
    ahead = F.expr("id_b IS NULL OR id_a < id_b")
    return links.select(F.when(ahead, F.col("id_a")).otherwise(F.col("id_b")).alias("doc_id"), F.when(ahead, F.col("id_b")).otherwise(F.col("id_a")).alias("other_id"))


def counted(docs: DataFrame) -> DataFrame:
    """One row per document: its set size, and the number of other sets that its set is linked with."""
    members, links = _all_links(docs)
    per_node = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    n_links = F.when(F.col("size") > 0, F.coalesce("n", F.lit(0))).otherwise(0).cast("bigint")
    return members.join(per_node, "node", "left").select("doc_id", F.col("size").alias("n_shingles"), n_links.alias("n_links"))


def grouped(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, digest of its text, n_shingles, component_id, and the component's root, null for empty sets."""
    docs = id_and_text(docs)
    prefixes = _prefixes(docs)
    members = prefixes.select("doc_id", "digest", "node", "size")
    nodes = prefixes.filter("size > 0").groupBy("node").agg(F.min("sketch").alias("sketch"))
    postings = _postings(prefixes)

    # One partner is enough to join a cluster: the central node that differs in the fewest bits.
    near = _possible(_with_central(postings), nodes).groupBy("a").agg(F.min(F.struct("apart", "b")).alias("best"))
    links = _linked(near.select("a", F.col("best.b").alias("b")), docs, members)
    labels = components(links)
    more = _linked(_possible(_across(postings, labels), nodes), docs, members)
    labels = components(labels.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))

    rows = members.join(labels, "node", "left").withColumn("root", F.when(F.col("size") > 0, F.coalesce("root", "node")))
    ids = rows.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least"))
    rows = with_index(rows, ids, "root", "left")
    component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return rows.select("doc_id", "digest", "root", F.col("size").alias("n_shingles"), component.alias("component_id"))


def report(docs: DataFrame) -> DataFrame:
    return grouped(docs).select("doc_id", "n_shingles", "component_id")


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per component, that of its smallest id; empty texts are components of their own.

    Of equal rows one stays, also of equal empty ones.
    """
    rows = grouped(docs)
    alone = F.when(F.col("root").isNull(), F.struct("doc_id", "digest"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest"))
    kept = rows.groupBy("root", alone.alias("alone")).agg(first.alias("first")).select("first.*").distinct()
    kept = kept.select(F.coalesce("doc_id", F.lit(0)).alias("kept_id"), "no_id", F.col("digest").alias("kept_digest"))
    own = docs.select(F.struct("*").alias("row")).select(
        "row", F.coalesce(F.col("row.doc_id").cast("bigint"), F.lit(0)).alias("kept_id"), F.col("row.doc_id").isNull().alias("no_id"), F.xxhash64(F.col("row.text").cast("string")).alias("kept_digest")
    )
    keys = ["kept_id", "no_id", "kept_digest"]
    return own.join(kept, keys, "left_semi").dropDuplicates(keys).select("row.*")


def sql(documents: str) -> str:
    """Every document's set size and component in DuckDB, by comparing all sets that share a shingle."""
    return f"""
    WITH RECURSIVE read AS (SELECT doc_id, {sql_words("text", PLAIN_WORD, lower=True)} AS words FROM ({documents}) AS source),
    sets AS MATERIALIZED (
        SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < {WORDS} THEN [array_to_string(words, ' ')]
               ELSE list_distinct(list_transform(range(1, len(words) - {WORDS - 2}), lambda i: array_to_string(list_slice(words, i, i + {WORDS - 1}), ' '))) END AS shingles
        FROM read),
    postings AS MATERIALIZED (SELECT doc_id, len(shingles) AS size, unnest(shingles) AS shingle FROM sets),
    links AS MATERIALIZED (
        SELECT a.doc_id AS a, b.doc_id AS b FROM postings AS a JOIN postings AS b USING (shingle) WHERE a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.size, b.size HAVING 100 * count(*) >= {PERCENT} * (a.size + b.size - count(*))),
    reached AS (SELECT doc_id, doc_id AS other FROM sets UNION SELECT r.doc_id, l.b FROM reached AS r JOIN links AS l ON l.a = r.other)
    SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, least_id AS component_id
    FROM sets JOIN (SELECT doc_id, min(other) AS least_id FROM reached GROUP BY doc_id) AS r USING (doc_id)"""


QUERY_SQL = sql("SELECT * FROM documents")
