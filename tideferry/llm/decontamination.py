"""Benchmark passages in documents, found through suffix arrays.

Each batch of documents is a training shard: its words become numbers (words
no benchmark item uses are 0) and a suffix array. Every suffix of every
benchmark item is searched in it by binary search, which gives the longest
verbatim matches and their places. Matches of a whole window make hits.

Benchmark items are cut into pieces of bounded size, overlapping by a window
less one word, and dealt to blocks of bounded size. A block is sent to the
tasks, never the whole benchmark; documents meet the blocks one after another.
Matches that touch a piece's edge are kept, and joined with those of the pieces
beside it, so a match is as long as it is in the item. Suffixes that share a
range of the suffix array, as those of a common prompt do, are marked once.

Defined results: null texts have no words and no hits; items without words
match nothing; equal items each count; equal rows get equal results; null item
ids are listed by none. Texts and items of any length are read whole. Empty tables give empty or clean results. Only
``doc_id``, ``item_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideferry.llm.suffixes import search, suffix_array
from tideferry.llm.words import ITEM_WORD, item_words, parts, spans, sql_words
from tideferry.sources.shared import scratch_path

WINDOW = 10

# Words of a piece of an item, bytes of a block, and bytes of text of a training shard.
PIECE_WORDS = 4096
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 8 << 20

# Matches at edges that a shard gathers before it joins them.
_MANY_EDGES = 1 << 20


def _pieces(benchmark: DataFrame, window: int) -> DataFrame:
    """Items as pieces of at most ``PIECE_WORDS`` words that together hold all windows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, places, sources, pieces = [], [], [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                words = item_words(text or b"")
                source = int.from_bytes(hashlib.md5(text or b"").digest()[:7], "big")
                for begin in range(0, max(len(words) - window + 1, min(len(words), 1)), PIECE_WORDS - window + 1):
                    ids.append(item)
                    places.append(begin)
                    sources.append(source)
                    pieces.append(b" ".join(words[begin : begin + PIECE_WORDS]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(places, pa.int64()), pa.array(sources, pa.int64()), pa.array(pieces, pa.binary())], names=["item", "place", "source", "piece"])

    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    return items.mapInArrow(cut, "item string, place bigint, source bigint, piece binary")


def _blocks(benchmark: DataFrame, window: int) -> Iterator[list[tuple[str | None, int, int, bytes]]]:
    """The benchmark's pieces in blocks of about ``BLOCK_BYTES``, one at a time.

    A hash deals the pieces; the number of blocks follows their total size.
    """
    pieces = _pieces(benchmark, window)
    total = pieces.agg(F.sum(F.length("piece") + 64)).first()[0] or 0
    blocks = total // BLOCK_BYTES + 1
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("item", "place"), F.lit(blocks)))
    for block in range(blocks):
        own = dealt.filter(F.col("block") == block).select("item", "place", "source", "piece")
        yield [(row.item, row.place, row.source, bytes(row.piece)) for row in own.toLocalIterator()]


class _Tests:
    """A block's pieces as word numbers, each followed by a 0."""

    def __init__(self, pieces: list[tuple[str | None, int, int, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        numbers, lengths = [], []
        for _, _, _, piece in pieces:
            words = piece.split()
            lengths.append(len(words))
            numbers.extend(self.vocabulary.setdefault(word, len(self.vocabulary) + 1) for word in words)
            numbers.append(0)
        self.numbers = np.array(numbers, dtype=np.int64)
        lengths = np.array(lengths, dtype=np.int64)
        piece = np.repeat(np.arange(len(pieces)), lengths)
        begins = np.cumsum(lengths + 1) - lengths - 1
        within = np.arange(len(piece)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        # A suffix shorter than its item's window can't hold one.
        least = np.minimum(window, lengths)[piece]
        whole = lengths[piece] - within >= least
        piece, within, self.least = piece[whole], within[whole], least[whole]
        self.starts = begins[piece] + within
        # Names with a mark before them, so that no id looks like none.
        self.items, item_of = np.unique(np.array(["" if name is None else "=" + name for name, *_ in pieces], dtype=object), return_inverse=True)
        self.item_of = item_of[piece] if len(pieces) else piece
        # Where a suffix stands in its item, where its piece begins and ends there, and which item's text it is.
        first = np.array([place for _, place, _, _ in pieces], dtype=np.int64)
        self.first, self.stop = first[piece], (first + lengths)[piece]
        self.at = self.first + within
        self.source = np.array([source for _, _, source, _ in pieces], dtype=np.int64)[piece]
        self.depth = int(lengths.max(initial=1))


def _joined(edges: np.ndarray) -> np.ndarray:
    """Matches (row, source, shift, begin, end) with those that go on in another piece as one."""
    if not len(edges):
        return edges
    edges = edges[np.lexsort(edges.T[::-1])]
    keys = edges[:, :3]
    new = np.ones(len(edges), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
    group = np.cumsum(new)
    # The farthest end so far within a group: ends are made to rise from group to group.
    span = edges[:, 4].max() + 1
    reach = np.maximum.accumulate(edges[:, 4] + group * span) - group * span
    new[1:] |= edges[1:, 3] > reach[:-1]
    at = np.flatnonzero(new)
    joined = edges[at].copy()
    joined[:, 4] = np.maximum.reduceat(edges[:, 4], at)
    return joined


def _shard(tests: _Tests, texts: list[bytes], hits: list[list[int]], items: list[list[str]], longest: list[int], edges: list[list[int]]):
    """One training shard: searches the block's suffixes in it and adds to what earlier blocks found."""
    numbers, lengths = [], []
    for text in texts:
        words = item_words(text)
        lengths.append(len(words))
        numbers.extend(map(tests.vocabulary.get, words, [0] * len(words)))
        numbers.append(0)
    words = np.array(numbers + [0], dtype=np.int64)
    lengths = np.array(lengths, dtype=np.int64)
    begins = np.cumsum(lengths + 1) - lengths - 1

    cover = np.zeros(len(words) + 1, dtype=np.int64)
    for begin, known in zip(begins, hits):
        np.add.at(cover, begin + np.array(known[::2], dtype=np.int64), 1)
        np.add.at(cover, begin + np.array(known[1::2], dtype=np.int64), -1)
    longest = np.array(longest, dtype=np.int64)
    found = [np.empty(0, dtype=np.int64)]
    touching = [np.array([[row, *known[i : i + 4]] for row, known in enumerate(edges) for i in range(0, len(known), 4)], dtype=np.int64).reshape(-1, 5)]
    order = suffix_array(words, tests.depth)
    for which, low, high, length in search(words, order, tests.numbers, tests.starts, tests.least):
        # Suffixes with one range match at the same places.
        ranges, one, of = np.unique(np.stack([low, high, tests.least[which]], axis=1), axis=0, return_index=True, return_inverse=True)
        count = ranges[:, 1] - ranges[:, 0]
        places = order[spans(ranges[:, 0], count)]
        least = np.repeat(ranges[:, 2], count)
        np.add.at(cover, places, 1)
        np.add.at(cover, places + least, -1)
        rows = np.searchsorted(begins, places, side="right") - 1
        np.maximum.at(longest, rows, length)
        # The documents of every range, and for each of its items a pair with all of them.
        in_range = np.unique(np.repeat(np.arange(len(ranges)), count) * len(texts) + rows)
        named = np.unique(of.ravel() * len(tests.items) + tests.item_of[which])
        of_range, rows = np.divmod(in_range, len(texts))
        begin = np.searchsorted(of_range, np.arange(len(ranges) + 1))
        own, item = np.divmod(named, len(tests.items))
        size = (begin[1:] - begin[:-1])[own]
        found.append(np.unique(rows[spans(begin[own], size)] * len(tests.items) + np.repeat(item, size)))
        # Matches from a piece's first word on, or up to its last, where the item goes on.
        edge = ((tests.at[which] == tests.first[which]) & (tests.first[which] > 0)) | (tests.at[which] + length == tests.stop[which])
        if edge.any():
            which, low, size = which[edge], low[edge], (high - low)[edge]
            places, which = order[spans(low, size)], np.repeat(which, size)
            rows = np.searchsorted(begins, places, side="right") - 1
            at = tests.at[which]
            touching.append(np.stack([rows, tests.source[which], places - begins[rows] - at, at, at + length], axis=1))
            if sum(map(len, touching)) > _MANY_EDGES:
                touching = [_joined(np.concatenate(touching))]

    hit = np.concatenate([[0], np.cumsum(cover[:-1]) > 0]).astype(np.int8)
    changes = np.diff(hit)
    opens, closes = np.flatnonzero(changes == 1), np.flatnonzero(changes == -1)
    rows = np.searchsorted(begins, opens, side="right") - 1
    flat = np.stack([opens - begins[rows], closes - begins[rows]], axis=1)
    cuts = np.searchsorted(rows, np.arange(len(texts) + 1))
    hits = [flat[cuts[row] : cuts[row + 1]].ravel().tolist() for row in range(len(texts))]
    items = [list(known) for known in items]
    for row, item in zip(*np.divmod(np.unique(np.concatenate(found)), max(len(tests.items), 1))):
        if tests.items[item]:
            items[row].append(tests.items[item][1:])
    joined = _joined(np.concatenate(touching))
    np.maximum.at(longest, joined[:, 0], joined[:, 4] - joined[:, 3])
    cuts = np.searchsorted(joined[:, 0], np.arange(len(texts) + 1))
    edges = [joined[cuts[row] : cuts[row + 1], 1:].ravel().tolist() for row in range(len(texts))]
    return lengths.tolist(), hits, items, longest.tolist(), edges


_FOUND = "n_words bigint, hits array<int>, items array<string>, longest bigint, edges array<bigint>"


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` as a struct ``row``, and what the benchmark's suffixes found in its text.

    ``hits`` holds the words inside matches as starts and ends, one after the
    other; ``items`` the ids; ``longest`` the words of the longest verbatim match;
    ``edges`` the matches that touch an edge of a piece, for the next block.
    """
    spark = docs.sparkSession
    rows = docs.select(F.struct("*").alias("row"), *(F.lit(None).cast(kind).alias(name) for name, kind in (f.split(" ") for f in _FOUND.split(", "))))

    def step(known) -> None:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tests = known.value
            for part in parts(batches, lambda batch: batch.column("row").field("text"), SHARD_BYTES):
                texts = [t or b"" for t in part.column("row").field("text").cast(pa.binary()).to_pylist()]
                before = [[v or empty for v in part.column(c).to_pylist()] for c, empty in (("hits", []), ("items", []), ("longest", 0), ("edges", []))]
                values = _shard(tests, texts, *before)
                kinds = (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.int64(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("row"), *(pa.array(v, k) for v, k in zip(values, kinds))], names=part.schema.names)

        return run

    for place, block in enumerate(_blocks(benchmark, window)):
        if place:
            # What one block found is a table before the next is searched.
            path, schema = scratch_path(spark, "matches"), rows.schema
            rows.write.parquet(path)
            rows = spark.read.schema(schema).parquet(path)
        rows = rows.mapInArrow(step(spark.sparkContext.broadcast(_Tests(block, window))), rows.schema)
    return rows


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: its words, those inside matches, the items, the longest match, and the verdict."""
    rows = matches(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")), benchmark, window)
    items = F.array_sort(F.array_distinct("items"))
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda total, edge: edge - total)
    return rows.select(
        "row.doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
        F.col("longest").alias("longest_match"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any window of the benchmark, with the columns they came with."""
    return matches(docs, benchmark, window).filter(F.size("hits") == 0).select("row.*")


def sql(documents: str, benchmark: str) -> str:
    """The same report in DuckDB."""
    windows = f"""
        SELECT item_id, i AS place, CASE WHEN len(w.words) < {WINDOW} THEN array_to_string(w.words, ' ')
               ELSE array_to_string(list_slice(w.words, i, i + {WINDOW - 1}), ' ') END AS shown, least(len(w.words), {WINDOW}) AS size
        FROM (SELECT item_id, {sql_words("text", ITEM_WORD, lower=True)} AS words FROM ({benchmark}) AS b) AS w,
             unnest(range(1, greatest(len(w.words) - {WINDOW - 2}, 2))) AS t(i)
        WHERE len(w.words) > 0"""
    return f"""
    WITH windows AS ({windows}),
    sizes AS (SELECT DISTINCT size FROM windows),
    read AS (SELECT *, {sql_words("text", ITEM_WORD, lower=True)} AS words FROM ({documents}) AS source),
    placed AS (
        SELECT doc_id, t.i, size, array_to_string(list_slice(words, t.i, t.i + size - 1), ' ') AS shown
        FROM read, sizes, unnest(range(1, len(words) - size + 2)) AS t(i)),
    found AS (SELECT DISTINCT doc_id, i, placed.size, item_id, place FROM placed JOIN windows USING (shown)),
    runs AS (
        SELECT doc_id, size, item_id, i - place AS shift,
               i - row_number() OVER (PARTITION BY doc_id, size, item_id, i - place ORDER BY i) AS run FROM found),
    longest AS (
        SELECT doc_id, max(words) AS words FROM (
            SELECT doc_id, count(*) + size - 1 AS words FROM runs GROUP BY doc_id, size, item_id, shift, run) AS r GROUP BY doc_id),
    hits AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM found, unnest(range(i, i + size)) AS u(word) GROUP BY doc_id),
    listed AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM found GROUP BY doc_id)
    SELECT read.* EXCLUDE (words), CAST(len(read.words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(len(items), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(longest.words, 0) AS BIGINT) AS longest_match
    FROM read LEFT JOIN hits USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN longest USING (doc_id)"""


QUERY_SQL = f"""SELECT doc_id, n_words, n_hit, n_items, items_sha256, contaminated, longest_match
FROM ({sql("SELECT * FROM documents", "SELECT * FROM benchmark")}) AS report"""
