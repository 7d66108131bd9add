"""Repeated passages: relative Lempel-Ziv parsing of documents against earlier text.

All documents, in the order of their ids, are one line of words; a word's
number in it is its place. Reference blocks are cut by content, so that equal
text gives equal blocks wherever it stands: among the ``GRAM``-word grams of
every ``WINDOW`` words the one with the least hash is the window's anchor, and
the windows of one anchor are a block. The index holds the first place of
every block whose anchor occurs twice or more; a passage of a window or more
can't hide from it. A document is parsed from left to right: a block found
earlier is copied from there, and neighbouring copies from neighbouring places
are one factor. Where a factor ends, the windows across its boundary belong to
blocks of their own that are new as a whole; these are looked up window by
window. Every word of a copy is a duplicate.

The index is dealt by hash over all tasks, and every lookup is a join with it,
so no document is compared with another, and a passage that a third of all
documents share costs no more per document than any other. Texts are shuffled
once. Documents, blocks and windows are told apart by 64-bit hashes.

Defined results: a null or empty text has no words. A text of fewer words than
a window keeps them all. Rows without an id come last in order; equal rows are
one document, and of documents with the same words but other ids the first
keeps them. An empty table gives an empty result. Only ``doc_id`` and ``text``
are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideferry.llm.hashing import Powers, mixed, word_hashes
from tideferry.llm.joins import with_index
from tideferry.llm.numbering import running
from tideferry.llm.words import PLAIN_WORD, id_and_text, parts, plain_words, sql_words, texts
from tideferry.sources.shared import scratch_path

WINDOW = 20
GRAM = 6

# Texts are hashed in parts of about so many bytes.
PART_BYTES = 2 << 20


class _Text:
    """Hashes of any run of a document's words, by prefix sums of a polynomial."""

    def __init__(self, hashed: np.ndarray, powers: Powers):
        self.n = len(hashed)
        powers.reach(self.n)
        self.sums = np.zeros(self.n + 1, dtype=np.uint64)
        np.cumsum(hashed * powers.down[: self.n], out=self.sums[1:])
        self.powers = powers.up

    def hashes(self, first: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        total = (self.sums[first + length] - self.sums[first]) * self.powers[first]
        return mixed(total + np.asarray(length).astype(np.uint64))

    def all_hashes(self, length: int) -> np.ndarray:
        total = (self.sums[length:] - self.sums[:-length]) * self.powers[: self.n - length + 1]
        return mixed(total + np.uint64(length))

    def blocks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First window, number of windows, hash and anchor of every block."""
        n = self.n - WINDOW + 1
        if n < 1:
            empty = np.empty(0, dtype=np.int64)
            return empty, empty, empty, empty
        grams = self.all_hashes(GRAM)
        # The least of each window's grams, by the upper half of its hash and then by place, in doubling steps.
        least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        width, wanted = 1, WINDOW - GRAM + 1
        while width < wanted:
            step = min(width, wanted - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        anchors = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.diff(anchors, prepend=-1))
        count = np.diff(first, append=n)
        at = anchors[first]
        own = mixed(self.hashes(first, count + WINDOW - 1) + (at - first).astype(np.uint64))
        return first, count, own.view(np.int64), grams[at].view(np.int64)


def _heads(docs: DataFrame) -> DataFrame:
    """Every document's key, number of words, and hash of its words, as a table."""
    schema = "doc_id bigint, key bigint, n_words bigint, sha string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            words = [plain_words(text) for text in texts(batch)]
            shas = [hashlib.sha256(b" ".join(w)).hexdigest() for w in words]
            columns = [batch.column("doc_id"), batch.column("key"), pa.array([len(w) for w in words], pa.int64()), pa.array(shas, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "n_words", "sha"])

    path = scratch_path(docs.sparkSession, "heads")
    docs.mapInArrow(run, schema).write.parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def _numbered(heads: DataFrame) -> DataFrame:
    """The first document of every sequence of words, and the place of its first word, as a table."""
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    firsts = heads.filter(F.col("n_words") >= WINDOW).groupBy("sha", "n_words").agg(F.min(order).alias("of")).select("of.*", "n_words")
    return running(firsts, ["no_id", "doc_id", "key"], "n_words").withColumnRenamed("begin", "base")


def _per_text(rows: DataFrame, schema: str, lists: tuple[str, ...], work) -> DataFrame:
    """Apply ``work(base, text, *lists)`` to each row; it returns the columns after ``key``."""
    names = [field.strip().split()[0] for field in schema.split(", ")]
    types = [_ARROW[field.strip().split(" ", 1)[1]] for field in schema.split(", ")][1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for part in parts(batches, most=PART_BYTES):
            hashes = word_hashes(texts(part), powers)
            given = [part.column(name) for name in lists]
            out = [work(base, _Text(hashed, powers), *(column[row].values for column in given)) for row, (base, hashed) in enumerate(zip(part.column("base").to_pylist(), hashes))]
            yield pa.RecordBatch.from_arrays([part.column("key"), *(pa.array(list(c), k) for c, k in zip(zip(*out), types))], names=names)

    return rows.select("key", "base", "text", *lists).mapInArrow(run, schema)


_ARROW = {"bigint": pa.int64(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64())}


def _anchors(base: int, text: _Text) -> tuple:
    anchors, times = np.unique(text.blocks()[3], return_counts=True)
    return anchors, times


def _known_blocks(base: int, text: _Text, repeated: pa.Array) -> tuple:
    first, count, own, anchors = text.blocks()
    held = np.isin(anchors, repeated.to_numpy(zero_copy_only=False))
    return own[held], base + first[held], count[held]


def _new_windows(base: int, text: _Text, blocks: pa.Array) -> tuple:
    """The windows of blocks that are new here."""
    place, count, first = (blocks.field(name).to_numpy(zero_copy_only=False) for name in ("place", "n", "first"))
    new = place == first
    begins, count = place[new] - base, count[new]
    at = np.repeat(begins - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    return text.hashes(at, WINDOW).view(np.int64), base + at


def _factors(rows: DataFrame) -> DataFrame:
    """Factors of documents from their copied windows, and the words outside them."""
    schema = "key bigint, starts array<bigint>, lengths array<bigint>, sources array<bigint>, n_removed bigint, kept string, kept_sha string"

    def parse(base: int, words: list[bytes], copies: pa.Array) -> tuple:
        place, count, first = (copies.field(name).to_numpy(zero_copy_only=False) for name in ("place", "n", "first"))
        order = np.argsort(place, kind="stable")
        place, count, first = place[order], count[order], first[order]
        # A copy goes on where the one before it ends, here and there: the factor grows.
        fresh = np.ones(len(place), dtype=bool)
        fresh[1:] = (place[1:] != place[:-1] + count[:-1]) | (first[1:] != first[:-1] + count[:-1])
        begins = np.flatnonzero(fresh)
        starts, lengths = place[begins] - base, np.add.reduceat(count, begins) + WINDOW - 1
        cover = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(cover, starts, 1)
        np.add.at(cover, starts + lengths, -1)
        keep = np.cumsum(cover[:-1]) == 0
        kept = b" ".join(compress(words, keep.tolist()))
        return starts, lengths, first[begins], len(words) - int(keep.sum()), kept.decode("utf-8", "replace"), hashlib.sha256(kept).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.string(), pa.string())
        for part in parts(batches, most=PART_BYTES):
            out = [parse(base, plain_words(text), copies.values) for base, text, copies in zip(part.column("base").to_pylist(), texts(part), part.column("copies"))]
            columns = (pa.array(list(c), k) for c, k in zip(zip(*out), kinds))
            yield pa.RecordBatch.from_arrays([part.column("key"), *columns], names=[field.split()[0] for field in schema.split(", ")])

    return rows.select("key", "base", "text", "copies").mapInArrow(run, schema)


def parsed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All documents' heads, with the key of the first with the same words; and the parse of those with copies.

    A parse has the factors' first words, lengths and source places, the number
    of words removed, the words kept, joined by blanks, and their hash.
    """
    docs = id_and_text(docs)
    docs = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")
    heads = _heads(docs)
    numbered = _numbered(heads)
    # Joined by key each time, so that the texts' exchange is made once and used again.
    # Equal rows have equal keys; what they find is gathered as sets.
    rows = docs.select("key", "text").join(numbered, "key")

    found = _per_text(rows, "key bigint, anchors array<bigint>, times array<bigint>", (), _anchors)
    found = found.select("key", F.explode(F.arrays_zip("anchors", "times")).alias("a")).select("key", F.col("a.anchors").alias("anchor"), F.col("a.times").alias("times"))
    repeated = found.groupBy("anchor").agg(F.sum("times").alias("times")).filter("times > 1").select("anchor")
    repeated = found.join(repeated, "anchor", "left_semi").groupBy("key").agg(F.collect_set("anchor").alias("repeated"))

    blocks = _per_text(rows.join(repeated, "key"), "key bigint, blocks array<bigint>, places array<bigint>, counts array<bigint>", ("repeated",), _known_blocks)
    # Dealt once more, small as it is now, so that the texts are not parsed again for each use.
    blocks = blocks.repartition("key").select("key", F.explode(F.arrays_zip("blocks", "places", "counts")).alias("b"))
    blocks = blocks.select("key", F.col("b.blocks").alias("block"), F.col("b.places").alias("place"), F.col("b.counts").alias("n"))
    index = blocks.groupBy("block").agg(F.min("place").alias("first"))
    blocks = with_index(blocks, index, "block").select("key", "place", "n", "first")

    listed = blocks.groupBy("key").agg(F.collect_set(F.struct("place", "n", "first")).alias("blocks"))
    windows = _per_text(rows.join(listed, "key"), "key bigint, windows array<bigint>, places array<bigint>", ("blocks",), _new_windows)
    windows = windows.select("key", F.explode(F.arrays_zip("windows", "places")).alias("w")).select("key", F.col("w.windows").alias("window"), F.col("w.places").alias("place"))
    index = windows.groupBy("window").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("times")).filter("times > 1").drop("times")
    windows = windows.join(index, "window").select("key", "place", F.lit(1).cast("bigint").alias("n"), "first")

    copies = blocks.unionByName(windows).filter("first < place").groupBy("key").agg(F.collect_set(F.struct("place", "n", "first")).alias("copies"))
    return heads.join(numbered.select("key", F.lit(True).alias("is_first")), "key", "left"), _factors(rows.join(copies, "key"))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: its words, those removed, and a hash of the kept ones."""
    heads, parses = parsed(docs)
    rows = heads.join(parses.select("key", "n_removed", "kept_sha", F.size("starts").alias("n_factors")).dropDuplicates(["key"]), "key", "left")
    # Whoever has the words of an earlier document keeps none.
    copied = F.col("is_first").isNull() & (F.col("n_words") >= WINDOW)
    nothing = hashlib.sha256(b"").hexdigest()
    return rows.select(
        "doc_id",
        "n_words",
        F.when(copied, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copied, F.lit(nothing)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
    )


def sql(documents: str) -> str:
    """The same report in DuckDB, window by window."""
    return f"""
    WITH read AS (SELECT doc_id, {sql_words("text", PLAIN_WORD)} AS words FROM ({documents}) AS source),
    windows AS (
        SELECT doc_id, t.i AS i, array_to_string(list_slice(words, t.i, t.i + {WINDOW - 1}), ' ') AS shown
        FROM read, unnest(range(1, len(words) - {WINDOW - 2})) AS t(i)),
    ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY shown ORDER BY doc_id, i) AS rank FROM windows),
    gone AS (SELECT doc_id, list(DISTINCT word) AS places FROM ranked, unnest(range(i, i + {WINDOW})) AS u(word) WHERE rank > 1 GROUP BY doc_id),
    words AS (SELECT read.doc_id, u.word AS word, t.i AS i FROM read, unnest(words) WITH ORDINALITY AS u(word, i2), unnest([i2]) AS t(i)),
    kept AS (
        SELECT words.doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
        FROM words LEFT JOIN (SELECT doc_id, unnest(places) AS i, true AS removed FROM gone) AS g USING (doc_id, i) WHERE removed IS NULL GROUP BY words.doc_id)
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM read LEFT JOIN kept USING (doc_id)"""


QUERY_SQL = sql("SELECT * FROM documents")
