"""Token counts of documents in flat token files, found by scanning for separators.

A flat token file is nothing but 16-bit little-endian token ids; every document
ends with the end-of-document id. There is no index. The scan cuts files into
blocks, searches each block for separators in one vectorised comparison, and
stitches documents that straddle blocks with a prefix scan over the blocks'
summaries: where a block starts, and where its last separator stands.

Files are read by Spark only. A file of up to ``WHOLE_BYTES`` is one read; a
larger one is split into records of equal size that divide it evenly.

Defined results: a null or empty text is a document of no tokens. Tokens after
the last separator of a file are one unfinished document. A byte beyond the
last whole token is none. An empty file, and a folder without files, hold no
documents. Equal rows are separate documents.
``write_tokens`` reads nothing but the column ``text``.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideferry.llm.words import parts, texts
from tideferry.sources.shared import scratch_path

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# How the vocabulary splits text, and its end-of-document id.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END = 50256

TOKEN = np.dtype("<u2")
BLOCK_TOKENS = 1 << 20
WHOLE_BYTES = 64 << 20

_ENCODERS: dict[str, object] = {}


def _encoder(name: str, ranks: bytes):
    """One encoder per worker and vocabulary."""
    if name not in _ENCODERS:
        import tiktoken

        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        _ENCODERS[name] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})
    return _ENCODERS[name]


def write_tokens(docs: DataFrame, path: str, ranks: str = RANKS) -> None:
    """Write documents as flat token files, one per task, in the order the tasks read them.

    Spark's text writer puts each row's bytes and then its line separator; here
    the bytes are the tokens and the separator is the end-of-document id.
    """
    with open(ranks, "rb") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())  # a vocabulary file, about 1 MB
    name = uuid.uuid4().hex

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(name, sent.value)
        for part in parts(batches):
            tokens = [np.asarray(encoder.encode_ordinary(text.decode("utf-8", "replace")), dtype=TOKEN).tobytes() for text in texts(part)]
            yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.binary())], names=["tokens"])

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(encode, "tokens binary")
    end = np.array([END], dtype=TOKEN).tobytes().decode("iso-8859-1")
    rows.select(F.col("tokens").cast("string").alias("value")).write.option("encoding", "ISO-8859-1").option("lineSep", end).text(path)


_BLOCK = "file string, block bigint, n_tokens bigint, ends array<bigint>"
_KINDS = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()))


def _scanned(file: str, block: int, content: bytes) -> tuple:
    """A block's size and the places of its separators."""
    tokens = np.frombuffer(content, dtype=TOKEN, count=len(content) // TOKEN.itemsize)
    return file, block, len(tokens), np.flatnonzero(tokens == END).tolist()


def _blocks(spark: SparkSession, path: str, block_tokens: int, whole_bytes: int) -> DataFrame:
    """One row per block of every file."""
    files = spark.read.format("binaryFile").load(path)
    step = block_tokens * TOKEN.itemsize

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                content = content.as_buffer()
                for block, begin in enumerate(range(0, content.size, step)):
                    row = _scanned(file, block, content.slice(begin, min(step, content.size - begin)))
                    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, _KINDS)], names=[f.split()[0] for f in _BLOCK.split(", ")])

    # A file with half a token at its end has no even records.
    whole = (F.col("length") <= whole_bytes) | (F.col("length") % TOKEN.itemsize != 0)
    blocks = files.filter(whole).select("path", "content").mapInArrow(cut, _BLOCK)
    for large in files.filter(~whole).select("path", "length").toLocalIterator():
        tokens = large.length // TOKEN.itemsize
        size = next(s for s in range(min(block_tokens, tokens), 0, -1) if tokens % s == 0)
        records = spark.sparkContext.binaryRecords(large.path, size * TOKEN.itemsize).zipWithIndex()
        rows = records.map(lambda record, file=large.path: _scanned(file, record[1], record[0]))
        blocks = blocks.unionByName(spark.createDataFrame(rows, _BLOCK))
    return blocks


def counted(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """One row per document of the token files: file, number in it, first token, tokens, and whether it is finished."""
    scratch = scratch_path(spark, "token-blocks")
    _blocks(spark, path, block_tokens, whole_bytes).write.parquet(scratch)
    blocks = spark.read.schema(_BLOCK).parquet(scratch)

    # The prefix scan sees a few numbers per block, not the separators.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    scan = blocks.select("file", "block", "n_tokens", F.size("ends").alias("n_ends"), F.try_element_at("ends", F.lit(-1)).alias("last_end"))
    scan = scan.select(
        "*",
        F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("begin"),
        F.coalesce(F.sum("n_ends").over(before), F.lit(0)).alias("earlier"),
        F.lead("block").over(Window.partitionBy("file").orderBy("block")).isNull().alias("is_last"),
    )
    # Where the document that is open at a block's start began: behind the last separator before the block.
    scan = scan.withColumn("open", F.coalesce(F.max(F.col("begin") + F.col("last_end") + 1).over(before), F.lit(0)))
    rest = F.col("begin") + F.col("n_tokens") > F.coalesce(F.col("begin") + F.col("last_end") + 1, F.col("open"))
    scan = scan.select("file", "block", "begin", "earlier", "open", (F.col("is_last") & rest).alias("unfinished"))

    rows = blocks.join(scan, ["file", "block"])
    ends = F.when(F.col("unfinished"), F.concat("ends", F.array("n_tokens"))).otherwise(F.col("ends"))
    rows = rows.select("file", "begin", "earlier", "open", "unfinished", ends.alias("ends"))
    rows = rows.select("*", F.posexplode("ends").alias("place", "end"))
    first = F.when(F.col("place") == 0, F.col("open")).otherwise(F.col("begin") + F.get("ends", F.col("place") - 1) + 1)
    return rows.select(
        "file",
        (F.col("earlier") + F.col("place")).alias("document"),
        first.alias("first_token"),
        (F.col("begin") + F.col("end") - first).alias("n_tokens"),
        (~F.col("unfinished") | (F.col("place") < F.size("ends") - 1)).alias("finished"),
    )


def of_documents(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """Tokens of a table's documents, written as flat token files and counted there."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, ranks)
    shard = F.regexp_extract("file", r"part-(\d+)", 1).cast("bigint")
    return counted(docs.sparkSession, path).select(shard.alias("shard"), "document", "first_token", "n_tokens", "finished")
