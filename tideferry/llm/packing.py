"""Packing documents for training: length buckets that waste least, and batches of a token budget.

A text's tokens are its words and one end. Texts longer than a piece may be
are cut into pieces, none of them lost. One count per length, at most
``MAX_TOKENS`` of them, tells how many pieces have it; dynamic programming over
these counts chooses the bucket lengths with the least padding. Inside a
bucket, pieces fill batches of ``BUDGET`` tokens one after another.

The order inside a bucket is by a hash of id and piece, so that the bucket,
which may hold most pieces, is numbered by many tasks: each numbers its share
and starts where the shares before it end. Pieces that agree in id, place and
length are numbered as one row with a count.

Defined results: null and empty texts are one piece of one token, the end.
Equal rows, and rows without an id, are separate pieces. If there are fewer
lengths than buckets, every length is a bucket; an empty table has none. Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideferry.llm.words import PLAIN_WORD, id_and_text, sql_words, words_of

MAX_TOKENS = 2048
BUCKETS = 8
BUDGET = 16384

# Pieces of a bucket that one task numbers, on average.
SHARE = 1 << 16


def pieces(docs: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """doc_id, first token and tokens of every piece."""
    counted = id_and_text(docs).select("doc_id", (F.size(words_of(F.col("text"))) + 1).cast("bigint").alias("total"))
    begins = F.sequence(F.lit(0).cast("bigint"), F.col("total") - 1, F.lit(max_tokens).cast("bigint"))
    cut = counted.select("doc_id", "total", F.explode(begins).alias("first_token"))
    return cut.select("doc_id", "first_token", F.least(F.col("total") - F.col("first_token"), F.lit(max_tokens)).alias("n_tokens"))


def bucket_lengths(histogram: list[tuple[int, int]], buckets: int = BUCKETS) -> list[int]:
    """Lengths of the buckets with the least padding for (length, count) pairs; the shortest choice among equals."""
    histogram = sorted(histogram)
    if not histogram:
        return []
    lengths = np.array([length for length, _ in histogram], dtype=np.int64)
    counts = np.concatenate([[0], np.cumsum([count for _, count in histogram])]).astype(np.int64)
    tokens = np.concatenate([[0], np.cumsum([length * count for length, count in histogram])]).astype(np.int64)
    n = len(lengths)
    # padding[i, j]: of the lengths i to j in one bucket as long as the j-th.
    padding = lengths[None, :] * (counts[None, 1:] - counts[:-1, None]) - (tokens[None, 1:] - tokens[:-1, None])
    never = np.iinfo(np.int64).max // 4
    padding[np.tril_indices(n, -1)] = never
    least = np.full(n + 1, never, dtype=np.int64)
    least[0] = 0
    choices = []
    for _ in range(min(buckets, n)):
        total = least[:-1, None] + padding
        choices.append(total.argmin(axis=0))
        least = np.concatenate([[never], np.minimum(total.min(axis=0), never)])
    ends, end = [], n
    for choice in reversed(choices):
        ends.append(int(lengths[end - 1]))
        end = int(choice[end - 1])
    return ends[::-1]


def packed(docs: DataFrame, max_tokens: int = MAX_TOKENS, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """One row per piece: its bucket's length, its batch in the bucket, and its place in the batch."""
    cut = pieces(docs, max_tokens)
    alike = cut.groupBy("doc_id", "first_token", "n_tokens").agg(F.count(F.lit(1)).alias("copies"))
    histogram = cut.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()  # at most max_tokens rows
    lengths = bucket_lengths([(row.n_tokens, row.n) for row in histogram], buckets)
    shares = sum(row.n for row in histogram) // SHARE + 1

    bucket = F.lit(None).cast("bigint")
    for length in reversed(lengths):
        bucket = F.when(F.col("n_tokens") <= length, F.lit(length).cast("bigint")).otherwise(bucket)
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("first_token").cast("string"))
    share = F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("bigint") % shares
    rows = alike.select("*", bucket.alias("bucket_tokens"), share.alias("share"))

    sizes = rows.groupBy("bucket_tokens", "share").agg(F.sum("copies").alias("size"))
    earlier = Window.partitionBy("bucket_tokens").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("bucket_tokens", "share", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("begin"))
    order = Window.partitionBy("bucket_tokens", "share").orderBy("doc_id", "first_token", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("within", F.coalesce(F.sum("copies").over(order), F.lit(0))).join(sizes, ["bucket_tokens", "share"])
    rows = rows.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)).alias("copy"))
    rank = F.col("begin") + F.col("within") + F.col("copy")
    room = F.expr(f"bigint(greatest(1, {budget} div bucket_tokens))")
    return rows.select(
        "doc_id",
        "first_token",
        "n_tokens",
        "bucket_tokens",
        F.floor(rank / room).alias("batch"),
        (rank % room).alias("place"),
    )


def sql(documents: str) -> str:
    """The same packing in DuckDB, for tables whose lengths differ in ``BUCKETS`` ways at least."""
    layers = ["layer0 AS (SELECT 0 AS j, CAST(0 AS HUGEINT) AS cost, 0 AS i)"]
    for k in range(1, BUCKETS + 1):
        layers.append(
            f"""layer{k} AS MATERIALIZED (
            SELECT j, best.cost AS cost, best.i AS i FROM (
                SELECT e.j AS j, min({{'cost': p.cost + e.length * (e.c - coalesce(b.c, 0)) - (e.t - coalesce(b.t, 0)), 'i': p.j}}) AS best
                FROM ends AS e JOIN layer{k - 1} AS p ON p.j < e.j LEFT JOIN ends AS b ON b.j = p.j GROUP BY e.j) AS found)"""
        )
    path = [f"step{BUCKETS} AS (SELECT i, j FROM layer{BUCKETS} WHERE j = (SELECT max(j) FROM ends))"]
    for k in range(BUCKETS - 1, 0, -1):
        path.append(f"step{k} AS (SELECT l.i, l.j FROM layer{k} AS l JOIN step{k + 1} AS s ON l.j = s.i)")
    chosen = " UNION ALL ".join(f"SELECT j FROM step{k}" for k in range(1, BUCKETS + 1))
    return f"""
    WITH counted AS (SELECT doc_id, len({sql_words("text", PLAIN_WORD)}) + 1 AS total FROM ({documents}) AS source),
    cut AS (SELECT doc_id, CAST(first_token AS BIGINT) AS first_token, CAST(least(total - first_token, {MAX_TOKENS}) AS BIGINT) AS n_tokens
            FROM counted, unnest(range(0, total, {MAX_TOKENS})) AS t(first_token)),
    ends AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY n_tokens) AS j, n_tokens AS length, sum(n) OVER (ORDER BY n_tokens) AS c, sum(n * n_tokens) OVER (ORDER BY n_tokens) AS t
        FROM (SELECT n_tokens, count(*) AS n FROM cut GROUP BY n_tokens) AS h),
    {", ".join(layers)}, {", ".join(path)},
    bounds AS (SELECT length FROM ends WHERE j IN ({chosen})),
    placed AS (
        SELECT cut.*, (SELECT min(length) FROM bounds WHERE length >= n_tokens) AS bucket_tokens,
               CAST('0x' || substr(md5(doc_id || ':' || first_token), 1, 8) AS BIGINT) % (SELECT count(*) // {SHARE} + 1 FROM cut) AS share
        FROM cut),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY bucket_tokens ORDER BY share, doc_id, first_token) - 1 AS place_in_bucket FROM placed)
    SELECT doc_id, first_token, n_tokens, bucket_tokens, CAST(place_in_bucket // greatest(1, {BUDGET} // bucket_tokens) AS BIGINT) AS batch,
           CAST(place_in_bucket % greatest(1, {BUDGET} // bucket_tokens) AS BIGINT) AS place
    FROM ranked"""


QUERY_SQL = sql("SELECT * FROM documents")
