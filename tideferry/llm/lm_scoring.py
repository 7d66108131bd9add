"""Language-model scores: context-tree weighting over bytes, beside a unigram of words.

Texts are UTF-8 with A to Z in lower case, ended by a byte that UTF-8 never
uses. A byte is coded as eight binary decisions; each decision, a node of the
byte's binary tree, has its own tree of contexts: the ``depth`` bytes before.
Every context estimates a decision by Krichevsky and Trofimov's rule from its
training counts and mixes it with what its longer contexts say, by their
weighted probabilities over the training texts. A score is the log10
probability of the whole text and its end.

How it is spread: runs of ``depth`` + 1 bytes (grams, at most eight bytes, one
number) and words, by 64-bit hashes, are counted in the tasks and added up by shuffles. All grams
with the same three bytes before the last hold every level below those three,
and their sums go on by context of three bytes. All of those with the same two
bytes before the last hold the next two levels. The two upper levels are at
most 65,280 rows and go through the driver. On the way back, what the upper
levels say of a context of three bytes meets its grams in the same group. Then
every distinct gram has its probability.
Texts look up frequent grams and words in a broadcast table of bounded size
(``HEAVY_GRAMS``, ``HEAVY_WORDS``); the rest, none of them frequent, is joined.

Defined results: null is the empty text, one end. Rows without an id are learnt
from. Equal rows score equally, and each counts in training. With no training
rows all bits are even. An empty table gives an empty result. Only ``doc_id``
and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideferry.llm.hashing import Powers, mixed, word_hashes
from tideferry.llm.words import id_and_text, parts, texts
from tideferry.sources.shared import scratch_path

# Bytes of context if none is asked for, of the registered query, and the most that fit a number beside the last byte.
DEPTH = 3
QUERY_DEPTH = 5
MOST_DEPTH = 7
START, END = 0xFE, 0xFF

# Bounds of what is broadcast, in entries.
HEAVY_GRAMS = 1 << 20
HEAVY_WORDS = 1 << 19

# Contexts of two bytes are dealt to so many groups, those of three to more if there are more grams than this in each.
GROUPS = 1024
GROUP_GRAMS = 1 << 16


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _grams(documents: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The grams of all texts, one per byte and one per end, and where each text begins."""
    pad = bytes([START]) * depth
    line = np.frombuffer(b"".join(pad + d.lower() + bytes([END]) for d in documents) + b"", dtype=np.uint8).astype(np.uint64)
    lengths = np.array([len(d) for d in documents], dtype=np.int64) + 1
    codes = np.zeros(len(line) - depth, dtype=np.uint64)
    for back in range(depth + 1):
        codes |= line[depth - back : len(line) - back] << np.uint64(8 * back)
    # Places that straddle two texts are left out.
    begins = np.cumsum(lengths + depth) - lengths - depth
    keep = np.ones(len(codes), dtype=bool)
    for gap in range(depth):
        keep[begins[1:] - depth + gap] = False
    return codes[keep], np.cumsum(lengths) - lengths


WORD, GRAM = 0, 1

# The end of a text, as a word's hash.
END_WORD = 0

# Codes looked up at once, and bytes of text whose codes are.
_AT_ONCE = 1 << 18
_PART_BYTES = 2 << 20


def _words(documents: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts and of one end for each, and where each text begins."""
    found = word_hashes([document.lower() for document in documents], _POWERS)
    end = np.array([END_WORD], dtype=np.uint64)
    lengths = np.array([len(words) for words in found], dtype=np.int64) + 1
    return np.concatenate([some for words in found for some in (words, end)]), np.cumsum(lengths) - lengths


_POWERS = Powers()


def _counts(docs: DataFrame, depth: int) -> DataFrame:
    """Words and grams, as numbers, with their counts in training texts and in all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            found = texts(part)
            learnt = np.array([not out for out in part.column("held_out").to_pylist()], dtype=bool)
            for kind, (codes, begins) in ((WORD, _words(found)), (GRAM, _grams(found, depth))):
                learn = np.repeat(learnt, np.diff(np.append(begins, len(codes))))
                for some, times in ((codes[learn], 1), (codes[~learn], 0)):
                    distinct, n = np.unique(some, return_counts=True)
                    columns = [np.full(len(n), kind, dtype=np.int32), distinct.view(np.int64), n.astype(np.int64) * times, n.astype(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(column) for column in columns], names=["kind", "code", "trained", "n"])

    counted = docs.select("text", "held_out").mapInArrow(count, "kind int, code bigint, trained bigint, n bigint")
    return counted.groupBy("kind", "code").agg(F.sum("trained").alias("trained"), F.sum("n").alias("n"))


class _Table:
    """Values by code, in open addressing: a code stands in its own slot or soon after. Looked up for many codes at once."""

    EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)  # no gram, as no text holds the byte 0xFF, and no word's hash but one in 2**64

    def __init__(self, codes: np.ndarray, *values: np.ndarray) -> None:
        size = 1 << max(4, (len(codes) + len(codes) // 2).bit_length())
        self.mask, self.steps = np.uint64(size - 1), 0
        self.codes = np.full(size, self.EMPTY)
        self.values = [np.zeros(size, dtype=value.dtype) for value in values]
        left = np.arange(len(codes))
        while len(left):
            slot = (mixed(codes[left]) + np.uint64(self.steps)) & self.mask
            free = self.codes[slot] == self.EMPTY
            taken, first = np.unique(slot[free], return_index=True)
            placed = left[free][first]
            self.codes[taken] = codes[placed]
            for own, value in zip(self.values, values):
                own[taken] = value[placed]
            left = np.setdiff1d(left, placed, assume_unique=True)
            self.steps += 1

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slots of some codes, and whether they are there; some at a time, so that little is held between."""
        slots, found = np.empty(len(codes), dtype=np.int32), np.empty(len(codes), dtype=bool)
        for begin in range(0, len(codes), _AT_ONCE):
            some = slice(begin, begin + _AT_ONCE)
            slots[some], found[some] = self._find(codes[some])
        return slots, found

    def _find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slots = (mixed(codes) & self.mask).astype(np.int32)
        held = self.codes[slots]
        found = held == codes
        open_ = np.flatnonzero(~found & (held != self.EMPTY))
        for _ in range(1, self.steps):
            if not len(open_):
                break
            slots[open_] = (slots[open_] + 1) & int(self.mask)
            held = self.codes[slots[open_]]
            found[open_] = held == codes[open_]
            open_ = open_[(held != codes[open_]) & (held != self.EMPTY)]
        return slots, found


def _rare(codes: np.ndarray, begins: np.ndarray, light: np.ndarray) -> pa.ListArray:
    """For every text, its codes at some places, each with how often it has it."""
    rows = np.searchsorted(begins, light, side="right") - 1
    order = np.lexsort((codes[light], rows))
    rows, some = rows[order], codes[light][order]
    new = np.ones(len(some), dtype=bool)
    new[1:] = (some[1:] != some[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(some)))
    pairs = pa.StructArray.from_arrays([pa.array(some[at].view(np.int64)), pa.array(times.astype(np.int64))], names=["code", "times"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(rows[at], np.arange(len(begins) + 1)).astype(np.int32)), pairs)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function for x > 0: Stirling's series ten steps up."""
    y = x + 10
    up = sum(np.log(x + step) for step in range(10))
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - up


def _log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the block probability of so many zeros and ones."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1) - np.log(np.pi)


class _Level:
    """One level of context trees: counts, block probabilities, and how much a context trusts itself."""

    def __init__(self, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None):
        self.zeros, self.ones = zeros, ones
        own = _log_kt(zeros, ones)
        if below is None:
            self.log, self.trust = own, np.ones(len(own))
        else:
            self.log = np.logaddexp(own, below) - np.log(2)
            self.trust = np.exp(own - np.log(2) - self.log)

    def mixed(self, at: np.ndarray, bit: np.ndarray, deeper: np.ndarray | None) -> np.ndarray:
        """Probability of the bits at some contexts, given what the level below says."""
        zeros, ones = self.zeros[at], self.ones[at]
        own = (np.where(bit == 1, ones, zeros) + 0.5) / (zeros + ones + 1)
        return own if deeper is None else self.trust[at] * own + (1 - self.trust[at]) * deeper


def _bits(grams: np.ndarray, trained: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The eight decisions of the last byte of every gram: context and node as one key, the bit, and how often it was learnt."""
    grams = np.repeat(grams.view(np.uint64), 8)
    step = np.tile(np.arange(8, dtype=np.uint64), len(grams) // 8)
    byte = grams & np.uint64(255)
    node = (np.uint64(1) << step) | (byte >> (np.uint64(8) - step))
    bit = (byte >> (np.uint64(7) - step)) & np.uint64(1)
    return (grams & ~np.uint64(255)) | node, bit.astype(np.int64), np.repeat(trained, 8).astype(float)


def _cut(keys: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys with only so many of the nearest bytes, and which of them each key has."""
    return np.unique(keys & np.uint64((1 << 8 * (length + 1)) - 1), return_inverse=True)


class _Levels:
    """Levels of some contexts, from the longest, whose counts are given, up to contexts of ``top`` bytes."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None, longest: int, top: int):
        self.keys, self.level = keys, _Level(zeros, ones, below)
        # The deepest first, with the place of each of the longest contexts in it.
        self.levels = [(self.level, np.arange(len(keys)))]
        for length in range(longest - 1, top - 1, -1):
            self._shorten(length)

    def _shorten(self, length: int) -> None:
        # The key of the context one byte shorter: drop the byte furthest back.
        self.keys, up = _cut(self.keys, length)
        total = lambda values: np.bincount(up, values, len(self.keys))
        self.level = _Level(total(self.level.zeros), total(self.level.ones), total(self.level.log))
        self.levels.append((self.level, up[self.levels[-1][1]]))

    @classmethod
    def of_grams(cls, grams: np.ndarray, trained: np.ndarray, longest: int, top: int) -> tuple[_Levels, np.ndarray, np.ndarray, np.ndarray]:
        """The levels, and for every decision of every gram its key, the place of its longest context, and its bit."""
        every, bit, weight = _bits(grams, trained)
        keys, at = np.unique(every, return_inverse=True)
        counts = [np.bincount(at, weight * (bit == b), len(keys)) for b in (0, 1)]
        return cls(keys, *counts, None, longest, top), every, at, bit

    def sums(self, length: int) -> pd.DataFrame:
        """Counts and block probabilities for the contexts above, of ``length`` bytes."""
        shorter, up = _cut(self.keys, length)
        total = lambda values: np.bincount(up, values, len(shorter))
        return pd.DataFrame({"place": shorter.view(np.int64), "zeros": total(self.level.zeros), "ones": total(self.level.ones), "log": total(self.level.log)})

    def mixed(self, at: np.ndarray, bit: np.ndarray, deeper: np.ndarray | None) -> np.ndarray:
        for level, place in self.levels:
            deeper = level.mixed(place[at], bit, deeper)
        return deeper


_SUMS = "place bigint, zeros double, ones double, log double"


def _by_two(key: str) -> Column:
    """Groups of keys by the two bytes before the last."""
    return (F.shiftright(key, 8).bitwiseAND(0xFFFF) % GROUPS).alias("part")


def _middle(rows: pd.DataFrame) -> _Levels:
    """The levels of three and two bytes from the sums of what is below."""
    rows = rows.sort_values("place")
    return _Levels(rows["place"].to_numpy().view(np.uint64), *(rows[name].to_numpy() for name in ("zeros", "ones", "log")), 3, 2)


def _upper(grouped) -> tuple[_Level, _Level]:
    """The levels of one and of no byte of context, as dense tables by (byte, node) and by node, from sums by groups."""
    rows = grouped.groupBy("place").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("log").alias("log")).collect()
    tables = np.zeros((3, 1 << 16))
    for row in rows:
        tables[:, row.place] = row.zeros, row.ones, row.log
    level1 = _Level(*tables)
    by_node = lambda values: values.reshape(256, 256).sum(axis=0)
    # Contexts never seen have probability 1, so they don't change the sums.
    return level1, _Level(by_node(level1.zeros), by_node(level1.ones), by_node(np.where(level1.zeros + level1.ones > 0, level1.log, 0)))


def _top(levels: tuple[_Level, _Level], keys: np.ndarray, bit: np.ndarray, deeper: np.ndarray) -> np.ndarray:
    """What the two upper levels make of the level below them."""
    found = levels[0].mixed((keys & np.uint64(0xFFFF)).astype(np.int64), bit, deeper)
    return levels[1].mixed((keys & np.uint64(0xFF)).astype(np.int64), bit, found)


def _log10(rows: pd.DataFrame, found: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"gram": rows["gram"].to_numpy(), "n": rows["n"].to_numpy(), "log10": np.log10(found).reshape(-1, 8).sum(axis=1)})


_SCORES = "gram bigint, n bigint, log10 double"


def _flat_scores(grams: DataFrame) -> DataFrame:
    """``gram_scores`` for three bytes of context: a group holds both deepest levels."""

    def summed(rows: pd.DataFrame) -> pd.DataFrame:
        return _Levels.of_grams(rows["gram"].to_numpy(), rows["trained"].to_numpy(), 3, 2)[0].sums(1)

    grouped = grams.groupBy(_by_two("gram"))
    sent = grams.sparkSession.sparkContext.broadcast(_upper(grouped.applyInPandas(summed, _SUMS)))

    def score(rows: pd.DataFrame) -> pd.DataFrame:
        deep, keys, at, bit = _Levels.of_grams(rows["gram"].to_numpy(), rows["trained"].to_numpy(), 3, 2)
        return _log10(rows, _top(sent.value, keys, bit, deep.mixed(at, bit, None)))

    return grouped.applyInPandas(score, _SCORES)


def gram_scores(grams: DataFrame, depth: int = DEPTH) -> DataFrame:
    """log10 probability of the last byte of every gram, given the bytes before it."""
    if depth == 3:
        return _flat_scores(grams)
    spark = grams.sparkSession
    groups = max(GROUPS, grams.count() // GROUP_GRAMS)
    by_three = lambda key: F.pmod(F.xxhash64(F.shiftright(key, 8).bitwiseAND(0xFFFFFF)), F.lit(groups)).alias("part")

    def summed(rows: pd.DataFrame) -> pd.DataFrame:
        return _Levels.of_grams(rows["gram"].to_numpy(), rows["trained"].to_numpy(), depth, 4)[0].sums(3)

    # A context of three bytes is in one group, so its sums are whole.
    path = scratch_path(spark, "lm-contexts")
    grams.groupBy(by_three("gram")).applyInPandas(summed, _SUMS).write.parquet(path)
    contexts = spark.read.schema(_SUMS).parquet(path)
    grouped = contexts.groupBy(_by_two("place"))
    sent = spark.sparkContext.broadcast(_upper(grouped.applyInPandas(lambda rows: _middle(rows).sums(1), _SUMS)))

    def said(rows: pd.DataFrame) -> pd.DataFrame:
        """What the upper four levels say of each bit, and the share they leave to what is deeper."""
        middle, keys = _middle(rows), np.sort(rows["place"].to_numpy()).view(np.uint64)
        at, whole = np.arange(len(keys)), np.ones(len(keys))
        own = [_top(sent.value, keys, at * 0 + bit, middle.mixed(at, at * 0 + bit, 0 * whole)) for bit in (0, 1)]
        rest = _top(sent.value, keys, at * 0, middle.mixed(at, at * 0, whole)) - own[0]
        return pd.DataFrame({"place": keys.view(np.int64), "zero": own[0], "one": own[1], "rest": rest})

    upper = grouped.applyInPandas(said, "place bigint, zero double, one double, rest double")

    def score(rows: pd.DataFrame, upper: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame({"gram": [], "n": [], "log10": []}).astype({"gram": "int64", "n": "int64"})
        deep, keys, at, bit = _Levels.of_grams(rows["gram"].to_numpy(), rows["trained"].to_numpy(), depth, 4)
        upper = upper.sort_values("place")
        place = np.searchsorted(upper["place"].to_numpy(), (keys & np.uint64(0xFFFFFFFF)).view(np.int64))
        zero, one, rest = (upper[name].to_numpy()[place] for name in ("zero", "one", "rest"))
        return _log10(rows, np.where(bit == 1, one, zero) + rest * deep.mixed(at, bit, None))

    return grams.groupBy(by_three("gram")).cogroup(upper.groupBy(by_three("place"))).applyInPandas(score, _SCORES)


def _frequent(counts: DataFrame, most: int) -> Column:
    """A condition on ``n`` that at most ``most`` rows meet: chosen from how many rows have each magnitude."""
    size = F.when(F.col("n") < 64, F.col("n")).otherwise(F.floor(F.log2("n") * 16) - 32)
    rows = counts.groupBy(size.cast("bigint").alias("size")).agg(F.count(F.lit(1)).alias("rows"), F.min("n").alias("least")).collect()
    total, least = 0, None
    for row in sorted(rows, key=lambda row: -row.size):
        total += row.rows
        if total > most:
            break
        least = row.least
    return F.col("n") >= F.lit(least) if least is not None else F.lit(False)


def scored(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """One row per document: token counts, the unigram score, the score of a model of ``depth`` bytes, and bits per byte."""
    if not 3 <= depth <= MOST_DEPTH:
        raise ValueError(f"depth must be 3 to {MOST_DEPTH}")
    spark = docs.sparkSession
    docs = id_and_text(docs).withColumn("held_out", held_out(F.col("doc_id")))
    path = scratch_path(spark, "lm-counts")
    _counts(docs, depth).write.partitionBy("kind").parquet(path)
    counts = spark.read.schema("code bigint, trained bigint, n bigint, kind int").parquet(path)

    words = counts.filter(F.col("kind") == WORD).select("code", "trained", "n")
    totals = words.agg(F.sum("trained").alias("tokens"), F.count(F.when(F.col("trained") > 0, 1)).alias("distinct")).first()
    tokens, distinct = totals.tokens or 0, totals.distinct
    words = words.select("code", "n", "trained", F.log10((F.col("trained") + 1) / F.lit(float(tokens + distinct + 1))).alias("log10"))
    path = scratch_path(spark, "lm-grams")
    gram_scores(counts.filter(F.col("kind") == GRAM).select(F.col("code").alias("gram"), "trained", "n"), depth).write.parquet(path)
    grams = spark.read.schema("gram bigint, n bigint, log10 double").parquet(path).withColumnRenamed("gram", "code")

    # As Arrow batches: rows of Python objects would take many times the memory.
    many_words, many_grams = _frequent(words, HEAVY_WORDS), _frequent(grams, HEAVY_GRAMS)
    heavy = words.filter(many_words).select("code", "log10", (F.col("trained") > 0).alias("known")).toArrow()
    known_words = _Table(heavy.column("code").to_numpy().view(np.uint64), heavy.column("log10").to_numpy(), heavy.column("known").to_numpy())
    heavy = grams.filter(many_grams).select("code", "log10").toArrow()
    known_grams = _Table(heavy.column("code").to_numpy().view(np.uint64), heavy.column("log10").to_numpy())
    sent = spark.sparkContext.broadcast((known_words, known_grams))

    pairs = "array<struct<code:bigint,times:bigint>>"
    schema = f"doc_id bigint, digest bigint, held_out boolean, n_bytes bigint, n_tokens bigint, n_known bigint, base double, score double, rare_words {pairs}, rare_grams {pairs}"
    names = [field.split()[0] for field in schema.split(", ")]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_words, known_grams = sent.value
        for part in parts(batches, most=_PART_BYTES):
            some = texts(part)
            words, begins = _words(some)
            slots, found = known_words.find(words)
            base = np.where(found, known_words.values[0][slots], 0.0)
            known = (found & known_words.values[1][slots]).astype(np.int64)
            columns = [pa.array([len(t) for t in some], pa.int64()), pa.array(np.diff(np.append(begins, len(words))))]
            columns += [pa.array(np.add.reduceat(known, begins)), pa.array(np.add.reduceat(base, begins))]
            rare_words = _rare(words, begins, np.flatnonzero(~found))
            grams, begins = _grams(some, depth)
            slots, found = known_grams.find(grams)
            each = np.where(found, known_grams.values[0][slots], 0.0)
            columns += [pa.array(np.add.reduceat(each, begins)), rare_words, _rare(grams, begins, np.flatnonzero(~found))]
            yield pa.RecordBatch.from_arrays([*(part.column(name) for name in names[:3]), *columns], names=names)

    path = scratch_path(spark, "lm-scores")
    # Equal rows share a digest, so that what is joined for them counts once.
    docs.select("doc_id", F.xxhash64("text").alias("digest"), "held_out", "text").mapInArrow(look_up, schema).write.parquet(path)
    read = spark.read.schema(schema).parquet(path)

    def joined(rare: str, table: DataFrame) -> DataFrame:
        rows = read.select("doc_id", "digest", F.explode(rare).alias("rare")).select("doc_id", "digest", "rare.code", "rare.times")
        return rows.groupBy("doc_id", "digest", "code").agg(F.max("times").alias("times")).join(table, "code")

    rare = joined("rare_words", words.filter(~many_words))
    rare = rare.select("doc_id", "digest", F.when(F.col("trained") > 0, F.col("times")).otherwise(0).alias("known"), (F.col("times") * F.col("log10")).alias("base"), F.lit(0.0).alias("score"))
    deep = joined("rare_grams", grams.filter(~many_grams))
    deep = deep.select("doc_id", "digest", F.lit(0).alias("known"), F.lit(0.0).alias("base"), (F.col("times") * F.col("log10")).alias("score"))
    more = rare.unionByName(deep).groupBy("doc_id", "digest").agg(*(F.sum(name).alias("more_" + name) for name in ("known", "base", "score")))
    more = more.withColumnsRenamed({"doc_id": "more_id", "digest": "more_digest"})

    rows = read.drop("rare_words", "rare_grams").join(more, F.col("doc_id").eqNullSafe(F.col("more_id")) & (F.col("digest") == F.col("more_digest")), "left")
    added = lambda name, own: F.col(own) + F.coalesce(F.col("more_" + name), F.lit(0))
    score = added("score", "score")
    return rows.select(
        "doc_id",
        "held_out",
        "n_tokens",
        added("known", "n_known").cast("bigint").alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        added("base", "base").alias("base_score"),
        score.alias("score"),
        (-score * F.lit(float(np.log2(10))) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
