"""Toxic documents: a convolutional text classifier, trained in numpy.

A word's embedding is the sum of two rows of a table, one for the hash of the
word and one for that of its first ``STEM`` bytes. Filters over one, two and
three neighbouring words slide over the whole text; the largest response of
each filter feeds a logistic unit. Scores come from the text alone.

The classifier learns from every labelled document that is not held out, whole
texts. They are dealt into parts of about ``DOCS_PER_PART``; in each pass one
task a part takes steps from the common parameters over its documents, and
Spark averages what the parts have made of them: a row of the table over the
parts that changed it, by the steps that did, all else by documents. Two more
models learn from one half of these documents each, and score the other half,
so that the thresholds per language come from all of them, too. The driver
holds parameters and counts of words, both bounded by ``BUCKETS``.

Defined results: null and empty texts score like a text without words. A null
id is never held out and never learnt from. A document marked both ways counts
as toxic; null marks are no marks. Without labels of both classes all scores
are the share of toxic labels, one half without labels. Equal rows score
equally; an empty table gives an empty result.
"""

from __future__ import annotations

import copy
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideferry.llm.words import item_words, parts, texts
from tideferry.session import settings
from tideferry.sources.shared import scratch_path

# Documents of a part, and the steps a part's task takes over all passes, at most EPOCHS of them.
DOCS_PER_PART = 12288
STEPS = 2000

BUCKETS = 1 << 18
STEM = 4
DIMENSIONS = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
EPOCHS = 20
DOCS_PER_STEP = 32
RATE = 0.1
# Words of fewer documents than this share of the smaller class are not learnt: they would only be learnt by heart.
LEAST_SHARE = 0.01
# Share of the words left out in each step, and what draws embeddings back to 0.
DROPPED = 0.6
DECAY = 1e-3
HOLD_OUT = 5
HALVES, ALL = (0, 1), 2
# Rows of the table that are averaged together.
ROWS_PER_BLOCK = 256

# Fewer toxic documents of a language than this share the common threshold.
LEAST_TOXIC = 20

_PAD = max(WIDTHS)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HOLD_OUT == 0, F.lit(False))


def _hashed(text: bytes) -> np.ndarray:
    """A text's words as pairs of rows of the embedding table; row 0 stands for no word."""
    words = item_words(text)
    found = np.empty((len(words), 2), dtype=np.uint32)
    found[:, 0] = np.fromiter(map(zlib.crc32, words), dtype=np.uint32, count=len(words))
    found[:, 1] = np.fromiter((zlib.crc32(word[:STEM], 1) for word in words), dtype=np.uint32, count=len(words))
    return found % (BUCKETS - 1) + 1


def _laid_out(documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents in one row of word numbers with gaps between them; first and last-plus-one place of each."""
    lengths = np.array([len(d) for d in documents], dtype=np.int64)
    begins = np.cumsum(lengths + _PAD) - lengths - _PAD
    numbers = np.zeros((int((lengths + _PAD).sum()) + _PAD, 2), dtype=np.int64)
    for begin, document in zip(begins, documents):
        numbers[begin : begin + len(document)] = document
    return numbers, begins, begins + lengths + 1


class Classifier:
    """Embeddings of ``words`` learnt words and of row 0 for all others, one weight block per filter width and offset, and the output unit."""

    def __init__(self, words: int, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.embedding = np.zeros((words + 1, DIMENSIONS), dtype=np.float32)
        self.embedding[1:] = np.random.default_rng(seed).normal(0, 0.02, (words, DIMENSIONS))
        self.filters = [draw.normal(0, 0.5 / width, (width, DIMENSIONS, FILTERS)).astype(np.float32) for width in WIDTHS]
        self.bias = np.zeros((len(WIDTHS), FILTERS), dtype=np.float32)
        self.out = draw.normal(0, 0.3, (len(WIDTHS), FILTERS)).astype(np.float32)
        self.shift = np.zeros(1)
        self.past = [np.full_like(x, 1e-3) for x in (self.embedding, *self._common())]
        self.docs, self.touched = 0, np.zeros(words + 1)

    def _common(self) -> list[np.ndarray]:
        """All parameters but the embeddings."""
        return [*self.filters, self.bias, self.out, self.shift]

    def _words(self, numbers: np.ndarray) -> np.ndarray:
        return self.embedding[numbers[..., 0]] + self.embedding[numbers[..., 1]]

    def _responses(self, numbers: np.ndarray) -> list[np.ndarray]:
        words = self._words(numbers)
        usable = len(numbers) - _PAD + 1
        found = []
        for block, bias in zip(self.filters, self.bias):
            total = words[:usable] @ block[0] + bias
            for offset in range(1, len(block)):
                total += words[offset : offset + usable] @ block[offset]
            found.append(total)
        return found

    def logits(self, documents: list[np.ndarray]) -> np.ndarray:
        numbers, first, end = _laid_out(documents)
        edges = np.stack([first, end], axis=1).ravel()
        total = np.full(len(documents), self.shift[0])
        for response, out in zip(self._responses(numbers), self.out):
            total += np.maximum(np.maximum.reduceat(response, edges, axis=0)[::2], 0) @ out
        return total

    def learn(self, documents: list[np.ndarray], toxic: np.ndarray, draw: np.random.Generator) -> None:
        """Adagrad on the logistic loss, once over the documents. Only the places of the largest responses carry gradient."""
        order = draw.permutation(len(documents))
        for begin in range(0, len(order), DOCS_PER_STEP):
            chosen = order[begin : begin + DOCS_PER_STEP]
            numbers, first, end = _laid_out([documents[i] for i in chosen])
            numbers[draw.random(len(numbers)) < DROPPED] = 0
            responses = self._responses(numbers)
            tops = np.empty((len(WIDTHS), len(chosen), FILTERS), dtype=np.int64)
            for width, response in enumerate(responses):
                for row, (a, b) in enumerate(zip(first, end)):
                    tops[width, row] = a + response[a:b].argmax(axis=0)
            lanes = np.arange(FILTERS)
            peak = np.stack([responses[w][tops[w], lanes] for w in range(len(WIDTHS))])
            active = np.maximum(peak, 0)
            logit = np.einsum("wnf,wf->n", active, self.out) + self.shift[0]
            error = ((1 / (1 + np.exp(-logit)) - toxic[chosen]) / len(chosen)).astype(np.float32)

            d_out = np.einsum("wnf,n->wf", active, error)
            d_peak = error[None, :, None] * self.out[:, None, :] * (peak > 0)
            rows, steps = [], []
            for width, block in enumerate(self.filters):
                for offset in range(len(block)):
                    step = (d_peak[width][:, :, None] * block[offset].T[None]).reshape(-1, DIMENSIONS)
                    for kind in (0, 1):
                        rows.append(numbers[tops[width] + offset, kind].ravel())
                        steps.append(step)
            rows, steps = np.concatenate(rows), np.concatenate(steps)
            d_filters = [
                np.stack([np.einsum("nfd,nf->df", self._words(numbers[tops[w] + o]), d_peak[w]) for o in range(len(block))]) for w, block in enumerate(self.filters)
            ]
            touched, place = np.unique(rows, return_inverse=True)
            d_rows = np.zeros((len(touched), DIMENSIONS), dtype=np.float32)
            np.add.at(d_rows, place, steps)
            d_rows += DECAY * self.embedding[touched]
            d_rows[touched == 0] = 0

            self.past[0][touched] += d_rows**2
            self.embedding[touched] -= RATE * d_rows / np.sqrt(self.past[0][touched])
            changes = [*d_filters, d_peak.sum(axis=1), d_out, error.sum(keepdims=True)]
            for value, gone, change in zip(self._common(), self.past[1:], changes):
                gone += change**2
                value -= RATE * change / np.sqrt(gone)
            self.touched[touched] += 1
            self.docs += len(chosen)

    def sums(self) -> Iterator[tuple[int, np.ndarray]]:
        """Blocks of numbers that add up over parts: weights, and parameters times weights."""
        common = [x.ravel() for x in (*self._common(), *self.past[1:])]
        if self.docs:
            yield -1, (np.concatenate([[1.0], *common]) * self.docs).astype(np.float32)
        rows = np.concatenate([np.ones((len(self.touched), 1)), self.embedding, self.past[0]], axis=1, dtype=np.float32) * self.touched[:, None].astype(np.float32)
        for begin in range(0, len(rows), ROWS_PER_BLOCK):
            if self.touched[begin : begin + ROWS_PER_BLOCK].any():
                yield begin // ROWS_PER_BLOCK, rows[begin : begin + ROWS_PER_BLOCK].ravel()

    def take(self, block: int, total: np.ndarray) -> None:
        """Replace parameters by their mean over the parts."""
        if block < 0:
            values = total[1:] / total[0]
            for x in (*self._common(), *self.past[1:]):
                x[...], values = values[: x.size].reshape(x.shape), values[x.size :]
            return
        rows = total.reshape(-1, 1 + 2 * DIMENSIONS)
        changed = np.flatnonzero(rows[:, 0])
        means = rows[changed, 1:] / rows[changed, :1]
        self.embedding[block * ROWS_PER_BLOCK + changed] = means[:, :DIMENSIONS]
        self.past[0][block * ROWS_PER_BLOCK + changed] = means[:, DIMENSIONS:]


@dataclass
class Fitted:
    classifier: Classifier | None
    places: np.ndarray | None
    constant: float
    threshold: float
    by_language: dict[str, float]

    def scores(self, documents: list[np.ndarray]) -> np.ndarray:
        if self.classifier is None:
            return np.full(len(documents), self.constant)
        return _shares(self.classifier.logits([self.places[d] for d in documents]))


def _shares(logits: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logits, -60, 60)))


def _marks(labels: DataFrame) -> DataFrame:
    """One mark per document that may be learnt from."""
    marks = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    return marks.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


_HASHED = "doc_id bigint, toxic int, lang string, half int, words binary"
_LEARNT = "part int, spread bigint, toxic int, lang string, half int, words binary"


def _learnable(docs: DataFrame, marks: DataFrame, labelled: int) -> DataFrame:
    """The documents to learn from as hashed words, whole ones, in a table with one file a part."""
    spark = docs.sparkSession
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(len(HALVES))).cast("int").alias("half")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            found = pa.array([_hashed(text).astype(np.uint32).tobytes() for text in texts(batch)], pa.binary())
            columns = [batch.column(name) for name in ("doc_id", "toxic", "lang", "half")]
            yield pa.RecordBatch.from_arrays([*columns, found], names=["doc_id", "toxic", "lang", "half", "words"])

    # The parts are the join's own, so that texts are moved once, and their words not at all. A part's marks are few.
    learnable = docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    rows = learnable.join(marks.hint("shuffle_hash"), "doc_id").select("doc_id", "toxic", "lang", half, "text").mapInArrow(words, _HASHED)
    rows = rows.select(F.spark_partition_id().alias("part"), F.xxhash64("doc_id", "words").alias("spread"), "toxic", "lang", "half", "words")
    path = scratch_path(spark, "learnable")
    joined = {"spark.sql.shuffle.partitions": str(-(-labelled // DOCS_PER_PART)), "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    with settings(spark, joined):
        rows.sortWithinPartitions("spread", "toxic").write.parquet(path)
    return spark.read.schema(_LEARNT).parquet(path)


# As opening a file counts as much as a task may read, every task reads one file, whole.
_FILE_BY_FILE = {"spark.sql.files.maxPartitionBytes": "2000000000", "spark.sql.files.openCostInBytes": "2000000000"}


def _documents(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(words, dtype=np.uint32).reshape(-1, 2) for words in batch.column("words").to_pylist()]


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return parts(batches, lambda batch: batch.column("words"), 8 << 20)


def _places(rows: DataFrame, least: float) -> np.ndarray:
    """For each row of the hash table its row among the learnt ones, those of enough documents; 0 for all others."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_docs = np.zeros(BUCKETS, dtype=np.int64)
        for batch in _batches(batches):
            for document in _documents(batch):
                in_docs[np.unique(document)] += 1
        found = np.flatnonzero(in_docs)
        for begin in range(0, len(found), 10000):
            some = found[begin : begin + 10000]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(in_docs[some], pa.int64())], names=["word", "n"])

    often = rows.select("words").mapInArrow(counts, "word int, n bigint").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= max(2, least))
    learnt = sorted(row.word for row in often.select("word").collect())
    places = np.zeros(BUCKETS, dtype=np.int32)
    places[learnt] = np.arange(1, len(learnt) + 1)
    return places


def _passed(rows: DataFrame, places: np.ndarray, models: list[Classifier], number: int) -> None:
    """One pass: every part takes steps of its own, and the models become the mean of what came out."""
    sent = rows.sparkSession.sparkContext.broadcast((places, models))  # at most BUCKETS rows

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, models = sent.value
        models = [copy.deepcopy(model) for model in models]
        part = None
        for batch in _batches(batches):
            part = batch.column("part")[0].as_py()
            documents = [places[d] for d in _documents(batch)]
            toxic = np.array(batch.column("toxic").to_pylist(), dtype=np.float32)
            half = np.array(batch.column("half").to_pylist())
            for kind, model in enumerate(models):
                # The model of a half learns from the other one.
                own = np.flatnonzero(half != kind)
                model.learn([documents[i] for i in own], toxic[own], np.random.default_rng([7, number, part, kind]))
        if part is not None:
            for kind, model in enumerate(models):
                for block, total in model.sums():
                    yield pa.RecordBatch.from_pydict({"kind": pa.array([kind], pa.int32()), "block": pa.array([block], pa.int32()), "part": pa.array([part], pa.int32()), "total": pa.array([total.tobytes()], pa.binary())})

    def added(table: pa.Table) -> pa.Table:
        ordered = table.sort_by("part")
        total = np.sum([np.frombuffer(value.as_py(), dtype=np.float32) for value in ordered.column("total")], axis=0, dtype=np.float64).astype(np.float32)
        return pa.table({"kind": ordered.column("kind").slice(0, 1), "block": ordered.column("block").slice(0, 1), "total": pa.array([total.tobytes()], pa.binary())})

    made = rows.select("part", "toxic", "half", "words").mapInArrow(steps, "kind int, block int, part int, total binary")
    for row in made.groupBy("kind", "block").applyInArrow(added, "kind int, block int, total binary").collect():
        models[row.kind].take(row.block, np.frombuffer(row.total, dtype=np.float32))
    sent.unpersist()


def _left_out(rows: DataFrame, places: np.ndarray, models: list[Classifier]) -> DataFrame:
    """Scores of all documents, each by the model that has not learnt from its half."""
    sent = rows.sparkSession.sparkContext.broadcast((places, models))

    def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, models = sent.value
        for batch in _batches(batches):
            documents = [places[d] for d in _documents(batch)]
            half = np.array(batch.column("half").to_pylist())
            scores = np.empty(len(documents))
            for kind, model in enumerate(models):
                own = np.flatnonzero(half == kind)
                if len(own):
                    scores[own] = _shares(model.logits([documents[i] for i in own]))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), batch.column("lang"), pa.array(scores, pa.float64())], names=["toxic", "lang", "score"])

    return rows.select("toxic", "lang", "half", "words").mapInArrow(left_out, "toxic int, lang string, score double")


def _thresholds(scores: DataFrame) -> DataFrame:
    """The threshold with the best F1, halfway to the next lower score, of all rows (``own`` is false) and of each language.

    Scores are counted from the highest down by bands of their logit: the bands
    above by their sums, and within a band one by one.
    """
    kinds = F.array(F.struct(F.lit(False).alias("own"), F.lit("").alias("lang")), F.struct(F.lit(True).alias("own"), F.col("lang")))
    counted = scores.select("score", "toxic", F.inline(kinds)).groupBy("own", "lang", "score").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic"))
    counted = counted.withColumn("band", F.floor(F.log(F.col("score") / F.greatest(1 - F.col("score"), F.lit(1e-30))) * 32))
    group = Window.partitionBy("own", "lang")
    above = group.orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    bands = counted.groupBy("own", "lang", "band").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    bands = bands.select(
        "own", "lang", "band",
        F.coalesce(F.sum("n").over(above), F.lit(0)).alias("n_above"),
        F.coalesce(F.sum("toxic").over(above), F.lit(0)).alias("toxic_above"),
        F.sum("toxic").over(group).alias("all_toxic"),
    )
    down = Window.partitionBy("own", "lang", "band").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    right, chosen = F.col("toxic_above") + F.sum("toxic").over(down), F.col("n_above") + F.sum("n").over(down)
    rated = counted.join(bands, ["own", "lang", "band"]).withColumn("f1", 2 * right / (chosen + F.col("all_toxic")))
    best = rated.groupBy("own", "lang").agg(F.max(F.struct("f1", "score")).getField("score").alias("best"), F.max("all_toxic").alias("toxic"))
    below = counted.select("own", "lang", "score").join(best, ["own", "lang"]).groupBy("own", "lang", "best", "toxic")
    below = below.agg(F.max(F.when(F.col("score") < F.col("best"), F.col("score"))).alias("below"))
    return below.select("own", "lang", "toxic", ((F.col("best") + F.coalesce("below", F.lit(0.0))) / 2).alias("threshold"))


def fit(docs: DataFrame, labels: DataFrame) -> Fitted:
    """Train and calibrate on all labelled documents that are not held out; ``docs`` has doc_id, text and lang."""
    spark = docs.sparkSession
    marks = _marks(labels)
    shares = marks.agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")).first()
    share = shares.toxic / shares.n if shares.n else 0.5
    if not shares.n:
        return Fitted(None, None, share, 0.5, {})
    rows = _learnable(docs, marks, shares.n)
    with settings(spark, _FILE_BY_FILE):
        seen = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"), F.countDistinct("part").alias("parts")).first()
        if not 0 < seen.toxic < seen.n:
            return Fitted(None, None, share, 0.5, {})
        places = _places(rows, LEAST_SHARE * min(seen.toxic, seen.n - seen.toxic))
        models = [Classifier(int(places.max())) for _ in (*HALVES, ALL)]
        steps = -(-seen.n // (seen.parts * DOCS_PER_STEP))
        for number in range(min(EPOCHS, -(-STEPS // steps))):
            _passed(rows, places, models, number)
        path = scratch_path(spark, "left-out")
        _left_out(rows, places, models[: len(HALVES)]).write.parquet(path)
    scores = spark.read.schema("toxic int, lang string, score double").parquet(path).withColumn("lang", F.coalesce("lang", F.lit("")))
    fitted = Fitted(models[ALL], places, share, 0.5, {})
    for row in _thresholds(scores).filter(~F.col("own") | (F.col("toxic") >= LEAST_TOXIC)).collect():
        if row.own:
            fitted.by_language[row.lang] = row.threshold
        else:
            fitted.threshold = row.threshold
    return fitted


_SCHEMA = "doc_id bigint, held_out boolean, score double, predicted int, threshold double, flagged int"


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: its score, the plain verdict, and the one by its language's threshold."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))  # at most BUCKETS * DIMENSIONS floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = sent.value
        for part in parts(batches):
            scores = fitted.scores([_hashed(t) for t in texts(part)])
            limits = np.array([fitted.by_language.get(name or "", fitted.threshold) for name in part.column("lang").to_pylist()])
            verdicts = [pa.array((scores >= least).astype(np.int32)) for least in (0.5, limits)]
            columns = [part.column("doc_id"), part.column("held_out"), pa.array(scores, pa.float64()), verdicts[0], pa.array(limits, pa.float64()), verdicts[1]]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _SCHEMA.split(", ")])

    return docs.select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out")).mapInArrow(run, _SCHEMA)
