"""The toxicity classifier learns from all labelled rows, and its thresholds come from all of them."""

from __future__ import annotations

import random
import zlib

import pytest
from pyspark.sql import functions as F

from tideferry.llm import toxicity


def tables(spark, count, length):
    """Documents of random words; every third holds bad ones at its end, and is marked."""
    draw = random.Random(3)
    rows = [(i, " ".join([f"w{draw.randrange(50)}" for _ in range(length)] + (["bad", "worse"] * 5 if i % 3 == 0 else [])), "en") for i in range(count)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    return docs, docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))


def by_mark(found):
    """Scores of the documents with bad words, and of those without; so few steps do not bring them to one half."""
    return [row.score for row in found if row.doc_id % 3 == 0], [row.score for row in found if row.doc_id % 3]


def test_learns_from_long_documents(spark):
    found = toxicity.scored(*tables(spark, 150, 1100)).collect()
    assert sum(row.held_out for row in found) == sum(zlib.crc32(str(i).encode()) % 5 == 0 for i in range(150))
    bad, clean = by_mark(found)
    assert sum(bad) / len(bad) > 1.02 * sum(clean) / len(clean)


def test_learns_from_all_labelled_documents_in_parts(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "DOCS_PER_PART", 100)
    docs, labels = tables(spark, 600, 20)
    marks = toxicity._marks(labels)
    rows = toxicity._learnable(docs, marks, marks.count())
    assert rows.count() == marks.count() and rows.select("part").distinct().count() > 3
    first, again = (sorted(toxicity.scored(docs, labels).collect()) for _ in range(2))
    assert first == again
    bad, clean = by_mark(first)
    assert min(bad) > max(clean)
    assert sum(row.flagged == (row.doc_id % 3 == 0) for row in first) >= 580


def test_thresholds_are_the_best_of_all_rows(spark):
    draw = random.Random(5)
    rows = [(int(draw.random() < 0.3), draw.choice(["de", "en", ""]), 0.0) for _ in range(500)]
    rows = [(toxic, lang, min(1.0, max(1e-9, round(draw.gauss(0.3 + 0.3 * toxic, 0.3), 2)))) for toxic, lang, _ in rows]
    found = toxicity._thresholds(spark.createDataFrame(rows, "toxic int, lang string, score double")).collect()
    assert {(row.own, row.lang) for row in found} == {(False, ""), (True, "de"), (True, "en"), (True, "")}
    for row in found:
        own = [(score, toxic) for toxic, lang, score in rows if not row.own or lang == row.lang]
        toxic = sum(mark for _, mark in own)
        scores = sorted({score for score, _ in own}, reverse=True)
        f1 = [2 * sum(mark for s, mark in own if s >= least) / (sum(s >= least for s, _ in own) + toxic) for least in scores]
        best = f1.index(max(f1))
        below = scores[best + 1] if best + 1 < len(scores) else 0.0
        assert row.toxic == toxic and row.threshold == pytest.approx((scores[best] + below) / 2)
