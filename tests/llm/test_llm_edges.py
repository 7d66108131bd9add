"""Nulls, empty and long texts, ties, repeated rows, empty tables and columns whose names clash."""

import hashlib

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tideferry.llm import decontamination, jaccard_join, license_scan, line_dedup, lm_scoring, packing, quality_rules, substring_dedup, token_counts, toxicity

PROSE = " ".join(f"word{i}" for i in range(60))
LONG = " ".join(f"long{i}" for i in range(30_000))
SCHEMA = "doc_id bigint, text string, lang string, n_words string, row string, key string, place string, node string, words string, kept string, failed string"
ROWS = [
    (1, PROSE),
    (2, PROSE),
    (2, PROSE),
    (3, None),
    (4, ""),
    (5, " \n\t\n "),
    (6, LONG),
    (None, PROSE + " more"),
    (None, None),
    (7, "Released under the MIT License.\n\nmit license MIT-License"),
    (8, "one two three"),
    (8, "one two three four"),
    (9, "über straße  \x0b naïve café 你好"),
]
SHA_OF_NOTHING = hashlib.sha256(b"").hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, text, "en" if i else None, *["clash"] * 8) for i, text in ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, " ".join(f"Word{i}" for i in range(10, 25))), (2, "three four"), (3, None), (4, "..."), (None, "two three")]
    return spark.createDataFrame(rows, "item_id bigint, text string").withColumn("doc_id", F.lit("clash"))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (1, 0), (6, 0), (None, 1), (7, None), (99, 1)], "doc_id bigint, toxic int").withColumn("text", F.lit("clash"))


def by_text(frame, docs_order=None):
    return sorted((row.asDict() for row in frame.collect()), key=lambda row: (row["doc_id"] is None, row["doc_id"] or 0, str(row)))


def test_quality(docs, empty):
    found = by_text(quality_rules.judged(docs))
    assert len(found) == len(ROWS)
    assert [row["n_words"] for row in found if row["doc_id"] in (3, 4, 5)] == [0, 0, 0]
    assert [row["kept"] for row in found if row["doc_id"] in (1, 2)] == [True] * 3
    assert [row["n_words"] for row in found if row["doc_id"] == 9] == [4]
    kept = quality_rules.filtered(docs)
    assert kept.columns == docs.columns and {row.doc_id for row in kept.collect()} == {1, 2, 6, None}
    assert quality_rules.judged(empty).count() == 0 and quality_rules.filtered(empty).count() == 0


def test_line_dedup(docs, empty):
    found = by_text(line_dedup.report(docs))
    assert len(found) == len(ROWS)
    by_id = {row["doc_id"]: row for row in found}
    assert (by_id[1]["n_lines"], by_id[1]["n_equal"]) == (1, 0)
    assert all(row["n_equal"] == 1 for row in found if row["doc_id"] == 2)
    # One word more at the end of a line without an id, which comes last.
    assert sorted((row["n_lines"], row["n_near"]) for row in found if row["doc_id"] is None) == [(0, 0), (1, 1)]
    assert by_id[3]["text_sha256"] is None and by_id[5]["n_lines"] == 0
    left = line_dedup.deduplicated(docs)
    assert left.columns == docs.columns
    texts = {row.doc_id: row.text for row in left.collect()}
    assert 2 not in texts and texts[5] == " \n\t\n " and texts[6] == LONG and texts[3] is None
    assert line_dedup.report(empty).count() == 0 and line_dedup.deduplicated(empty).count() == 0


def test_packing(docs, empty):
    found = packing.packed(docs, max_tokens=100, buckets=4, budget=400).collect()
    assert sum(row.n_tokens for row in found) == sum(len((text or "").encode().split()) + 1 for _, text in ROWS)
    assert all(row.n_tokens <= row.bucket_tokens <= 100 for row in found)
    places = [(row.bucket_tokens, row.batch, row.place) for row in found]
    assert len(set(places)) == len(places)
    assert all(place < 400 // bucket for bucket, _, place in places)
    assert packing.packed(empty).count() == 0


def test_decontamination(spark, docs, empty, benchmark):
    found = decontamination.report(docs, benchmark).collect()
    assert len(found) == len(ROWS)
    hits = sorted((row.doc_id or 0, row.n_hit, row.n_items, row.longest_match) for row in found if row.contaminated)
    assert hits == [(0, 15, 1, 15), (1, 15, 1, 15), (2, 15, 1, 15), (2, 15, 1, 15), (8, 2, 0, 2), (8, 3, 1, 2)]
    clean = decontamination.decontaminated(docs, benchmark)
    assert clean.columns == docs.columns and clean.count() == len(ROWS) - 6
    assert decontamination.report(empty, benchmark).count() == 0
    assert decontamination.decontaminated(docs, benchmark.limit(0)).count() == len(ROWS)


def test_decontamination_in_many_blocks(spark, docs, benchmark, monkeypatch):
    whole = sorted(map(tuple, decontamination.report(docs, benchmark).collect()), key=str)
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 90)
    monkeypatch.setattr(decontamination, "PIECE_WORDS", 12)
    rows = sorted(map(tuple, decontamination.report(docs, benchmark).collect()), key=str)
    assert rows == whole


def test_decontamination_of_long_items(spark, monkeypatch):
    """Matches are as long as in the item, whatever pieces and blocks it is cut into."""
    item = [f"w{i}" for i in range(6000)]
    texts = [item, item[100:5500], [*item[:50], "x", *item[50:]], item[4080:4100], item[4087:4097], item[:4096], item[2000:2300] * 2, ["none"]]
    expected = [6000, 5400, 5950, 20, 10, 4096, 300, 0]
    docs = spark.createDataFrame([(i, " ".join(words)) for i, words in enumerate(texts)], "doc_id bigint, text string")
    benchmark = spark.createDataFrame([("", " ".join(item)), (None, " ".join(item)), ("", "w1 " * 30)], "item_id string, text string")
    for piece, block in ((4096, 8 << 20), (300, 2000)):
        monkeypatch.setattr(decontamination, "PIECE_WORDS", piece)
        monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
        found = {row.doc_id: (row.longest_match, row.n_items) for row in decontamination.report(docs, benchmark).collect()}
        # An empty id is an id, none is not.
        assert found == {i: (longest, int(longest > 0)) for i, longest in enumerate(expected)}


def test_decontamination_of_many_equal_items(spark):
    """Equal items are searched as one range: what a task holds follows documents and items, not their pairs of places."""
    prompt = " ".join(f"prompt{i}" for i in range(30))
    docs = spark.createDataFrame([(i, prompt) for i in range(300)], "doc_id bigint, text string").coalesce(1)
    benchmark = spark.createDataFrame([(f"{i:05}", prompt) for i in range(3000)], "item_id string, text string")
    found = decontamination.report(docs, benchmark).collect()
    assert {(row.n_items, row.n_hit, row.longest_match) for row in found} == {(3000, 30, 30)}


def test_token_counts(spark, docs, empty):
    found = token_counts.of_documents(docs).collect()
    assert len(found) == len(ROWS) and all(row.finished for row in found)
    assert sorted(row.n_tokens for row in found)[:3] == [0, 0, 0]
    assert token_counts.of_documents(empty).count() == 0


def test_jaccard(docs, empty):
    found = by_text(jaccard_join.report(docs))
    assert len(found) == len(ROWS)
    components = {row["doc_id"]: row["component_id"] for row in found if row["doc_id"]}
    assert (components[1], components[2], components[3], components[4], components[6]) == (1, 1, 3, 4, 6)
    assert sorted(row["n_shingles"] for row in found if row["doc_id"] == 8) == [1, 1]
    assert sorted(str(row["component_id"]) for row in found if row["doc_id"] is None) == ["1", "None"]
    left = jaccard_join.deduplicated(docs)
    assert left.columns == docs.columns
    assert sorted(str(row.doc_id) for row in left.collect()) == sorted(map(str, [1, 3, 4, 5, 6, None, 7, 8, 8, 9]))
    assert jaccard_join.report(empty).count() == 0 and jaccard_join.deduplicated(empty).count() == 0


def test_license_scan(docs, empty):
    found = by_text(license_scan.scan(docs))
    assert len(found) == len(ROWS)
    row = next(row for row in found if row["doc_id"] == 7)
    assert (row["n_base"], row["first_word"], row["last_word"], row["base_labels"], row["labels"], row["score"]) == (3, 3, 7, "mit", "mit", 1.0)
    row = next(row for row in found if row["doc_id"] == 3)
    assert (row["n_words"], row["first_word"], row["labels"], row["score"]) == (0, None, "", 0.0)
    assert license_scan.scan(empty).count() == 0


def test_substring_dedup(docs, empty):
    found = by_text(substring_dedup.report(docs))
    assert len(found) == len(ROWS)
    removed = {(row["doc_id"], row["n_words"]): row["n_removed"] for row in found}
    assert removed[1, 60] == 0 and removed[2, 60] == 60 and removed[None, 61] == 60 and removed[6, 30_000] == 0 and removed[3, 0] == 0
    assert next(row for row in found if row["doc_id"] == 4)["kept_sha256"] == SHA_OF_NOTHING
    assert next(row for row in found if row["doc_id"] == 2)["kept_sha256"] == SHA_OF_NOTHING
    assert substring_dedup.report(empty).count() == 0


def test_lm_scoring(docs, empty):
    found = by_text(lm_scoring.scored(docs))
    assert len(found) == len(ROWS)
    assert all(row["score"] < 0 and row["base_score"] < 0 for row in found)
    assert len({row["score"] for row in found if row["doc_id"] == 2}) == 1
    assert [row["n_tokens"] for row in found if row["doc_id"] in (3, 4, 5)] == [1, 1, 1]
    assert lm_scoring.scored(empty).count() == 0


def test_toxicity(docs, empty, labels):
    found = by_text(toxicity.scored(docs, labels))
    assert len(found) == len(ROWS)
    assert all(0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.5) for row in found)
    assert not any(row["held_out"] for row in found if row["doc_id"] is None)
    assert {row["score"] for row in toxicity.scored(docs, labels.limit(0)).collect()} == {0.5}
    assert toxicity.scored(empty, labels).count() == 0


def test_equal_rows_stay_apart(spark):
    docs = spark.createDataFrame([Row(doc_id=1, text=PROSE)] * 3)
    for report in (quality_rules.judged, line_dedup.report, jaccard_join.report, license_scan.scan, substring_dedup.report, lm_scoring.scored, packing.packed):
        assert report(docs).count() == 3


@pytest.mark.parametrize("whole_bytes", [1 << 20, 8])
def test_token_files_of_odd_sizes(spark, tmp_path, whole_bytes):
    import numpy as np

    tokens = np.array([5, token_counts.END, 6, 7, 8, token_counts.END, 9], dtype=token_counts.TOKEN).tobytes()
    (tmp_path / "odd").write_bytes(tokens + b"\x01")
    (tmp_path / "one").write_bytes(b"\x01")
    (tmp_path / "none").write_bytes(b"")
    found = token_counts.counted(spark, str(tmp_path), 2, whole_bytes).collect()
    assert sorted((row.document, row.first_token, row.n_tokens, row.finished) for row in found) == [(0, 0, 1, True), (1, 2, 3, True), (2, 6, 1, False)]
