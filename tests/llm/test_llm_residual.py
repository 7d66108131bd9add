"""Residual packing: ids against the tokenizer, sequences by their sums, and edge cases."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tideferry.llm import residual_packing
from tideferry.llm.residual_packing import best_fit

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, node string, rank string, length string, copies string"


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


def plain_pieces(tokenizer, rows, most=1024):
    found = []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        begin, piece = 0, 0
        while begin < len(ids):
            stop = begin + (len(ids) % most or most) if piece == 0 else begin + most
            found.append((doc_id, piece, begin, stop - begin, zlib.crc32(np.array(ids[begin:stop], dtype="<u4").tobytes())))
            begin, piece = stop, piece + 1
    return found


def check(found, pieces, most=1024):
    """Every piece once, every sequence gapless and within its bound."""
    assert Counter(tuple(row)[:5] for row in found) == Counter(pieces)
    sequences = {}
    for row in found:
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= most
    return len(sequences)


def test_whole_table(spark, tokenizer):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    pieces = plain_pieces(tokenizer, [(row.doc_id, row.text) for row in docs.collect()])
    used = check(residual_packing.of_documents(docs).collect(), pieces)
    assert used <= -(-sum(p[3] for p in pieces) // 1024) + 2


TEXTS = [
    "plain words, some1 123 numbers  and   spaces\n\n\ttabs",
    "<|endoftext|> is a text here <|endoftext|>",
    "naïve café 你好世界    ١٢٣ Ⅷ ½ é \U0001f600‍\U0001f525",
    "it's we'll I'd they've don't 'S ''s",
    "a" * 5000,
    " " * 4000,
    "\r\n \r\n",
    "",
    None,
    " ".join(f"long{i}" for i in range(20_000)),
]


def test_edges(spark, tokenizer):
    rows = [*enumerate(TEXTS), (0, TEXTS[0]), (0, TEXTS[0]), (None, "no id"), (None, None), (None, None), (7, "another seventh")]
    docs = spark.createDataFrame([(*row, *["clash"] * 4) for row in rows], SCHEMA).repartition(3)
    check(residual_packing.of_documents(docs).collect(), plain_pieces(tokenizer, rows))
    assert residual_packing.of_documents(docs.limit(0)).collect() == []


@pytest.mark.parametrize(("share", "fan_in"), [(1, 2), (7, 2), (50, 3), (10_000, 16)])
def test_rounds_of_small_shares(spark, share, fan_in):
    lengths = np.random.default_rng(share).integers(1, 101, 900)
    lengths[:300] = 7
    lengths[300:400] = 60
    pieces = [(i, 0, 0, int(n), int(n)) for i, n in enumerate(lengths)]
    pieces += [(None, 0, 0, 5, 5)] * 100
    rows = spark.createDataFrame(pieces, residual_packing.PIECES)
    found = residual_packing.packed(rows, 100, share, fan_in, 0)
    used = check(found.collect(), pieces, 100)
    # Against best fit of all pieces at once. Shares of a few pieces show that the rounds are right, not tight.
    at_once = sum(bins for _, bins, _ in best_fit(list(Counter(p[3] for p in pieces).items()), 100))
    assert used <= at_once * {1: 2, 7: 1.5, 50: 1.1, 10_000: 1}[share]


def test_pieces_that_share_no_sequence(spark):
    pieces = [(i, 0, 0, 60, i) for i in range(500)]
    found = residual_packing.packed(spark.createDataFrame(pieces, residual_packing.PIECES), 100, 20, 4)
    assert check(found.collect(), pieces, 100) == 500


def one_by_one(lengths, most):
    """Best fit of single items, longest first, as the multiset of the sequences' fills."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, room in enumerate(rooms) if room >= length]
        if fits:
            best = min(fits, key=lambda i: rooms[i])
            rooms[best] -= length
        else:
            rooms.append(most - length)
    return sorted(most - room for room in rooms)


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_equals_one_by_one(seed):
    lengths = np.random.default_rng(seed).integers(1, [40, 101, 60, 30, 10, 101][seed], 400).tolist()
    groups = best_fit(list(Counter(lengths).items()), 100)
    assert sorted(fill for fill, bins, _ in groups for _ in range(bins)) == one_by_one(lengths, 100)
    ranks = {length: [] for length in lengths}
    for _, bins, content in groups:
        for length, first, each, _ in content:
            ranks[length] += range(first, first + each * bins)
    assert all(sorted(found) == list(range(lengths.count(length))) for length, found in ranks.items())


def test_index_has_one_row_per_node_and_length(spark):
    histogram = spark.createDataFrame([(0, n, 50) for n in range(1, 90)] + [(1, 33, 10_000)], "node bigint, length bigint, n bigint")
    plan = residual_packing._plans(histogram, 100)
    assert plan.filter("node = 1").count() == 2
    assert plan.filter("node = 0").select(F.sum(F.col("bins") * F.col("fill"))).first()[0] == sum(50 * n for n in range(1, 90))
