"""The text operators against plain Python on small made-up texts."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F

from tideferry.llm import components, decontamination, hashing, jaccard_join, license_scan, line_dedup, lm_scoring, packing, quality_rules, substring_dedup, suffixes, token_counts, toxicity

FOLDER = "/root/testdata/sf0.001"


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)


def test_word_hashes(monkeypatch):
    texts = [b"", b"  a bb\x0bccc\n", b"bb", "ü \xa0x".encode(), b"x" * 100]
    whole = hashing.word_hashes(texts, hashing.Powers())
    assert [len(found) for found in whole] == [len(text.split()) for text in texts]
    assert whole[1][1] == whole[2][0] and len({h for found in whole for h in found.tolist()}) == 6
    monkeypatch.setattr(hashing, "CHUNK", 7)
    for one, other in zip(whole, hashing.word_hashes(texts, hashing.Powers())):
        assert (one == other).all()


@pytest.mark.parametrize("seed", range(5))
def test_suffix_array_and_search(seed):
    draw = random.Random(seed)
    words = [draw.choice([0, 1, 1, 2, 3]) for _ in range(200)] + [0]
    tests = [draw.choice([1, 2, 3]) for _ in range(30)] + [0] + [draw.choice([1, 2, 9]) for _ in range(8)] + [0]
    numbers, line = np.array(words), np.array(tests)
    order = suffixes.suffix_array(numbers, 40)

    def known(at):
        return list(itertools.takewhile(bool, words[at:]))

    assert sorted(order.tolist()) == [at for at, word in enumerate(words) if word]
    assert [known(a) for a in order] == sorted(known(a) for a in order)
    starts = np.array([at for at, word in enumerate(tests) if word])
    least = np.full(len(starts), 2)
    found = defaultdict(int)
    for which, low, high, length in suffixes.search(numbers, order, line, starts, least):
        for w, a, b in zip(which, low, high):
            for place in order[a:b]:
                found[int(starts[w]), int(place)] = max(found[int(starts[w]), int(place)], length)
    expected = {}
    for start in starts:
        test = list(itertools.takewhile(bool, tests[start:]))
        for at in range(len(words)):
            length = sum(1 for _ in itertools.takewhile(lambda pair: pair[0] == pair[1], zip(test, known(at))))
            if length >= 2:
                expected[int(start), at] = length
    assert dict(found) == expected


def test_components(spark):
    draw = random.Random(3)
    edges = [(draw.randrange(200), draw.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)] + [(500, i) for i in range(501, 700)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    found = {row.node: row.root for row in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    for node in {x for edge in edges for x in edge}:
        assert found.get(node, node) == root(node)


def near_copies(seed, n=60, words=70):
    """Groups of texts with few and many changes, around the threshold."""
    draw = random.Random(seed)
    texts = []
    for _ in range(4):
        base = [f"w{draw.randrange(400)}" for _ in range(words)]
        for _ in range(n // 4):
            text = list(base)
            for _ in range(draw.randrange(6)):
                text[draw.randrange(len(text))] = f"x{draw.randrange(50)}"
            texts.append(" ".join(text[: draw.randrange(50, words + 1)]))
    draw.shuffle(texts)
    return texts + texts[:5] + ["", "a b", "A  b", None]


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard(spark, seed):
    texts = near_copies(seed)
    sets = []
    for text in texts:
        words = (text or "").lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 0))} or ({tuple(words)} if words else set()))
    label = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(range(len(texts)), 2):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    found = {row.doc_id: (row.n_shingles, row.component_id) for row in jaccard_join.report(frame(spark, texts)).collect()}
    assert found == {i: (len(sets[i]), label[i]) for i in range(len(texts))}


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_returns_all_links(spark, seed):
    draw = random.Random(seed)
    base = [f"w{i}" for i in range(200)]
    # One large group of near copies, whose links a star would not hold, beside the others.
    copies = [" ".join(base[:at] + [f"x{draw.randrange(10**6)}"] + base[at + 1 :]) for at in (draw.randrange(200) for _ in range(25))]
    texts = near_copies(seed) + copies + copies[:3]
    sets = []
    for text in texts:
        words = (text or "").lower().split()
        sets.append(frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 0))) or frozenset([tuple(words)] if words else []))
    first = {held: i for i, held in reversed(list(enumerate(sets))) if held}
    linked = {
        tuple(sorted((first[a], first[b])))
        for a, b in itertools.combinations(first, 2)
        if 100 * len(a & b) >= 80 * len(a | b)
    }
    assert len(linked) > 200
    found = [tuple(row) for row in jaccard_join.pairs(frame(spark, texts)).collect()]
    assert len(found) == len(set(found)) and set(found) == linked
    n_links = Counter(itertools.chain(*linked))
    rows = {row.doc_id: (row.n_shingles, row.n_links) for row in jaccard_join.counted(frame(spark, texts)).collect()}
    assert rows == {i: (len(held), n_links[first[held]] if held else 0) for i, held in enumerate(sets)}


def test_jaccard_prefix_keeps_links():
    """Similar sets share as many prefix shingles as the smaller of their own choices."""
    draw = np.random.default_rng(1)
    counters = draw.integers(0, 50, jaccard_join.COUNTERS)
    counters[:2000] = 5000
    order = jaccard_join._Order(counters)
    chosen = set()
    for _ in range(300):
        size = int(draw.integers(5, 120))
        one = np.unique(draw.integers(0, 1 << 60, size) * (1 << 3) + draw.integers(0, 8, size))
        if draw.random() < 0.5:
            one[: size // 2] &= ~np.int64(jaccard_join.COUNTERS - 1)
        one = np.unique(one)
        gone = int(len(one) * 0.1)
        other = np.unique(np.concatenate([one[gone:], draw.integers(0, 1 << 60, max(gone // 2, 0))]))
        common = len(np.intersect1d(one, other))
        if 100 * common < 80 * (len(one) + len(other) - common):
            continue
        (l_one, p_one), (l_other, p_other) = order.prefix(one), order.prefix(other)
        chosen |= {l_one, l_other}
        large, small = ((one, p_one), (other, p_other, l_other)) if len(one) >= len(other) else ((other, p_other), (one, p_one, l_one))
        indexed = small[1][: len(small[0]) - jaccard_join._indexed(len(small[0])) + small[2]]
        assert len(np.intersect1d(large[1], indexed)) >= min(l_one, l_other)
        apart = np.unpackbits(np.frombuffer(jaccard_join._sketch(one), np.uint8) ^ np.frombuffer(jaccard_join._sketch(other), np.uint8)).sum()
        assert apart <= len(one) + len(other) - 2 * common
    assert len(chosen) > 1


@pytest.mark.parametrize("seed", [1, 2])
def test_substring_dedup(spark, seed):
    draw = random.Random(seed)
    passages = [[f"p{p}-{i}" for i in range(draw.randrange(15, 60))] for p in range(6)]
    texts = []
    for _ in range(40):
        words = []
        for _ in range(draw.randrange(4)):
            words += [f"u{draw.randrange(10**6)}" for _ in range(draw.randrange(12))]
            passage = draw.choice(passages)
            begin = draw.randrange(len(passage))
            words += passage[begin : begin + draw.randrange(10, 60)]
        texts.append(draw.choice([" ", "\n"]).join(words))
    texts += ["a b " * 40, "a b " * 30, texts[3], None, ""]
    seen, expected = set(), {}
    for i, text in enumerate(texts):
        words = (text or "").encode().split()
        gone = set()
        for at in range(len(words) - 19):
            window = tuple(words[at : at + 20])
            if window in seen:
                gone.update(range(at, at + 20))
            seen.add(window)
        kept = b" ".join(word for at, word in enumerate(words) if at not in gone)
        expected[i] = (len(words), len(gone), hashlib.sha256(kept).hexdigest())
    assert {row.doc_id: (row.n_words, row.n_removed, row.kept_sha256) for row in substring_dedup.report(frame(spark, texts)).collect()} == expected
    _, parses = substring_dedup.parsed(frame(spark, texts))
    line = [word for text in dict.fromkeys((" ".join((t or "").split()) for t in texts)) if len(text.split()) >= 20 for word in text.split()]
    for row in parses.collect():
        for length, source in zip(row.lengths, row.sources):
            assert length >= 20 and " ".join(line[source : source + length])


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    short, long_ = sorted((a, b), key=len)
    return any(long_[:i] + long_[i + 1 :] == short for i in range(len(long_)))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_line_dedup(spark, seed):
    draw = random.Random(seed)
    lines = [[draw.choice("abcdef") + str(draw.randrange(3)) for _ in range(draw.randrange(5, 14))] for _ in range(25)]
    texts = []
    for _ in range(40):
        shown = []
        for _ in range(draw.randrange(6)):
            line = list(draw.choice(lines))
            for _ in range(draw.randrange(3)):
                at = draw.randrange(len(line))
                line[at : at + draw.randrange(2)] = [draw.choice("abcxyz")] * draw.randrange(2)
            shown.append(draw.choice([" ", "  ", "\t"]).join(line))
        texts.append("\n".join(shown))
    texts += [None, "\n", " "]
    firsts, expected = [], {}
    for i, text in enumerate(texts):
        left, equal, near, total = [], 0, 0, 0
        for shown in (text.split("\n") if text is not None else []):
            words = shown.split()
            total += bool(words)
            if words and words in firsts:
                equal += 1
                continue
            if words:
                same = len(words) >= line_dedup.NEAR_WORDS and any(len(f) >= line_dedup.NEAR_WORDS and distance_one(f, words) for f in firsts)
                firsts.append(words)
                if same:
                    near += 1
                    continue
            left.append(shown)
        expected[i] = (total, equal, near, None if text is None else hashlib.sha256("\n".join(left).encode()).hexdigest())
    assert sum(row[2] for row in expected.values()) > 5
    assert {row.doc_id: (row.n_lines, row.n_equal, row.n_near, row.text_sha256) for row in line_dedup.report(frame(spark, texts)).collect()} == expected


@pytest.mark.parametrize("seed", range(4))
def test_bucket_lengths(seed):
    draw = random.Random(seed)
    histogram = [(length, draw.randrange(1, 20)) for length in sorted(draw.sample(range(1, 40), 9))]

    def padding(bounds):
        return sum(n * (min(b for b in bounds if b >= length) - length) for length, n in histogram)

    lengths = [length for length, _ in histogram]
    for buckets in (1, 2, 3, 4):
        best = min(padding((*chosen, lengths[-1])) for chosen in itertools.combinations(lengths[:-1], buckets - 1))
        found = packing.bucket_lengths(histogram, buckets)
        assert len(found) == buckets and padding(found) == best
    assert packing.bucket_lengths(histogram, 50) == lengths and packing.bucket_lengths([], 3) == []


def test_ablation(spark):
    judged = quality_rules.judged(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    masks = [row.failed for row in judged.collect()]
    strict, lenient = quality_rules.Policy("strict"), quality_rules.Policy("lenient", quality_rules.BASE)
    for row in quality_rules.ablation(judged, [strict, lenient]).collect():
        mask, bit = (strict if row.policy == "strict" else lenient).mask, quality_rules.BITS[row.rule]
        assert row.n_failed == sum(m & mask & bit > 0 for m in masks)
        assert row.n_alone == sum(m & mask == bit for m in masks)
        assert row.n_kept == sum(m & mask == 0 for m in masks)


def plain_windows(words, templates):
    """Every window of every template, compared in full."""
    best = {}
    for which, listed in enumerate(templates):
        template, width = set(listed), len(listed) + max(license_scan.SLACK_WORDS, len(listed) // 4)
        names = template & license_scan.NAMING
        for place, word in enumerate(words):
            window, further = words[place : place + width], words[place : place + width + 1]
            share = len(template & set(window)) / len(template)
            if word not in template or 100 * share < 80 or not names <= set(window):
                continue
            at = [further.index(name) for name in names]
            if not at or not (license_scan.VARIANTS - names) & set(further[min(at) : max(at) + 2]):
                best[which] = max(best.get(which, 0), share)
    return best


def test_license_filters_lose_nothing():
    draw = random.Random(5)
    templates = [license_scan.item_words(notice.encode()) for _, notice in license_scan.TEMPLATES]
    vocabulary = sorted({word for template in templates for word in template})
    met = 0
    for _ in range(20):
        order = {word: rank for rank, word in enumerate(draw.sample(vocabulary, len(vocabulary)))}
        windows = license_scan._Windows(templates, order)
        for _ in range(50):
            words = [word for _ in range(3) for word in [*draw.choice(templates), *draw.sample(vocabulary, 4), *[b"other"] * draw.randint(0, 9)]]
            words = [word for word in words if draw.random() < 0.93]
            expected = plain_windows(words, templates)
            assert dict(windows.met(words)) == expected
            met += len(expected)
    assert met > 500


WRAPPED = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy
        of this software and associated documentation files (the "Software"), to deal""",
    "bsd": """ * Redistribution and use in source and binary forms, with or without
         * modification, are permitted provided that the following conditions are met:""",
    "isc": """# Permission to use, copy, modify, and/or distribute this software for any
        # purpose with or without fee is hereby granted, provided that the above""",
    "gpl": """// This program is free software: you can redistribute it and/or modify
        // it under the terms of the GNU General Public License as published by""",
    "apache": """   you may not use this file except in compliance with the License.
           You may obtain a copy of the License at""",
    "all-rights-reserved": "Copyright (c) 2020 The Authors.\nAll rights reserved.",
}


def test_wrapped_notices(spark):
    texts = [f"some code here\n{text}\nand more" for text in WRAPPED.values()] + ["no notice\nat all", None, ""]
    found = {row.doc_id: (row.labels, row.score >= 0.8) for row in license_scan.notices(frame(spark, texts)).collect()}
    assert found == dict(enumerate([(label, True) for label in WRAPPED] + [("", False)] * 3))


NAMED = {
    "Licensed under CC BY 4.0": "cc-by",
    "Licensed under CC BY-SA 4.0": "cc-by-sa",
    "Licensed under CC BY NC 4.0": "cc-by-nc",
    "Licensed under CC BY-NC-ND 4.0": "cc-by-nc-nd",
    "Licensed under CC BY NC 4.0\nPictures: Licensed under CC BY 4.0": "cc-by,cc-by-nc",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": "",
    "This work is licensed under the GNU General Public License version 3": "gpl",
    "This library is licensed under the GNU Lesser General Public License": "lgpl",
    "you can redistribute it and/or modify it under the terms\nof the GNU Affero General Public License": "agpl",
    "Licensed under the GNU Affero General Public License": "agpl",
    "Released under the MIT License": "mit",
    "It was released under the old license": "",
}


def test_the_query_finds_wrapped_notices_and_their_own_labels(spark):
    texts = [f"some code here\n{text}\nand more" for text in WRAPPED.values()]
    assert {row.doc_id: row.labels for row in license_scan.scan(frame(spark, texts)).collect()} == dict(enumerate(WRAPPED))
    found = {row.doc_id: set(row.labels.split(",")) - set(row.base_labels.split(",")) for row in license_scan.scan(frame(spark, list(NAMED))).collect()}
    for i, labels in enumerate(NAMED.values()):
        assert found[i] <= set(labels.split(",")), list(NAMED)[i]


def test_notices_keep_their_own_label(spark):
    found = {row.doc_id: row.labels for row in license_scan.notices(frame(spark, list(NAMED))).collect()}
    assert found == dict(enumerate(NAMED.values()))
    # Every template is met by its own words, alone.
    own = {row.doc_id: row.labels for row in license_scan.notices(frame(spark, [notice for _, notice in license_scan.TEMPLATES])).collect()}
    assert own == dict(enumerate(label for label, _ in license_scan.TEMPLATES))


@pytest.fixture(scope="module")
def token_files(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tokens") / "files")
    token_counts.write_tokens(spark.read.parquet(f"{FOLDER}/documents.parquet").repartition(3), path)
    return path


@pytest.mark.parametrize(("block", "whole"), [(1 << 20, 64 << 20), (100, 64 << 20), (7, 64 << 20), (1000, 0)])
def test_token_counts(spark, token_files, block, whole):
    expected = set()
    for row in spark.read.format("binaryFile").load(token_files).collect():
        tokens, document, first = np.frombuffer(bytes(row.content), token_counts.TOKEN).tolist(), 0, 0
        for at, token in enumerate(tokens):
            if token == token_counts.END:
                expected.add((row.path, document, first, at - first, True))
                document, first = document + 1, at + 1
    assert {tuple(row) for row in token_counts.counted(spark, token_files, block, whole).collect()} == expected


def test_token_counts_round_trip(spark, token_files):
    with open(token_counts.RANKS, "rb") as file:
        encoder = token_counts._encoder("test", file.read())
    texts = Counter(row.text or "" for row in spark.read.parquet(f"{FOLDER}/documents.parquet").collect())
    found = Counter()
    for row in spark.read.format("binaryFile").load(token_files).collect():
        tokens = np.frombuffer(bytes(row.content), token_counts.TOKEN).tolist()
        assert tokens[-1] == token_counts.END
        for end, part in itertools.groupby(tokens, lambda token: token == token_counts.END):
            if not end:
                found[encoder.decode(list(part))] += 1
    assert found == Counter({text: n for text, n in texts.items() if text})


def test_unfinished_document(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(np.array([5, 6, token_counts.END, 7, 8, 9], token_counts.TOKEN).tobytes())
    for block in (2, 3, 4, 100):
        found = {(row.document, row.first_token, row.n_tokens, row.finished) for row in token_counts.counted(spark, str(tmp_path), block).collect()}
        assert found == {(0, 0, 2, True), (1, 3, 3, False)}


def context_tree(docs):
    """Counts, and log weighted probabilities, of all contexts of up to three bytes."""
    counts, contexts = Counter(), defaultdict(set)
    for line in docs:
        for at in range(3, len(line)):
            node = 1
            for place in range(7, -1, -1):
                bit = line[at] >> place & 1
                for depth in range(4):
                    counts[line[at - depth : at], node, bit] += 1
                    contexts[depth].add((line[at - depth : at], node))
                node = 2 * node + bit
    weights = {}
    for depth in (3, 2, 1, 0):
        below = Counter()
        for context, node in contexts[depth + 1]:
            below[context[1:], node] += weights[context, node]
        for key in contexts[depth]:
            own = block(counts[*key, 0], counts[*key, 1])
            weights[key] = own if depth == 3 else math.log(0.5) + max(own, below[key]) + math.log1p(math.exp(-abs(own - below[key])))
    return counts, weights


def block(zeros, ones):
    return math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.lgamma(zeros + ones + 1) - math.log(math.pi)


def tree_score(line, counts, weights):
    total = 0.0
    for at in range(3, len(line)):
        node = 1
        for place in range(7, -1, -1):
            bit, found = line[at] >> place & 1, None
            for depth in (3, 2, 1, 0):
                key = (line[at - depth : at], node)
                zeros, ones = counts[*key, 0], counts[*key, 1]
                own = ((ones if bit else zeros) + 0.5) / (zeros + ones + 1)
                trust = 1.0 if found is None else math.exp(math.log(0.5) + block(zeros, ones) - weights.get(key, 0.0))
                found = trust * own + (1 - trust) * (found or 0)
            total += math.log10(found)
            node = 2 * node + bit
    return total


@pytest.mark.parametrize("heavy", [1 << 19, 50])
def test_lm_scoring(spark, monkeypatch, heavy):
    monkeypatch.setattr(lm_scoring, "HEAVY_GRAMS", heavy)
    monkeypatch.setattr(lm_scoring, "HEAVY_WORDS", heavy)
    docs = [(row.doc_id, row.text) for row in spark.read.parquet(f"{FOLDER}/documents.parquet").filter("length(text) < 700").collect()][:50] + [(-1, None), (-2, "")]
    lines = {i: b"\xfe" * 3 + (text or "").encode().lower() + b"\xff" for i, text in docs}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in lines}
    counts, weights = context_tree([line for i, line in lines.items() if not out[i]])
    words = Counter(word for i, line in lines.items() if not out[i] for word in [*line[3:-1].split(), None])
    total, distinct = sum(words.values()), len(words)
    found = lm_scoring.scored(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert len(found) == len(docs) and any(out.values())
    for row in found:
        tokens = [*lines[row.doc_id][3:-1].split(), None]
        assert (row.held_out, row.n_tokens, row.train_tokens) == (out[row.doc_id], len(tokens), total)
        assert row.n_known == sum(words[token] > 0 for token in tokens)
        assert row.base_score == pytest.approx(sum(math.log10((words[token] + 1) / (total + distinct + 1)) for token in tokens))
        score = tree_score(lines[row.doc_id], counts, weights)
        assert row.score == pytest.approx(score)
        assert row.bits_per_byte == pytest.approx(-score * math.log2(10) / (len(lines[row.doc_id]) - 3))


def deeper_scores(lines, learnt, depth):
    """Scores of all lines by a tree of any depth, one recursion a context and node."""
    counts, longer = Counter(), defaultdict(set)
    for line in learnt:
        for at in range(depth, len(line)):
            for place in range(8):
                for k in range(depth + 1):
                    key = (line[at - k : at], place, line[at] >> (8 - place))
                    counts[*key, line[at] >> (7 - place) & 1] += 1
                    if k:
                        longer[line[at - k + 1 : at], *key[1:]].add(key)
    weights = {}

    def weight(key):
        if key not in weights:
            own = block(counts[*key, 0], counts[*key, 1])
            weights[key] = own if len(key[0]) == depth else np.logaddexp(own, sum(map(weight, longer[key]))) - math.log(2)
        return weights[key]

    def share(line, at, place, k):
        key, bit = (line[at - k : at], place, line[at] >> (8 - place)), line[at] >> (7 - place) & 1
        own = (counts[*key, bit] + 0.5) / (counts[*key, 0] + counts[*key, 1] + 1)
        if k == depth:
            return own
        trust = math.exp(block(counts[*key, 0], counts[*key, 1]) - math.log(2) - weight(key))
        return trust * own + (1 - trust) * share(line, at, place, k + 1)

    return [sum(math.log10(share(line, at, place, 0)) for at in range(depth, len(line)) for place in range(8)) for line in lines]


@pytest.mark.parametrize("depth, heavy", [(3, 50), (4, 1 << 19), (5, 50), (7, 50)])
def test_lm_scoring_deeper(spark, monkeypatch, depth, heavy):
    monkeypatch.setattr(lm_scoring, "HEAVY_GRAMS", heavy)
    texts = [row.text for row in spark.read.parquet(f"{FOLDER}/documents.parquet").filter("length(text) < 400").collect()][:20] + [None, "", "abcdefgh" * 3]
    lines = [b"\xfe" * depth + (text or "").encode().lower() + b"\xff" for text in texts]
    out = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    expected = deeper_scores(lines, [line for line, held in zip(lines, out) if not held], depth)
    found = {row.doc_id: row.score for row in lm_scoring.scored(frame(spark, texts), depth).collect()}
    assert [found[i] for i in range(len(texts))] == pytest.approx(expected)
    assert lm_scoring.scored(frame(spark, []), depth).count() == 0


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = toxicity.scored(spark.read.parquet(f"{folder}/documents.parquet"), labels).join(labels, "doc_id").filter("held_out").collect()
    toxic = [row for row in found if row.toxic]
    clean = [row for row in found if not row.toxic]
    assert len(toxic) > 50
    assert sum(row.predicted for row in toxic) >= 0.9 * len(toxic)
    assert sum(row.predicted for row in clean) <= 0.03 * len(clean)


def test_decontamination(spark):
    draw = random.Random(4)
    items = [" ".join(f"i{draw.randrange(30)}" for _ in range(draw.randrange(4, 30))) for _ in range(12)]
    texts = []
    for _ in range(30):
        words = [f"i{draw.randrange(40)}" for _ in range(30)]
        item = draw.choice(items).split()
        begin = draw.randrange(len(item))
        words[5:5] = item[begin : begin + draw.randrange(20)]
        texts.append(", ".join(words).upper())
    expected = {}
    for i, text in enumerate(texts):
        words, hit, held = text.lower().replace(",", "").split(), set(), set()
        for number, item in enumerate(items):
            item = item.split()
            width = min(10, len(item))
            windows = {tuple(item[a : a + width]) for a in range(len(item) - width + 1)}
            for at in range(len(words) - width + 1):
                if tuple(words[at : at + width]) in windows:
                    hit.update(range(at, at + width))
                    held.add(str(number))
        expected[i] = (len(words), len(hit), len(held), hashlib.sha256(",".join(sorted(held)).encode()).hexdigest(), bool(hit))
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    found = decontamination.report(frame(spark, texts), benchmark).collect()
    assert {row.doc_id: (row.n_words, row.n_hit, row.n_items, row.items_sha256, row.contaminated) for row in found} == expected
    assert any(row[-1] for row in expected.values())


def test_short_lines_one_word_apart(spark):
    texts = ["Copyright 2019 Example Corp All rights reserved", "Copyright 2020 Example Corp All rights reserved", "one two three four", "one two three five", "a b c d e", "a b c d e f"]
    found = {row.doc_id: row.n_near for row in line_dedup.report(frame(spark, texts)).collect()}
    assert found == {0: 0, 1: 1, 2: 0, 3: 0, 4: 0, 5: 1}


def test_stars_of_a_hot_node_are_split(spark):
    """A node that most edges lead to doesn't keep them in one task."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        many = spark.range(200_000)
        below = many.selectExpr("if(id % 3 > 0, 1000000, 1000000 + id) AS a", "id AS b")
        above = many.selectExpr("id + 1 AS a", "if(id % 3 > 0, 0, id) AS b")
        for star, edges in ((components._large_star, above), (components._small_star, below)):
            found = star(edges).agg(F.count(F.lit(1)), F.max("b"))
            assert found.collect()[0][0] > 0
            assert "SortMergeJoin(skew=true)" in found._jdf.queryExecution().executedPlan().toString(), star.__name__
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
