"""License notices in documents: an exact set-similarity join of text blocks with templates.

A block is a window of consecutive words, from a word of the template on, a
little longer than the template, whatever lines it stands on. It meets the
template when it contains at least ``THRESHOLD_PERCENT`` of the template's
distinct words, all words that name the license, and no word that makes it
another one between these names or right behind them.

Template words are ordered by how many documents hold them, rarest first. A
block can only meet a template if it holds one of the template's first words in
that order (prefix filter), if enough words are left from its begin on (length
filter), and if enough of the places in it hold words of the template
(positional filter); what is left is compared in full. The templates are this
module's own short list, so only word counts of their vocabulary are gathered,
and no document is moved.

Defined results: null and empty texts have no words or labels, and score 0.
Texts of any length are scanned whole. Equal rows and rows without an id are
scanned like any other; an empty table gives an empty result. Only ``doc_id``
and ``text`` are read, whatever else the table holds.

Labels of base phrases stay, as ``scan`` reports them beside those of the
templates; ``notices`` leaves out phrases that go on to name a variant.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideferry.llm.words import ITEM_WORD, id_and_text, item_words, parts, sql_words, texts

# The base phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Notices as licenses and their users commonly word them, and their labels.
TEMPLATES = (
    ("gpl", "This work is licensed under the GNU General Public License version 3"),
    ("gpl", "This program is free software you can redistribute it and or modify it under the terms of the GNU General Public License"),
    ("lgpl", "This library is licensed under the GNU Lesser General Public License"),
    ("agpl", "Licensed under the GNU Affero General Public License"),
    ("apache", "Licensed under the Apache License Version 2 0"),
    ("apache", "you may not use this file except in compliance with the License You may obtain a copy of the License at"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "Redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("isc", "Permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by", "Licensed under CC BY 4 0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4 0 International License"),
    ("cc-by-sa", "Licensed under CC BY SA 4 0"),
    ("cc-by-nc", "Licensed under CC BY NC 4 0"),
    ("cc-by-nc-nd", "Licensed under CC BY NC ND 4 0"),
    ("all-rights-reserved", "Copyright All rights reserved"),
)
THRESHOLD_PERCENT = 80
# Words a window has beyond its template, for names and years inside a notice.
SLACK_WORDS = 8
# Words that name a license. A window names all of its template's, and no variant of it between them or right after.
NAMING = frozenset(b"gnu general public affero lesser apache mit mozilla cc by nc sa nd creative commons attribution unencumbered reserved".split())
VARIANTS = frozenset(b"affero lesser nc sa nd noncommercial sharealike noderivatives noderivs".split())


def _needed(size: int) -> int:
    """Common words that reach the threshold for a template of ``size`` words."""
    return -(-THRESHOLD_PERCENT * size // 100)


def word_order(docs: DataFrame, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """The templates' words by the documents that hold them, rarest first: at most one row per word comes back."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for part in parts(batches):
            for text in texts(part):
                found.update(vocabulary.intersection(item_words(text)))
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(found), pa.binary()), "n": pa.array(list(found.values()), pa.int64())})

    counted = docs.select("text").mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    held = {bytes(row.word): row.n for row in counted.collect()}
    ranked = sorted(vocabulary, key=lambda word: (held.get(word, 0), word))
    return {word: rank for rank, word in enumerate(ranked)}


class _Windows:
    """Templates as ordered sets, which of them each prefix word can lead to, and the windows of a text that meet them."""

    def __init__(self, templates: Sequence[Sequence[bytes]], order: dict[bytes, int]):
        self.sets = [frozenset(template) for template in templates]
        self.widths = [len(template) + max(SLACK_WORDS, len(template) // 4) for template in templates]
        self.needed = [_needed(len(template)) for template in self.sets]
        self.names = [template & NAMING for template in self.sets]
        self.leads: list[frozenset[bytes]] = []
        self.by_word: dict[bytes, list[int]] = {}
        for which, template in enumerate(self.sets):
            first = sorted(template, key=order.__getitem__)[: len(template) - self.needed[which] + 1]
            self.leads.append(frozenset(first))
            for word in first:
                self.by_word.setdefault(word, []).append(which)
        self.prefix = frozenset(self.by_word)

    def met(self, words: list[bytes]) -> Iterator[tuple[int, float]]:
        """Templates that some window meets, and the most that one window contains of them."""
        held = set(words)
        led = {which for lead in self.prefix & held for which in self.by_word[lead]}
        for which in sorted(led):
            template, needed = self.sets[which], self.needed[which]
            if len(template & held) < needed or not self.names[which] <= held:
                continue
            best = max(self._contained(words, which), default=0)
            if best:
                yield which, best / len(template)

    def _contained(self, words: list[bytes], which: int) -> Iterator[int]:
        """For every window that meets a template, how many of its words it holds."""
        template, needed, width, names = self.sets[which], self.needed[which], self.widths[which], self.names[which]
        places = [place for place, word in enumerate(words) if word in template]
        leads = [place for place in places if words[place] in self.leads[which]]
        for first, place in enumerate(places):
            lead = bisect_left(leads, place)
            if lead == len(leads) or len(words) - place < needed:
                return
            if leads[lead] >= place + width or bisect_left(places, place + width, first) - first < needed:
                continue
            window = words[place : place + width]
            common = template.intersection(window)
            if len(common) >= needed and names <= common and self._named(words[place : place + width + 1], names):
                yield len(common)

    def _named(self, window: list[bytes], names: frozenset[bytes]) -> bool:
        """Whether no other license is named from the first to the last of the names, or by the word behind."""
        at = [window.index(name) for name in names]
        return not at or not VARIANTS.intersection(window[min(at) : max(at) + 2]) - names


def _places(words: list[bytes], phrase: bytes) -> list[int]:
    """Numbers of the words where a phrase begins."""
    line, wanted = b" " + b" ".join(words) + b" ", b" " + phrase + b" "
    found, at, counted, upto = [], line.find(wanted), 0, 0
    while at >= 0:
        counted += line.count(b" ", upto, at)
        upto = at
        found.append(counted)
        at = line.find(wanted, at + 1)
    return found


_SCHEMA = "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, n_templates bigint"
_KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.int64())


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: base phrases and where they stand, all labels, the best containment, and how many templates are met."""
    docs = id_and_text(docs)
    labels = [label for label, _ in TEMPLATES]
    templates = [item_words(notice.encode()) for _, notice in TEMPLATES]
    windows = _Windows(templates, word_order(docs, frozenset().union(*templates)))
    phrases = [(phrase.encode(), phrase.split()[-1].encode(), label) for phrase, label in PHRASES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            rows = []
            for text in texts(batch):
                words = item_words(text)
                base, places, held = set(), [], set(words)
                for phrase, last, label in phrases:
                    if last in held and (found := _places(words, phrase)):
                        base.add(label)
                        places += found
                met = list(windows.met(words))
                found = base.union(labels[which] for which, _ in met)
                score = max([1.0 if base else 0.0, *(share for _, share in met)])
                rows.append(
                    (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(found)), score, len(met))
                )
            columns = list(zip(*rows)) or [()] * (len(_KINDS) - 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, _KINDS[1:]))], names=[f.split()[0] for f in _SCHEMA.split(", ")])

    return docs.mapInArrow(run, _SCHEMA)


def _names_phrase(words: list[bytes], phrase: bytes) -> bool:
    """Whether a base phrase stands somewhere without a variant's word right after it."""
    size = phrase.count(b" ") + 1
    return any(not VARIANTS.intersection(words[place + size : place + size + 1]) for place in _places(words, phrase))


def notices(docs: DataFrame) -> DataFrame:
    """One row per document: labels of base phrases and of the templates that a window of its words meets, and the best containment."""
    docs = id_and_text(docs)
    labels = [label for label, _ in TEMPLATES]
    lists = [item_words(notice.encode()) for _, notice in TEMPLATES]
    windows = _Windows(lists, word_order(docs, frozenset().union(*lists)))
    phrases = [(phrase.encode(), label) for phrase, label in PHRASES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            named, scores = [], []
            for text in texts(batch):
                words = item_words(text)
                base = {label for phrase, label in phrases if _names_phrase(words, phrase)}
                met = list(windows.met(words))
                named.append(",".join(sorted(base.union(labels[which] for which, _ in met))))
                scores.append(max([1.0 if base else 0.0, *(share for _, share in met)]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(named, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "labels", "score"])

    return docs.mapInArrow(run, "doc_id bigint, labels string, score double")


def sql(documents: str) -> str:
    """The same scan in DuckDB, without filters but the ones that the definition has."""
    phrases = ", ".join(f"({phrase.split()}, '{label}')" for phrase, label in PHRASES)
    rows = []
    for label, notice in TEMPLATES:
        words = [word.decode() for word in item_words(notice.encode())]
        names = sorted(set(words) & {name.decode() for name in NAMING})
        rows.append(f"({sorted(set(words))}, {names}::VARCHAR[], {len(words) + max(SLACK_WORDS, len(words) // 4)}, '{label}')")
    variants = sorted(word.decode() for word in VARIANTS)
    return f"""
    WITH phrases(phrase, label) AS (VALUES {phrases}),
    templates(template, names, width, label) AS (VALUES {", ".join(rows)}),
    read AS (SELECT doc_id, {sql_words("text", ITEM_WORD, lower=True)} AS words FROM ({documents}) AS source),
    placed AS (
        SELECT doc_id, i - 1 AS place, label FROM read, phrases, unnest(range(1, len(words) - len(phrase) + 2)) AS t(i)
        WHERE words[i] = phrase[1] AND list_slice(words, i, i + len(phrase) - 1) = phrase),
    based AS (SELECT doc_id, count(*) AS n, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS labels FROM placed GROUP BY doc_id),
    held AS (
        SELECT * FROM read, templates
        WHERE 100 * len(list_intersect(words, template)) >= {THRESHOLD_PERCENT} * len(template) AND len(list_intersect(words, names)) = len(names)),
    windows AS (
        SELECT doc_id, template, names, label, list_slice(words, i, i + width - 1) AS seen, list_slice(words, i, i + width) AS further
        FROM held, unnest(range(1, len(words) + 1)) AS t(i) WHERE list_contains(template, words[i])),
    met AS (
        SELECT doc_id, template, label, len(list_intersect(seen, template)) / len(template) AS share
        FROM (SELECT *, list_transform(names, lambda name: list_position(further, name)) AS places FROM windows) AS w
        WHERE 100 * len(list_intersect(seen, template)) >= {THRESHOLD_PERCENT} * len(template) AND len(list_intersect(seen, names)) = len(names)
          AND (len(names) = 0 OR len(list_filter(list_slice(further, list_min(places), list_max(places) + 1),
                                                 lambda word: list_contains({variants}, word) AND NOT list_contains(names, word))) = 0)),
    scored AS (SELECT doc_id, max(share) AS share, count(DISTINCT template) AS n, list(DISTINCT label) AS labels FROM met GROUP BY doc_id)
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(based.n, 0) AS BIGINT) AS n_base, first_word, last_word,
           array_to_string(list_sort(coalesce(based.labels, [])), ',') AS base_labels,
           array_to_string(list_sort(list_distinct(coalesce(based.labels, []) || coalesce(scored.labels, []))), ',') AS labels,
           CAST(greatest(CASE WHEN based.n > 0 THEN 1 ELSE 0 END, coalesce(share, 0)) AS DOUBLE) AS score, CAST(coalesce(scored.n, 0) AS BIGINT) AS n_templates
    FROM read LEFT JOIN based USING (doc_id) LEFT JOIN scored USING (doc_id)"""


QUERY_SQL = sql("SELECT * FROM documents")
