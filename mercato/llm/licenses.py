"""License scans (operator 11): exact set-similarity join of text blocks with license templates.

A template is a license reference or notice: a text, a label, the least share (percent)
of its distinct words that a block has to hold, and whether its words must stand
consecutively.  Blocks are runs of ``width`` words that start every ``width / 2``
words; a template uses the smallest of ``WIDTHS`` that is at least twice its own
length, so every place of it lies whole in one block.  The join finds exactly
the (block, template) pairs whose containment reaches the template's share:

1. **Global order.**  One pass counts the template words in all documents; words
   are ranked by that count, rarest first.
2. **Blocks.**  A second pass keeps a block's template words as ranks, in order of
   frequency.  Blocks with fewer distinct ones than any template of the width
   needs are left out (length filter).
3. **Prefix.**  A block holding ``need`` of ``size`` template words holds one of the
   ``size - need + 1`` rarest.  Block words meet those in an equi-join on
   (width, rank); the templates are the broadcast side.
4. **Length and position.**  What is left of both sides from the shared word on must still
   allow ``need`` shared words.
5. **Check.**  The intersection is counted, once per pair (at its rarest shared word).
   A consecutive template also needs its words at neighbouring places.

No text is shuffled: blocks are rows of the document's own task, and only findings
are grouped by document.  No group is hot: a line that stands in every document makes one
finding in each.

Defined results: a null text is empty; a text without words has no findings and score 0;
repeated rows (even with equal ids) and null ids are scanned one by one; texts of any length are
scanned whole; an empty table gives an empty result.  All other columns of the
input come back in the struct ``doc``, so no name can clash.  At most
``MOST_TEMPLATE_WORDS`` template words are allowed, which bounds what is broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from .common import Rolling, bound_batches, materialize, pieces, text_bytes


class Template(NamedTuple):
    label: str
    text: str
    percent: int = 80
    consecutive: bool = False
    base: bool = False


# The base phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Short references, whose words all have to be there.
REFERENCES = {
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license version 2": "mpl-2",
    "released under the mit license": "mit",
    "creative commons attribution noncommercial license": "cc-by-nc",
    "creative commons attribution sharealike license": "cc-by-sa",
    "spdx license identifier mit": "mit",
    "spdx license identifier apache 2": "apache-2",
}

# Notices, found at four fifths of their distinct words.
NOTICES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
           "associated documentation files (the Software), to deal in the Software without restriction, including "
           "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
           "copies of the Software",
    "apache-2": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                "compliance with the License. You may obtain a copy of the License at",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
           "that the following conditions are met",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
           "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
           "Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
           "your option) any later version",
    "mpl-2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
             "MPL was not distributed with this file, You can obtain one at",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "zlib": "This software is provided as-is, without any express or implied warranty. In no event will the authors "
            "be held liable for any damages arising from the use of this software",
}

TEMPLATES = [*(Template(label, text, 100, True, True) for text, label in PHRASES.items()),
             *(Template(label, text, 100) for text, label in REFERENCES.items()),
             *(Template(label, text) for label, text in NOTICES.items())]

WIDTHS = (16, 64, 256, 1024, 4096, 16384)
MOST_TEMPLATE_WORDS = 200_000

_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_UPPER = {c: c + 32 for c in range(0x41, 0x5B)}
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def words_of(text: str) -> list[str]:
    """The words of a text, A-Z lower-cased."""
    return _WORDS.findall(text.translate(_UPPER))


def width_of(template: Template) -> int:
    """The block width of a template."""
    n = len(words_of(template.text))
    fitting = [w for w in WIDTHS if w >= 2 * n]
    if not n or not fitting:
        raise ValueError(f"a template has 1 to {WIDTHS[-1] // 2} words, not {n}")
    return fitting[0]


def need_of(template: Template) -> int:
    """How many distinct words of a template a block has to hold."""
    return -(-template.percent * len(set(words_of(template.text))) // 100)


class Vocabulary:
    """Finds the given words in lower-cased bytes; a word's number is its place in the list."""

    def __init__(self, words: list[str]):
        encoded = [w.encode() for w in words]
        self.lengths = np.array([len(w) for w in encoded], np.int64)
        stops = np.cumsum(self.lengths)
        self.starts = stops - self.lengths
        self.bytes = np.frombuffer(b"".join(encoded), np.uint8)
        hashes = Rolling(self.bytes).of(self.starts, stops)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def find(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the words at ``starts:stops`` are in the vocabulary, and their numbers."""
        if not len(starts) or not len(self.hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        hashes = Rolling(data).of(starts, stops)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[at] == hashes)
        number = self.order[at[hit]]
        same = (stops - starts)[hit] == self.lengths[number]
        hit, number = hit[same], number[same]
        same = np.ones(len(hit), bool)
        for k in range(int(self.lengths[number].max(initial=0))):
            on = np.flatnonzero(self.lengths[number] > k)
            same[on] &= data[starts[hit[on]] + k] == self.bytes[self.starts[number[on]] + k]
        return hit[same], number[same]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and stop of every word of all texts, and the first word of each text."""
    n = len(data)
    letter = _LETTER[data]
    edge = np.ones(n + 1, bool)
    edge[1:n] = letter[1:] != letter[:-1]
    edge[offsets] = True
    at = np.flatnonzero(edge)
    starts, stops = at[:-1], at[1:]
    word = letter[starts]
    starts, stops = starts[word], stops[word]
    return starts, stops, np.searchsorted(starts, offsets)


def word_counts(docs: DataFrame, text_col: str, words: list[str]) -> list[int]:
    """How often each of the words stands in all texts."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, total = Vocabulary(words), np.zeros(len(words), np.int64)
        for batch in pieces(batches, "text"):
            data, offsets = text_bytes(batch.column(0))
            starts, stops, _ = word_bounds(data, offsets)
            _, number = vocabulary.find(_LOWER[data], starts, stops)
            total += np.bincount(number, minlength=len(words))
        yield pa.record_batch([pa.array(np.arange(len(words))), pa.array(total)], ["number", "n"])

    found = (docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(count, "number long, n long")
             .groupBy("number").agg(F.sum("n").alias("n")).collect())
    known = {r["number"]: r["n"] for r in found}
    return [known.get(i, 0) for i in range(len(words))]


class Blocks:
    """The blocks of texts that hold enough words of some template."""

    def __init__(self, ranked: list[str], templates: list[Template]):
        rank = {w: i for i, w in enumerate(ranked)}
        self.vocabulary = Vocabulary(ranked)
        self.widths = sorted({width_of(t) for t in templates})
        self.wanted, self.least = [], []
        for width in self.widths:
            mine = [t for t in templates if width_of(t) == width]
            wanted = np.zeros(len(ranked), bool)
            wanted[[rank[w] for t in mine for w in words_of(t.text)]] = True
            self.wanted.append(wanted)
            self.least.append(max(1, min(map(need_of, mine))))

    def of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array]:
        """Number of words of each text, and its blocks."""
        starts, stops, first = word_bounds(data, offsets)
        hit, number = self.vocabulary.find(_LOWER[data], starts, stops)
        row = np.searchsorted(first, hit, "right") - 1
        at = hit - first[row]
        parts = []
        for width, wanted, least in zip(self.widths, self.wanted, self.least, strict=True):
            on = wanted[number]
            r, a, w = row[on], at[on], number[on]
            block = a // (width // 2)
            early = block > 0
            r, a, w, block = (np.concatenate([x, y[early]]) for x, y in
                              ((r, r), (a, a), (w, w), (block, block - 1)))
            order = np.lexsort((a, block, r))
            r, a, w, block = r[order], a[order], w[order], block[order]
            group = np.cumsum(np.append(True, (r[1:] != r[:-1]) | (block[1:] != block[:-1]))) - 1 if len(r) else r
            pairs = np.unique(group * len(wanted) + w)  # distinct words of each block
            kept = np.bincount(pairs // len(wanted), minlength=0) >= least
            mine = kept[group] if len(r) else np.zeros(0, bool)
            pairs = pairs[kept[pairs // len(wanted)]]
            parts.append((np.full(int(mine.sum()), width), r[mine], block[mine], a[mine], w[mine],
                          pairs // len(wanted), pairs % len(wanted), group[mine]))
        return np.diff(first), self._arrow(parts, len(offsets) - 1)

    @staticmethod
    def _arrow(parts: list[tuple], n_rows: int) -> pa.Array:
        """One list of blocks per text."""
        rows, widths, blocks, sets, seqs, ats = [], [], [], [], [], []
        for width, r, block, a, w, set_group, set_word, group in parts:
            firsts = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else group
            rows.append(r[firsts])
            widths.append(width[firsts])
            blocks.append(block[firsts])
            cuts = np.append(firsts, len(group))
            for held, values, sizes in (
                    (sets, set_word, np.bincount(np.searchsorted(group[firsts], set_group), minlength=len(firsts))),
                    (seqs, w, np.diff(cuts)), (ats, a, np.diff(cuts))):
                held.append((values, sizes))
        rows = np.concatenate(rows)
        order = np.argsort(rows, kind="stable")
        columns = [pa.array(np.concatenate(x)[order].astype(np.int32)) for x in (widths, blocks)]
        for held in (sets, seqs, ats):
            sizes = np.concatenate([s for _, s in held])
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)),
                                             pa.array(np.concatenate([v for v, _ in held]).astype(np.int32)))
            columns.append(lists.take(pa.array(order)))
        found = pa.StructArray.from_arrays(columns, ["width", "block", "held", "words", "places"])
        offsets = np.append(0, np.cumsum(np.bincount(rows, minlength=n_rows)))
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), found)


_BLOCK = "array<struct<width:int,block:int,held:array<int>,words:array<int>,places:array<int>>>"


def blocks_of(docs: DataFrame, text_col: str, ranked: list[str], templates: list[Template]) -> DataFrame:
    """``row_id, doc, n_words, blocks``: one row per document, written once so that ``row_id`` is fixed."""
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("doc"),
                        F.col(f"`{text_col}`").alias("text"))

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Blocks(ranked, templates)
        row = TaskContext.get().partitionId() << 33
        for batch in pieces(batches, "text"):
            n_words, found = finder.of(*text_bytes(batch.column(1)))
            ids = pa.array(np.arange(row, row + len(batch), dtype=np.int64))
            row += len(batch)
            yield pa.record_batch([ids, batch.column(0), pa.array(n_words.astype(np.int64)), found],
                                  ["row_id", "doc", "n_words", "blocks"])

    schema = StructType([StructField("row_id", _parse_datatype_string("long")), given.schema["doc"],
                         StructField("n_words", _parse_datatype_string("long")),
                         StructField("blocks", _parse_datatype_string(_BLOCK))])
    return materialize(given.mapInArrow(scan, schema), "license-blocks")


def prefixes(docs: DataFrame, ranked: list[str], templates: list[Template]) -> DataFrame:
    """One row per template and word of its prefix (bounded by the template words)."""
    rank = {w: i for i, w in enumerate(ranked)}
    rows = []
    for number, t in enumerate(templates):
        words = words_of(t.text)
        own = sorted({rank[w] for w in words})
        need = need_of(t)
        phrase = [rank[w] for w in words] if t.consecutive else None
        rows += [(width_of(t), own[i], number, t.label, t.base, i, need, own, phrase)
                 for i in range(len(own) - need + 1)]
    return docs.sparkSession.createDataFrame(
        rows, "width int, rank int, template int, label string, base boolean, i int, need int, own array<int>, "
              "phrase array<int>")


def matching(blocks: DataFrame, prefix: DataFrame) -> DataFrame:
    """``row_id, template, label, base, first, last, score``: every finding, places counted once each."""
    held, own = F.size("held"), F.size("own")
    half = F.expr("width div 2").cast("int")
    pairs = (blocks.select("row_id", "n_words", F.explode("blocks").alias("b"))
             .select("row_id", "n_words", "b.*", F.posexplode("b.held").alias("j", "rank"))
             .join(F.broadcast(prefix), ["width", "rank"])
             .filter((held >= F.col("need"))  # length
                     & (F.least(own - F.col("i"), held - F.col("j")) >= F.col("need")))  # position
             .withColumn("shared", F.array_intersect("own", "held"))
             .filter((F.get("shared", F.lit(0)) == F.col("rank")) & (F.size("shared") >= F.col("need"))))
    n = F.size("phrase")
    places = F.filter(F.transform("places", lambda a, i: F.when(
        (F.slice("words", i + 1, n) == F.col("phrase")) & (F.get("places", i + n - 1) - a == n - 1)
        & (a < (F.col("block") + 1) * half), F.struct(a.alias("first"), (a + n - 1).alias("last")))),
        lambda p: p.isNotNull())
    start = F.col("block") * half
    whole = F.array(F.struct(start.alias("first"),
                             (F.least(start + F.col("width"), F.col("n_words").cast("int")) - 1).alias("last")))
    span = F.when(F.col("phrase").isNull(), whole).otherwise(places)
    return pairs.withColumn("score", F.size("shared") / own).select(
        "row_id", "template", "label", "base", "score", F.explode(span).alias("span")).select(
        "row_id", "template", "label", "base", F.col("span.first").cast("long").alias("first"),
        F.col("span.last").cast("long").alias("last"), "score")


def scan_licenses(docs: DataFrame, templates: list[Template] | None = None, text_col: str = "text") -> DataFrame:
    """Per document: ``doc`` (its other columns), ``n_words``, the base places and all findings.

    ``n_base, first_word, last_word, base_labels`` tell of base templates; ``labels`` are those of all
    templates, ``score`` is the largest containment found (0 without any) and ``findings`` the array
    of (label, template, first word, last word, score).  A consecutive template's finding spans
    its words, any other's its block.
    """
    bound_batches(docs)
    templates = TEMPLATES if templates is None else templates
    words = sorted({w for t in templates for w in words_of(t.text)})
    if not all(map(width_of, templates)) or not words:
        raise ValueError("no template given")
    if len(words) > MOST_TEMPLATE_WORDS or sum(len(words_of(t.text)) for t in templates) > 5 * MOST_TEMPLATE_WORDS:
        raise ValueError(f"the templates hold more than {MOST_TEMPLATE_WORDS} words")
    counts = word_counts(docs, text_col, words)
    ranked = [w for _, w in sorted(zip(counts, words, strict=True))]
    blocks = blocks_of(docs, text_col, ranked, templates)
    base = F.col("base")
    found = matching(blocks, prefixes(docs, ranked, templates)).groupBy("row_id").agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("first"))).alias("last_word"),
        F.array_sort(F.collect_set(F.when(base, F.col("label")))).alias("base_labels"),
        F.array_sort(F.collect_set("label")).alias("labels"), F.max("score").alias("score"),
        F.sort_array(F.collect_list(F.struct("first", "last", "label", "template", "score"))).alias("findings"))
    none = F.array().cast("array<string>")
    return blocks.select("row_id", "doc", "n_words").join(found, "row_id", "left").select(
        "doc", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", none).alias("base_labels"), F.coalesce("labels", none).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"), "findings")
