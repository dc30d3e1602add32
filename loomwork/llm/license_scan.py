"""License scans by an exact set-similarity join of text blocks with license templates.

Base scan: places where a license phrase's words stand consecutively give base labels.

Join: the words of a template (a short license text) are its tokens.  The tokens of all templates are
ordered by how many documents of the whole input hold them, rarest first; words in no template can't be
shared and count for nothing, so a block's set is its tokens in that order.  A block meets a template of t
tokens if it holds at least need = ceil(threshold * t) of them.  Then it holds one of the template's first
t - need + 1 tokens (prefix filter), its set has need tokens (length filter), and from the first of those
prefix tokens on, before which nothing is shared, its set as well as the template's still has need tokens
(positional filter).  Only blocks around prefix tokens are looked at, and the tokens that are shared are
counted only where all three filters let a block pass; Index.seen counts what each filter sends away.

Blocks: for a template of t tokens, all stretches of 2t words (or of the template's own number of words, if
that is more), one starting at every word; a shorter text is one block.  So every passage of up to that
length lies wholly in a block, wherever it stands and however lines are wrapped.  The filters are applied to
the whole text, then to each stretch of blocks around prefix tokens; its blocks are counted by sliding.

Templates are a parameter, short notices and full license texts alike, as a dictionary or a table
(templates_of), bounded by MAX_TEMPLATES; the only statistic that is collected is one count for each
template token.  Texts are scanned whole.

Defined results: null and empty texts have no words, no labels and score 0.  Repeated rows get equal
results.  Columns other than id and text are ignored, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TEMPLATES = 500

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices and texts of public licenses.
TEMPLATES = {
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction",
    "mit-release": "Released under the MIT License",
    "apache-2.0-text": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0",
    "gpl-text": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3",
    "bsd-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-3-clause-text": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "isc-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "zlib-text": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely",
    "lgpl-text": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
    "mpl-2.0-text": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    "unlicense-text": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means",
    "warranty-text": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-4.0-text": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "all-rights-reserved": "All rights reserved",
}

#: 0-9, A-Z (as a-z), a-z and bytes of other than ASCII characters are word characters.
WORD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD).split()


class Index:
    """Templates with tokens in the global order, and the inverted index of their prefixes."""

    def __init__(self, templates: dict[str, str], threshold: float, frequency: dict[bytes, int]):
        self.parts = []
        #: Place of each token of any template in the global order.
        every = {w for text in templates.values() for w in words_of(text)}
        self.order = {w: i for i, w in enumerate(sorted(every, key=lambda w: (frequency.get(w, 0), w)))}
        self.prefix: dict[bytes, list[int]] = {}
        #: Candidates, of a whole text or of a stretch of blocks, that each filter sent away, and those that were counted.
        self.seen: Counter = Counter()
        for k, (label, text) in enumerate(templates.items()):
            tokens = sorted(set(words_of(text)), key=self.order.__getitem__)
            need = max(1, ceil(threshold * len(tokens) - 1e-9))
            self.parts.append((label, tokens, frozenset(tokens), need, max(2 * len(tokens), len(words_of(text)))))
            for w in tokens[: len(tokens) - need + 1]:
                self.prefix.setdefault(w, []).append(k)

    def matches(self, words: list[bytes], present: set[bytes]) -> dict[str, float]:
        """Largest containment by label, of the labels that some block meets. present: the distinct words."""
        hit = self.prefix.keys() & present
        if not hit:
            return {}
        held = sorted(map(self.order.__getitem__, self.order.keys() & present))
        open_: dict[int, list[list[int]]] = {k: [] for k in {k for word in hit for k in self.prefix[word]} if self._may_meet(k, held, hit)}
        if not open_:
            return {}
        for at, word in enumerate(words):
            if word in hit:
                for k in self.prefix[word]:
                    if k in open_:
                        low, high = max(0, at - self.parts[k][4] + 1), at + self.parts[k][4]
                        if open_[k] and low <= open_[k][-1][1]:
                            open_[k][-1][1] = high
                        else:
                            open_[k].append([low, high])
        found: dict[str, float] = {}
        for k, stretches in open_.items():
            label, tokens, members, need, width = self.parts[k]
            for low, high in stretches:
                stretch = words[low:high]
                inside = set(stretch)
                if not self._may_meet(k, sorted(map(self.order.__getitem__, self.order.keys() & inside)), hit & inside):
                    continue
                self.seen["counted"] += 1
                if len(members & inside) >= need and (most := most_shared(stretch, members, width)) >= need:
                    found[label] = max(found.get(label, 0.0), most / len(tokens))
        return found

    def _may_meet(self, k: int, held: list[int], hit: set[bytes]) -> bool:
        """Whether a block can meet template k. held: places of its tokens in the global order, ascending; hit: those that are in prefixes."""
        _, tokens, _, need, _ = self.parts[k]
        if len(held) < need:
            self.seen["length"] += 1
            return False
        first = next(i for i, w in enumerate(tokens) if w in hit)  # a token of the prefix, as k is a candidate
        if min(len(tokens) - first, len(held) - bisect_left(held, self.order[tokens[first]])) < need:
            self.seen["position"] += 1
            return False
        return True


def most_shared(words: list[bytes], tokens: frozenset[bytes], width: int) -> int:
    """The largest number of distinct tokens in any width consecutive words."""
    at = [i for i, w in enumerate(words) if w in tokens]
    inside: Counter = Counter()
    most = first = 0
    for i in at:
        inside[words[i]] += 1
        while at[first] <= i - width:
            gone = words[at[first]]
            inside[gone] -= 1
            if not inside[gone]:
                del inside[gone]
            first += 1
        most = max(most, len(inside))
    return most


def templates_of(table: DataFrame, label_col: str = "label", text_col: str = "text") -> dict[str, str]:
    """Templates from a table of at most MAX_TEMPLATES license texts; rows without a label or a word are left out, of rows that repeat a label the smallest text counts."""
    rows = table.select(F.col(label_col).cast("string").alias("label"), F.col(text_col).cast("string").alias("text")).where("label IS NOT NULL AND text IS NOT NULL")
    found = rows.groupBy("label").agg(F.min("text").alias("text")).orderBy("label").limit(MAX_TEMPLATES + 1).collect()
    if len(found) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    return {r["label"]: r["text"] for r in found if words_of(r["text"])}


def places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    out, at, n = [], -1, len(phrase)
    while True:
        try:
            at = words.index(phrase[0], at + 1)
        except ValueError:
            return out
        if words[at : at + n] == phrase:
            out.append(at)


class LicenseScan:
    """threshold: least share of a template's tokens that a block must hold."""

    def __init__(self, templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = PHRASES, threshold: float = 0.8):
        if len(templates) > MAX_TEMPLATES:
            raise ValueError(f"more than {MAX_TEMPLATES} templates")
        self.templates, self.phrases, self.threshold = templates, phrases, threshold

    def frequencies(self, docs: DataFrame, text_col: str = "text") -> dict[bytes, int]:
        """In how many of all documents each template token is."""
        tokens = {w for text in self.templates.values() for w in words_of(text)}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: Counter = Counter()
            for batch in batches:
                for text in batch.column(0):
                    seen.update(tokens.intersection(words_of(text.as_py())))
            yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], names=["token", "n"])

        rows = docs.select(F.col(text_col).cast("string")).mapInArrow(run, "token binary, n bigint").groupBy("token").agg(F.sum("n").alias("n")).collect()
        return {bytes(r["token"]): r["n"] for r in rows}

    def apply(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score: one row for each row of docs."""
        index = Index(self.templates, self.threshold, self.frequencies(docs, text_col))
        phrases = [(words_of(p), label) for p, label in self.phrases.items()]
        docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out: list[list] = [[] for _ in range(7)]
                for text in batch.column(1):
                    words = words_of(text.as_py())
                    present = set(words)
                    at, base = [], set()
                    for phrase, label in phrases:
                        if present.issuperset(phrase) and (here := places(words, phrase)):
                            at += here
                            base.add(label)
                    more = index.matches(words, present)
                    row = (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | more.keys())), 1.0 if base else max(more.values(), default=0.0))
                    for column, value in zip(out, row):
                        column.append(value)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
                names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds))], names=["doc_id", *names])

        return docs.mapInArrow(run, "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double")


def oracle_sql(templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = PHRASES, threshold: float = 0.8) -> str:
    """The same scan as SQL: phrases by position, and for each template all windows that start at one of its words."""
    quoted = lambda words: "[" + ", ".join("'" + w.decode() + "'" for w in words) + "]"
    tokens = {label: sorted(set(words_of(text))) for label, text in templates.items()}
    rows = [f"('{label}', {quoted(t)}, {len(t)}, {max(1, ceil(threshold * len(t) - 1e-9))}, {max(2 * len(t), len(words_of(templates[label])))})" for label, t in tokens.items()]
    at = [f"SELECT doc_id, '{label}' AS label, unnest(list_filter(range(0, len(w)), lambda i: w[i + 1:i + {len(words_of(p))}] = {quoted(words_of(p))})) AS pos FROM words" for p, label in phrases.items()]
    return rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
places AS ({" UNION ALL ".join(at)}),
base AS (SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list_sort(list(DISTINCT label)) AS labels FROM places GROUP BY doc_id),
templates(label, tokens, size, need, width) AS (VALUES {", ".join(rows)}),
token AS (SELECT label, unnest(tokens) AS word, size, need, width FROM templates),
hits AS (SELECT doc_id, label, pos, h.word, size, need, width FROM (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS pos FROM words) h JOIN token USING (word)),
likely AS (SELECT doc_id, label FROM hits GROUP BY doc_id, label, need HAVING count(DISTINCT word) >= need),
near AS (SELECT h.* FROM hits h JOIN likely USING (doc_id, label)),
windows AS (SELECT a.doc_id, a.label, a.pos, a.size, a.need, count(DISTINCT b.word) AS shared FROM near a JOIN near b ON a.doc_id = b.doc_id AND a.label = b.label AND b.pos >= a.pos AND b.pos < a.pos + a.width GROUP BY ALL),
found AS (SELECT doc_id, list(DISTINCT label) AS labels, max(shared / size::DOUBLE) AS score FROM windows WHERE shared >= need GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, array_to_string(coalesce(b.labels, []), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(f.labels, [])))), ',') AS labels, CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(f.score, 0.0::DOUBLE) END AS score
FROM words w LEFT JOIN base b USING (doc_id) LEFT JOIN found f USING (doc_id)
"""


ORACLE_SQL = oracle_sql()
