"""License scans: fixed phrases, and an exact set-similarity join with license templates.

Template tokens are put in one global order, rarest in the corpus first.  A text
block can only contain a template to the threshold if it holds one of the
template's first tokens (prefix filter), has enough tokens (length filter), and
enough are left behind each first match (positional filter); what passes is
verified by counting the overlap.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced

#: Bytes of text that are Python's at once.
SLICE_BYTES = 8 << 20

# Base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Opening sentences of public license texts and usual one-line notices.
TEMPLATES = {
    "mit": ["released under the MIT License", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "apache-2.0": ["Licensed under the Apache License, Version 2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"],
    "gpl-3": ["licensed under the GNU General Public License, version 3"],
    "gpl-2": ["licensed under the GNU General Public License, version 2"],
    "lgpl": ["under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "unlicense": ["This is free and unencumbered software released into the public domain"],
}

#: A-Z to a-z, every other separator of words to a blank; bytes of other letters stay.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


@dataclass(frozen=True)
class ScanParams:
    """threshold: share of a template's tokens that a block must hold.  Longer paragraphs are read in windows of block_words, half overlapping."""

    threshold: float = 0.9
    block_words: int = 200
    phrases: dict = field(default_factory=lambda: dict(PHRASES))
    templates: dict = field(default_factory=lambda: {k: list(v) for k, v in TEMPLATES.items()})


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


def template_sets(p: ScanParams) -> list[tuple[str, frozenset[bytes]]]:
    return [(label, frozenset(words_of(t))) for label, texts in sorted(p.templates.items()) for t in texts]


def token_frequencies(docs: DataFrame, p: ScanParams, text_col: str = "text") -> dict[bytes, int]:
    """In how many documents each template token stands, over all documents; as many rows as the templates have tokens."""
    vocabulary = frozenset().union(*(s for _, s in template_sets(p)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter = Counter()
        for batch in sliced(batches, 0, SLICE_BYTES):
            for text in batch.column(0).to_pylist():
                count.update(vocabulary.intersection(words_of(text)))
        yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.binary()), pa.array(list(count.values()), pa.int64())], ["token", "n"])

    rows = docs.select(text_col).mapInArrow(run, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    found = {bytes(r["token"]): r["n"] for r in rows}
    return {t: found.get(t, 0) for t in vocabulary}


class TemplateIndex:
    """Prefix index over the templates in the global order."""

    def __init__(self, p: ScanParams, frequency: dict[bytes, int]):
        self.p = p
        self.rank = {t: i for i, t in enumerate(sorted(frequency, key=lambda t: (frequency[t], t)))}
        self.sets = []
        self.prefix: dict[bytes, list[tuple[int, int]]] = {}
        for label, tokens in template_sets(p):
            need = max(1, -(-int(round(p.threshold * 1000)) * len(tokens) // 1000))
            ordered = sorted(tokens, key=self.rank.__getitem__)
            for at, t in enumerate(ordered[: len(ordered) - need + 1]):
                self.prefix.setdefault(t, []).append((len(self.sets), at))
            self.sets.append((label, tokens, need))
        self.first = frozenset(self.prefix)

    def matches(self, block: list[bytes]) -> list[tuple[str, float]]:
        """(label, containment) of every template that the block meets."""
        have = self.rank.keys() & set(block)
        out, seen = [], set()
        ordered = sorted(have, key=self.rank.__getitem__)
        for j, t in enumerate(ordered):
            for k, at in self.prefix.get(t, ()):
                if k in seen:
                    continue
                seen.add(k)
                label, tokens, need = self.sets[k]
                if len(have) < need or 1 + min(len(tokens) - at - 1, len(ordered) - j - 1) < need:
                    continue
                shared = len(tokens & have)
                if shared >= need:
                    out.append((label, shared / len(tokens)))
        return out


def blocks(text: str, p: ScanParams) -> Iterator[list[bytes]]:
    """Words of each paragraph (lines without an empty one between them), long ones in windows."""
    for part in _paragraphs(text):
        words = words_of(part)
        step = max(1, p.block_words // 2)
        for a in range(0, max(1, len(words) - step), step):
            yield words[a : a + p.block_words]


def _paragraphs(text: str) -> list[str]:
    out: list[list[str]] = [[]]
    for line in text.split("\n"):
        if line.strip():
            out[-1].append(line)
        elif out[-1]:
            out.append([])
    return ["\n".join(x) for x in out if x]


def find_places(words: list[bytes], phrase: str) -> list[int]:
    """Word numbers at which the phrase's words stand one after another."""
    tokens = words_of(phrase)
    if not tokens or tokens[0] not in words:
        return []
    n, out, at = len(tokens), [], -1
    while True:
        try:
            at = words.index(tokens[0], at + 1)
        except ValueError:
            return out
        if words[at : at + n] == tokens:
            out.append(at)


def scan_text(text: str | None, index: TemplateIndex) -> tuple:
    """(n_words, n_base, first_word, last_word, base labels, all labels, score) of one whole text."""
    words = words_of(text)
    have = set(words)
    base, places = set(), []
    for phrase, label in index.p.phrases.items():
        if all(t in have for t in words_of(phrase)) and (found := find_places(words, phrase)):
            base.add(label)
            places += found
    labels, score = set(base), 1.0 if base else 0.0
    if not index.first.isdisjoint(have):
        for block in blocks(text, index.p):
            if not index.first.isdisjoint(block):
                for label, share in index.matches(block):
                    labels.add(label)
                    score = max(score, share)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score


FOUND = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan(docs: DataFrame, p: ScanParams = ScanParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """License phrases and templates in every row of docs.

    score is the largest containment of a template, or 1 where a base phrase
    stands.  Null and empty texts have no words, labels or places and score 0;
    long texts are read whole; repeated rows are scanned each; an empty table
    gives no rows; other columns are not read.  Two passes over the texts, no
    shuffle of them.
    """
    index = TemplateIndex(p, token_frequencies(docs, p, text_col))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1, SLICE_BYTES):
            cols = list(zip(*(scan_text(t, index) for t in batch.column(1).to_pylist()))) or [[]] * 7
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types))], ["_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, f"_id {kind}, {FOUND}").withColumnRenamed("_id", id_col)
