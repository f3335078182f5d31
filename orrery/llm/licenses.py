"""License scan: an exact containment join of text blocks with notice templates.

A block of a template is a window of words, at least twice as long as the
template, at steps of half a window, so that every passage of the template's
length lies whole in one. A block matches when it holds at least ``least`` of
the template's distinct words.

The join is by prefix filtering. Words of the templates are ordered by their
number of occurrences in the corpus, rarest first. A block that holds k of a
template's m words holds one of the first m - k + 1 in that order, so only
blocks around those words are looked at; then those with fewer than k words of
any template go (length), then those whose place in both orders leaves fewer
than k words to come (position), and the rest are counted. No block that meets
the threshold is lost.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orrery.llm.common import batches, mapped, text_bytes
from orrery.session import cut_lineage

CUT = 1 << 20  # bytes of text split at once
BATCH = 4 << 20  # bytes of text read at once
MOST_WORDS = 100_000  # of all templates together: they go to every task

# Phrases that the scan counts, and the openings of public notices.
PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]
TEMPLATES = [
    ("apache", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
               'compliance with the License. You may obtain a copy of the License at'),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("cc", "Licensed under CC BY-NC 4.0."),
    ("cc", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mit", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and '
            'associated documentation files (the "Software"), to deal in the Software without restriction'),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]

# words: digits, letters (A-Z lowered) and characters beyond ASCII; the rest is blank
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    flat, at = text.translate(_FOLD), 0
    while at < len(flat):
        end = flat.find(b" ", at + CUT) if at + CUT < len(flat) else -1
        end = len(flat) if end < 0 else end
        yield flat[at:end].split()
        at = end


@dataclass(frozen=True)
class Template:
    label: str
    words: frozenset[bytes]
    window: int  # words in a block: a power of two, at least twice those of the template
    need: int  # distinct words that a matching block holds


def prepare(templates: Sequence[tuple[str, str]], least: float = 0.8) -> list[Template]:
    """Templates without a word are refused: every block would hold them."""
    out = []
    for label, text in templates:
        all_ = [w for part in words(text.encode()) for w in part]
        if not all_:
            raise ValueError(f"template {label!r} has no words")
        need = ceil(Fraction(str(least)) * len(set(all_)))
        out.append(Template(label, frozenset(all_), 1 << (2 * len(all_) - 1).bit_length(), max(1, need)))
    if sum(len(t.words) for t in out) > MOST_WORDS:
        raise ValueError(f"templates of more than {MOST_WORDS} words")
    return out


def _phrase_places(word: np.ndarray, place: np.ndarray, phrase: list[int]) -> np.ndarray:
    """Indexes of ``word`` where the phrase's words begin that stand in a row."""
    n = len(word) - len(phrase) + 1
    if n < 1:
        return np.zeros(0, np.int64)
    ok = place[len(phrase) - 1:] - place[:n] == len(phrase) - 1
    for k, w in enumerate(phrase):
        ok &= word[k:k + n] == w
    return np.flatnonzero(ok)


def hits(docs: DataFrame, phrases: Sequence[tuple[str, str]], templates: Sequence[Template], id_col: str,
         text_col: str) -> tuple[DataFrame, list[bytes]]:
    """One row per row of ``docs``: id, n_words, the places of phrases
    (n_base, first_word, last_word, base), and ``place`` and ``word``: where
    which template words stand; empty where a text has too few for any
    template. Also the template words by number."""
    split = [(label, [w for part in words(p.encode()) for w in part]) for label, p in phrases]
    if not all(p for _, p in split):
        raise ValueError("a phrase has no words")
    known = sorted({w for t in templates for w in t.words})
    number = {w: k for k, w in enumerate([*known, *sorted({w for _, p in split for w in p} - set(known))])}
    coded = [(label, [number[w] for w in p]) for label, p in split]
    fewest, n_known = min((t.need for t in templates), default=1 << 60), len(known)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = StructType([src.schema["id"], *StructType.fromDDL(
        "n_words long, n_base long, first_word long, last_word long, base array<string>, "
        "place array<long>, word array<int>")])

    def one(text: bytes):
        n, place, word = 0, [], []
        for part in words(text):
            for i, w in enumerate(map(number.get, part), n):
                if w is not None:
                    place.append(i)
                    word.append(w)
            n += len(part)
        place, word = np.array(place, np.int64), np.array(word, np.int32)
        starts = [(label, place[_phrase_places(word, place, p)]) for label, p in coded]
        at = np.concatenate([p for _, p in starts]) if starts else np.zeros(0, np.int64)
        mine = word < n_known
        place, word = place[mine], word[mine]
        if len(np.unique(word)) < fewest:
            place, word = place[:0], word[:0]
        first, last = (int(at.min()), int(at.max())) if len(at) else (None, None)
        return n, len(at), first, last, sorted({label for label, p in starts if len(p)}), place, word

    def run(it):
        for b in batches(it, BATCH, "text"):
            got = list(zip(*map(one, text_bytes(b.column(1)))))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, f.type) for c, f in zip(got, ARROW))], names=schema.names)

    return src.transform(mapped, run, schema), known


ARROW = pa.schema([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                   ("last_word", pa.int64()), ("base", pa.list_(pa.string())), ("place", pa.list_(pa.int64())),
                   ("word", pa.list_(pa.int32()))])


class Index:
    """Inverted index of the templates' prefixes; words are ranks from the rarest on."""

    def __init__(self, templates: Sequence[Template], known: list[bytes], counts: Mapping[int, int]):
        order = sorted(range(len(known)), key=lambda k: (counts.get(k, 0), known[k]))
        self.rank = np.zeros(len(known), np.int64)
        self.rank[order] = np.arange(len(known))
        number = {w: k for k, w in enumerate(known)}
        self.templates = templates
        self.sets = [np.sort(self.rank[[number[w] for w in t.words]]) for t in templates]
        self.prefixes = [s[:len(s) - t.need + 1] for s, t in zip(self.sets, templates)]

    def matches(self, place: np.ndarray, word: np.ndarray) -> list[tuple[str, int, int, float]]:
        """(label, first, last, share) of each template and block that match:
        the places of the first and the last of the template's words."""
        out, ranks = [], self.rank[word]
        for t, full, prefix in zip(self.templates, self.sets, self.prefixes):
            if len(place) < t.need:
                continue
            half = t.window // 2
            near = place[np.isin(ranks, prefix)] // half
            starts = np.unique(np.r_[near, near - 1][np.r_[near, near - 1] >= 0] if len(near) else near) * half
            lo, hi = np.searchsorted(place, starts), np.searchsorted(place, starts + t.window)
            for i, j in zip(lo.tolist(), hi.tolist()):
                if j - i < t.need:
                    continue
                block = np.unique(ranks[i:j])
                if len(block) < t.need:
                    continue
                first = block[np.isin(block, prefix)][0]
                left = min(len(block) - np.searchsorted(block, first), len(full) - np.searchsorted(full, first))
                if left < t.need:
                    continue
                n = int(np.isin(full, block).sum())
                if n >= t.need:
                    of = place[i:j][np.isin(ranks[i:j], full)]
                    out.append((t.label, int(of[0]), int(of[-1]), n / len(full)))
        return out


def scan(docs: DataFrame, phrases: Sequence[tuple[str, str]] = tuple(PHRASES),
         templates: Sequence[tuple[str, str]] = tuple(TEMPLATES), least: float = 0.8, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_base (places where a phrase's
    words stand in a row), first_word and last_word (smallest and largest of
    those places, words from 0; null without one), base_labels, labels,
    ``matches`` (label, start, end, share: template words of a block that
    holds at least the share ``least`` of a template's distinct words) and
    score: 1 where a phrase stands, else the largest share, else 0.

    Labels are arrays, distinct and sorted; ``labels`` has those of phrases and
    of matches. Null, empty and word-free texts have no words, labels or
    matches. Rows of equal id or text are handled each for itself, null ids
    too; other columns aren't read. An empty table gives an empty one. Templates
    have at most ``MOST_WORDS`` words together."""
    ready = prepare(templates, least)
    found, known = hits(docs, phrases, ready, id_col, text_col)
    rows = cut_lineage(found, "license-hits")
    counts = {r.w: r["count"] for r in rows.select(F.explode("word").alias("w")).groupBy("w").count().collect()}
    index = Index(ready, known, counts)
    schema = StructType([*rows.schema.fields[:-2], *StructType.fromDDL(
        "matches array<struct<label:string,start:long,end:long,share:double>>")])
    kind = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                               ("share", pa.float64())]))

    def run(it):
        for b in it:
            place, word = b.column(6), b.column(7)
            flat = place.flatten().to_numpy(), word.flatten().to_numpy()
            ends = np.cumsum(np.r_[0, [len(x) for x in place]]).tolist()
            got = [[dict(zip(("label", "start", "end", "share"), m))
                    for m in (index.matches(flat[0][i:j], flat[1][i:j]) if j > i else ())]
                   for i, j in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([*b.columns[:6], pa.array(got, kind)], names=schema.names)

    out = mapped(rows, run, schema)
    share = F.array_max(F.transform("matches", lambda m: m["share"]))
    return out.select(
        F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", F.col("base").alias("base_labels"),
        F.array_sort(F.array_union("base", F.transform("matches", lambda m: m["label"]))).alias("labels"), "matches",
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce(share, F.lit(0.0))).alias("score"))
