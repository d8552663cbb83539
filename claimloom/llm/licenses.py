"""License scan: exact places of license phrases, and an exact set-similarity join of text blocks with templates.

The join finds every block of a text that contains at least a given share of a template's distinct words. Words are
put in one order for the whole corpus, the rarest first. If a block has ``need`` of a template's words, then the first
``size - need + 1`` words of both, in that order, share one (prefix filter); a block with fewer than ``need`` of the
known words cannot match (length filter); and the places of the first shared word bound what can still be shared
(positional filter). What is left is verified. Only words of some template matter, so a block is reduced to those.

A block is a window of BLOCK_TEMPLATES times the longest template, in steps of half of it, so any passage up to the
length of a template lies whole in some block.

Defined results: a null text is an empty one, without words or labels; long texts are scanned whole; repeated rows are
scanned alike; an empty table gives an empty result; columns other than the named ones are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
"""Share of a template's distinct words that a block has to contain."""
BLOCK_TEMPLATES = 2

# The phrases of the base labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Well-known grant and notice sentences of public licenses.
TEMPLATES = {
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
    "associated documentation files the software to deal in the software without restriction",
    "apache-notice": "licensed under the apache license version 2 0 the license you may not use this file except in "
    "compliance with the license",
    "apache-line": "licensed under the apache license version 2 0",
    "mit-line": "released under the mit license",
    "gpl-line": "this work is licensed under the gnu general public license version 3",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
    "general public license as published by the free software foundation",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee "
    "is hereby granted",
    "mpl-notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "cc-notice": "this work is licensed under a creative commons attribution 4 0 international license",
}

_WORD_BYTES = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_FOLD = bytes(b if b in _WORD_BYTES else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
"""A-Z lowered; every byte that is not part of a word becomes a space."""


def words_of(text: str | None) -> list[bytes]:
    """Runs of a-z, 0-9 and all characters beyond ASCII, after lowering A-Z."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class Templates:
    def __init__(self, templates: dict[str, str], threshold: float) -> None:
        self.names = sorted(templates)
        self.words = [frozenset(words_of(templates[n])) for n in self.names]
        self.threshold = threshold
        self.known = frozenset().union(*self.words)
        longest = max((len(words_of(t)) for t in templates.values()), default=1)
        self.block = BLOCK_TEMPLATES * longest
        self.step = self.block - longest
        self.need = [max(1, math.ceil(threshold * len(w) - 1e-9)) for w in self.words]

    def order(self, frequency: dict[bytes, int]) -> None:
        """Fix the global order of words and index the templates' prefixes by it."""
        self.place = {w: i for i, w in enumerate(sorted(self.known, key=lambda w: (frequency.get(w, 0), w)))}
        self.sorted = [sorted(self.place[w] for w in words) for words in self.words]
        self.by_prefix: dict[int, list[tuple[int, int]]] = {}
        for k, ranks in enumerate(self.sorted):
            for i, rank in enumerate(ranks[: len(ranks) - self.need[k] + 1]):
                self.by_prefix.setdefault(rank, []).append((k, i))
        self.least = min(self.need, default=1)
        self.indexed = frozenset(self.by_prefix)

    def matches(self, block: set[int]) -> dict[int, float]:
        """Templates that a block contains to the threshold, and the share of each."""
        found: dict[int, float] = {}
        if len(block) < self.least or block.isdisjoint(self.indexed):
            return found
        ranks = sorted(block)
        tried = set()
        for j, rank in enumerate(ranks):
            for k, i in self.by_prefix.get(rank, ()):
                need = self.need[k]
                if k in tried or len(ranks) < need or j > len(ranks) - need:
                    continue
                tried.add(k)  # the first shared word: no earlier one is shared
                if 1 + min(len(self.sorted[k]) - i, len(ranks) - j) - 1 < need:
                    continue
                shared = sum(r in block for r in self.sorted[k])
                if shared >= need:
                    found[k] = shared / len(self.sorted[k])
        return found

    def scan(self, words: list[bytes]) -> tuple[dict[str, float], list[tuple[str, int, int]]]:
        """The best share per template, and the matching blocks as (template, first word, words)."""
        at = [(i, self.place[w]) for i, w in enumerate(words) if w in self.known]
        best: dict[str, float] = {}
        blocks: list[tuple[str, int, int]] = []
        if len(at) < self.least or not any(r in self.indexed for _, r in at):
            return best, blocks
        low = high = 0
        # Only windows that hold a known word are looked at; the last of a text may be shorter.
        seen = -1
        for place, _ in at:
            for window in range(max(seen + 1, (place - self.block) // self.step + 1, 0), place // self.step + 1):
                seen = window
                start, end = window * self.step, window * self.step + self.block
                while low < len(at) and at[low][0] < start:
                    low += 1
                high = max(high, low)
                while high < len(at) and at[high][0] < end:
                    high += 1
                if high - low < self.least:
                    continue
                for k, share in self.matches({r for _, r in at[low:high]}).items():
                    name = self.names[k]
                    best[name] = max(best.get(name, 0.0), share)
                    blocks.append((name, start, min(end, len(words)) - start))
        return best, blocks


def frequencies(docs: DataFrame, templates: Templates) -> dict[bytes, int]:
    """How often every template word occurs in the whole corpus; at most one row per template word is collected."""
    known = templates.known

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column("text"):
                total.update(w for w in words_of(text.as_py()) if w in known)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], ["word", "n"]
        )

    counted = docs.select("text").mapInArrow(count, "word binary, n long")
    return {bytes(r.word): r.n for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def places(words: list[bytes], phrases: list[list[bytes]]) -> list[list[int]]:
    """Where each phrase stands, by its last word, which is the rarest."""
    found: list[list[int]] = []
    for phrase in phrases:
        starts: list[int] = []
        at, last, n = -1, phrase[-1], len(phrase)
        while True:
            try:
                at = words.index(last, at + 1)
            except ValueError:
                break
            if at >= n - 1 and words[at - n + 1 : at + 1] == phrase:
                starts.append(at - n + 1)
        found.append(starts)
    return found


SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "blocks array<struct<template:string,first_word:long,n_words:long>>"
)


def scan(
    docs: DataFrame,
    templates: dict[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
    phrases: dict[str, str] = PHRASES,
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The columns ``keep`` and SCHEMA's. ``labels`` has the base labels and the names of the templates found."""
    known = Templates(templates, threshold)
    known.order(frequencies(docs, known))
    kept = docs.select(*keep, F.col("text").alias("__text"))
    schema = ", ".join(f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in keep)
    wanted, labels = [words_of(p) for p in phrases], list(phrases.values())
    types = pa.list_(pa.struct([("template", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("__text"):
                words = words_of(text.as_py())
                starts = places(words, wanted)
                base = sorted({label for label, s in zip(labels, starts) if s})
                every = [s for found in starts for s in found]
                best, blocks = known.scan(words)
                rows.append(
                    (
                        len(words),
                        len(every),
                        min(every, default=None),
                        max(every, default=None),
                        ",".join(base),
                        ",".join(sorted({*base, *best})),
                        max(best.values(), default=1.0 if every else 0.0),
                        [{"template": t, "first_word": s, "n_words": n} for t, s, n in blocks],
                    )
                )
            columns = list(zip(*rows)) if rows else [()] * 8
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), types]
            arrays = [*(batch.column(c) for c in keep), *(pa.array(list(c), k) for c, k in zip(columns, kinds))]
            names = "n_words n_base first_word last_word base_labels labels score blocks".split()
            yield pa.RecordBatch.from_arrays(arrays, [*keep, *names])

    return kept.mapInArrow(run, f"{schema}, {SCHEMA}")
