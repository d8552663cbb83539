"""Language identification by cross-parsing entropy.

For each language a bounded sample of labelled text is turned into a suffix automaton, which knows every substring of
it. A text is parsed against a sample into phrases, each the longest match with any place of the sample: the fewer
phrases, the closer the language. The language with the fewest normalised phrases (phrases times the bits of a place
in the sample, per character) wins.

The alphabet is every character of the samples. Texts are parsed whole. Long ones are cut into stretches of STRETCH
characters that are parsed side by side, for all languages alike.

Defined results: a text that is null or has no letter is ``und`` with score 0, as is every text if nothing can be
learned; ties go to the language that sorts first; repeated rows are predicted alike; rows without an id are never
learned from and never held out; an empty table gives an empty result; columns other than the named ones are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_CHARS = 24_000
"""Characters learned per language, or what there is; the bits of a place make up for samples of other lengths."""
SAMPLE_DOCUMENTS = 64
"""Documents that the characters of a language are taken from, evenly."""
SYMBOLS = 96
"""Width of the dense tables, which hold the most frequent characters; moves by other characters are looked up."""
STRETCH = 2048
LANES = 8192
"""Stretches parsed side by side."""
LETTER = re.compile(r"[^\W\d_]")
NEXT = 0x7FFFFFFF


def learnable(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def samples(docs: DataFrame) -> dict[str, str]:
    """A bounded sample of text per language: SAMPLE_DOCUMENTS documents by a hash of their id.

    A document is the rows of a language with an id, of which the smallest text is taken. So repeated rows neither
    crowd others out nor reach the driver, and what does is at most SAMPLE_CHARS per language.
    """
    # The documents are chosen on their narrow columns, and only then are their texts read.
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    known = learnable(docs).where(F.col("doc_id").isNotNull()).select("lang", "doc_id").distinct()
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ids = known.withColumn("__n", nth).where(F.col("__n") <= SAMPLE_DOCUMENTS).select("lang", "doc_id")
    chosen: dict[str, list] = {}
    for r in ids.collect():
        chosen.setdefault(r.lang, []).append(r.doc_id)
    if not chosen:
        return {}
    wanted = reduce(or_, ((F.col("lang") == l) & F.col("doc_id").isin(sorted(i)) for l, i in sorted(chosen.items())))
    part = F.substring("text", 1, -(-SAMPLE_CHARS // SAMPLE_DOCUMENTS))
    texts = learnable(docs).where(wanted).groupBy("lang", "doc_id").agg(F.min(part).alias("t")).collect()
    found: dict[str, list[str]] = {}
    for r in sorted(texts, key=lambda r: (r.lang, r.doc_id, r.t)):
        found.setdefault(r.lang, []).append(r.t)
    joined = {lang: "\n".join(parts)[:SAMPLE_CHARS].lower() for lang, parts in found.items()}
    return {lang: t for lang, t in sorted(joined.items()) if t}


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """The transitions of the automaton that accepts every substring; state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    length, link, last = [0], [-1], 0
    for c in symbols:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p != -1:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return moves


class Languages:
    """The automata of all languages over one alphabet: every character of the samples.

    Moves by the most frequent characters are in flat tables; those by other characters, of which the automata have few
    for their number, are in sorted arrays of (state, symbol).
    """

    def __init__(self, sample: dict[str, str]) -> None:
        counts: dict[str, int] = {}
        for text in sample.values():
            for ch in text:
                counts[ch] = counts.get(ch, 0) + 1
        chosen = sorted(counts, key=lambda ch: (-counts[ch], ch))
        self.names = sorted(sample)
        self.width = min(SYMBOLS, len(chosen) + 1)
        self.size = len(chosen) + 1
        self.symbol = np.zeros(0x110000, np.min_scalar_type(self.size))  # 0: not in the alphabet
        for i, ch in enumerate(chosen, 1):
            self.symbol[ord(ch)] = i
        self.tables = [self._table(self.symbols(sample[n])) for n in self.names]
        self.bits = np.array([np.log2(max(2, len(sample[n]))) for n in self.names])

    def symbols(self, text: str) -> np.ndarray:
        return self.symbol[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]

    def _table(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The dense table and the moves by symbols beyond it: their sorted keys, where they lead, and the start's row.

        At state + symbol: the next state, negative (by the sign bit) where a phrase ends before the symbol.

        States are given as offsets of their rows. After the end of a phrase the symbol starts the next one; a symbol
        that the sample does not have is a phrase of its own, for which the last row stands.
        """
        moves = suffix_automaton([int(s) for s in symbols if s])
        alone = len(moves)
        table = np.full((alone + 1, self.width), alone * self.width, np.int32)
        start = np.full(self.size, alone * self.width, np.int32)
        for c, to in moves[0].items():
            start[c] = to * self.width
        table[:] = start[: self.width]
        table[1:] |= np.int32(-NEXT - 1)
        rare: dict[int, int] = {}
        for state, row in enumerate(moves):
            for c, to in row.items():
                if c < self.width:
                    table[state, c] = to * self.width
                else:
                    rare[state * self.width * self.size + c] = to * self.width
        keys = np.array(sorted(rare), np.int64)
        return table.ravel(), keys, np.array([rare[k] for k in keys.tolist()], np.int32), start

    def _looked_up(self, table: tuple[np.ndarray, ...], state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """As the dense table at state + symbol, for symbols beyond it."""
        _, keys, to, start = table
        first = np.where(state > 0, start[symbol] | np.int32(-NEXT - 1), start[symbol])
        if not len(keys):
            return first
        asked = state.astype(np.int64) * self.size + symbol
        at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        return np.where(keys[at] == asked, to[at], first)

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases per text and language."""
        out = np.zeros((len(texts), len(self.names)), np.int64)
        pieces = [(len(t[at : at + STRETCH]), i, at) for i, t in enumerate(texts) for at in range(0, len(t), STRETCH)]
        pieces.sort(reverse=True)
        for first in range(0, len(pieces), LANES):
            group = pieces[first : first + LANES]
            lanes = np.zeros((group[0][0], len(group)), self.symbol.dtype)
            for lane, (n, i, at) in enumerate(group):
                lanes[:n, lane] = texts[i][at : at + n]
            lengths = -np.array([n for n, _, _ in group])
            alive = np.searchsorted(lengths, -np.arange(len(lanes)), "left")  # lanes longer than each step
            owner = np.array([i for _, i, _ in group])
            # Per step the lanes whose symbol is beyond the dense tables, which read 0 there.
            step, who = np.nonzero(lanes >= self.width)
            beyond = lanes[step, who]
            bounds = np.searchsorted(step, np.arange(len(lanes) + 1)).tolist()
            lanes[step, who] = 0
            for k, table in enumerate(self.tables):
                state = np.zeros(len(group), np.int32)
                count = np.zeros(len(group), np.int32)
                for row, m, f, t in zip(lanes, alive.tolist(), bounds, bounds[1:]):
                    to = table[0].take(state[:m] + row[:m])
                    if f < t:
                        to[who[f:t]] = self._looked_up(table, state[who[f:t]], beyond[f:t])
                    count[:m] += to < 0
                    state[:m] = to & NEXT
                np.add.at(out[:, k], owner, count + (state > 0))
        return out


@lru_cache(2)
def learned(sample: tuple[tuple[str, str], ...]) -> Languages:
    """Built once per Python worker from the broadcast samples."""
    return Languages(dict(sample))


def predict(docs: DataFrame, sample: dict[str, str], keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, lang_pred and score: 1 - (best / second best normalised phrases)."""
    known = tuple(sorted(sample.items()))
    kept = docs.select(*keep, F.col("text").alias("__text"))
    schema = ", ".join(f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in keep)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = learned(known)
        for batch in batches:
            names, scores = ["und"] * len(batch), np.zeros(len(batch))
            places, texts = [], []
            for i, t in enumerate(batch.column("__text")):
                text = t.as_py()
                if known and text and LETTER.search(text):
                    places.append(i)
                    texts.append(languages.symbols(text.lower()))
            if places:
                cost = languages.phrases(texts) * languages.bits / np.array([[len(t)] for t in texts])
                best = cost.argmin(axis=1)
                ranked = np.sort(cost, axis=1)
                sure = 1 - ranked[:, 0] / ranked[:, 1] if len(languages.names) > 1 else np.ones(len(places))
                for i, b, s in zip(places, best, sure):
                    names[i], scores[i] = languages.names[b], s
            columns = [*(batch.column(c) for c in keep), pa.array(names, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "lang_pred", "score"])

    return kept.mapInArrow(judge, f"{schema}, lang_pred string, score double")
