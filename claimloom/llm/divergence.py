"""Source divergence audit: how far each source of a language is from every other one, and which terms set it apart.

The table of terms by (language, source) group is a sparse matrix. What a group's row has in common with every other
row is accumulated the way Gustavson multiplies sparse matrices: a task holds a block of the term-major index, takes the
terms of one group after the other, scatters each through its postings into a dense accumulator over the peers, and puts
out one row per touched peer. No pair of postings becomes a row. A term that a group or its peer lacks still has a share
(one pseudo count), so the accumulators start from that zero baseline, and a scattered term corrects it:

    value(g, h) = V*f(g0, h0) + sum over g's terms of f(p, h0) - f(g0, h0) + sum over h's terms of f(g0, q) - f(g0, h0)
                  + sum over common terms of f(p, q) - f(p, h0) - f(g0, q) + f(g0, h0)

The two middle sums need a group's histogram of shares only, as equal counts have equal shares. Everything is in integers.

Defined results: null text, language and source are read as empty; every row is a document of its own, so repeated rows
count as often as they are there; ties go to the item that is smaller by its UTF-8 bytes; a group without terms has
pairs, but no terms; a language without kept terms has pairs of value 0; a language of one source has no pairs; an empty
table gives an empty result; texts are read whole; columns other than text, lang and source are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.shared import written

MIN_DOCUMENTS = 3
"""Documents of a language that must hold a term for it to be kept."""
TOP_TERMS = 200
SCALE = 1_000_000_000
"""Shares are integers of this scale."""
BLOCK_POSTINGS = 200_000
"""About as many postings (term, group) make a block of the index, which one task holds."""
HELD_TERMS = 300_000
"""A task hands its counts on when it holds so many."""
CHUNK = 2_000_000
"""Postings that are scattered at once."""

# Bytes of a term: ASCII letters, lower-cased, and all bytes of characters beyond ASCII. All others separate.
_FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return text.translate(_FOLDED).split()


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs): occurrences and documents, combined within a task before the shuffle."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    seen = 0

    def handed_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            rows = len(n)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * rows, pa.string()),
                        pa.array([source] * rows, pa.string()),
                        pa.array(list(n), pa.binary()).cast(pa.string()),
                        pa.array(list(n.values()), pa.int64()),
                        pa.array([docs[t] for t in n], pa.int64()),
                    ],
                    names=["lang", "source", "term", "n", "docs"],
                )
        held.clear()

    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for lang, source, text in zip(langs, sources, batch.column("text").cast(pa.binary())):
            found = terms(text.as_py())
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            before = len(n)
            n.update(found)
            docs.update(set(found))
            seen += len(n) - before
            if seen > HELD_TERMS:
                yield from handed_on()
                seen = 0
    yield from handed_on()


def share(count: Column, total: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / total), exactly for any bigint count; 1 where there is nothing to divide by."""
    scaled = (count + 1).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    divided = F.call_function("div", scaled, F.nullif(total, F.lit(0)).cast("decimal(20,0)"))
    return F.coalesce(divided, F.lit(0)) + 1


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def postings_of(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, lang_n, first): kept terms per group with the language's count; ``first`` marks one row
    per term of a language."""
    counts = docs.mapInArrow(count_terms, "lang string, source string, term string, n long, docs long")
    counts = counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    marked = counts.select(
        "lang",
        "source",
        "term",
        "n",
        F.sum("n").over(of_term).alias("lang_n"),
        F.sum("docs").over(of_term).alias("__docs"),
        (F.min("source").over(of_term) == F.col("source")).cast("int").alias("first"),
    )
    return marked.where(F.col("__docs") >= MIN_DOCUMENTS).drop("__docs")


def groups_of(docs: DataFrame, postings: DataFrame) -> DataFrame:
    """(lang, source, gid, total, v, lang_total, blocks, zero): every occurring group, numbered within its language;
    ``zero`` is its share of a term it lacks."""
    per_group = postings.groupBy("lang", "source").agg(
        F.sum("n").alias("__n"), F.sum("first").alias("__v"), F.count("*").alias("__rows")
    )
    every = docs.select("lang", "source").distinct().join(per_group, ["lang", "source"], "left").fillna(0)
    of_lang = Window.partitionBy("lang")
    numbered = every.select(
        "lang",
        "source",
        (F.row_number().over(of_lang.orderBy("source")) - 1).cast("int").alias("gid"),
        F.col("__n"),
        F.sum("__v").over(of_lang).alias("v"),
        F.sum("__n").over(of_lang).alias("__lang_n"),
        F.sum("__rows").over(of_lang).alias("__rows"),
    )
    return numbered.select(
        "lang",
        "source",
        "gid",
        (F.col("__n") + F.col("v")).alias("total"),
        "v",
        (F.col("__lang_n") + F.col("v")).alias("lang_total"),
        F.ceil(F.col("__rows") / BLOCK_POSTINGS).alias("blocks"),
        share(F.lit(0), F.col("__n") + F.col("v")).alias("zero"),
    )


def scattered(block: pd.DataFrame) -> pd.DataFrame:
    """The corrections of the common terms of a block: (lang, gid, peer, value)."""
    code = pd.factorize(block["term"])[0]
    order = np.argsort(code, kind="stable")
    gid, p, zero = (block[c].to_numpy()[order] for c in ("gid", "p", "zero"))
    code = code[order]
    starts = np.concatenate([[0], np.flatnonzero(np.diff(code)) + 1])
    sizes = np.diff(np.append(starts, len(code)))
    rows, firsts = np.unique(np.sort(gid), return_index=True)
    by_group = np.argsort(gid, kind="stable")
    out: list[pd.DataFrame] = []
    for g, own in zip(rows.tolist(), np.split(by_group, firsts[1:])):
        dense = np.zeros(int(rows[-1]) + 1, np.int64)
        touched = np.zeros(len(dense), bool)
        lengths = sizes[code[own]]
        for part in np.split(own, np.flatnonzero(np.diff(lengths.cumsum() // CHUNK)) + 1):
            length = sizes[code[part]]
            ends = length.cumsum()
            at = np.arange(ends[-1]) + np.repeat(starts[code[part]] - (ends - length), length)
            mine, zero_mine = np.repeat(p[part], length), zero[part[0]]
            peer, theirs, zero_theirs = gid[at], p[at], zero[at]
            value = _distance(mine, theirs) - _distance(mine, zero_theirs)
            value += _distance(zero_mine, zero_theirs) - _distance(zero_mine, theirs)
            np.add.at(dense, peer, value)
            touched[peer] = True
        touched[g] = False
        peers = np.flatnonzero(touched)
        out.append(pd.DataFrame({"gid": g, "peer": peers, "value": dense[peers]}))
    found = pd.concat(out)
    found.insert(0, "lang", block["lang"].iloc[0])
    return found


def baselines(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What a group's terms add to its own row and to those of its peers, as if no term were common."""
    for frame in frames:
        for row in frame.itertuples(index=False):
            peers = np.array([p["gid"] for p in row.peers], np.int32)
            zeros = np.array([p["zero"] for p in row.peers], np.int64)
            empty = _distance(np.int64(row.zero), zeros)
            own, theirs = row.v * empty, np.zeros(len(peers), np.int64)
            from_peer = _distance(zeros, np.int64(row.zero))
            for bar in row.bars if row.bars is not None else ():
                own += bar["terms"] * (_distance(np.int64(bar["p"]), zeros) - empty)
                theirs += bar["terms"] * (_distance(zeros, np.int64(bar["p"])) - from_peer)
            other = peers != row.gid
            for gid, peer, value in ((row.gid, peers[other], own), (peers[other], row.gid, theirs)):
                yield pd.DataFrame({"lang": row.lang, "gid": gid, "peer": peer, "value": value[other]})


def pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of sources of a language."""
    sums = "lang string, gid int, peer int, value long"
    common = shares.withColumn("block", F.pmod(F.xxhash64("term"), "blocks"))
    corrected = common.groupBy("lang", "block").applyInPandas(scattered, sums)
    bars = shares.groupBy("lang", "gid", "p").agg(F.count("*").alias("terms"))
    bars = bars.groupBy("lang", "gid").agg(F.collect_list(F.struct("p", "terms")).alias("bars"))
    peers = groups.groupBy("lang").agg(F.collect_list(F.struct("gid", "zero")).alias("peers"))
    base = groups.select("lang", "gid", "zero", "v").join(bars, ["lang", "gid"], "left").join(peers, "lang")
    every = base.mapInPandas(baselines, sums).union(corrected)
    summed = every.groupBy("lang", "gid", "peer").agg(F.sum("value").alias("value"))
    named = groups.select("lang", "gid", "source")
    item = groups.select("lang", F.col("gid").alias("peer"), F.col("source").alias("item"))
    return summed.join(named, ["lang", "gid"]).join(item, ["lang", "peer"]).select("lang", "source", "item", "value")


def audit(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value, rank: all ``pair`` rows and the first TOP_TERMS ``term`` rows of every group."""
    read = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")))
    postings = written(postings_of(read), "divergence-postings")
    groups = written(groups_of(read, postings), "divergence-groups")
    shares = postings.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total")))
    q = share(F.col("lang_n"), F.col("lang_total"))
    own = shares.withColumn("q", q).where("p > q")
    telling = own.select("lang", "source", F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    of_group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        rank = F.row_number().over(of_group).alias("rank")
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", rank)

    top = ranked(telling, "term").where(F.col("rank") <= TOP_TERMS)
    return ranked(pairs(shares, groups), "pair").unionByName(top)
