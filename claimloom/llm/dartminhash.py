"""Near-duplicate documents by DartMinHash, banded joining and an exact check.

Signatures. Every element of a weighted set owns an endless strip, its weight wide, with the rank running upwards. A
hash throws darts into fixed regions of the strip, as many as a Poisson variable of the region's area, so the darts of
an element depend on it alone. A dart's hash gives one of K coordinates, and each coordinate keeps its lowest dart.
Two sets agree in a coordinate with the probability of their weighted Jaccard similarity. Only about K log K darts per
set are thrown: regions are taken in order of rank until every coordinate has one.

Classes. Equal texts are one node. Nodes that agree in all rows of a band meet in a bucket. In each bucket all nodes
are compared with its most central one (that with the most company over all its buckets), which is linear in the size
of the bucket. Buckets that then still hold several classes get CENTRES more centres, one after the other, each compared
with the members of other classes; near copies of one text are one class after a few. What is still apart is compared
in pairs of different classes if the similarity can reach the threshold, so no link is lost to the choice of a centre:
by a bound that is exact, from the number of shingles that each has in common with other classes at all, and by sketches
of their signatures. Every link is decided by the exact Jaccard similarity of the sets of five-word shingles;
classes are the connected components of the links.

At similarity 0.8 a pair misses all BANDS bands with probability 2e-5; SKETCH_SLACK is five standard deviations (3e-7).

Defined results: a null text is an empty one; texts without words are duplicates of equal texts only; texts of fewer
than five words have one shingle, of all their words; words are compared without case and punctuation. Repeated rows
and rows without an id belong to the class of their text; a class is named by its smallest id. An empty table gives an
empty result; columns other than the named ones are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.shared import connected_components, joined_components, spare_prefix, with_keys, written

SHINGLE = 5
SIMILARITY = 0.8
ROWS, BANDS = 8, 60
SKETCH_BITS = 4
SKETCH_SLACK = 133
"""Most differing coordinates of 480, by SKETCH_BITS bits of each, for a pair to be compared: 90 are expected at similarity
0.8, with a standard deviation of 8.7, and 166 at 0.63."""
CENTRES = 6
"""Rounds of new centres for buckets that hold several classes."""
AT_ONCE = 32
"""Sets whose darts are thrown together."""

_FOLD = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER)


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as many as were asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            base = 0xD1342543DE82EF95
            for name, b in (("up", base), ("down", pow(base, -1, 2**64))):
                factors = np.full(2 * n, b, np.uint64)
                factors[0] = 1
                with np.errstate(over="ignore"):
                    setattr(self, name, np.cumprod(factors, dtype=np.uint64))


_POWERS = Powers()


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of ``size`` words.

    The hash of a run is a polynomial over its bytes, taken from prefix sums over the whole text.
    """
    words = (text or "").lower().encode("utf-8", "surrogatepass").translate(_FOLD).split()
    if not words:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(b" ".join(words), np.uint8)
    _POWERS.grow(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * _POWERS.up[: len(data)], dtype=np.uint64)])
    ends = np.append(np.flatnonzero(data == 0x20), len(data))
    starts = np.append(0, ends[:-1] + 1)
    n = min(size, len(words))
    first, last = starts[: len(words) - n + 1], ends[n - 1 :]
    with np.errstate(over="ignore"):
        return np.unique(mix((sums[last] - sums[first]) * _POWERS.down[first]))


class Darts:
    """Signatures of k coordinates for sets of 64-bit elements with positive weights."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.thrown = k * np.log(k) + 0.5 * k
        self.tables: dict[tuple[int, int], np.ndarray] = {}

    @staticmethod
    def ranks(area: int) -> tuple[float, float]:
        """The region's ranks: up to 1/8, then doubling."""
        return (0.0, 0.125) if area == 0 else (2.0 ** (area - 4), 2.0 ** (area - 3))

    @staticmethod
    def weights(layer: int) -> tuple[float, float]:
        """The region's weights: up to 1, then doubling."""
        return (0.0, 1.0) if layer == 0 else (2.0 ** (layer - 1), 2.0**layer)

    def poisson(self, area: int, layer: int) -> np.ndarray:
        """The distribution function of the number of darts in a region."""
        if (area, layer) not in self.tables:
            low, high = self.ranks(area)
            left, right = self.weights(layer)
            mean = (high - low) * (right - left)
            counts = np.arange(int(mean + 12 * np.sqrt(mean) + 24))
            logs = counts * np.log(mean) - mean - np.concatenate([[0], np.cumsum(np.log(counts[1:]))])
            self.tables[area, layer] = np.cumsum(np.exp(logs))[:-1]
        return self.tables[area, layer]

    def throw(self, out: np.ndarray, elements: np.ndarray, owner: np.ndarray, weight: np.ndarray | None, area: int):
        """Add the darts of one region of ranks to ``out``, a flat array of k lowest darts per owner."""
        layer = 0
        while layer == 0 or (weight is not None and len(elements)):
            left, right = self.weights(layer)
            if weight is not None:
                inside = weight > left
                elements, owner, weight = elements[inside], owner[inside], weight[inside]
            with np.errstate(over="ignore"):
                own = mix(elements + np.uint64(area * 64 + layer + 1) * _MULTIPLIER)
            chance = (own >> np.uint64(11)).astype(np.float64) * 2.0**-53
            counts = np.searchsorted(self.poisson(area, layer), chance, "right")
            some = np.flatnonzero(counts)
            counts = counts[some]
            total = int(counts.sum())
            number = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
            index = np.repeat(some, counts)
            with np.errstate(over="ignore"):
                dart = mix(own[index] + (number + 1).astype(np.uint64) * _MULTIPLIER)
                more = mix(dart + _MULTIPLIER)
            low, high = self.ranks(area)
            rank = (low + (high - low) * ((dart >> np.uint64(40)).astype(np.float64) * 2.0**-24)).astype(np.float32)
            value = (rank.view(np.uint32).astype(np.uint64) << np.uint64(32)) | (more & np.uint64(0xFFFFFFFF))
            coordinate = ((more >> np.uint64(32)) * np.uint64(self.k)) >> np.uint64(32)
            place = owner[index] * self.k + coordinate.astype(np.int64)
            if weight is not None:  # the dart's own weight, from bits that the rank does not use
                at = left + (right - left) * ((dart & np.uint64(0xFFFFFF)).astype(np.float64) * 2.0**-24)
                hit = at < weight[index]
                place, value = place[hit], value[hit]
            np.minimum.at(out, place, value)
            layer += 1

    def sign(self, sets: list[np.ndarray], weights: list[np.ndarray] | None = None) -> np.ndarray:
        """One row of k values per set; all ones for an empty set."""
        none = np.uint64(2**64 - 1)
        out = np.full(len(sets) * self.k, none)
        elements = np.concatenate([*sets, np.zeros(0, np.uint64)])
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        weight = None if weights is None else np.concatenate([*weights, np.zeros(0)])
        total = np.bincount(owner, weight, minlength=len(sets))
        enough = self.thrown / np.maximum(total, 1e-300)
        open_, area = total > 0, 0
        while open_.any():
            mine = open_[owner]
            self.throw(out, elements[mine], owner[mine], None if weight is None else weight[mine], area)
            if self.ranks(area)[1] * total[open_].max() >= self.k:
                full = (out.reshape(-1, self.k) != none).all(axis=1)
                open_ &= ~(full & (self.ranks(area)[1] >= enough)) if area < 60 else False
            area += 1
        return out.reshape(len(sets), self.k)


def banded(signatures: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band, the band's number included."""
    n, k = signatures.shape
    parts = signatures.reshape(n, k // rows, rows)
    key = np.broadcast_to(np.arange(1, k // rows + 1, dtype=np.uint64) * _MULTIPLIER, parts.shape[:2])
    with np.errstate(over="ignore"):
        for r in range(rows):
            key = mix(key + parts[:, :, r])
    return key


def sketches(signatures: np.ndarray) -> np.ndarray:
    """SKETCH_BITS bits of every coordinate, packed into 64-bit integers."""
    few = (signatures & np.uint64(2**SKETCH_BITS - 1)).astype(np.uint8)
    packed = (few[:, ::2] << np.uint8(SKETCH_BITS)) | few[:, 1::2]
    padded = np.zeros((len(packed), -(-packed.shape[1] // 8) * 8), np.uint8)
    padded[:, : packed.shape[1]] = packed
    return padded.view("<i8")


def differing(one: str, other: str) -> F.Column:
    """How many coordinates of two sketches differ."""
    words = -(-ROWS * BANDS * SKETCH_BITS // 64)
    lowest = int("1" * 16, 16)

    def count(i: int) -> F.Column:
        x = F.get(one, i).bitwiseXOR(F.get(other, i))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        return F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseAND(F.lit(lowest)))

    return reduce(add, (count(i) for i in range(words)))


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, print, bands, sketch) per row; ``print`` identifies the text."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", F.sha2(F.col("text"), 256).alias("print"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        darts = Darts(ROWS * BANDS)
        for batch in batches:
            for at in range(0, len(batch), AT_ONCE):
                part = batch.slice(at, AT_ONCE)
                sets = [shingles(t.as_py()) for t in part.column("text")]
                signatures = darts.sign(sets)
                filled = np.array([len(s) > 0 for s in sets])
                columns = []
                for values in (banded(signatures, ROWS).view(np.int64), sketches(signatures)):
                    ends = np.concatenate([[0], np.cumsum(filled * values.shape[1])]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(values[filled].ravel())))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("print"), *columns], ["doc_id", "print", "bands", "sketch"]
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, print string, bands array<long>, sketch array<long>")


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets have the similarity, exactly."""
    one = sets.select(F.col("node").alias("a"), F.col("elements").alias("x"))
    other = sets.select(F.col("node").alias("b"), F.col("elements").alias("y"))
    both = pairs.select("a", "b").join(one, "a").join(other, "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                one, two = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                small, large = (one, two) if len(one) <= len(two) else (two, one)
                if len(small) < similarity * len(large):
                    keep.append(False)
                    continue
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                shared = int((large[at] == small).sum())
                keep.append(shared >= similarity * (len(one) + len(two) - shared) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def element_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, elements): the shingles of the nodes' texts; ``nodes`` has node, doc_id and print."""
    asked = nodes.select("node", F.col("doc_id").alias("__id"), "print")
    # A null id is asked for under the hash of nothing, as semi-joins skip nulls.
    key = lambda c: F.xxhash64(F.col(c)).alias("__key")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), key("doc_id"))
    texts = with_keys(rows, asked.select(key("__id"))).join(asked, F.col("doc_id").eqNullSafe(F.col("__id")))
    texts = texts.where(F.sha2(F.col("text"), 256) == F.col("print")).select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py()).astype("<u8").tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], ["node", "elements"])

    return texts.mapInArrow(run, "node long, elements binary").dropDuplicates(["node"])


def shared_with_others(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, class, size, shared): how many elements a set has, and how many that some other class has as well.

    No more than those can be shared with a set of another class, which bounds the similarity from above.
    """
    chosen = sets.join(classes, "node")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.frombuffer(e.as_buffer(), "<i8") for e in batch.column("elements")]
            at = pa.array(np.repeat(np.arange(len(parts)), [len(p) for p in parts]))
            elements = pa.array(np.concatenate([*parts, np.zeros(0, np.int64)]))
            columns = [batch.column("node").take(at), batch.column("class").take(at), elements]
            yield pa.RecordBatch.from_arrays(columns, ["node", "class", "element"])

    elements = chosen.mapInArrow(spread, "node long, class long, element long")
    per_element = elements.groupBy("element").agg(F.min("class").alias("__lo"), F.max("class").alias("__hi"))
    common = per_element.where("__lo < __hi").select("element", F.lit(1).alias("__one"))
    counted = elements.join(common, "element", "left").groupBy("node", "class")
    return counted.agg(F.count("*").alias("size"), F.count("__one").alias("shared"))


def apart(members: DataFrame, classes: DataFrame) -> DataFrame:
    """(key, node, class) of the buckets that hold several classes."""
    named = members.join(classes, "node", "left").withColumn("class", F.coalesce("component", "node"))
    mixed = named.groupBy("key").agg(F.min("class").alias("__lo"), F.max("class").alias("__hi")).where("__lo < __hi")
    return written(named.join(mixed, "key").select("key", "node", "class"), "near-rest")


def able_of(sets: DataFrame, rest: DataFrame, similarity: float) -> DataFrame:
    """(node, class, size, shared) of the members that can be like one of another class at all."""
    able = shared_with_others(sets, rest.select("node", "class").distinct())
    return able.where(F.col("shared") >= F.col("size") * F.lit(similarity) - 1e-9)


def classes_of(docs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """(node, component) of the nodes that are like another one. ``nodes``: node, doc_id, print, bands, sketch."""
    keys = nodes.select("node", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = written(keys.join(shared, "key"), "near-members")
    centrality = members.groupBy("node").agg(F.sum("n").alias("c"))
    centres = (
        members.join(centrality, "node").groupBy("key").agg(F.max(F.struct("c", "node"))["node"].alias("centre"))
    )
    to_centre = members.join(centres, "key").where("node <> centre").select(
        F.col("node").alias("a"), F.col("centre").alias("b")
    )
    asked = nodes.join(centrality.select("node"), "node", "left_semi")
    sets = written(element_sets(docs, asked), "near-sets")
    first = written(verified(to_centre.distinct(), sets, similarity), "near-links")
    classes = written(connected_components(first, "near-classes"), "near-classes")
    rest = apart(members, classes)
    for turn in range(CENTRES):
        able = able_of(sets, rest, similarity)
        rest = written(rest.join(able.select("node"), "node", "left_semi"), "near-rest")
        # The member with the lowest hash of the round: the same one in most of the buckets it is in.
        order = F.struct(F.xxhash64(F.lit(turn), "node").alias("__h"), F.col("node").alias("centre"), "class")
        chosen = rest.groupBy("key").agg(F.min(order).alias("__c")).select("key", "__c.centre", F.col("__c.class").alias("__of"))
        tried = rest.join(chosen, "key").where(F.col("class") != F.col("__of"))
        tried = tried.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
        found = written(verified(tried, sets, similarity), "near-links")
        if found.isEmpty():
            break
        classes = written(joined_components(classes, found, "near-classes"), "near-classes")
        rest = apart(rest.drop("class"), classes)
    able = able_of(sets, rest, similarity)
    rest = rest.drop("class").join(written(able.join(nodes.select("node", "sketch"), "node"), "near-able"), "node")
    columns = ["node", "class", "sketch", "size", "shared"]
    left = rest.select("key", *(F.col(c).alias(f"{c}_a") for c in columns))
    right = rest.select("key", *(F.col(c).alias(f"{c}_b") for c in columns))
    differ = differing("sketch_a", "sketch_b")
    # Shared elements are in both shared parts; the union has all of one set and what the other shares with no class.
    most = F.least("shared_a", "shared_b")
    least = F.col("size_a") + F.col("size_b") - F.least("shared_a", "shared_b")
    able = most >= least * F.lit(similarity) - 1e-9
    close = (left.key == right.key) & (F.col("class_a") < F.col("class_b")) & able & (differ <= SKETCH_SLACK)
    near = left.join(right, close).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    across = near.select("a", "b").distinct().join(first, ["a", "b"], "left_anti")
    return joined_components(classes, verified(across, sets, similarity), "near-classes")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, print, class_id, class_size, keeps.

    ``class_id``: the smallest id of the class; ``keeps``: whether this is the text of the class that stays, the one of
    the smallest id.
    """
    rows = written(signed(docs), "near-signed")
    # Equal texts have equal signatures, so any one of them will do.
    texts = rows.groupBy("print").agg(
        F.min("doc_id").alias("doc_id"),
        F.any_value("bands").alias("bands"),
        F.any_value("sketch").alias("sketch"),
        F.count("*").alias("copies"),
    )
    nodes = written(texts.withColumn("node", F.monotonically_increasing_id()), "near-nodes")
    classes = classes_of(docs, nodes, similarity)
    named = nodes.select("node", "print", "doc_id", "copies").join(classes, "node", "left")
    named = written(named.withColumn("class", F.coalesce("component", "node")).drop("component"), "near-named")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "print"))
    sizes = named.groupBy("class").agg(first.alias("first"), F.sum("copies").alias("class_size"))
    told = named.join(sizes, "class").select(
        "print",
        F.col("first.doc_id").alias("class_id"),
        "class_size",
        (F.col("first.print") == F.col("print")).alias("__first"),
    )
    found = rows.select("doc_id", "print").join(told, "print")
    keeps = F.col("__first") & F.col("doc_id").eqNullSafe(F.col("class_id"))
    return found.select("doc_id", "print", "class_id", "class_size", keeps.alias("keeps"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """One document of every class, that of the smallest id; the columns of the input."""
    p = spare_prefix(docs.columns)
    id_, print_, key, turn = (p + n for n in ("id", "print", "key", "turn"))
    kept = near_duplicates(docs).where("keeps").select(F.struct("doc_id", "print").alias(key)).distinct()
    keyed = docs.withColumns({id_: F.col("doc_id"), print_: F.sha2(F.coalesce("text", F.lit("")), 256)})
    same = F.col(id_).eqNullSafe(F.col(f"{key}.doc_id")) & (F.col(print_) == F.col(f"{key}.print"))
    found = keyed.join(kept, same, "left_semi")
    # Repeated rows: the same text under the same id, once.
    nth = F.row_number().over(Window.partitionBy(id_, print_).orderBy(print_))
    return found.withColumn(turn, nth).where(F.col(turn) == 1).select(*(F.col(f"`{c}`") for c in docs.columns))
