"""Hard-negative mining: a cover tree per shard over norm-augmented vectors, searched best-first within score windows.

A score is an inner product of integer vectors. With one more component, sqrt(M^2 - |x|^2), all rows of a shard lie on
a sphere of radius M, where the score of a row and a query falls with their angle. The cover tree is built over these
points: at every level centres are further apart than the level's radius and every row is within it of its centre. A
node keeps the largest distance from its centre to a row below it, so its rows' scores lie between those of two angles.
The search takes the nodes with the highest bound first, leaves out those that lie outside all windows still open, and
scores the rows of the others exactly in integers. So results are exact; the tree only saves work.

Rows are dealt to shards by hash, whatever their label, so a hot label or a hot group is spread. A shard's tree is one
row of flat arrays of a written table. All queries go to every shard in one shuffle, are read there batch by batch
behind the shard's tree, and the best of all shards are merged by a window that Spark limits per task.

Defined results: a row takes part if id, label and vector are not null and all components are finite and small enough
that no score leaves a bigint (its own squared length is below 2^61); of rows that repeat an id, the smallest by
length, vector and label is the id's only row; vectors are compared with those of their own length; equal vectors and
ties are ordered by id; an anchor without another row of its label has no result, as has a positive without a negative
in its window, always so where the positive's score is negative; an empty table gives an empty result; columns other
than the named ones are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.shared import written

BASE = 1.3
"""The radius of a level is this power of the one below it."""
LEAF = 48
"""A node of so few rows is not divided further."""
SHARD_ROWS = 8192
"""Rows per shard, about."""
POSITIVES = 5
NEGATIVES = 5
SCALE = 256
AT_ONCE = 12
"""Nodes that are opened together."""
SLACK = 1e-7
"""Share of the largest possible score by which bounds are widened, far above the rounding of doubles."""
LARGEST_LENGTH = 2.0**61

TREE = (
    "shard int, dim int, n int, vectors binary, ids binary, labels binary, slot_node binary, "
    "node_slot binary, node_radius binary, node_low binary, node_high binary, node_next binary"
)
FLAT = {
    "vectors": "<i8", "ids": "<i8", "labels": "<i8", "slot_node": "<i4", "node_slot": "<i4", "node_radius": "<f8",
    "node_low": "<i4", "node_high": "<i4", "node_next": "<i4",
}


def distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(np.square(points - centre).sum(axis=1))


def augmented(vectors: np.ndarray) -> tuple[np.ndarray, float]:
    """The vectors as doubles with the component that puts them on a sphere, and its radius."""
    points = vectors.astype("f8")
    squares = np.square(points).sum(axis=1)
    largest = float(squares.max(initial=0.0))
    return np.column_stack([points, np.sqrt(largest - squares)]), math.sqrt(largest)


def centres_of(points: np.ndarray, rows: np.ndarray, radius: float) -> list[tuple[int, np.ndarray]]:
    """Rows further apart than the radius, each with the rows within it that no earlier one has taken."""
    found: list[tuple[int, np.ndarray]] = []
    squares = np.square(points[rows]).sum(axis=1)
    while len(rows):
        some = rows[:64]
        between = squares[: len(some), None] + squares[None, :] - 2.0 * (points[some] @ points[rows].T)
        near = between <= radius * radius
        free = np.ones(len(rows), bool)
        for i, centre in enumerate(some.tolist()):
            if free[i]:
                free[i] = False
                taken = near[i] & free
                free &= ~taken
                found.append((centre, rows[taken]))
        rows, squares = rows[free], squares[free]
    return found


class CoverTree:
    """Flat arrays. A slot is a row in the order of the tree. A node is a centre at one level: the slots from
    ``node_low`` to ``node_high`` are the other centres below it (or the rows of a leaf), ``node_next`` is the same
    centre one level down, ``node_radius`` the largest distance to a row below. ``slot_node`` is a slot's first node.
    """

    def __init__(self, **arrays: np.ndarray) -> None:
        self.__dict__.update(arrays)
        self.points, self.radius = augmented(self.vectors)
        largest = int(np.abs(self.vectors).max(initial=0))
        # In doubles, which are exact so far, products are much faster than in integers.
        self.exact_below = 2.0**53 / max(1, largest * self.vectors.shape[1])
        self.floats = self.vectors.astype("f8")
        # A chord of length r of the sphere spans this angle.
        chords = self.node_radius / (2.0 * self.radius) if self.radius else self.node_radius * 0.0
        self.angles = 2.0 * np.arcsin(np.minimum(1.0, chords)) if len(chords) else chords

    @classmethod
    def build(cls, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> CoverTree:
        points, _ = augmented(vectors)
        order: list[int] = [0]
        slot_node: list[int] = [-1]
        nodes: dict[str, list] = {c: [] for c in ("slot", "radius", "low", "high", "next")}
        # (slot of the centre, its rows, node that continues here or -1)
        todo = [(0, np.arange(1, len(vectors)), -1)]
        while todo:
            slot, rows, above = todo.pop()
            if not len(rows):
                continue
            node = len(nodes["slot"])
            if above < 0:
                slot_node[slot] = node
            else:
                nodes["next"][above] = node
            away = distances(points[rows], points[order[slot]])
            radius = float(away.max())
            low = len(order)
            if len(rows) <= LEAF or radius == 0.0:
                order += rows.tolist()
                slot_node += [-1] * len(rows)
            else:
                below = BASE ** (math.ceil(math.log(radius, BASE)) - 1)
                below = below if below < radius else radius / BASE
                todo.append((slot, rows[away <= below], node))
                for centre, members in centres_of(points, rows[away > below], below):
                    todo.append((len(order), members, -1))
                    order.append(centre)
                    slot_node.append(-1)
            for c, value in zip(nodes, (slot, radius, low, len(order), -1)):
                nodes[c].append(value)
        kinds = {"radius": "<f8"}
        return cls(
            vectors=vectors[order], ids=ids[order], labels=labels[order], slot_node=np.array(slot_node, "<i4"),
            **{f"node_{c}": np.array(v, kinds.get(c, "<i4")) for c, v in nodes.items()},
        )

    def as_row(self) -> dict:
        return {c: getattr(self, c).astype(kind).tobytes() for c, kind in FLAT.items()}

    @classmethod
    def from_row(cls, row) -> CoverTree:
        arrays = {c: np.frombuffer(getattr(row, c), kind) for c, kind in FLAT.items()}
        arrays["vectors"] = arrays["vectors"].reshape(int(row.n), int(row.dim))
        return cls(**arrays)

    def scores(self, query: np.ndarray, slots: np.ndarray) -> np.ndarray:
        if float(np.abs(query).max(initial=0)) < self.exact_below:
            return (self.floats[slots] @ query.astype("f8")).astype(np.int64)
        return self.vectors[slots] @ query

    def search(
        self, query: np.ndarray, own: int, label: int, same_label: bool, windows: Sequence[tuple[int, int]], k: int
    ) -> list[list[tuple[int, int]]]:
        """Per window (lowest, highest score) the first k rows as (score, id), by falling score and rising id.

        Only rows of the label (``same_label``), or only those of other labels; never the row with id ``own``.
        """
        best: list[list[tuple[int, int]]] = [[] for _ in windows]
        lows, highs = [low for low, _ in windows], [high for _, high in windows]
        length = math.sqrt(float(np.square(query.astype("f8")).sum()))
        span = self.radius * length
        slack = span * SLACK + 2.0

        def offer(slots: np.ndarray, scores: np.ndarray) -> None:
            take = (scores >= min(lows)) & (scores <= max(highs))
            take &= (self.labels[slots] == label) == same_label
            take &= self.ids[slots] != own
            if not take.any():
                return
            rows = list(zip(scores[take].tolist(), self.ids[slots[take]].tolist()))
            for w, found in enumerate(best):
                new = [r for r in rows if lows[w] <= r[0] <= highs[w]]
                if new:
                    found += new
                    found.sort(key=lambda r: (-r[0], r[1]))
                    del found[k:]
                    if len(found) == k:
                        lows[w] = max(lows[w], found[-1][0])

        def bounds(scores: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            if not span:
                return scores - slack, scores + slack
            angle = np.arccos(np.clip(scores / span, -1.0, 1.0))
            wide = self.angles[nodes]
            high = span * np.cos(np.maximum(0.0, angle - wide)) + slack
            return span * np.cos(np.minimum(math.pi, angle + wide)) - slack, high

        def open_windows(low: float, high: float) -> bool:
            return any(high >= a and low <= b for a, b in zip(lows, highs))

        first = np.array([0])
        scores = self.scores(query, first)
        offer(first, scores)
        todo: list[tuple[float, float, int, int]] = []  # (-upper bound, lower bound, node, score of its centre)
        if self.slot_node[0] >= 0:
            root = np.array([self.slot_node[0]])
            low, high = bounds(scores, root)
            todo.append((-float(high[0]), float(low[0]), int(root[0]), int(scores[0])))
        while todo:
            opened: list[tuple[int, int]] = []
            while todo and len(opened) < AT_ONCE:
                high, low, node, score = heapq.heappop(todo)
                if -high < min(lows):
                    todo.clear()
                elif open_windows(low, -high):
                    opened.append((node, score))
            if not opened:
                continue
            nodes = np.array([n for n, _ in opened])
            slots = np.concatenate([np.arange(self.node_low[n], self.node_high[n]) for n in nodes])
            scores = self.scores(query, slots)
            offer(slots, scores)
            below = self.slot_node[slots]
            inner = below >= 0
            on = self.node_next[nodes]
            same = on >= 0
            children = np.concatenate([below[inner], on[same]])
            if len(children):
                own_scores = np.concatenate([scores[inner], np.array([s for _, s in opened], np.int64)[same]])
                low, high = bounds(own_scores, children)
                keep = (high >= min(lows)) & (low <= max(highs))
                for entry in zip((-high[keep]).tolist(), low[keep].tolist(), children[keep].tolist(), own_scores[keep].tolist()):
                    heapq.heappush(todo, entry)
        return best


def quantised(vectors: DataFrame, id_column: str, vector_column: str, label: Column, scale: int = SCALE) -> DataFrame:
    """(vec_id, vector, dim, label), one row per id: the rows that take part, their components as integers."""
    v = F.transform(F.col(vector_column).cast("array<double>"), lambda x: x * scale)
    finite = F.forall("__v", lambda x: x.isNotNull() & ~F.isnan(x))
    length = F.aggregate("__v", F.lit(0.0), lambda total, x: total + F.pow(F.abs(x) + 1, 2))
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), label.cast("long").alias("label"), v.alias("__v"))
    rows = rows.where("vec_id is not null and label is not null and __v is not null").where(finite)
    rows = rows.where(length < LARGEST_LENGTH)
    whole = rows.select("vec_id", "label", F.transform("__v", lambda x: F.floor(x)).alias("vector"))
    one = whole.groupBy("vec_id").agg(F.min(F.struct(F.size("vector").alias("dim"), "vector", "label")).alias("__r"))
    return one.select("vec_id", "__r.vector", "__r.dim", "__r.label")


def build_trees(points: DataFrame, copies: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The table of trees. Of rows with equal vector and label the ``copies`` smallest ids are kept: they have the same
    score for every query, so no search for fewer rows can return a later one."""
    nth = F.row_number().over(Window.partitionBy("vector", "label").orderBy("vec_id"))
    kept = written(points.withColumn("__n", nth).where(F.col("__n") <= copies).drop("__n"), "negatives-points")
    shards = max(1, -(-kept.count() // shard_rows))

    def make(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("vec_id")
        vectors = np.stack(frame["vector"].to_list()).astype("<i8")
        tree = CoverTree.build(vectors, frame["vec_id"].to_numpy(), frame["label"].to_numpy())
        row = {"shard": int(frame["shard"].iloc[0]), "dim": vectors.shape[1], "n": len(vectors)}
        return pd.DataFrame([row | tree.as_row()])

    dealt = kept.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    spread = dealt.repartition(shards, "shard")
    return written(spread.groupBy("shard", "dim").applyInPandas(make, TREE), "negatives-trees")


QUERY = "vec_id long, vector array<long>, label long, windows array<struct<low: long, high: long>>"
FOUND = "query_id long, window int, vec_id long, score long"


def search(trees: DataFrame, queries: DataFrame, shards: int, same_label: bool, k: int) -> DataFrame:
    """query_id, window, vec_id, score: the first k rows of every shard for every window of every query.

    A task reads a shard's tree and then the queries behind it, a batch at a time, so only the tree has to fit.
    """
    names = [f.name for f in trees.schema if f.name not in ("shard", "dim")]
    asked = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        "dim",
        F.lit(1).alias("kind"),
        F.struct("vec_id", "vector", "label", "windows").alias("query"),
        *(F.lit(None).cast(trees.schema[c].dataType).alias(c) for c in names),
    )
    empty = F.lit(None).cast(asked.schema["query"].dataType).alias("query")
    behind = trees.select("shard", "dim", F.lit(0).alias("kind"), empty, *names).unionByName(asked)
    behind = behind.repartition(shards, "shard").sortWithinPartitions("shard", "dim", "kind")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree, at = None, None
        for frame in frames:
            out: list[tuple[int, int, int, int]] = []
            for row in frame.itertuples(index=False):
                if row.kind == 0:
                    tree, at = CoverTree.from_row(row), (row.shard, row.dim)
                elif at == (row.shard, row.dim):  # else no row has vectors of this length here
                    q = row.query
                    windows = [(w["low"], w["high"]) for w in q["windows"]]
                    vector = np.asarray(q["vector"], np.int64)
                    found = tree.search(vector, q["vec_id"], q["label"], same_label, windows, k)
                    out += [(q["vec_id"], w, i, s) for w, rows in enumerate(found) for s, i in rows]
            yield pd.DataFrame(out, columns=["query_id", "window", "vec_id", "score"])

    return behind.mapInPandas(run, FOUND)


def mine(
    points: DataFrame, anchors: DataFrame, lowest_percent: int = 80, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``points`` and ``anchors`` as :func:`quantised` gives them. Per anchor the POSITIVES best other rows of its label,
    and per positive the NEGATIVES best rows of other labels that score at most as much as it, and at least
    ``lowest_percent`` percent of that.
    """
    trees = build_trees(points, max(POSITIVES + 1, NEGATIVES), shard_rows)
    shards = (trees.agg(F.max("shard")).first()[0] or 0) + 1
    asked = written(anchors, "negatives-anchors")
    unbounded = F.array(F.struct(F.lit(-(2**62)).alias("low"), F.lit(2**62).alias("high")))
    found = search(trees, asked.withColumn("windows", unbounded), shards, True, POSITIVES)
    first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= POSITIVES)
    positives = written(best.select("query_id", "rank", "vec_id", "score"), "negatives-positives")

    per_anchor = positives.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("positives")
    )
    # The least integer that is at least so many percent is a floor of the negated value.
    ranges = F.transform("positives", lambda p: F.struct(
        (-F.floor(-(p["score"].cast("decimal(20,0)") * lowest_percent) / 100)).cast("long").alias("low"),
        p["score"].alias("high"),
    ))
    windowed = asked.join(per_anchor, asked["vec_id"] == per_anchor["query_id"]).withColumn("windows", ranges)
    found = search(trees, windowed, shards, False, NEGATIVES)
    nth = Window.partitionBy("query_id", "window").orderBy(F.desc("score"), "vec_id")
    hard = found.withColumn("rank", F.row_number().over(nth)).where(F.col("rank") <= NEGATIVES).alias("n")
    of = positives.withColumn("window", F.col("rank") - 1).drop("rank").alias("p")
    joined = hard.join(of, (F.col("n.query_id") == F.col("p.query_id")) & (F.col("n.window") == F.col("p.window")))
    return joined.select(
        F.col("n.query_id").alias("anchor_id"),
        F.col("p.vec_id").alias("positive_id"),
        F.col("n.rank").alias("rank"),
        F.col("n.vec_id").alias("negative_id"),
        F.col("p.score").alias("positive_score"),
        F.col("n.score").alias("negative_score"),
    )
