"""Approximate nearest neighbours: one hierarchical navigable small-world graph per shard, results merged.

Equal vectors are indexed once, with the ids that a search can return for them. Distinct vectors are dealt to shards by
hash. A shard's graph is kept as flat neighbour arrays, one row of a written table per shard. Queries are packed into
blocks; every block meets every shard in an equality join on the shard number, and the nearest of all shards are merged.

Defined results: vectors that are null, of zero length, zero, or that hold null or non-finite components take no part;
vectors are compared with those of their own length only; rows of equal id and vector count once; of an id with several
vectors the shortest and then smallest one is searched, and all can be found; ties go to the smaller id; with fewer
candidates than asked for all are returned; an empty table gives an empty result; columns other than the named ones are
not read. Components may be of any finite size: graphs are built over vectors that are moved and scaled.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.shared import written

LINKS = 16
"""Neighbours per node on the upper levels, twice as many on the lowest."""
BREADTH_BUILD = 80
BREADTH_SEARCH = 96
SHARD_ROWS = 8192
"""Distinct vectors per shard, about: larger shards are searched faster, smaller ones are built by more tasks."""
QUERY_BLOCK = 1024

INDEX = "shard int, dim int, n int, entry int, vectors binary, ids binary, starts binary, levels binary, links binary"


class Graph:
    """A graph over the rows of ``vectors``; ``links[level]`` is a flat array of neighbours, -1 where there is none."""

    def __init__(self, vectors: np.ndarray, links: list[np.ndarray], entry: int) -> None:
        self.vectors, self.links, self.entry = vectors, links, entry

    def distances(self, query: np.ndarray, rows: np.ndarray | list[int]) -> np.ndarray:
        """Squared distances. Differences are squared, as the difference of squares would cancel off the origin."""
        apart = self.vectors[rows] - query
        return np.einsum("ij,ij->i", apart, apart)

    def descend(self, query: np.ndarray, start: int, level: int) -> int:
        """The node of a level that no neighbour is nearer than."""
        best = float(self.distances(query, [start])[0])
        while True:
            near = self.links[level][start]
            near = near[near >= 0]
            if not len(near):
                return start
            d = self.distances(query, near)
            i = int(d.argmin())
            if not d[i] < best:
                return start
            start, best = int(near[i]), float(d[i])

    def search(self, query: np.ndarray, starts: list[int], level: int, breadth: int, seen: np.ndarray, mark: int):
        """The ``breadth`` nearest nodes found from ``starts``, as a list of (distance, node)."""
        seen[starts] = mark
        found = [(-d, s) for d, s in zip(self.distances(query, starts).tolist(), starts)]
        todo = [(-d, s) for d, s in found]
        heapq.heapify(found)
        heapq.heapify(todo)
        links = self.links[level]
        while todo:
            d, node = heapq.heappop(todo)
            if len(found) >= breadth and d > -found[0][0]:
                break
            near = links[node]
            near = near[near >= 0]
            near = near[seen[near] != mark]
            if not len(near):
                continue
            seen[near] = mark
            distances = self.distances(query, near)
            if len(found) >= breadth:
                close = distances < -found[0][0]
                near, distances = near[close], distances[close]
            for e, n in zip(distances.tolist(), near.tolist()):
                if len(found) < breadth:
                    heapq.heappush(found, (-e, n))
                elif e < -found[0][0]:
                    heapq.heapreplace(found, (-e, n))
                else:
                    continue
                heapq.heappush(todo, (e, n))
        return sorted((-d, n) for d, n in found)


def choose(graph: Graph, found: list[tuple[float, int]], node: np.ndarray, most: int) -> list[int]:
    """Neighbours that are nearer to the node than to any neighbour chosen before; then the nearest others."""
    rows = np.array([n for _, n in found])
    vectors = graph.vectors[rows] - node  # around the node, so that what cancels is no larger than the neighbourhood
    norms = np.einsum("ij,ij->i", vectors, vectors)
    between = norms[:, None] + norms[None, :] - 2.0 * (vectors @ vectors.T)
    chosen: list[int] = []
    for i, (d, _) in enumerate(found):
        if len(chosen) == most:
            break
        if not chosen or d < between[i, chosen].min():
            chosen.append(i)
    if len(chosen) < most:
        rest = [i for i in range(len(found)) if i not in set(chosen)]
        chosen += rest[: most - len(chosen)]
    return rows[chosen].tolist()


def scaled(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple[int, int]]:
    """The vectors moved to their mean and scaled by powers of two, so that their squares neither leave the doubles nor
    vanish; with the mean and the two exponents for :func:`placed`."""
    first = int(np.frexp(np.abs(vectors).max(initial=0.0))[1])
    near_one = np.ldexp(vectors, -first)
    mean = near_one.mean(axis=0)
    second = int(np.frexp(np.abs(near_one - mean).max(initial=0.0))[1])
    return np.ldexp(near_one - mean, -second), mean, (first, second)


def placed(query: np.ndarray, mean: np.ndarray, exponents: tuple[int, int]) -> np.ndarray:
    """A query among scaled vectors. One that is beyond all of them by far is drawn in, where its order of them stays."""
    with np.errstate(over="ignore"):
        moved = np.ldexp(np.ldexp(query, -exponents[0]) - mean, -exponents[1])
    return np.clip(moved, -1e100, 1e100)


def euclidean(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Distances in double precision, scaled by a power of two per row where squares would leave the doubles."""
    with np.errstate(over="ignore"):
        apart = vectors - query
        power = np.frexp(np.abs(apart).max(axis=1, initial=0.0))[1]
        far = np.abs(power) > 400
        apart[far] = np.ldexp(apart[far], -power[far, None])
        d = np.sqrt(np.square(apart).sum(axis=1))
        d[far] = np.ldexp(d[far], power[far])
    return d


def build(vectors: np.ndarray, seed: int = 0) -> Graph:
    """Insert the vectors one by one. The same vectors in the same order give the same graph."""
    n = len(vectors)
    random = np.random.default_rng(seed)
    levels = np.floor(-np.log(1.0 - random.random(n)) / np.log(LINKS)).astype(int)
    top = int(levels.max(initial=0))
    links = [np.full((n, LINKS * (2 if k == 0 else 1)), -1, np.int32) for k in range(top + 1)]
    graph = Graph(vectors, links, 0)
    seen = np.full(n, -1, np.int64)
    mark = 0
    highest = int(levels[0]) if n else 0
    for i in range(1, n):
        query, entry, level = vectors[i], graph.entry, int(levels[i])
        for k in range(highest, level, -1):
            entry = graph.descend(query, entry, k)
        starts = [entry]
        for k in range(min(level, highest), -1, -1):
            mark += 1
            found = graph.search(query, starts, k, BREADTH_BUILD, seen, mark)
            near = choose(graph, found, query, LINKS)
            rows = links[k]
            rows[i, : len(near)] = near
            for other in near:
                row = rows[other]
                free = np.flatnonzero(row < 0)
                if len(free):
                    row[free[0]] = i
                    continue
                all_ = np.append(row, i)
                d = graph.distances(vectors[other], all_)
                order = np.lexsort((all_, d))
                kept = choose(graph, [(float(d[o]), int(all_[o])) for o in order], vectors[other], len(row))
                rows[other] = -1
                rows[other, : len(kept)] = kept
            starts = [node for _, node in found]
        if level > highest:
            highest, graph.entry = level, i
    return graph


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, embedding, dim) of the vectors that take part, as doubles."""
    v = F.col(vector_column).cast("array<double>")
    limit = F.lit(float("inf"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), v.alias("embedding")).where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite
    )
    return rows.where(F.exists("embedding", lambda x: x != 0)).withColumn("dim", F.size("embedding"))


def build_index(points: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The index table: a row per shard and vector length, every vector in it. ``k``: the most neighbours asked for.

    Of equal vectors the k + 1 smallest ids are kept, as no search can return more of them: its own id is skipped, and
    ties go to smaller ids. Rows that repeat an id count once. They are chosen before the shuffle, so a vector that very many rows have stays small.
    """
    nth = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    once = points.select("embedding", "dim", "vec_id").distinct()
    few = once.withColumn("__n", nth).where(F.col("__n") <= k + 1)
    distinct = written(
        few.groupBy("embedding", "dim").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "ann-vectors"
    )
    shards = max(1, -(-distinct.count() // shard_rows))
    dealt = distinct.withColumn("shard", F.pmod(F.xxhash64("embedding"), F.lit(shards)).cast("int"))

    def make(frame: pd.DataFrame) -> pd.DataFrame:
        first = np.array([ids[0] for ids in frame["ids"]])
        frame = frame.iloc[np.argsort(first, kind="stable")]
        exact = np.stack(frame["embedding"].to_list()).astype("<f8")
        graph = build(scaled(exact)[0])
        ids = [np.asarray(i, "<i8") for i in frame["ids"]]
        starts = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype("<i8")
        row = {
            "shard": int(frame["shard"].iloc[0]),
            "dim": exact.shape[1],
            "n": len(exact),
            "entry": graph.entry,
            "vectors": exact.tobytes(),
            "ids": np.concatenate(ids).tobytes(),
            "starts": starts.tobytes(),
            "levels": np.array([x.shape[1] for x in graph.links], "<i4").tobytes(),
            "links": b"".join(x.astype("<i4").tobytes() for x in graph.links),
        }
        return pd.DataFrame([row])

    # A number of partitions of its own: one graph is a long task, and small shuffles are not packed together.
    spread = dealt.repartition(shards, "shard")
    return written(spread.groupBy("shard", "dim").applyInPandas(make, INDEX), "ann-index")


def search(index: DataFrame, queries: DataFrame, k: int, breadth: int = BREADTH_SEARCH) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of each query found in all shards, by exact distance.

    ``queries`` has vec_id, embedding and dim. A row of the index with vec_id equal to a query's is not its candidate.
    """
    packed = queries.withColumn("__block", F.expr(f"pmod(xxhash64(vec_id), greatest(1, __total div {QUERY_BLOCK}))"))
    blocks = packed.groupBy("__block", "dim").agg(
        F.collect_list(F.struct("vec_id", "embedding")).alias("queries")
    )
    # Every block of queries for every shard of its length; the broadcast side is two integers per shard.
    per_shard = blocks.join(F.broadcast(index.select("shard", "dim")), "dim")
    work = per_shard.join(index, ["shard", "dim"]).drop("__block")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                yield one(row)

    def one(row) -> pd.DataFrame:
        vectors = np.frombuffer(row.vectors, "<f8").reshape(row.n, row.dim)
        ids, starts = np.frombuffer(row.ids, "<i8"), np.frombuffer(row.starts, "<i8")
        links, at = [], 0
        flat = np.frombuffer(row.links, "<i4")
        for width in np.frombuffer(row.levels, "<i4").tolist():
            links.append(flat[at : at + width * row.n].reshape(row.n, width))
            at += width * row.n
        points, mean, exponents = scaled(vectors)
        graph = Graph(points, links, row.entry)
        seen = np.full(row.n, -1, np.int64)
        out: list[tuple[int, int, float]] = []
        for mark, q in enumerate(row.queries):
            own, original = q["vec_id"], np.asarray(q["embedding"], "f8")
            query = placed(original, mean, exponents)
            node = graph.entry
            for level in range(len(links) - 1, 0, -1):
                node = graph.descend(query, node, level)
            nodes = np.array([n for _, n in graph.search(query, [node], 0, max(breadth, 2 * k), seen, mark)])
            exact = euclidean(vectors[nodes], original)
            near = [(d, i) for d, n in zip(exact.tolist(), nodes) for i in ids[starts[n] : starts[n + 1]].tolist()]
            out += [(own, i, d) for d, i in heapq.nsmallest(k, ((d, i) for d, i in near if i != own))]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    found = work.mapInPandas(run, "query_id long, vec_id long, score double")
    best = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", best.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, id_column: str = "vec_id", column: str = "embedding"):
    """The k nearest rows of ``vectors`` for every row of ``queries``, itself left out."""
    points = usable(vectors, id_column, column)
    asked = usable(queries, id_column, column)
    total = asked.count()
    first = F.min(F.struct("dim", "embedding")).alias("__q")
    asked = asked.groupBy("vec_id").agg(first).select("vec_id", "__q.embedding", "__q.dim")
    return search(build_index(points, k), asked.withColumn("__total", F.lit(total)), k)
