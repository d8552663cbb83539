import numpy as np
import pytest
from pyspark.sql import functions as F

from claimloom.llm import hard_negatives
from claimloom.llm.hard_negatives import CoverTree

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(given, anchors=lambda i: i % 100 == 0, k=5):
    """The definition over rows (id, integers, label)."""
    out = []
    for a, v, label in given:
        if not anchors(a):
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), i, l) for i, w, l in given if i != a and len(w) == len(v)]
        scored.sort(key=lambda r: (-r[0], r[1]))
        for ps, positive, _ in [r for r in scored if r[2] == label][:k]:
            window = [r for r in scored if r[2] != label and 80 * ps <= 100 * r[0] <= 100 * ps]
            out += [(a, positive, n, i, ps, s) for n, (s, i, _) in enumerate(window[:k], 1)]
    return sorted(out)


def mined(spark, given, anchors="vec_id % 100 = 0", **options):
    frame = spark.createDataFrame([(i, [float(x) for x in v], l) for i, v, l in given], SCHEMA)
    points = hard_negatives.quantised(frame, "vec_id", "embedding", F.col("label"), scale=1)
    found = hard_negatives.mine(points, points.where(anchors), **options)
    return sorted(tuple(r) for r in found.collect())


def clustered(n, dim=12, seed=1, copies=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(7, dim)) * 60
    rows = [(i, (centres[i % 7] + rng.normal(size=dim) * 25).astype(int).tolist(), int(rng.integers(4))) for i in range(n)]
    return rows + [(n + i, rows[0][1], i % 2) for i in range(copies)]


@pytest.mark.parametrize("shard_rows", [10_000, 150])
def test_equals_brute_force(spark, shard_rows):
    given = clustered(900, copies=120)
    assert mined(spark, given, shard_rows=shard_rows) == brute(given)


def test_many_equal_rows_and_ties(spark):
    given = [(i, [3, 4], i % 3) for i in range(250)] + [(300, [3, 3], 0), (301, [3, 3], 1), (302, [0, 0], 1)]
    assert mined(spark, given) == brute(given)


def test_the_tree_covers_and_separates():
    given = clustered(1500)
    vectors = np.array([v for _, v, _ in given], "i8")
    tree = CoverTree.build(vectors, np.arange(1500), np.zeros(1500, "i8"))
    assert sorted(tree.ids.tolist()) == list(range(1500))
    assert np.array_equal(tree.vectors, vectors[tree.ids])

    def below(node):
        found = []
        while node >= 0:
            for slot in range(tree.node_low[node], tree.node_high[node]):
                found += [slot, *(below(tree.slot_node[slot]) if tree.slot_node[slot] >= 0 else [])]
            node = tree.node_next[node]
        return found

    for node, slot in enumerate(tree.node_slot):
        rows = below(node)
        away = hard_negatives.distances(tree.points[rows], tree.points[slot])
        assert away.max() == pytest.approx(tree.node_radius[node])
        children = [s for s in range(tree.node_low[node], tree.node_high[node])]
        if len(rows) > hard_negatives.LEAF and tree.node_radius[node]:
            level = hard_negatives.BASE ** (np.ceil(np.log(tree.node_radius[node]) / np.log(hard_negatives.BASE)) - 1)
            for i, s in enumerate(children):
                apart = hard_negatives.distances(tree.points[[slot, *children[:i]]], tree.points[s])
                assert apart.min() >= level * (1 - 1e-9)


def test_the_search_skips_nodes_outside_the_windows():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 8)) * 1000
    vectors = (centres[rng.integers(40, size=4000)] + rng.normal(size=(4000, 8)) * 10).astype("i8")
    tree = CoverTree.build(vectors, np.arange(4000), np.zeros(4000, "i8"))
    scored, plain = 0, tree.scores

    def counting(query, slots):
        nonlocal scored
        scored += len(slots)
        return plain(query, slots)

    tree.scores = counting
    query = vectors[5]
    found = tree.search(query, -1, 0, True, [(-(2**62), 2**62)], 5)[0]
    exact = vectors @ query
    assert [s for s, _ in found] == sorted(exact.tolist(), reverse=True)[:5]
    assert scored < 1500
    low, high = int(np.quantile(exact, 0.5)), int(np.quantile(exact, 0.52))
    found = tree.search(query, -1, 0, True, [(low, high)], 3)[0]
    assert [s for s, _ in found] == sorted(exact[(exact >= low) & (exact <= high)].tolist(), reverse=True)[:3]


def test_large_components_are_exact(spark):
    big = 2**27
    given = [(i, [big + i, big - 3 * i, -i], i % 2) for i in range(0, 120)]
    assert mined(spark, given, "vec_id in (0, 100)") == brute(given, lambda i: i in (0, 100))


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    given = [
        (0, [1.0, 1.0], 1), (1, [1.0, 0.9], 1), (2, [0.9, 0.9], 2), (3, None, 1), (4, [nan, 1.0], 2), (5, [inf, 1.0], 2),
        (6, [None, 1.0], 2), (None, [1.0, 0.9], 2), (8, [1.0, 0.9], None), (9, [1.0], 2), (10, [1e200, 1.0], 2), (11, [], 2),
        (2, [0.9, 0.9], 2), (1, [1.0, 0.9], 1),
    ]
    frame = spark.createDataFrame(given, SCHEMA).withColumn("windows", F.lit(1)).withColumn("shard", F.lit("x"))
    points = hard_negatives.quantised(frame, "vec_id", "embedding", F.col("label"))
    found = hard_negatives.mine(points, points.where("vec_id % 100 = 0")).collect()
    assert [tuple(r) for r in found] == [(0, 1, 1, 2, 256 * 256 + 256 * 230, 2 * 256 * 230)]
    assert hard_negatives.mine(points.where("false"), points.where("false")).count() == 0


def test_quantising_rounds_down(spark):
    frame = spark.createDataFrame([(0, [0.999 / 256, -0.001, -1.0, 0.5], 1)], SCHEMA)
    assert hard_negatives.quantised(frame, "vec_id", "embedding", F.col("label")).first().vector == [0, -1, -256, 128]
