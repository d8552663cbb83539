import numpy as np
import pytest

from claimloom.llm import hnsw

SCHEMA = "vec_id long, embedding array<float>, label int"


def exact(rows, queries, k):
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], "f4").astype("f8")
    out = {}
    for q, v in queries:
        d = np.sqrt(np.square(vectors - np.asarray(v, "f4").astype("f8")).sum(axis=1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(d[i])) for i in order]
    return out


def search(spark, rows, ask, k=10, **options):
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    found = {}
    for r in hnsw.nearest(frame, frame.where(ask), k).collect():
        found.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    return {q: [r[n] for n in sorted(r)] for q, r in found.items()}


def test_recall_over_shards(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=24).tolist()) for i in range(3000)]
    points = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    usable = hnsw.usable(points, "vec_id", "embedding")
    index = hnsw.build_index(usable, 10, shard_rows=700)
    assert index.count() == 5 and index.agg({"n": "sum"}).first()[0] == 3000
    asked = usable.where("vec_id % 100 = 0").selectExpr("*", "30 as __total")
    expected = exact(rows, [r for r in rows if r[0] % 100 == 0], 10)
    hits = 0
    for r in hnsw.search(index, asked, 10).collect():
        known = dict(expected[r.query_id])
        hits += r.vec_id in known
        assert r.vec_id not in known or r.score == pytest.approx(known[r.vec_id], rel=1e-12)
    assert hits >= 0.95 * 300


def test_one_graph_finds_the_nearest():
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(1500, 16))
    graph = hnsw.build(vectors)
    seen = np.full(1500, -1)
    hits = 0
    for mark, q in enumerate(range(0, 1500, 30)):
        node = graph.entry
        for level in range(len(graph.links) - 1, 0, -1):
            node = graph.descend(vectors[q], node, level)
        got = [n for _, n in graph.search(vectors[q], [node], 0, 64, seen, mark)][:10]
        hits += len(set(got) & set(np.square(vectors - vectors[q]).sum(axis=1).argsort()[:10].tolist()))
    assert hits >= 0.95 * 500


def test_equal_vectors_ties_and_few_candidates(spark):
    rows = [(i, [1.0, 2.0]) for i in range(40)] + [(100, [1.0, 3.0]), (101, [5.0, 5.0])]
    found = search(spark, rows, "vec_id in (0, 100)", 10)
    assert found == {q: [(i, pytest.approx(d)) for i, d in e] for q, e in
                     exact(rows, [(0, [1.0, 2.0]), (100, [1.0, 3.0])], 10).items()}
    assert len(search(spark, rows[-2:], "vec_id = 100", 10)[100]) == 1


def test_vectors_that_take_no_part(spark):
    bad = [(1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [None, 1.0]), (6, []),
           (None, [1.0, 1.0]), (7, [1.0]), (8, [1.0, 0.5]), (9, [2.0, 0.5])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in bad], SCHEMA)
    rows = hnsw.nearest(frame, frame, 10).collect()
    assert sorted((r.query_id, r.vec_id) for r in rows) == [(8, 9), (9, 8)]
    assert hnsw.nearest(frame.where("false"), frame.where("false")).count() == 0


def test_repeated_rows_do_not_crowd_out_other_ids(spark):
    rows = [(1, [1.0, 0.0])] * 30 + [(2, [1.0, 0.0]), (3, [1.0, 0.0])] + [(4, [0.0, 1.0]), (4, [1.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = hnsw.nearest(frame, frame, k=3).collect()
    assert [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == 1] == [2, 3, 4]
    assert min(r.score for r in found if r.query_id == 4) == 2**0.5


@pytest.mark.parametrize("scale, away", [(1e200, 0.0), (1e-200, 0.0), (1e300, 0.0), (1.0, 1e9), (1e-5, 1e3)])
def test_recall_of_any_size_and_off_the_origin(spark, scale, away):
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(1000, 8)) * scale + away
    vectors[500:] -= 2 * away  # two clouds on both sides of the origin
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {}
    for r in hnsw.nearest(frame, frame.where("vec_id % 100 = 0"), 10).collect():
        found.setdefault(r.query_id, {})[r.vec_id] = r.score
    hits = 0
    for q, got in found.items():
        exact = np.sqrt(np.square((vectors - vectors[q]) / scale).sum(axis=1)) * scale
        order = [i for i in exact.argsort(kind="stable") if i != q][:10]
        hits += len(set(order) & set(got))
        assert all(got[i] == pytest.approx(exact[i], rel=1e-9) for i in got)
    assert len(found) == 10 and hits >= 90


def test_recall_of_three_full_shards(spark):
    """Production parameters: 24,576 Gaussian vectors of 32 components, the hard case of no clusters at all."""
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(3 * hnsw.SHARD_ROWS, 32))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(8)
    found = hnsw.nearest(frame, frame.where("vec_id % 500 = 0"), 10).collect()
    hits = 0
    for q in range(0, len(vectors), 500):
        d = np.square(vectors - vectors[q]).sum(axis=1)
        d[q] = np.inf
        hits += len(set(d.argsort()[:10].tolist()) & {r.vec_id for r in found if r.query_id == q})
    assert hits >= 0.9 * 10 * len(range(0, len(vectors), 500))
