import numpy as np
import pytest
from pyspark.sql import functions as F

from claimloom.llm import dartminhash
from corpora import SCHEMA, docs, edited, no_docs, prose  # noqa: F401


def classes(rows, similarity=0.8):
    """Smallest id per class, comparing all pairs."""
    sets = []
    for _, text in rows:
        found = dartminhash.shingles(text)
        sets.append(set(found.tolist()) if len(found) else {("text", text or "")})
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared >= similarity * len(sets[i] | sets[j]) - 1e-9:
                parent[root(i)] = root(j)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        ids.setdefault(root(i), []).append(doc)
    known = {r: min((d for d in ds if d is not None), default=None) for r, ds in ids.items()}
    return sorted(((d, known[root(i)], len(ids[root(i)])) for i, (d, _) in enumerate(rows)), key=repr)


def test_shingles_are_the_runs_of_five_words():
    a, b = dartminhash.shingles("A b, c d e f"), dartminhash.shingles("zz a B c d e")
    assert len(a) == 2 and len(np.intersect1d(a, b)) == 1
    assert len(dartminhash.shingles("one")) == 1 and len(dartminhash.shingles(" .. ")) == 0
    assert dartminhash.shingles("ab c d e f").tolist() != dartminhash.shingles("a bc d e f").tolist()


@pytest.mark.parametrize("n", [4, 300])
@pytest.mark.parametrize("similarity", [0.3, 0.8])
def test_agreement_estimates_the_similarity(n, similarity):
    rng = np.random.default_rng(n)
    darts, off = dartminhash.Darts(480), []
    for _ in range(12):
        shared = round(2 * n * similarity / (1 + similarity))
        common = rng.integers(0, 2**63, shared, dtype=np.uint64)
        sets = [np.append(common, rng.integers(0, 2**63, n - shared, dtype=np.uint64)) for _ in range(2)]
        one, two = darts.sign(sets)
        off.append((one == two).mean() - shared / (2 * n - shared))
    assert abs(np.mean(off)) < 0.03


def test_agreement_estimates_the_weighted_similarity():
    rng, darts, off = np.random.default_rng(3), dartminhash.Darts(480), []
    for _ in range(20):
        elements = rng.integers(0, 2**63, 40, dtype=np.uint64)
        x, y = rng.gamma(1, 2, 40), rng.gamma(1, 2, 40)
        one, two = darts.sign([elements, elements], [x, y])
        off.append((one == two).mean() - np.minimum(x, y).sum() / np.maximum(x, y).sum())
    assert abs(np.mean(off)) < 0.03


def test_signatures_do_not_depend_on_the_batch():
    darts = dartminhash.Darts(96)
    sets = [dartminhash.shingles(prose(s, 30 * s + 1)) for s in range(6)]
    together = darts.sign(sets)
    assert all((darts.sign([s])[0] == row).all() for s, row in zip(sets, together))


def found(df):
    rows = dartminhash.near_duplicates(df).collect()
    return sorted(((r.doc_id, r.class_id, r.class_size) for r in rows), key=repr)


def test_classes_equal_brute_force(docs):
    assert found(docs) == classes([(r.doc_id, r.text) for r in docs.collect()])


def test_star_and_chain_groups_lose_no_link(spark):
    base = prose(50, 150)
    rows = [(i, edited(base, i, 1 + i % 9)) for i in range(60)]
    chain = prose(51, 120)
    for i in range(60, 75):
        chain = edited(chain, i, 2)
        rows.append((i, chain))
    rows += [(i, prose(i, 80)) for i in range(100, 110)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == classes(rows)


def test_one_document_of_each_class_stays(spark, docs, no_docs):
    out = dartminhash.deduplicated(docs)
    assert out.schema.names == docs.schema.names
    expected = {c for _, c, _ in classes([(r.doc_id, r.text) for r in docs.collect()])}
    assert sorted((r.doc_id for r in out.collect()), key=repr) == sorted(expected, key=repr)
    assert dartminhash.deduplicated(no_docs).count() == 0
    odd = spark.createDataFrame([(1, "a b c d e f", "x")], "doc_id long, text string, class_id string")
    assert dartminhash.deduplicated(odd).first() == (1, "a b c d e f", "x")


def test_rows_without_ids_alone(spark):
    frame = spark.createDataFrame([(None, "a b c d e", None, None, None)] * 2, SCHEMA)
    assert found(frame) == [(None, None, 2)] * 2
    assert dartminhash.near_duplicates(frame).select(F.count_if("keeps")).first()[0] == 2
    assert dartminhash.deduplicated(frame).count() == 1


def test_a_large_group_of_near_copies_is_compared_with_few_centres(spark, monkeypatch):
    """Copies that each differ in some shingles from the original: pairs of them are around the threshold."""
    base = prose(77, 400, 400)
    rows = [(i, edited(base, i, 2 + i % 9)) for i in range(300)] + [(900 + i, prose(500 + i, 60)) for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    asked = []
    plain = dartminhash.verified

    def counting(pairs, sets, similarity):
        asked.append(pairs.count())
        return plain(pairs, sets, similarity)

    monkeypatch.setattr(dartminhash, "verified", counting)
    found = dartminhash.near_duplicates(frame).collect()
    assert sorted((r.doc_id, r.class_id) for r in found) == sorted((d, c) for d, c, _ in classes(rows))
    assert sum(asked) < 300 * 300 / 8


def test_sketches_count_the_coordinates_that_differ(spark):
    rng = np.random.default_rng(12)
    one = rng.integers(0, 2**63, (20, 480), dtype=np.uint64)
    other = np.where(rng.random(one.shape) < 0.3, rng.integers(0, 2**63, one.shape, dtype=np.uint64), one)
    expected = ((one & np.uint64(15)) != (other & np.uint64(15))).sum(axis=1).tolist()
    rows = list(zip(range(20), dartminhash.sketches(one).tolist(), dartminhash.sketches(other).tolist()))
    frame = spark.createDataFrame(rows, "id int, x array<long>, y array<long>")
    got = frame.orderBy("id").select(dartminhash.differing("x", "y").alias("n")).collect()
    assert [r.n for r in got] == expected
