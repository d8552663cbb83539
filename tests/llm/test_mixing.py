import pytest

from claimloom.llm import mixing
from corpora import docs, no_docs, prose  # noqa: F401


def fair(sizes, weights=(5, 2, 1), share=1.5):
    """Targets by repeated resharing."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, target, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        level = (total - sum(target.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        for s in over or open_:
            target[s] = 2.0 * sizes[s] if over else level * weight[s]
        open_ -= over or open_
    return target


@pytest.fixture
def sources(spark):
    rows = [(i, prose(i, 40 + i % 60), f"s{i % 7}" if i % 11 else None) for i in range(400)]
    rows += [(i, prose(i, 50), "s0") for i in range(1000, 1200)] + [(2000, None, "s1"), (2001, "", "sz")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_targets_are_the_fair_shares(sources):
    sized = mixing.sizes(sources)
    found = {r.source: (r.source_size, r.target) for r in mixing.targets(sized).collect()}
    assert {s: t for s, (_, t) in found.items()} == pytest.approx(fair({s: n for s, (n, _) in found.items()}))


def test_taken_words_come_near_the_targets(sources):
    rows = mixing.mix(sources).collect()
    assert len(rows) == 602
    target = {r.source: r.target for r in rows}
    taken = {s: sum(r.taken for r in rows if r.source == s) for s in target}
    for s, t in target.items():
        assert abs(taken[s] - t) <= 0.02 * t + 16
    assert all(0 <= r.taken <= 2 * r["size"] for r in rows)


def test_reruns_and_other_partitionings_agree(sources):
    def rows(df):
        return sorted((r.doc_id, r.taken, r.first_slot or -1) for r in mixing.mix(df).collect())

    assert rows(sources) == rows(sources.repartition(7))


def test_repeated_rows_nulls_and_nothing(docs, no_docs, spark):
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    assert all(r.taken == 0 for r in rows if r["size"] == 0)
    out = mixing.mixed_documents(docs)
    assert out.schema.names == docs.schema.names
    assert out.count() > 0
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0
    empty = spark.createDataFrame([(1, None, "a")], "doc_id long, text string, source string")
    assert [(r["size"], r.target, r.taken) for r in mixing.mix(empty).collect()] == [(0, 0.0, 0)]


def test_documents_come_as_often_as_they_are_read(sources):
    times = {}
    for r in mixing.mixed_documents(sources).select("doc_id").collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    for r in mixing.mix(sources).collect():
        expected = (2 * r.taken + r["size"]) // (2 * r["size"]) if r["size"] else 0
        assert times.get(r.doc_id, 0) == expected


def test_a_tiny_source_beside_millions_of_words_reaches_its_target(spark):
    big = [(f"b{i}-{j}", " ".join(["w"] * 20_000), f"s{i:02}") for i in range(20) for j in range(10)]
    tiny = [(f"t{i}-{j}", "a b c d e f g h i j k l m n o", f"t{i:02}") for i in range(10) for j in range(20)]
    frame = spark.createDataFrame(big + tiny, "doc_id string, text string, source string")
    rows = mixing.mix(frame).collect()
    target = {r.source: r.target for r in rows}
    assert min(target.values()) <= 600 and sum(target.values()) >= 6e6 - 1
    for s, t in target.items():
        assert sum(r.taken for r in rows if r.source == s) == round(t)
    assert {r.source for r in mixing.mixed_documents(frame).collect()} == set(target)
