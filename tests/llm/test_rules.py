import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimloom.llm import rules

from corpora import SCHEMA, docs, no_docs, prose  # noqa: F401

LABELS = "doc_id long, quality int, toxic int"


def labelled(n=240):
    """Plain prose, and as bad texts shouted, repeated or symbol-ridden ones."""
    rng = random.Random(4)
    made = []
    for i in range(n):
        text, bad = prose(i, rng.randint(20, 120)), i % 4 == 0
        if bad:
            text = [text.upper().replace(" ", "!! "), "\n".join([text.split("\n")[0]] * 9), text.replace(" ", " *** ")][i // 4 % 3]
        made.append((i, text, int(not bad)))
    return made


def frames(spark, given):
    told = spark.createDataFrame([(i, t, None, None, None) for i, t, _ in given], SCHEMA)
    return told, spark.createDataFrame([(i, q, 0) for i, _, q in given], LABELS)


def test_held_out_accuracy(spark):
    given = labelled()
    told, labels = frames(spark, given)
    model = rules.train(told.where("doc_id % 5 <> 0"), labels, "quality")
    assert 0 < len(model.rules) < 60
    found = rules.scored(told.where("doc_id % 5 = 0"), model).join(labels, "doc_id")
    rows = found.select("score", "predicted", "quality").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_the_compiled_columns_score_as_the_model(spark):
    told, labels = frames(spark, labelled(120))
    model = rules.train(told, labels, "quality")
    stats, names = rules.with_statistics(told)
    rows = stats.select(*names, model.score().alias("score")).collect()
    x = np.array([[r[c] for c in names] for r in rows])
    assert model.scores(x) == pytest.approx([r["score"] for r in rows], rel=1e-12)


def test_rules_are_paths_of_the_trees():
    rng = np.random.default_rng(2)
    x = rng.random((400, 3))
    y = ((x[:, 0] > 0.5) & (x[:, 1] > 0.3)).astype(float)
    grown = rules.grow(x, y, np.ones(400))
    paths = {r.bounds for r in grown}
    assert all(len(p) <= rules.DEPTH for p in paths)
    assert all(p[:-1] in paths or len(p) == 1 for p in paths)
    model = rules.fit(["a", "b", "c"], x, y, np.ones(400) / 400)
    assert ((model.scores(x) > 0.5) == (y == 1)).mean() > 0.98


def test_the_penalty_makes_weights_zero():
    rng = np.random.default_rng(3)
    holds = (rng.random((300, 30)) > 0.5).astype(float)
    y = (holds[:, 4] + 0.2 * rng.random(300) > 0.6).astype(float)
    w, _ = rules.lasso(holds, y, np.ones(300), 0.05)
    assert np.flatnonzero(w).tolist() == [4]
    w, _ = rules.lasso(holds, y, np.ones(300), 10.0)
    assert not w.any()


def test_statistics_of_a_known_text(spark):
    text = "Aa bb\x0bbb\n\nAa bb\x0bbb\n#1 é!"
    frame, names = rules.with_statistics(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    s = {c[4:]: v for c, v in frame.select(*names).first().asDict().items()}
    assert s["words"] == pytest.approx(np.log1p(8))
    assert s["word_length"] == 16 / 8 and s["short_words"] == 1 and s["distinct_words"] == 4 / 8
    assert s["repeated_lines"] == pytest.approx(1 / 3) and s["ended_lines"] == 1 / 3
    assert s["symbols"] == 1 / len(text) and s["digits"] == 1 / len(text) and s["calls"] == 1 / 8
    assert s["capitals"] == 2 / 13 and s["letters"] == 13 / len(text)


def test_odd_documents(spark, docs):  # noqa: F811
    told, labels = frames(spark, labelled(80))
    model = rules.train(told, labels, "quality")
    clash = docs.withColumn("score", F.lit("x")).withColumn("__t2", F.lit(1)).withColumn("words", F.lit(2))
    found = rules.scored(clash, model)
    assert found.count() == docs.count() and found.where("score is null or isnan(score)").count() == 0
    assert set(found.columns) == {*clash.columns, "predicted"}
    assert found.where("doc_id = 8").first().score == found.where("doc_id = 9").first().score


def test_labels_that_teach_little(spark, no_docs):  # noqa: F811
    told, labels = frames(spark, labelled(20))
    one_kind = rules.train(told, labels.where("quality = 1"), "quality")
    assert rules.scored(told, one_kind).select("predicted").distinct().collect()[0][0] == 1
    none = rules.train(told, labels.where("false"), "quality")
    assert rules.scored(told, none).first().score == pytest.approx(0.5)
    assert rules.scored(no_docs, none).count() == 0
    odd = labels.withColumn("quality", F.when(F.col("doc_id") < 5, None).when(F.col("doc_id") < 9, 7).otherwise(F.col("quality")))
    repeated = odd.union(odd).union(odd.select("doc_id", (1 - F.col("quality")).alias("quality"), "toxic"))
    assert rules.train(told.union(told), repeated, "quality").rules is not None


def test_the_sample_is_bounded_and_repeats(spark):
    told, labels = frames(spark, labelled(200))
    a = rules.train(told, labels, "quality", per_label=20)
    b = rules.train(told.union(told).repartition(7), labels, "quality", per_label=20)
    assert a == b
