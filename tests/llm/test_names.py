"""Columns named as a stage's own ones come through every stage of documents as they were."""

import pytest
from corpora import docs, no_docs  # noqa: F401
from pyspark.sql import functions as F

from claimloom.llm import dartminhash, line_dedup, mixing, quality, shared

CLASHING = [
    "__id", "__print", "__g", "__gone", "__nth", "__n", "__k", "__m", "__words", "__at", "___x", "kept", "cleaned",
    "n_words", "N_Dropped", "n_lines", "row", "size", "print", "class", "node", "taken", "odd name",
]
STAGES = [quality.clean, line_dedup.cleaned, dartminhash.deduplicated, mixing.mixed_documents]


def named(stage):
    return f"{stage.__module__}.{stage.__name__}"


@pytest.mark.parametrize("stage", STAGES, ids=named)
def test_clashing_names(docs, stage):
    plain = docs.where("doc_id is not null")
    given = plain.withColumns({n: F.concat_ws("-", F.lit(n), F.col("doc_id").cast("string")) for n in CLASHING})
    out = stage(given)
    assert out.columns == given.columns
    rows = out.collect()
    for r in rows:
        assert [r[n] for n in CLASHING] == [f"{n}-{r.doc_id}" for n in CLASHING]
    expected = sorted(map(tuple, stage(plain).collect()), key=repr)
    assert sorted((tuple(r)[: len(plain.columns)] for r in rows), key=repr) == expected


@pytest.mark.parametrize("stage", STAGES, ids=named)
def test_without_a_length_column(docs, no_docs, stage):
    narrow = stage(docs.select("doc_id", "text", "source"))
    assert narrow.columns == ["doc_id", "text", "source"]
    assert narrow.count() == stage(docs).count()
    assert stage(no_docs.select("doc_id", "text", "source")).count() == 0


def test_prefixes_and_shuffle_files(spark):
    assert shared.spare_prefix(["a", "b__"]) == "__" and shared.spare_prefix(["__A", "____b"]) == "_____"
    before = spark.conf.get(shared.SHUFFLE_CLEANUP)
    assert shared.written(spark.range(9).groupBy(F.col("id") % 2).count(), "test").count() == 2
    assert spark.conf.get(shared.SHUFFLE_CLEANUP) == before
