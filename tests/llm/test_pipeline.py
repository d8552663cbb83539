"""The pipeline stage by stage, each against a brute-force version over what the stage before it kept."""

import re

import numpy as np
import pytest
from test_dartminhash import classes
from test_line_dedup import brute as without_repeated_lines
from test_mixing import fair
from test_quality import measures

import corpus_pipeline
from claimloom.llm import quality
from claimloom.llm.registry import vocabulary
from claimloom.llm.shared import table, written

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def stages(spark):
    """The rows that go into each stage and come out of the last."""
    docs, seen = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        seen.append(docs.collect())
        docs = written(stage(spark, docs, SF), f"test-{name}")
    return [*seen, docs.collect()]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def line_is_bad(line):
    if not words(line):
        return False
    bars = sum(w in quality.SEPARATORS for w in words(line))
    return (
        line.rstrip(quality.CLOSERS)[-1:] not in quality.ENDINGS
        or (bars >= 2 and bars * 5 >= len(words(line)))
        or re.search(quality.NAVIGATION, line, re.ASCII) is not None
        or (re.search(quality.BOILERPLATE, line) is not None and len(words(line)) <= quality.BOILERPLATE_WORDS)
    )


def test_the_stages_and_their_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_duplicates", "source_mixing", "bpe_encoding",
    ]


def test_quality_rules(stages):
    expected = []
    for r in stages[0]:
        lines = (r.text or "").split("\n")
        bad = [x for x in lines if line_is_bad(x)]
        lost = sum(len(words(x)) for x in bad)
        if not measures(r.text)[-1] and lost <= quality.MAX_LOST_SHARE * len(words(r.text)):
            expected.append((r.doc_id, "\n".join(x for x in lines if not line_is_bad(x))))
    assert sorted((r.doc_id, r.text) for r in stages[1]) == sorted(expected)
    assert [list(r.asDict()) for r in stages[1][:1]] == [COLUMNS]
    assert all(r.n_chars == len(r.text) for r in stages[1])


def test_line_dedup(stages):
    expected = without_repeated_lines([(r.doc_id, r.text) for r in stages[1]], 0.8)
    assert sorted((r.doc_id, r.text) for r in stages[2]) == sorted(expected)


def test_near_duplicates(stages):
    expected = {c for _, c, _ in classes([(r.doc_id, r.text) for r in stages[2]])}
    assert sorted(r.doc_id for r in stages[3]) == sorted(expected)


def test_source_mixing(stages):
    size = {r.doc_id: len(words(r.text)) for r in stages[3]}
    source = {r.doc_id: r.source for r in stages[3]}
    per_source = {s: sum(n for d, n in size.items() if source[d] == s) for s in set(source.values())}
    taken = dict.fromkeys(per_source, 0)
    times = dict.fromkeys(size, 0)
    for r in stages[4]:
        taken[r.source] += size[r.doc_id]
        times[r.doc_id] += 1
    assert max(times.values()) <= 2
    for s, target in fair(per_source).items():
        # Documents are whole, so a source may be off by half of one, and by a few blocks of the schedule.
        assert abs(taken[s] - target) <= max((n for d, n in size.items() if source[d] == s), default=0) / 2 + 0.05 * target


def test_bpe_encoding(stages):
    library = tokenizers.Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in stages[4]}
    assert len(stages[5]) == len(stages[4])
    for r in stages[5]:
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(r.ids) and len(r.ids_sha256) == 64
    assert np.sum([r.n_tokens for r in stages[5]]) > 0


def test_run_gives_the_rows_of_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens", "ids_sha256").collect()
    assert sorted(map(tuple, got)) == sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in stages[5])
