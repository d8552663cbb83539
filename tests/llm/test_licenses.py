import re

import pytest

from corpora import docs, no_docs  # noqa: F401

from claimloom.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, templates, threshold):
    given, starts, labels = words(text), [], set()
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split()
        for i in range(len(given) - len(parts) + 1):
            if given[i : i + len(parts)] == parts:
                starts.append(i)
                labels.add(label)
    block = licenses.BLOCK_TEMPLATES * max(len(words(t)) for t in templates.values())
    step, best = block // 2, {}
    for at in range(0, max(1, len(given)), step):
        own = set(given[at : at + block])
        for name, t in templates.items():
            share = len(set(words(t)) & own) / len(set(words(t)))
            if share >= threshold - 1e-9:
                best[name] = max(best.get(name, 0), share)
    return (
        len(given), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)),
        ",".join(sorted(labels | set(best))), pytest.approx(max(best.values(), default=1.0 if starts else 0.0)),
    )


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_equals_brute_force(spark, docs, threshold):
    grant = licenses.TEMPLATES["mit-grant"]
    more = [
        (100, "filler words " * 100 + grant + " and more " * 50),
        (101, " ".join(grant.split()[::2])),
        (102, "MIT license, MIT-License; Apache License mit license mit"),
        (103, "the gnu General Public License the general public"),
        (104, "ÉMIT LICENSE mit license"),
    ]
    texts = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    rows = licenses.scan(texts, threshold=threshold, keep=("doc_id", "text")).collect()
    assert len(rows) == texts.count()
    for r in rows:
        found = (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score)
        assert found == brute(r.text, licenses.TEMPLATES, threshold)


def test_frequencies_cover_the_corpus(docs):
    known = licenses.Templates(licenses.TEMPLATES, 0.8)
    counts = licenses.frequencies(docs, known)
    every = [w for r in docs.collect() for w in words(r.text)]
    assert counts == {w: every.count(w.decode()) for w in known.known if w.decode() in every}


def test_no_documents(no_docs):
    assert licenses.scan(no_docs).count() == 0
