import random
import zlib

import pytest

from corpora import docs, no_docs  # noqa: F401

from claimloom.llm import language
from claimloom.llm.registry import op8_language_id
from claimloom.llm.shared import table


def longest_matches(text: str, sample: str, known: set[str]) -> int:
    """Phrases of a text against a sample, by trying every substring."""
    phrases = i = 0
    while i < len(text):
        n = 0
        while i + n < len(text) and text[i : i + n + 1] in sample:
            n += 1
        phrases += 1
        i += max(n, 1)
    return phrases


def test_phrases_equal_brute_force():
    samples = {"a": "abracadabra simsalabim", "b": "lorem ipsum dolor sit amet"}
    found = language.Languages(samples)
    texts = ["abra dabra", "dolor ipsum sit", "a", "salabimlorem" * 3]
    got = found.phrases([found.symbols(t) for t in texts])
    for row, t in zip(got, texts):
        assert row.tolist() == [longest_matches(t, samples[n], set()) for n in found.names]


def test_every_character_of_the_samples_counts():
    rng = random.Random(1)
    scripts = {"en": range(97, 123), "ja": range(0x4E00, 0x4E00 + 1500), "ru": range(0x430, 0x450), "zh": range(0x4E00, 0x4E00 + 1500)}
    words = {}
    for lang, letters in scripts.items():
        words[lang] = ["".join(chr(rng.choice(letters)) for _ in range(2 + i % 3)) for i in range(900)]
    say = lambda lang, n: " ".join(rng.choice(words[lang]) for _ in range(n))
    samples = {lang: say(lang, 2000) for lang in scripts}
    found = language.Languages(samples)
    texts = [(lang, say(lang, 12)) for lang in scripts for _ in range(10)]
    got = found.phrases([found.symbols(t) for _, t in texts])
    for row, (lang, text) in zip(got, texts):
        assert row.tolist() == [longest_matches(text, samples[n], set()) for n in found.names]
        assert found.names[row.argmin()] == lang


def test_long_texts_are_cut_into_stretches():
    found = language.Languages({"a": "ab" * 50, "b": "xy" * 50})
    text = "ab" * 5000
    whole = found.phrases([found.symbols(text)])[0]
    assert whole[0] < whole[1] and whole[0] >= len(text) / language.STRETCH


def test_held_out_accuracy(spark):
    rows = op8_language_id(spark, "/root/testdata/sf0.01").collect()
    truth = {r.doc_id: r.lang for r in table(spark, "/root/testdata/sf0.01", "documents").collect()}
    asked = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2 or r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    judged = asked or rows
    assert sum(r.lang_pred == truth[r.doc_id] for r in judged) >= 0.97 * len(judged)
    assert all(0 <= r.score <= 1 for r in rows)


def test_nothing_to_say(spark, docs, no_docs):
    rows = language.predict(docs, {}).collect()
    assert len(rows) == docs.count() and {r.lang_pred for r in rows} == {"und"}
    learned = language.samples(docs)
    assert set(learned) <= {"la", "lb"}
    found = {r.doc_id: r.lang_pred for r in language.predict(docs, learned).collect()}
    assert found[8] == found[9] == found[10] == found[13] == "und"
    assert language.samples(no_docs) == {} and language.predict(no_docs, learned).count() == 0


@pytest.mark.parametrize("given, expected", [(None, False), (0, zlib.crc32(b"0") % 4 == 2)])
def test_held_out_of_missing_ids(spark, given, expected):
    frame = spark.createDataFrame([(given,)], "doc_id long")
    assert frame.select(language.held_out()).first()[0] == expected


def test_repeated_rows_count_once_in_the_sample(spark):
    frame = spark.range(40).selectExpr("id as doc_id", "concat('text number ', id) as text", "'la' as lang")
    repeated = frame.unionByName(frame.crossJoin(spark.range(200)).select(frame.columns))
    repeated = repeated.unionByName(frame.selectExpr("doc_id", "'zz' as text", "lang"))
    assert language.samples(repeated) == language.samples(frame) != {}
