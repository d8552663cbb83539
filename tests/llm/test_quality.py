import re
from collections import Counter

from corpora import docs, no_docs  # noqa: F401

from claimloom.llm import quality


def measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed)


def test_measures_equal_brute_force(docs):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    found = quality.judge(docs).collect()
    assert len(found) == docs.count()
    for r in found:
        assert tuple(r[n] for n in names) == measures(r.text)


def test_lines_are_judged_first(spark):
    text = "home | news | mail\n" + "one two three four five six seven eight nine ten eleven.\n" + "All rights reserved."
    row = quality.judge(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.cleaned == "one two three four five six seven eight nine ten eleven."
    assert row.n_lost_words == 8 and row.kept


def test_a_document_that_loses_most_is_rejected(spark):
    text = "no end here in this line at all\n" * 1 + "another line that has no end\n" + "A short one."
    row = quality.judge(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert not row.base_failed and not row.kept


def test_columns_of_result_names_are_replaced_and_others_kept(spark):
    given = spark.createDataFrame([(1, "x", "mine", 7)], "doc_id long, text string, kept string, `odd name` long")
    out = quality.judge(given)
    assert out.columns.count("kept") == 1 and dict(out.dtypes)["kept"] == "boolean"
    assert out.first()["odd name"] == 7


def test_clean_keeps_the_columns_and_updates_lengths(docs, no_docs):
    out = quality.clean(docs)
    assert out.schema.names == docs.schema.names
    rows = {r.doc_id: r for r in out.collect()}
    assert "home" not in rows[16].text and rows[16].n_chars == len(rows[16].text)
    assert rows[1].text == docs.where("doc_id = 1").first().text
    assert 8 not in rows and 9 not in rows and 17 not in rows
    assert quality.clean(no_docs).count() == 0
