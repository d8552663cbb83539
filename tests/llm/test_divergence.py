import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F

from claimloom.llm import divergence

from corpora import SCHEMA, docs, no_docs, prose  # noqa: F401

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def fold(term):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in term)


def brute(given):
    """The definition, term by term and pair by pair, in Python's integers."""
    found, kept_in = defaultdict(Counter), defaultdict(Counter)
    groups = defaultdict(set)
    for _, text, lang, source, _ in given:
        words = [fold(t) for t in TERM.findall(text or "")]
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        found[lang, source].update(words)
        kept_in[lang].update(set(words))
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in kept_in[lang].items() if n >= 3)
        count = {s: {t: found[lang, s][t] for t in kept} for s in sources}
        count[None] = {t: sum(count[s][t] for s in sources) for t in kept}
        p = {
            s: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept} for s, c in count.items()
        }
        for s in sources:
            def value(t, q):
                return (p[s][t] - q) ** 2 // q

            pairs = [(sum(value(t, p[o][t]) for t in kept), o) for o in sources if o != s]
            tells = [(value(t, p[None][t]), t) for t in kept if count[s][t] and p[s][t] > p[None][t]]
            for part, items, most in (("pair", pairs, None), ("term", tells, 200)):
                items.sort(key=lambda r: (-r[0], r[1].encode()))
                out += [(lang, s, part, item, v, n) for n, (v, item) in enumerate(items[:most], 1)]
    return sorted(out, key=repr)


def audited(spark, given):
    return rows(divergence.audit(spark.createDataFrame(given, SCHEMA)), "lang", "source", "part", "item", "value", "rank")


def many():
    """A hot source, a small one, one without kept terms, one without text; terms beyond ASCII; a repeated row."""
    made = []
    for i in range(60):
        source = "hot" if i % 3 else f"s{i % 5}"
        text = prose(i % 7, 80) + " ÉtÉ été İstanbul x1y don't " + "common " * (i % 4) + ("own " * i if i % 3 else "")
        made.append((i, text, "la" if i % 2 else "lb", source, 0))
    made += [(90, "never seen elsewhere", "la", "lone", 0), (91, None, "la", "silent", 0), (92, "", None, None, 0)]
    made += [(93, "thrice thrice", "lc", "only", 0)] * 3 + [(94, "a", "ld", "x", 0), (95, "b", "ld", "y", 0)]
    return made


def test_equals_brute_force(spark):
    assert audited(spark, many()) == brute(many())


def test_blocks_of_the_index_and_chunks_change_nothing(spark, monkeypatch):
    expected = brute(many())
    monkeypatch.setattr(divergence, "BLOCK_POSTINGS", 40)
    assert audited(spark, many()) == expected


def test_counts_are_handed_on_in_parts(monkeypatch):
    monkeypatch.setattr(divergence, "HELD_TERMS", 3)
    batch = pa.RecordBatch.from_pydict({"text": ["A b c d", "a b", "É é a"], "lang": ["l"] * 3, "source": ["s"] * 3})
    parts = [r for b in divergence.count_terms(iter([batch])) for r in b.to_pylist()]
    total, in_docs = Counter(), Counter()
    for r in parts:
        total[r["term"]] += r["n"]
        in_docs[r["term"]] += r["docs"]
    assert total == Counter({"a": 3, "b": 2, "c": 1, "d": 1, "É": 1, "é": 1})
    assert in_docs["a"] == 3 and len(parts) > len(total)


def test_share_is_exact_beyond_bigint(spark):
    count, total = 7 * 10**12, 9 * 10**13 + 1
    got = spark.range(1).select(divergence.share(F.lit(count), F.lit(total))).first()[0]
    assert got == 1 + 10**9 * (count + 1) // total
    assert spark.range(1).select(divergence.share(F.lit(0), F.lit(0))).first()[0] == 1


def test_odd_documents(spark, docs):  # noqa: F811
    from corpora import corpus

    assert audited(spark, corpus()) == brute(corpus())


def test_empty_table_and_clashing_names(spark, no_docs, docs):  # noqa: F811
    assert divergence.audit(no_docs).count() == 0
    names = ["term", "p", "gid", "zero", "value", "item", "rank", "block", "n"]
    more = docs.select("*", *(F.lit("x").alias(c) for c in names))
    assert divergence.audit(more).exceptAll(divergence.audit(docs)).count() == 0


@pytest.mark.parametrize("text, expected", [(b"", []), (b"Don't 1x\x00Y", [b"don", b"t", b"x", b"y"]),
                                            ("ÀB c".encode(), ["Àb c".encode()])])
def test_terms(text, expected):
    assert divergence.terms(text) == expected
