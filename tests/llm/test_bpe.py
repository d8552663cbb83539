import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from corpora import corpus, docs, no_docs  # noqa: F401

from claimloom.llm import bpe
from claimloom.llm.registry import vocabulary

tokenizers = pytest.importorskip("tokenizers")
FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]


@pytest.fixture(scope="module", params=FILES)
def both(request):
    path = vocabulary(request.param)
    return bpe.encoder(path), tokenizers.Tokenizer.from_file(path)


def same(both, text):
    ours, library = both
    packed = ours.encode(text)
    ids = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packed, "<u4").tolist() == ids
    assert "".join(bpe.decode_packed(ours.v, packed)) == library.decode(ids, skip_special_tokens=False)


def test_texts_of_the_corpus(both):
    for row in corpus():
        same(both, row[1] or "")


LIBRARY = {name: tokenizers.Tokenizer.from_file(vocabulary(name)) for name in FILES}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8", exclude_categories=["Cs", "Cn"]), max_size=60))
def test_any_text(text):
    for name in FILES:
        same((bpe.encoder(vocabulary(name)), LIBRARY[name]), text)


def test_long_words_are_emitted_early_and_right(both, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 16)
    monkeypatch.setattr(bpe, "SHORT", 0)
    rng = random.Random(2)
    own = bpe.Encoder(both[0].v)
    for _ in range(10):
        same((own, both[1]), "".join(rng.choice(["the", "ing", "a", "ab", "é"]) for _ in range(1500)))


def test_transducer_holds_a_bounded_number_of_symbols(both, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 32)
    v = both[0].v
    t, most, n = bpe.WordTransducer(v), 0, 0
    for _ in range(3000):
        n += len(list(t.feed([v.symbol[ord(c)] for c in "thea"])))
        most = max(most, len(t.held))
    assert n > 0 and most <= v.lookahead + 32


def test_lookahead_of_a_chain_of_rules():
    # "bc" takes the b that "ab" would have taken, which leaves the a for "za".
    assert bpe.lookahead([("b", "c"), ("a", "b"), ("z", "a")]) == 3
    assert bpe.lookahead([("a", "b")]) == 1
    with pytest.raises(ValueError):
        bpe.lookahead([("ab", "c"), ("a", "b")])


def test_lookahead_suffices_on_random_rules():
    rng = random.Random(4)
    for _ in range(60):
        tokens, merges = list("abc"), []
        while len(merges) < 8:
            pair = (rng.choice(tokens), rng.choice(tokens))
            if "".join(pair) not in tokens:
                merges.append(pair)
                tokens.append("".join(pair))
        far = bpe.lookahead(merges)

        def cuts(word):
            word = list(word)
            for pair in [m for m in merges]:
                i = 0
                while i < len(word) - 1:
                    if (word[i], word[i + 1]) == pair:
                        word[i : i + 2] = ["".join(pair)]
                    i += 1
            out, at = [], 0
            for t in word:
                at += len(t)
                out.append(at)
            return out

        for _ in range(40):
            start = "".join(rng.choice("abc") for _ in range(12))
            ends = ["".join(rng.choice("abc") for _ in range(rng.randint(0, 8))) for _ in range(2)]
            stable = [[c for c in cuts(start + e) if c <= len(start) - far] for e in ends]
            assert stable[0] == stable[1]


def test_digests(docs, no_docs):
    path = vocabulary(FILES[0])
    library = tokenizers.Tokenizer.from_file(path)
    rows = bpe.encode(docs, path, keep=("doc_id", "text")).collect()
    assert len(rows) == docs.count()
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.digests(no_docs, path).count() == 0
