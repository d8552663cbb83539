import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpora import docs, no_docs  # noqa: F401

from claimloom.llm import token_files
from claimloom.llm.registry import vocabulary
from claimloom.llm.shared import new_folder, written

tokenizers = pytest.importorskip("tokenizers")


@pytest.mark.parametrize("n", [1, 2, 5, 100, 5000])
def test_perfect_hash_fills_every_slot_once(n):
    keys = np.unique(np.random.default_rng(n).integers(-(2**62), 2**62, n))
    shift = token_files.perfect_hash(keys)
    slots = token_files.slots_of(keys, shift, len(keys))
    assert sorted(slots.tolist()) == list(range(len(keys)))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8", exclude_categories=["Cs", "Cn"]), max_size=60))
def test_cached_words_are_encoded_as_whole_texts_are(text):
    ours = token_files.library_encoder(vocabulary("byte_bpe_50k.json"), "<u2")
    for t in (text, f"a  {text}<|endoftext|>{text} ", f"it's {text}\n\n {text}"):
        assert np.frombuffer(ours.encode(t), "<u2").tolist() == ours.library.encode(t, add_special_tokens=False).ids


def test_files_read_back(spark, docs, no_docs):
    path = vocabulary("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    folder = new_folder(spark, "test-files")
    shards = written(token_files.write(docs.repartition(3), folder, path, 50257, 0), "test-shards")
    found = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files.read(shards, folder).collect())
    assert len(found) == docs.count()
    # In order of ids, nulls first; each starts where the one before ends.
    assert [d for _, d, _, _ in found if d is not None] == sorted(d for _, d, _, _ in found if d is not None)
    at, left = 0, [(r.doc_id, r.text or "") for r in docs.collect()]
    for start, doc, n, crc in found:
        assert start == at
        at += n
        fits = [x for x in left if x[0] == doc and crc == zlib.crc32(
            np.array(library.encode(x[1], add_special_tokens=False).ids + [0], "<u4").tobytes())]
        assert fits
        left.remove(fits[0])
    assert not left
    none = written(token_files.write(no_docs, new_folder(spark, "test-files"), path, 50257, 0), "test-shards")
    assert none.count() == 0 and token_files.read(none, folder).count() == 0


def test_keyed_access_and_unknown_keys(spark):
    path = vocabulary("byte_bpe_50k.json")
    folder = new_folder(spark, "test-files")
    frame = spark.createDataFrame([(i * 7, f"text {i}") for i in range(300)], "doc_id long, text string").coalesce(1)
    shards = written(token_files.write(frame, folder, path, 50257, 0), "test-shards").collect()
    for r in shards:
        index = token_files.Index(folder, r.shard)
        first, count = index.locate(np.arange(2200))
        known = np.isin(np.arange(2200), index.keys)
        assert (count == known).all()
        assert (np.flatnonzero(known) == index.keys[first[known]]).all()


def test_wide_ids_use_four_bytes(spark):
    folder = new_folder(spark, "test-files")
    frame = spark.createDataFrame([(1, "x y")], "doc_id long, text string")
    shards = written(token_files.write(frame, folder, vocabulary("byte_bpe_50k.json"), 100_000, 0), "t").collect()
    index = token_files.Index(folder, shards[0].shard)
    assert index.id_bytes == 4 and index.ids(0).tolist()[-1] == 0
