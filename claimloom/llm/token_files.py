"""Token ids in binary shard files with constant-time access by document key.

A shard is two files. ``shard-N.bin`` holds the raw ids of its documents, one after the other, as little-endian 16-bit
integers where the vocabulary allows it, else 32-bit. ``shard-N.idx`` maps a document key to its ids: a minimal perfect
hash (hash and displace) gives a key's slot, the slot's fingerprint tells unknown keys apart, and the slot points at
the key's rows, whose offsets lead into the payload. Keys are in ascending order within and across shards.

Tasks write under a name of their own and rename when a shard is complete; its content depends on its documents only,
so a repeated task or a lost executor does no harm. Files are written through ``pyarrow.fs`` by the URI of the folder.

Defined results: a null text has no ids but the end id; repeated keys share a slot that points at all their rows; a null
key is kept beside the hash; an empty table makes no files; columns other than the named ones are not read.
"""

from __future__ import annotations

import io
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.bpe import CACHED_PIECE, SPACE, byte_alphabet, word_pattern

MAGIC = b"TOKIDX01"
HEADER = struct.Struct("<8sBQQQQ")
"""Magic, bytes per id, rows, rows without a key, keys, buckets."""
PER_BUCKET = 4
CACHE_PIECES = 1 << 20
"""Pieces whose ids a worker remembers, some 200 bytes each; the cache starts anew when it is full."""
SHARD = "shard int, n_rows long, n_ids long"


def filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in folder and not folder.startswith("file:"):
        return pafs.LocalFileSystem(), folder
    return pafs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit integers, well mixed; another seed gives another function."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


BUCKET, PRINT, FIRST_TRY = 1, 2, 3
"""Seeds of the hashes; displacement d of a bucket is seed FIRST_TRY + d."""


def perfect_hash(keys: np.ndarray) -> np.ndarray:
    """The displacement of each bucket such that the keys fill the slots 0 to n - 1 one to one.

    Larger buckets are placed first, by trying displacements until their keys fall into free slots. Buckets of one key
    take what is left: they hold -1 - slot.
    """
    n = len(keys)
    buckets = -(-n // PER_BUCKET)
    of = (mixed(keys, BUCKET) % np.uint64(max(1, buckets))).astype(np.int64)
    order = np.argsort(of, kind="stable")
    counts = np.bincount(of, minlength=buckets)
    starts = np.concatenate([[0], counts.cumsum()])
    taken = np.zeros(n, bool)
    shift = np.zeros(buckets, np.int64)
    for b in np.argsort(-counts, kind="stable").tolist():
        if counts[b] < 2:
            break
        own = keys[order[starts[b] : starts[b + 1]]]
        d = 0
        while True:
            slots = mixed(own, FIRST_TRY + d) % np.uint64(n)
            if not taken[slots].any() and len(set(slots.tolist())) == len(own):
                break
            d += 1
        taken[slots] = True
        shift[b] = d
    free = np.flatnonzero(~taken)
    shift[np.flatnonzero(counts == 1)] = -1 - free
    return shift


def slots_of(keys: np.ndarray, shift: np.ndarray, n: int) -> np.ndarray:
    """The slot of each key; some slot for a key that is not in the index."""
    moves = shift[(mixed(keys, BUCKET) % np.uint64(len(shift))).astype(np.int64)]
    slots = -1 - moves
    for d in np.unique(moves[moves >= 0]).tolist():
        at = moves == d
        slots[at] = (mixed(keys[at], FIRST_TRY + d) % np.uint64(n)).astype(np.int64)
    return slots


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, PRINT) >> np.uint64(32)).astype(np.uint32)


def index_bytes(keys: list[int | None], lengths: list[int], id_bytes: int) -> bytes:
    """The index file of rows in ascending key order, nulls first."""
    without = sum(k is None for k in keys)
    known = np.array(keys[without:], np.int64)
    distinct, first, rows = np.unique(known, return_index=True, return_counts=True)
    shift = perfect_hash(distinct)
    out = io.BytesIO()
    out.write(HEADER.pack(MAGIC, id_bytes, len(keys), without, len(distinct), len(shift)))
    out.write(np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype("<i8").tobytes())
    out.write(known.astype("<i8").tobytes())
    out.write(shift.astype("<i8").tobytes())
    if len(distinct):
        slots = slots_of(distinct, shift, len(distinct))
        for values, kind in ((fingerprints(distinct), "<u4"), (first + without, "<i8"), (rows, "<i8")):
            placed = np.empty(len(distinct), kind)
            placed[slots] = values
            out.write(placed.tobytes())
    return out.getvalue()


class Index:
    """An index file in memory, and the payload beside it."""

    def __init__(self, folder: str, shard: int) -> None:
        system, path = filesystem(folder)
        with system.open_input_file(f"{path}/{name(shard)}.idx") as f:
            data = f.read()
        magic, self.id_bytes, self.rows, self.without, self.n, buckets = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError(f"not an index: {folder}/{name(shard)}.idx")
        at = HEADER.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            values = np.frombuffer(data, kind, count, at)
            at += values.nbytes
            return values

        self.offsets = take("<i8", self.rows + 1)
        self.keys = take("<i8", self.rows - self.without)
        self.shift = take("<i8", buckets)
        self.prints, self.first, self.count = take("<u4", self.n), take("<i8", self.n), take("<i8", self.n)
        self.payload = system.open_input_file(f"{path}/{name(shard)}.bin")

    def locate(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first row of each key and how many rows it has; -1 and 0 for a key that is not there."""
        if not self.n:
            return np.full(len(keys), -1), np.zeros(len(keys), np.int64)
        slots = slots_of(keys, self.shift, self.n)
        there = self.prints[slots] == fingerprints(keys)
        return np.where(there, self.first[slots], -1), np.where(there, self.count[slots], 0)

    def ids(self, row: int) -> np.ndarray:
        start, end = int(self.offsets[row]), int(self.offsets[row + 1])
        raw = self.payload.read_at((end - start) * self.id_bytes, start * self.id_bytes)
        return np.frombuffer(raw, f"<u{self.id_bytes}").astype("<u4")


def name(shard: int) -> str:
    return f"shard-{shard:07d}"


class LibraryEncoder(dict):
    """Texts to packed ids by the tokenizers library, which is asked once for each piece it has not seen lately.

    For byte-level vocabularies without a prefix space. No token reaches across the start of a white-space run that
    follows another character, nor past the last letter of a word, so pieces cut there can be encoded apart, and the
    words of a piece are what the library's model is given. A text with a special token goes through the whole library.
    The mapping is a bounded cache of pieces.
    """

    def __init__(self, path: str, kind: str) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.library, self.code = Tokenizer.from_file(path), "H" if kind == "<u2" else "I"
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        # A word of common letters that no other letter follows; else up to the next white space; else that.
        self.cut = re.compile(
            rf"[{SPACE}]*[A-Za-zÀ-ÖØ-öø-ÿ]+(?![^\W\d_])|[{SPACE}]*[^{SPACE}]+|[{SPACE}]+"
        ).findall
        self.words = word_pattern().findall
        self.alphabet = str.maketrans({chr(b): c for b, c in enumerate(byte_alphabet())})

    def packed(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def __missing__(self, piece: str) -> bytes:
        mapped = (w.encode().decode("latin-1").translate(self.alphabet) for w in self.words(piece))
        found = self.packed([t.id for w in mapped for t in self.model.tokenize(w)])
        if len(piece) <= CACHED_PIECE:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[piece] = found
        return found

    def encode(self, text: str | None) -> bytes:
        text = text or ""
        if any(s in text for s in self.special):
            return self.packed(self.library.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self.__getitem__, self.cut(text)))


@lru_cache(2)
def library_encoder(path: str, kind: str) -> LibraryEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return LibraryEncoder(path, kind)


def write(docs: DataFrame, folder: str, vocabulary: str, vocabulary_size: int, end_id: int) -> DataFrame:
    """Write shards of the documents' ids in ascending doc_id order; returns one row per shard: SHARD's columns.

    One shuffle by ranges of the id; each range becomes a shard. Run it once: the result is written by the caller.
    """
    id_bytes = 2 if vocabulary_size <= 1 << 16 else 4
    kind = f"<u{id_bytes}"
    end = np.array([end_id], kind).tobytes()
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = filesystem(folder)
        system.create_dir(path, recursive=True)
        shard = TaskContext.get().partitionId()
        own = f"{path}/_{name(shard)}-{uuid.uuid4().hex}"
        encoder = library_encoder(vocabulary, kind)
        keys: list[int | None] = []
        lengths: list[int] = []
        with system.open_output_stream(f"{own}.bin") as out:
            for batch in batches:
                keys += batch.column("doc_id").to_pylist()
                for text in batch.column("text"):
                    ids = encoder.encode(text.as_py()) + end
                    lengths.append(len(ids) // id_bytes)
                    out.write(ids)
        if not keys:
            system.delete_file(f"{own}.bin")
            return
        with system.open_output_stream(f"{own}.idx") as out:
            out.write(index_bytes(keys, lengths, id_bytes))
        for part in ("bin", "idx"):
            system.move(f"{own}.{part}", f"{path}/{name(shard)}.{part}")
        columns = [pa.array([shard], pa.int32()), pa.array([len(keys)], pa.int64()), pa.array([sum(lengths)], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["shard", "n_rows", "n_ids"])

    return ordered.mapInArrow(run, SHARD)


def with_starts(shards: DataFrame) -> DataFrame:
    """Add ``start``, the ids in earlier shards; one row per shard."""
    earlier = Window.partitionBy(F.lit(1)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("start", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))


def read(shards: DataFrame, folder: str) -> DataFrame:
    """Read every document back through the index: doc_id, start, n_tokens, ids_crc32."""
    n = max(1, shards.count())

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard, start in zip(frame["shard"].tolist(), frame["start"].tolist()):
                index = Index(folder, shard)
                keys = np.unique(index.keys)
                first, count = index.locate(keys)
                rows = [(None, r) for r in range(index.without)]
                rows += [(k, f + i) for k, f, c in zip(keys.tolist(), first.tolist(), count.tolist()) for i in range(c)]
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array([k for k, _ in rows], "Int64"),
                        "start": [start + int(index.offsets[r]) for _, r in rows],
                        "n_tokens": [int(index.offsets[r + 1] - index.offsets[r]) for _, r in rows],
                        "ids_crc32": [zlib.crc32(index.ids(r).tobytes()) for _, r in rows],
                    }
                )

    spread = with_starts(shards).repartition(n)
    return spread.mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
