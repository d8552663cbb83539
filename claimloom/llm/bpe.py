"""BPE encoding and decoding as a streaming transducer with bounded lookahead.

Encoding. The merge rules of a word are applied by rank. :func:`lookahead` computes from the merge list how far left of
the end of the input read so far a later symbol can still change a token. Symbols further left are stable: their tokens
are emitted and forgotten, so a word of any length is encoded in constant memory. Decoding feeds one token at a time to
an incremental byte-to-text state machine.

Texts are cut at white space, which no token of these vocabularies crosses; a bounded cache keeps the ids of pieces
seen before. Vocabularies are read from a ``tokenizers`` JSON file, whose path is a parameter; the library itself is
not used.

Defined results: a null text is encoded as an empty one, which has no tokens; repeated rows are encoded alike; an empty
table gives an empty result; columns other than the named ones are not read.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 4096
"""Symbols read beyond the lookahead before a long word's stable tokens are emitted."""
SHORT = 64
"""Words up to this many symbols are merged one place at a time, longer ones one rule at a time."""
NO_RULE = 1 << 60
CACHE_PIECES = 1 << 19
"""Pieces, and words, whose ids are remembered; a cache starts anew when it is full."""
CACHED_PIECE = 64
"""Only pieces up to this many characters are remembered."""

# White space as the vocabularies' patterns define it; unlike str.isspace it leaves out U+001C to U+001F.
SPACE = "\t-\r \x85\xa0  -     　"
# The patterns that cut words, as the vocabulary files and the byte-level scheme name them.
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def word_pattern(pattern: str = BYTE_LEVEL_WORDS) -> regex.Pattern:
    """A pattern that cuts words, with white space as SPACE has it."""
    pattern = pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]")
    return regex.compile(pattern)


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def lookahead(merges: list[tuple[str, str]]) -> int:
    """How many symbols before the end of the input read a token can still change, whatever follows.

    Let two inputs agree up to a point. While rules are applied in order of rank, the place up to which both have the
    same symbols moves left only when a rule takes the last agreed symbol in one of them: past that rule's left part.
    The next rule to move it has a higher rank, and its right part starts with the symbol passed, as it was or grown
    to the right. So the distance is at most that of the longest such chain of rules, found here from the last rank
    to the first. A rule's parts must be made by earlier rules, which is checked.
    """
    made_by = {left + right: rank for rank, (left, right) in enumerate(merges)}
    if len(made_by) != len(merges):
        raise ValueError("a token is made by two rules")
    parts = {left + right: left for left, right in merges}
    symbols = {p for pair in merges for p in pair if p not in made_by}
    length = {s: 1 for s in symbols}
    for rank, (left, right) in enumerate(merges):
        if made_by.get(left, -1) >= rank or made_by.get(right, -1) >= rank:
            raise ValueError("a rule uses a token that a later rule makes")
        length[left + right] = length[left] + length[right]
    farthest: dict[str, int] = {}
    most = 0
    for left, right in reversed(merges):
        distance = length[left] + farthest.get(left, 0)
        most = max(most, distance)
        while right is not None:  # the right part and what it starts with, down to one symbol
            if farthest.get(right, 0) < distance:
                farthest[right] = distance
            right = parts.get(right)
    return most


class WordTransducer:
    """Ids of one word's symbols in, stable token ids out; keeps at most BLOCK + lookahead + one token's symbols."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.held: list[int] = []

    def feed(self, symbols: Iterable[int]) -> Iterator[int]:
        symbols = iter(symbols)
        room = self.v.lookahead + BLOCK
        while more := list(islice(symbols, room - len(self.held))):
            self.held += more
            if len(self.held) >= room:
                yield from self._emit(len(self.held) - self.v.lookahead)

    def close(self) -> Iterator[int]:
        yield from self._emit(len(self.held))
        self.held = []

    def _emit(self, stable: int) -> Iterator[int]:
        """Tokens that end within the first ``stable`` symbols; the rest is kept."""
        at = 0
        for token in self.v.merged(self.held):
            n = self.v.symbols_in[token]
            if at + n > stable:
                break
            at += n
            yield token
        self.held = self.held[at:]


class Vocabulary:
    """A ``tokenizers`` BPE file: how texts are cut into words, the merge rules and the ids."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges"):
            raise ValueError("only plain BPE models are read")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ids: dict[str, int] = model["vocab"]
        end = model.get("end_of_word_suffix") or ""
        self.lookahead = lookahead(merges)
        # Rules as numbers: the ids of a pair in one integer, to its rank; the id a rule makes, by rank.
        self.rank = {self.ids[a] << 32 | self.ids[b]: i for i, (a, b) in enumerate(merges)}
        self.made = [self.ids[a + b] for a, b in merges]
        self.symbols_in = [1] * (max(self.ids.values()) + 1)
        for a, b in merges:
            self.symbols_in[self.ids[a + b]] = self.symbols_in[self.ids[a]] + self.symbols_in[self.ids[b]]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self._read_normalizer(spec.get("normalizer"))
        self._read_words(spec["pre_tokenizer"])
        self.decodes_bytes = (spec.get("decoder") or {}).get("type") == "ByteLevel"
        self.alphabet = byte_alphabet()
        self.symbol = [self.ids[c] for c in self.alphabet]
        self.last_symbol = [self.ids[c + end] for c in self.alphabet]
        self._read_tokens()

    def _read_normalizer(self, spec: dict | None) -> None:
        steps = [] if spec is None else spec["normalizers"] if spec["type"] == "Sequence" else [spec]
        kinds = [s["type"] for s in steps]
        if kinds not in ([], ["NFC", "Replace", "Lowercase"]):
            raise ValueError(f"normalizer not known: {kinds}")
        self.lowers = bool(kinds)

    def _read_words(self, spec: dict) -> None:
        steps = spec["pretokenizers"] if spec["type"] == "Sequence" else [spec]
        if steps[-1]["type"] != "ByteLevel" or steps[-1]["add_prefix_space"]:
            raise ValueError("only byte-level vocabularies without a prefix space are read")
        self.keeps_space = len(steps) == 1
        pattern = BYTE_LEVEL_WORDS if self.keeps_space else steps[0]["pattern"]["Regex"]
        self.words = word_pattern(pattern)
        # What one lookup handles: a run of other characters, with the space before it where tokens keep it.
        self.pieces = re.compile(rf"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+" if self.keeps_space else rf"[^{SPACE}]+")

    def _read_tokens(self) -> None:
        n = max([*self.ids.values(), *self.special.values()]) + 1
        self.token_bytes = [b""] * n
        byte = {c: b for b, c in enumerate(self.alphabet)}
        for token, i in self.ids.items():
            whole = self.decodes_bytes and all(c in byte for c in token)
            self.token_bytes[i] = bytes(byte[c] for c in token) if whole else token.encode()
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()

    def merged(self, symbols: list[int]) -> list[int]:
        """Apply the merge rules by rank, leftmost first."""
        if len(symbols) <= SHORT:
            return self._merged_one_by_one(symbols)
        word = symbols
        while True:
            ranks = [self.rank.get(a << 32 | b, NO_RULE) for a, b in zip(word, word[1:])]
            best = min(ranks, default=NO_RULE)
            if best == NO_RULE:
                return word
            new, out, i = self.made[best], [], 0
            while i < len(word):
                if i < len(ranks) and ranks[i] == best:
                    out.append(new)  # takes the symbol after it as well, so the next place is skipped
                    i += 2
                else:
                    out.append(word[i])
                    i += 1
            word = out

    def _merged_one_by_one(self, symbols: list[int]) -> list[int]:
        word, find = list(symbols), self.rank.get
        ranks = [find(a << 32 | b, NO_RULE) for a, b in zip(word, word[1:])]
        while ranks:
            best = min(ranks)
            if best == NO_RULE:
                break
            i = ranks.index(best)
            word[i] = new = self.made[best]
            del word[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = find(new << 32 | word[i + 1], NO_RULE)
            if i:
                ranks[i - 1] = find(word[i - 1] << 32 | new, NO_RULE)
        return word

    def word_ids(self, word: str) -> list[int]:
        data = word.encode("utf-8")
        symbols = [self.symbol[b] for b in data]
        symbols[-1] = self.last_symbol[data[-1]]
        if len(symbols) <= SHORT:  # all of it is read before anything has to be emitted
            return self.merged(symbols)
        transducer = WordTransducer(self)
        return [*transducer.feed(symbols), *transducer.close()]

    def piece_ids(self, piece: str, word_ids: Callable[[str], list[int]]) -> list[int]:
        """The ids of a piece of text between white space."""
        ids: list[int] = []
        for part in self.specials.split(piece) if self.specials else [piece]:
            if part in self.special:
                ids.append(self.special[part])
                continue
            if self.lowers:
                # Letters are lowered one by one, so a sigma at the end of a word is an ordinary one.
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            for word in self.words.findall(part):
                ids += word_ids(word)
        return ids

    def cut(self, text: str) -> list[str]:
        """A text's pieces."""
        if not self.keeps_space and not any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return text.split()  # the same pieces, faster
        return self.pieces.findall(text)


class Encoder(dict):
    """Texts to ids. As a mapping it is the cache: piece to its ids as little-endian 32-bit integers."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__()
        self.v = vocabulary
        self.seen: dict[str, list[int]] = {}

    def word_ids(self, word: str) -> list[int]:
        """Pieces with other punctuation or capitals share their words."""
        ids = self.seen.get(word)
        if ids is None:
            ids = self.v.word_ids(word)
            if len(word) <= CACHED_PIECE:
                if len(self.seen) >= CACHE_PIECES:
                    self.seen.clear()
                self.seen[word] = ids
        return ids

    def __missing__(self, piece: str) -> bytes:
        packed = array("I", self.v.piece_ids(piece, self.word_ids)).tobytes()
        if len(piece) <= CACHED_PIECE:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[piece] = packed
        return packed

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.__getitem__, self.v.cut(text or "")))


class Decoder:
    """Ids in, text out: bytes are collected until they are whole characters; invalid ones become U+FFFD."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.state = codecs.getincrementaldecoder("utf-8")("replace")
        self.started = False

    def feed(self, ids: Iterable[int]) -> str:
        """Without a decoder in the file tokens are joined by spaces, as the library does; else bytes are."""
        gap = b"" if self.v.decodes_bytes else b" "
        data = gap.join(map(self.v.token_bytes.__getitem__, ids))
        if data and self.started:
            data = gap + data
        self.started = self.started or bool(data)
        return self.state.decode(data)

    def close(self) -> str:
        return self.state.decode(b"", True)


@lru_cache(4)
def encoder(path: str) -> Encoder:
    """One per Python worker and vocabulary."""
    return Encoder(Vocabulary(path))


DECODED_AT_ONCE = 1 << 16
DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def decode_packed(v: Vocabulary, packed: bytes) -> Iterator[str]:
    """The text of packed ids, some thousand tokens at a time."""
    machine, ids = Decoder(v), np.frombuffer(packed, "<u4")
    for at in range(0, len(ids), DECODED_AT_ONCE):
        yield machine.feed(ids[at : at + DECODED_AT_ONCE].tolist())
    yield machine.close()


def encode(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and the result: ids array<int>, n_tokens, ids_sha256, decoded_sha256."""
    return _run(docs, path, text, keep, True)


def digests(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """As :func:`encode`, without the ids."""
    return _run(docs, path, text, keep, False)


def _run(docs: DataFrame, path: str, text: str, keep: tuple[str, ...], with_ids: bool) -> DataFrame:
    kept = docs.select(*keep, F.col(text).alias("__text"))
    schema = ", ".join(f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in keep)
    schema += ", " + ("ids array<int>, " if with_ids else "") + DIGEST

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            packed = [e.encode(t.as_py()) for t in batch.column("__text")]
            decoded = []
            for p in packed:
                sha = hashlib.sha256()
                for piece in decode_packed(e.v, p):
                    sha.update(piece.encode())
                decoded.append(sha.hexdigest())
            columns = [batch.column(c) for c in keep]
            lengths = np.array([len(p) // 4 for p in packed], "i8")
            if with_ids:
                ends = np.concatenate([[0], lengths.cumsum()]).astype("i4")
                values = pa.array(np.frombuffer(b"".join(packed), "<i4"))
                columns.append(pa.ListArray.from_arrays(pa.array(ends), values))
            columns += [
                pa.array(lengths),
                pa.array([hashlib.sha256(p).hexdigest() for p in packed], pa.string()),
                pa.array(decoded, pa.string()),
            ]
            names = [*keep, *(["ids"] if with_ids else []), "n_tokens", "ids_sha256", "decoded_sha256"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return kept.mapInArrow(run, schema)
