"""Byte-pair encoding by backtracking over longest matches, and decoding by an offset table.

An Aho-Corasick automaton over the vocabulary gives the longest token at a place.
Two neighbouring tokens are *compatible* if merging their joined bytes by the
vocabulary's merge order gives just these two; a sequence whose neighbours are all
compatible is the exact encoding. The encoder takes longest matches and, where a pair
is incompatible, goes to the next shorter token or steps back; every place is given up
at most once, so time is linear in the text.

Texts are first cut as the vocabulary's pre-tokenizer does. Decoding copies slices of
one byte string, found by an array of offsets. Encoding is local to a row: one pass over
the input, no shuffle.

Nulls are encoded as the empty text (0 tokens); a text of any length is encoded whole;
repeated rows give repeated results; an empty table gives an empty table; further
columns are left alone.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from functools import cache

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHED_WORDS = 300_000
CACHED_PAIRS = 500_000
NEVER = 1 << 60

# Letters, digits and white space of the first 256 characters; the general pattern has the rest.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾", "\\t-\\r \\x85\\xa0"
_LATIN = re.compile(
    rf"'(?:[stmd]|re|ve|ll)| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
)
_ANY = regex.compile(
    r"'(?:[stmd]|re|ve|ll)| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def words(text: str) -> list[str]:
    """The pieces that are encoded on their own."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _ANY.findall(text)
    return _LATIN.findall(text)


def _byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merges and the tables derived from them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        letters = _byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        special = {t["content"]: t["id"] for t in data["added_tokens"]}
        ids = {raw(t): i for t, i in data["model"]["vocab"].items() if t not in special}
        size = max([*ids.values(), *special.values()]) + 1
        self.special = special
        self.split_special = (
            re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")
            if special else None
        )
        self.tokens = [b""] * size
        for token, i in ids.items():
            self.tokens[i] = token
        for token, i in special.items():
            self.tokens[i] = token.encode()
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(data["model"]["merges"]):
            left, right = (ids[raw(t)] for t in (merge.split(" ") if isinstance(merge, str) else merge))
            self.rank[left, right] = rank
            self.parts.setdefault(ids[self.tokens[left] + self.tokens[right]], (rank, left, right))
        self.automaton = ahocorasick.Automaton()
        for token, i in ids.items():
            self.automaton.add_word(token.decode("latin-1"), i)
        self.automaton.make_automaton()
        #: The next shorter token that begins a token, or -1.
        self.shorter = [-1] * size
        for token, i in ids.items():
            self.shorter[i] = next(
                (ids[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in ids), -1
            )
        lengths = np.fromiter(map(len, self.tokens), np.int64, size)
        self.length = lengths.tolist()
        self.offsets = np.concatenate(([0], np.cumsum(lengths)))
        self.blob = np.frombuffer(b"".join(self.tokens), np.uint8)
        decimal = [b"%d," % i for i in range(size)]
        self.decimal_offsets = np.concatenate(([0], np.cumsum([len(d) for d in decimal])))
        self.decimal_blob = np.frombuffer(b"".join(decimal), np.uint8)
        self._left: dict[int, list] = {}
        self._right: dict[int, list] = {}
        self._pairs: dict[int, bool] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The parts at one end of a token, smallest first, each with the rank that absorbs it."""
        kept = self._right if side else self._left
        if token not in kept:
            edge, absorbed, part = [], NEVER, token
            while True:
                edge.append((part, absorbed))
                if part not in self.parts:
                    break
                rank, left, right = self.parts[part]
                absorbed, part = rank, right if side else left
            kept[token] = edge[::-1]
        return kept[token]

    def compatible(self, a: int, b: int) -> bool:
        """Whether the joined bytes of two tokens are encoded as just these two."""
        key = a << 20 | b
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= CACHED_PAIRS:
                self._pairs.clear()
            known = self._pairs[key] = self._compatible(a, b)
        return known

    def _compatible(self, a: int, b: int) -> bool:
        ends, starts, i, j = self._edge(a, 1), self._edge(b, 0), 0, 0
        while True:
            (left, left_goes), (right, right_goes) = ends[i], starts[j]
            across = self.rank.get((left, right), NEVER)
            # Equal ranks merge from the left, so the one inside ``a`` comes first.
            if across < left_goes and across <= right_goes and across != NEVER:
                return False
            if left_goes == right_goes == NEVER:
                return True
            if left_goes <= right_goes:
                i += 1
            else:
                j += 1

    def encode_word(self, word: str) -> list[int]:
        """Token ids of one pre-token."""
        text = word.encode("utf-8", "surrogatepass").decode("latin-1")
        found = [i for _, i in self.automaton.iter_long(text)]
        known, last = self._pairs.get, found[0]
        for n, token in enumerate(found[1:], 1):
            fits = known(last << 20 | token)
            if not (self.compatible(last, token) if fits is None else fits):
                return self._backtrack(text, found, n)
            last = token
        return found

    def _backtrack(self, text: str, found: list[int], fitting: int) -> list[int]:
        """Go on from the first ``fitting`` longest matches, after which the next one does not fit."""
        length, shorter, known, longest = self.length, self.shorter, self._pairs.get, self.automaton.iter_long
        chosen, token, end = found[:fitting], found[fitting], len(text)
        dead = bytearray(end + 1)
        at = sum(length[i] for i in chosen)
        while at < end:
            last = chosen[-1] if chosen else -1
            while token >= 0:
                if not dead[at + length[token]]:
                    if last < 0:
                        break
                    fits = known(last << 20 | token)
                    if self.compatible(last, token) if fits is None else fits:
                        break
                token = shorter[token]
            if token >= 0:
                chosen.append(token)
                at += length[token]
                if at < end:
                    token = next(longest(text, at))[1]
            else:  # nothing fits here after what was chosen: give the place up
                dead[at] = 1
                token = chosen.pop()
                at -= length[token]
        return chosen


def gather(blob: np.ndarray, offsets: np.ndarray, ids: np.ndarray) -> bytes:
    """Joined slices ``blob[offsets[i]:offsets[i + 1]]`` of all ids."""
    starts = offsets[ids]
    lengths = offsets[ids + 1] - starts
    ends = np.cumsum(lengths)
    if not len(ends):
        return b""
    places = np.repeat(starts - (ends - lengths), lengths)
    places += np.arange(ends[-1])
    return blob[places].tobytes()


class _Known(dict):
    """Ids of words met lately, as little-endian 32-bit bytes.

    When full it becomes the older half and a new one begins; words met again move over.
    """

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            found = self.vocabulary.encode_word(word)
            ids = struct.pack(f"<{len(found)}I", *found)
        if len(word) <= 64:
            if len(self) >= CACHED_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Codec:
    """Encoder and decoder for one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._known = _Known(self.vocabulary)

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        v, known = self.vocabulary, self._known.__getitem__
        if v.split_special is None or not any(s in text for s in v.special):
            return b"".join(map(known, words(text)))
        out = []
        for part in v.split_special.split(text):
            if part in v.special:
                out.append(np.array([v.special[part]], "<u4").tobytes())
            elif part:
                out.append(b"".join(map(known, words(part))))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 bytes of the decoded text."""
        v = self.vocabulary
        joined = gather(v.blob, v.offsets, np.frombuffer(ids, "<u4").astype(np.int64))
        return joined.decode("utf-8", "replace").encode()

    def decimal(self, ids: bytes) -> bytes:
        """Decimal ids joined by commas."""
        v = self.vocabulary
        return gather(v.decimal_blob, v.decimal_offsets, np.frombuffer(ids, "<u4").astype(np.int64))[:-1]


@cache
def codec(path: str) -> Codec:
    """One per Python worker."""
    return Codec(Vocabulary(path))


def encode_column(path: str):
    """A vectorised function: text to ids as little-endian 32-bit bytes."""

    @F.pandas_udf("binary")
    def encode(texts: pd.Series) -> pd.Series:
        return texts.map(codec(path).encode)

    return encode


def decode_column(path: str):
    """A vectorised function: such bytes to text."""

    @F.pandas_udf("string")
    def decode(ids: pd.Series) -> pd.Series:
        return ids.map(lambda x: None if x is None else codec(path).decode(x).decode())

    return decode


def round_trip_digests(docs: DataFrame, path: str) -> DataFrame:
    """Per row: doc_id, number of tokens, SHA-256 of the ids and of the decoded text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def digests(batches):
        own = codec(path)
        for batch in batches:
            out = ([], [], [])
            for text in batch.column("text"):
                ids = own.encode(text.as_py())
                out[0].append(len(ids) // 4)
                out[1].append(hashlib.sha256(own.decimal(ids)).hexdigest())
                out[2].append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out[0], pa.int64()),
                 pa.array(out[1], pa.string()), pa.array(out[2], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        digests, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
