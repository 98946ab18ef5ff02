"""Byte-level BPE over rank files: encode whole texts to ids and decode ids to bytes.

Lookup has two tiers. A minimal perfect hash over the vocabulary resolves a
pre-token that is a vocabulary entry at once; any other is merged pair by pair,
lowest rank first and leftmost among equals, with a heap over a linked list of
its bytes. Each worker keeps the results for pre-tokens it has seen, up to
``REMEMBERED`` of them.

A null text encodes to no ids. A repeated row is encoded again. Lone surrogates
cannot occur: Spark strings are UTF-8. Texts of any length are encoded whole. An empty
table gives no rows, and other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
import unicodedata
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weatherloom.llm.common import map_rows

REMEMBERED = 800_000
PER_BUCKET = 4
_STEP, _SPREAD, _ALL = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), (1 << 64) - 1

#: The White_Space characters of Unicode.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0                　"


class MinimalPerfectHash:
    """Hash and displace: ``len(keys)`` keys to as many slots, each slot used once.

    Keys are dealt to buckets of about four. From the fullest bucket on, each finds
    the first displacement that moves its keys to free slots; buckets of one key
    name their slot outright.
    """

    def __init__(self, keys: list[bytes]) -> None:
        from xxhash import xxh3_64_intdigest

        self.size = len(keys)
        self.buckets = max(1, self.size // PER_BUCKET)
        dealt: list[list[int]] = [[] for _ in range(self.buckets)]
        hashes = [xxh3_64_intdigest(key) for key in keys]
        for i, h in enumerate(hashes):
            dealt[h % self.buckets].append(i)
        self.displacement = [0] * self.buckets
        self.slots: list[int] = [-1] * self.size
        taken = np.zeros(self.size, bool)
        order = sorted(range(self.buckets), key=lambda b: -len(dealt[b]))
        tries = np.arange(1, 1025, dtype=np.uint64)[:, None]
        single = [b for b in order if len(dealt[b]) == 1]
        for b in order:
            if len(dealt[b]) < 2:
                break
            own = np.array([hashes[i] for i in dealt[b]], np.uint64)
            base = np.uint64(0)
            while True:
                places = (((own ^ ((tries + base) * _STEP)) * _SPREAD) >> np.uint64(24)) % np.uint64(self.size)
                free = ~taken[places].any(axis=1)
                if len(own) > 1:
                    ordered = np.sort(places, axis=1)
                    free &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
                good = np.flatnonzero(free)
                if len(good):
                    break
                base += np.uint64(1024)
                if base > np.uint64(1 << 32):
                    raise ValueError("keys repeat, or their hashes do")
            self.displacement[b] = int(tries[good[0], 0] + base)
            for i, place in zip(dealt[b], places[good[0]].tolist(), strict=True):
                taken[place] = True
                self.slots[place] = i
        for b, place in zip(single, np.flatnonzero(~taken).tolist(), strict=True):
            self.displacement[b] = -place - 1
            self.slots[place] = dealt[b][0]
        self.keys = [keys[i] for i in self.slots]
        self._hash = xxh3_64_intdigest

    def find(self, key: bytes) -> int | None:
        """The key's slot, or None for any other bytes."""
        h = self._hash(key)
        d = self.displacement[h % self.buckets]
        place = -d - 1 if d < 0 else ((((h ^ (d * int(_STEP) & _ALL)) * int(_SPREAD)) & _ALL) >> 24) % self.size
        return place if self.keys[place] == key else None


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The tokens of a pre-token that is no vocabulary entry itself.

    ``following[i]`` is where the part after the one at i starts, 0 when no part
    starts at i any more. A heap entry holds rank, start and end of a pair; it is
    stale unless a part starts there and the next one ends there.
    """
    end = len(piece)
    following = [*range(1, end + 1), 0]
    before = [*range(-1, end)]
    get = ranks.get
    heap = [(rank, i, i + 2) for i in range(end - 1) if (rank := get(piece[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, stop = heappop(heap)
        middle = following[i]
        if not middle or following[middle] != stop:
            continue
        following[i], following[middle] = stop, 0
        before[stop] = i
        if stop < end and (rank := get(piece[i : following[stop]])) is not None:
            heappush(heap, (rank, i, following[stop]))
        if i and (rank := get(piece[before[i] : stop])) is not None:
            heappush(heap, (rank, before[i], stop))
    out, i = [], 0
    while i < end:
        out.append(piece[i : following[i]])
        i = following[i]
    return out


def _class_of(kind: str, top: int) -> str:
    """The characters below ``top`` whose general category starts with ``kind``, for a character class."""
    ranges, start = [], None
    for code in range(top + 1):
        inside = code < top and not 0xD800 <= code <= 0xDFFF and unicodedata.category(chr(code))[0] == kind
        if inside and start is None:
            start = code
        elif not inside and start is not None:
            ranges.append((start, code - 1))
            start = None
    return "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in ranges)


def splitter(pattern: str):
    """A function from a text to its pre-tokens.

    Texts of Latin-1 characters, the usual case, go to Python's ``re`` with the
    classes written out; all others go to ``regex``. White space is Unicode's
    White_Space property in both.
    """
    import regex

    letters, numbers = _class_of("L", 256), _class_of("N", 256)
    latin_space = "".join(re.escape(c) for c in WHITE_SPACE if c < "Ā")

    def written(space: str, letter: str, number: str, not_space: str) -> str:
        # inside a class the bare members are wanted, outside a class of their own
        out, inside, i = [], False, 0
        while i < len(pattern):
            two = pattern[i : i + 2]
            named = pattern[i : i + 5]
            if two == r"\s":
                out.append(space if inside else f"[{space}]")
                i += 2
            elif two == r"\S":
                out.append(not_space)
                i += 2
            elif named in (r"\p{L}", r"\p{N}"):
                member = letter if named[3] == "L" else number
                out.append(member if inside else f"[{member}]")
                i += 5
            else:
                inside = (inside or pattern[i] == "[") and pattern[i] != "]"
                out.append(pattern[i])
                i += 1
        return "".join(out)

    narrow = re.compile(written(latin_space, letters, numbers, f"[^{latin_space}]")).findall
    wide = regex.compile(written(r"\p{White_Space}", r"\p{L}", r"\p{N}", r"\P{White_Space}")).findall

    def split(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return wide(text)
        return narrow(text)

    return split


class _Remembered(dict):
    """Pre-token -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, codec: Codec) -> None:
        self.codec = codec

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        self[piece] = ids = self.codec.encode_piece(piece.encode("utf-8", "surrogatepass"))
        return ids


class Codec:
    """Encoder and decoder for one rank file and one pre-token pattern."""

    def __init__(self, ranks_file: str, pattern: str) -> None:
        with open(ranks_file, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        tokens = list(self.ranks)
        self.packed = {token: rank.to_bytes(4, "little") for token, rank in self.ranks.items()}
        self.whole = MinimalPerfectHash(tokens)
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.split = splitter(pattern)
        self.remembered = _Remembered(self)

    def encode_piece(self, piece: bytes) -> bytes:
        found = self.whole.find(piece)
        if found is not None:
            return self.packed[self.whole.keys[found]]
        return b"".join(map(self.packed.__getitem__, merge(piece, self.ranks)))

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.remembered.__getitem__, self.split(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def codec(ranks_file: str, pattern: str) -> Codec:
    """One per worker; the vocabulary is read where it is used."""
    return Codec(ranks_file, pattern)


def encoded(docs: DataFrame, ranks_file: str, pattern: str) -> DataFrame:
    """doc_id and ``ids``: the text's ids as little-endian unsigned 32-bit integers (empty for null)."""

    def rows(columns: dict[str, list]) -> dict[str, list]:
        own = codec(ranks_file, pattern)
        return {"doc_id": columns["doc_id"], "ids": [own.encode(t) if t else b"" for t in columns["text"]]}

    picked = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    return map_rows(picked, f"doc_id {kind}, ids binary", rows, ["doc_id", "text"])


def decoded(ids: DataFrame, ranks_file: str, pattern: str) -> DataFrame:
    """doc_id, ids and ``bytes``: what the ids stand for."""

    def rows(columns: dict[str, list]) -> dict[str, list]:
        own = codec(ranks_file, pattern)
        return {**columns, "bytes": [own.decode(i) for i in columns["ids"]]}

    kind = ids.schema["doc_id"].dataType.simpleString()
    return map_rows(ids, f"doc_id {kind}, ids binary, bytes binary", rows, ["doc_id", "ids"])


def digests(docs: DataFrame, ranks_file: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text, encoded and decoded again."""

    def rows(columns: dict[str, list]) -> dict[str, list]:
        own = codec(ranks_file, pattern)
        out: dict[str, list] = {"doc_id": columns["doc_id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for text in columns["text"]:
            ids = own.encode(text) if text else b""
            out["n_tokens"].append(len(ids) // 4)
            out["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(own.decode(ids)).hexdigest())
        return out

    picked = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    return map_rows(picked, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string", rows, ["doc_id", "text"])
