"""Token counts of a lower-casing BPE with word ends, by a search over vocabulary entries with a cache of token pairs.

The tokenizer file is read as it stands (NFC, white space to one space, lower
case, pieces by pattern, byte-level BPE whose last symbol of a piece carries the
end-of-word mark). At each symbol of a piece exactly one vocabulary entry ends the
prefix and fits the one before it. Whether two tokens may stand next to each other is worked
out by the merges once per pair and kept. No table of states and transitions is
built, and no maps of chunks: pieces do not depend on one another.

A text is cut into chunks at white space, or where a piece certainly ends, whose
counts are added up in one process. Special strings in a text are one token each, as
the library counts them by default.

Null and empty texts have no tokens. Repeated rows are counted again, there are no ties, an
empty table gives no rows, and other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import accumulate

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weatherloom.llm.byte_bpe import splitter
from weatherloom.llm.common import map_rows, utf8

REMEMBERED = 800_000
CHUNK = 1 << 16


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves; the other bytes, in order,
    for the characters from U+0100 on.
    """
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Transducer:
    """Counts the tokens of a piece; transitions are compiled as they are met."""

    def __init__(self, vocabulary: set[str], ranks: dict[tuple[str, str], int], word_end: str) -> None:
        self.vocabulary, self.ranks, self.word_end = vocabulary, ranks, word_end
        self.symbols = byte_symbols()
        self.longest = max(len(t.removesuffix(word_end)) for t in vocabulary)
        self.fits: dict[tuple[str, str], bool] = {}
        self.reached: dict[str, bool] = {}

    def merged(self, parts: list[str]) -> list[str]:
        """The parts after all merges: lowest rank first, leftmost among equals."""
        n = len(parts)
        after, text = [*range(1, n + 1)], list(parts)
        before, alive = [*range(-1, n - 1)], [True] * n
        rank = self.ranks.get
        heap = [(r, i, text[i], text[i + 1]) for i in range(n - 1) if (r := rank((text[i], text[i + 1]))) is not None]
        heapify(heap)
        while heap:
            _, i, left, right = heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or text[i] != left or text[j] != right:
                continue
            text[i], alive[j], after[i] = left + right, False, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := rank((text[i], text[after[i]]))) is not None:
                    heappush(heap, (r, i, text[i], text[after[i]]))
            if before[i] >= 0 and (r := rank((text[before[i]], text[i]))) is not None:
                heappush(heap, (r, before[i], text[before[i]], text[i]))
        return [text[i] for i in range(n) if alive[i]]

    def _parts(self, token: str) -> list[str]:
        if token.endswith(self.word_end) and len(token) > len(self.word_end):
            body = token[: -len(self.word_end)]
            return [*body[:-1], body[-1] + self.word_end]
        return list(token)

    def _is_reached(self, token: str) -> bool:
        if token not in self.reached:
            self.reached[token] = self.merged(self._parts(token)) == [token]
        return self.reached[token]

    def _fit(self, left: str, right: str) -> bool:
        if len(self.fits) >= 2 * REMEMBERED:
            self.fits.clear()
        known = self.fits[left, right] = self.merged([*left, *self._parts(right)]) == [left, right]
        return known

    def count(self, piece: str) -> int:
        """Tokens of a piece, by running over its symbols and adding what the transitions emit."""
        text = "".join(map(self.symbols.__getitem__, utf8(piece)))
        n, vocabulary, longest = len(text), self.vocabulary, self.longest
        if text + self.word_end in vocabulary and self._is_reached(text + self.word_end):
            return 1
        last: list[str] = [""] * (n + 1)
        emitted = [0] * (n + 1)
        fits = self.fits
        for stop in range(1, n + 1):
            mark = self.word_end if stop == n else ""
            # longer candidates first: the token that is in fact last is usually among them
            for start in range(max(0, stop - longest), stop):
                token = text[start:stop] + mark
                if token in vocabulary:
                    if start:
                        fit = fits.get((last[start], token))
                        if fit is None:
                            fit = self._fit(last[start], token)
                    else:
                        fit = self._is_reached(token)
                    if fit:
                        last[stop], emitted[stop] = token, emitted[start] + 1
                        break
        return emitted[n]


class _Remembered(dict):
    def __init__(self, transducer: Transducer) -> None:
        self.transducer = transducer

    def __missing__(self, piece: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[piece] = n = self.transducer.count(piece)
        return n


class Counter:
    """Counts for one tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        model = made["model"]
        steps = [n["type"] for n in made["normalizer"]["normalizers"]]
        if (model["type"], steps) != ("BPE", ["NFC", "Replace", "Lowercase"]):
            raise ValueError(f"{path}: not a lower-casing BPE of this kind")
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.transducer = Transducer(set(model["vocab"]), {m: i for i, m in enumerate(merges)}, model["end_of_word_suffix"])
        self.remembered = _Remembered(self.transducer)
        self.split = splitter(made["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        special = [t["content"] for t in made["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        # where a piece has certainly ended: at white space, or after a letter or digit that no letter or digit follows
        self.cut = regex.compile(r"\s|(?<=[\p{L}\p{N}])(?=[^\s\p{L}\p{N}\p{M}])")

    def chunks(self, text: str) -> list[str]:
        """The text in pieces of about ``CHUNK`` characters, or longer where there is nowhere to cut."""
        out, start = [], 0
        while len(text) - start > CHUNK:
            found = self.cut.search(text, start + CHUNK)
            if found is None:
                break
            out.append(text[start : found.start()])
            start = found.start()
        return [*out, text[start:]]

    def of_chunk(self, text: str) -> int:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            text = "".join(c.lower() for c in text) if "Σ" in text else text.lower()
        else:
            text = text.lower()
        return sum(map(self.remembered.__getitem__, self.split(text)))

    def of_text(self, text: str) -> int:
        parts = self.special.split(text) if self.special else [text]
        counts = [self.of_chunk(chunk) for part in parts for chunk in self.chunks(part)]
        return [*accumulate(counts, initial=len(parts) - 1)][-1]


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One per worker; the file is read where it is used."""
    return Counter(path)


def counted(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every whole text."""

    def rows(columns: dict[str, list]) -> dict[str, list]:
        own = counter(path)
        texts = [t or "" for t in columns["text"]]
        tokens = [own.of_text(t) for t in texts]
        return {
            "doc_id": columns["doc_id"],
            "n_bytes": [len(utf8(t)) for t in texts],
            "n_tokens": tokens,
            "over_limit": [n > limit for n in tokens],
        }

    picked = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    return map_rows(picked, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean", rows, ["doc_id", "text"])
