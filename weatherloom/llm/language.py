"""Language by compression: the language whose dictionary makes a text smallest.

For each language a zstandard raw-content dictionary is cut from a bounded sample
of its texts: up to ``SAMPLE`` documents, chosen by a hash of the id, whole and as many as
``DICTIONARY_BYTES`` hold; these bounds are parameters of the fit alone. Every
whole text, in lower case, is then compressed with each dictionary; the smallest wins. When the runner-up is
within ``margin`` of it, the answer is marked as rejected. A text without a
letter, or null, is ``und`` with score 0 and rejected. Ties go to the language
with more learned documents, then to the first name. Repeated rows are judged alike, an
empty table gives no rows, and other columns, whatever their names, are not looked at.

The score is the share the winner gets when every language is weighted by two to
the power of minus the bits it needs more than the winner, spread over the
logarithm of the text's length; it lies between 1/languages and 1.
"""

from __future__ import annotations

from functools import lru_cache

import regex
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from weatherloom.llm.common import map_rows, sampled, utf8

UNDETERMINED = "und"
SAMPLE = 400
DICTIONARY_BYTES = 112 * 1024
LANGUAGES = 500
MARGIN = 0.02
LEVEL = 3


def held_out(doc_id: str = "doc_id") -> Column:
    """The fifth of the ids that learning leaves alone; rows without an id are not learned from either."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _fitting(rows: list[Row], size: int) -> list[Row]:
    """Rows of one language in the order of their rank, as many as the bytes hold; one that alone holds more is passed over."""
    room, out = size, []
    for row in rows:
        if row["bytes"] < room:
            room -= row["bytes"] + 1
            out.append(row)
    return out


def dictionaries(docs: DataFrame, sample: int = SAMPLE, size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Language -> raw content, from a bounded sample of rows that are not held out; most frequent first.

    The ``LANGUAGES`` most frequent languages are learned. Of each, up to ``sample``
    rows are chosen by a hash, and of these the whole texts that fit into ``size`` bytes come to
    the driver; a text that no longer fits is passed over. A language whose chosen texts are
    all longer than that is learned from the first ``size`` bytes of one.
    """
    learned = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    learned = learned.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    frequent = learned.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    learned = learned.join(F.broadcast(frequent.select("lang")), "lang")
    named = learned.withColumn("hash", F.xxhash64("text"))
    rows = named.select("lang", "doc_id", "hash", F.octet_length("text").alias("bytes")).distinct()
    top, sizes = sampled(rows, "lang", sample, LANGUAGES, "doc_id", "hash")
    chosen = []
    by_language: dict[str, list[Row]] = {lang: [] for lang in sizes}
    for row in top.collect():
        by_language[row["lang"]].append(row)
    for ranked in by_language.values():
        ranked.sort(key=lambda r: r["rank"])
        fitting = _fitting(ranked, size)
        chosen += fitting or ranked[:1]
    keys = [(r["lang"], r["doc_id"], r["hash"], r["rank"]) for r in chosen]
    kind = docs.schema["doc_id"].dataType.simpleString()
    picked = docs.sparkSession.createDataFrame(keys, f"lang string, doc_id {kind}, hash long, rank int")
    # a language's share of the driver is ``size`` bytes, cut or not
    head = F.when(F.octet_length("text") > size, F.substring("text", 1, size)).otherwise(F.col("text")).alias("text")
    found = named.join(F.broadcast(picked), ["lang", "doc_id", "hash"]).select("lang", "rank", head).distinct().collect()
    texts = {(r["lang"], r["rank"]): r["text"] for r in found}
    out = {}
    for lang in sorted(by_language, key=lambda name: (-sizes[name], name)):
        # the text that comes first by rank stands last, nearest to what is compressed
        parts = [texts[key] for key in sorted((k for k in texts if k[0] == lang), reverse=True)]
        out[lang] = _whole_characters(utf8("\n".join(parts).lower()), size)
    return out


def _whole_characters(data: bytes, size: int) -> bytes:
    """The first ``size`` bytes, less a character that is cut."""
    end = min(size, len(data))
    while 0 < end < len(data) and data[end] & 0xC0 == 0x80:
        end -= 1
    return data[:end]


class Identifier:
    def __init__(self, contents: tuple[tuple[str, bytes], ...], margin: float) -> None:
        import zstandard

        self.names = [name for name, _ in contents]
        self.margin = margin
        self.coders = []
        for _, content in contents:
            own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            own.precompute_compress(level=LEVEL)
            options = {"level": LEVEL, "dict_data": own, "write_checksum": False, "write_content_size": False, "write_dict_id": False}
            self.coders.append(zstandard.ZstdCompressor(**options))
        self.letter = regex.compile(r"\p{L}")

    def guess(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score, rejected."""
        if not text or not self.names or not self.letter.search(text):
            return UNDETERMINED, 0.0, True
        data = utf8(text.lower())
        sizes = [len(c.compress(data)) for c in self.coders]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        low = sizes[best]
        scale = max(4.0, len(data) / 64)
        weights = [2.0 ** (-8 * (s - low) / scale) for s in sizes]
        second = min((s for i, s in enumerate(sizes) if i != best), default=2 * low)
        return self.names[best], 1 / sum(weights), second - low < self.margin * low


@lru_cache(maxsize=2)
def _identifier(contents: tuple[tuple[str, bytes], ...], margin: float) -> Identifier:
    return Identifier(contents, margin)


def identified(docs: DataFrame, contents: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """doc_id, lang_pred, score, rejected for every whole text."""
    fixed = tuple(contents.items())

    def rows(columns: dict[str, list]) -> dict[str, list]:
        own = _identifier(fixed, margin)
        found = [own.guess(t) for t in columns["text"]]
        return {
            "doc_id": columns["doc_id"],
            "lang_pred": [f[0] for f in found],
            "score": [f[1] for f in found],
            "rejected": [f[2] for f in found],
        }

    picked = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    return map_rows(picked, f"doc_id {kind}, lang_pred string, score double, rejected boolean", rows, ["doc_id", "text"])
