"""Repeated runs of lines, by prefix doubling over line ids.

A document is the sequence of its lines (split at ``\\n``). A run of neighbouring lines that
holds at least ``words`` words and stands earlier in the corpus too (in order of
doc_id, text hash, line) is a copy, and all its lines go; the first copy stays. Of an unbroken
repetition of a line the first stands earlier than the rest, so the run shrinks to
its beginning.

Runs are compared in a suffix array's way, by the names of their prefixes. Line
ids are 64-bit hashes, and doubling gives each place a name for the next 1, 2,
4, ... lines, and the number of words in them: a name is the hash of the names of its two halves, so
every task names equal runs alike and no ranks are exchanged. At each place the
doubling descends to the shortest run from there that holds the words, and to the
shortest that ends there; a run of any length is named by the two overlapping
powers of two that cover it. Suffixes that share such a prefix form one interval of the
array. Only (interval, place) pairs are shuffled. A maximal repeated run with enough
words is the union of the shortest ones inside it, taken from both sides, so marking
those marks every maximal run in full.

Null text has no lines. An empty table gives no rows, and documents keep their other columns, whatever
their names. Rows that are equal in doc_id and text count as one
document. A null doc_id orders first. Words lie between ASCII white space; empty
lines are lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherloom.session import cut_lineage

WORDS = 50
WORD = r"[^\x20\x09-\x0D]+"


def _lines(text: str) -> Column:
    return F.expr(f"split({text}, '\\n', -1)")


def _named(docs: DataFrame) -> DataFrame:
    """Per document the arrays of names and word counts, one level for each power of two."""
    words = F.expr(f"transform(lines, x -> named_struct('name', xxhash64(x), 'words', regexp_count(x, r'{WORD}')))")
    first = docs.withColumn("levels", F.array(words))
    doubled = """aggregate(sequence(1, greatest(1, cast(ceil(log2(size(lines))) as int))), levels, (acc, j) ->
        concat(acc, array(transform(acc[j - 1], (x, i) -> if(i + cast(shiftleft(1, j - 1) as int) < size(lines),
            named_struct('name', xxhash64(x.name, acc[j - 1][i + cast(shiftleft(1, j - 1) as int)].name),
                         'words', x.words + acc[j - 1][i + cast(shiftleft(1, j - 1) as int)].words),
            x)))))"""
    return first.withColumn("levels", F.expr(doubled))


def _runs(words: int) -> Column:
    """Shortest runs with enough words, from each place forward and back: array of (from, to), to exclusive."""
    descent = "sequence(size(levels) - 1, 0, -1)"
    step = "cast(shiftleft(1, j) as int)"
    forward = f"""transform(lines, (x, p) -> aggregate({descent}, named_struct('n', 0, 'w', 0), (s, j) ->
        if(p + s.n + {step} < size(lines) and s.w + levels[j][p + s.n].words < {words},
           named_struct('n', s.n + {step}, 'w', s.w + levels[j][p + s.n].words), s),
        s -> if(s.w + levels[0][p + s.n].words >= {words}, shiftleft(cast(s.n + 1 as bigint), 32) + p, null)))"""
    backward = f"""transform(lines, (x, p) -> aggregate({descent}, named_struct('n', 0, 'w', 0), (s, j) ->
        if(p - s.n - {step} >= 0 and s.w + levels[j][p - s.n - {step} + 1].words < {words},
           named_struct('n', s.n + {step}, 'w', s.w + levels[j][p - s.n - {step} + 1].words), s),
        s -> if(s.w + levels[0][p - s.n].words >= {words}, shiftleft(cast(s.n + 1 as bigint), 32) + p - s.n, null)))"""
    # a run is one number here, its length above its start: numbers are compared by hash, structs one with another,
    # and the hash of a number is its halves' exclusive or, which a start above an end would make alike
    distinct = f"array_distinct(filter(concat({forward}, {backward}), r -> r is not null))"
    return F.expr(f"transform({distinct}, r -> named_struct('from', cast(r & 4294967295 as int), 'to', cast((r & 4294967295) + shiftright(r, 32) as int)))")


def repeated_runs(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, row_hash and ``runs`` (array of from, to in lines) of the runs that stand earlier too; they may overlap."""
    given = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter("text is not null")
    lined = given.select("doc_id", F.xxhash64("text").alias("row_hash"), _lines("text").alias("lines"))
    enough = lined.filter(F.expr(f"aggregate(lines, 0, (s, x) -> s + regexp_count(x, r'{WORD}')) >= {int(words)}"))
    runs = _named(enough).withColumn("runs", _runs(words))
    level = "cast(floor(log2(r.to - r.from)) as int)"
    name = f"""transform(runs, r -> named_struct('from', r.from, 'to', r.to, 'name', xxhash64(r.to - r.from,
        levels[{level}][r.from].name, levels[{level}][r.to - cast(shiftleft(1, {level}) as int)].name)))"""
    placed = runs.select("doc_id", "row_hash", F.expr(f"inline({name})"))
    places = cut_lineage(placed.select("name", F.struct("doc_id", "row_hash", "from").alias("at"), "to"))
    first = places.groupBy("name").agg(F.min("at").alias("first"), F.max("at").alias("last")).filter("first < last")
    copies = places.join(first.select("name", "first"), "name").filter("first < at")
    return (
        copies.groupBy(F.col("at.doc_id").alias("doc_id"), F.col("at.row_hash").alias("row_hash"))
        .agg(F.collect_set(F.struct(F.col("at.from").alias("from"), "to")).alias("runs"))
    )


def _merged(runs: str) -> str:
    """Maximal runs of lines, in order, from runs that may overlap or touch.

    The furthest end up to each run is found by doubling; a run that starts
    beyond it begins a new maximal one.
    """
    furthest = """aggregate(sequence(0, greatest(0, cast(ceil(log2(size(s))) as int) - 1)), transform(s, r -> r.to), (acc, j) ->
        transform(acc, (x, i) -> if(i >= cast(shiftleft(1, j) as int), greatest(x, acc[i - cast(shiftleft(1, j) as int)]), x)))"""
    starts = "filter(transform(s, (r, i) -> if(i = 0 or r.from > m[i - 1], i, null)), i -> i is not null)"
    whole = "transform(b, (i, k) -> named_struct('from', s[i].from, 'to', m[if(k + 1 < size(b), b[k + 1], size(s)) - 1]))"
    for name, value in (("b", starts), ("m", furthest), ("s", f"array_sort({runs})")):
        whole = f"transform(array({value}), {name} -> {whole})[0]"
    return whole


def _marked(docs: DataFrame, words: int) -> DataFrame:
    """``row`` (the document with all its columns), ``lines`` and ``gone`` (maximal runs of lines that go, in order)."""
    copies = repeated_runs(docs, words).select(F.col("doc_id").alias("own_id"), F.col("row_hash").alias("own_hash"), "runs")
    rows = docs.select(F.struct("*").alias("row"))  # its columns may have any names
    same = F.col("row.doc_id").eqNullSafe(F.col("own_id")) & (F.xxhash64(F.col("row.text").cast("string")) == F.col("own_hash"))
    nothing = F.array().cast("array<struct<from:int,to:int>>")
    return rows.join(copies, same, "left").select(
        "row",
        F.coalesce(_lines("cast(row.text as string)"), F.array().cast("array<string>")).alias("lines"),
        F.when(F.col("runs").isNull(), nothing).otherwise(F.expr(_merged("runs"))).alias("gone"),
    )


#: What stays: the lines before, between and after the runs that go.
_KEPT = """array_join(flatten(transform(sequence(0, size(gone)), k -> slice(lines,
    if(k = 0, 0, gone[k - 1].to) + 1,
    greatest(0, if(k = size(gone), size(lines), gone[k].from) - if(k = 0, 0, gone[k - 1].to))))), '\\n')"""


def summary(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Per row: doc_id, n_lines, n_removed, n_runs (maximal runs removed) and kept_sha256 of the lines that stay."""
    given = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return _marked(given, words).select(
        F.col("row.doc_id").alias("doc_id"),
        F.size("lines").cast("long").alias("n_lines"),
        F.expr("aggregate(gone, 0L, (s, r) -> s + r.to - r.from)").alias("n_removed"),
        F.size("gone").cast("long").alias("n_runs"),
        F.sha2(F.expr(_KEPT).cast("binary"), 256).alias("kept_sha256"),
    )


def without_copies(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """The documents, with all their columns, without the copies of lines. A document with nothing left but copies goes."""
    marked = _marked(docs, words)
    kept = marked.filter("size(gone) = 0 or aggregate(gone, 0, (s, r) -> s + r.to - r.from) < size(lines)")
    text = F.when(F.size("gone") == 0, F.col("row.text")).otherwise(F.expr(_KEPT))
    columns = [F.col("row").getField(c).alias(c) if c != "text" else text.alias(c) for c in docs.columns]
    return kept.select(*columns)
