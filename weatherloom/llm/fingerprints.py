"""Document fingerprints by winnowing, in Spark expressions only.

A text's units are its words of at most eight characters and, in longer unspaced runs, the
eight characters at every character, each hashed; a gram is ``GRAM`` units in a row, and one starts
at every unit, so grams roll whatever comes before them. Of every ``WINDOW`` neighbouring grams the
smallest is kept, the rightmost of equals, once; window minima are found by doubling. A
number holds both: the upper 37 bits of the hash and, below them, how far the place lies from the
27-bit maximum, so that the smaller number is the smaller hash and then the place further right.
Two texts that share ``GRAM + WINDOW - 1`` units in a row (11 short words, or 18 characters of a
longer run) share a kept gram, and the places say where.

A text of at most ``SHORT`` grams keeps all of them; they are thinned by the window before they
are compared with a longer text's, so that likeness does not jump there. With fewer
units than a gram all units are one gram; without units (empty, null, white space) the
fingerprint is empty. The likeness of two fingerprints is the Jaccard similarity of their hashes,
1 if both are empty. Equal texts have equal fingerprints.

The next document is found without a global window: ids are cut into ranges of
about ``PER_RANGE`` documents by quantiles of the id and evenly between them, rows without an id
by their text's hash (each at most ``RANGES``); a range is one window group, and the first row of a range is copied to
the end of the range before. Rows are ordered by doc_id (null first), then by text hash; of
rows that are equal in both, each is followed by the next such row. An empty table gives no rows; other
columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

GRAM, WINDOW, SHORT = 4, 8, 64
PLACE_BITS = 27
PER_RANGE, RANGES, QUANTILES = 1024, 1_000_000, 64


def _minima(grams: str, window: int) -> str:
    """The smallest of every ``window`` neighbouring numbers, once; of fewer numbers the smallest."""
    out, width = "g", 1
    steps = []
    while width < window:
        steps.append(width)
        width *= 2
    for width in steps:
        out = f"transform(array({out}), g -> transform(sequence(0, size(g) - {width + 1}), i -> least(g[i], g[i + {width}])))[0]"
    return f"transform(array({grams}), g -> if(size(g) <= {window}, slice(array(array_min(g)), 1, least(size(g), 1)), array_distinct({out})))[0]"


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``name``: the fingerprint of column ``text``, as (n: number of grams, kept: numbers in order of place)."""
    units = rf"regexp_extract_all({text}, r'(?=((?<!\S)\S{{1,8}}(?!\S)|\S{{8}}))\S', 1)"
    top = (1 << PLACE_BITS) - 1
    at = "_winnow"
    pieces = F.expr(f"transform({units}, x -> xxhash64(x))")
    out = df.withColumn(at, F.when(F.col(text).isNull(), F.array().cast("array<long>")).otherwise(pieces))
    numbered = f"shiftleft(shiftright(xxhash64({{}}), {PLACE_BITS}), {PLACE_BITS}) | ({top}{{}})"
    own = ", ".join(f"{at}[i + {k}]" for k in range(GRAM))
    out = out.withColumn(
        at,
        F.expr(
            f"if(size({at}) >= {GRAM}, transform(sequence(0, size({at}) - {GRAM}), i -> {numbered.format(own, ' - i')}), "
            f"if(size({at}) > 0, array({numbered.format(at, '')}), {at}))"
        ),
    )
    return out.withColumn(name, F.expr(f"struct(size({at}) as n, if(size({at}) <= {SHORT}, {at}, {_minima(at, WINDOW)}) as kept)")).drop(at)


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of two fingerprints; a short one beside a long one is thinned by the window."""

    def side(own: str, other: str) -> str:
        return f"if({own}.n <= {SHORT} and {other}.n > {SHORT}, {_minima(f'{own}.kept', WINDOW)}, {own}.kept)"

    hashes = [hashes_of(side(*pair)) for pair in ((a, b), (b, a))]
    joint = f"transform(array(struct({hashes[0]} as x, {hashes[1]} as y)), h -> struct(size(array_intersect(h.x, h.y)) as c, size(h.x) + size(h.y) as s))[0]"
    return F.expr(f"transform(array({joint}), j -> if(j.s = 0, 1d, j.c / cast(j.s - j.c as double)))[0]")


def hashes_of(fingerprint: str) -> str:
    return f"array_distinct(transform({fingerprint}, x -> shiftright(x, {PLACE_BITS})))"


def written(fingerprint: str) -> Column:
    """place:hash of every kept gram, hexadecimal."""
    top = (1 << PLACE_BITS) - 1
    return F.expr(
        f"array_join(transform({fingerprint}, x -> concat(hex({top} - (x & {top})), ':', hex(shiftrightunsigned(x, {PLACE_BITS})))), ' ')"
    )


def _ranges(docs: DataFrame) -> Column:
    """The range of a row, in the order of rows: by doc_id, or below zero by the text's hash for rows without one."""
    quantiles = F.percentile_approx("doc_id", [i / QUANTILES for i in range(QUANTILES + 1)], 1000).alias("q")
    counts = [F.count("*").alias("rows"), F.count("doc_id").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")]
    row = docs.agg(*counts, quantiles).first()
    parts = max(1, min(RANGES, (row["rows"] - row["n"]) // PER_RANGE))
    by_hash = F.floor((F.col("hash").cast("double") / 2.0**64 + 0.5) * parts)
    without = F.least(F.greatest(by_hash, F.lit(0).cast("long")), F.lit(parts - 1).cast("long")) - parts
    if not row["n"]:
        return without
    bounds = sorted({row["low"], *row["q"], row["high"]})
    each = max(1, min(RANGES, row["n"] // PER_RANGE) // QUANTILES)
    array = F.array(*[F.lit(b).cast("long") for b in bounds])
    step = F.size(F.filter(array, lambda b: b <= F.col("doc_id"))) - 1
    low, high = F.get(array, step), F.coalesce(F.get(array, step + 1), F.lit(bounds[-1] + 1).cast("long"))
    share = (F.col("doc_id").cast("double") - low.cast("double")) / (high.cast("double") - low.cast("double"))
    inside = F.least(F.floor(share * each), F.lit(each - 1).cast("long"))
    return F.when(F.col("doc_id").isNull(), without).otherwise(step * F.lit(each).cast("long") + inside)


def edited(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 2) characters replaced by the first as
    many (or all) of the next document's; after the last document comes the first.
    """
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    given = given.withColumn("hash", F.xxhash64("text"))
    placed = given.withColumn("range", _ranges(given))
    # one row per range, 2 * RANGES at most
    firsts = placed.groupBy("range").agg(F.min(F.struct("doc_id", "hash")).alias("first"))
    order = Window.orderBy("range")
    wrapped = F.max("range").over(Window.partitionBy())
    firsts = firsts.select(F.col("range").alias("_range"), F.col("first").alias("_first"), F.coalesce(F.lag("range").over(order), wrapped).alias("_before"))
    is_first = F.col("doc_id").eqNullSafe(F.col("_first.doc_id")) & (F.col("hash") == F.col("_first.hash"))
    both = placed.join(F.broadcast(firsts), (F.col("range") == F.col("_range")) & is_first, "left")
    # lists of a row's own range and, for the first of a range, the one before, which it closes
    homes = F.expr(
        "if(_range is null, array(named_struct('home', range, 'closes', false)), "
        "array(named_struct('home', range, 'closes', false), named_struct('home', _before, 'closes', true)))"
    )
    printed = with_fingerprint(both, "text", "own").withColumn("n_chars", F.length("text").cast("long"))
    copied = printed.select("doc_id", "text", "hash", "n_chars", "own", F.explode(homes).alias("h")).select("*", "h.home", "h.closes")
    along = Window.partitionBy("home").orderBy("closes", F.asc_nulls_first("doc_id"), "hash")
    following = copied.select(
        "doc_id",
        "text",
        "n_chars",
        "own",
        "closes",
        F.lead("text").over(along).alias("next_text"),
        F.lead("own").over(along).alias("next_own"),
    ).filter("not closes")
    changed = following.withColumn("half", F.expr("cast(floor(n_chars / 2) as int)")).withColumn(
        "edited", F.expr("concat(substring(text, 1, cast(n_chars as int) - half), substring(next_text, 1, half))")
    )
    done = with_fingerprint(changed.select("doc_id", "n_chars", "own", "next_own", "edited"), "edited", "other")
    return done.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written("own.kept").alias("fingerprint"),
        written("other.kept").alias("edited_fingerprint"),
        likeness("own", "other").alias("near_edited"),
        likeness("own", "next_own").alias("near_next"),
    )
