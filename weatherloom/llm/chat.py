"""Conversations as training text, in windows of a token budget.

A turn is written ``<|im_start|>role\\ntext<|im_end|>\\n``. In texts and roles a
control string is broken by a backslash: ``<`` and any backslashes before ``|``
get one more, which reading takes off again, so that any text comes back as it
was. A role's backslashes and newlines are escaped too.

Prefix sums of the turns' tokens choose turn-aligned spans: the line of tokens is
cut every ``span`` tokens, turns inside one cell form a window, and a turn that lies
across a cut has a window of its own. A window is therefore within the span
unless it is a single longer turn. Ahead of its own turns a window repeats the
conversation's system turn (its first turn, if that is one) and the last turns
before it, at most ``history`` and only while they fit in the rest of the budget;
repeated turns are masked. The loss mask covers the texts of a window's own
assistant turns, so each counts once.

Prefix sums are taken in two steps, inside blocks of ``BLOCK`` turns and over the
blocks' sums, and only numbers meet there: a conversation of any length is never
gathered as text in one place until it is read back and hashed, which a task
does turn by turn. Rows are ordered by turn, then role, then text; null text
and role are empty, a null turn comes first, and rows without a conv_id form
one conversation. Repeated rows are turns like others.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from weatherloom.session import cut_lineage

START, END = "<|im_start|>", "<|im_end|>"
SPAN, BUDGET, HISTORY, BLOCK = 1024, 2048, 2, 256


def escaped(text: str | Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def escaped_role(role: str | Column) -> Column:
    doubled = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return F.replace(doubled, F.lit("<"), F.lit("\\l"))


def unescaped(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def unescaped_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"n": "\n", "l": "<"}.get(m[1], m[1]), role)


def tokens_of(text: Column) -> Column:
    """Tokens of a turn, estimated: a quarter of its bytes, rounded up, and five for the marks. No tokenizer is asked."""
    return F.ceil(F.octet_length(text) / 4) + 5


def windows(
    conversations: DataFrame, span: int = SPAN, budget: int = BUDGET, history: int = HISTORY, role: str = "assistant"
) -> DataFrame:
    """One row per window: conv_id, window, n_repeated, n_turns (its own), n_tokens, formatted, loss (array of start, end).

    ``loss`` counts code points of ``formatted`` from 0, end exclusive.
    """
    if budget < span or history < 0:
        raise ValueError("a budget holds at least a span, and history is no less than none")
    rows = conversations.select(
        F.col("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    written = cut_lineage(rows.withColumns({"body": escaped("text"), "head": escaped_role("role")}).withColumn("tokens", tokens_of(F.col("body"))))

    # the place of a turn and the tokens before it: inside a block, and of the blocks before
    block = F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62)))
    order = [F.asc_nulls_first("turn"), "role", F.xxhash64("text"), "text"]
    inside = Window.partitionBy("conv_id", "block").orderBy(*order)
    placed = written.withColumn("block", block).withColumn("inside", F.row_number().over(inside) - 1)
    placed = placed.withColumn("before", F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    sums = placed.groupBy("conv_id", "block").agg(F.count("*").alias("turns"), F.sum("tokens").alias("sum"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("conv_id").alias("_conv"),
        F.col("block").alias("_block"),
        F.coalesce(F.sum("turns").over(earlier), F.lit(0)).alias("turns_before"),
        F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("sum_before"),
    )
    placed = placed.join(sums, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block")))
    start = F.col("sum_before") + F.coalesce("before", F.lit(0))
    own = placed.select(
        "conv_id",
        (F.col("turns_before") + F.col("inside")).alias("place"),
        "role",
        "head",
        "body",
        "tokens",
        start.alias("first"),
        (start + F.col("tokens")).alias("last"),
    )
    cell, end_cell = F.floor(F.col("first") / span), F.floor((F.col("last") - 1) / span)
    own = cut_lineage(own.withColumn("window", 2 * cell + F.when(cell == end_cell, 0).otherwise(1)))

    turn = F.struct("place", F.lit(False).alias("repeated"), "role", "head", "body", "tokens")
    spans = own.groupBy("conv_id", "window").agg(
        F.min("place").alias("from"), F.sum("tokens").alias("own_tokens"), F.collect_list(turn).alias("turns")
    )
    numbered = spans.select("conv_id", "window", "from", "own_tokens")
    # earlier turns by their place, and the system turn; each at most once a window
    wanted = numbered.select(
        "conv_id",
        "window",
        "from",
        "own_tokens",
        F.expr(f"explode(array_distinct(concat(array(0L), transform(sequence(0, {history}), i -> `from` - i))))").alias("place"),
    ).filter("place >= 0 and place < from")
    again = wanted.alias("w").join(
        own.alias("o"), F.expr("w.conv_id <=> o.conv_id and w.place = o.place"), "inner"
    ).select("w.conv_id", "w.window", "w.from", "w.own_tokens", "o.place", "o.role", "o.head", "o.body", "o.tokens")
    again = again.filter(f"role = 'system' and place = 0 or place >= `from` - {history}")
    nearest = Window.partitionBy("conv_id", "window").orderBy(F.desc(F.expr("role = 'system' and place = 0")), F.desc("place"))
    again = again.withColumn("spent", F.sum("tokens").over(nearest)).filter(f"own_tokens + spent <= {budget}")
    context = again.groupBy("conv_id", "window").agg(
        F.collect_list(F.struct("place", F.lit(True).alias("repeated"), "role", "head", "body", "tokens")).alias("context")
    )
    context = context.select(F.col("conv_id").alias("_conv"), F.col("window").alias("_window"), "context")
    both = spans.join(context, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("window") == F.col("_window")), "left")
    turns = F.concat(F.sort_array(F.coalesce("context", F.slice("turns", 1, 0))), F.sort_array("turns"))
    both = both.select("conv_id", "window", turns.alias("turns"))

    kept = f"not x.repeated and x.role = '{role}'"
    opened = f"s.length + {len(START) + 1} + length(x.head)"
    total = f"{opened} + length(x.body) + {len(END) + 1}"
    lengths = f"""aggregate(turns, named_struct('length', 0, 'loss', cast(array() as array<struct<start:int,end:int>>)),
        (s, x) -> named_struct('length', {total}, 'loss',
            if({kept}, concat(s.loss, array(named_struct('start', {opened}, 'end', {opened} + length(x.body)))), s.loss)))"""
    return both.select(
        "conv_id",
        "window",
        F.expr("size(filter(turns, x -> x.repeated))").alias("n_repeated"),
        F.expr("size(filter(turns, x -> not x.repeated))").alias("n_turns"),
        F.expr("aggregate(turns, 0L, (s, x) -> s + x.tokens)").alias("n_tokens"),
        F.expr(f"array_join(transform(turns, x -> concat('{START}', x.head, '\\n', x.body, '{END}\\n')), '')").alias("formatted"),
        F.expr(f"{lengths}.loss").alias("loss"),
    )


_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.DOTALL)


def turns_in(formatted: str) -> list[tuple[str, str]]:
    """Role and text of every turn, as they were before formatting."""
    return [(unescaped_role(role), unescaped(text)) for role, text in _TURN.findall(formatted)]


def read_back(made: DataFrame) -> DataFrame:
    """Per conversation, from the windows alone: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_windows.

    Windows of a conversation are read in order, one at a time.
    """
    kind = made.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long"

    target = to_arrow_schema(made.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: list | None = None

        def closed(s: list) -> dict:
            return dict(zip(target.names, (s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5], s[6]), strict=True))

        done: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if current is None or current[0] != row["conv_id"]:
                    if current is not None:
                        done.append(closed(current))
                    current = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                text = row["formatted"]
                for role, said in turns_in(text)[row["n_repeated"] :]:
                    current[1] += 1
                    current[2].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                for part in row["loss"]:
                    said = unescaped(text[part["start"] : part["end"]])
                    current[3] += len(said)
                    current[4].update(said.encode("utf-8", "surrogatepass"))
                current[5] += len(text)
                current[6] += 1
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=target)
                done = []
        if current is not None:
            yield pa.RecordBatch.from_pylist([closed(current)], schema=target)

    ordered = made.select("conv_id", "window", "n_repeated", "formatted", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return ordered.mapInArrow(run, schema)
