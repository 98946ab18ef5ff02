"""The sigma chain by increments: each run reads the batches that are new, and a state of fixed size.

A run writes the distinct readings of its batches as one more part of silver. Identical rows
share their batch, so parts need not be compared. The state holds what
can be merged: count, mean and squared deviations of the temperature, from which
the bounds follow, and counts and sums of each measure. Sums are kept for the
*core*, readings well inside the bounds of the run that added them; the few other
readings are kept as rows, as later bounds may take them in or leave them
out. Should bounds ever move into the core, the parts are split again by one pass.

Silver is a view: parts, the newest bounds as a filter, the newest means where a
measure is missing. It equals the chain over all bronze at once, and no run writes an old
reading again. A part counts once the commit names it; a run that fails is
repeated into the same folder. One run at a time.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weatherloom import fixed_values as V
from weatherloom import schemas
from weatherloom.operators import duplicates
from weatherloom.sinks import commits, lake, storage
from weatherloom.sinks.lake import Lake

MEASURES = V.MEAN_IMPUTED_COLUMNS
BY = "temperature"
CORE_SIGMAS = 4
NOTHING = {"rows": 0, "low": None, "high": None, "n": {}, "s": {}}
BEGIN = {"seen": {}, "base": 0, "split": 0, "parts": 0, "rows_in": 0, "moments": [0, 0.0, 0.0], "core": NOTHING, "missing": NOTHING}


def log_of(store: Lake) -> str:
    return f"{store.root}/control/silver"


def state_of(spark: SparkSession, store: Lake) -> commits.Commit:
    return commits.newest_of(spark, log_of(store), "silver")


def _part(store: Lake, kind: str, number: int, part: int) -> str:
    return f"{store.root}/silver/{kind}/set={number}/part={part}"


def _merged_moments(one: list, other: list) -> list:
    """Count, mean and squared deviations of two sets of values together."""
    n = one[0] + other[0]
    if not n:
        return [0, 0.0, 0.0]
    gap = other[1] - one[1]
    return [n, one[1] + gap * other[0] / n, one[2] + other[2] + gap * gap * one[0] * other[0] / n]


def _merged_sums(one: dict, other: dict) -> dict:
    """Rows, extremes, counts and sums of two sets of readings together."""
    names = {*one["n"], *other["n"]}

    def pick(f, key):  # noqa: ANN001, ANN202
        known = [x[key] for x in (one, other) if x[key] is not None]
        return f(known) if known else None

    return {
        "rows": one["rows"] + other["rows"],
        "low": pick(min, "low"),
        "high": pick(max, "high"),
        "n": {c: one["n"].get(c, 0) + other["n"].get(c, 0) for c in names},
        "s": {c: one["s"].get(c, 0.0) + other["s"].get(c, 0.0) for c in names},
    }


def bounds_of(moments: list, sigmas: float = V.OUTLIER_SIGMAS) -> tuple[float, float] | None:
    """The same bounds as :func:`filters.sigma_bounds`, from merged moments; None where there is no spread."""
    n, mean, squares = moments
    spread = math.sqrt(squares / (n - 1)) if n > 1 else 0.0
    return (mean - sigmas * spread, mean + sigmas * spread) if spread > 0 else None


def _inside(bounds: tuple[float, float] | None) -> Column:
    return F.col(BY).isNotNull() if bounds is None else F.col(BY).between(*bounds)


def _measures(df: DataFrame) -> list[str]:
    return [c for c in MEASURES if c in df.columns]


def _sums(df: DataFrame, **groups: Column) -> dict[str, dict]:
    """Rows, extremes, counts and sums of the readings of each group, from one pass."""
    columns = _measures(df)
    aggregates = []
    for name, chosen in groups.items():
        aggregates += [F.count_if(chosen).alias(f"{name}_rows"), F.min(F.when(chosen, F.col(BY))).alias(f"{name}_low"), F.max(F.when(chosen, F.col(BY))).alias(f"{name}_high")]
        for c in columns:
            value = F.when(chosen, F.col(c).cast("double"))
            aggregates += [F.count(value).alias(f"{name}_n_{c}"), F.sum(value).alias(f"{name}_s_{c}")]
    row = df.agg(*aggregates).first()
    return {
        name: {
            "rows": row[f"{name}_rows"],
            "low": row[f"{name}_low"],
            "high": row[f"{name}_high"],
            "n": {c: row[f"{name}_n_{c}"] for c in columns},
            "s": {c: row[f"{name}_s_{c}"] or 0.0 for c in columns},
        }
        for name in groups
    }


def _split(rows: DataFrame, state: dict, path: str) -> dict:
    """Add readings to the core and to the missing; those outside the core are written to ``path``."""
    band = bounds_of(state["moments"], CORE_SIGMAS)
    core = F.coalesce(_inside(band), F.lit(False))
    sums = _sums(rows, core=core, missing=F.col(BY).isNull())
    rows.filter(F.col(BY).isNotNull() & ~core).select(*_measures(rows)).write.mode("overwrite").parquet(path)
    return {k: _merged_sums(state[k], sums[k]) for k in ("core", "missing")}


def _read(spark: SparkSession, state: dict, paths: list[str], columns=None) -> DataFrame:  # noqa: ANN001
    schema = StructType.fromJson(state["schema"])
    return spark.read.schema(schema if columns is None else StructType([f for f in schema.fields if f.name in columns])).parquet(*paths)


def _parts(store: Lake, state: dict) -> list[str]:
    return [_part(store, "parts", state["base"], i + 1) for i in range(state["parts"])]


def _outside(spark: SparkSession, store: Lake, state: dict) -> DataFrame:
    return _read(spark, state, [_part(store, "extremes", state["split"], i + 1) for i in range(state["parts"])], MEASURES)


def clean(spark: SparkSession, store: Lake) -> dict:
    """Take in the batches that are new since the last run; the new state.

    A first load of any source begins silver anew, as it replaces that source's readings.
    """
    before = state_of(spark, store)
    state = before.state or BEGIN
    batches, seen, anew = lake.batches_after(spark, store, state["seen"])
    if anew:
        state = {**BEGIN, "base": state["base"] + 1, "split": state["split"] + 1}
    if batches is None:
        if anew:
            commits.commit(spark, log_of(store), before, state)
        return state
    rows = batches.transform(schemas.with_sensor_id).transform(schemas.nan_to_null)
    part = _part(store, "parts", state["base"], state["parts"] + 1)
    duplicates.exact(rows).write.mode("overwrite").parquet(part)
    columns = schemas.union_of(StructType.fromJson(state["schema"]) if "schema" in state else StructType(), rows.schema)
    state = {**state, "seen": seen, "schema": columns.jsonValue()}
    added = _read(spark, state, [part])
    t = F.col(BY).cast("double")
    # counts of rows come from the files' footers
    n, mean, variance = added.agg(F.count(t), F.coalesce(F.avg(t), F.lit(0.0)), F.coalesce(F.var_pop(t), F.lit(0.0))).first()
    state["moments"] = _merged_moments(state["moments"], [n, mean, variance * n])
    state["rows_in"] += batches.count()
    state.update(_split(added, state, _part(store, "extremes", state["split"], state["parts"] + 1)))
    state["parts"] += 1

    bounds = bounds_of(state["moments"])
    if bounds and state["core"]["rows"] and (state["core"]["low"] < bounds[0] or state["core"]["high"] > bounds[1]):
        state = _split_again(spark, store, state)
    kept = state["core"]
    outside = _outside(spark, store, state)
    if bounds:
        kept = _merged_sums(kept, _sums(outside.filter(_inside(bounds)), all=F.lit(True))["all"])
    else:
        kept = _merged_sums(_merged_sums(kept, state["missing"]), _sums(outside, all=F.lit(True))["all"])
    state["bounds"] = list(bounds) if bounds else None
    state["means"] = {c: kept["s"][c] / n if n else None for c, n in kept["n"].items()}
    state["rows_out"] = kept["rows"]
    state["rows_distinct"] = state["core"]["rows"] + state["missing"]["rows"] + outside.count()
    return commits.commit(spark, log_of(store), before, state).state


def _split_again(spark: SparkSession, store: Lake, state: dict) -> dict:
    """Bounds have moved into the core: one pass over the measures of all parts."""
    state = {**state, "split": state["split"] + 1, "core": NOTHING, "missing": NOTHING}
    for i in range(1, state["parts"]):
        spark.range(0).select(*[F.lit(None).cast("double").alias(c) for c in MEASURES]).write.mode("overwrite").parquet(_part(store, "extremes", state["split"], i))
    every = _read(spark, state, _parts(store, state), MEASURES)
    return {**state, **_split(every, state, _part(store, "extremes", state["split"], state["parts"]))}


def silver(spark: SparkSession, store: Lake) -> DataFrame | None:
    """The cleaned readings; None where nothing was cleaned by increments."""
    state = state_of(spark, store).state
    if not state.get("parts"):
        return None
    rows = _read(spark, state, _parts(store, state))
    if state["bounds"]:
        rows = rows.filter(_inside(tuple(state["bounds"])))
    means = {c: F.coalesce(F.col(c).cast("double"), F.lit(state["means"].get(c)).cast("double")) for c in _measures(rows)}
    return rows.withColumns(means)


def release(spark: SparkSession, store: Lake) -> list[str]:
    """Remove parts and extremes that the newest state does not name. For a time when no run is on; safe to repeat."""
    state = state_of(spark, store).state or BEGIN
    current = {"parts": state["base"], "extremes": state["split"]}
    gone = []
    for kind, number in current.items():
        gone += storage.remove_partitions(spark, f"{store.root}/silver/{kind}", "set", lambda n, own=number: int(n) != own)
    return gone
