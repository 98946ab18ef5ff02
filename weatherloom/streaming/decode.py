"""From message text to typed rows, with defaults and a reject rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weatherloom import fixed_values as V

# fixed values: message fields by kind; an absent field takes the kind's default
WHOLE_NUMBERS = ("id", "light", "uv_level", "rain_raw", "wind_raw")
DECIMALS = ("temperature", "humidity", "pressure", "pm25")
TIMES = ("timestamp", "ingestion_timestamp")
TEXTS = {"sensor_id": V.UNKNOWN_SENSOR, "location": V.UNKNOWN_LOCATION, "batch_id": ""}
FLAG = "vibration"

FIELDS = (*V.SOURCE_COLUMNS, *V.LINEAGE_COLUMNS)
UNREADABLE = "_unreadable"


def _number(name: str) -> str:
    """The number in a text, else NULL. Fractions of whole numbers are cut off."""
    decimal = f"nullif(try_cast(_given.{name} AS double), double('NaN'))"
    if name in DECIMALS:
        return decimal
    return f"coalesce(try_cast(_given.{name} AS bigint), try_cast({decimal} AS bigint))"


def decoded(messages: DataFrame, value: str = "value") -> DataFrame:
    """Typed readings plus ``rejected`` and the original text.

    A message is rejected if it is no JSON object, if a numeric field is there
    without holding a number, or if a time field holds text that is no time. A
    field that is absent takes its default; an empty time is none.
    To tell an absent field from a null one the names in a message are listed,
    but only where some number is missing.
    """
    numeric = (*WHOLE_NUMBERS, *DECIMALS)
    texts = ", ".join(f"{c} string" for c in (*FIELDS, UNREADABLE))
    given = F.from_json(value, texts, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": UNREADABLE})
    read = messages.select(F.col(value).alias("message"), given.alias("_given"))

    numbers = read.selectExpr("message", "_given", *[f"{_number(c)} AS {c}" for c in numeric])
    some_missing = " OR ".join(f"{c} IS NULL" for c in numeric)
    named = numbers.selectExpr(
        "*",
        f"_given IS NULL OR _given.{UNREADABLE} IS NOT NULL AS _broken",
        f"CASE WHEN {some_missing} THEN json_object_keys(message) END AS _names",
    )
    wrong = [
        f"({c} IS NULL AND (_given.{c} IS NOT NULL OR array_contains(_names, '{c}')))" for c in numeric
    ]
    wrong += [f"(trim(coalesce(_given.{c}, '')) <> '' AND try_to_timestamp(_given.{c}) IS NULL)" for c in TIMES]
    columns = {
        **{c: f"coalesce({c}, 0)" for c in WHOLE_NUMBERS},
        **{c: f"coalesce({c}, 0D)" for c in DECIMALS},
        **{c: f"try_to_timestamp(_given.{c})" for c in TIMES},
        **{c: f"coalesce(_given.{c}, '{default}')" for c, default in TEXTS.items()},
        FLAG: f"coalesce(try_cast(_given.{FLAG} AS boolean), try_cast(_given.{FLAG} AS double) <> 0, false)",
    }
    return named.selectExpr(
        *[f"{columns[c]} AS {c}" for c in FIELDS],
        f"_broken OR coalesce({' OR '.join(wrong)}, true) AS rejected",
        "message",
    )


def accepted(rows: DataFrame) -> DataFrame:
    return rows.filter(~F.col("rejected")).select(*FIELDS)


def rejected(rows: DataFrame) -> DataFrame:
    return rows.filter("rejected").select("message")
