"""Column rules over property values and the small text rules around them."""

from __future__ import annotations

import json
import math
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Limits and the texts left where they are exceeded. Lengths are in code points.
MAX_STRING_LENGTH = 1024
MAX_DEPTH = 32
ELLIPSIS = "…"
DEPTH_TEXT = "[depth-exceeded]"
TEXT_CAP = 128

# Warning kinds a table can produce.
DEPTH_EXCEEDED = "depth_exceeded"
TRUNCATED_STRING = "truncated_string"
NON_SERIALISABLE = "non_serialisable"
NOT_FINITE = "not_finite"

WARNINGS = T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("kind", T.StringType())]))

_TEXT = (T.StringType, T.VarcharType, T.CharType)
_PLAIN = (T.BooleanType, T.IntegralType)
_REAL = (T.DoubleType, T.FloatType)
_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def strip(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def truncate_string(text: Column) -> Column:
    kept = F.concat(F.substring(text, 1, MAX_STRING_LENGTH - 1), F.lit(ELLIPSIS))
    return F.when(F.length(text) > MAX_STRING_LENGTH, kept).otherwise(text)


def _not_finite(col: Column) -> Column:
    return F.isnan(col) | (F.abs(col) == float("inf"))


def sanitize(col: Column, dtype: T.DataType, depth: int = 0) -> Column:
    """Sanitise a typed value; the type is walked while the plan is built.

    Long strings are cut, non-finite numbers become null, times become ISO text. Null entries
    leave maps and stay in arrays; values of other types become null.
    """
    if depth > MAX_DEPTH:
        return F.lit(DEPTH_TEXT)
    if isinstance(dtype, _TEXT):
        return truncate_string(col)
    if isinstance(dtype, _PLAIN):
        return col
    if isinstance(dtype, _REAL):
        return F.when(~_not_finite(col), col)
    if isinstance(dtype, _TIMES):
        return F.date_format(col.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    if isinstance(dtype, T.MapType):
        cleaned = F.transform_values(col, lambda _, v: sanitize(v, dtype.valueType, depth + 1))
        named = cleaned if isinstance(dtype.keyType, _TEXT) else F.transform_keys(cleaned, lambda k, _: k.cast("string"))
        return F.map_filter(named, lambda _, v: v.isNotNull())
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda v: sanitize(v, dtype.elementType, depth + 1))
    if isinstance(dtype, T.StructType):
        fields = [sanitize(col[f.name], f.dataType, depth + 1).alias(f.name) for f in dtype.fields]
        return F.when(col.isNotNull(), F.struct(*fields))
    return F.lit(None).cast("string")


def property_warnings(col: Column, dtype: T.DataType, key: Column | str = "<root>", depth: int = 0) -> Column:
    """Array of (key, kind) for what ``sanitize`` changes; list elements are ``key[i]``."""
    key = F.lit(key) if isinstance(key, str) else key
    none = F.array().cast(WARNINGS)

    def warn(when: Column, kind: str) -> Column:
        return F.when(when, F.array(F.struct(key.alias("key"), F.lit(kind).alias("kind")))).otherwise(none)

    if depth > MAX_DEPTH:
        return warn(F.lit(True), DEPTH_EXCEEDED)
    if isinstance(dtype, _TEXT):
        return warn(F.length(col) > MAX_STRING_LENGTH, TRUNCATED_STRING)
    if isinstance(dtype, _REAL):
        return warn(_not_finite(col), NOT_FINITE)
    if isinstance(dtype, (*_PLAIN, *_TIMES)):
        return none
    if isinstance(dtype, T.MapType):
        per_entry = F.transform(
            F.map_entries(col),
            lambda e: property_warnings(e["value"], dtype.valueType, e["key"].cast("string"), depth + 1),
        )
        return F.coalesce(F.flatten(per_entry), none)
    if isinstance(dtype, T.ArrayType):
        per_item = F.transform(
            col,
            lambda v, i: property_warnings(
                v, dtype.elementType, F.concat(key, F.lit("["), i.cast("string"), F.lit("]")), depth + 1
            ),
        )
        return F.coalesce(F.flatten(per_item), none)
    if isinstance(dtype, T.StructType):
        parts = [property_warnings(col[f.name], f.dataType, f.name, depth + 1) for f in dtype.fields]
        return F.concat(*parts) if parts else none
    return warn(col.isNotNull(), NON_SERIALISABLE)


# Why free JSON could not be read; null where it was.
INVALID_JSON = "invalid_json"
TOO_DEEP = "too_deep"
NOT_AN_OBJECT = "not_an_object"

SANITIZED_JSON = T.StructType(
    [T.StructField("properties", T.StringType()), T.StructField("warnings", WARNINGS), T.StructField("error", T.StringType())]
)
_LONE_SURROGATE = re.compile("[\ud800-\udfff]")


def load_json(text: str) -> tuple[object, str | None]:
    """The value of a JSON text, and why it has none."""
    try:
        return json.loads(text), None
    except RecursionError:
        return None, TOO_DEEP
    except ValueError:
        return None, INVALID_JSON


def dump_json(value: object) -> str:
    """JSON text that can be encoded: half of a surrogate pair becomes the replacement character."""
    return _LONE_SURROGATE.sub("\ufffd", json.dumps(value, ensure_ascii=False))


def _clean_json(value, key, depth, warnings):
    if depth > MAX_DEPTH:
        warnings.append((key, DEPTH_EXCEEDED))
        return DEPTH_TEXT
    if isinstance(value, str) and len(value) > MAX_STRING_LENGTH:
        warnings.append((key, TRUNCATED_STRING))
        return value[: MAX_STRING_LENGTH - 1] + ELLIPSIS
    if isinstance(value, float) and not math.isfinite(value):
        warnings.append((key, NOT_FINITE))
        return None
    if isinstance(value, dict):
        cleaned = {k: _clean_json(v, k, depth + 1, warnings) for k, v in value.items()}
        return {k: v for k, v in cleaned.items() if v is not None}
    if isinstance(value, list):
        return [_clean_json(v, f"{key}[{i}]", depth + 1, warnings) for i, v in enumerate(value)]
    return value


@F.pandas_udf(SANITIZED_JSON)
def sanitize_json(texts: pd.Series) -> pd.DataFrame:
    """Sanitise free JSON objects, whose shape is known only per row (Arrow batches).

    Never fails: a text that is no JSON object gives an empty object and the ``error`` that
    says why, so that the row can go to the reject sink with its text. No text is an empty object.
    """
    rows = []
    for text in texts:
        found: list[tuple[str, str]] = []
        value, error = load_json(text) if text else ({}, None)
        if error is None and not isinstance(value, dict):
            error = NOT_AN_OBJECT
        bag = {} if error else _clean_json(value, "<root>", 0, found)
        warnings = [{"key": _LONE_SURROGATE.sub("\ufffd", k), "kind": w} for k, w in found]
        rows.append((dump_json(bag), warnings, error))
    return pd.DataFrame(rows, columns=["properties", "warnings", "error"])


def wire_traits(bag: Column, dtype: T.MapType) -> Column:
    """Sanitised bag as strings, nulls dropped; an empty bag is null."""
    cleaned = F.transform_values(sanitize(bag, dtype), lambda _, v: v.cast("string"))
    kept = F.map_filter(cleaned, lambda _, v: v.isNotNull())
    return F.when(F.size(kept) > 0, kept)


def cap_text(text: Column, n: int = TEXT_CAP) -> Column:
    return F.substring(text, 1, n)


def device_payload(**fields: Column) -> Column:
    """Device fields as a string map; absent ones are left out."""
    pairs = [x for name, col in fields.items() for x in (F.lit(name), col.cast("string"))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())


def first_non_empty(*candidates: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates])


def resolve_label(
    label: Column, text: Column, title: Column, aria: Column, accessibility: Column, description: Column
) -> Column:
    """A click's label: the first that is not empty, in this order."""
    return first_non_empty(label, text, title, aria, accessibility, description)


def page_key(url: Column, path: Column, screen: Column) -> Column:
    """What identifies a page: url, else path, else screen."""
    return F.coalesce(url, path, screen)
