"""Parsing JSON text columns once, and reading their fields leniently.

Schemas name every scalar field a string, so that a field of the wrong type costs neither the document nor its
siblings; the functions here turn the text into what was meant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_json(df: DataFrame, body: str, schema: str, options: dict[str, str] | None = None) -> DataFrame:
    """Add the fields of a JSON text as columns; all are null where the text is no such object.

    The parse is the input of a generator, so filters on the new columns stay above it and no
    text is parsed twice, which a plain ``from_json`` column does not promise.
    """
    return df.select("*", F.inline(F.array(F.from_json(F.col(body), schema, options or {}))))


def whole_number(text: Column, default: Column) -> Column:
    """A number, or text that reads as one, without its fraction; ``default`` where there is none or it cannot be read."""
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"), default)


def truth(text: Column) -> Column:
    """True for true, in any case and also as text; everything else is false."""
    return F.coalesce(F.lower(text) == "true", F.lit(False))
