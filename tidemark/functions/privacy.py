"""Column rules that keep personal data out: scrubbing, key warnings, label and host filters."""

from __future__ import annotations

import math
import re
import string
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .values import dump_json, load_json

# What is redacted and the tokens left in its place.
EMAIL_PATTERN = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"
CARD_PATTERN = r"\b(?:\d[ \-]*?){13,19}\b"
EMAIL_TOKEN = "<email>"
CARD_TOKEN = "<card>"
SCRUB_DEPTH_MARKER = "<scrub:max-depth>"
SCRUB_MAX_DEPTH = 64

# Property names that suggest personal or secret data.
SENSITIVE_KEY_PATTERN = r"(?i)^(email|password|token|secret|card|phone)$|password|credit_?card"

# Words in a click target's description that keep it from being recorded.
PII_LABEL_WORDS = (
    "password",
    "passcode",
    "pin",
    "card number",
    "credit card",
    "cvv",
    "cvc",
    "ssn",
    "social security",
    "bank account",
    "routing number",
)


def scrub_pii(text: Column) -> Column:
    """Replace e-mail addresses, then runs of 13 to 19 digits.

    The first pattern needs an ``@``, so most rows skip it.
    """
    emails = F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, EMAIL_PATTERN, EMAIL_TOKEN)).otherwise(text)
    return F.regexp_replace(emails, CARD_PATTERN, CARD_TOKEN)


def scrub_pii_deep(
    col: Column,
    dtype: T.DataType,
    max_depth: int = SCRUB_MAX_DEPTH,
    marker: str = SCRUB_DEPTH_MARKER,
    depth: int = 0,
) -> Column:
    """Scrub every string of a typed value; keys, numbers and nulls stay as they are.

    The type is walked while the plan is built, so the result is plain expressions.
    Below ``max_depth`` every value becomes the marker, and null where its type cannot hold that.
    """
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        if depth > max_depth:
            return F.lit(marker)
        return scrub_pii(col)
    if depth > max_depth:
        return F.lit(None).cast(dtype)
    if isinstance(dtype, T.MapType):
        return F.transform_values(col, lambda _, v: scrub_pii_deep(v, dtype.valueType, max_depth, marker, depth + 1))
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda v: scrub_pii_deep(v, dtype.elementType, max_depth, marker, depth + 1))
    if isinstance(dtype, T.StructType):
        fields = [
            scrub_pii_deep(col[f.name], f.dataType, max_depth, marker, depth + 1).alias(f.name) for f in dtype.fields
        ]
        return F.when(col.isNotNull(), F.struct(*fields))
    return col


def scrub_pii_json(max_depth: int = SCRUB_MAX_DEPTH, marker: str = SCRUB_DEPTH_MARKER):
    """Arrow function for free JSON text, whose shape is known only per row.

    Never fails: a text that cannot be read as JSON is scrubbed as plain text.
    Numbers that JSON cannot hold become null.
    """
    # As on the JVM, word boundaries heed all letters and digits are ASCII.
    email, card = re.compile(EMAIL_PATTERN), re.compile(CARD_PATTERN.replace(r"\d", "[0-9]"))

    def plain(text):
        # Most texts lack what a pattern needs, and to look for single characters is far faster than to match at each.
        if "@" in text:
            text = email.sub(EMAIL_TOKEN, text)
        return card.sub(CARD_TOKEN, text) if any(d in text for d in string.digits) else text

    def walk(value, depth):
        if depth > max_depth:
            return marker
        if isinstance(value, str):
            return plain(value)
        if isinstance(value, float) and not math.isfinite(value):
            return None
        if isinstance(value, list):
            return [walk(v, depth + 1) for v in value]
        if isinstance(value, dict):
            return {k: walk(v, depth + 1) for k, v in value.items()}
        return value

    def one(text):
        if text is None:
            return None
        value, error = load_json(text)
        return plain(text) if error else dump_json(walk(value, 0))

    @F.pandas_udf(T.StringType())
    def scrub(texts: pd.Series) -> pd.Series:
        return texts.map(one)

    return scrub


def flag_sensitive_keys(keys: Column) -> Column:
    """The names in an array of property names that look personal or secret."""
    return F.filter(F.coalesce(keys, F.array().cast("array<string>")), lambda k: k.rlike(SENSITIVE_KEY_PATTERN))


def has_pii_label(description: Column, words: Sequence[str] = PII_LABEL_WORDS) -> Column:
    """True if the lower-cased description contains one of the words."""
    pattern = "|".join(re.escape(w) for w in words)
    return F.coalesce(F.lower(description).rlike(pattern), F.lit(False))


def is_opted_out(description: Column, marker: str) -> Column:
    return F.contains(F.coalesce(description, F.lit("")), F.lit(marker))


def is_self_error(messages: Column, host: str | None, hops: int = 8) -> Column:
    """True if one of the first ``hops`` messages of a cause chain names the ingest host."""
    if not host:
        return F.lit(False)
    named = F.exists(F.slice(messages, 1, hops), lambda m: F.contains(F.lower(m), F.lit(host.lower())))
    return F.coalesce(named, F.lit(False))
