"""Free JSON as a table of its paths, in expressions only.

A text becomes a variant and is opened level by level, all nodes of a level at once, down to a depth limit. No
Python worker, no job and no shuffle takes part, and the work of a row is that of its own text. Each node is
(path, name, key, depth, kind, value): ``path`` is a JSON pointer, ``name`` the name within an object (null for
list elements), ``key`` what warnings call it (``tags[1]``), ``kind`` one of the KINDS, ``value`` the text of a string,
number or truth value. Nodes come by depth; those one level below the limit are DEEP, whatever they are, and end there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .privacy import SCRUB_DEPTH_MARKER, SENSITIVE_KEY_PATTERN, scrub_pii
from .values import (
    DEPTH_EXCEEDED,
    INVALID_JSON,
    MAX_DEPTH,
    MAX_STRING_LENGTH,
    NOT_AN_OBJECT,
    NOT_FINITE,
    TOO_DEEP,
    TRUNCATED_STRING,
    WARNINGS,
)

OBJECT, LIST, STRING, NUMBER, TRUTH, NULL, DEEP = "object", "list", "string", "number", "truth", "null", "deep"
#: A number that JSON has no form for (NaN, Infinity).
NO_NUMBER = "no_number"
KINDS = (OBJECT, LIST, STRING, NUMBER, TRUTH, NULL, NO_NUMBER, DEEP)

#: So many levels the JVM's JSON reader opens, counting the list that a text is wrapped in.
READER_DEPTH = 1000
#: So much of a text is looked at first for its depth, and so many brackets are counted together.
HEAD = 4_096
MARKS_OF_BLOCK = 1_000

_NODE = "struct<path: string, name: string, key: string, depth: int, kind: string, value: string>"
_OPEN = "struct<path: string, key: string, v: variant>"
# An escaped half of a surrogate pair without its other half. An even number of backslashes before it is text.
_HALF = (
    r"(?<!\\)((?:\\\\)*+)\\u(?:[dD][89abAB][0-9a-fA-F]{2}(?!\\u[dD][c-fC-F][0-9a-fA-F]{2})"
    r"|(?<!\\u[dD][89abAB][0-9a-fA-F]{2}\\u)[dD][c-fC-F][0-9a-fA-F]{2})"
)


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once: within lambdas nothing that repeats is shared."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _whole(text: Column) -> Column:
    """The variant of a JSON text; null unless the whole text is one JSON value.

    The reader ignores what follows a value, so the text is read as the first of two elements, the second its hash.
    """
    halves = F.when(text.rlike(r"\\u[dD][89a-fA-F]"), F.regexp_replace(text, _HALF, r"$1\\ufffd")).otherwise(text)
    framed = F.concat(F.lit("["), halves, F.lit(","), F.xxhash64(text).cast("string"), F.lit("]"))
    both = F.from_json(framed, "array<variant>", {"allowSingleQuotes": "false"})

    def first(parts: Column) -> Column:
        whole = (F.size(parts) == 2) & (F.try_variant_get(F.get(parts, F.lit(1)), "$", "bigint") == F.xxhash64(text))
        return F.when(whole, F.get(parts, F.lit(0)))

    return _bound(both, first)


def _described(path: Column, name: Column, key: Column, depth: Column, v: Column, deep: Column) -> Column:
    """The node of a value."""
    # The type of an object or list is that of all below it, so it is asked only of plain values.
    plain = F.schema_of_variant(v)
    kind = (
        F.when(deep, DEEP)
        .when(v.try_cast("map<string,variant>").isNotNull(), OBJECT)
        .when(v.try_cast("array<variant>").isNotNull(), LIST)
        .when(F.is_variant_null(v), NULL)
        .otherwise(
            F.when(plain == "STRING", STRING)
            .when(plain == "BOOLEAN", TRUTH)
            .when(plain.isin("DOUBLE", "FLOAT") & v.try_cast("string").isin("NaN", "Infinity", "-Infinity"), NO_NUMBER)
            .otherwise(NUMBER)
        )
    )

    def node(kind: Column) -> Column:
        value = F.when(kind.isin(STRING, NUMBER, TRUTH), v.try_cast("string"))
        return F.struct(path.alias("path"), name.alias("name"), key.alias("key"), depth.alias("depth"), kind.alias("kind"), value.alias("value"))

    return _bound(kind, node)


def _children(x: Column) -> Column:
    """The values in an object or list as (path, name, key, v); none in a plain value."""
    part = F.when(x["v"].isNotNull(), x["v"].try_cast("map<string,variant>"))
    names = F.transform(
        F.map_entries(part),
        lambda e: F.struct(
            F.concat(x["path"], F.lit("/"), F.replace(F.replace(e["key"], F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))).alias("path"),
            e["key"].alias("name"),
            e["key"].alias("key"),
            e["value"].alias("v"),
        ),
    )
    items = F.transform(
        x["v"].try_cast("array<variant>"),
        lambda v, i: F.struct(
            F.concat(x["path"], F.lit("/"), i.cast("string")).alias("path"),
            F.lit(None).cast("string").alias("name"),
            F.concat(x["key"], F.lit("["), i.cast("string"), F.lit("]")).alias("key"),
            v.alias("v"),
        ),
    )
    none = F.array().cast("array<struct<path: string, name: string, key: string, v: variant>>")
    return F.coalesce(names, items, none)


def json_nodes(text: Column, max_depth: int = MAX_DEPTH, root: str = "<root>") -> Column:
    """All nodes of a JSON text, by depth; null where it is null or not JSON.

    Of names that repeat within an object the last counts (``spark.sql.variant.allowDuplicateKeys``, set by
    ``session.configure``); objects come in order of their names. Whole numbers beyond 64 bits are doubles.
    """
    none = F.array().cast(f"array<{_OPEN}>")

    def level(state: Column, depth: Column) -> Column:
        below = F.flatten(F.transform(state["open"], _children))

        def step(found: Column) -> Column:
            nodes = F.transform(found, lambda c: _described(c["path"], c["name"], c["key"], depth, c["v"], depth > max_depth))
            opened = F.transform(found, lambda c: F.struct(c["path"].alias("path"), c["key"].alias("key"), c["v"].alias("v")))
            return F.struct(F.concat(state["nodes"], nodes).alias("nodes"), opened.alias("open"))

        more = _bound(below, step)
        return F.when(F.size(state["open"]) > 0, more).otherwise(state)

    def walk(v: Column) -> Column:
        at = F.lit("")
        first = _described(at, F.lit(None).cast("string"), F.lit(root), F.lit(0), v, F.lit(False))
        start = F.struct(
            F.array(first).cast(f"array<{_NODE}>").alias("nodes"),
            F.array(F.struct(at.alias("path"), F.lit(root).alias("key"), v.alias("v"))).cast(f"array<{_OPEN}>").alias("open"),
        )
        done = F.aggregate(F.sequence(F.lit(1), F.lit(max_depth + 1)), start, level, lambda s: s["nodes"])
        return F.when(v.isNotNull(), done)

    return _bound(_whole(text), walk)


def with_json_nodes(df: DataFrame, text: str, name: str = "nodes", max_depth: int = MAX_DEPTH) -> DataFrame:
    """Add ``json_nodes`` of a text column; as a generator's input it is computed once, however often it is used."""
    return df.select("*", F.explode(F.array(json_nodes(F.col(text), max_depth))).alias(name))


def _opened(text: Column) -> Column:
    """The number of opening brackets."""
    return F.length(text) - F.length(F.replace(F.replace(text, F.lit("[")), F.lit("{")))


def _reaches_limit(text: Column) -> Column:
    """Whether READER_DEPTH brackets are open at once in a text without strings.

    The marks are counted a block at a time; one by one only in a block that could get there, and in none after it.
    """
    marks = F.regexp_replace(text, r"[^\[\]{}]++", "")
    blocks = F.regexp_extract_all(marks, F.lit(f".{{1,{MARKS_OF_BLOCK}}}"), F.lit(0))

    def state(now: Column, deep: Column) -> Column:
        return F.struct(now.alias("now"), deep.alias("deep"))

    def mark(s: Column, m: Column) -> Column:
        now = s["now"] + F.when(m.isin("[", "{"), 1).when(m == "", 0).otherwise(-1)
        return state(now, s["deep"] | (now >= READER_DEPTH))

    def block(s: Column, part: Column) -> Column:
        opened = _opened(part)
        within = F.aggregate(F.split(part, ""), state(s["now"], F.lit(False)), mark)
        passed = state(s["now"] + 2 * opened - F.length(part), F.lit(False))
        return F.when(s["deep"], s).when(s["now"] + opened >= READER_DEPTH, within).otherwise(passed)

    return F.aggregate(blocks, state(F.lit(0), F.lit(False)), block, lambda s: s["deep"])


def _too_deep(text: Column) -> Column:
    """Whether more levels are open somewhere than the reader opens; brackets in strings do not count."""
    strings = r'"(?:[^"\\]|\\.)*+"'
    # A string that ends in the head is one of the whole text; from the first other quote on the head does not tell.
    head = F.substring_index(F.regexp_replace(F.substring(text, 1, HEAD), strings, ""), '"', 1)
    few = _opened(text) < READER_DEPTH
    return F.when(_reaches_limit(head), True).when(few, False).otherwise(_reaches_limit(F.regexp_replace(text, strings, "")))


def json_error(text: Column, nodes: Column) -> Column:
    """Why a text is no property bag: not JSON, nested too deeply to be read, no object; null if it is one, or no text."""
    unread = F.when(_too_deep(text), TOO_DEEP).otherwise(INVALID_JSON)
    return F.when(F.coalesce(text, F.lit("")) != "", F.when(nodes.isNull(), unread).when(F.get(nodes, F.lit(0))["kind"] != OBJECT, NOT_AN_OBJECT))


def json_warnings(nodes: Column) -> Column:
    """(key, kind) of what sanitising a bag changes, by depth; none where it is no object."""

    def kind(x: Column) -> Column:
        long = (x["kind"] == STRING) & (F.length(x["value"]) > MAX_STRING_LENGTH)
        return F.when(x["kind"] == DEEP, DEPTH_EXCEEDED).when(long, TRUNCATED_STRING).when(x["kind"] == NO_NUMBER, NOT_FINITE)

    told = F.filter(F.transform(nodes, lambda x: F.struct(x["key"].alias("key"), kind(x).alias("kind"))), lambda w: w["kind"].isNotNull())
    none = F.array().cast(WARNINGS)
    return F.when(F.get(nodes, F.lit(0))["kind"] == OBJECT, told.cast(WARNINGS)).otherwise(none)


def scrub_json_nodes(nodes: Column, marker: str = SCRUB_DEPTH_MARKER) -> Column:
    """The nodes with every string scrubbed; what lies below the depth limit is the marker, numbers that are none are null.

    Take the nodes to ``privacy.SCRUB_MAX_DEPTH``.
    """

    def clean(x: Column) -> Column:
        odd = x["kind"] == NO_NUMBER
        deep = x["kind"] == DEEP
        value = F.when(deep, F.lit(marker)).when(x["kind"] == STRING, scrub_pii(x["value"])).otherwise(x["value"])
        kind = F.when(deep, F.lit(STRING)).when(odd, F.lit(NULL)).otherwise(x["kind"])
        return F.struct(*[x[f].alias(f) for f in ("path", "name", "key", "depth")], kind.alias("kind"), value.alias("value"))

    return F.transform(nodes, clean)


def sensitive_json_paths(nodes: Column) -> Column:
    """Paths, at any depth, whose names look personal or secret."""
    hits = F.filter(nodes, lambda x: F.coalesce(x["name"].rlike(SENSITIVE_KEY_PATTERN), F.lit(False)))
    return F.transform(hits, lambda x: x["path"])


def json_paths(df: DataFrame, text: str, max_depth: int = MAX_DEPTH) -> DataFrame:
    """One row per node of a JSON text, with the other columns of ``df``; texts that cannot be read have none."""
    return with_json_nodes(df, text, "__nodes", max_depth).drop(text).select("*", F.inline("__nodes")).drop("__nodes")
