"""Column rules over stack traces."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FINGERPRINT_DEPTH = 5
DEFAULT_MODULE = "<default>"
_LINE = r"^\s*(?:at\s+)?([\w$.<>]*?)\.?([\w$<>]+)\(([^():]*)(?::(-?\d+))?\)"


def parse_stack(frames: Column) -> Column:
    """Frames (className, methodName, fileName, lineNumber) as module, symbol, number, file, line.

    Frames without class or method are skipped but keep their place in the numbering.
    """

    def parse(f: Column, i: Column) -> Column:
        cls = f["className"]
        dot = F.length(cls) - F.length(F.substring_index(cls, ".", -1))
        module = F.when(dot > 1, F.substring(cls, F.lit(1), dot - 1)).otherwise(DEFAULT_MODULE)
        simple = F.when(dot > 1, F.substring(cls, dot + 1, F.length(cls))).otherwise(cls)
        return F.struct(
            module.alias("module"),
            F.concat(simple, F.lit("."), f["methodName"]).alias("symbol"),
            i.alias("frame_number"),
            f["fileName"].alias("file_name"),
            F.when(f["lineNumber"] >= 0, f["lineNumber"]).alias("line_number"),
            ((cls != "") & (f["methodName"] != "")).alias("known"),
        )

    known = F.filter(F.transform(frames, parse), lambda f: f["known"])
    return F.transform(known, lambda f: f.dropFields("known"))


def parse_stack_text(text: Column) -> Column:
    """Printed ``at package.Class.method(File:line)`` lines as structured frames."""
    lines = F.filter(F.split(text, "\n"), lambda s: s.rlike(_LINE))
    return F.transform(
        lines,
        lambda s: F.struct(
            F.regexp_extract(s, _LINE, 1).alias("className"),
            F.regexp_extract(s, _LINE, 2).alias("methodName"),
            F.nullif(F.regexp_extract(s, _LINE, 3), F.lit("")).alias("fileName"),
            F.nullif(F.regexp_extract(s, _LINE, 4), F.lit("")).try_cast("int").alias("lineNumber"),
        ),
    )


def fingerprint(parsed: Column, type_name: Column, depth: int = FINGERPRINT_DEPTH) -> Column:
    """First ``depth`` frames as module:symbol, without line numbers, so moved code groups the same."""
    top = F.transform(F.slice(parsed, 1, depth), lambda f: F.concat_ws(":", f["module"], f["symbol"]))
    bare = F.concat(type_name, F.lit(":no_stack"))
    return F.when(F.coalesce(F.size(parsed), F.lit(0)) > 0, F.array_join(top, "|")).otherwise(bare)
