"""Tables of Parquet files with a list of those that count, and erasure that rewrites only files with a hit.

A folder without a list holds all its files. Lists are numbered; a new one is
written under another name and renamed, which is what commits it, so a reader sees
the table before or after an erasure and a crash in between changes nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.identity import forget

_LISTS = "_lists"


def _store(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root, root.getFileSystem(spark._jsc.hadoopConfiguration())


def _at(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def _lists(spark: SparkSession, path: str) -> list[int]:
    root, store = _store(spark, f"{path}/{_LISTS}")
    if not store.exists(root):
        return []
    names = [s.getPath().getName() for s in store.listStatus(root)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())


def _read_list(spark: SparkSession, path: str, number: int) -> dict:
    lines = spark.read.option("wholetext", True).text(f"{path}/{_LISTS}/{number:08d}.json").first()
    return json.loads(lines["value"])


def _all_files(spark: SparkSession, path: str) -> list[str]:
    root, store = _store(spark, path)
    base = store.makeQualified(root).toString()
    found, left = [], store.listFiles(root, True)
    while left.hasNext():
        name = left.next().getPath().toString().removeprefix(base).lstrip("/")
        if name.endswith(".parquet") and not any(part.startswith(("_", ".")) for part in name.split("/")):
            found.append(name)
    return sorted(found)


def live_files(spark: SparkSession, path: str) -> list[str]:
    """The files that count, relative to the table's folder."""
    numbers = _lists(spark, path)
    return _read_list(spark, path, numbers[-1])["files"] if numbers else _all_files(spark, path)


def read_stored(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The table as of its newest list."""
    files = live_files(spark, path)
    if schema is None:
        schema = spark.read.parquet(path if not files else f"{path}/{files[0]}").schema
    reader = spark.read.schema(schema)
    return reader.parquet(*[f"{path}/{f}" for f in files]) if files else spark.createDataFrame([], schema)


def _commit(spark: SparkSession, path: str, number: int, entry: dict) -> None:
    name = f"{path}/{_LISTS}/{number:08d}.json"
    root, store = _store(spark, path)
    draft = _at(spark, f"{name}.draft")
    out = store.create(draft, True)
    out.write(bytearray(json.dumps(entry).encode()))
    out.close()
    if store.exists(_at(spark, name)) or not store.rename(draft, _at(spark, name)):
        raise RuntimeError(f"another writer has committed {name}")


def _clean(spark: SparkSession, path: str, entry: dict) -> None:
    """Delete the files that the erasure replaced; those already gone are no error."""
    root, store = _store(spark, path)
    for name in entry["replaced"]:
        store.delete(_at(spark, f"{path}/{name}"), False)


def erase_stored(spark: SparkSession, path: str, requests: DataFrame, columns: dict[str, str], erasure: str) -> dict[str, int]:
    """Remove rows that match a request on any id from a stored table. ``columns`` maps request columns to the table's.

    One scan of the id columns finds the files that hold a hit; only these are read whole and written anew, under the
    name of the ``erasure``. The rest keep their names. Run it again under the same name after a crash: what was not
    committed is written again, what was is only cleaned up. The list of files, not rows, passes through the driver.
    A folder that other writers add to must get its files through lists of its own, as files outside the newest do not
    count.
    """
    numbers = _lists(spark, path)
    if numbers:
        newest = _read_list(spark, path, numbers[-1])
        for number in reversed(numbers):
            entry = newest if number == numbers[-1] else _read_list(spark, path, number)
            if entry["erasure"] == erasure:
                _clean(spark, path, entry)
                return {"files": len(newest["files"]), "rewritten": len(entry["replaced"])}
    files = live_files(spark, path)
    if not files:
        return {"files": 0, "rewritten": 0}
    table = read_stored(spark, path)
    held = table.select(*dict.fromkeys(columns.values()), F.col("_metadata.file_path").alias("__file"))
    names = []
    for asked, own in columns.items():
        ids = requests.filter(F.col(asked).isNotNull()).select(F.col(asked).alias(own)).distinct()
        names.append(held.join(ids, own, "left_semi").select("__file"))
    found = names[0]
    for more in names[1:]:
        found = found.unionByName(more)
    # At most a name for each file of the table, which its list holds anyway. The last part of a path may be encoded, so names are compared by it.
    endings = {r[0].rsplit("/", 1)[-1] for r in found.distinct().collect()}
    hit = [f for f in files if f.rsplit("/", 1)[-1] in endings]
    fresh: list[str] = []
    if hit:
        if not numbers:
            # From here on a list says what counts, so that files written before the commit do not.
            _commit(spark, path, 1, {"erasure": None, "files": files, "replaced": []})
            numbers = [1]
        kept = forget(read_stored_files(spark, path, hit, table), requests, columns)
        kept.write.mode("overwrite").parquet(f"{path}/erased-{erasure}")
        fresh = [f for f in _all_files(spark, path) if f.startswith(f"erased-{erasure}/")]
    gone = set(hit)
    entry = {"erasure": erasure, "files": [f for f in files if f not in gone] + fresh, "replaced": hit}
    _commit(spark, path, numbers[-1] + 1 if numbers else 1, entry)
    _clean(spark, path, entry)
    return {"files": len(entry["files"]), "rewritten": len(hit)}


def read_stored_files(spark: SparkSession, path: str, files: list[str], table: DataFrame) -> DataFrame:
    return spark.read.schema(table.schema).parquet(*[f"{path}/{f}" for f in files])
