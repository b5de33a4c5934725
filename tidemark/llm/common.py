"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir

#: Texts handed to one vectorised step together, in bytes; a longer text goes alone.
STEP_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read back.

    Later jobs read the files, so a lost executor costs no recomputation of what is upstream.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_at = path
    return table


def discard(table: DataFrame) -> None:
    """Delete a table of ``written`` that nothing will read again, such as an earlier round of an iteration."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.written_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def id_remainder(column: str, divisor: int) -> Column:
    """crc32 of the id's decimal text, modulo ``divisor``; null ids take the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def shares(df: DataFrame, by: Column, wanted: int, key: Column) -> DataFrame:
    """A sample of about ``wanted`` rows of each value of ``by``, chosen by a hash of ``key``.

    Only for fitting models: the counts are over all rows, the rows are not held in one task.
    """
    scale = float(1 << 30)
    marked = df.withColumn("_by", by)
    counts = marked.groupBy("_by").agg(F.count(F.lit(1)).alias("_n"))
    draw = F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)).cast("double")
    return marked.join(counts, "_by").filter(draw * F.col("_n") < F.lit(scale * wanted)).drop("_by", "_n")


def steps(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts hold about STEP_BYTES together."""
    start = held = 0
    for i in range(len(texts)):
        size = len(texts[i].as_buffer()) if texts[i].is_valid else 0
        if i > start and held + size > STEP_BYTES:
            yield start, i
            start, held = i, 0
        held += size
    if len(texts) > start:
        yield start, len(texts)


def annotate(
    df: DataFrame,
    make: Callable[[], Callable[[list], dict[str, list]]],
    fields: list[T.StructField],
    text: str = "text",
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """Append columns computed from the texts, batch by batch.

    ``make`` runs once per task and returns the function from a list of texts
    to the new columns. Input columns of the same names are replaced.
    """
    new = [f.name for f in fields]
    kept = [f for f in df.schema.fields if f.name not in new and f.name not in drop]
    source = df.select(F.col(text).cast("string").alias("_text_in"), *[F.col(f"`{f.name}`") for f in kept])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            for start, end in steps(batch.column(0)):
                part = batch.slice(start, end - start)
                made = apply(part.column(0).to_pylist())
                arrays = [part.column(i + 1) for i in range(len(names))]
                for f in fields:
                    value = made[f.name]
                    arrays.append(value if isinstance(value, pa.Array) else pa.array(value, type=arrow_type(f.dataType)))
                yield pa.RecordBatch.from_arrays(arrays, names=names + new)

    return source.mapInArrow(run, T.StructType([*kept, *fields]))


def unused(columns: list[str], name: str) -> str:
    """``name``, with underscores before it until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
