"""Whitening of embeddings from the covariance of distinct vectors.

Entries become integers, so that equal vectors are equal bytes. Rows are grouped
by those bytes; each distinct vector enters the fit once, weighted by one or by
its count. Its sums are exact integers, and centring happens on them, before
anything is multiplied: a task adds the weighted products of its centred vectors
to one matrix, and matrices are added by rows across tasks. What reaches the
driver is one matrix of the vectors' dimension, whatever the number of rows. Each
distinct vector is then projected once and joined back to its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, table, written

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
#: A vector with at least this share of all rows is joined by a broadcast; there are at most as many of them.
HOT_ROWS = 1000
#: Larger entries have no 64-bit integer and count as not finite.
LARGEST = 2.0**62
#: Vectors turned into one matrix at a time, in entries.
STEP_ENTRIES = 1 << 20

FACTS = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def pack(x: np.ndarray) -> list[bytes]:
    """Rows of integers as bytes: the width of the largest entry, then the entries in that width."""
    top = np.maximum(x.max(axis=1), -(x.min(axis=1) + 1))
    width = np.where(top < 1 << 15, 2, np.where(top < 1 << 31, 4, 8))
    out: list[bytes] = [b""] * len(x)
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        for i, row in zip(at.tolist(), x[at].astype(f"<i{w}"), strict=True):
            out[i] = bytes([w]) + row.tobytes()
    return out


def unpack(keys: pa.Array) -> np.ndarray:
    """The rows of ``pack``, all of one length."""
    rows = keys.to_pylist()
    return np.stack([np.frombuffer(k, dtype=f"<i{k[0]}", offset=1).astype(np.int64) for k in rows])


def coded(df: DataFrame, id_col: str, vector_col: str, scale: float = SCALE) -> DataFrame:
    """Rows ``_id``, ``dim``, ``key`` of the vectors that have no null and no entry that is not finite.

    ``key`` holds floor(scale * entry) of each entry, computed in doubles.
    """
    kind = df.schema[id_col].dataType
    element = df.schema[vector_col].dataType.elementType
    vector = F.col(f"`{vector_col}`")
    if not isinstance(element, (T.FloatType, T.DoubleType)):
        vector = vector.cast("array<double>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = batch.column(0), batch.column(1)
            lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths[lengths > 0]).tolist():
                at = np.flatnonzero(lengths == dim)
                step = max(1, STEP_ENTRIES // dim)
                for part in (at[a : a + step] for a in range(0, len(at), step)):
                    # A null entry becomes NaN here.
                    flat = vectors.take(pa.array(part)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
                    with np.errstate(invalid="ignore", over="ignore"):
                        x = np.floor(flat.reshape(-1, dim) * scale)
                        good = (np.abs(x) < LARGEST).all(axis=1)
                    if not good.any():
                        continue
                    held = pa.array(part[good])
                    keys = pa.array(pack(x[good].astype(np.int64)), pa.binary())
                    yield pa.RecordBatch.from_arrays([ids.take(held), pa.array(np.full(len(held), dim), pa.int32()), keys], names=["_id", "dim", "key"])

    schema = T.StructType([T.StructField("_id", kind), T.StructField("dim", T.IntegerType()), T.StructField("key", T.BinaryType())])
    return df.select(F.col(f"`{id_col}`").alias("_id"), vector.alias("_vector")).mapInArrow(run, schema)


def tasks_of(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    """The batches, cut to a bounded number of entries."""
    step = max(1, STEP_ENTRIES // max(dim, 1))
    for batch in batches:
        for a in range(0, batch.num_rows, step):
            yield batch.slice(a, step)


def exact_sums(vectors: DataFrame, dim: int) -> list[int]:
    """Sum over rows of weight times each entry, as integers of any size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [0] * dim
        for batch in tasks_of(batches, dim):
            x, w = unpack(batch.column("key")), batch.column("weight").to_numpy()
            if float(np.abs(x.astype(np.float64)).max()) * float(w.sum()) >= LARGEST:
                x, w = x.astype(object), w.astype(object)
            totals = [a + int(b) for a, b in zip(totals, (x * w[:, None]).sum(axis=0), strict=True)]
        from decimal import Decimal

        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array([Decimal(t) for t in totals], pa.decimal128(38, 0))], names=["i", "total"])

    parts = vectors.select("key", "weight").mapInArrow(run, "i int, total decimal(38,0)")
    # One row for each dimension.
    return [int(r["total"]) for r in parts.groupBy("i").agg(F.sum("total").alias("total")).orderBy("i").collect()]


def gemm(rows: DataFrame, centred: Callable[[pa.RecordBatch], np.ndarray], dim: int) -> np.ndarray:
    """Sum over rows of weight times the outer product of the centred row with itself.

    A task holds one matrix; matrices are added row by row of the matrix, as they come in.
    """

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in tasks_of(batches, dim):
            x = centred(batch)
            part = (x * batch.column("weight").to_numpy()[:, None]).T @ x
            held = part if held is None else held + part
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array([r.tobytes() for r in held], pa.binary())], names=["i", "products"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, products in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held[i] = held.get(i, 0.0) + np.frombuffer(products)
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([v.tobytes() for v in held.values()], pa.binary())], names=["i", "products"])

    schema = "i int, products binary"
    summed = rows.mapInArrow(multiply, schema).repartition(F.col("i")).mapInArrow(add, schema)
    # dim rows of dim numbers.
    out = np.zeros((dim, dim))
    for r in summed.collect():
        out[r["i"]] = np.frombuffer(r["products"])
    return (out + out.T) / 2


@dataclass
class Model:
    """n and the sums S of the fit (of entries before the offset), and the components by falling eigenvalue."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact; Python integers where 64 bits might not hold them."""
        largest = self.n * int(np.abs(x.astype(np.float64)).max() + 1) + max(map(abs, self.sums))
        if largest < 1 << 62:
            return x * self.n - np.array(self.sums, dtype=np.int64)
        return x.astype(object) * self.n - np.array(self.sums, dtype=object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n."""
        return (self.deviations(x) / self.n).astype(np.float64)


def fit(vectors: DataFrame, dim: int, components: int = COMPONENTS) -> Model:
    """Fit to rows ``key``, ``weight``. Components whose eigenvalue is zero in double precision are left out."""
    n = int(vectors.agg(F.sum("weight")).first()[0])
    model = Model(n, exact_sums(vectors, dim), np.zeros(0), np.zeros((dim, 0)), 0.0)
    covariance = gemm(vectors.select("key", "weight"), lambda batch: model.centred(unpack(batch.column("key"))), dim) / n
    values, axes = np.linalg.eigh(covariance)
    order = np.argsort(values, kind="stable")[::-1]
    order = [i for i in order if values[i] > dim * np.finfo(float).eps * values[order[0]] and values[i] > 0][:components]
    return Model(n, model.sums, values[order], axes[:, order], float(np.trace(covariance)))


def project(vectors: DataFrame, model: Model, dim: int) -> DataFrame:
    """``key``, ``weight``, ``many``, whitened (one number for each component) and deviation; null where 64 bits do not hold it."""
    axes = model.vectors / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tasks_of(batches, dim):
            x = unpack(batch.column("key"))
            away = model.deviations(x)
            if away.dtype == object or float(np.abs(away).max()) ** 2 * dim >= LARGEST:
                away = away.astype(object)
            squares = [int(s) if s < 1 << 63 else None for s in (away * away).sum(axis=1).tolist()]
            z = model.centred(x) @ axes
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, z.size + 1, z.shape[1]), pa.int32()), pa.array(z.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(squares, pa.int64())], names=[*batch.schema.names, "z", "deviation"])

    kept = vectors.select("key", "weight", "many")
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("z", T.ArrayType(T.DoubleType())), T.StructField("deviation", T.LongType())]))


def identity_error(projected: DataFrame, n: int, components: int) -> float:
    """Largest absolute entry of the covariance of the whitened vectors minus the identity, over the fit."""
    means = np.array(projected.agg(*[F.sum(F.col("weight") * F.col("z")[i]) / n for i in range(components)]).first())

    def centred(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column("z").flatten().to_numpy().reshape(-1, components) - means

    return float(np.abs(gemm(projected.select("z", "weight"), centred, components) / n - np.eye(components)).max())


def whiten(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
    weights: str = "one",
    scale: float = SCALE,
) -> DataFrame:
    """One row per remaining row and component: ``id_col``, component, n, deviation, whitened, explained, identity_error.

    Rows without a vector, or whose vector holds a null, a number that is not
    finite or one that no 64-bit integer holds after scaling, are dropped, and so
    are vectors of another length than most have (the smaller one on a tie).
    ``weights`` is "one" (each distinct vector counts once) or "count" (as often
    as it occurs); n is the sum of weights. Repeated rows, repeated and null ids
    are answered each for itself. Components of eigenvalue zero have no rows, so
    there are none where all vectors are equal; no rows give no rows. Vectors may
    have any length, as the driver and a task hold one matrix of it. ``deviation``
    is null where 64 bits do not hold it. Other columns are ignored.
    """
    if weights not in ("one", "count"):
        raise ValueError("weights are one or count")
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), *T.StructType.fromDDL(FACTS).fields])
    rows = written(coded(df, id_col, vector_col, scale))
    lengths = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "dim").first()
    if lengths is None:
        return df.sparkSession.createDataFrame([], schema)
    dim, total = lengths["dim"], lengths["n"]
    rows = rows.filter(F.col("dim") == dim)
    many = rows.groupBy("key").agg(F.count(F.lit(1)).alias("many"))
    vectors = written(many.withColumn("weight", F.lit(1).cast("long") if weights == "one" else F.col("many")))
    model = fit(vectors, dim, components)
    k = len(model.values)
    if k == 0:
        return df.sparkSession.createDataFrame([], schema)
    projected = written(project(vectors, model, dim))
    discard(vectors)
    error = identity_error(projected, model.n, k)
    # Vectors with at least total / HOT_ROWS rows, so at most HOT_ROWS of them, meet their rows where those are.
    hot = F.col("many") * HOT_ROWS >= total
    facts = projected.select("key", "z", "deviation")
    met = rows.join(F.broadcast(facts.filter(hot)), "key", "left")
    rest = met.filter("z is null").select("_id", "key").join(projected.filter(~hot).select("key", "z", "deviation"), "key")
    all_rows = met.filter("z is not null").select("_id", "z", "deviation").unionByName(rest.select("_id", "z", "deviation"))
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    return all_rows.select("_id", "deviation", F.posexplode("z").alias("i", "whitened")).select(
        F.col("_id").alias(id_col),
        (F.col("i") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("i")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
