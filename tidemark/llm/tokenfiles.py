"""Token ids as binary files: one array of ids, and document boundaries in Elias-Fano code.

A file holds documents in ascending order of their ids: a header, the documents'
ends within the array, their keys, and the array itself in 16 or 32 bits an id.
The ends are a rising sequence of n numbers up to u, kept in n (2 + log2(u / n))
bits: the low bits of each packed one after another, the high bits as a row of
bits with a one for each number. ``select`` finds the i-th one: a directory of
32-bit counts, one for every 512 bits, is searched, then the bits of one block
are counted. So an offset is read without a table of 64-bit offsets, and where a
file starts among all ids is one number in the table of files.

Integer keys are coded the same way, others are UTF-8 with coded ends.
"""

from __future__ import annotations

import random
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir
from .bpe import _RARE, _WORD, Encoder, public_path
from .common import steps, table, written

END_ID = 2
#: A file is closed at so many ids, or documents; a longer document has one of its own.
FILE_IDS = 8_000_000
FILE_DOCS = 1 << 18
#: Documents read from a file at a time, in ids.
READ_IDS = 1 << 20
BLOCK_BITS = 512
_MAGIC = b"IDFILE01"
_HEADER = struct.Struct("<8sIIQQQqQQQ")
_EF_HEADER = struct.Struct("<QQII")


class EliasFano:
    """A sequence of integers, none smaller than the one before, in near-minimal space."""

    def __init__(self, n: int, last: int, low_width: int, low: np.ndarray, high: np.ndarray) -> None:
        self.n, self.last, self.low_width = n, last, low_width
        self.low, self.high = low, high
        ones = np.unpackbits(high.reshape(-1, BLOCK_BITS // 8), axis=1).sum(axis=1, dtype=np.uint32)
        #: Ones before each block.
        self.counts = np.concatenate([np.zeros(1, np.uint32), np.cumsum(ones, dtype=np.uint32)])

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        """Code non-negative integers; the last is the largest."""
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        last = int(values[-1]) if n else 0
        width = max(0, ((last + 1) // max(n, 1)).bit_length() - 1)
        bits = (values[:, None] >> np.arange(width, dtype=np.uint64)[None, :] & np.uint64(1)).astype(np.uint8)
        at = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        size = -(-(int(at[-1]) + 1 if n else 0) // BLOCK_BITS) * BLOCK_BITS
        high = np.zeros(size, np.uint8)
        high[at] = 1
        return cls(n, last, width, np.packbits(bits.ravel()), np.packbits(high))

    def place_of(self, i: np.ndarray) -> np.ndarray:
        """Select: where in the high bits the one number ``i`` stands."""
        block = np.searchsorted(self.counts, i, side="right") - 1
        out = np.empty(len(i), np.int64)
        for a in range(0, len(i), 4096):
            b = block[a : a + 4096]
            bits = np.unpackbits(self.high.reshape(-1, BLOCK_BITS // 8)[b], axis=1)
            within = np.cumsum(bits, axis=1, dtype=np.uint16)
            out[a : a + 4096] = b * BLOCK_BITS + (within <= (i[a : a + 4096] - self.counts[b])[:, None]).sum(axis=1)
        return out

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        """Numbers ``i`` of the sequence."""
        i = np.asarray(i, dtype=np.int64)
        if self.n == 0 or len(i) == 0:
            return np.zeros(0, np.uint64)
        value = (self.place_of(i) - i).astype(np.uint64) << np.uint64(self.low_width)
        for bit in range(self.low_width):
            at = i * self.low_width + bit
            value |= (self.low[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(np.uint64) << np.uint64(bit)
        return value

    def edges(self, a: int, b: int) -> np.ndarray:
        """The number before number a (0 at the start), and numbers a to b - 1: the edges of pieces whose ends are coded."""
        found = self[np.arange(max(a - 1, 0), b)].astype(np.int64)
        return found if a else np.concatenate([np.zeros(1, np.int64), found])

    def to_bytes(self) -> bytes:
        return _EF_HEADER.pack(self.n, self.last, self.low_width, len(self.high)) + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes, at: int = 0) -> tuple[EliasFano, int]:
        """The sequence at ``at``, and where it ends."""
        n, last, width, size = _EF_HEADER.unpack_from(data, at)
        at += _EF_HEADER.size
        low_size = -(-n * width // 8)
        low = np.frombuffer(data, np.uint8, low_size, at)
        high = np.frombuffer(data, np.uint8, size, at + low_size)
        return cls(n, last, width, low, high), at + low_size + size


@dataclass
class Index:
    """What a file says about its documents: the rows without a key come first."""

    width: int
    ends: EliasFano
    unkeyed: int
    base: int
    keys: EliasFano
    letters: bytes | None
    ids_at: int

    def bounds(self, a: int, b: int) -> np.ndarray:
        """Where documents a to b - 1 start, and where the last one ends."""
        return self.ends.edges(a, b)

    def names(self, a: int, b: int) -> list:
        """Keys of documents a to b - 1, null where there is none."""
        first = max(a - self.unkeyed, 0)
        last = max(b - self.unkeyed, first)
        if first == last:
            return [None] * (b - a)
        if self.letters is None:
            found = [int(v) + self.base for v in self.keys[np.arange(first, last)].tolist()]
        else:
            stops = self.keys.edges(first, last).tolist()
            found = [self.letters[x:y].decode() for x, y in zip(stops, stops[1:], strict=False)]
        return [None] * (b - a - len(found)) + found


def packed_file(keys: list, ids: list[bytes], width: int, integers: bool) -> bytes:
    """A file of documents in order, keys ascending after the nulls."""
    stops = np.cumsum([len(x) // width for x in ids])
    ends = EliasFano.of(stops).to_bytes()
    known = [k for k in keys if k is not None]
    letters, base = b"", 0
    if integers:
        base = known[0] if known else 0
        coded = EliasFano.of(np.array([k - base for k in known], dtype=np.uint64))
    else:
        names = [k.encode() for k in known]
        letters = b"".join(names)
        coded = EliasFano.of(np.cumsum([len(x) for x in names], dtype=np.uint64))
    sections = ends + coded.to_bytes() + letters
    at = -(-(_HEADER.size + len(sections)) // 64) * 64
    head = _HEADER.pack(_MAGIC, width, int(integers), len(ids), int(stops[-1]), len(keys) - len(known), base, len(ends), len(letters), at)
    return b"".join([head, sections, bytes(at - _HEADER.size - len(sections)), *ids])


class TokenFile:
    """Reads a file: its index at once, its ids as asked for."""

    def __init__(self, source: pa.NativeFile) -> None:
        self.source = source
        magic, width, integers, _, _, unkeyed, base, ends, letters, ids_at = _HEADER.unpack(source.read_at(_HEADER.size, 0))
        if magic != _MAGIC:
            raise ValueError("not a file of token ids")
        data = source.read_at(ids_at - _HEADER.size, _HEADER.size)
        boundaries, _ = EliasFano.from_bytes(data)
        keys, after = EliasFano.from_bytes(data, ends)
        self.index = Index(width, boundaries, unkeyed, base, keys, None if integers else data[after : after + letters], ids_at)

    def __len__(self) -> int:
        return self.index.ends.n

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids from ``start`` to ``end`` of the array."""
        width = self.index.width
        return np.frombuffer(self.source.read_at((end - start) * width, self.index.ids_at + start * width), f"<u{width}")

    def documents(self, step: int = READ_IDS) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
        """Runs of documents: their keys, bounds, and ids."""
        a, n = 0, len(self)
        while a < n:
            # As many as hold ``step`` ids, by search over the coded ends; at least one.
            start = int(self.index.bounds(a, a + 1)[0])
            low, high = a + 1, min(n, a + 4096)
            while low < high:
                middle = (low + high + 1) // 2
                low, high = (middle, high) if int(self.index.ends[[middle - 1]][0]) - start <= step else (low, middle - 1)
            bounds = self.index.bounds(a, low)
            yield self.index.names(a, low), bounds, self.ids(int(bounds[0]), int(bounds[-1]))
            a = low


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder that driver and executors share, and the path in it.

    A plain path or file: URI is a shared mount; others are what pyarrow opens (hdfs, s3, gs).
    """
    if "://" in path or path.startswith("file:"):
        if path.startswith("file:"):
            return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
        return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return fs.LocalFileSystem(), path


class PackedEncoder(Encoder):
    """Ids of whole texts as bytes, ``width`` an id. What stands between white space is independent, so its bytes are kept once made."""

    #: Strings kept before they become the older ones; the older ones before go.
    KEPT = 1 << 18

    def __init__(self, path: str, width: int) -> None:
        super().__init__(path)
        if len(self.numbers) > 1 << 8 * width:
            raise ValueError(f"the vocabulary takes more than {width} bytes an id")
        self.kind = f"<u{width}"
        encoder = self

        class Strings(dict):
            older: dict[str, bytes] = {}

            def __missing__(self, string: str) -> bytes:
                made = self.older.get(string)
                if made is None:
                    ids = encoder.ranks.encode_ordinary(" ".join(_WORD.findall(string)) + " ")
                    made = np.array(ids, dtype=encoder.kind).tobytes()
                if len(self) >= encoder.KEPT:
                    self.older = dict(self)
                    self.clear()
                self[string] = made
                return made

        self.strings = Strings()

    def __call__(self, text: str) -> bytes:
        if self.ranks is None or "<|" in text or _RARE.search(text):
            return np.array(self.ids(text), dtype=self.kind).tobytes()
        return b"".join(map(self.strings.__getitem__, text.lower().split()))


@lru_cache(maxsize=2)
def public_encoder(width: int) -> Callable[[str], bytes]:
    return PackedEncoder(public_path(), width)


def ordered(key, tie: int) -> tuple:
    """Sorts as Spark does: no key first, then by key, then by the text's hash."""
    return (False, 0, tie) if key is None else (True, key, tie)


def range_bounds(rows: DataFrame, ranges: int) -> list[tuple]:
    """The first (key, hash) of each of at most ``ranges`` ranges of about as many rows."""
    # A number for each row lets several ranges start with rows that are alike.
    dealt = rows.select("_id", "_tie", F.monotonically_increasing_id().alias("_row")).repartitionByRange(ranges, "_id", "_tie", "_row")
    first = F.min(F.struct(F.col("_id").isNotNull().alias("known"), F.col("_id").alias("id"), F.col("_tie").alias("tie")))
    return sorted(ordered(r["first"]["id"], r["first"]["tie"]) for r in dealt.groupBy(F.spark_partition_id()).agg(first.alias("first")).collect())


def encoded(rows: DataFrame, bounds: list[tuple], end_id: int, width: int, encoder: Callable[[int], Callable[[str], bytes]]) -> DataFrame:
    """``_part`` (the range of ``bounds``), ``_id``, ``_tie`` and ids (in ``width`` bytes, end id included) of every row."""
    schema = T.StructType([T.StructField("_part", T.IntegerType()), rows.schema["_id"], rows.schema["_tie"], T.StructField("ids", T.BinaryType())])

    def range_of(at: tuple) -> int:
        # Rows that several ranges start with are alike, and go to any of these.
        low, high = bisect_left(bounds, at), bisect_right(bounds, at)
        return max(0, random.randint(low, high - 1) if high > low else high - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(width), end_id.to_bytes(width, "little")
        for batch in batches:
            for a, b in steps(batch.column(2)):
                part = batch.slice(a, b - a)
                places = [range_of(ordered(k, t)) for k, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)]
                held = [encode(t or "") + end for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), part.column(0), part.column(1), pa.array(held, pa.binary())], names=schema.names)

    return rows.mapInArrow(run, schema)


def write_token_files(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    width: int = 2,
    file_ids: int = FILE_IDS,
    file_docs: int = FILE_DOCS,
    encoder: Callable[[int], Callable[[str], bytes]] = public_encoder,
) -> DataFrame:
    """Write the ids of all texts to files under ``path``; the table of files: file, part, number, start, n_docs, n_ids.

    Documents ascend by id over all files (null ids first; rows of one id by
    a hash of their text), each followed by ``end_id``; ``start`` counts the
    ids of all files before. Null texts count as empty: the end id alone. A
    document never spans files; one of over ``file_ids`` ids has its own. ``width``
    is 2 or 4 bytes an id and must hold the vocabulary. Ids of documents that are
    not integers are kept as text. No rows give no files. Other columns are
    ignored.

    A task gives its files names of its own and only the files of the attempt
    that ended are in the table, so a task that runs again does no harm.
    """
    if width not in (2, 4):
        raise ValueError("ids take 2 or 4 bytes")
    if end_id >= 1 << 8 * width:
        raise ValueError(f"end_id takes more than {width} bytes")
    id_type = docs.schema[id_col].dataType
    integers = isinstance(id_type, T.IntegralType)
    # Ranges are cut by ids alone; then texts are encoded once, where they are, and only ids of tokens are moved.
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select((F.col(f"`{id_col}`") if integers else F.col(f"`{id_col}`").cast("string")).alias("_id"), F.xxhash64(text).alias("_tie"), text.alias("_text"))
    coded = encoded(rows, range_bounds(rows, ranges), end_id, width, encoder)
    parts = coded.repartitionById(ranges, "_part").sortWithinPartitions("_part", "_id", "_tie").select(F.col("_part").cast("long"), "_id", "ids")
    fields = "file string, part long, number long, n_docs long, n_ids long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = store_of(path)
        keys: list = []
        ids: list[bytes] = []
        held = number = part = 0

        def close() -> pa.RecordBatch:
            name = f"part-{part:06d}-{number:06d}-{uuid.uuid4().hex}.ids"
            data = packed_file(keys, ids, width, integers)
            with store.open_output_stream(f"{base}/{name}") as out:
                out.write(data)
            row = {"file": name, "part": part, "number": number, "n_docs": len(ids), "n_ids": held}
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([("file", pa.string()), *[(c, pa.int64()) for c in ("part", "number", "n_docs", "n_ids")]]))

        store.create_dir(base, recursive=True)
        for batch in batches:
            for row in range(batch.num_rows):
                some = batch.column(2)[row].as_py()
                size = len(some) // width
                own = batch.column(0)[row].as_py()
                if ids and (own != part or held + size > file_ids or len(ids) == file_docs):
                    yield close()
                    keys, ids, held, number = [], [], 0, number + 1 if own == part else 0
                part = own
                keys.append(batch.column(1)[row].as_py())
                ids.append(some)
                held += size
        if ids:
            yield close()

    files = written(parts.mapInArrow(run, fields))
    # Starts: over the parts, of which there are as many as partitions, then within each.
    sums = files.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    back = (Window.unboundedPreceding, -1)
    earlier = sums.select("part", F.coalesce(F.sum("_n").over(Window.orderBy("part").rowsBetween(*back)), F.lit(0)).alias("_before"))
    inside = F.coalesce(F.sum("n_ids").over(Window.partitionBy("part").orderBy("number").rowsBetween(*back)), F.lit(0))
    return files.withColumn("_inside", inside).join(earlier, "part").select("file", "part", "number", (F.col("_before") + F.col("_inside")).alias("start"), "n_docs", "n_ids")


def read_token_files(files: DataFrame, path: str, id_col: str = "doc_id", id_type: T.DataType | None = None, with_ids: bool = False) -> DataFrame:
    """One row per document of the files: ``id_col``, start, n_tokens, ids_crc32 (and ids, if asked for).

    ``files`` is the table that ``write_token_files`` gives, and ``path`` its folder. Offsets come from the coded
    boundaries. ``start`` counts the ids of all documents before. An empty table gives no rows.
    """
    id_type = id_type or T.LongType()
    held_as = id_type if isinstance(id_type, T.IntegralType) else T.StringType()
    schema = T.StructType([T.StructField("_id", held_as), *[T.StructField(c, T.LongType()) for c in ("start", "n_tokens", "ids_crc32")]])
    if with_ids:
        schema.add("ids", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        store, base = store_of(path)
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with store.open_input_file(f"{base}/{name}") as source:
                    for keys, bounds, ids in TokenFile(source).documents():
                        cuts = (bounds - bounds[0]).tolist()
                        docs = [ids[a:b].astype("<u4") for a, b in zip(cuts, cuts[1:], strict=False)]
                        rows = {"_id": keys, "start": (bounds[:-1] + start).tolist(), "n_tokens": [len(d) for d in docs], "ids_crc32": [zlib.crc32(d.tobytes()) for d in docs]}
                        if with_ids:
                            rows["ids"] = [d.tolist() for d in docs]
                        yield pa.RecordBatch.from_pydict(rows, schema=out)

    # One file a task or a few: the table of files is small beside what it names.
    read = files.select("file", "start").repartition(F.col("file")).mapInArrow(run, schema)
    return read.select(F.col("_id").cast(id_type).alias(id_col), *schema.names[1:])


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write documents' ids to the shared folder and read them back."""
    docs = table(spark, sf_dir, "documents")
    path = f"{checkpoint_dir(spark).rstrip('/')}/ids-{uuid.uuid4().hex}"
    return read_token_files(write_token_files(docs, path), path, id_type=docs.schema["doc_id"].dataType)
