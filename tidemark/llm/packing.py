"""Harmonic packing of token ids into sequences of fixed capacity.

Lengths fall into reciprocal classes: class j holds pieces longer than
capacity / (j + 1) and no longer than capacity / j, and each of its bins takes
exactly j of them. A task fills its own bins and sees no other task, so packing
needs no shuffle. Documents may be cut, so a remainder is first cut at exact
reciprocals (1/2, 1/4, ... of the capacity), whose bins come out full; only a
tail of at most ``tail`` ids goes to a class that does not divide the capacity.
Bins open at the end of a task are joined and cut to powers of two.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import steps, table

CAPACITY = 1024
TAIL = 32
END_ID = 0
#: White space in a row that the rank encoder is given at most: its pattern fails on about a million characters of it.
SPACE_RUN = 100_000
_SPACES = re.compile(r"\s+")


@lru_cache(maxsize=2)
def byte_encoder(path: str) -> Callable[[list[str]], list[list[int]]]:
    """Ids of the byte-level tokenizer file at ``path``, special strings read as the file says."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def encode(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    return encode


@lru_cache(maxsize=2)
def rank_encoder(path: str, pattern: str, special: tuple[tuple[str, int], ...]) -> Callable[[list[str]], list[list[int]]]:
    """The same vocabulary as a rank file: the same ids, several times faster."""
    import base64

    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    coder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(special))
    return lambda texts: [coder.encode(t, allowed_special="all") for t in texts]


def has_long_space(text: str) -> bool:
    return len(text) > SPACE_RUN and any(m.end() - m.start() > SPACE_RUN for m in _SPACES.finditer(text))


def public_encoder() -> Callable[[list[str]], list[list[int]]]:
    """Ids of byte_bpe_50k.json: by its rank file, or by the library where a text has white space the rank encoder fails on."""
    import public_tokenizers

    fast = rank_encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, (("<|endoftext|>", 50256),))

    def encode(texts: list[str]) -> list[list[int]]:
        return [byte_encoder(public_tokenizers.path("byte_bpe_50k.json"))([t])[0] if has_long_space(t) else fast([t])[0] for t in texts]

    return encode


def cuts(length: int, capacity: int = CAPACITY, tail: int = TAIL) -> list[int]:
    """Piece lengths of a document: full sequences, then exact reciprocals, then one tail."""
    pieces = [capacity] * (length // capacity)
    rest = length % capacity
    part = capacity // 2
    while rest > tail and part >= 1:
        if rest >= part:
            pieces.append(part)
            rest -= part
        part //= 2
    return [*pieces, rest] if rest else pieces


class Bins:
    """The bins of one task. A piece is (row, start, length)."""

    def __init__(self, first_sequence: int, capacity: int) -> None:
        self.capacity, self.next = capacity, first_sequence
        self.open: dict[int, list] = {}

    def add(self, piece: tuple) -> list[tuple]:
        """The pieces of the bin that ``piece`` closes, each with its sequence and offset."""
        fit = self.capacity // piece[2]
        held = self.open.setdefault(fit, [])
        held.append(piece)
        return self.close(self.open.pop(fit)) if len(held) == fit else []

    def close(self, pieces: list[tuple]) -> list[tuple]:
        placed, offset = [], 0
        for piece in pieces:
            placed.append((*piece, self.next, offset))
            offset += piece[2]
        self.next += 1
        return placed

    def finish(self) -> list[tuple]:
        """Join what is left, cutting pieces: full sequences, then one for each power of two in the rest."""
        left = [p for fit in sorted(self.open) for p in self.open[fit]]
        self.open = {}
        total = sum(p[2] for p in left)
        sizes = [self.capacity] * (total // self.capacity)
        rest = total % self.capacity
        sizes += [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        placed: list[tuple] = []
        queue = left[::-1]
        for size in sizes:
            bin_pieces, room = [], size
            while room:
                doc, start, length, ids = queue.pop()
                take = min(length, room)
                bin_pieces.append((doc, start, take, ids[:take]))
                if take < length:
                    queue.append((doc, start + take, length - take, ids[take:]))
                room -= take
            placed += self.close(bin_pieces)
        return placed


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    tail: int = TAIL,
    encoder: Callable[[], Callable[[list[str]], list[list[int]]]] = public_encoder,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``id_col``, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, if asked for).

    Null texts count as empty; an empty document is its end id alone. Repeated
    rows are packed each for itself; a null id stays null. Other columns are
    ignored. No rows give no rows. ``capacity`` is a power of two.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    id_type = docs.schema[id_col].dataType
    fields = [T.StructField(id_col, id_type)] + [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        bins = Bins(TaskContext.get().partitionId() << 40, capacity)

        def rows(placed: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
            arrays = [
                pa.array([p[0][0] for p in placed], id_type),
                pa.array([p[1] for p in placed], pa.int64()),
                pa.array([p[2] for p in placed], pa.int64()),
                pa.array([zlib.crc32(p[3].tobytes()) for p in placed], pa.int64()),
                pa.array([p[0][1] for p in placed], pa.int64()),
                pa.array([p[4] for p in placed], pa.int64()),
                pa.array([p[5] for p in placed], pa.int64()),
            ]
            if with_ids:
                arrays.append(pa.array([p[3].astype(np.int32).tolist() for p in placed], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(arrays, names=schema.names)

        kind = None
        for batch in batches:
            kind = batch.column(0).type
            for a, b in steps(batch.column(1)):
                part = batch.slice(a, b - a)
                placed: list[tuple] = []
                for key, ids in zip(part.column(0).to_pylist(), encode([t or "" for t in part.column(1).to_pylist()]), strict=True):
                    ids = np.array([*ids, END_ID], dtype="<u4")
                    doc, start = (key, len(ids)), 0
                    for length in cuts(len(ids), capacity, tail):
                        # A copy, so that an open bin does not hold its whole document.
                        placed += bins.add((doc, start, length, ids[start : start + length].copy()))
                        start += length
                yield rows(placed, kind)
        if kind is not None:
            yield rows(bins.finish(), kind)

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text_in")).mapInArrow(run, schema)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
