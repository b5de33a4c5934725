"""Byte-pair encoding and decoding with a public tokenizer file.

This tokenizer drops white space, so words between ASCII white space are
independent. A text of more than ``leaf_chars`` code points is cut in halves down to leaves, whatever the cut goes
through; leaves are rows of their own, encoded in parallel on all executors.
Their ids are then concatenated up a tree: where a cut went through a run of
characters without white space, a window around it is encoded again and grown
until it agrees with both sides.

Why that is exact: adjacent ids of an encoding stay an encoding wherever they
stand inside one run, so ids left of the agreement with the left side, ids of
the window, and ids right of the agreement with the right side are what the
whole text gives. A window starts where the left side starts an id, at least
``_REACH`` code points before the cut, so no special string is cut by it.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate, steps, table, text_or_empty

LEAF_CHARS = 16384
#: Characters whose normal form, case or class is left to the library: all but ASCII and Latin letters in composed form.
_RARE = regex.compile("[^\\x00-\\x1b\\x20-\\x7e\\xa1-\\xac\\xae-\\u012f\\u0131-\\u017e\\u2010-\\u2027\\u2030-\\u205e\\u20ac]")
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
_REACH = 64
_SPACES = " \t\n\x0b\x0c\r"
_SPACE = re.compile(r"[ \t-\r]")

Coded = tuple[list[int], list[tuple[int, int]]]


def public_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@lru_cache(maxsize=2)
def tokenizer_of(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def byte_letters() -> dict[str, int]:
    """The printable stand-ins of bytes in a byte-level vocabulary: printable Latin-1 for itself, the rest from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


@lru_cache(maxsize=2)
def rank_coder(path: str):
    """The file's merges as a rank table, where a word's end is written as a space; None if they are not of that kind.

    Ids grow in the order of the merges, so the ids are the ranks.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    letters = byte_letters()
    vocabulary = {t: i for t, i in model["vocab"].items() if not t.startswith("<|")}
    end = model.get("end_of_word_suffix")
    if not end:
        return None
    ranks = {bytes(letters[c] for c in t.removesuffix(end)) + (b" " if t.endswith(end) else b""): i for t, i in vocabulary.items()}
    return tiktoken.Encoding("word-ends", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Ids of whole texts as the library gives them.

    Texts of plain letters are split here and merged through the rank table,
    several times faster than the library; all others go to the library itself.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer, self.ranks = tokenizer_of(path), rank_coder(path)
        size = max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1
        self.numbers = [str(i) for i in range(size)]
        self.tokens = [self.tokenizer.id_to_token(i) or "" for i in range(size)]

    def ids(self, text: str) -> list[int]:
        if self.ranks is None or "<|" in text or _RARE.search(text):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        words = _WORD.findall(text.lower())
        return self.ranks.encode_ordinary(" ".join(words) + " ") if words else []

    def texts_of(self, ids: list[int]) -> tuple[int, str, str]:
        """Their number, the ids with a space between, and the decoded text."""
        numbers, tokens = self.numbers, self.tokens
        return len(ids), " ".join([numbers[i] for i in ids]), " ".join([tokens[i] for i in ids])


def code(path: str, text: str) -> Coded:
    """Ids and their spans in code points."""
    e = tokenizer_of(path).encode(text, add_special_tokens=False)
    return e.ids, e.offsets


def joined(path: str, text: str, cut: int, left: Coded, right: Coded) -> Coded:
    """The encoding of ``text`` from those of its parts before and after ``cut`` (spans count from each part's start)."""
    (li, ls), (ri, rs) = left, [right[0], [(a + cut, b + cut) for a, b in right[1]]]
    grow = 8
    while True:
        i = max(0, len(li) - grow)
        while i > 0 and (ls[i][0] > cut - _REACH or ls[i - 1][1] > ls[i][0] or text[ls[i][0]] == "'"):
            i -= 1
        j = min(len(ri), grow)
        while j < len(ri) and rs[j - 1][1] > rs[j][0]:
            j += 1
        a = ls[i][0] if i > 0 else 0
        b = rs[j - 1][1] if j < len(ri) else len(text)
        wi, ws = code(path, text[a:b])
        ws = [(x + a, y + a) for x, y in ws]
        agrees = i == 0 or (len(wi) > 2 and wi[:2] == li[i : i + 2] and ws[:2] == ls[i : i + 2])
        if agrees and b == len(text):
            return li[:i] + wi, ls[:i] + ws
        if agrees:
            # The first place where two ids in a row are the right side's; the window's last id may be cut short.
            place = {span: k for k, span in reversed(list(enumerate(rs[:j])))}
            for k in range(len(wi) - 2):
                m = place.get(ws[k])
                if m is not None and (i > 0 or ws[k][0] >= cut) and wi[k : k + 2] == ri[m : m + 2] and ws[k : k + 2] == rs[m : m + 2]:
                    if k == 0 or ws[k - 1][1] <= ws[k][0]:
                        return li[:i] + wi[:k] + ri[m:], ls[:i] + ws[:k] + rs[m:]
        if a == 0 and b == len(text):
            return wi, ws
        grow *= 2


@dataclass
class Edge:
    """A run without white space at the edge of a leaf, and its encoding."""

    text: str
    coded: Coded


@dataclass
class Node:
    """The encoding of a stretch of text: its first run, the ids between, its last run.

    A stretch without any white space is its first run alone.
    """

    head: Edge
    middle: list[int]
    tail: Edge | None


def leaf_parts(text: str) -> tuple[str, str, str | None]:
    """First run, what is between, last run; None as the last where there is no white space."""
    first = _SPACE.search(text)
    if first is None:
        return text, "", None
    last = len(text)
    while text[last - 1] not in _SPACES:
        last -= 1
    return text[: first.start()], text[first.start() : last], text[last:]


def concatenated(path: str, nodes: list[Node]) -> list[int]:
    """Join neighbouring nodes, level by level, until one is left; its ids."""

    def fuse(a: Edge, b: Edge) -> Edge:
        if not a.text or not b.text:
            return b if not a.text else a
        return Edge(a.text + b.text, joined(path, a.text + b.text, len(a.text), a.coded, b.coded))

    def join(a: Node, b: Node) -> Node:
        if a.tail is None:
            return Node(fuse(a.head, b.head), b.middle, b.tail)
        if b.tail is None:
            return Node(a.head, a.middle, fuse(a.tail, b.head))
        return Node(a.head, a.middle + fuse(a.tail, b.head).coded[0] + b.middle, b.tail)

    while len(nodes) > 1:
        pairs = [join(nodes[k], nodes[k + 1]) for k in range(0, len(nodes) - 1, 2)]
        nodes = pairs + nodes[len(nodes) - len(nodes) % 2 :]
    only = nodes[0]
    return only.head.coded[0] + only.middle + (only.tail.coded[0] if only.tail else [])


def leaf_bounds(length: int, leaf_chars: int) -> list[int]:
    """Halves of halves: cuts of [0, length) into a power of two of leaves."""
    parts = 1
    while length > parts * leaf_chars:
        parts *= 2
    return [length * k // parts for k in range(parts + 1)]


RESULT = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.StringType()), T.StructField("decoded", T.StringType())]
#: The columns of an encoded leaf besides its key and number.
_LEAF = "_head string, _head_ids array<int>, _head_at array<int>, _middle binary, _tail string, _tail_ids array<int>, _tail_at array<int>"


def encode_texts(docs: DataFrame, text_col: str = "text", path: str | None = None, leaf_chars: int = LEAF_CHARS, digests: bool = False, id_cols: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``id_cols`` and, for each document, n_tokens, ids (decimal, one space between) and decoded.

    With ``digests``, ids_sha256 and decoded_sha256 stand in for the two texts.
    Null texts count as empty and give no ids. Repeated rows are encoded each
    for itself; other columns are ignored; no rows give no rows. The file at
    ``path`` must be of a tokenizer that drops white space and has no decoder.
    """
    path = path or public_path()
    fields = [RESULT[0], *([T.StructField(f"{f.name}_sha256", T.StringType()) for f in RESULT[1:]] if digests else RESULT[1:])]

    def values(found: list[tuple[int, str, str]]) -> dict[str, list]:
        ids, decoded = [x[1] for x in found], [x[2] for x in found]
        if digests:
            ids, decoded = ([hashlib.sha256(x.encode()).hexdigest() for x in texts] for texts in (ids, decoded))
        return {f.name: v for f, v in zip(fields, ([x[0] for x in found], ids, decoded), strict=True)}

    def short() -> Callable[[list], dict[str, list]]:
        encoder = Encoder(path)
        return lambda texts: values([encoder.texts_of(encoder.ids(t)) for t in texts])

    rows = docs.select(*id_cols, text_or_empty(text_col).alias("_text"))
    is_long = F.char_length("_text") > leaf_chars
    out = annotate(rows.filter(~is_long), short, fields, "_text", drop=("_text",))

    # Long texts: leaves as rows, dealt out by document and leaf.
    held = rows.filter(is_long).withColumn("_key", F.monotonically_increasing_id())
    id_fields = [docs.schema[c] for c in id_cols]
    keys = [*id_fields, T.StructField("_key", T.LongType()), T.StructField("_leaf", T.LongType())]
    leaf = T.StructType([*keys, T.StructField("_part", T.StringType())])
    coded = T.StructType([*keys, *T.StructType.fromDDL(_LEAF).fields])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                text = batch.column("_text")[row].as_py()
                edges = leaf_bounds(len(text), leaf_chars)
                n = len(edges) - 1
                one = batch.slice(row, 1)
                arrays = [pa.array(one.column(c).to_pylist() * n, one.column(c).type) for c in (*id_cols, "_key")]
                arrays += [pa.array(range(n), pa.int64()), pa.array([text[a:b] for a, b in zip(edges, edges[1:], strict=False)], pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=leaf.names)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        ints = pa.list_(pa.int32())
        for batch in batches:
            for a, b in steps(batch.column("_part")):
                part = batch.slice(a, b - a)
                split = [leaf_parts(t) for t in part.column("_part").to_pylist()]
                heads, tails = ([code(path, x) if x is not None else None for x in side] for side in ([s[0] for s in split], [s[2] for s in split]))
                middles = [np.array(encoder.ids(s[1]), dtype="<u4").tobytes() for s in split]
                arrays = [part.column(f.name) for f in keys]
                for side, found in ((0, heads), (2, tails)):
                    if side:
                        arrays.append(pa.array(middles, pa.binary()))
                    arrays.append(pa.array([s[side] for s in split], pa.string()))
                    arrays.append(pa.array([f and f[0] for f in found], ints))
                    arrays.append(pa.array([f and [x for span in f[1] for x in span] for f in found], ints))
                yield pa.RecordBatch.from_arrays(arrays, names=coded.names)

    def join(group: pa.Table) -> pa.Table:
        def edge(row: dict, side: str) -> Edge | None:
            if row[f"{side}_ids"] is None:
                return None
            at = row[f"{side}_at"]
            return Edge(row[side], (row[f"{side}_ids"], list(zip(at[::2], at[1::2], strict=True))))

        nodes = [Node(edge(r, "_head"), np.frombuffer(r["_middle"], dtype="<u4").tolist(), edge(r, "_tail")) for r in group.sort_by("_leaf").to_pylist()]
        made = values([texts_of(concatenated(path, nodes))])
        first = group.slice(0, 1)
        return pa.table([*(first.column(c) for c in id_cols), *(pa.array(made[f.name]) for f in fields)], names=[*id_cols, *(f.name for f in fields)])

    def texts_of(ids: list[int]) -> tuple[int, str, str]:
        return len(ids), " ".join(map(str, ids)), tokenizer_of(path).decode(ids, skip_special_tokens=False)

    leaves = held.mapInArrow(cut, leaf).repartition(F.col("_key"), F.col("_leaf")).mapInArrow(encode, coded)
    return out.unionByName(leaves.groupBy("_key").applyInArrow(join, T.StructType([*id_fields, *fields])))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(table(spark, sf_dir, "documents"), digests=True)
