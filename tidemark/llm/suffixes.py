"""Removal of repeated byte strings by merging Burrows-Wheeler transforms.

A string of WINDOW bytes is owned by its anchor, the place in it where the hash
of K bytes is smallest. Equal strings have equal anchors, so strings of
different anchor keys never have to meet, and the suffixes to compare fall apart
into many small texts: the contexts of the anchors of one key, each the bytes of
all windows that an anchor owns. Contexts that are alike are kept once, with
their number; a key with a single context has nothing to be merged with.

For the others, shards of contexts get a transform of their own, over symbols of
STEP bytes, and transforms are merged by iterative interleave refinement: round
by round the interleaving of the two suffix orders is refined by one symbol more,
moving through the transforms only and never sorting the suffixes of both
together. The blocks that WINDOW / STEP rounds leave are the intervals of
suffixes whose common prefix is WINDOW bytes or more. A window is repeated when
its interval has more than one member.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import steps, table, text_or_empty, written

WINDOW = 200
K = 32
STEP = 50
#: Anchors in one packed bucket, and bytes of contexts in one merge, about.
BUCKET_ANCHORS = 400_000
MERGE_BYTES = 1 << 19
#: Anchors, and windows of heavy keys, among which a task looks for equal ones before it sends any.
COMBINED_ANCHORS = 400_000
COMBINED_WINDOWS = 100_000
#: Shards of a merge, if each has so many bytes; two at least.
SHARDS = 8
SHARD_BYTES = 1 << 16
#: Places of an anchor in a window that are looked at together when contexts are compared by what such windows must have in common.
SPAN = 22
#: A key with more contexts than this has its windows dealt out one by one instead, by their bytes.
KEY_CONTEXTS = 4096
_PIECE = 8 << 20
#: Bytes of a block of rolling hashes, and of texts that go through the steps of their anchors together.
_BLOCK = 1 << 14
_TOGETHER = 1 << 17
_PLACE = np.uint64((1 << 24) - 1)
_P = 0x9E3779B97F4A7C15
_SENT = np.dtype([("key", "<u8"), ("start", "<u4"), ("windows", "<u2"), ("many", "u1"), ("heavy", "u1")])


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.random.default_rng(20).integers(0, 1 << 64, 256, dtype=np.uint64)


@lru_cache(maxsize=1)
def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and of its inverse, for the places of a block."""
    inverse = pow(_P, -1, 1 << 64)
    return tuple(np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(_BLOCK, base, dtype=np.uint64)])) for base in (_P, inverse))


def rolling(data: np.ndarray, size: int) -> np.ndarray:
    """A polynomial hash of every ``size`` bytes, from running sums over blocks."""
    number = max(0, len(data) - size + 1)
    out = np.empty(number, dtype=np.uint64)
    up, down = powers()
    block = _BLOCK - size + 1
    for a in range(0, number, block):
        n = min(block, number - a)
        sums = np.zeros(n + size, dtype=np.uint64)
        np.cumsum(letters()[data[a : a + n + size - 1]] * down[: n + size - 1], out=sums[1:])
        h = (sums[size:] - sums[:n]) * up[size - 1 : size - 1 + n]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xC4CEB9FE1A85EC53)
        np.bitwise_xor(h, h >> np.uint64(29), out=out[a : a + n])
    return out


def anchors(data: np.ndarray, ends: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, first window and number of windows of each anchor of a text of at least WINDOW bytes.

    With ``ends`` of several such texts, one after the other in ``data``, windows that go over an end are none.
    """
    keys, starts, counts = [], [], []
    windows = len(data) - WINDOW + 1
    over = np.zeros(windows, dtype=bool)
    for end in [] if ends is None else ends[:-1].tolist():
        over[end - WINDOW + 1 : end] = True
    for a in range(0, windows, _PIECE):
        part = data[a : min(a + _PIECE, windows) + WINDOW - 1]
        h = rolling(part, K)
        # The smallest hash, and of equal ones the leftmost, of each window's K-byte strings.
        low = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
        span, wide = 1, WINDOW - K + 1
        while span * 2 <= wide:
            low, span = np.minimum(low[:-span], low[span:]), span * 2
        if wide > span:
            low = np.minimum(low[: span - wide], low[wide - span :])
        inside = np.flatnonzero(~over[a : a + len(low)])
        if not len(inside):
            continue
        place = (low[inside] & _PLACE).astype(np.int64)
        # Windows on both sides of an end have no place in common.
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        keys.append(h[place[first]])
        starts.append(inside[first] + a)
        counts.append(np.diff(np.concatenate([first, [len(place)]])))
    return np.concatenate(keys), np.concatenate(starts), np.concatenate(counts)


def anchors_of(texts: list[pa.Buffer]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``anchors`` of each text; texts that are short go through the steps together."""
    first = 0
    while first < len(texts):
        last, size = first + 1, len(texts[first])
        while last < len(texts) and size + len(texts[last]) <= _TOGETHER:
            size += len(texts[last])
            last += 1
        ends = np.cumsum([len(t) for t in texts[first:last]])
        key, start, count = anchors(np.concatenate([np.frombuffer(t, dtype=np.uint8) for t in texts[first:last]]), ends)
        begins = np.concatenate([[0], ends[:-1]])
        cuts = np.searchsorted(start, np.concatenate([begins, ends[-1:]]))
        for begin, x, y in zip(begins, cuts[:-1], cuts[1:], strict=True):
            yield key[x:y], start[x:y] - begin, count[x:y]
        first = last


def packed_runs(names: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> list[tuple[int, bytes]]:
    """By text: pairs of first window and number."""
    order = np.argsort(names, kind="stable")
    names, pairs = names[order], np.stack([starts[order], counts[order]], axis=1).astype("<u4")
    found, first = np.unique(names, return_index=True)
    ends = np.concatenate([first[1:], [len(names)]]).astype(int)
    return [(int(n), pairs[x:y].tobytes()) for n, x, y in zip(found, first, ends, strict=True)]


def packed_anchors(texts: DataFrame, buckets: int) -> DataFrame:
    """Anchors by bucket of their keys: of each text its name and number of anchors; key, context hash, first window, windows.

    Of the equal contexts that a task meets one is sent, marked as there more than once; the others are decided, and
    go along as (name, full), dealt by name. So what is sent of a context grows with the tasks, not with its places.
    """

    def combined(held: list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        name = np.repeat(np.array([h[0] for h in held], dtype=np.int64), [len(h[1]) for h in held])
        key, context, start, count = (np.concatenate([h[i] for h in held]) for i in range(1, 5))
        order = np.lexsort((context, key))
        new = np.concatenate([[True], (key[order][1:] != key[order][:-1]) | (context[order][1:] != context[order][:-1])])
        first, rest = order[new], order[~new]
        many = np.diff(np.concatenate([np.flatnonzero(new), [len(order)]])) > 1
        # By bucket, the anchors of a text side by side.
        bucket = (key[first] % np.uint64(buckets)).astype(np.int64)
        at = np.lexsort((name[first], bucket))
        first, many, bucket = first[at], many[at], bucket[at]
        rows: list[tuple] = []
        edges = np.searchsorted(bucket, np.arange(buckets + 1))
        for i in np.flatnonzero(np.diff(edges)).tolist():
            here = first[edges[i] : edges[i + 1]]
            owners = name[here]
            begins = np.flatnonzero(np.concatenate([[True], owners[1:] != owners[:-1]]))
            numbers = np.diff(np.concatenate([begins, [len(owners)]]))
            packed = (owners[begins].tobytes(), numbers.astype("<u4").tobytes(), key[here].tobytes(), context[here].tobytes(), start[here].astype("<u4").tobytes(), count[here].astype("u1").tobytes())
            rows.append((i, *packed, many[edges[i] : edges[i + 1]].astype("u1").tobytes(), None, None))
        if len(rest):
            rows += [(n % buckets, *[None] * 7, n, runs) for n, runs in packed_runs(name[rest], start[rest], count[rest])]
        kinds = [pa.int32(), *[pa.binary()] * 7, pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["bucket", "names", "numbers", "keys", "contexts", "starts", "counts", "many", "name", "full"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        held: list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        number = 0
        with np.errstate(over="ignore"):
            for batch in batches:
                fresh: dict[int, pa.Buffer] = {}
                for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    if name not in done:
                        done.add(name)
                        fresh[name] = text.as_buffer()
                for (name, raw), (k, s, n) in zip(fresh.items(), anchors_of(list(fresh.values())), strict=True):
                    view = memoryview(raw)
                    contexts = np.array([xxhash.xxh3_64_intdigest(view[x:y]) for x, y in zip(s.tolist(), (s + n + WINDOW - 1).tolist(), strict=True)], dtype=np.uint64)
                    held.append((name, k, contexts, s, n))
                    number += len(k)
                    if number >= COMBINED_ANCHORS:
                        yield combined(held)
                        held, number = [], 0
                if len(done) > 1_000_000:
                    done.clear()
            if held:
                yield combined(held)

    return texts.select("_name", "_text").mapInArrow(run, "bucket int, names binary, numbers binary, keys binary, contexts binary, starts binary, counts binary, many binary, name long, full binary")


def marked(group: pa.Table, key_contexts: int) -> pa.Table:
    """Of one bucket, by text: windows known to be repeated (pairs of first and number), and the contexts to be merged."""
    names = ["name", "full", "sent", "bytes"]
    decided = group.filter(group.column("name").is_valid())
    group = group.filter(group.column("name").is_null())
    passed = pa.table([decided.column("name"), decided.column("full"), pa.array([b""] * len(decided), pa.binary()), pa.array([0] * len(decided), pa.int64())], names=names)
    if not len(group):
        return passed

    def column(name: str, kind: str) -> np.ndarray:
        return np.concatenate([np.frombuffer(x, dtype=kind) for x in group.column(name).to_pylist()])

    name = np.repeat(column("names", "<i8"), column("numbers", "<u4"))
    key, context, start, count, many = column("keys", "<u8"), column("contexts", "<u8"), column("starts", "<u4"), column("counts", "u1"), column("many", "u1")
    order = np.lexsort((1 - many.astype(np.int8), start, name, context, key))
    name, key, context, start, count, many = (x[order] for x in (name, key, context, start, count, many))
    # Tasks may have sent the same text; the first of its rows says whether any has met the context again.
    once = np.concatenate([[True], (name[1:] != name[:-1]) | (start[1:] != start[:-1]) | (key[1:] != key[:-1]) | (context[1:] != context[:-1])])
    name, key, context, start, count, many = (x[once] for x in (name, key, context, start, count, many))
    new_key = np.concatenate([[True], key[1:] != key[:-1]])
    new_context = new_key | np.concatenate([[True], context[1:] != context[:-1]])
    of_context = np.cumsum(new_context) - 1
    of_key = np.cumsum(new_key) - 1
    members = np.bincount(of_context, weights=1 + many.astype(np.int64))[of_context]
    contexts = np.bincount(of_key, weights=new_context)[of_key]
    full = members > 1
    send = (contexts > 1) & new_context
    kept = full | send
    name, key, start, count, full, send, contexts = (x[kept] for x in (name, key, start, count, full, send, contexts))
    order = np.argsort(name, kind="stable")
    name, key, start, count, full, send, contexts = (x[order] for x in (name, key, start, count, full, send, contexts))
    if not len(name):
        return passed
    sent = np.zeros(len(name), dtype=_SENT)
    sent["key"], sent["start"], sent["windows"], sent["many"], sent["heavy"] = key, start, count, full, contexts > key_contexts
    runs = np.stack([start, count.astype("<u4")], axis=1).astype("<u4")
    found, first = np.unique(name, return_index=True)
    ends = np.concatenate([first[1:], [len(name)]])
    spans = list(zip(first, ends, strict=True))
    told = pa.table(
        [
            pa.array(found, pa.int64()),
            pa.array([runs[a:b][full[a:b]].tobytes() for a, b in spans], pa.binary()),
            pa.array([sent[a:b][send[a:b]].tobytes() for a, b in spans], pa.binary()),
            pa.array([int((sent["windows"][a:b][send[a:b]].astype(int) + WINDOW - 1).sum()) for a, b in spans], pa.int64()),
        ],
        names=names,
    )
    return pa.concat_tables([told, passed])


def marks_of(packed: DataFrame) -> DataFrame:
    """``marked`` of each bucket."""
    most = KEY_CONTEXTS

    def run(group: pa.Table) -> pa.Table:
        return marked(group, most)

    return packed.groupBy("bucket").applyInArrow(run, "name long, full binary, sent binary, bytes long")


def contexts_of(rows: DataFrame, merges: int) -> DataFrame:
    """The contexts to be merged, dealt out by key; of a heavy key each window for itself, dealt out by its bytes.

    Of the equal windows that a task meets one is sent, marked as there more than once; the others are decided, and go
    along as (name, full), dealt by name.
    """
    kinds = {"merge": pa.int32(), "name": pa.int64(), "start": pa.int64(), "many": pa.int8(), "context": pa.binary(), "full": pa.binary()}

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds.values())], names=list(kinds))

    def combined(windows: dict[bytes, list], again: list[tuple[int, int]]) -> pa.RecordBatch:
        out: list[tuple] = [(int.from_bytes(digest[:6], "little") % merges, *one, None) for digest, one in windows.items()]
        if again:
            places = np.array(again, dtype=np.int64)
            places = places[np.lexsort((places[:, 1], places[:, 0]))]
            new = np.concatenate([[True], (places[1:, 0] != places[:-1, 0]) | (places[1:, 1] != places[:-1, 1] + 1)])
            at = np.flatnonzero(new)
            number = np.diff(np.concatenate([at, [len(places)]]))
            out += [(n % merges, n, 0, 0, None, runs) for n, runs in packed_runs(places[at, 0], places[at, 1], number)]
        return batch_of(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        windows: dict[bytes, list] = {}
        again: list[tuple[int, int]] = []
        for batch in batches:
            for a, b in steps(batch.column("_text")):
                out: list[tuple] = []
                for row in batch.slice(a, b - a).to_pylist():
                    if row["name"] in done:
                        continue
                    done.add(row["name"])
                    data = row["_text"].encode()
                    for part in row["sent"]:
                        for s in np.frombuffer(part, dtype=_SENT).tolist():
                            key, start, count, many, heavy = s
                            if not heavy:
                                out.append((xxhash.xxh3_64_intdigest(key.to_bytes(8, "little")) % merges, row["name"], start, many, data[start : start + count + WINDOW - 1], None))
                                continue
                            for p in range(start, start + count):
                                one = data[p : p + WINDOW]
                                digest = xxhash.xxh3_128_digest(one)
                                met = windows.get(digest)
                                if met is None:
                                    windows[digest] = [row["name"], p, many, one]
                                else:
                                    met[2] = 1
                                    again.append((row["name"], p))
                            if len(windows) >= COMBINED_WINDOWS or len(again) >= 10 * COMBINED_WINDOWS:
                                yield combined(windows, again)
                                windows, again = {}, []
                if len(done) > 1_000_000:
                    done.clear()
                if out:
                    yield batch_of(out)
        if windows:
            yield combined(windows, again)

    return rows.mapInArrow(run, "merge int, name long, start long, many tinyint, context binary, full binary")


class Transform:
    """Contexts as one text, its suffixes in order, and what stands before each of them.

    Symbols are numbers of STEP bytes. ``before`` has, suffix by suffix in order,
    the symbol that stands before it, or -1 where its context begins within STEP
    bytes; ``ends`` are the symbols of the suffixes that are one symbol long, in
    order. ``block`` numbers the intervals of suffixes with the same WINDOW bytes
    in front.
    """

    def __init__(self, order: np.ndarray, before: np.ndarray, ends: np.ndarray, block: np.ndarray) -> None:
        self.order, self.before, self.ends, self.block = order, before, ends, block


def refine(before: np.ndarray, ends: np.ndarray, block: np.ndarray, first: bool, extra: list[tuple[np.ndarray, np.ndarray]]) -> tuple[list[np.ndarray], np.ndarray]:
    """One round: from an order and its blocks to those by one symbol more.

    ``before`` is the symbol before each suffix in the present order. The suffixes
    one symbol long come first among those of their symbol; after the first round,
    which compares that symbol alone, each is a block by itself. ``extra`` are
    arrays to be carried along: over ``ends`` and over the present order.
    """
    has = before >= 0
    symbol = np.concatenate([ends, before[has]])
    alone = np.zeros(len(ends), dtype=np.int32) if first else -1 - np.arange(len(ends), dtype=np.int32)
    source = np.concatenate([alone, block[has]])
    order = stable_order(symbol)
    symbol, source = symbol[order], source[order]
    new = np.concatenate([[True], (symbol[1:] != symbol[:-1]) | (source[1:] != source[:-1])]) if len(symbol) else np.zeros(0, bool)
    return [np.concatenate([x, y[has]])[order] for x, y in extra], np.cumsum(new, dtype=np.int32) - 1


def stable_order(symbol: np.ndarray) -> np.ndarray:
    """Stable order of numbers below 2^32, by two passes over their halves."""
    order = np.argsort((symbol & 0xFFFF).astype(np.uint16), kind="stable")
    if len(symbol) and int(symbol.max()) > 0xFFFF:
        order = order[np.argsort((symbol >> 16).astype(np.uint16)[order], kind="stable")]
    return order


def transform_of(symbol: np.ndarray, follows: np.ndarray, precedes: np.ndarray) -> Transform:
    """The transform of one shard: its suffixes ordered by as many symbols as a window has."""
    is_end = follows < 0
    ends = np.flatnonzero(is_end).astype(np.int32)
    before = np.where(precedes >= 0, symbol[np.maximum(precedes, 0)], np.int32(-1))
    order, block = np.arange(len(symbol), dtype=np.int32), np.zeros(len(symbol), dtype=np.int32)
    for k in range(WINDOW // STEP):
        (order,), block = refine(before[order], symbol[ends], block, k == 0, [(ends, precedes[order])])
    return Transform(order, before[order], symbol[order[is_end[order]]], block)


def merge(parts: list[Transform]) -> tuple[np.ndarray, np.ndarray]:
    """Order and blocks of the suffixes of all shards together, from the interleaving of their orders; no suffix is compared."""
    of_part = np.arange(len(parts), dtype=np.int8)
    side = np.repeat(of_part, [len(p.order) for p in parts])
    end_side = np.repeat(of_part, [len(p.ends) for p in parts])
    ends = np.concatenate([p.ends for p in parts])
    before = np.concatenate([p.before for p in parts])
    block = np.zeros(len(side), dtype=np.int32)

    def woven(x: np.ndarray) -> np.ndarray:
        """The shards' values one after the other, in the order that the sides say."""
        out = np.empty_like(x)
        out[np.argsort(side, kind="stable")] = x
        return out

    for k in range(WINDOW // STEP):
        # The merged transform is read off those of the shards by the interleaving alone.
        (side,), block = refine(woven(before), ends, block, k == 0, [(end_side, side)])
    return woven(np.concatenate([p.order for p in parts])), block


def repeated_windows(texts: list[bytes], many: np.ndarray) -> np.ndarray:
    """For each window of the contexts, one after the other, whether it is in more than one of them, or in one that there is more than once."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    starts = np.cumsum(sizes) - sizes
    suffixes = sizes - STEP + 1
    at = np.repeat(starts - (np.cumsum(suffixes) - suffixes), suffixes) + np.arange(int(suffixes.sum()))
    _, symbol = np.unique(rolling(data, STEP)[at], return_inverse=True)
    symbol = symbol.astype(np.int32)
    owner = np.repeat(np.arange(len(texts)), suffixes)
    index = np.arange(len(at), dtype=np.int32)
    follows = np.where(at + 2 * STEP <= (starts + sizes)[owner], index + np.int32(STEP), np.int32(-1))
    precedes = np.where(at - STEP >= starts[owner], index - np.int32(STEP), np.int32(-1))
    # Shards are cut between contexts; their transforms are merged all at once.
    last = np.cumsum(suffixes)
    count = max(2, min(SHARDS, int(sizes.sum()) // SHARD_BYTES))
    middles = np.searchsorted(last, len(at) * np.arange(1, count) // count) + 1
    cuts = np.unique([0, *last[np.minimum(middles, len(last)) - 1], len(at)]).tolist()

    def part(a: int, b: int) -> Transform:
        shift = np.int32(a)
        whole = transform_of(symbol[a:b], np.where(follows[a:b] < 0, np.int32(-1), follows[a:b] - shift), np.where(precedes[a:b] < 0, np.int32(-1), precedes[a:b] - shift))
        whole.order = whole.order + shift
        return whole

    shards = [part(a, b) for a, b in itertools.pairwise(cuts)]
    order, block = merge(shards) if len(shards) > 1 else (shards[0].order, shards[0].block)
    is_window = at + WINDOW <= (starts + sizes)[owner]
    weight = np.where(is_window, 1 + many[owner], 0)[order]
    hit = np.zeros(len(at), dtype=bool)
    hit[order] = np.bincount(block, weights=weight)[block] > 1
    return hit[is_window]


def shareable(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of windows that may be in another context too: context, first window and number of windows.

    All windows of a context have one anchor, and equal windows have it at the same place. Those that have it at one of
    SPAN places share the bytes in their middle, so a context that has these with no other of its key has none of them in common.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    starts = np.cumsum(sizes) - sizes
    h = rolling(data, K)
    inside = np.arange(len(data)) - np.repeat(starts, sizes)
    low = np.append((h & ~_PLACE) | inside[: len(h)].astype(np.uint64), np.uint64(0))
    # The smallest of a context's hashes is that of its anchor.
    anchor = (np.minimum.reduceat(low, np.stack([starts, starts + sizes - K + 1], axis=1).ravel())[::2] & _PLACE).astype(np.int64)
    windows = sizes - WINDOW + 1
    lowest, highest = (anchor - windows + 1) // SPAN, anchor // SPAN
    number = highest - lowest + 1
    context = np.repeat(np.arange(len(texts)), number)
    span = np.repeat(lowest - (np.cumsum(number) - number), number) + np.arange(int(number.sum()))
    middle = rolling(data, WINDOW - SPAN + 1)[(starts + anchor)[context] - span * SPAN]
    key = h[starts + anchor][context]
    order = np.lexsort((middle, span, key))
    same = (key[order][1:] == key[order][:-1]) & (span[order][1:] == span[order][:-1]) & (middle[order][1:] == middle[order][:-1])
    met = np.zeros(len(order), dtype=bool)
    met[order] = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    # Spans that follow one another are one stretch; windows go the other way.
    context, span = context[met], span[met]
    new = np.concatenate([[True], (context[1:] != context[:-1]) | (span[1:] != span[:-1] + 1)]) if len(context) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    until = np.append(at[1:], len(context)) - 1
    context, top, bottom = context[at], span[until] * SPAN + SPAN - 1, span[at] * SPAN
    first = np.maximum(anchor[context] - top, 0)
    return context, first, np.minimum(anchor[context] - bottom, windows[context] - 1) - first + 1


def merged(group: pa.Table) -> pa.Table:
    """Of one merge: for each text the repeated windows (pairs of first and number)."""
    decided = group.filter(group.column("context").is_null()).select(["name", "full"])
    # Tasks may have sent the contexts of the same text; one that any has met again counts as more.
    rows: dict[tuple[int, int, int], list] = {}
    for r in group.filter(group.column("context").is_valid()).select(["name", "start", "many", "context"]).to_pylist():
        row = rows.setdefault((r["name"], r["start"], len(r["context"])), [r["context"], 0])
        row[1] = max(row[1], r["many"])
    texts = [r[0] for r in rows.values()]
    names = [k[:2] for k in rows]
    if not texts:
        return decided
    many = np.array([r[1] for r in rows.values()], dtype=np.int64)
    windows = np.array([len(t) - WINDOW + 1 for t in texts])
    hit = np.repeat(many > 0, windows)
    with np.errstate(over="ignore"):
        context, begin, number = shareable(texts)
        if len(context):
            found = repeated_windows([texts[c][a : a + n + WINDOW - 1] for c, a, n in zip(context.tolist(), begin.tolist(), number.tolist(), strict=True)], many[context])
            begin = (np.cumsum(windows) - windows)[context] + begin
            hit[np.repeat(begin - (np.cumsum(number) - number), number) + np.arange(int(number.sum()))] = found
    out: dict[int, list[np.ndarray]] = {}
    first = 0
    for (name, start), text in zip(names, texts, strict=True):
        n = len(text) - WINDOW + 1
        edges = np.flatnonzero(np.diff(np.concatenate([[0], hit[first : first + n].astype(np.int8), [0]])))
        first += n
        if len(edges):
            out.setdefault(name, []).append(np.stack([edges[::2] + start, edges[1::2] - edges[::2]], axis=1))
    told = pa.table([pa.array(list(out), pa.int64()), pa.array([np.concatenate(x).astype("<u4").tobytes() for x in out.values()], pa.binary())], names=["name", "full"])
    return pa.concat_tables([told, decided])


def repeated_runs(texts: DataFrame) -> DataFrame:
    """name and runs: of each text with repeated windows, packed pairs of their first place and number.

    ``texts`` has _name, a hash of the text, and _text. Copies of a text are looked at once.
    """
    size = texts.agg(F.sum(F.octet_length("_text")), F.count(F.lit(1))).first()
    total = size[0] or 0
    long = texts.filter(F.octet_length("_text") >= WINDOW)
    # A K-byte string is an anchor about twice in WINDOW - K + 2 places.
    buckets = max(8, math.ceil(2 * total / (WINDOW - K + 2) / BUCKET_ANCHORS))
    marks = written(marks_of(packed_anchors(long, buckets)))
    merges = max(8, math.ceil((marks.agg(F.sum("bytes")).first()[0] or 0) / MERGE_BYTES))
    wanted = marks.filter(F.octet_length("sent") > 0).groupBy("name").agg(F.collect_list("sent").alias("sent"))
    dealt = contexts_of(long.join(wanted, F.col("_name") == F.col("name")).select("name", "_text", "sent"), merges)
    found = dealt.groupBy("merge").applyInArrow(merged, "name long, full binary")
    # A text that there is twice repeats all of its windows.
    copies = long.groupBy(F.col("_name").alias("name")).agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("_text")).alias("size")).filter("n > 1")
    whole = copies.select("name", F.col("size").alias("whole"))
    runs = marks.select("name", "full").unionByName(found).filter(F.octet_length("full") > 0).groupBy("name").agg(F.collect_list("full").alias("runs"))
    return written(runs.join(whole, "name", "full"))


def spans_of(runs: list[bytes] | None, whole: int | None, size: int) -> list[tuple[int, int]]:
    """The maximal covered stretches of a text, end exclusive."""
    if whole is not None:
        return [(0, size)]
    if not runs:
        return []
    pairs = np.concatenate([np.frombuffer(r, dtype="<u4").reshape(-1, 2) for r in runs]).astype(np.int64)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    starts, ends = pairs[:, 0], np.maximum.accumulate(pairs[:, 0] + pairs[:, 1] + WINDOW - 1)
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    first = np.flatnonzero(new)
    return list(zip(starts[first].tolist(), ends[np.concatenate([first[1:] - 1, [len(ends) - 1]])].tolist(), strict=True))


FIELDS = [T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType()), T.StructField("kept", T.BinaryType())]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = False) -> DataFrame:
    """One row per document: ``id_col``, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the bytes that stay).

    Null texts count as empty. Texts are UTF-8 bytes, so what stays may begin or
    end inside a character. Repeated rows are copies and repeat each other;
    other columns are ignored; no rows give no rows.
    """
    texts = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    # Texts without a window repeat nothing; many of them are equal, so they are told apart by their ids.
    texts = texts.withColumn("_name", F.when(F.octet_length("_text") >= WINDOW, F.xxhash64("_text", F.octet_length("_text"))).otherwise(F.xxhash64("_id", "_text")))
    runs = repeated_runs(texts.select("_name", "_text"))
    joined = texts.join(runs, F.col("_name") == F.col("name"), "left").select("_id", "_text", "runs", "whole")
    fields = FIELDS if with_kept else FIELDS[:-1]
    id_field = T.StructField(id_col, docs.schema[id_col].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, run_list, whole in zip(batch.column("_text"), batch.column("runs").to_pylist(), batch.column("whole").to_pylist(), strict=True):
                data = memoryview(text.as_buffer())
                spans = spans_of(run_list, whole, len(data)) if len(data) >= WINDOW else []
                digest, at, kept = hashlib.sha256(), 0, []
                for a, b in [*spans, (len(data), len(data))]:
                    digest.update(data[at:a])
                    if with_kept:
                        kept.append(bytes(data[at:a]))
                    at = b
                out.append((len(data), sum(b - a for a, b in spans), len(spans), digest.hexdigest(), b"".join(kept)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("_id"), *(pa.array([o[i] for o in out], kinds[i]) for i in range(len(fields)))], names=[id_col, *(f.name for f in fields)])

    return joined.mapInArrow(run, T.StructType([id_field, *fields]))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
