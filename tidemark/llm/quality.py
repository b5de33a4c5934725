"""Text quality by an interpolated modified Kneser-Ney model of trusted text.

The model is over words, three in a row, and holds every n-gram of the trusted
documents, so it grows with them. It lives in tables only: trigrams are counted
and summed by a shuffle; the counts of shorter n-grams are numbers of different
words to the left; discounted counts are joined with the sums of their contexts
and with the order below. Names of words and n-grams are 64-bit hashes.

A document's log probability is a sum over its n-grams of all orders. Take off
from each seen n-gram's log probability what its context's back-off and the order
below would have given: then a token's probability is the sum of what its three
n-grams and their contexts are worth, and an unseen n-gram is worth nothing.

Each word moves about five n-grams, so all of them at once take many times the
disk of the text. All that an n-gram's worth needs but the words' own counts
stands with the same middle word: bigrams by their contexts, trigrams by the word
between. So the work goes in rounds over these words. A first sweep counts words
and takes the discounts; then each round counts and joins its part of the model,
sends its n-grams of some documents at a time, packed by buckets of names, looks
them up there and leaves a sum a document. A round's tables and shuffle files are
deleted before the next one; the texts are read again in each round. Perplexity
is compared with a quantile of trusted documents of the same language that the
model has not seen.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, steps, table, written

#: A document is not kept above SLACK times this quantile of its language's trusted documents.
QUANTILE = 0.99
SLACK = 1.1
#: One in so many trusted documents is not counted but gives the quantiles, as counted ones look better than they are.
HELD = 4
#: Bytes of texts turned into n-grams at a time, so that what is between fits a CPU's cache.
PIECE = 1 << 17
#: The n-grams are counted, joined and summed in so many rounds, by a word of theirs: disk holds those of one round. Texts of fewer times ROUND_BYTES take fewer.
ROUNDS = 12
ROUND_BYTES = 12 << 20
#: Bytes of text whose n-grams of a round meet in one bucket, about 0.8 of an n-gram each.
BUCKET_BYTES = 10 << 20
_START = np.uint64(0x2545F4914F6CDD1D)
_SPACE = re.compile(rb"[ \t-\r]")
_INSIDE = np.array([not (x == 32 or 9 <= x <= 13) for x in range(256)], dtype=np.int8)
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_OFTEN = [f"{x}{k}" for x in "bt" for k in range(1, 5)]
_SUMS = pa.schema([("part", pa.int64()), ("docs", pa.binary()), ("places", pa.binary()), ("sums", pa.binary())])


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Within, a query's shuffle files go when it ends: each is read once, and the next round needs the disk."""
    was = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if was is None else spark.conf.set(_CLEANUP, was)


class Names:
    """64-bit names of all words of a text at once: sums over their bytes times powers of an odd number, scrambled."""

    ODD = 0x9FB21C651E98DF25

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def __call__(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The words' names and where they begin."""
        size = len(data)
        if size > len(self.up):
            most = size + size // 4 + 1
            self.up, self.down = (np.cumprod(np.where(np.arange(most) == 0, np.uint64(1), np.uint64(x))) for x in (self.ODD, pow(self.ODD, -1, 1 << 64)))
        codes = np.frombuffer(data, dtype=np.uint8)
        inside = np.zeros(size + 2, dtype=np.int8)
        inside[1:-1] = _INSIDE[codes]
        edges = np.diff(inside)
        start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum((codes + np.uint64(1)) * self.up[:size], out=sums[1:])
        return mixed((sums[end] - sums[start]) * self.down[start], 0).view(np.uint64), start


def mixed(x: np.ndarray, order: int) -> np.ndarray:
    """The name of an n-gram of ``order`` from a sum over its words' names; scrambled, so that orders do not meet."""
    x = x + np.uint64(0x9E3779B97F4A7C15 * order & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))).view(np.int64)


def in_round(words: np.ndarray, which: int, rounds: int) -> np.ndarray:
    """Where the round of a word's name is ``which``."""
    return (words & np.uint64(0xFFFFFF)) * np.uint64(rounds) >> np.uint64(24) == which


def occurrences(texts: list[bytes], names: Names) -> Iterator[tuple[np.ndarray, ...]]:
    """For each word of the texts, about PIECE bytes at a time: the text's number, the names of the two words before and its own."""
    held, numbers, size = [], [], 0
    w, doc = np.full(2, _START, dtype=np.uint64), np.full(2, -1)

    def made() -> tuple[np.ndarray, ...]:
        nonlocal w, doc
        found, start = names(b"\n".join(held))
        bounds = np.cumsum([0] + [len(x) + 1 for x in held[:-1]])
        w = np.concatenate([w[-2:], found])
        doc = np.concatenate([doc[-2:], np.array(numbers)[np.searchsorted(bounds, start, "right") - 1]])
        own = doc[2:]
        return own, np.where(doc[:-2] == own, w[:-2], _START), np.where(doc[1:-1] == own, w[1:-1], _START), w[2:]

    for number, text in enumerate(texts):
        at = 0
        while at < len(text):
            cut = _SPACE.search(text, at + PIECE) if len(text) - at > PIECE else None
            to = cut.start() if cut else len(text)
            held.append(text[at:to])
            numbers.append(number)
            size, at = size + to - at, to
            if size >= PIECE:
                yield made()
                held, numbers, size = [], [], 0
    if held:
        yield made()


def five(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, ...]:
    """Names of the trigram, of the bigram before as its context, of the bigram it ends, of the word before as context, of the last word."""
    odd, other = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
    return mixed(a * odd + b * other + c, 3), mixed(a * other + b, 4), mixed(b * other + c, 2), mixed(b, 5), c.view(np.int64)


def grams(text: str, names: Names) -> Iterator[tuple[np.ndarray, ...]]:
    """For each word of a text the names of ``five``."""
    for _, a, b, c in occurrences([text.encode()], names):
        yield five(a, b, c)


def of_round(texts: list[bytes], names: Names, which: int, rounds: int) -> list[np.ndarray]:
    """The texts' numbers and the names of ``five`` where the word before the last is of the round."""
    found = [[np.zeros(0, dtype=np.int64)] * 6]
    for doc, a, b, c in occurrences(texts, names):
        some = np.flatnonzero(in_round(b, which, rounds)) if rounds > 1 else slice(None)
        found.append([doc[some], *five(a[some], b[some], c[some])])
    return [np.concatenate(x) for x in zip(*found, strict=True)]


def texts_of(column: pa.Array, at: int, to: int) -> list[bytes]:
    return [x or b"" for x in column.slice(at, to - at).cast(pa.binary()).to_pylist()]


def count_trigrams(texts: DataFrame, which: int = 0, rounds: int = 1) -> DataFrame:
    """gram, context, rest, second, last and n of the trigrams of the one text column whose middle word is of the round, a row a task's step.

    ``rest`` is the trigram without its first word, ``second`` its middle and ``last`` its last word.
    """
    columns = ["gram", "context", "rest", "second", "last"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Names()
        for batch in batches:
            for at, to in steps(batch.column(0)):
                _, *whole = of_round(texts_of(batch.column(0), at, to), names, which, rounds)
                _, first, n = np.unique(whole[0], return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([*[pa.array(x[first]) for x in whole], pa.array(n)], names=[*columns, "n"])

    return texts.mapInArrow(run, ", ".join(f"{c} long" for c in (*columns, "n")))


def packed_trigrams(texts: DataFrame, which: int, rounds: int, buckets: int) -> DataFrame:
    """For each step of a task and bucket of bigrams the packed bigrams at the end of the round's trigrams, with trigram and last word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Names()
        for batch in batches:
            for at, to in steps(batch.column(0)):
                _, gram, _, rest, _, last = of_round(texts_of(batch.column(0), at, to), names, which, rounds)
                order = np.argsort(rest.view(np.uint64))
                yield blocks(rest[order], buckets, [x[order] for x in (gram, rest, last)], ["gram", "rest", "last"])

    return texts.mapInArrow(run, "bucket long, gram binary, rest binary, last binary")


def blocks(name: np.ndarray, buckets: int, columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    """Columns sorted by ``name`` as a row a bucket."""
    cut = np.searchsorted(bucket_of(name, buckets), np.arange(buckets + 1))
    full = np.flatnonzero(np.diff(cut)).tolist()
    return pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), *[pa.array([x[cut[k] : cut[k + 1]].tobytes() for k in full], pa.binary()) for x in columns]], names=["bucket", *names])


def bucket_of(name: np.ndarray, buckets: int) -> np.ndarray:
    return ((name.view(np.uint64) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def counted(rows: pa.Table) -> pa.Table:
    """How many different bigrams of a bucket end in each word; in a row without one, how many bigrams and trigrams occur once to four times."""
    gram, rest, last = (np.frombuffer(b"".join(rows[c].to_pylist()), dtype=np.int64) for c in ("gram", "rest", "last"))
    _, first, n = np.unique(gram, return_index=True, return_counts=True)
    _, second, left = np.unique(rest[first], return_index=True, return_counts=True)
    words, ends = np.unique(last[first][second], return_counts=True)
    often = [[0] * len(words) + [int((x == k).sum())] for x in (left, n) for k in range(1, 5)]
    return pa.table([pa.array([*words.tolist(), None], pa.int64()), pa.array([*ends.tolist(), 0], pa.int64()), *[pa.array(x, pa.int64()) for x in often]], names=["gram", "n", *_OFTEN])


def discounts(found: list[float | None]) -> tuple[float, float, float]:
    """The three discounts of modified Kneser-Ney, from how many n-grams occur once to four times."""
    n1, n2, n3, n4 = (float(x or 0) for x in found)
    y = n1 / (n1 + 2 * n2) if n1 else 0.5

    def bounded(value: float, k: int) -> float:
        return min(max(value, 0.1), k - 0.1)

    return (
        bounded(1 - 2 * y * n2 / n1, 1) if n1 else 0.5,
        bounded(2 - 3 * y * n3 / n2, 2) if n2 else 1.0,
        bounded(3 - 4 * y * n4 / n3, 3) if n3 else 1.5,
    )


def off(cuts: tuple[float, float, float]) -> Column:
    """What is taken off a count ``n``."""
    return F.when(F.col("n") == 1, cuts[0]).when(F.col("n") == 2, cuts[1]).otherwise(cuts[2])


class Model:
    """What all rounds share, and the n-grams' worth round by round.

    ``unknown``: the log probability of a word never seen; ``p1``: gram and p, the log probability of each word alone;
    ``cuts``: the discounts of bigrams and of trigrams.
    """

    def __init__(self, texts: DataFrame, rounds: int, p1: DataFrame, unknown: float, cuts: list[tuple[float, float, float]], tables: list[DataFrame]) -> None:
        self.texts, self.rounds, self.p1, self.unknown, self.cuts, self.tables = texts, rounds, p1, unknown, cuts, tables

    @property
    def worth(self) -> DataFrame:
        """gram and worth of all rounds."""
        found = None
        for which in range(self.rounds):
            part, tables = self.part(which)
            self.tables += tables
            found = part if found is None else found.unionByName(part)
        return found

    def part(self, which: int) -> tuple[DataFrame, list[DataFrame]]:
        """gram and worth, in logarithms, of the n-grams of a round, and the tables that it reads."""
        # By context, so that totals need no shuffle of their own.
        third = count_trigrams(self.texts, which, self.rounds).repartition("context").groupBy("context", "gram")
        third = third.agg(F.first("rest").alias("rest"), F.first("second").alias("second"), F.first("last").alias("last"), F.sum("n").alias("n"))
        context, cut = Window.partitionBy("context"), off(self.cuts[1])
        total = F.sum("n").over(context)
        third = third.select(
            "gram", "context", "rest", "second", "last", ((F.col("n") - cut) / total).alias("seen"),
            F.log(F.sum(cut).over(context) / total).alias("backoff"), (F.row_number().over(context.orderBy("gram")) == 1).alias("once"),
        )
        third = written(third)
        second = written(third.groupBy("rest").agg(F.first("second").alias("context"), F.first("last").alias("last"), F.count(F.lit(1)).alias("n")))
        cut = off(self.cuts[0])
        contexts = second.groupBy("context").agg(F.sum("n").alias("total"), F.sum(cut).alias("mass"))
        contexts = written(contexts.select("context", "total", F.log(F.col("mass") / F.col("total")).alias("backoff")))
        joined = second.join(contexts, "context").join(self.p1.select(F.col("gram").alias("last"), F.col("p").alias("below")), "last")
        p = F.log((F.col("n") - cut) / F.col("total") + F.exp(F.col("backoff") + F.col("below")))
        p2 = written(joined.select("rest", p.alias("p"), (p - F.col("backoff") - F.col("below")).alias("worth")))
        discard(second)
        ends = third.join(p2.select("rest", F.col("p").alias("below")), "rest")
        lower = F.col("backoff") + F.col("below")
        parts = [
            ends.select("gram", (F.log(F.col("seen") + F.exp(lower)) - lower).alias("worth")),
            third.filter("once").select(F.col("context").alias("gram"), F.col("backoff").alias("worth")),
            p2.select(F.col("rest").alias("gram"), "worth"),
            contexts.select(F.col("context").alias("gram"), F.col("backoff").alias("worth")),
            self.p1.filter(F.shiftright(F.col("gram").bitwiseAND(F.lit(0xFFFFFF)) * self.rounds, 24) == which).select("gram", (F.col("p") - F.lit(self.unknown)).alias("worth")),
        ]
        worth = parts[0]
        for part in parts[1:]:
            worth = worth.unionByName(part)
        return worth, [third, contexts, p2]

    def discard(self) -> None:
        for one in self.tables:
            discard(one)


def text_bytes(rows: DataFrame, column: str) -> int:
    return rows.agg(F.sum(F.octet_length(F.col(f"`{column}`")))).first()[0] or 0


def fit(texts: DataFrame, n_bytes: int | None = None) -> Model | None:
    """The model of the one text column, for documents of ``n_bytes`` (its own, if not given); None where it has no word."""
    own = text_bytes(texts, texts.columns[0])
    n_bytes = max(own, n_bytes or 0)
    rounds = min(ROUNDS, 1 + n_bytes // ROUND_BYTES)
    sweeps = min(rounds, 1 + own * rounds // max(1, n_bytes))
    buckets = max(4 * texts.sparkSession.sparkContext.defaultParallelism, own // sweeps // BUCKET_BYTES)
    with released(texts.sparkSession):
        found = []
        for which in range(sweeps):
            # All trigrams that end in a bigram meet in its bucket.
            rows = packed_trigrams(texts, which, sweeps, buckets).groupBy("bucket")
            rows = rows.applyInArrow(counted, ", ".join(f"{c} long" for c in ("gram", "n", *_OFTEN)))
            found.append(written(rows.groupBy("gram").agg(*[F.sum(c).alias(c) for c in ("n", *_OFTEN)])))
        every = found[0]
        for one in found[1:]:
            every = every.unionByName(one)
        first = written(every.filter("gram is not null").groupBy("gram").agg(F.sum("n").alias("n")))
        words, total, *often = first.agg(F.count(F.lit(1)), F.sum("n"), *[F.count_if(F.col("n") == k) for k in range(1, 5)]).first()
        if not words:
            return None
        lower = off(discounts(often))
        often = every.agg(*[F.sum(c) for c in _OFTEN]).first()
        unknown = first.agg(F.sum(lower)).first()[0] / total / (words + 1)
        # One word: its discounted count, and an equal share of what is left for it and each other word, known or not.
        p1 = written(first.select("gram", F.log((F.col("n") - lower) / total + F.lit(unknown)).alias("p")))
        for one in (*found, first):
            discard(one)
        return Model(texts, rounds, p1, float(np.log(unknown)), [discounts(often[:4]), discounts(often[4:])], [p1])


def asked(rows: DataFrame, which: int, rounds: int, buckets: int) -> DataFrame:
    """Packed n-grams of a round: for each bucket of names and some documents at a time their different names, in how many documents each is, in which, and how many times.

    Rows without names give the documents' own names and numbers of words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, part = Names(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for at, to in steps(batch.column(1)):
                ids = batch.column(0).slice(at, to - at).to_numpy()
                found = [[np.zeros(0, dtype=np.int64)] * 7]
                words = np.zeros(len(ids), dtype=np.int64)
                for doc, a, b, c in occurrences(texts_of(batch.column(1), at, to), names):
                    words += np.bincount(doc, minlength=len(ids))
                    some, ends = (np.flatnonzero(in_round(x, which, rounds)) for x in (b, c))
                    found.append([doc[some], *five(a[some], b[some], c[some])[:4], doc[ends], c[ends].view(np.int64)])
                doc, *four, other, last = (np.concatenate(x) for x in zip(*found, strict=True))
                part += 1
                place, name = np.concatenate([doc] * 4 + [other]).astype(np.uint32), np.concatenate([*four, last]).view(np.uint64)
                order = np.argsort(name, kind="stable")
                name, place = name[order], place[order]
                first = np.flatnonzero(np.diff(name, prepend=~name[:1]).astype(bool) | np.diff(place, prepend=0).astype(bool))
                times = np.diff(np.append(first, len(name))).astype(np.uint32)
                name, place = name[first], place[first]
                new = np.flatnonzero(np.diff(name, prepend=~name[:1]))
                edges = np.append(new, len(place))
                name, often = name[new], np.diff(edges).astype(np.uint32)
                cut = np.searchsorted(bucket_of(name, buckets), np.arange(buckets + 1))
                keys, blobs = [part % buckets], [(None, None, ids.tobytes(), words.tobytes())]
                for k in np.flatnonzero(np.diff(cut)).tolist():
                    i, j = cut[k], cut[k + 1]
                    keys.append(k)
                    blobs.append((split(name[i:j]), split(often[i:j]), split(place[edges[i] : edges[j]]), split(times[edges[i] : edges[j]])))
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([part] * len(keys)), *[pa.array(x, pa.binary()) for x in zip(*blobs, strict=True)]], names=["bucket", "part", "names", "often", "places", "times"])

    return rows.select("_doc", "_text").mapInArrow(run, "bucket long, part long, names binary, often binary, places binary, times binary")


def split(x: np.ndarray) -> bytes:
    """All first bytes, then all second ones: sorted and small numbers so compress."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def joined(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(width, -1).T).view(kind).ravel()


def packed(worth: DataFrame, buckets: int) -> DataFrame:
    """gram and worth as packed rows, one for each bucket and some hundred thousand n-grams of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
                size += len(batch)
            if size and (batch is None or size >= 1 << 19):
                gram, value = (np.concatenate(x) for x in zip(*held, strict=True))
                order = np.argsort(gram.view(np.uint64))
                yield blocks(gram[order], buckets, [gram[order], value[order]], ["gram", "worth"])
                held, size = [], 0

    return worth.select("gram", "worth").mapInArrow(run, "bucket long, gram binary, worth binary")


def looked_up(asks: pa.Table, worth: pa.Table) -> pa.Table:
    """The worth of the n-grams asked for, summed by document; rows that name documents pass."""
    gram, value = (np.frombuffer(b"".join(worth[c].to_pylist()), dtype=kind) for c, kind in (("gram", np.int64), ("worth", np.float64)))
    order = np.argsort(gram)
    gram, value = np.append(gram[order], 0), np.append(value[order], 0.0)
    found: list[tuple] = []
    for part, names, often, places, times in zip(*(asks[c].to_pylist() for c in ("part", "names", "often", "places", "times")), strict=True):
        if names is None:
            found.append((part, places, times, None))
            continue
        name = joined(names, np.int64)
        at = np.searchsorted(gram[:-1], name)
        sums = np.repeat(np.where(gram[at] == name, value[at], 0.0) * (at < len(gram) - 1), joined(often, np.uint32))
        place, n = (joined(x, np.uint32).astype(np.int64) for x in (places, times))
        # Times are an odd number doubled some times: shares of a document's words are rounded for the odd ones only.
        twice = n & -n
        sums, odd = sums * twice, n // twice
        plain = odd == 1
        total = np.bincount(place[plain], sums[plain])
        some = np.flatnonzero(total)
        other, which = np.unique(place[~plain] << 32 | odd[~plain], return_inverse=True)
        keys = np.concatenate([some << 32 | 1, other])
        found.append((part, None, keys.tobytes(), np.concatenate([total[some], np.bincount(which, sums[~plain], len(other))]).tobytes()))
    return pa.table([pa.array(x, t) for x, t in zip(zip(*found, strict=True), (pa.int64(), *[pa.binary()] * 3), strict=True)], names=["part", "docs", "places", "sums"]) if found else _SUMS.empty_table()


def added(parts: pa.Table) -> pa.Table:
    """``_doc`` and ``_mean``, the worth a word, of the documents of one part."""
    rows = list(zip(*(parts[c].to_pylist() for c in ("docs", "places", "sums")), strict=True))
    ids, words = next((np.frombuffer(d, dtype=np.int64), np.frombuffer(n, dtype=np.int64)) for d, n, _ in rows if d is not None)
    total = np.zeros(len(ids))
    for docs, places, sums in rows:
        if docs is None:
            key = np.frombuffer(places, dtype=np.int64)
            place = key >> 32
            share = ((key & 0xFFFFFFFF) / words[place]).astype(np.float32)
            total += np.bincount(place, share * np.frombuffer(sums), len(ids))
    some = words > 0
    return pa.table({"_doc": ids[some], "_mean": total[some]})


def with_perplexity(rows: DataFrame, model: Model) -> DataFrame:
    """``_doc``, ``_id``, ``_lang`` of every row and its perplexity a word; null for a text without words."""
    spark = rows.sparkSession
    buckets = max(4 * spark.sparkContext.defaultParallelism, text_bytes(rows, "_text") // model.rounds // BUCKET_BYTES)
    found = []
    with released(spark):
        for which in range(model.rounds):
            worth, tables = model.part(which)
            worth = written(packed(worth, buckets))
            for one in tables:
                discard(one)
            asks = asked(rows, which, model.rounds, buckets).groupBy("bucket").cogroup(worth.groupBy("bucket"))
            sums = asks.applyInArrow(looked_up, "part long, docs binary, places binary, sums binary")
            found.append(written(sums.groupBy("part").applyInArrow(added, "_doc long, _mean double")))
            discard(worth)
    scores = found[0]
    for one in found[1:]:
        scores = scores.unionByName(one)
    # Rows of one id and text share a name, so their means are of all of them, and each round has its own.
    scores = scores.groupBy("_doc").agg((F.sum("_mean") * F.lit(model.rounds) / F.count(F.lit(1))).alias("_mean"))
    narrow = rows.select("_doc", "_id", "_lang").join(scores, "_doc", "left")
    return narrow.select("_doc", "_id", "_lang", F.exp(-(F.lit(model.unknown) + F.col("_mean"))).alias("perplexity"))


def classify_quality(docs: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", quantile: float = QUANTILE) -> DataFrame:
    """One row per document: ``id_col``, lang, perplexity, threshold, kept.

    ``trusted_ids`` has the ids whose text is trusted; null ids are in neither. A
    text that is null or has no words has no perplexity and is not kept. A language without
    trusted documents, or none, takes the quantile of all trusted ones; without
    any trusted document every text with words is kept, without perplexity. A perplexity equal to
    the threshold is kept. Repeated rows are judged each for itself, texts of any length are read
    whole; other columns are ignored; no rows give no rows. ``docs`` is read once for each of up to ROUNDS rounds, so hand in a table.
    """
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{lang_col}`").alias("_lang"), F.coalesce(text, F.lit("")).alias("_text"))
    rows = rows.withColumn("_doc", F.xxhash64("_id", "_text"))
    trusted = trusted_ids.select(F.col(id_col).alias("_id")).filter("_id is not null").distinct()
    held = F.pmod(F.xxhash64("_id", F.lit("held")), F.lit(HELD)) == 0
    # Written once, as each round reads them twice; the documents move only here.
    with released(rows.sparkSession):
        counted = written(rows.select("_id", "_text").join(trusted.filter(~held), "_id", "left_semi").select("_text"))
    model = fit(counted, text_bytes(rows, "_text"))
    if model is None:
        words = F.col("_text").rlike(r"[^\x20\x09-\x0D]")
        blank = F.lit(None).cast("double")
        return rows.select(F.col("_id").alias(id_col), F.col("_lang").alias("lang"), blank.alias("perplexity"), blank.alias("threshold"), words.alias("kept"))
    scored = written(with_perplexity(rows, model))
    model.discard()
    discard(counted)
    judged = scored.filter("perplexity is not null").join(trusted.filter(held), "_id", "left_semi")
    by_language = judged.groupBy("_lang").agg(F.percentile_approx("perplexity", quantile, 1000).alias("own"))
    overall = judged.agg(F.percentile_approx("perplexity", quantile, 1000)).first()[0]
    bounded = scored.join(by_language, "_lang", "left").withColumn("threshold", F.lit(SLACK) * F.coalesce("own", F.lit(overall).cast("double")))
    kept = F.col("perplexity").isNotNull() & (F.col("threshold").isNull() | (F.col("perplexity") <= F.col("threshold")))
    return bounded.select(F.col("_id").alias(id_col), F.col("_lang").alias("lang"), "perplexity", "threshold", kept.alias("kept"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").filter("quality = 1")
    return classify_quality(table(spark, sf_dir, "documents"), labels)
