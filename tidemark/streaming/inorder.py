"""Rules that fold a key's rows in order of time, on streams whose rows come in any order.

Keys are dealt into buckets, and a bucket is what Spark groups by: calls, timers and
round trips to the state store are those of buckets, however many keys there are. A
bucket's states are held in pages of the state store, of which only those in use are
opened.

Rows wait in the state store until the watermark has passed their time, so that a
row may arrive as much later than its successors as the stream's allowed lateness.
They wait as sorted runs cut into chunks, and are folded by merging the runs, one
chunk of each at a time: a key with millions of rows in a micro-batch costs disk in
the state store, not memory in its task. A row the watermark has already passed
cannot be folded in order any more; it comes out with a reject code.

Event-time timers fold what is due and let a rule's state expire, so a run over
what is available ends by itself.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections import namedtuple
from collections.abc import Iterable, Iterator
from heapq import merge
from itertools import chain, islice
from zlib import crc32

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Rows of a run that are held in memory together, and of an output frame.
CHUNK_ROWS = 1_000
OUT_ROWS = 10_000
#: Runs merged at a time; where there are more, they are first merged into longer ones.
FAN_IN = 64
#: Groups that keys are dealt into, and pages that hold the states of a group. A stream keeps its numbers for life, as its
#: state lies by them. A task folds with the states of one bucket in memory.
BUCKETS = 512
PAGES = 4
BUCKET = "__bucket"
LATE = "late_row"
TIMELESS = "missing_time"
REJECT = "document string, reject_code string"


def use_rocksdb(spark) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


class Rule:
    """How a key's rows are folded, one by one, in order.

    ``reads`` names the columns of a row besides its key, the time first and then what decides between rows of one
    time. ``unit`` is the number of time units in a millisecond.
    """

    reads: tuple[str, ...] = ()
    unit = 1000
    state_schema = ""
    output = ""

    def start(self) -> list:
        """The state of a key without rows."""
        raise NotImplementedError

    def opened(self, state: list) -> list:
        """The stored state as ``step`` works on it."""
        return state

    def stored(self, state: list) -> list:
        """The reverse of ``opened``."""
        return state

    def step(self, key, state: list, row) -> Iterator[tuple]:
        """Fold a row into ``state``; output rows."""
        raise NotImplementedError

    def deadline(self, state: list) -> int | None:
        """When, in milliseconds, ``expire`` is due if no row comes before."""
        return None

    def expire(self, key, state: list) -> tuple[list[tuple], list | None]:
        """Output rows, and the state after; None forgets the key."""
        return [], None


def _sort_key(time, seq) -> tuple:
    return time, seq is not None, seq


class States:
    """The states of a bucket's keys, opened page by page as they are asked for, and written back by ``save``.

    ``dues`` has the earliest deadline in each page that has one.
    """

    def __init__(self, of: InOrder):
        self.of, self.rule = of, of.rule
        self.pages: dict[int, dict] = {}
        self.opened: dict = {}
        self.dues = {int(k): v for k, v in json.loads(of.dues.get()[0]).items()} if of.buffered and of.dues.exists() else {}

    @staticmethod
    def place(key) -> int:
        return crc32(repr(key).encode()) % PAGES

    def page(self, number: int) -> dict:
        """A page's keys and stored states."""
        if number not in self.pages:
            held = self.of.state.getValue((number,))
            columns = pa.ipc.open_stream(held[0]).read_next_batch().columns if held else []
            self.pages[number] = {key: list(state) for key, *state in zip(*[c.to_pylist() for c in columns], strict=True)}
        return self.pages[number]

    def __getitem__(self, key) -> list:
        if key not in self.opened:
            state = self.page(self.place(key)).get(key)
            self.opened[key] = self.rule.opened(list(self.rule.start()) if state is None else state)
        return self.opened[key]

    def forget(self, key) -> None:
        del self.opened[key]
        del self.page(self.place(key))[key]

    def save(self) -> int | None:
        """Write the pages of opened states back; the earliest deadline of all."""
        for key, state in self.opened.items():
            self.page(self.place(key))[key] = list(self.rule.stored(state))
        for number, page in self.pages.items():
            self.dues.pop(number, None)
            if not page:
                self.of.state.removeKey((number,))
                continue
            self.of.state.updateValue((number,), (self.of.packed([(k, *v) for k, v in page.items()], self.of.kept),))
            due = [at for k, v in page.items() if (at := self.rule.deadline(self.opened[k] if k in self.opened else self.rule.opened(v))) is not None] if self.of.buffered else []
            if due:
                self.dues[number] = min(due)
        if self.of.buffered and self.pages:
            self.of.dues.update((json.dumps(self.dues),))
        return min(self.dues.values(), default=None)


class InOrder(StatefulProcessor):
    """Folds rows by ``rule``: at once in each micro-batch, or, ``buffered``, when the watermark has passed them.

    It is called for a bucket of keys at a time; ``schema`` is that of the rows, the key first.
    """

    def __init__(self, rule: Rule, schema: T.StructType, buffered: bool, chunk_rows: int = CHUNK_ROWS, fan_in: int = FAN_IN):
        self.rule, self.buffered, self.chunk_rows, self.fan_in = rule, buffered, chunk_rows, fan_in
        self.schema = schema
        # Of a page: its keys and their states.
        self.stored = T.StructType([schema.fields[0], *T.StructType.fromDDL(rule.state_schema).fields])
        self.time, self.seq = rule.reads[:2]
        self.out_names = [f.name for f in T.StructType.fromDDL(f"{rule.output}, {REJECT}").fields]

    def init(self, handle: StatefulProcessorHandle) -> None:
        from pyspark.sql.pandas.types import to_arrow_schema

        self.handle = handle
        self.arrow = to_arrow_schema(self.schema)
        self.Row = namedtuple("Row", self.schema.names)
        # Of the bucket: its pages, and the earliest deadline in each, as JSON.
        self.kept = to_arrow_schema(self.stored)
        self.state = handle.getMapState("state", "page int", "held binary")
        self.dues = handle.getValueState("dues", "held string")
        # Of a run: the place of its next chunk, its number of chunks, the time of its next row.
        self.runs = handle.getMapState("runs", "run long", "at long, chunks long, first long")
        self.chunks = handle.getMapState("chunks", "run long, place long", "held binary")

    def close(self) -> None:
        pass

    # Sorted runs in the state store

    @staticmethod
    def packed(rows: pa.RecordBatch | list, schema: pa.Schema) -> bytes:
        batch = InOrder._batch(rows, schema) if isinstance(rows, list) else rows
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(batch)
        return sink.getvalue().to_pybytes()

    def _put(self, run: int, place: int, batch: pa.RecordBatch) -> None:
        self.chunks.updateValue((run, place), (self.packed(batch, batch.schema),))

    def _get(self, run: int, place: int) -> pa.RecordBatch:
        return pa.ipc.open_stream(self.chunks.getValue((run, place))[0]).read_next_batch()

    def _store(self, run: int, batches: Iterable[pa.RecordBatch]) -> None:
        place, first = 0, None
        for batch in batches:
            first = batch.column(self.time)[0].as_py() if first is None else first
            self._put(run, place, batch)
            place += 1
        if place:
            self.runs.updateValue((run,), (0, place, first))

    def _held(self) -> dict[int, tuple[int, int, int]]:
        return {k[0]: tuple(v) for k, v in self.runs.iterator()}

    def _rows(self, run: int, at: int, chunks: int, before: int | None) -> Iterator[tuple]:
        """(order, run, row) of a run, up to the time ``before``; the rest of it stays."""
        for place in range(at, chunks):
            batch = self._get(run, place)
            times, seqs = batch.column(self.time).to_pylist(), batch.column(self.seq).to_pylist()
            due = len(times) if before is None else bisect_left(times, before)
            rows = zip(*[c.to_pylist() for c in batch.slice(0, due).columns], strict=True)
            for n, row in enumerate(rows):
                yield _sort_key(times[n], seqs[n]), run, (place, n), row
            if due < len(times):
                self._put(run, place, batch.slice(due))
                self.runs.updateValue((run,), (place, chunks, times[due]))
                return
            self.chunks.removeKey((run, place))
        self.runs.removeKey((run,))

    def _merged(self, held: dict[int, tuple[int, int, int]], before: int | None = None) -> Iterator:
        due = {run: v for run, v in held.items() if before is None or v[2] < before}
        for *_, row in merge(*[self._rows(run, at, chunks, before) for run, (at, chunks, _) in due.items()]):
            yield self.Row._make(row)

    def _compacted(self) -> None:
        """Merge runs into longer ones until at most ``fan_in`` are left."""
        while len(held := self._held()) > self.fan_in:
            some = dict(islice(sorted(held.items(), key=lambda item: item[1][1] - item[1][0]), self.fan_in))
            rows = self._merged(some)
            self._store(max(held) + 1, iter(lambda: self._batch(list(islice(rows, self.chunk_rows)), self.arrow), None))

    @staticmethod
    def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch | None:
        if not rows:
            return None
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def _cut(self, frame: pd.DataFrame) -> Iterator[pa.RecordBatch]:
        whole = pa.RecordBatch.from_pandas(frame, schema=self.arrow, preserve_index=False)
        for a in range(0, whole.num_rows, self.chunk_rows):
            yield whole.slice(a, self.chunk_rows)

    # Folding

    def _fold(self, rows: Iterable) -> Iterator[pd.DataFrame]:
        states = States(self)
        yield from self._frames(chain.from_iterable(self.rule.step(row[0], states[row[0]], row) for row in rows))
        self._wake(states.save())

    def _frames(self, made: Iterator[tuple]) -> Iterator[pd.DataFrame]:
        while some := [(*r, None, None) for r in islice(made, OUT_ROWS)]:
            yield pd.DataFrame(some, columns=self.out_names, dtype=object)

    def _wake(self, at: int | None) -> None:
        if self.buffered and at is not None:
            self.handle.registerTimer(max(at, 1))

    def _refused(self, frame: pd.DataFrame, code: str) -> pd.DataFrame:
        rows = pa.RecordBatch.from_pandas(frame, schema=self.arrow, preserve_index=False).to_pylist()
        blank = [None] * (len(self.out_names) - 2)
        return pd.DataFrame([(*blank, json.dumps(r, default=str), code) for r in rows], columns=self.out_names, dtype=object)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() if self.buffered else 0
        passed = watermark * self.rule.unit if watermark > 0 else None
        run, earliest, alone = None, None, None
        for frame in rows:
            for code in (TIMELESS, LATE) if passed is not None else (TIMELESS,):
                bad = frame[self.time].isna() if code == TIMELESS else frame[self.time] < passed
                if bad.any():
                    yield self._refused(frame[bad], code)
                    frame = frame[~bad]
            if frame.empty:
                continue
            frame = frame.sort_values([self.time, self.seq], kind="stable", na_position="first")
            if not self.buffered and run is None and alone is None:
                # A lone frame need not go through the store.
                alone = frame
                continue
            if run is None:
                run = max(self._held(), default=-1) + 1
            for one in (alone, frame):
                if one is not None:
                    self._store(run, self._cut(one))
                    run += 1
            alone = None
            first = int(frame[self.time].iloc[0])
            earliest = first if earliest is None else min(first, earliest)
            if run % self.fan_in == 0:
                self._compacted()
                run = max(self._held()) + 1
        if alone is not None:
            yield from self._fold(chain.from_iterable(map(self.Row._make, zip(*[c.to_pylist() for c in b.columns], strict=True)) for b in self._cut(alone)))
        elif run is not None and not self.buffered:
            yield from self._fold(self._merged(self._held()))
        elif earliest is not None:
            self._wake(earliest // self.rule.unit + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        passed = watermark * self.rule.unit
        held = self._held()
        if any(first < passed for _, _, first in held.values()):
            yield from self._fold(self._merged(held, passed))
            held = self._held()
        if held:
            self._wake(min(first for _, _, first in held.values()) // self.rule.unit + 1)
        yield from self._expired(watermark)

    def _expired(self, watermark: int) -> Iterator[pd.DataFrame]:
        """Expire the states whose deadline the watermark has reached."""
        states = States(self)
        due = [number for number, at in states.dues.items() if at <= watermark]
        if due:
            yield from self._frames(chain.from_iterable(self._expire(states, key, watermark) for number in due for key in list(states.page(number))))
            self._wake(states.save())

    def _expire(self, states: States, key, watermark: int) -> Iterator[tuple]:
        state = states[key]
        while (due := self.rule.deadline(state)) is not None and due <= watermark:
            made, state = self.rule.expire(key, state)
            yield from made
            if state is None:
                states.forget(key)
                return
            states.opened[key] = state


def fold_in_order(df: DataFrame, rule: Rule, by: str, late: str | None, rejects: bool = False, chunk_rows: int = CHUNK_ROWS, fan_in: int = FAN_IN, buckets: int = BUCKETS) -> DataFrame:
    """Fold each key's rows by ``rule``.

    With ``late``, rows are folded in order of time over the whole stream, each when the watermark has passed it; what
    comes more than ``late`` behind is refused. Without, each micro-batch is folded as it comes, in order within itself.
    ``rejects`` keeps refused rows in the result, with ``document`` and ``reject_code`` set and all else null. Keys share
    ``buckets``, so that what a key costs besides its rows does not grow with the number of keys.
    """
    use_rocksdb(df.sparkSession)
    columns = [by, *[c for c in rule.reads if c != by]]
    rows = df
    if late is not None:
        micros = F.col(rule.reads[0]) * 1000 if rule.unit == 1 else F.expr(f"{rule.reads[0]} div {rule.unit // 1000}")
        # The watched column is dropped again, so that late rows reach the rule instead of being filtered out.
        rows = df.withColumn("__at", F.timestamp_micros(micros.cast("bigint"))).withWatermark("__at", late)
    rows = rows.select(*columns)
    dealt = rows.withColumn(BUCKET, F.pmod(F.xxhash64(by), F.lit(buckets)))
    done = dealt.groupBy(BUCKET).transformWithStateInPandas(
        statefulProcessor=InOrder(rule, rows.schema, late is not None, chunk_rows, fan_in),
        outputStructType=f"{rule.output}, {REJECT}",
        outputMode="Append",
        timeMode="None" if late is None else "EventTime",
    )
    return done if rejects else done.filter("reject_code is null").drop("document", "reject_code")
