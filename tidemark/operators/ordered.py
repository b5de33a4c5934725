"""Ordered rules over keyed logs, without ever sorting a hot key in one task.

Rules such as "the identity in force", "the previous event" or "how many
so far" read rows of one key in time order. A plain window would put a key with
a third of the table into a single task. So the rows per key are counted first, and keys with more
than ``hot_rows`` are cut into time chunks of about that many:

1. rows are shuffled once by (key, chunk) and a window runs inside each chunk;
2. for cut keys, one summary row per chunk, pre-aggregated before its shuffle, is scanned
   per key to give every chunk the state it starts with;
3. that state is joined back on (key, chunk), which the rows are already
   partitioned by, so the large side is not moved again.

Where no key is hot, which the count tells, all that is left is the window. Rows with a null key belong to
nobody: each is a key of its own, so they neither see each other nor meet in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

HOT_ROWS = 4_000_000

# Hot keys and cells are broadcast up to this number; beyond it AQE splits the join.
BROADCAST_ROWS = 100_000

_CHUNK = "__chunk"
ALONE = "__alone"
_FINE_PARTS = 1 << 20


def place(
    df: DataFrame, keys: Sequence[str], tick: str, hot_rows: int = HOT_ROWS, measure: DataFrame | None = None
) -> tuple[DataFrame, bool]:
    """Add ``__chunk``, and ``__hot`` which is true for keys cut into several chunks; or
    return ``df`` as it is, and false, if no key has more than ``hot_rows`` rows.

    A key with n > ``hot_rows`` rows gets n / hot_rows equal cells of its time span; a cell that
    still holds several times ``hot_rows``, a burst, is cut again by its own count. The counts run
    as jobs of their own, when this is called. They are pre-aggregated before their shuffle, and few
    are kept: of N rows at most N / hot_rows keys or cells are that large. They are broadcast if they are few.

    ``measure`` may be a cheaper table with the same keys and times to count instead, such as ``df``
    before a costly step. How keys are cut never changes a result.
    """
    keys = list(keys)
    counted = (df if measure is None else measure).select(*keys, F.col(tick).cast("bigint").alias("__tick"))
    counted = counted.filter(~without_key(keys))
    rows = F.count(F.lit(1)).alias("__n")
    spans = (
        counted.groupBy(*keys)
        .agg(rows, F.min("__tick").alias("__key_lo"), F.max("__tick").alias("__key_hi"))
        .filter(F.col("__n") > hot_rows)
        .select(*keys, "__key_lo", _share(F.col("__key_hi") - F.col("__key_lo") + 1, hot_rows).alias("__key_step"))
    )
    if spans.isEmpty():
        return df, False
    spans = cut_lineage(spans)
    cell = F.expr("(__tick - __key_lo) div __key_step")
    cells = cut_lineage(
        counted.join(_small(spans), keys)
        .groupBy(*keys, cell.alias("__cell"), "__key_step")
        .agg(rows)
        .filter(F.col("__n") > 4 * hot_rows)
        .select(*keys, "__cell", _share(F.col("__key_step"), hot_rows).alias("__cell_step"))
    )
    fine = F.least(F.expr("(__tick - __key_lo - __cell * __key_step) div __cell_step"), F.lit(_FINE_PARTS - 1))
    placed = (
        df.withColumn("__tick", F.col(tick).cast("bigint"))
        .join(_small(spans), keys, "left")
        .withColumn("__cell", cell)
        .join(_small(cells), [*keys, "__cell"], "left")
        .withColumns(
            {
                _CHUNK: F.coalesce("__cell", F.lit(0)) * _FINE_PARTS + F.coalesce(fine, F.lit(0)),
                "__hot": F.col("__key_step").isNotNull(),
            }
        )
    )
    return placed.drop("__tick", "__key_lo", "__key_step", "__cell", "__cell_step"), True


def _small(table: DataFrame) -> DataFrame:
    """Broadcast a written table of counted size: a join by key would bring a hot key's rows together before they are cut."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def without_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def alone(keys: Sequence[str], order: Sequence[str]) -> Column:
    """What tells rows with a null key apart: their position; null for all others."""
    return F.when(without_key(keys), F.struct(*[F.col(c) for c in order]))


def _share(span: Column, hot_rows: int) -> Column:
    """The part of ``span`` that holds ``hot_rows`` of ``__n`` rows, at least 1."""
    return F.greatest(F.floor(span * (F.lit(float(hot_rows)) / F.col("__n"))), F.lit(1)).cast("bigint")


@dataclass(frozen=True)
class Running:
    """A running value: ``kind`` is last, before, first, total or previous."""

    kind: str
    expr: Column


def last(expr: Column) -> Running:
    """Latest non-null value up to and including the row."""
    return Running("last", expr)


def before(expr: Column) -> Running:
    """Latest non-null value strictly before the row."""
    return Running("before", expr)


def first(expr: Column) -> Running:
    """Earliest non-null value up to and including the row."""
    return Running("first", expr)


def total(expr: Column) -> Running:
    """Sum up to and including the row, null counting as nothing."""
    return Running("total", expr)


def previous(expr: Column) -> Running:
    """Value of the row just before, null kept; null on the first row."""
    return Running("previous", F.struct(expr.alias("v")))


class Ordered:
    """A table cut into (key, chunk) groups, on which running values are added.

    ``order`` must identify rows of a key; its first column is a whole number, the time.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        hot_rows: int = HOT_ROWS,
        measure: DataFrame | None = None,
    ):
        self.keys = list(keys)
        self.order = list(order)
        placed, self.cut = place(df, self.keys, self.order[0], hot_rows, measure)
        self.df = placed.withColumn(ALONE, alone(self.keys, self.order))

    def _wrap(self, df: DataFrame) -> Ordered:
        other = object.__new__(Ordered)
        other.keys, other.order, other.df, other.cut = self.keys, self.order, df, self.cut
        return other

    def with_columns(self, **columns: Column) -> Ordered:
        return self._wrap(self.df.withColumns(columns))

    def running(self, reverse: bool = False, **values: Running) -> Ordered:
        """Add one column per running value, reading forwards or in reverse."""
        way = F.desc if reverse else F.asc
        group = [*self.keys, _CHUNK] if self.cut else self.keys
        inside = Window.partitionBy(*group, ALONE).orderBy(*[way(c) for c in self.order])
        upto = inside.rowsBetween(Window.unboundedPreceding, 0)
        earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
        own = {
            "total": lambda col: F.coalesce(F.sum(col).over(upto), F.lit(0)),
            "first": lambda col: F.first(col, ignorenulls=True).over(upto),
            "last": lambda col: F.last(col, ignorenulls=True).over(upto),
            "before": lambda col: F.last(col, ignorenulls=True).over(earlier),
            "previous": lambda col: F.last(col, ignorenulls=True).over(earlier),
        }
        source = {f"__in_{n}": v.expr for n, v in values.items()}
        base = self.df.withColumns(source)
        local = {f"__own_{n}": own[v.kind](F.col(f"__in_{n}")) for n, v in values.items()}
        rows, starts = base.withColumns(local), {}
        if self.cut:
            carried = self._carry(base, values, reverse)
            rows = rows.join(carried, group, "left")
            starts = {n: F.col(f"__start_{n}") for n in values}

        def merge(name: str, kind: str) -> Column:
            mine, start = F.col(f"__own_{name}"), starts.get(name)
            if start is not None and kind == "total":
                mine = mine + F.coalesce(start, F.lit(0))
            elif start is not None:
                mine = F.coalesce(start, mine) if kind == "first" else F.coalesce(mine, start)
            return mine["v"] if kind == "previous" else mine

        rows = rows.withColumns({n: merge(n, v.kind) for n, v in values.items()})
        return self._wrap(rows.drop(*source, *local, *[f"__start_{n}" for n in values]))

    def _carry(self, base: DataFrame, values: dict[str, Running], reverse: bool) -> DataFrame:
        """The values each chunk of a cut key starts with, from one summary row per chunk."""
        position = F.struct(*[F.col(c) for c in self.order])
        newest, oldest = (F.min_by, F.max_by) if reverse else (F.max_by, F.min_by)
        chunks = Window.partitionBy(*self.keys).orderBy((F.desc if reverse else F.asc)(_CHUNK))
        before_it = chunks.rowsBetween(Window.unboundedPreceding, -1)
        summary, carry = [], []
        for name, value in values.items():
            col, end, start = F.col(f"__in_{name}"), f"__end_{name}", f"__start_{name}"
            present = F.when(col.isNotNull(), position)
            if value.kind == "total":
                summary.append(F.sum(col).alias(end))
                carry.append(F.sum(end).over(before_it).alias(start))
            elif value.kind == "first":
                summary.append(oldest(col, present).alias(end))
                carry.append(F.first(end, ignorenulls=True).over(before_it).alias(start))
            else:
                summary.append(newest(col, present).alias(end))
                carry.append(F.last(end, ignorenulls=True).over(before_it).alias(start))
        ends = base.filter("__hot").groupBy(*self.keys, _CHUNK).agg(*summary)
        return ends.select(*self.keys, _CHUNK, *carry)

    def frame(self) -> DataFrame:
        return self.df.drop(_CHUNK, "__hot", ALONE)


def as_of(
    events: DataFrame,
    logs: dict[str, DataFrame],
    keys: Sequence[str],
    time: str,
    seq: str,
    hot_rows: int = HOT_ROWS,
    measure: DataFrame | None = None,
) -> DataFrame:
    """Give each event, per named log, the newest log row at or before it.

    Logs share the key, time and sequence columns of ``events``; their other columns
    arrive as one struct column under the log's name (null when there is none).
    A log row at the same instant as an event counts as earlier. Events without a key find nothing. All logs ride in
    one union, so all lookups together cost one shuffle. The inputs are read more than once, for
    the key counts and for the rows: hand in tables, not long computations (``session.cut_lineage`` writes one),
    or name a table of the same keys and times in ``measure``.
    """
    head = [*keys, time, seq]
    payload = {n: [c for c in log.columns if c not in head] for n, log in logs.items()}
    event_cols = [c for c in events.columns if c not in head]
    parts = [events.select(*head, F.lit(1).alias("__kind"), F.struct(*event_cols).alias("__event"))]
    for name, log in logs.items():
        rows = log.filter(~without_key(keys))
        parts.append(rows.select(*head, F.lit(0).alias("__kind"), F.struct(*payload[name]).alias(name)))
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    scanned = Ordered(union, keys, [time, "__kind", seq], hot_rows, measure).running(
        **{f"__now_{n}": last(F.col(n)) for n in logs}
    )
    return (
        scanned.frame()
        .filter("__kind = 1")
        .select(*head, "__event.*", *[F.col(f"__now_{n}").alias(n) for n in logs])
    )


# Runs up to this many rows are decided by a fold in one task, longer ones by pointer doubling. A fold copies
# its openers as they grow, so its cost goes with the square of this.
FOLD_ROWS = 512


def open_intervals(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    seq: str,
    length: int,
    starts_run: Column | None = None,
    hot_rows: int = HOT_ROWS,
    also: dict[str, Running] | None = None,
    fold_rows: int = FOLD_ROWS,
) -> DataFrame:
    """Mark rows that open an interval: the first row, then each first row at least
    ``length`` after the last opener. Rows inside an interval do not extend it.

    ``starts_run`` (which may read the running values in ``also``) marks rows that
    open one whatever the time. Adds boolean ``opens``.

    A row that follows its predecessor by ``length`` or more always opens, so rows split
    into runs that can be decided alone, and a run shorter than ``length`` has its
    first row as sole opener. Only longer runs, usually few, need their openers followed one
    after the other: their distinct times are written once, runs of at most ``fold_rows`` of
    them are folded, and longer ones go through ``_follow``. The rows and their runs are written once
    and read from there. A row with a null key opens.
    """
    keys, also = list(keys), also or {}
    scan = Ordered(df, keys, [time, seq], hot_rows).running(__prev=previous(F.col(time)), **also)
    head = F.col("__prev").isNull() | (F.col(time) - F.col("__prev") >= length)
    if starts_run is not None:
        head = head | F.coalesce(starts_run, F.lit(False))
    scan = scan.with_columns(__head=head)
    run = [*keys, "__run"]
    at = F.struct(F.col(time).alias("t"), F.col(seq).alias("s"))
    scanned = scan.running(__run=last(F.when(F.col("__head"), at))).frame().drop("__prev", *also)
    scanned = cut_lineage(scanned)
    heads = scanned.drop("__run")
    runs = scanned.filter(~without_key(keys)).select(*run, time, seq)
    long_runs = runs.groupBy(*run).agg(F.max(time).alias("__to")).filter(F.col("__to") - F.col("__run.t") >= length)
    # One candidate per run and instant: the first row there, others cannot open.
    ticks = runs.join(long_runs.select(*run), run, "left_semi").groupBy(*run, time).agg(F.min(seq).alias(seq))
    ticks = cut_lineage(ticks)
    if ticks.isEmpty():
        return heads.withColumnRenamed("__head", "opens")

    sized = ticks.groupBy(*run).agg(F.count(F.lit(1)).alias("__n"), F.max(time).alias("__to"))
    opened = _fold(ticks.join(sized.filter(F.col("__n") <= fold_rows).select(*run), run, "left_semi"), run, time, seq, length)
    big = sized.filter(F.col("__n") > fold_rows)
    widest = big.agg(F.max(F.col("__to") - F.col("__run.t")).alias("w")).first()["w"]
    if widest is not None:
        rest = ticks.join(big.select(*run), run, "left_semi")
        opened = opened.unionByName(_follow(rest, run, time, seq, length, widest, hot_rows))
    opened = opened.select(*keys, time, seq, F.lit(True).alias("__opened"))
    return (
        heads.join(opened, [*keys, time, seq], "left")
        .withColumn("opens", F.col("__head") | F.coalesce("__opened", F.lit(False)))
        .drop("__head", "__opened")
    )


def _fold(ticks: DataFrame, run: list[str], time: str, seq: str, length: int) -> DataFrame:
    """Openers of runs small enough to be an array each."""
    tick = F.struct(F.col(time).alias("t"), F.col(seq).alias("s"))
    per_run = ticks.groupBy(*run).agg(F.array_sort(F.collect_list(tick)).alias("__ticks"))
    first = F.element_at("__ticks", 1)

    def step(openers: Column, t: Column) -> Column:
        return F.when(t["t"] - F.element_at(openers, -1)["t"] >= length, F.concat(openers, F.array(t))).otherwise(openers)

    openers = F.aggregate("__ticks", F.array(first), step)
    return per_run.select(*run, F.explode(openers).alias("__o")).select(
        *run, F.col("__o.t").alias(time), F.col("__o.s").alias(seq)
    )


def _follow(
    ticks: DataFrame, run: list[str], time: str, seq: str, length: int, widest: int, hot_rows: int
) -> DataFrame:
    """Openers of long runs, all at once, by pointer doubling.

    Each time links to the first one at least ``length`` later; the times reached from a run's
    head by 1, 2, 4, ... links are its openers. Every join is on (run, time), so a
    long run is spread over all tasks, and log2(chain) rounds are enough.
    """
    points = ticks.select(*run, F.col(time).alias("__at"), F.lit(1).alias("__cand"), F.col(time).alias("__cand_at"))
    probes = ticks.select(
        *run, (F.col(time) + length).alias("__at"), F.lit(0).alias("__cand"), F.col(time).alias("__from")
    )
    links = (
        Ordered(points.unionByName(probes, allowMissingColumns=True), run, ["__at", "__cand"], hot_rows)
        .running(reverse=True, __next=last(F.col("__cand_at")))
        .frame()
        .filter("__cand = 0 and __next is not null")
        .select(*run, "__from", "__next")
    )
    links = cut_lineage(links)
    reached = ticks.select(*run, F.col("__run.t").alias("__from")).distinct()
    for _ in range(math.ceil(math.log2(widest / length + 1))):
        step = reached.join(links, [*run, "__from"]).select(*run, F.col("__next").alias("__from"))
        reached = cut_lineage(reached.unionByName(step).distinct())
        hop = links.select(*run, F.col("__from").alias("__next"), F.col("__next").alias("__then"))
        links = cut_lineage(links.join(hop, [*run, "__next"]).select(*run, "__from", F.col("__then").alias("__next")))
    return reached.withColumnRenamed("__from", time).join(ticks, [*run, time]).select(*run, time, seq)
