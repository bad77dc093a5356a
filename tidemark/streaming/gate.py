"""Which events of a sequenced stream count: duplicates, gaps and snapshots that recover from them.

A snapshot is a new baseline.  A correction always counts and advances nothing; so does an event without a sequence.
A delta counts right after the last position (the first one anchors the stream); at or behind it, it is a duplicate;
ahead of it, it is dropped and a snapshot is awaited.  Where a slice of a stream begins is not known before the slices
ahead of it are through, so each slice first says where any start would end: ranges of starts, as many as there are
disorders in it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: Statuses of events that change a state.
LIVE = ("snapshot_applied", "correction_applied", "unsequenced", "applied")


class Position:
    """Where a stream stands; ``step`` gives an event's status."""

    def __init__(self, last: int | None = None, snapshot_first: bool = False):
        self.last, self.snapshot_first = last, snapshot_first

    def step(self, kind: str | None, sequence: int | None) -> str:
        if kind == "snapshot":
            self.last = self.last if sequence is None else sequence
            return "snapshot_applied"
        if kind == "correction":
            return "correction_applied"
        if sequence is None:
            return "unsequenced"
        if self.last is None and self.snapshot_first:
            return "gap_detected"
        if self.last is None or sequence == self.last + 1:
            self.last = sequence
            return "applied"
        return "duplicate" if sequence <= self.last else "gap_detected"


class Moves:
    """Where a slice takes every position that a stream may have when it begins.

    ``known``: the end, once a snapshot has set it.  ``unset``: the end of a stream without position.  ``at``: by end, the
    ranges of starts that have been moved there; any other start stays where it is.
    """

    def __init__(self, snapshot_first: bool = False):
        self.fixed, self.from_none = False, Position(None, snapshot_first)
        self.at: dict[int, list[list[int]]] = {}
        self.moved: set[int] = set()

    def step(self, kind: str | None, sequence: int | None) -> None:
        self.from_none.step(kind, sequence)
        if self.fixed or kind == "correction" or sequence is None:
            return
        if kind == "snapshot":
            self.fixed, self.at, self.moved = True, {}, set()
            return
        start = sequence - 1
        ranges = self.at.pop(start, [])
        if start not in self.moved:
            self.moved.add(start)
            if ranges and ranges[-1][1] == start - 1:
                ranges[-1][1] = start
            else:
                ranges.append([start, start])
        if ranges:
            self.at[sequence] = self.at.get(sequence, []) + ranges

    def dump(self) -> str:
        return json.dumps([self.fixed, self.from_none.last, [[lo, hi, end] for end, ranges in self.at.items() for lo, hi in ranges]])

    @staticmethod
    def end(dumped: str, start: int | None) -> int | None:
        fixed, from_none, moves = json.loads(dumped)
        if fixed or start is None:
            return from_none
        return next((end for lo, hi, end in moves if lo <= start <= hi), start)


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    for batch in batches:
        yield batch, list(zip(*(batch.column(i).to_pylist() for i in range(keys)), strict=True))


def gate(events: DataFrame, key: str, order: Sequence[str], kind: str, sequence: str, slice_: Column | None = None, snapshot_first: bool = False) -> DataFrame:
    """Events with ``status`` and ``position``, the stream's last position behind the event.

    ``order`` is the order of arrival.  A key's rows are one sorted pass that holds a number; with ``slice_``, which must
    not fall in that order, a busy key is spread over its slices, in three passes.  A null key is a stream of its own; an
    empty table gives no rows; a table must not have columns named ``status`` or ``position``.
    """
    names = events.columns
    extra = StructType([StructField("status", StringType()), StructField("position", LongType())])
    led = [F.col(key).alias("__k"), F.col(kind).alias("__kind"), F.col(sequence).cast("long").alias("__seq")]

    def mark(width: int, begin: Callable) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, current = None, None
            for batch, rows in _runs(batches, width):
                status, position = [], []
                for row in rows:
                    if now is None or (row[0], *row[3:]) != current:
                        current, now = (row[0], *row[3:]), begin(row)
                    status.append(now.step(row[1], row[2]))
                    position.append(now.last)
                columns = batch.columns[width:]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(status, pa.string()), pa.array(position, pa.int64())], schema=to_arrow_schema(out))

        return run

    out = StructType([*events.schema.fields, *extra.fields])
    if slice_ is None:
        dealt = events.select(*led, *names).repartition("__k").sortWithinPartitions("__k", *order)
        return dealt.mapInArrow(mark(3, lambda row: Position(None, snapshot_first)), out)

    kinds = events.select(led[0], slice_.alias("__slice")).schema
    ended = StructType([*kinds.fields, StructField("moves", StringType())])
    begun = StructType([*kinds.fields, StructField("__start", LongType())])

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, current, rows_out = None, None, []
        for _, rows in _runs(batches, 4):
            for row in rows:
                if now is None or (row[0], row[3]) != current:
                    if now is not None:
                        rows_out.append((*current, now.dump()))
                    current, now = (row[0], row[3]), Moves(snapshot_first)
                now.step(row[1], row[2])
        if now is not None:
            rows_out.append((*current, now.dump()))
            yield _batch(rows_out, ended)

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, last, begun_any = None, None, False
        for _, rows in _runs(batches, 3):
            found = []
            for k, slice_at, moves in rows:
                if not begun_any or k != current:
                    current, last, begun_any = k, None, True
                found.append((k, slice_at, last))
                last = Moves.end(moves, last)
            if found:
                yield _batch(found, begun)

    sliced = events.select(*led, slice_.alias("__slice"), *names)
    cut = sliced.select("__k", "__kind", "__seq", "__slice", *order).repartition("__k", "__slice").sortWithinPartitions("__k", "__slice", *order)
    moves = cut.mapInArrow(summarise, ended)
    starts = moves.repartition("__k").sortWithinPartitions("__k", "__slice").mapInArrow(chain, begun)
    named = starts.select(F.struct("__k", "__slice").alias("__at"), "__start")
    both = sliced.withColumn("__at", F.struct("__k", "__slice")).join(named, "__at", "left")
    dealt = both.select("__k", "__kind", "__seq", "__slice", "__start", "__at", *names).repartition("__at").sortWithinPartitions("__k", "__slice", *order)
    ready = dealt.select("__k", "__kind", "__seq", "__slice", "__start", *names)
    return ready.mapInArrow(mark(5, lambda row: Position(row[4], snapshot_first)), out)


def _batch(rows: list[tuple], schema: StructType) -> pa.RecordBatch:
    types = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types.types, strict=True)], schema=types)
