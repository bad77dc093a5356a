"""Keyed folds over ordered rows, in one pass and in bounded memory.

A fold is a small state machine over one key's rows in order: ``step(*row)`` gives the output columns behind the key,
``dump()`` its state as JSON, and its constructor takes that state back.  The batch form deals rows by key, sorts them
where they are, and walks through Arrow batches: of a key, however hot, only the fold's own state is held.  The
streaming form keeps the state between micro-batches.
"""

from __future__ import annotations

import bisect
import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType


def _names(schema: str) -> list[str]:
    return StructType.fromDDL(schema).fieldNames()


def fold(df: DataFrame, key: str, order: Sequence[str], inputs: Sequence[str], make: Callable, schema: str) -> DataFrame:
    """Batch form: a row per input row, the key and what ``make().step`` gives for ``inputs``.  Rows with equal order
    columns should be equal; null keys are a key of their own."""
    types = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, now = None, None
        for batch in batches:
            out = []
            for k, *row in zip(*(batch.column(i).to_pylist() for i in range(len(inputs) + 1)), strict=True):
                if now is None or k != current:
                    current, now = k, make()
                out.append((k, *now.step(*row)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types.types, strict=True)], schema=types)

    sorted_ = df.select(key, *dict.fromkeys([*inputs, *order])).repartition(key).sortWithinPartitions(key, *order)
    return sorted_.select(key, *inputs, *[c for c in order if c not in inputs]).mapInArrow(run, schema)


def fold_stream(df: DataFrame, key: str, order: Sequence[str], inputs: Sequence[str], make: Callable, schema: str) -> DataFrame:
    """Streaming form: rows of a micro-batch are taken in order, and micro-batches as they come."""
    names = _names(schema)

    def run(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = make(json.loads(state.get[0]) if state.exists else None)
        rows = pd.concat(list(frames)).sort_values(list(order))
        plain = [[None if pd.isna(v) else v for v in rows[c].tolist()] for c in inputs]
        yield pd.DataFrame([(group[0], *now.step(*row)) for row in zip(*plain, strict=True)], columns=names).convert_dtypes()
        state.update((json.dumps(now.dump()),))

    return df.groupBy(key).applyInPandasWithState(run, schema, "state string", "append", GroupStateTimeout.NoTimeout)


class Ranges:
    """Whole numbers as ascending ranges; as large as there are gaps, not as there are numbers."""

    def __init__(self, pairs: Sequence[Sequence[int]] = ()):
        self.pairs = [list(p) for p in pairs]

    def append(self, low: int, high: int) -> None:
        """Add a range behind all others."""
        if low > high:
            return
        if self.pairs and self.pairs[-1][1] == low - 1:
            self.pairs[-1][1] = high
        else:
            self.pairs.append([low, high])

    def _at(self, x: int) -> int:
        at = bisect.bisect_right(self.pairs, [x, float("inf")]) - 1
        return at if at >= 0 and self.pairs[at][1] >= x else -1

    def __contains__(self, x: int) -> bool:
        return self._at(x) >= 0

    def remove(self, x: int) -> None:
        at = self._at(x)
        if at >= 0:
            low, high = self.pairs[at]
            self.pairs[at : at + 1] = [p for p in ([low, x - 1], [x + 1, high]) if p[0] <= p[1]]

    def drop_below(self, x: int) -> None:
        while self.pairs and self.pairs[0][1] < x:
            self.pairs.pop(0)
        if self.pairs:
            self.pairs[0][0] = max(self.pairs[0][0], x)

    def __len__(self) -> int:
        return sum(high - low + 1 for low, high in self.pairs)


class SequenceFold:
    """Position of one stream; gives (arrival, sequence, status, healthy, events released, missing, correction).

    The first event anchors it.  An event ahead of the expected position is held back, and what lies between counts as
    missing until it is released; one behind it, or seen before, is a duplicate.  A known position with another content
    is a correction; contents of the last ``keep`` positions are known.
    """

    def __init__(self, state: dict | None = None, keep: int = 10_000):
        s = state or {}
        self.expected, self.high, self.keep = s.get("expected"), s.get("high"), keep
        self.unseen, self.ahead = Ranges(s.get("unseen", ())), Ranges(s.get("ahead", ()))
        self.contents: dict[int, str] = {int(k): v for k, v in s.get("contents", {}).items()}

    def dump(self) -> dict:
        return {"expected": self.expected, "high": self.high, "unseen": self.unseen.pairs, "ahead": self.ahead.pairs, "contents": self.contents}

    def step(self, arrival: int, sequence: int | None, content: str, flagged: bool = False) -> tuple:
        if sequence is None:
            return arrival, None, "unsequenced", True, 1, 0, "not_applicable"
        if sequence in self.contents:
            correction = "unchanged" if self.contents[sequence] == content and not flagged else "correction"
        else:
            correction = "original"
        self.contents[sequence] = content
        while len(self.contents) > self.keep:
            self.contents.pop(next(iter(self.contents)))
        if self.expected is None:
            self.expected, self.high = sequence, sequence - 1
        status, released = "duplicate", 0
        if sequence > self.high:
            self.unseen.append(self.high + 1, sequence - 1)
            self.ahead.append(sequence, sequence)
            self.high, status = sequence, "gap"
        elif sequence in self.unseen:
            self.unseen.remove(sequence)
            status = "gap"
        if status == "gap" and sequence == self.expected:
            status, before = "in_order", self.expected
            self.expected = self.unseen.pairs[0][0] if self.unseen.pairs else self.high + 1
            self.ahead.drop_below(self.expected)
            released = self.expected - before
        missing = self.high - self.expected + 1 - len(self.ahead)
        return arrival, sequence, status, missing == 0, released, missing, correction


class LiveFold:
    """A running total with snapshots, corrections and gaps.

    A snapshot resets the total and the position.  A correction adds without advancing, also while a snapshot is
    awaited.  A delta applies only right after the last position; behind it, it is a duplicate, and ahead of it, it is
    dropped and a snapshot is awaited.
    """

    def __init__(self, state: list | None = None, snapshot_first: bool = False):
        self.snapshot_first = snapshot_first
        self.last, self.total, self.applied, self.corrected, self.awaiting = state or [None, 0, 0, 0, False]

    def dump(self) -> list:
        return [self.last, self.total, self.applied, self.corrected, self.awaiting]

    def step(self, arrival: int, kind: str, sequence: int | None, amount: int) -> tuple:
        status = self._apply(kind, sequence, amount)
        return arrival, sequence, status, self.awaiting, self.total, self.applied, self.corrected

    def _apply(self, kind: str, sequence: int | None, amount: int) -> str:
        if kind == "snapshot":
            self.total, self.awaiting = amount, False
            self.last = sequence if sequence is not None else self.last
            status = "snapshot_applied"
        elif kind == "correction":
            self.total += amount
            self.corrected += 1
            status = "correction_applied"
        elif sequence is None:
            self.total += amount
            status = "unsequenced"
        elif (self.last is None and not self.snapshot_first) or (self.last is not None and sequence == self.last + 1):
            self.total += amount
            self.last = sequence
            status = "applied"
        elif self.last is not None and sequence <= self.last:
            return "duplicate"
        else:
            self.awaiting = True
            return "gap_detected"
        self.applied += 1
        return status


class PaceFold:
    """Sliding-window limiter: (request, asked at, granted at).  Only the last ``per_window`` grants matter and are kept."""

    def __init__(self, state: list | None = None, per_window: int = 1, window_us: int = 0, spacing_us: int = 0):
        self.granted: list[int] = list(state or [])
        self.per_window, self.window_us, self.spacing_us = per_window, window_us, spacing_us

    def dump(self) -> list:
        return self.granted

    def step(self, at_us: int, request: int) -> tuple:
        go = at_us
        if self.granted:
            go = max(go, self.granted[-1] + self.spacing_us)
        if len(self.granted) >= self.per_window:
            go = max(go, self.granted[-self.per_window] + self.window_us)
        self.granted = [*self.granted, go][-self.per_window :]
        return request, at_us, go


class BucketFold:
    """Token bucket: (request, allowed).  Tokens refill with time up to the capacity."""

    def __init__(self, state: list | None = None, rate_per_s: float = 1.0, capacity: float = 1.0):
        self.tokens, self.last = state or [capacity, None]
        self.rate_per_s, self.capacity = rate_per_s, capacity

    def dump(self) -> list:
        return [self.tokens, self.last]

    def step(self, at_us: int, request: int) -> tuple:
        self.tokens = min(self.capacity, self.tokens + (0 if self.last is None else (at_us - self.last) / 1e6 * self.rate_per_s))
        self.last = at_us
        allowed = self.tokens >= 1
        self.tokens -= 1 if allowed else 0
        return request, allowed


class PipelineFold:
    """What a delivery of an event does, in this order: schema gate, content dedup, redelivery, correction, sequence.

    Gives (arrival, action, status, events delivered).  ``action`` is ``ack``, ``retry`` or ``term``; a failing handler is
    retried until ``most`` deliveries and then goes to the dead letters.  Contents count as processed once delivered, so a
    retry is not a duplicate.  Held back are only the events beyond a gap; contents known are the last ``keep``.

    An event that closes a gap releases those behind it.  If one of these fails, or the event itself is to be retried, what
    was not delivered waits in line: the line is tried again with every later event of the stream, and its head, after
    ``most`` failures, is a dead letter (``+dead_letter`` in the status).  While there is a line, events in order join it, so
    none is lost and none overtakes; a transport that only redelivers the releasing event would lose them.
    """

    def __init__(self, state: dict | None = None, most: int = 3, keep: int = 10_000):
        s = state or {}
        self.most, self.keep = most, keep
        self.processed: dict[str, None] = dict.fromkeys(s.get("processed", ()))
        self.contents: dict[int, str] = {int(k): v for k, v in s.get("contents", {}).items()}
        self.held: dict[int, list] = {int(k): v for k, v in s.get("held", {}).items()}
        self.line: list[list] = s.get("line", [])  # [content, fails, failures so far]
        self.awaited: str | None = s.get("awaited")  # the event that must be redelivered before the line moves
        self.sequence = SequenceFold(s.get("sequence"), keep=0)

    def dump(self) -> dict:
        return {"processed": list(self.processed), "contents": self.contents, "held": self.held, "line": self.line, "awaited": self.awaited, "sequence": self.sequence.dump()}

    def _done(self, content: str) -> None:
        self.processed[content] = None
        while len(self.processed) > self.keep:
            self.processed.pop(next(iter(self.processed)))

    def _move(self) -> tuple[int, bool]:
        """Deliver the line as far as it goes: how many, and whether its head was given up."""
        n, gave_up = 0, False
        while self.line and self.awaited is None:
            content, fails, failures = self.line[0]
            if fails and failures + 1 < self.most:
                self.line[0][2] += 1
                break
            self.line.pop(0)
            gave_up |= fails
            if not fails:
                self._done(content)
                n += 1
        return n, gave_up

    def _deliver(self, ready: list, deliveries: int, status: str) -> tuple[str, str, int]:
        (content, fails), behind = ready[0], [[c, f, 0] for c, f in ready[1:]]
        if fails and deliveries < self.most:
            self.line += behind
            self.awaited = content if behind else self.awaited
            return "retry", "retry", 0
        if not fails:
            self._done(content)
        if self.awaited == content:
            self.awaited = None
        self.line += behind
        n, gave_up = self._move()
        action, said = ("term", "dead_letter") if fails else ("ack", status)
        return action, f"{said}+dead_letter" if gave_up else said, n + (not fails)

    def step(self, arrival: int, supported: bool, content: str, redelivered: bool, corrects: bool, sequence: int | None, fails: bool, deliveries: int) -> tuple:
        before, gave_up = self._move()
        action, status, n = self._decide(supported, content, redelivered, corrects, sequence, fails, deliveries)
        return arrival, action, f"{status}+dead_letter" if gave_up and not status.endswith("+dead_letter") else status, n + before

    def _decide(self, supported: bool, content: str, redelivered: bool, corrects: bool, sequence: int | None, fails: bool, deliveries: int) -> tuple[str, str, int]:
        if not supported:
            return "term", "schema_mismatch", 0
        if content in self.processed:
            return "ack", "duplicate", 0
        one = [(content, fails)]
        if redelivered:
            return self._deliver(one, deliveries, "delivered")
        if sequence is None:
            return self._deliver(one, deliveries, "correction" if corrects else "delivered")
        known = self.contents.get(sequence)
        self.contents[sequence] = content
        while len(self.contents) > self.keep:
            self.contents.pop(next(iter(self.contents)))
        if corrects or (known is not None and known != content):
            return self._deliver(one, deliveries, "correction")
        before = self.sequence.expected
        status, released = self.sequence.step(0, sequence, content)[2], self.sequence.expected
        if status == "duplicate":
            return "ack", "duplicate", 0
        if status == "gap":
            self.held[sequence] = [content, fails]
            return "ack", "buffered_gap", 0
        first = sequence if before is None else before
        ready = one + [tuple(self.held.pop(n)) for n in range(first + 1, released) if n in self.held]
        if self.line:
            self.line += [[c, f, 0] for c, f in ready]
            return "ack", "in_line", 0
        return self._deliver(ready, deliveries, "delivered")
