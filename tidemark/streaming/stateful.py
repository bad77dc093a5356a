"""Gap-aware ordering of streams with state by position, bounded by event time.

State of one stream is a few numbers, a map of the events held beyond a gap, and a map of the contents of known positions;
each position is an entry of its own in the state store, so a micro-batch touches only the positions it brings.  Timers in
event time bound both maps: a gap that lasts longer than ``patience`` is given up, its loss is reported and what it held
back goes on; contents are known for ``keep``, after which another content under their position is no longer told from
a first one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The state store that keeps maps by entry.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TOLD = "stream_key string, arrival long, sequence long, status string, healthy boolean, n_ready long, n_missing long, correction string, n_lost long"
HEAD = "expected long, high long, n_ahead long, sweep long, n_highs long"


class Tracker(StatefulProcessor):
    """Rows (``stream_key``, ``arrival``, ``sequence``, ``content``, ``flagged``, ``event_time``) to verdicts."""

    def __init__(self, patience_ms: int, keep_ms: int):
        self.patience_ms, self.keep_ms = patience_ms, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = handle.getValueState("head", HEAD)
        self.ahead = handle.getMapState("ahead", "sequence long", "at_ms long, new_high boolean")
        self.contents = handle.getMapState("contents", "sequence long", "content string, at_ms long")

    def _load(self) -> list:
        return list(self.head.get()) if self.head.exists() else [None, None, 0, None, 0]

    @staticmethod
    def _missing(head: list) -> int:
        """Positions up to the highest that are not released, less those held that came as a new highest."""
        return head[1] - head[0] + 1 - head[4]

    def _release(self, head: list) -> int:
        """Take what follows from the expected position on; returns how many."""
        n = 0
        while head[2] and self.ahead.containsKey((head[0] + n,)):
            head[4] -= self.ahead.getValue((head[0] + n,))[1]
            self.ahead.removeKey((head[0] + n,))
            head[2], n = head[2] - 1, n + 1
        head[0] += n
        return n

    def _corrects(self, sequence: int, content: str, flagged: bool, at_ms: int) -> str:
        known = self.contents.getValue((sequence,)) if self.contents.containsKey((sequence,)) else None
        self.contents.updateValue((sequence,), (content, at_ms))
        if known is None:
            return "original"
        return "unchanged" if known[0] == content and not flagged else "correction"

    def _step(self, head: list, sequence: int, at_ms: int) -> tuple[str, int]:
        if head[0] is None:
            head[0], head[1] = sequence, sequence - 1
        if sequence < head[0]:
            return "duplicate", 0
        if sequence == head[0]:
            head[0], head[1] = sequence + 1, max(head[1], sequence)
            return "in_order", 1 + self._release(head)
        if head[2] and self.ahead.containsKey((sequence,)):
            return "duplicate", 0
        new_high = sequence > head[1]
        self.ahead.updateValue((sequence,), (at_ms, new_high))
        head[1], head[2], head[4] = max(head[1], sequence), head[2] + 1, head[4] + new_high
        self.handle.registerTimer(at_ms + self.patience_ms)
        return "gap", 0

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        head, out = self._load(), []
        frame = pd.concat(list(rows)).sort_values("arrival", kind="stable")
        times = (frame["event_time"].astype("datetime64[ms]").astype("int64")).tolist()
        for arrival, sequence, content, flagged, at_ms in zip(frame["arrival"].tolist(), frame["sequence"].tolist(), frame["content"].tolist(), frame["flagged"].tolist(), times, strict=True):
            if sequence is None or sequence != sequence:
                out.append((key[0], arrival, None, "unsequenced", True, 1, 0, "not_applicable", 0))
                continue
            sequence = int(sequence)
            correction = self._corrects(sequence, content, bool(flagged), at_ms)
            status, n_ready = self._step(head, sequence, at_ms)
            missing = self._missing(head)
            out.append((key[0], arrival, sequence, status, missing == 0, n_ready, missing, correction, 0))
            if head[3] is None:
                head[3] = at_ms + self.keep_ms
                self.handle.registerTimer(head[3])
        self.head.update(tuple(head))
        yield _frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, head, out = expiredTimerInfo.getExpiryTimeInMs(), self._load(), []
        while head[2]:
            first, at_ms = min((k[0], v[0]) for k, v in self.ahead.iterator())
            if at_ms + self.patience_ms > now:
                self.handle.registerTimer(at_ms + self.patience_ms)
                break
            lost, head[0] = first - head[0], first
            n_ready = self._release(head)
            missing = self._missing(head)
            out.append((key[0], None, first - 1, "lost", missing == 0, n_ready, missing, "not_applicable", lost))
        if head[3] is not None and head[3] <= now:
            ages = [(k[0], v[1]) for k, v in self.contents.iterator()]
            for sequence, at_ms in ages:
                if at_ms + self.keep_ms <= now:
                    self.contents.removeKey((sequence,))
            left = [at_ms for _, at_ms in ages if at_ms + self.keep_ms > now]
            head[3] = min(left) + self.keep_ms if left else None
            if left:
                self.handle.registerTimer(head[3])
        self.head.update(tuple(head))
        yield _frame(out)

    def close(self) -> None:
        pass


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [c.split()[0] for c in TOLD.split(", ")]
    return pd.DataFrame(rows, columns=names).astype({"arrival": "Int64", "sequence": "Int64"})


def track_stream(events: DataFrame, patience: str = "5 minutes", keep: str = "1 hour", delay: str = "0 seconds") -> DataFrame:
    """Verdicts of a stream of events, as ``sequence.track`` gives them, and a row ``lost`` for each gap that was given up.

    ``events``: (``stream_key``, ``arrival``, ``sequence``, ``content``, ``flagged``, ``event_time``).  Rows of a micro-batch
    are taken in order of ``arrival``; ``delay`` is how late in event time they may come.  State is what came within
    ``keep`` and what is held behind gaps younger than ``patience``, whatever a stream's length.  Rows without an event time
    are left out.  The session's state store must be ``PROVIDER``.
    """
    ms = lambda text: int(pd.Timedelta(text).total_seconds() * 1000)
    rows = events.select("stream_key", "arrival", "sequence", "content", F.coalesce("flagged", F.lit(False)).alias("flagged"), "event_time")
    timed = rows.where("event_time IS NOT NULL").withWatermark("event_time", delay)
    return timed.groupBy("stream_key").transformWithStateInPandas(Tracker(ms(patience), ms(keep)), TOLD, "append", "EventTime")
