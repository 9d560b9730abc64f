"""Alerts with a waiting time, as a state machine per series: pending, firing, resolved.

A condition that comes true makes its alert pending; after the waiting time it fires, also if no sample comes any more: an event-time
timer fires it when the watermark passes that moment.  A false sample resolves a firing alert and ends a pending one.
Samples wait in the state until the watermark has passed them and are then taken in the order of their times, so late samples within
the watermark change nothing, and the transitions equal those of ``quality.alert_states``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.times import duration_micros, micros
from ..operators.quality import FIRING, INACTIVE, PENDING, RESOLVED
from .pipelines import SHARDS, WATERMARK, with_event_time


class AlertProcessor(StatefulProcessor):
    """State per shard of series: samples the watermark has not passed, and the alerts that are pending or firing with their beginning.

    A group costs some milliseconds a micro-batch, whatever it holds, so series share groups; a shard's state is read and written once.
    """

    def __init__(self, series: str, kind: str, wait: int):
        self.series, self.kind, self.wait = series, kind, wait

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getValueState("waiting", f"series array<{self.kind}>, at array<bigint>, place array<bigint>, is_on array<boolean>")
        self.alerts = handle.getValueState("alerts", f"series array<{self.kind}>, state array<string>, since array<bigint>, timer bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        columns = [[], [], [], []]
        for part in rows:
            for column, name in zip(columns, (self.series, "at", "place", "is_on")):
                column += part[name].tolist()
        yield from self._advance(columns, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._advance([[], [], [], []], timerValues)

    def _advance(self, new: list[list], timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        names, states, begun, timer = self.alerts.get() or ([], [], [], -1)
        alerts = {name: (state, since) for name, state, since in zip(names, states, begun)}
        held = self.waiting.get()
        columns = [[*old, *added] for old, added in zip(held, new)] if held else new
        # Series in any order; the samples of each by time.
        due: dict = {name: [] for name, (state, since) in alerts.items() if state == PENDING and since + self.wait <= mark}
        later = []
        for sample in zip(*columns):
            if sample[1] > mark:
                later.append(sample)
            else:
                due.setdefault(sample[0], []).append(sample[1:])
        moves: list[tuple] = []
        for name, samples in due.items():
            state, since = alerts.pop(name, (INACTIVE, 0))
            state, since, moved = self._moves(state, since, sorted(samples), mark)
            moves += [(name, *move) for move in moved]
            if state in (PENDING, FIRING):  # a quiet series leaves the state
                alerts[name] = (state, since)
        if later:
            self.waiting.update(tuple(map(list, zip(*later))))
        elif held:
            self.waiting.clear()
        # The next moment at which anything can happen.
        times = [s[1] for s in later] + [since + self.wait for state, since in alerts.values() if state == PENDING]
        soon = min(times) // 1000 if times else -1
        if soon >= 0 and soon != timer:
            self.handle.registerTimer(soon)
        if alerts or later:
            self.alerts.update((list(alerts), [a[0] for a in alerts.values()], [a[1] for a in alerts.values()], soon))
        elif self.alerts.exists():
            self.alerts.clear()
        if moves:
            yield pd.DataFrame({self.series: [m[0] for m in moves], "state": [m[1] for m in moves], "at_us": [m[2] for m in moves]})

    def _moves(self, state: str, since: int, samples: list[tuple], mark: int) -> tuple[str, int, list[tuple[str, int]]]:
        """A series' state and its beginning after samples in order, and the transitions on the way."""
        moves: list[tuple[str, int]] = []
        for at, _, is_on in samples:
            # A false sample at the very end of the waiting time comes first.
            if state == PENDING and (since + self.wait < at or is_on and since + self.wait == at):
                state = FIRING
                moves.append((FIRING, since + self.wait))
            if is_on and state in (INACTIVE, RESOLVED):
                state, since = PENDING, at
                moves.append((PENDING, at))
                if self.wait == 0:
                    state = FIRING
                    moves.append((FIRING, at))
            elif not is_on and state in (PENDING, FIRING):
                state = RESOLVED if state == FIRING else INACTIVE
                moves.append((state, at))
        if state == PENDING and since + self.wait <= mark:
            state = FIRING
            moves.append((FIRING, since + self.wait))
        return state, since, moves

    def close(self) -> None:
        pass


def alert_stream(
    samples: DataFrame, condition: Column, wait: str, series: str, ts: str = "event_ts", delay: str = WATERMARK, order: str | None = None,
) -> DataFrame:
    """``series, state, at``: the transitions of each series' alert, up to the watermark (append mode).

    ``order`` is a number that orders samples of one time.
    """
    rows = with_event_time(samples, delay, ts).filter(F.col(ts).isNotNull() & F.col(series).isNotNull()).select(
        F.col(series), ts, micros(F.col(ts)).alias("at"), (F.col(order) if order else F.lit(0)).cast("bigint").alias("place"),
        F.coalesce(condition, F.lit(False)).alias("is_on"),
    )
    kind = samples.schema[series].dataType.simpleString()
    found = rows.withColumn("_shard", F.pmod(F.xxhash64(series), F.lit(SHARDS))).groupBy("_shard").transformWithStateInPandas(
        statefulProcessor=AlertProcessor(series, kind, duration_micros(wait)), outputStructType=f"`{series}` {kind}, state string, at_us bigint",
        outputMode="Append", timeMode="EventTime",
    )
    return found.select(series, "state", F.timestamp_micros("at_us").alias("at"))
