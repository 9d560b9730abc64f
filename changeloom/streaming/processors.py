"""Keyed state for the rules that look back over single orders or sales.

Each processor keeps what its rules can still reach and works on whole micro-batches with array operations.  Rules and output
fields are the batch operators' columns, applied after it.  Within a micro-batch events are put in order.  Across
micro-batches an event counts what arrived before it and lies in its own window, so a late event neither misses earlier ones
nor hides itself from later ones.

Keys share groups, whose rows are worked on together.  Events are kept in buckets of time, one entry of a map state for a key's
bucket: a micro-batch reads the buckets its windows reach and writes those it adds to, so the state it writes grows with the batch,
not with the key.  Buckets out of reach leave when their key has a new event, or by an event-time timer, which empties idle keys too.

All columns come and go as whole numbers without nulls (``NONE`` for none): ids and cents beyond 2^53 keep their digits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.times import duration_micros
from ..operators.anomalies import Limits

#: Stands for a missing number; sorts first.
NONE = -(1 << 63)

FEATURES = (
    "customer_id bigint, id bigint, cents bigint, event_us bigint, total_customer_orders bigint, total_cents bigint, "
    "spike_count bigint, rapid_count bigint, mean_amount double, stddev_amount double, z_score double"
)

STOCK_ROWS = (
    "product_id bigint, event_kind string, event_us bigint, name string, price_cents bigint, "
    "current_stock bigint, units bigint, sale_us bigint, restock_us bigint"
)

_MILLI = 1000


def _batch(rows: Iterator[pd.DataFrame], order: Sequence[str]) -> dict[str, np.ndarray]:
    """The micro-batch of one group as arrays in order."""
    parts = list(rows)
    frame = parts[0] if len(parts) == 1 else pd.concat(parts)
    at = np.lexsort([frame[c].to_numpy(np.int64) for c in reversed(order)])
    return {c: frame[c].to_numpy()[at] for c in frame.columns}


def _last(mask: np.ndarray) -> np.ndarray:
    """Position of the last true entry up to each position, or -1."""
    return np.maximum.accumulate(np.where(mask, np.arange(len(mask)), -1))


def _parts(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows in order of their key: the first and the last row of each key's part, and each row's number of part."""
    opens = np.concatenate([[True], key[1:] != key[:-1]])
    first = np.flatnonzero(opens)
    return first, np.append(first[1:], len(key)) - 1, np.cumsum(opens) - 1


def _within(old: np.ndarray, amounts: np.ndarray, now: np.ndarray, added: np.ndarray, width: int) -> np.ndarray:
    """``_within_parts`` for the rows of one key, whose amounts are ``added``."""
    none = np.zeros(len(old), np.int64), np.zeros(len(now), np.int64)
    return _within_parts(none[0], old, amounts, none[1], now, np.concatenate([[0], np.cumsum(added)]), width)


def _within_parts(
    of: np.ndarray, old: np.ndarray, amounts: np.ndarray, part: np.ndarray, now: np.ndarray, total: np.ndarray, width: int,
) -> np.ndarray:
    """Per new row: the sum of its key's amounts that arrived up to it and lie after its time less ``width``.

    New rows are in order of ``part``, the number of their key, and time; ``total`` are running totals of their amounts, from 0.
    ``old`` are times of stored amounts and ``of`` the numbers of their keys, in any order, as late events join them.
    """
    edge = now - width
    # A key's number and the rank of a time as one number.
    moments = np.unique(np.concatenate([now, edge, old]))
    size = len(moments)
    place, edges = (part * size + np.searchsorted(moments, t) for t in (now, edge))
    found = total[1:] - total[np.searchsorted(place, edges, side="right")]
    if len(of):
        stored = of * size + np.searchsorted(moments, old)
        at = np.argsort(stored, kind="stable")
        stored, run = stored[at], np.concatenate([[0], np.cumsum(amounts[at])])
        found += run[np.searchsorted(stored, (part + 1) * size, side="left")] - run[np.searchsorted(stored, edges, side="right")]
    return found


class _Share:
    """The buckets of one owner in a map state that many share, as a map of their own.

    ``numbers`` are the buckets there may be: no call is made for others.
    """

    def __init__(self, state, owner: int, numbers: Sequence[int]):
        self.state, self.owner, self.numbers = state, owner, set(numbers)

    def getValue(self, key: tuple) -> tuple | None:
        return self.state.getValue((self.owner, *key)) if key[0] in self.numbers else None

    def updateValue(self, key: tuple, value: tuple) -> None:
        self.numbers.add(key[0])
        self.state.updateValue((self.owner, *key), value)

    def removeKey(self, key: tuple) -> None:
        if key[0] in self.numbers:
            self.numbers.remove(key[0])
            self.state.removeKey((self.owner, *key))

    def keys(self) -> Iterator[tuple]:
        return iter([(b,) for b in self.numbers])


class Buckets:
    """Timed values of one key in a map state: bucket number to (times, values)."""

    #: Buckets looked up one by one; a longer reach goes through the map's keys.
    FEW = 48

    def __init__(self, state, width: int, kept: int):
        self.state, self.width, self.kept = state, width, kept
        self.held: dict[int, tuple[list[int], list[int]]] = {}

    def read(self, low: int, high: int, oldest: int, newest: int, horizon: int) -> tuple[np.ndarray, np.ndarray]:
        """Values with times in [low, high] that are newer than the horizon; buckets from oldest to newest may exist."""
        first, last = max(low // self.width, oldest), min(high // self.width, newest)
        near = last - first < self.FEW
        wanted = range(first, last + 1) if near else [k[0] for k in self.state.keys() if first <= k[0] <= last]
        values = ((b, self.state.getValue((b,))) for b in wanted)
        self.held = {b: value for b, value in values if value is not None}  # a timer may have removed it
        none = np.zeros(0, np.int64)
        times = np.concatenate([none, *[np.asarray(t, np.int64) for t, _ in self.held.values()]])
        amounts = np.concatenate([none, *[np.asarray(a, np.int64) for _, a in self.held.values()]])
        return times[times > horizon], amounts[times > horizon]

    def end(self, newest: int) -> int:
        """The last moment of a bucket.  What arrived before an event counts for it, however much later it lies, so reads go on to the
        newest bucket."""
        return (newest + 1) * self.width - 1

    def add(self, times: np.ndarray, amounts: np.ndarray, horizon: int) -> list[int]:
        """Write the buckets of new values; the numbers of buckets that did not exist."""
        times, amounts = times[times > horizon], amounts[times > horizon]
        number, fresh = times // self.width, []
        for b in np.unique(number).tolist():
            here = number == b
            old = self.held.get(b, ([], []))
            if b not in self.held:
                fresh.append(b)
            self.state.updateValue((b,), ([*old[0], *times[here].tolist()], [*old[1], *amounts[here].tolist()]))
        return fresh

    def drop(self, oldest: int, horizon: int) -> int:
        """Remove buckets that end at or before the horizon; the oldest number that may be left."""
        left = (horizon + 1) // self.width
        if oldest < left:
            wanted = range(oldest, left) if left - oldest < 4 else [k[0] for k in self.state.keys() if k[0] < left]
            for b in wanted:
                self.state.removeKey((b,))
        return max(oldest, left)

    def timer(self, bucket: int) -> int:
        """Milliseconds of event time at which a bucket is out of reach."""
        return ((bucket + 1) * self.width + self.kept) // _MILLI + 1

    def timed_out(self, expired_ms: int) -> int:
        """The bucket of a timer."""
        return ((expired_ms - 1) * _MILLI - self.kept) // self.width - 1


def _exact(amounts: np.ndarray, rows: int) -> np.ndarray:
    """As int64 where sums of squares over the array, times ``rows``, fit; as Python integers otherwise."""
    top = int(np.abs(amounts).max(initial=0))
    return amounts if max(len(amounts), rows) * rows * top * top < 1 << 62 else amounts.astype(object)


class AnomalyProcessor(StatefulProcessor):
    """State per customer, kept by shard: totals, last amounts in cents, and recent order times.

    A group is a shard of customers, whose rows are worked on together: a group costs some milliseconds a micro-batch, whatever it
    holds, and each call to the state a third of one.  A customer has one row, which holds up to ``FEW`` order times; where there
    are more, times lie in buckets of an hour, an entry each.  With ``timers`` all lie there, and an hour leaves its shard by
    an event-time timer.
    """

    FEW = 64

    def __init__(self, limits: Limits = Limits(), timers: bool = False):
        self.limits, self.timers = limits, timers
        self.spike = self.width = duration_micros(limits.spike_window)
        self.rapid = duration_micros(limits.rapid_window)
        self.kept = max(self.spike, self.rapid, duration_micros(limits.kept))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.amounts = handle.getMapState(
            "amounts", "customer_id bigint",
            "n bigint, total bigint, horizon bigint, cents array<bigint>, times array<bigint>, buckets array<bigint>",
        )
        self.recent = handle.getMapState("recent", "customer_id bigint, bucket bigint", "times array<bigint>, amounts array<bigint>")
        self.buckets = Buckets(self.recent, self.width, self.kept)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = _batch(rows, ["customer_id", "event_us", "id"])
        customer, now, cents = (batch[c].astype(np.int64) for c in ("customer_id", "event_us", "cents"))
        first, last, part = _parts(customer)
        ids, size = customer[first].tolist(), self.limits.z_rows
        met = [tuple(self.amounts.getValue((c,)) or (0, 0, NONE, (), (), ())) for c in ids]
        n0, total0, horizon = (np.array([m[f] for m in met], np.int64) for f in range(3))
        buckets = {k: self._of(ids[k], m[5]) for k, m in enumerate(met) if m[5]}
        since = (now[first] - max(self.spike, self.rapid)).tolist()
        times = [self._times(buckets[k], since[k], m[2]) if k in buckets else m[4] for k, m in enumerate(met)]

        # Exact integer sums over the last rows of a customer, as differences of running totals.
        stored = np.array([len(m[3]) for m in met])
        shift, place = np.cumsum(stored), np.arange(len(now) + 1)
        end = place[1:] + shift[part]
        amounts = np.zeros(len(now) + shift[-1], np.int64)
        amounts[end - 1] = cents
        amounts[np.delete(np.arange(len(amounts)), end - 1)] = [x for m in met for x in m[3]]
        amounts = _exact(amounts, size)
        run = np.concatenate([[0], np.cumsum(amounts)])
        squares = np.concatenate([[0], np.cumsum(amounts * amounts)])
        begin = np.maximum((first + shift - stored)[part], end - size)
        n = end - begin
        s, q = run[end] - run[begin], squares[end] - squares[begin]
        spread = (n.astype(amounts.dtype) * q - s * s).astype(float)
        pairs = np.maximum(1, n * (n - 1))
        mean = s.astype(float) / n / 100.0
        deviation = np.sqrt(spread / pairs) / 100.0
        scored = (n >= self.limits.z_min_rows) & (deviation > 0)
        z = np.where(scored, (cents / 100.0 - mean) / np.where(scored, deviation, 1.0), np.nan)

        paid = np.concatenate([[0], np.cumsum(cents)])
        total = (total0 - paid[first])[part] + paid[1:]
        of, old = np.repeat(np.arange(len(ids)), [len(t) for t in times]), np.array([t for ts in times for t in ts], np.int64)
        spikes, rapids = (_within_parts(of, old, np.ones(len(old), np.int64), part, now, place, w) for w in (self.spike, self.rapid))
        yield pd.DataFrame({
            "customer_id": customer,
            "id": batch["id"],
            "cents": cents,
            "event_us": now,
            "total_customer_orders": (n0 - first)[part] + place[1:],
            "total_cents": total,
            "spike_count": spikes,
            "rapid_count": rapids,
            "mean_amount": mean,
            "stddev_amount": np.where(n > 1, deviation, np.nan),
            "z_score": z,
        })

        # What lies before the horizon no later event may count.
        horizon = np.maximum(horizon, now[last] - self.kept).tolist()
        counts, total, now, cents, fresh = (n0 + last + 1 - first).tolist(), total[last].tolist(), now.tolist(), cents.tolist(), set()
        for k, (c, f, l) in enumerate(zip(ids, first.tolist(), (last + 1).tolist())):
            kept, numbers = [t for t in (*met[k][4], *now[f:l]) if t > horizon[k]], []
            if self.timers or k in buckets or len(kept) > self.FEW:
                own = buckets.get(k) or self._of(c, ())
                fresh.update(own.add(np.array(kept, np.int64), np.ones(len(kept), np.int64), horizon[k]))
                if own.state.numbers:
                    own.drop(min(own.state.numbers), horizon[k])
                kept, numbers = [], sorted(own.state.numbers)
            self.amounts.updateValue((c,), (counts[k], total[k], horizon[k], [*met[k][3], *cents[f:l]][-size:], kept, numbers))
        if self.timers:
            for b in sorted(fresh):
                self.handle.registerTimer(self.buckets.timer(b))

    def _of(self, customer: int, numbers: Sequence[int]) -> Buckets:
        return Buckets(_Share(self.recent, customer, numbers), self.width, self.kept)

    def _times(self, buckets: Buckets, low: int, horizon: int) -> list[int]:
        """Order times in a customer's buckets that its new orders can reach."""
        oldest, newest = min(buckets.state.numbers), max(buckets.state.numbers)
        return buckets.read(low, buckets.end(newest), oldest, newest, horizon)[0].tolist()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        bucket = self.buckets.timed_out(expiredTimerInfo.getExpiryTimeInMs())
        for k in [k for k in self.recent.keys() if k[1] == bucket]:
            self.recent.removeKey(tuple(k))
        return iter(())

    def close(self) -> None:
        pass


class InventoryProcessor(StatefulProcessor):
    """State per product, kept by shard: shown fields, stock, last sale and restock, and sales of the velocity window by the day.

    Rows carry ``product_id, kind`` (0 product, 1 item), ``name, price_cents, set, qty, event_us`` and ties.  A group is a shard of
    products, whose rows are worked on together; its map states have an entry per product, and per product and day.  With
    ``timers`` a day leaves its shard by an event-time timer.
    """

    def __init__(self, ties: tuple[str, ...], window: int, timers: bool = False):
        self.ties, self.kept, self.timers = list(ties), window, timers
        self.width = duration_micros("1 day")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.stock = handle.getMapState(
            "stock", "product_id bigint",
            "known boolean, name string, price bigint, stock bigint, sale bigint, restock bigint, horizon bigint, days array<bigint>",
        )
        self.recent = handle.getMapState("recent", "product_id bigint, day bigint", "times array<bigint>, amounts array<bigint>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = _batch(rows, ["product_id", "event_us", "kind", *self.ties])
        product, now, qty, given = (batch[c].astype(np.int64) for c in ("product_id", "event_us", "qty", "set"))
        is_set = batch["kind"] == 0
        first, last, part = _parts(product)
        begin, ids = first[part], product[first].tolist()
        met = [self.stock.getValue((p,)) for p in ids] if self.stock.exists() else [None] * len(ids)
        seen = [tuple(m) if m is not None else (False, None, NONE, 0, NONE, NONE, NONE, []) for m in met]
        known, name, price, stock, sale, restock, horizon, days = map(list, zip(*seen))
        known, name = np.array(known, bool), np.array(name, object)
        price, stock, sale, restock, horizon = (np.array(c, np.int64) for c in (price, stock, sale, restock, horizon))

        # A product event at running total S0 lifts the ceiling to stock + S0 (see batch twin).
        total = np.concatenate([[0], np.cumsum(qty)])
        sold = total[1:] - total[begin]
        shown = _last(is_set)
        has_set = shown >= begin
        ceiling = np.where(has_set, (given + sold)[shown], stock[part])
        after = np.where(has_set | known[part], np.maximum(0, ceiling - sold), 0)
        before = np.concatenate([[0], after[:-1]])
        before[first] = stock

        def carried(values: np.ndarray, mask: np.ndarray, old: np.ndarray) -> np.ndarray:
            at = _last(mask)
            return np.where(at >= begin, values[at], old[part])

        held = self._held(ids, now[first], days)
        names, prices = carried(batch["name"], is_set, name), carried(batch["price_cents"].astype(np.int64), is_set, price)
        sales, restocks = carried(now, ~is_set, sale), carried(now, is_set & (given > before), restock)
        yield pd.DataFrame({
            "product_id": product,
            "event_kind": np.where(is_set, "product", "sale"),
            "event_us": now,
            "name": names,
            "price_cents": prices,
            "current_stock": after,
            "units": self._units(held, horizon, part, now, total),
            "sale_us": sales,
            "restock_us": restocks,
        })

        horizon = np.maximum(horizon, now[last] - self.kept)
        kept = np.flatnonzero((qty != 0) & (now > horizon[part]))
        added: dict[tuple[int, int], tuple[list[int], list[int]]] = {}
        for k, day, t, q in zip(part[kept].tolist(), (now[kept] // self.width).tolist(), now[kept].tolist(), qty[kept].tolist()):
            times, amounts = added.setdefault((k, day), ([], []))
            times.append(t)
            amounts.append(q)
        for (k, day), (times, amounts) in added.items():
            old = held.get((k, day)) or (self.recent.getValue((ids[k], day)) if day in days[k] else None) or ([], [])
            self.recent.updateValue((ids[k], day), ([*old[0], *times], [*old[1], *amounts]))
            if day not in days[k]:
                days[k] = [*days[k], day]
                if self.timers:
                    self.handle.registerTimer(((day + 1) * self.width + self.kept) // _MILLI + 1)
        left = (horizon + 1) // self.width
        known = known | np.logical_or.reduceat(is_set, first)
        for k, row in enumerate(zip(
            known.tolist(), names[last].tolist(), prices[last].tolist(), after[last].tolist(), sales[last].tolist(), restocks[last].tolist(),
            horizon.tolist(),
        )):
            for day in days[k]:
                if day < left[k]:
                    self.recent.removeKey((ids[k], day))
            self.stock.updateValue((ids[k],), (*row, [d for d in days[k] if d >= left[k]]))

    def _held(self, ids: list[int], since: np.ndarray, days: list[list[int]]) -> dict[tuple[int, int], tuple]:
        """Stored sales that the first event of a product or a later one can reach, by product's number and day."""
        found = {}
        for k, low in enumerate(((since - self.kept) // self.width).tolist()):
            for day in days[k]:
                value = self.recent.getValue((ids[k], day)) if day >= low else None
                if value is not None:  # a timer may have removed it
                    found[k, day] = tuple(value)
        return found

    def _units(self, held: dict, horizon: np.ndarray, part: np.ndarray, now: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Per row: units of its product that arrived up to it and were sold after its time less the window."""
        none = np.zeros(0, np.int64)
        of = np.concatenate([none, *[np.full(len(t), k) for (k, _), (t, _) in held.items()]])
        times = np.concatenate([none, *[np.asarray(t, np.int64) for t, _ in held.values()]])
        amounts = np.concatenate([none, *[np.asarray(a, np.int64) for _, a in held.values()]])
        there = times > horizon[of]
        return _within_parts(of[there], times[there], amounts[there], part, now, total, self.kept)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        day = ((expiredTimerInfo.getExpiryTimeInMs() - 1) * _MILLI - self.kept) // self.width - 1
        for k in [k for k in self.recent.keys() if k[1] == day]:
            self.recent.removeKey(tuple(k))
        return iter(())

    def close(self) -> None:
        pass
