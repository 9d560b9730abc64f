"""Patterns over a key's events: sequences, gaps, repetition and negation.

A pattern is a list of steps.  Each step names a kind of event, how soon after the step before it must come, how often it is
repeated, and kinds that must not come in between.  It is compiled into one running state per step: the beginning of
the best partial match that has come as far as the step, which is the latest one, as a later beginning is never worse.
That state is a last value in event order, so ``per_key`` carries it over the chunks of a hot key, and a pattern of n
steps is n running passes over one sort.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.times import duration_micros, micros
from .envelope import require_key
from .ordered import per_key


@dataclass(frozen=True)
class Step:
    """An event for which ``when`` holds; ``within`` bounds its distance from the event of the step before (each repetition
    counts as a step), and no event for which ``unless`` holds may lie between the two."""

    when: Column
    within: str | None = None
    times: int = 1
    unless: Column | None = None


def compiled(steps: Sequence[Step]) -> list[Step]:
    """Repetitions written out; the bound on the first event is none."""
    if not steps or any(s.times < 1 for s in steps):
        raise ValueError("a pattern has steps, and each stands at least once")
    flat = [Step(s.when, s.within, 1, s.unless) for s in steps for _ in range(s.times)]
    return [Step(flat[0].when, None, 1, None), *flat[1:]]


def match(
    events: DataFrame, steps: Sequence[Step], key: str = "customer_id", order: Sequence[str] = ("event_us", "id"), max_rows: int | None = None,
) -> DataFrame:
    """``key``, the order columns of the event that completes a match, and ``started_us``: when the latest match it completes began.

    Steps follow each other in event order, with other events between them unless excluded; matches may share events.  The first
    order column is a time in microseconds.  Events without a key or a time match nothing.
    """
    at, plan = order[0], compiled(steps)
    if "event_us" not in events.columns and at == "event_us":
        events = events.withColumn("event_us", micros(F.col("event_ts")))
    flags = {f"_is_{i}": F.coalesce(s.when, F.lit(False)) for i, s in enumerate(plan)}
    bars = {f"_bar_{i}": F.coalesce(s.unless, F.lit(False)) for i, s in enumerate(plan) if s.unless is not None}
    rows = require_key(events, key).filter(F.col(at).isNotNull()).select(
        key, *order, *[c.alias(n) for n, c in {**flags, **bars}.items()]
    )

    def body(d: DataFrame, scan) -> DataFrame:
        # How far step i has come at each event of its kind: when the match began, and when this step stood.
        d = d.withColumn("_m0", F.when(F.col("_is_0"), F.struct(F.col(at).alias("began"), F.col(at).alias("stood"))))
        for i, step in enumerate(plan[1:], 1):
            held, barred = F.col(f"_m{i - 1}"), f"_bar_{i}"
            if barred in bars:
                # An excluded event ends the partial matches before it: it is a last value of its own.
                ended = F.struct(F.lit(None).cast("bigint").alias("began"), F.lit(None).cast("bigint").alias("stood"))
                held = F.coalesce(held, F.when(F.col(barred), ended))
            d = scan.running(d, lasts={f"_l{i}": held})
            last = F.col(f"_l{i}")
            fits = F.col(f"_is_{i}") & last["began"].isNotNull()
            if step.within is not None:
                fits = fits & (F.col(at) - last["stood"] <= duration_micros(step.within))
            d = d.withColumn(f"_m{i}", F.when(fits, F.struct(last["began"].alias("began"), F.col(at).alias("stood"))))
        return d

    found = per_key(rows, key, list(order), body, max_rows)
    done = F.col(f"_m{len(plan) - 1}")
    return found.filter(done.isNotNull()).select(key, *order, done["began"].alias("started_us"))
