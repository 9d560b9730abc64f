"""Event patterns against a search over all partial matches, with plain windows and with hot keys cut into chunks."""

import random

import pytest
from pyspark.sql import functions as F

from changeloom.operators.patterns import Step, compiled, match

MINUTE = 60_000_000
KINDS = "abcx"


def brute(events, plan):
    """(key, time, id, latest beginning) of each event that completes a match; steps are (kind, minutes, excluded)."""
    out = []
    for key in {e[0] for e in events if e[0] is not None}:
        mine = sorted((e[1], e[2], e[3]) for e in events if e[0] == key and e[1] is not None)

        def reach(i, k):
            """Beginnings of matches of the first i + 1 steps that end at event k."""
            kind, minutes, bar = plan[i]
            if mine[k][2] not in kind:
                return set()
            if i == 0:
                return {mine[k][0]}
            found = set()
            for j in range(k):
                if minutes is not None and mine[k][0] - mine[j][0] > minutes * MINUTE:
                    continue
                if bar and any(mine[b][2] in bar for b in range(j + 1, k)):
                    continue
                found |= reach(i - 1, j)
            return found

        for k in range(len(mine)):
            if began := reach(len(plan) - 1, k):
                out.append((key, mine[k][0], mine[k][1], max(began)))
    return sorted(out)


PLANS = [
    [("a", None, ""), ("b", 5, "")],
    [("a", None, ""), ("b", None, "x"), ("c", 6, "")],
    [("ab", None, ""), ("ab", 4, ""), ("ab", 4, "c")],
    [("a", None, ""), ("a", 3, "b"), ("x", 9, "c")],
    [("c", None, "")],
]


@pytest.mark.parametrize("plan", PLANS, ids=range(len(PLANS)))
@pytest.mark.parametrize("max_rows", [None, 12])
def test_match(spark, plan, max_rows):
    rng = random.Random(len(plan))
    events = [(1 if rng.random() < 0.5 else rng.randrange(2, 5), rng.randrange(40) * MINUTE, k, rng.choice(KINDS)) for k in range(90)]
    events += [(None, 0, 500, "a"), (None, MINUTE, 501, "b"), (2, None, 502, "a")]
    df = spark.createDataFrame(events, "customer_id long, event_us long, id long, kind string")
    steps = [
        Step(F.col("kind").isin(*kind), None if minutes is None else f"{minutes} minutes", 1, F.col("kind").isin(*bar) if bar else None)
        for kind, minutes, bar in plan
    ]
    assert sorted(map(tuple, match(df, steps, max_rows=max_rows).collect())) == brute(events, plan)
    if max_rows is None:
        assert match(df.limit(0), steps).collect() == []


def test_repetition_is_written_out(spark):
    flat = compiled([Step(F.lit(True), "1 hour", 3), Step(F.lit(True), None, 2)])
    assert [s.within for s in flat] == [None, "1 hour", "1 hour", None, None]
    with pytest.raises(ValueError):
        compiled([])
