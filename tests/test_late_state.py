"""Late events of sparse keys: what arrived before them counts, however much later it lies."""

import numpy as np
import pandas as pd

from changeloom.operators.anomalies import Limits
from changeloom.streaming.processors import AnomalyProcessor
from test_keyed_state import HOUR, Handle


def test_a_late_event_counts_all_that_came_before():
    p = AnomalyProcessor(Limits(kept="10 days"))
    p.init(Handle())
    got = []
    for times in ([0, 5, 9], [2], [3, 50], [30]):  # hours; the second and the last batch hold a late event alone
        at = np.array(times) * HOUR
        frame = pd.DataFrame({"customer_id": 1, "id": np.arange(len(at)), "cents": 1, "event_us": at})
        got += [out["spike_count"].tolist() for out in p.handleInputRows((1,), iter([frame]), None)]
    assert got == [[1, 1, 1], [3], [3, 1], [2]]
