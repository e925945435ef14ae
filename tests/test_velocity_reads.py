"""Keyed velocity state: what a batch has just written is not read back from the store, and the results are the same."""

import pandas as pd

from marketlake.config import VelocityRules
from marketlake.streaming import velocity_state
from marketlake.streaming.velocity_state import VelocityState


class Store(dict):
    reads = 0

    def getValue(self, key):
        self.reads += 1
        return self[key]

    def updateValue(self, key, value):
        self[key] = value


def decided(batches):
    state = VelocityState(VelocityRules(), part=3)
    state.orders, state.flagged = Store(), Store()
    out, reads = [], []
    for hours in batches:
        us = [int(h * 3_600_000_000) for h in hours]
        some = pd.DataFrame({
            "created_us": us, "units": [10_000] * len(us), "is_fraud": [k % 2 == 0 for k in range(len(us))], "order_id": [f"o{u}" for u in us],
            "total": [1.0] * len(us), "fraud_score": [0.9] * len(us), "fraud_flags": [["x"]] * len(us),
        })
        for chunk in state.handleInputRows(("c",), iter([some.iloc[:4], some.iloc[4:]]), None):
            out += [tuple(r[:3]) + tuple(r[5:]) for r in chunk.itertuples(index=False)]
        reads.append(state.orders.reads + state.flagged.reads)
    return out, reads


BATCHES = [[0, 0.1, 0.2, 0.3, 0.4, 5, 9, 9.5], [0.35, 4, 9.6, 30, 31]]


def test_written_values_are_not_read_back(monkeypatch):
    got, reads = decided(BATCHES)
    assert reads[0] == 0
    for n in (0, 2):
        monkeypatch.setattr(velocity_state, "AT_HAND", n)
        again, more = decided(BATCHES)
        assert again == got and more[0] > 0 and more[1] > reads[1]
