"""Velocity check as keyed state: each customer's orders by time slot, kept in the state store.

An order's windows reach back a bounded time, so a customer's state is the orders of the slots that later or late
orders can still reach; it expires when a slot was not written for the retention time. A batch adds its orders to
their slots, in parts of bounded size, so a busy slot is not written anew for each order. Then every flagged order
into whose windows one of them falls is decided (again), slot by slot, with only the slots of one window in memory.
So the last decision on an order does not depend on how the input is cut in batches or on its order of arrival, and
no batch reads a log.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from marketlake.config import FraudRules, VelocityRules
from marketlake.functions.numeric import UNIT, units
from marketlake.functions.timefn import micros
from marketlake.operators import fraud
from marketlake.streaming.orders import DECISION_SCHEMA, last_decisions, scored_stream
from marketlake.streaming.snapshots import Snapshot, bucket_of

#: Time after which an untouched slot expires: the longest window and as much again for late orders.
RETENTION_S = 2 * 86_400
#: Orders in one value of the state.
PART = 1_000
#: Values of one customer that a batch keeps at hand after it wrote them; others are read again.
AT_HAND = 64

_EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
_SLOT = "slot bigint, part int"
_ORDERS = "times array<bigint>, units array<bigint>"
_FLAGGED = "times array<bigint>, order_ids array<string>, totals array<double>, scores array<double>, flags array<array<string>>"
CHECKED = (
    "customer_id string, order_id string, total double, fraud_score double, fraud_flags array<string>, "
    "created_us bigint, orders_in_window bigint, spend_in_window double"
)


class VelocityState(StatefulProcessor):
    """Orders of one customer -> the flagged orders whose windows they change, with both windows."""

    def __init__(self, rules: VelocityRules, retention_s: int = RETENTION_S, part: int = PART):
        self.rules, self.retention_s, self.part = rules, retention_s, part
        self.slot_us = rules.slot_s * 1_000_000
        self.order_us, self.spend_us = rules.order_window_s * 1_000_000, rules.spend_window_s * 1_000_000
        self.reach_us = max(self.order_us, self.spend_us)

    def init(self, handle: StatefulProcessorHandle) -> None:
        ttl = self.retention_s * 1000
        self.orders = handle.getMapState("orders", _SLOT, _ORDERS, ttl)
        self.flagged = handle.getMapState("flagged", _SLOT, _FLAGGED, ttl)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        self.written: dict[tuple[int, int, int], tuple] = {}
        orders, flagged = _parts(self.orders), _parts(self.flagged)
        first, last = None, None
        for some in rows:
            us = some["created_us"].to_numpy(np.int64)
            first = int(us.min()) if first is None else min(first, int(us.min()))
            last = int(us.max()) if last is None else max(last, int(us.max()))
            self._add(self.orders, orders, us, [us, some["units"].to_numpy(np.int64)])
            alerts = some[some["is_fraud"].to_numpy(bool)]
            us = alerts["created_us"].to_numpy(np.int64)
            names = ("order_id", "total", "fraud_score", "fraud_flags")
            self._add(self.flagged, flagged, us, [us, *(alerts[c].to_numpy() for c in names)])
        if first is not None:
            yield from self._decided(key[0], orders, flagged, first, last + self.reach_us)

    def close(self) -> None:
        pass

    def _add(self, state, parts: dict[int, int], us: np.ndarray, columns: list[np.ndarray]) -> None:
        """Rows to their slots, behind what these hold; parts: number of the last part of each slot."""
        slots = us // self.slot_us
        for slot in np.unique(slots).tolist():
            new = [[_plain(v) for v in c[slots == slot]] for c in columns]
            part = parts.get(slot, 0)
            held = [list(v) for v in self._value(state, slot, part)] if slot in parts else [[] for _ in columns]
            while new[0]:
                room = self.part - len(held[0])
                if room > 0:
                    held = [h + n[:room] for h, n in zip(held, new, strict=True)]
                    new = [n[room:] for n in new]
                    state.updateValue((slot, part), tuple(held))
                    if (id(state), slot, part) in self.written or len(self.written) < AT_HAND:
                        self.written[id(state), slot, part] = tuple(held)
                if new[0]:
                    part, held = part + 1, [[] for _ in columns]
            parts[slot] = part

    def _value(self, state, slot: int, part: int) -> tuple:
        """A value of the state; each read of the store is a call to another process, so what was just written is at hand."""
        at_hand = self.written.get((id(state), slot, part))
        return state.getValue((slot, part)) if at_hand is None else at_hand

    def _read(self, state, slot: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        values = [self._value(state, slot, part) for part in range(last + 1)]
        return tuple(np.concatenate([np.array(v[k], np.int64) for v in values]) for k in (0, 1))

    def _decided(self, customer: str, orders: dict[int, int], flagged: dict[int, int], since: int, until: int) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for slot in sorted(s for s in flagged if since // self.slot_us <= s <= until // self.slot_us):
            lowest = slot - -(-self.reach_us // self.slot_us)
            held = {s: v for s, v in held.items() if s >= lowest}
            for s in orders:
                if lowest <= s <= slot and s not in held:
                    held[s] = self._read(self.orders, s, orders[s])
            times, amounts = (np.concatenate([held[s][k] for s in sorted(held)]) for k in (0, 1))
            order = np.argsort(times, kind="stable")
            times, sums = times[order], np.concatenate([[0], np.cumsum(amounts[order])])
            for part in range(flagged[slot] + 1):
                at, ids, totals, scores, flags = self._value(self.flagged, slot, part)
                at = np.array(at, np.int64)
                mine = np.flatnonzero((at >= since) & (at <= until))
                if not len(mine):
                    continue
                end = np.searchsorted(times, at[mine], side="right")
                n = end - np.searchsorted(times, at[mine] - self.order_us)
                spent = sums[end] - sums[np.searchsorted(times, at[mine] - self.spend_us)]
                yield pd.DataFrame(
                    {
                        "customer_id": customer,
                        "order_id": [ids[k] for k in mine],
                        "total": [totals[k] for k in mine],
                        "fraud_score": [scores[k] for k in mine],
                        "fraud_flags": [list(flags[k] or []) for k in mine],
                        "created_us": at[mine],
                        "orders_in_window": n.astype(np.int64),
                        "spend_in_window": spent / float(UNIT),
                    }
                )


def _plain(value):
    """A value of a column as the state store takes it."""
    if isinstance(value, np.ndarray):
        return [str(v) for v in value]
    if isinstance(value, float | np.floating) and np.isnan(value):
        return None
    return value.item() if isinstance(value, np.generic) else value


def _parts(state) -> dict[int, int]:
    """Slots that the state holds, with the number of their last part."""
    out: dict[int, int] = {}
    for slot, part in state.keys():
        out[slot] = max(part, out.get(slot, 0))
    return out


def checked_orders(scored: DataFrame, rules: VelocityRules = VelocityRules(), retention_s: int = RETENTION_S, part: int = PART) -> DataFrame:
    """A stream of flagged orders with both windows, each time they change; scored: the stream of scored orders with `ts`."""
    rows = scored.select(
        "customer_id", "order_id", micros(F.col("ts")).alias("created_us"), F.coalesce(units(F.col("total")), F.lit(0)).alias("units"),
        F.col("total").cast("double").alias("total"), "fraud_score", "fraud_flags", "is_fraud",
    )
    state = VelocityState(rules, retention_s, part)
    return rows.groupBy("customer_id").transformWithStateInPandas(state, CHECKED, "Update", "ProcessingTime")


def decided_orders(scored: DataFrame, rules: VelocityRules = VelocityRules(), retention_s: int = RETENTION_S, part: int = PART) -> DataFrame:
    """The decisions on flagged orders, again whenever a window of theirs changes."""
    return fraud.decide_checked(checked_orders(scored, rules, retention_s, part), rules)


class StateDecisionJob:
    """Decides on flagged orders by keyed state alone and keeps the last decision on each below one folder."""

    def __init__(
        self, spark: SparkSession, root: str, velocity: VelocityRules = VelocityRules(), retention_s: int = RETENTION_S,
        part: int = PART, buckets: int = 16, every: int = 16,
    ):
        self.spark, self.root, self.velocity, self.retention_s, self.part = spark, root, velocity, retention_s, part
        self.buckets = buckets
        self.decided = Snapshot(spark, f"{root}/fraud_decisions", DECISION_SCHEMA, "bucket", last_decisions, every)

    def on_batch(self, decided: DataFrame, batch_id: int) -> None:
        stamps = {"fraud_reviewed_at": F.current_timestamp(), "batch_id": F.lit(batch_id), "bucket": bucket_of("order_id", self.buckets)}
        self.decided.add(decided.withColumns(stamps), batch_id)

    def start(self, bodies: DataFrame, rules: FraudRules = FraudRules(), available_now: bool = True) -> StreamingQuery:
        decided = decided_orders(scored_stream(bodies, rules), self.velocity, self.retention_s, self.part)
        writer = decided.writeStream.foreachBatch(self.on_batch).outputMode("update")
        writer = writer.option("checkpointLocation", f"{self.root}/checkpoints/velocity")
        # The query takes the setting with it: expired slots go with the next data, not in batches of their own without end.
        before = self.spark.conf.get(_EMPTY_BATCHES)
        self.spark.conf.set(_EMPTY_BATCHES, "false")
        try:
            return (writer.trigger(availableNow=True) if available_now else writer).start()
        finally:
            self.spark.conf.set(_EMPTY_BATCHES, before)

    def decisions(self) -> DataFrame:
        """The last decision on every flagged order."""
        return self.decided.read()
