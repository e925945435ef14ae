"""Keyed tables kept as an append log with a latest-row view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.operators.clean import keep_last


def latest(log: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Last write per key."""
    return keep_last(log, keys, F.col(version))


def merge_decisions(
    orders: DataFrame, decisions: DataFrame, keys: Sequence[str] = ("order_id", "customer_id")
) -> DataFrame:
    """Stored orders with the decision fields of reviewed ones; others keep what they had.

    Decision fields already on the orders are kept where there is no new decision.
    """
    fields = ["fraud_decision", "combined_fraud_score", "all_fraud_flags", "fraud_reviewed_at"]
    fields = [f for f in fields if f in decisions.columns]
    new = decisions.select(*keys, *[F.col(f).alias(f"_{f}") for f in fields])
    joined = orders.join(new, list(keys), "left")
    merged = [
        (F.coalesce(f"_{f}", f) if f in orders.columns else F.col(f"_{f}")).alias(f) for f in fields
    ]
    return joined.select(*[c for c in orders.columns if c not in fields], *merged)
