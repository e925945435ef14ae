"""Parameters of the operators. The defaults are fixed values of the model."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class FraudRules:
    high_value: float = 500.0
    bronze_value: float = 200.0
    risky_payments: tuple[str, ...] = ("crypto",)
    bulk_items: int = 3
    flag_at: float = 0.5
    w_known_risk: float = 0.40
    w_high_value: float = 0.20
    w_payment: float = 0.15
    w_tier: float = 0.25
    w_bulk: float = 0.10


@dataclass(frozen=True)
class VelocityRules:
    """Windows are closed at both ends and must be whole multiples of the slot."""

    order_window_s: int = 3600
    spend_window_s: int = 86400
    slot_s: int = 3600
    # Rows of one key that a slot may have before it is cut in parts.
    busy: int = 200_000
    max_orders: int = 3
    max_spend: float = 1500.0
    w_orders: float = 0.40
    w_spend: float = 0.35
    block_at: float = 0.7
    review_at: float = 0.5
    # An order is stored before it is checked, so it counts in its own windows and
    # its total is added once more. False counts it once.
    include_current: bool = True


@dataclass(frozen=True)
class ClvRules:
    high_above: float = 500.0
    medium_above: float = 150.0


@dataclass(frozen=True)
class TierRules:
    platinum: int = 5
    gold: int = 3
    silver: int = 2


@dataclass(frozen=True)
class StockRules:
    low: int = 10
    critical: int = 3


@dataclass(frozen=True)
class SessionRules:
    gap_s: int = 1800
    anonymous: str = "anonymous"


@dataclass(frozen=True)
class AlarmRule:
    name: str
    period_s: int
    statistic: str  # sum | max | avg
    comparator: str  # ge | gt
    threshold: float
    periods: int = 1


# The two alarms of the model.
ERROR_ALARM = AlarmRule("errors", 300, "sum", "ge", 5.0, 1)
BACKLOG_ALARM = AlarmRule("backlog", 60, "max", "gt", 1000.0, 3)


@dataclass(frozen=True)
class RecoRules:
    default_n: int = 5
    max_n: int = 20
    pool_factor: int = 8
    max_pool: int = 200
    strict: tuple[float, float] = (0.4, 1.6)
    relaxed: tuple[float, float] = (0.2, 3.0)
    score_cap: float = 0.99
    bulk_n: int = 20
    popular_score: float = 0.5
    user_block: int = 4096
    item_block: int = 16384


@dataclass(frozen=True)
class AlsParams:
    rank: int = 64
    max_iter: int = 20
    reg: float = 0.05
    alpha: float = 1.0
    seed: int = 42


RETENTION_DAYS = 90
DEFAULT_PRICE = 50.0
LATE_DATA = "24 hours"
