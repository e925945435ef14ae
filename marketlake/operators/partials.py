"""Curated tables as sums by key and day, so that a changed day is put right without the others.

A table's partial is one row per (key, order_date). What a run changes is the new partials of its days less the old
ones, added up by key: a delta. Deltas add up to the table's state in any order of days. The least and greatest time
of a key cannot be taken back by subtraction: where a day has lost the one it had, the key's row says `full` and
carries the span over all its days instead, which replaces the spans of earlier runs (`epoch` is the run).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.numeric import UNIT, units
from marketlake.functions.timefn import parse_ts
from marketlake.operators import clean
from marketlake.operators.curated import clv_segment

DAY = "order_date"


@dataclass(frozen=True)
class Part:
    """One table: its keys, the rows that count, their sums, and the table that the summed state gives.

    `sums` make aggregates over the rows of one key and day that add up over days; `span` is a time column whose least
    and greatest are kept. Every partial also counts its rows, and a key without rows is no longer in the table.
    """

    keys: tuple[str, ...]
    rows: Callable[[DataFrame], DataFrame]
    sums: Mapping[str, Callable[[], Column]]
    table: Callable[[DataFrame], DataFrame]
    span: Callable[[], Column] | None = None

    @property
    def added(self) -> list[str]:
        return ["n_rows", *self.sums]

    def by_day(self, orders: DataFrame) -> DataFrame:
        """The partials of some days' orders."""
        ends = [] if self.span is None else [F.min(self.span()).alias("first"), F.max(self.span()).alias("last")]
        sums = [F.coalesce(x(), F.lit(0)).cast("bigint").alias(name) for name, x in self.sums.items()]
        return self.rows(orders).groupBy(*self.keys, DAY).agg(F.count(F.lit(1)).alias("n_rows"), *sums, *ends)

    def delta(self, old: DataFrame, new: DataFrame, run: int, *carry: str) -> DataFrame:
        """What a run adds to each key: partials of the run's days, after and before. Unchanged keys have no row.

        `carry` are columns that follow from the key; the rows are dealt to tasks by them. A key has at most two rows
        for each day here, so none is hot.
        """
        before = old.withColumns({c: -F.col(c) for c in self.added}).withColumn("_new", F.lit(False))
        both = _dealt(new.withColumn("_new", F.lit(True)).unionByName(before), carry)
        sums = [F.sum(c).alias(c) for c in self.added]
        changed = F.greatest(*[F.abs(c) for c in self.added]) > 0
        if self.span is None:
            return both.groupBy(*self.keys, *carry).agg(*sums).filter(changed)
        kept = F.col("_new")
        out = both.groupBy(*self.keys, *carry).agg(
            *sums,
            F.min(F.when(kept, F.col("first"))).alias("first"),
            F.max(F.when(kept, F.col("last"))).alias("last"),
            F.min(F.when(~kept, F.col("first"))).alias("_first"),
            F.max(F.when(~kept, F.col("last"))).alias("_last"),
        )
        same = F.col("first").eqNullSafe(F.col("_first")) & F.col("last").eqNullSafe(F.col("_last"))
        lost = F.coalesce(
            F.col("_first").isNotNull() & (F.col("first").isNull() | (F.col("first") > F.col("_first")) | (F.col("last") < F.col("_last"))),
            F.lit(False),
        )
        return out.filter(changed | ~same).select(
            *self.keys, *carry, *self.added, "first", "last", lost.alias("full"), F.lit(run).cast("bigint").alias("epoch")
        )

    def respan(self, delta: DataFrame, everything: DataFrame) -> DataFrame:
        """The delta with the spans of its `full` keys taken from all days' partials."""
        asked = delta.filter("full").select(*[F.col(k).alias(f"_{k}") for k in self.keys])
        # null is a key like any other
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys]
        spans = everything.join(asked, same, "left_semi").groupBy(*self.keys).agg(F.min("first").alias("_first"), F.max("last").alias("_last"))
        spans = spans.select(*[F.col(k).alias(f"_{k}") for k in self.keys], "_first", "_last")
        joined = delta.filter("full").join(spans, same, "left")
        kept = [c for c in delta.columns if c not in ("first", "last")]
        full = joined.select(*kept, F.col("_first").alias("first"), F.col("_last").alias("last"))
        return delta.filter(~F.col("full")).unionByName(full)

    def fold(self, rows: DataFrame, *carry: str) -> DataFrame:
        """Deltas of successive runs as one; a key whose rows are all gone leaves. `carry` as in `delta`."""
        rows = _dealt(rows, carry)
        sums = [F.sum(c).alias(c) for c in self.added]
        if self.span is None:
            return rows.groupBy(*self.keys, *carry).agg(*sums).filter("n_rows > 0")
        # a key has at most one row of each run here
        base = F.max(F.when(F.col("full"), F.col("epoch"))).over(Window.partitionBy(*self.keys, *carry))
        valid = F.col("_base").isNull() | (F.col("epoch") >= F.col("_base"))
        return (
            rows.withColumn("_base", base)
            .groupBy(*self.keys, *carry)
            .agg(
                *sums,
                F.min(F.when(valid, F.col("first"))).alias("first"),
                F.max(F.when(valid, F.col("last"))).alias("last"),
                F.max("full").alias("full"),
                F.max("epoch").alias("epoch"),
            )
            .filter("n_rows > 0")
        )


def _dealt(rows: DataFrame, by: tuple[str, ...]) -> DataFrame:
    return rows.repartition(*by) if by else rows


def _total(name: str, count: str) -> Column:
    """A sum kept in units, null if nothing was added."""
    return F.when(F.col(count) > 0, F.col(name) / F.lit(float(UNIT)))


def _mean(name: str, count: str) -> Column:
    return F.when(F.col(count) > 0, F.col(name) / F.col(count) / F.lit(float(UNIT)))


_MONEY = {
    "n_orders": lambda: F.count("order_id"),
    "units": lambda: F.sum(units(F.col("total"))),
    "n_totals": lambda: F.count(units(F.col("total"))),
}


def _clv_table(state: DataFrame) -> DataFrame:
    return state.select(
        "customer_id",
        F.col("n_orders").alias("order_count"),
        _total("units", "n_totals").alias("total_spend"),
        _mean("units", "n_totals").alias("avg_order_value"),
        F.col("first").alias("first_order"),
        F.col("last").alias("last_order"),
        F.col("n_days").alias("active_days"),
    ).withColumn("clv_segment", clv_segment(F.col("total_spend")))


def _interactions_table(state: DataFrame) -> DataFrame:
    quantity = F.when(F.col("n_quantities") > 0, F.col("quantity"))
    return state.select(
        "customer_id",
        "product_id",
        F.col("n_orders").alias("purchase_count"),
        quantity.alias("total_quantity"),
        _total("units", "n_amounts").alias("total_spend"),
        F.log1p(F.col("n_orders") * quantity).alias("implicit_rating"),
    )


def _states_table(state: DataFrame) -> DataFrame:
    """The state holds one row per (state, customer), so customers are counted without a distinct."""
    summed = state.groupBy("shipping_state").agg(
        F.sum("n_orders").alias("total_orders"),
        F.sum("units").alias("units"),
        F.sum("n_totals").alias("n_totals"),
        F.count("customer_id").alias("unique_customers"),
    )
    return summed.select(
        "shipping_state",
        "total_orders",
        _total("units", "n_totals").alias("gross_revenue"),
        _mean("units", "n_totals").alias("avg_order_value"),
        "unique_customers",
    )


PARTS: dict[str, Part] = {
    "customer_clv": Part(
        ("customer_id",),
        clean.confirmed,
        {**_MONEY, "n_days": lambda: F.max(F.col(DAY).isNotNull().cast("bigint"))},
        _clv_table,
        span=lambda: parse_ts(F.col("created_at")),
    ),
    "product_interactions": Part(
        ("customer_id", "product_id"),
        lambda orders: clean.explode_items(orders, "order_id", "customer_id", DAY),
        {
            "n_orders": lambda: F.count("order_id"),
            "quantity": lambda: F.sum("quantity"),
            "n_quantities": lambda: F.count("quantity"),
            "units": lambda: F.sum(units(F.col("quantity") * F.col("unit_price"))),
            "n_amounts": lambda: F.count(units(F.col("quantity") * F.col("unit_price"))),
        },
        _interactions_table,
    ),
    "state_revenue": Part(("shipping_state", "customer_id"), clean.confirmed_with_state, _MONEY, _states_table),
}
