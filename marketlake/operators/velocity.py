"""Trailing count and sum per key over closed time windows, safe for very large keys.

A plain RANGE window puts all rows of one key into one task. Here time is cut into slots
(one hour by default) and the work is grouped by (key, slot):

* a row's window is its own slot up to its time, whole slots before it, and the end of
  one slot at the far edge;
* each history row is sent to its own slot and to the slot whose window edge falls on it,
  with its position moved forward by the window length, so one sort serves all frames;
* whole slots in between are added up from per-slot sums, which have at most one row per
  key and slot however many orders a key has.

So a group holds one key's rows of three slots, not its whole history, and the result is
exactly that of the RANGE window (equal times included).

A burst can put very many rows of one key into one slot. The history's largest slot is counted
first (targets are taken to be part of the history, as in the log); if it has more than `rules.busy` rows, every slot is cut in parts of equal length, short enough
for no part to have more. The same sums are then taken over the parts of a slot, from one row
for each part, and a sorted group holds the rows of one part. Only rows of the same microsecond
cannot be cut.

A history of its own is cut at its scan, before anything is shuffled: a Bloom filter of the (key, span of
slots) that some target's windows reach leaves only rows near a target, and one of the targets' (key, slot)
leaves only the copies that some target meets. A row that passes by chance meets no target, so the results
are the same. A filter has at most `MOST_BITS` bits, in words of 64: a table of at most 2**20 rows, which is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.config import VelocityRules
from marketlake.functions.numeric import UNIT, units
from marketlake.functions.timefn import micros

_OWN, _EDGE_A, _EDGE_B, _SLOTS, _TARGET = 1, 2, 3, 4, 5
#: Parts of a slot that are tried, one after another.
PARTS = (1, 1 << 10, 1 << 20)
#: Bits of a Bloom filter for each target, and the least and most bits of one.
BITS_EACH, LEAST_BITS, MOST_BITS = 32, 1 << 12, 1 << 26


def trailing_activity(
    targets: DataFrame,
    history: DataFrame | None = None,
    rules: VelocityRules = VelocityRules(),
    key: str = "customer_id",
    ts: str = "created_at",
    amount: str = "total",
) -> DataFrame:
    """Adds orders_in_window and spend_in_window to every target row.

    A target without key or time has 0 in both. Without `history` the targets are their own history, and one copy fewer is shuffled.
    """
    slot_us = rules.slot_s * 1_000_000
    order_slots, rest_a = divmod(rules.order_window_s, rules.slot_s)
    spend_slots, rest_b = divmod(rules.spend_window_s, rules.slot_s)
    if rest_a or rest_b or order_slots < 1 or spend_slots < 1:
        raise ValueError("velocity windows must be whole multiples of the slot")

    own_history = history is None
    payload = F.struct(*targets.columns)

    def timed(df: DataFrame, *extra: Column) -> DataFrame:
        us = micros(F.col(ts).try_cast("timestamp") if dict(df.dtypes)[ts] == "string" else F.col(ts))
        return df.select(
            F.col(key).alias("k"), us.alias("us"), F.coalesce(units(F.col(amount)), F.lit(0)).alias("amt"), *extra
        ).withColumn("slot", F.floor(F.col("us") / F.lit(slot_us)).cast("bigint"))

    usable = F.col("k").isNotNull() & F.col("us").isNotNull()
    target_rows = timed(targets, payload.alias("row"))
    if own_history:
        events = target_rows.filter(usable)
    else:
        past = timed(history).filter(usable)
        # equal keys of different types have different hashes
        kind_of_key = target_rows.select("k").unionByName(past.select("k")).schema["k"].dataType
        target_rows, past = (df.withColumn("k", F.col("k").cast(kind_of_key)) for df in (target_rows, past))
        met = target_rows.filter(usable).select("k", "slot").distinct()
        bits = filter_bits(met.count())
        events = in_reach(past, met, max(order_slots, spend_slots), bits)
    parts = parts_needed(events, slot_us, rules.busy)
    target_rows, events = (df.withColumn("part", _part(slot_us, parts)) for df in (target_rows, events))

    def place(kind: int, shift_slots: int) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            (F.col("slot") + shift_slots).alias("slot"),
            (F.col("us") + shift_slots * slot_us).alias("pos"),
        )

    copies = events.select(
        "k",
        "part",
        "amt",
        F.explode(F.array(place(_OWN, 0), place(_EDGE_A, order_slots), place(_EDGE_B, spend_slots))).alias("p"),
    ).select("k", "part", "amt", "p.kind", "p.slot", "p.pos")
    if own_history:
        copies = copies.filter(F.col("kind") != _OWN)
    else:
        copies = seen(copies, met, ("k", "slot"), bits)

    # Sums of whole slots strictly between the row's slot and the far edge.
    per_slot = events.groupBy("k", "slot").agg(F.count(F.lit(1)).alias("n"), F.sum("amt").alias("amt"))
    if not own_history:
        zero = met.select("k", "slot", F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("amt"))
        per_slot = per_slot.unionByName(zero).groupBy("k", "slot").agg(F.sum("n").alias("n"), F.sum("amt").alias("amt"))
    by_slot = Window.partitionBy("k").orderBy("slot")

    def between(col: str, slots: int) -> Column:
        if slots < 2:
            return F.lit(0).cast("bigint")
        return F.coalesce(F.sum(col).over(by_slot.rangeBetween(-(slots - 1), -1)), F.lit(0).cast("bigint"))

    middles = per_slot.select(
        "k",
        "slot",
        (F.col("slot") * slot_us).alias("pos"),
        F.lit(_SLOTS).alias("kind"),
        between("n", order_slots).alias("mid_n"),
        between("amt", spend_slots).alias("mid_amt"),
    )

    if parts == 1:
        middles = middles.withColumn("part", F.lit(0))
    else:
        wanted = target_rows.filter(usable).select("k", "slot", "part").distinct()
        middles = _sums_beside_parts(events, wanted, middles.drop("pos", "kind"), (order_slots, spend_slots)).withColumns(
            {"pos": F.col("slot") * slot_us, "kind": F.lit(_SLOTS)}
        )

    # Rows without key or time have no window; a hash for a slot keeps them from meeting in one group.
    targets_placed = target_rows.select(
        "k",
        F.when(usable, F.col("part")).otherwise(F.lit(0)).alias("part"),
        F.when(usable, F.col("slot")).otherwise(F.xxhash64("row")).alias("slot"),
        F.when(usable, F.col("us")).alias("pos"),
        F.lit(_TARGET).alias("kind"),
        "amt",
        "row",
    )
    together = targets_placed.unionByName(copies, allowMissingColumns=True).unionByName(middles, allowMissingColumns=True)

    ordered = Window.partitionBy("k", "slot", *(["part"] if parts > 1 else [])).orderBy("pos")
    upto = ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    before = ordered.rangeBetween(Window.unboundedPreceding, -1)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    kind = F.col("kind")
    own = kind == (_TARGET if own_history else _OWN)
    zero = F.lit(0).cast("bigint")

    def total(cond: Column, value: Column, frame) -> Column:
        return F.coalesce(F.sum(F.when(cond, value)).over(frame), zero)

    one = F.lit(1).cast("bigint")
    n = (
        total(own, one, upto)
        + total(kind == _EDGE_A, one, whole)
        - total(kind == _EDGE_A, one, before)
        + F.coalesce(F.max("mid_n").over(whole), zero)
    )
    amt = (
        total(own, F.col("amt"), upto)
        + total(kind == _EDGE_B, F.col("amt"), whole)
        - total(kind == _EDGE_B, F.col("amt"), before)
        + F.coalesce(F.max("mid_amt").over(whole), zero)
    )
    return (
        together.select(
            "kind",
            "row",
            F.when(F.col("pos").isNotNull(), n).otherwise(zero).alias("orders_in_window"),
            F.when(F.col("pos").isNotNull(), amt).otherwise(zero).alias("_amt"),
        )
        .filter(kind == _TARGET)
        .select("row.*", "orders_in_window", (F.col("_amt") / F.lit(float(UNIT))).alias("spend_in_window"))
    )


def filter_bits(keys: int) -> int:
    """The bits of a filter for so many keys: a power of two, within the bounds."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (keys * BITS_EACH - 1).bit_length()))


def seen(rows: DataFrame, keys: DataFrame, by: tuple[str, ...], bits: int) -> DataFrame:
    """The rows whose `by` may be among the keys: none that is goes, and few that are not stay. No row is shuffled.

    Each key sets two bits of one word of 64; the words that have a bit are a table of at most bits / 64 rows.
    """
    return _met(rows, keys, by, bits, "inner").filter("_seen").select(*rows.columns)


def may_be_among(rows: DataFrame, keys: DataFrame, by: tuple[str, ...], bits: int, name: str) -> DataFrame:
    """All rows, with a column that is false only if their `by` is not among the keys."""
    return _met(rows, keys, by, bits, "left").select(*rows.columns, F.coalesce("_seen", F.lit(False)).alias(name))


def _met(rows: DataFrame, keys: DataFrame, by: tuple[str, ...], bits: int, how: str) -> DataFrame:
    code = F.xxhash64(*by)
    word = F.shiftrightunsigned(code, 12).bitwiseAND(F.lit(bits // 64 - 1))

    def mask(first: int) -> Column:
        return F.expr(f"shiftleft(1L, cast(shiftrightunsigned(_code, {first}) & 63 as int))")

    both = mask(0).bitwiseOR(mask(6))
    words = keys.select(code.alias("_code")).select(
        F.shiftrightunsigned("_code", 12).bitwiseAND(F.lit(bits // 64 - 1)).alias("_word"), both.alias("_mask")
    ).groupBy("_word").agg(F.bit_or("_mask").alias("_bits"))
    coded = rows.withColumns({"_code": code, "_word": word})
    return coded.join(F.broadcast(words), "_word", how).withColumn("_seen", F.col("_bits").bitwiseAND(both) == both)


def in_reach(events: DataFrame, met: DataFrame, reach: int, bits: int) -> DataFrame:
    """Events at most `reach` slots before a target of their key, and some others: each target asks two spans of slots."""
    span = F.floor(F.col("slot") / F.lit(reach))
    ends = F.array(F.col("slot"), F.col("slot") - reach)
    asked = met.select("k", F.explode(ends).alias("slot")).select("k", span.alias("span"))
    return seen(events.withColumn("span", span), asked, ("k", "span"), 2 * bits if bits < MOST_BITS else bits).drop("span")


def _part(slot_us: int, parts: int) -> Column:
    """The part of its slot that a time lies in."""
    length = -(-slot_us // parts)
    return F.floor((F.col("us") - F.col("slot") * F.lit(slot_us)) / F.lit(length)).cast("int")


def parts_needed(events: DataFrame, slot_us: int, busy: int) -> int:
    """The fewest parts of a slot, of those tried, that leave no key more than `busy` rows in one."""
    for parts in PARTS:
        sizes = events.groupBy("k", "slot", _part(slot_us, parts).alias("part")).count()
        if (sizes.agg(F.max("count")).first()[0] or 0) <= busy:
            break
    return parts


def _sums_beside_parts(events: DataFrame, wanted: DataFrame, middles: DataFrame, shifts: tuple[int, int]) -> DataFrame:
    """For each wanted part of a slot, what lies in the windows outside of that part: (k, slot, part, mid_n, mid_amt).

    The own slot's parts before it, the parts behind it of the slots at the far edges, and the whole slots between.
    A group holds one row for each part of three slots.
    """
    sums = events.groupBy("k", "slot", "part").agg(F.count(F.lit(1)).alias("n"), F.sum("amt").alias("amt"))

    def placed(kind: int, shift: int) -> DataFrame:
        return sums.select("k", (F.col("slot") + shift).alias("slot"), "part", "n", "amt", F.lit(kind).alias("kind"))

    rows = placed(_OWN, 0).unionByName(placed(_EDGE_A, shifts[0])).unionByName(placed(_EDGE_B, shifts[1]))
    rows = rows.unionByName(wanted.withColumn("kind", F.lit(_TARGET)), allowMissingColumns=True)
    between = middles.withColumns({"kind": F.lit(_SLOTS), "part": F.lit(-1)})
    rows = rows.unionByName(between, allowMissingColumns=True)
    ordered = Window.partitionBy("k", "slot").orderBy("part")
    upto = ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    before = ordered.rangeBetween(Window.unboundedPreceding, -1)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def total(kind: int, value: str, frame) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col(value))).over(frame), F.lit(0).cast("bigint"))

    def beside(value: str, edge: int) -> Column:
        far = total(edge, value, whole) - total(edge, value, upto)
        return total(_OWN, value, before) + far + F.coalesce(F.max(f"mid_{value}").over(whole), F.lit(0).cast("bigint"))

    out = rows.select("k", "slot", "part", "kind", beside("n", _EDGE_A).alias("mid_n"), beside("amt", _EDGE_B).alias("mid_amt"))
    return out.filter(F.col("kind") == _TARGET).drop("kind")
