"""Folds over the events of a key, without one task walking along them.

A rule such as "approved if the last approved one lies a day back" jumps from one event to a later one that follows from its time
alone. So each event gets a pointer, found within blocks of (key, time), and the events that the rule visits are those that
the pointers reach from a key's first event; pointers are doubled, so rounds grow with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrystone.session import materialize, release

#: A block of a level holds this many of the level below.
FANOUT = 1024


def first_at_or_after(asks: DataFrame, held: DataFrame, width: int) -> DataFrame:
    """``asks`` (k, t, ask) with ``found``: the least ``t`` of ``held`` (k, t) with the same k that is ``ask`` or more, else null.

    Both are cut by (k, block of ``width``); what a block cannot answer is asked again among the least times of blocks, in blocks
    of ``FANOUT`` times the width, and at last among the least times of those by k alone. A key with very many events is
    spread over its blocks. ``width`` changes the spread, never the result.
    """
    answered, open_, step = [], asks.select("k", "t", "ask"), width
    rows = held.select("k", F.col("t").alias("at"))
    for level in range(3):
        block = lambda c: F.floor(c / step) if level < 2 else F.lit(0).cast("long")  # noqa: B023, E731
        both = rows.select("k", block(F.col("at")).alias("b"), F.col("at"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("t")).unionByName(
            open_.select("k", block(F.col("ask")).alias("b"), F.col("ask").alias("at"), F.lit(1).alias("kind"), "t")
        )
        later = Window.partitionBy("k", "b").orderBy(F.desc("at"), "kind").rowsBetween(Window.unboundedPreceding, 0)
        seen = both.select("k", "t", F.col("at").alias("ask"), "kind", F.min(F.when(F.col("kind") == 0, F.col("at"))).over(later).alias("found")).where("kind = 1").drop("kind")
        if level == 2:
            answered.append(seen)
            break
        seen = materialize(seen)
        answered.append(seen.where("found is not null"))
        open_ = seen.where("found is null").drop("found")
        rows = rows.groupBy("k", block(F.col("at")).alias("b")).agg(F.min("at").alias("at")).select("k", "at")
        step *= FANOUT
    out = answered[0]
    for more in answered[1:]:
        out = out.unionByName(more)
    return out


def reached(starts: DataFrame, pointers: DataFrame) -> DataFrame:
    """(k, t) of ``starts`` (one for each k) and of all that ``pointers`` (k, t, to) lead to from there; a written table."""
    found = materialize(starts.select("k", "t"))
    jump = materialize(pointers.where("to is not null").select("k", "t", "to"))
    while True:
        # found holds the first 2**i of each chain, and jump leads 2**i on.
        more = materialize(found.join(jump, ["k", "t"]).select("k", F.col("to").alias("t")))
        if more.isEmpty():
            release(more, jump)
            return found
        before = found, more, jump
        found = materialize(found.unionByName(more))
        jump = materialize(jump.join(jump.select("k", F.col("t").alias("to"), F.col("to").alias("on")), ["k", "to"]).select("k", "t", F.col("on").alias("to")))
        release(*before)


def micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def spaced_out(events: DataFrame, seconds: float) -> DataFrame:
    """(k, t) of the times of ``events`` (k, t in microseconds) that are a key's first, or the first ``seconds`` after the last one taken."""
    gap = round(seconds * 1_000_000)
    times = materialize(events.select("k", "t").distinct())
    pointers = first_at_or_after(times.withColumn("ask", F.col("t") + gap), times, max(gap, 1_000_000))
    # No pause: every time is taken, and pointers to themselves would never end.
    return times if gap <= 0 else reached(times.groupBy("k").agg(F.min("t").alias("t")), pointers.select("k", "t", F.col("found").alias("to")))


def open_spells(points: DataFrame, hold_s: float) -> DataFrame:
    """(k, opened, closed) of a switch that opens at a bad point (k, t, bad) and closes at the first clean one ``hold_s`` later."""
    hold = round(hold_s * 1_000_000)
    bad, good = (materialize(points.where(c).select("k", "t").distinct()) for c in ("bad", "not bad"))
    width = max(hold, 60_000_000)
    closing = materialize(first_at_or_after(bad.withColumn("ask", F.col("t") + hold), good, width).select("k", "t", F.col("found").alias("closed")))
    asked = closing.where("closed is not null").select("k", "t", F.col("closed").alias("ask"))
    again = first_at_or_after(asked, bad, width)
    opened = reached(bad.groupBy("k").agg(F.min("t").alias("t")), again.select("k", "t", F.col("found").alias("to")))
    return opened.join(closing, ["k", "t"]).select("k", F.col("t").alias("opened"), "closed")


def within_spells(points: DataFrame, spells: DataFrame, width: int) -> DataFrame:
    """(k, t, inside) of distinct ``points`` (k, t): whether the last spell that opened by t has not closed by then."""
    spells = materialize(spells)
    last = first_at_or_after(points.select("k", "t", (-F.col("t")).alias("ask")), spells.select("k", (-F.col("opened")).alias("t")), width)
    held = last.select("k", "t", (-F.col("found")).alias("opened")).join(spells, ["k", "opened"], "left")
    return held.select("k", "t", (F.col("opened").isNotNull() & (F.col("closed").isNull() | (F.col("t") < F.col("closed")))).alias("inside"))
