"""Pointer-based folds against walking along each key's events."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quarrystone.operators import folds, telemetry

T0 = dt.datetime(2024, 1, 1)


def walk(events, seconds):
    """{(key, event_id): approved}"""
    last, out = {}, {}
    for key, ts, event in sorted(events, key=lambda e: (e[0], e[1], e[2])):
        ok = key not in last or (ts - last[key]).total_seconds() >= seconds
        if ok:
            last[key] = ts
        out[key, event] = ok
    return out


def frame(spark, events):
    return spark.createDataFrame(events, "k string, ts timestamp, event_id long")


@pytest.mark.parametrize("seconds", [3600, 7, 0.5, 0])
def test_cooldown_matches_walk(spark, seconds):
    rng = random.Random(seconds)
    events = [("hot", T0 + dt.timedelta(seconds=rng.uniform(0, 4 * 86_400)), i) for i in range(3000)]
    events += [(f"k{rng.randrange(40)}", T0 + dt.timedelta(seconds=rng.randrange(200_000)), 10_000 + i) for i in range(800)]
    events += [("tie", T0, 20_001), ("tie", T0, 20_000), ("far", T0, 20_002), ("far", T0 + dt.timedelta(days=4000), 20_003), ("far", T0 + dt.timedelta(days=4000, seconds=1), 20_004), ("old", dt.datetime(1962, 5, 1), 20_005)]
    df = frame(spark, [*events, (None, T0, 1), ("hot", None, 2)]).repartition(5)
    got = {(r.k, r.event_id): r.approved for r in telemetry.cooldown(df, "k", seconds).collect()}
    want = walk(events, seconds)
    if seconds == 0:
        want["tie", 20_001] = False  # one event a time
    assert got == want


def test_one_key_with_very_many_events(spark):
    """200000 events of one key: no partition of a window holds more than its own blocks."""
    rows = spark.range(200_000).select(F.lit("hot").alias("k"), F.timestamp_micros(F.col("id") * 1_000_003).alias("ts"), F.col("id").alias("event_id"))
    got = telemetry.cooldown(rows, "k", 86_400).where("approved").select("event_id").orderBy("event_id").collect()
    want, last = [], None
    for i in range(200_000):
        if last is None or (i - last) * 1_000_003 >= 86_400_000_000:
            want.append(i)
            last = i
    assert [r.event_id for r in got] == want
    spread = rows.groupBy(F.floor(folds.micros(F.col("ts")) / 86_400_000_000)).count()
    assert spread.agg(F.max("count")).first()[0] < 90_000


def test_no_python_runs_in_the_folds(spark):
    plan = telemetry.cooldown(frame(spark, [("a", T0, 1)]), "k", 10)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_first_at_or_after_looks_through_all_levels(spark):
    rng = random.Random(8)
    held = [(rng.choice("ab"), rng.choice([rng.randrange(-50, 50), rng.randrange(10**5), rng.randrange(10**9)])) for _ in range(300)]
    asks = [(k, i, rng.choice([t, t + 1, rng.randrange(-100, 2 * 10**9)])) for i, (k, t) in enumerate(held)] + [("none", 9999, 5)]
    got = folds.first_at_or_after(spark.createDataFrame(asks, "k string, t long, ask long"), spark.createDataFrame(held, "k string, t long"), 10).collect()
    assert sorted((r.k, r.t, r.ask, r.found) for r in got if r.found is not None) == sorted((k, t, a, min(x for y, x in held if y == k and x >= a)) for k, t, a in asks if any(y == k and x >= a for y, x in held))
    assert len(got) == len(asks)


def test_breaker_matches_walk(spark):
    rng = random.Random(4)
    rows = [(rng.choice([*"abc", None]), T0 + dt.timedelta(seconds=300 * i), rng.choice([0.01, 0.03, 0.05, None]), rng.choice([0.0, 0.1, 0.5])) for i in range(1500)]
    rows = list({(r[0], r[1]): r for r in rows}.values())
    want, since = {}, {}
    for run, ts, cost, errors in sorted(rows, key=lambda r: r[1]):
        bad = (cost or 0) > 0.04 or errors > 0.25
        if since.get(run) is None and bad:
            since[run] = ts
        elif since.get(run) is not None and not bad and (ts - since[run]).total_seconds() >= 600:
            since[run] = None
        want[run, ts] = since.get(run) is not None
    df = spark.createDataFrame(rows, "run_id string, window_start timestamp, cost_per_company double, error_rate double")
    got = {(r.run_id, r.window_start): r.open for r in telemetry.circuit_breaker(df).collect()}
    assert got == want and len(set(got.values())) == 2
    assert telemetry.circuit_breaker(df.limit(0)).count() == 0 and telemetry.cooldown(frame(spark, []), "k", 5).count() == 0
