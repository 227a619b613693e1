"""Cost, error and health figures from call logs. A ledger has provider, ts, duration_ms, cost_eur, success, cache_hit, company_id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrystone.operators import folds
from quarrystone.session import materialize


def run_metrics(df: DataFrame) -> DataFrame:
    s = F.col("status")
    return df.agg(F.count("*").alias("total"), F.count_if(s == "OK").alias("ok"), F.count_if(s == "NO_DOMAIN_FOUND").alias("no_domain"), F.count_if(s == "ERROR").alias("error"), F.floor(F.avg("latency_ms") + 0.5).alias("avg_latency_ms"))


def lead_report(df: DataFrame) -> DataFrame:
    """Totals, leads per category, mean score, leads with each contact field."""
    has = lambda c: F.count_if(F.length(F.coalesce(c, F.lit(""))) > 0).alias(f"with_{c}")
    cats = [F.count_if(F.col("category") == c).alias(c.lower()) for c in ("HOT", "WARM", "COLD", "DEAD")]
    return df.agg(F.count("*").alias("total"), *cats, F.round(F.avg("total"), 4).alias("mean_score"), *[has(c) for c in ("website", "vat", "email", "phone")])


def db_stats(companies: DataFrame, results: DataFrame, log: DataFrame) -> DataFrame:
    """Total, enriched, pending, and distinct failed companies."""
    c = companies.agg(F.count("*").alias("total"))
    r = results.agg(F.count("*").alias("enriched"))
    failed = log.agg(F.countDistinct(F.when(F.col("status") == "FAILED", F.col("company_id"))).alias("failed"))
    return c.join(r).join(failed).select("total", "enriched", (F.col("total") - F.col("enriched")).alias("pending"), "failed")  # one row each


#: Logarithm of a sketch's number of buckets; the standard error of a count is about 0.83 / sqrt(2 ** it), 1.3 % at 12.
SKETCH = 12


def distinct_sketches(log: DataFrame, by: str | Column, what: str = "company_id", lg: int = SKETCH) -> DataFrame:
    """(part, calls, sketch): a mergeable sketch of the distinct ``what`` of each part of a log, such as a day. Written once, it
    answers for any union of parts, without reading the log again."""
    return log.groupBy((F.col(by) if isinstance(by, str) else by).alias("part")).agg(F.count("*").alias("calls"), F.hll_sketch_agg(what, lg).alias("sketch"))


def distinct_rollup(sketches: DataFrame, to: Column) -> DataFrame:
    """(part, calls, distinct): calls and approximate distinct values of unions of parts, ``to`` what each belongs."""
    return sketches.groupBy(to.alias("part")).agg(F.sum("calls").alias("calls"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct"))


def ledger_summary(ledger: DataFrame, since: str | None = None) -> DataFrame:
    rows = ledger if since is None else ledger.where(F.col("ts") >= F.lit(since).cast("timestamp"))
    cost, n = F.coalesce(F.sum("cost_eur"), F.lit(0.0)), F.count("*")
    companies = F.countDistinct("company_id")
    return rows.agg(F.round(cost, 6).alias("cost_eur"), n.alias("calls"), F.round(F.coalesce(F.avg(F.col("success").cast("int")), F.lit(1.0)), 6).alias("success_rate"), F.round(F.when(companies > 0, cost / companies).otherwise(F.lit(0.0)), 6).alias("cost_per_company"))


def health_snapshot(ledger: DataFrame, window: str = "1 day", by: list[str] | None = None) -> DataFrame:
    """Per window: calls, error rate, mean and 95th percentile duration (element floor(0.95 n) of the sorted list), cost,
    cache hits, providers that are unhealthy (five calls and over 30 % errors), and whether to slow down."""
    by = by or []
    rows = ledger.withColumn("window_start", F.window("ts", window)["start"])
    keys = [*by, "window_start"]
    # The percentile from counts per duration, so that a window's calls are never in one task.
    counted = rows.where("duration_ms is not null").groupBy(*keys, "duration_ms").agg(F.count("*").alias("n"))
    w = Window.partitionBy(*keys)
    upto = counted.withColumns({"_upto": F.sum("n").over(w.orderBy("duration_ms")), "_of": F.sum("n").over(w)})
    p95 = upto.where("_upto >= cast(floor(_of * 0.95) as bigint) + 1").groupBy(*keys).agg(F.min("duration_ms").alias("p95_duration_ms"))
    per = rows.groupBy(*keys, "provider").agg(F.count("*").alias("n"), F.count_if(~F.col("success")).alias("bad"), F.sum("duration_ms").alias("ms"), F.sum("cost_eur").alias("cost"), F.count_if("cache_hit").alias("hits"))
    ill = (F.col("n") >= 5) & (F.col("bad") / F.col("n") > 0.3)
    # Few providers: rolled up from the counts per provider, so a busy one is aggregated before it moves.
    out = per.groupBy(*keys).agg(
        F.sum("n").alias("total_calls"), (F.sum("bad") / F.sum("n")).alias("error_rate"), (F.sum("ms") / F.sum("n")).alias("avg_duration_ms"), F.sum("cost").alias("cost_eur"), (F.sum("hits") / F.sum("n")).alias("cache_hit_rate"),
        F.array_join(F.sort_array(F.collect_list(F.when(ill, F.col("provider")))), ",").alias("providers_unhealthy"),
    )
    return out.withColumn("backpressure_recommended", (F.col("error_rate") > 0.2) | (F.col("avg_duration_ms") > 5000)).join(p95, keys, "left")


def provider_health(ledger: DataFrame) -> DataFrame:
    out = ledger.groupBy("provider").agg(F.avg((~F.col("success")).cast("int")).alias("error_rate"), F.avg("duration_ms").alias("avg_ms"))
    return out.withColumn("state", F.when(F.col("error_rate") > 0.3, "UNHEALTHY").when(F.col("avg_ms") > 10_000, "DEGRADED").otherwise("HEALTHY"))


def block_profile(blocks: DataFrame, hot: int = 5) -> DataFrame:
    """Counts per domain and block type, without NONE, and whether the domain is hot."""
    per = blocks.where("block_type <> 'NONE'").groupBy("domain", "block_type").agg(F.count("*").alias("n"))
    return per.withColumn("domain_total", F.sum("n").over(Window.partitionBy("domain"))).withColumn("hot", F.col("domain_total") >= hot)


def attach_pricing(usage: DataFrame, pricing: DataFrame, fallback: str) -> DataFrame:
    """Usage with prices per model; models without a price take the fallback model's."""
    spare = pricing.where(F.col("model") == fallback).select(F.col("input_per_1m").alias("_i"), F.col("output_per_1m").alias("_o"))
    return usage.join(pricing, "model", "left").join(F.broadcast(spare)).withColumns({"input_per_1m": F.coalesce("input_per_1m", "_i"), "output_per_1m": F.coalesce("output_per_1m", "_o")}).drop("_i", "_o")  # one row


def llm_cost(usage: DataFrame, pricing: DataFrame, fallback: str) -> DataFrame:
    cost = (F.col("prompt_tokens") * F.col("input_per_1m") + F.col("completion_tokens") * F.col("output_per_1m")) / 1e6
    return attach_pricing(usage, pricing, fallback).groupBy("model").agg(F.count("*").alias("calls"), F.round(F.sum(cost), 8).alias("cost"))


def url_vote(votes: DataFrame) -> DataFrame:
    """Per company the URL with the greatest sum of positive scores; confidence the sum / 20, to 0.95."""
    total = votes.where("score > 0").groupBy("company_id", "url").agg(F.sum("score").alias("total"))
    w = Window.partitionBy("company_id").orderBy(F.desc("total"), "url")
    return total.withColumn("_n", F.row_number().over(w)).where("_n = 1").select("company_id", "url", "total", F.least(F.col("total") / 20, F.lit(0.95)).alias("confidence"))


def source_mix(df: DataFrame, source: str = "source") -> DataFrame:
    merged = F.contains(F.col(source), F.lit("+"))
    return df.agg(F.count_if(merged).alias("merged"), F.count_if(~merged & (F.col(source) == "PG")).alias("pg_only"), F.count_if(~merged & (F.col(source) == "Maps")).alias("maps_only"))


def campaign_yield(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count_if(F.col("status") == "FOUND_VALID").alias("found"), F.count_if(F.col("status") == "NOT_FOUND").alias("not_found"), F.count_if(F.col("status") == "ERROR").alias("errors"),
        F.round(F.sum("cost_eur"), 6).alias("cost_eur"), F.round(F.sum("cost_eur") / F.count("*"), 8).alias("cost_per_company"),
    )


def split_overflow_targets(results: DataFrame, municipalities: DataFrame, most: int = 199) -> DataFrame:
    """Search targets: category and province, or with more than ``most`` results each of its municipalities."""
    counts = results.groupBy("category", "province").agg(F.count("*").alias("n"))
    return counts.join(municipalities, (counts["province"] == municipalities["m_province"]) & (F.col("n") > most), "left").select("category", "province", F.coalesce("municipality", "province").alias("target"), "n")


def running_totals(log: DataFrame, key: str = "provider") -> DataFrame:
    """Per key: processed, found, yield, and the failures in a row at the end of the log (all if there was no success).

    Two aggregations: the last success of each key, then the counts of each key and of what comes after it."""
    last = log.groupBy(F.col(key).alias("_key")).agg(F.max(F.when(F.col("success"), F.struct("ts", "event_id"))).alias("_last"))
    rows = log.join(last, F.col(key).eqNullSafe(F.col("_key")))
    tail = F.coalesce(F.struct("ts", "event_id") > F.col("_last"), F.lit(True))
    return rows.groupBy(key).agg(F.count("*").alias("processed"), F.count_if("success").alias("found"), F.avg(F.col("success").cast("int")).alias("yield"), F.count_if(tail).alias("consecutive_failures"))


def alerts(health: DataFrame, cost_per_company: float = 0.06, exhaustions: int = 10) -> DataFrame:
    """(window_start, alert, value) of five-minute windows: COST_RUNAWAY and PROVIDER_EXHAUSTION."""
    found = F.array_compact(
        F.array(
            F.when(F.col("cost_per_company") > cost_per_company, F.struct(F.lit("COST_RUNAWAY").alias("alert"), F.col("cost_per_company").cast("double").alias("value"))),
            F.when(F.col("exhausted") > exhaustions, F.struct(F.lit("PROVIDER_EXHAUSTION").alias("alert"), F.col("exhausted").cast("double").alias("value"))),
        )
    )
    return health.select("window_start", F.explode(found).alias("_a")).select("window_start", "_a.alert", "_a.value")


def circuit_breaker(health: DataFrame, cost: float = 0.04, errors: float = 0.25, hold_s: float = 600) -> DataFrame:
    """(run_id, window_start, open): opens on cost per company or error rate, closes only when clean and ``hold_s`` after
    opening. Openings are followed by pointers, so a run's windows are spread over tasks, however many it has. Missing figures are
    clean; rows without a time are left out; a time with a bad and a clean row is bad."""
    is_bad = F.coalesce(F.col("cost_per_company") > cost, F.lit(False)) | F.coalesce(F.col("error_rate") > errors, F.lit(False))
    rows = health.where(F.col("window_start").isNotNull()).select(F.struct(F.col("run_id").cast("string").alias("run_id")).alias("k"), F.col("window_start").cast("timestamp").alias("window_start"), is_bad.alias("bad"))
    points = materialize(rows.groupBy("k", "window_start", folds.micros(F.col("window_start")).alias("t")).agg(F.bool_or("bad").alias("bad")))
    inside = folds.within_spells(points, folds.open_spells(points, hold_s), round(max(hold_s, 60) * 1_000_000))
    return points.join(inside, ["k", "t"]).select("k.run_id", "window_start", F.col("inside").alias("open"))


def cooldown(events: DataFrame, key: str, seconds: float) -> DataFrame:
    """(event_id, key, approved): an event is approved if the key's last approved one lies ``seconds`` back. The same rule
    gives first writes with a time to live: what isn't approved is a cache hit. At one time the least event_id counts. Rows
    without a key or time are left out. Approved times are followed by pointers, so a key's events are spread over tasks."""
    rows = events.where(F.col(key).isNotNull() & F.col("ts").isNotNull()).select(F.col(key).alias("k"), folds.micros(F.col("ts")).alias("t"), "event_id")
    taken = folds.spaced_out(rows, seconds)
    first = rows.groupBy("k", "t").agg(F.min("event_id").alias("_first"), F.lit(True).alias("_taken")).join(taken, ["k", "t"])
    out = rows.join(first, ["k", "t"], "left")
    return out.select("event_id", F.col("k").alias(key), (F.col("_taken").isNotNull() & F.col("event_id").eqNullSafe(F.col("_first"))).alias("approved"))
