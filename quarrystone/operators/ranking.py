"""Choosing among candidates: decisions, waterfalls, top rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, group: list[str], order: list, k: int) -> DataFrame:
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("place") <= k)


def decide(scored: DataFrame, ok: float = 80, ok_margin: float = 20, risk: float = 94, risk_margin: float = 30, phone_limit: int = 3) -> DataFrame:
    """One row per company: the best candidate, its margin over the second, and whether it passes.

    High risk (phone shared by ``phone_limit`` companies or a name of four characters at most) asks for more. Ties go to the
    earlier candidate. Confidence: score plus margin / 5 (10 at most), to 100; a rejected one has its score, to 80.
    """
    w = Window.partitionBy("company_id").orderBy(F.desc("final_score"), "pos")
    ranked = scored.withColumns({"_n": F.row_number().over(w), "_second": F.lead("final_score", 1, 0.0).over(w)}).where("_n = 1")
    margin = F.col("final_score") - F.col("_second")
    risky = (F.col("phone_freq") >= phone_limit) | (F.length("company_name") <= 4)
    passed = F.when(risky, (F.col("final_score") >= risk) & (margin >= risk_margin)).otherwise((F.col("final_score") >= ok) & (margin >= ok_margin))
    confidence = F.when(passed, F.least(F.lit(100.0), F.col("final_score") + F.least(F.lit(10.0), margin / 5))).otherwise(F.least(F.lit(80.0), F.col("final_score")))
    reason = F.when(passed & (F.coalesce("n_vats", F.lit(0)) > 0), "OK_CONFIRMED_VAT_MATCH").when(passed & (F.coalesce("n_phones", F.lit(0)) > 0), "OK_CONFIRMED_PHONE_MATCH").when(passed, "OK_LIKELY_NAME_CITY_MATCH")
    listed = F.lower("source_url").rlike(r"facebook\.com|instagram\.com|linkedin\.com|paginegialle\.it")
    reason = F.coalesce(reason, F.when(listed, "REJECTED_DIRECTORY_OR_SOCIAL").otherwise("REJECTED_NO_MATCHING_SIGNALS"))
    return ranked.select(
        "company_id", F.when(passed, F.col("source_url")).alias("site_url"), F.when(passed, "OK").otherwise("NO_DOMAIN_FOUND").alias("status"), reason.alias("reason_code"),
        F.col("final_score").alias("score"), margin.alias("margin"), F.floor(confidence + 0.5).cast("int").alias("confidence"),
    )


def complete(inputs: DataFrame, decided: DataFrame, key: str = "company_id", run_id: str = "run") -> DataFrame:
    """Every input row gives an output row: missing decisions are filled with defaults."""
    out = inputs.join(decided, key, "left")
    fill = {"status": "NO_DOMAIN_FOUND", "reason_code": "NOT_FOUND_NO_CANDIDATES"}
    out = out.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in fill.items()} | {"score": F.coalesce("score", F.lit(0.0)), "confidence": F.coalesce("confidence", F.lit(0))})
    return out.withColumns({"run_id": F.lit(run_id), "timestamp": F.current_timestamp()})


def top2_candidates(df: DataFrame, column: str = "candidates_json") -> DataFrame:
    """The two best of a JSON list of candidates as four columns."""
    parsed = F.from_json(column, "array<struct<url: string, score: double>>")
    order = lambda x, y: F.when(x["score"] > y["score"], -1).when(x["score"] < y["score"], 1).otherwise(0)
    best = F.array_sort(F.coalesce(parsed, F.array().cast("array<struct<url: string, score: double>>")), order)
    return df.withColumn("_b", best).withColumns({f"candidate{i}_{f}": F.get("_b", F.lit(i - 1))[f] for i in (1, 2) for f in ("url", "score")}).drop("_b")


def best_verification(df: DataFrame, threshold: float, most: int) -> DataFrame:
    """Per company, of its first ``most`` candidates the one of best confidence, and whether it is valid."""
    kept = top_k(df, ["company_id"], ["pos"], most).drop("place")
    best = top_k(kept, ["company_id"], [F.desc("confidence"), "pos"], 1).drop("place")
    return best.withColumn("status", F.when(F.col("confidence") >= threshold, "FOUND_VALID").otherwise("FOUND_INVALID"))


def waterfall(df: DataFrame, thresholds: dict[int, float], weak: float = 0.35) -> DataFrame:
    """Per company the first layer whose verification passes its threshold; else the best of ``weak`` at least; else none."""
    limit = F.coalesce(*[F.when(F.col("layer") == k, F.lit(v)) for k, v in thresholds.items()], F.lit(1.1))
    rows = df.withColumn("_pass", F.col("confidence") >= limit)
    w = Window.partitionBy("company_id").orderBy(F.desc("_pass"), F.when(F.col("_pass"), F.col("layer")), F.desc("confidence"), "layer", "pos")
    best = rows.withColumn("_n", F.row_number().over(w)).where("_n = 1")
    status = F.when(F.col("_pass"), "FOUND_VALID").when(F.col("confidence") >= weak, "FOUND_INVALID").otherwise("NOT_FOUND")
    return best.withColumn("status", status).withColumn("url", F.when(status != "NOT_FOUND", F.col("url"))).drop("_n", "_pass")


# Threshold steps and candidate limits of the runs.
MODES = [("FAST", 0.0, 8), ("DEEP", -0.05, 15), ("AGGRESSIVE", -0.1, 20), ("NUCLEAR", -0.15, 30)]


def mode_thresholds(df: DataFrame, base: float = 0.75, bleeding: bool = False) -> DataFrame:
    """Rows x modes: threshold (0.1 to 0.99) and candidate limit, 8 at most while costs run away."""
    modes = df.sparkSession.createDataFrame(MODES, "mode string, delta double, most int")
    limit = F.least(F.col("most"), F.lit(8)) if bleeding else F.col("most")
    modes = modes.select("mode", F.greatest(F.lit(0.1), F.least(F.lit(0.99), F.lit(base) + F.col("delta"))).alias("threshold"), limit.alias("most"))
    return df.join(F.broadcast(modes), "mode")  # four rows


def financial_waterfall(df: DataFrame, fields: list[str], order: list[str], company: str = "company_id", source: str = "source") -> DataFrame:
    """Per company and field the value of the first source in ``order`` that has one, and whether revenue is an estimate."""
    rank = F.coalesce(*[F.when(F.col(source) == s, F.lit(i)) for i, s in enumerate(order)], F.lit(len(order)))
    picks = [F.min_by(F.when(F.col(f).isNotNull(), F.col(f)), F.when(F.col(f).isNotNull(), rank)).alias(f) for f in fields]
    return df.groupBy(company).agg(*picks, F.min_by(source, F.when(F.col(fields[0]).isNotNull(), rank)).alias("first_source"))


def vat_waterfall(candidates: list) -> object:
    """The first of several columns that is a VAT number with a right check digit."""
    from quarrystone.functions.contacts import digits, vat_checksum

    return F.coalesce(*[F.when(vat_checksum(c), digits(c)) for c in candidates])


def attempts(log: DataFrame, last: int = 3) -> DataFrame:
    """Job log with attempt numbers; a failed attempt is RETRYING, the last one FAILED and dead."""
    w = Window.partitionBy("company_id").orderBy("ts", "event_id")
    out = log.withColumn("attempt", F.row_number().over(w))
    failed = F.col("success") == F.lit(False)
    state = F.when(failed & (F.col("attempt") >= last), "FAILED").when(failed, "RETRYING").otherwise("OK")
    return out.withColumn("state", state).withColumn("dead", state == "FAILED")


def pick_provider(tasks: DataFrame, providers: DataFrame, health: DataFrame, max_tier: int = 5) -> DataFrame:
    """Per task the cheapest provider of its kind that is healthy, not exhausted, and of an allowed tier."""
    fit = providers.join(health, "provider", "left").where((F.col("tier") <= max_tier) & ~F.col("exhausted") & (F.coalesce("error_rate", F.lit(0.0)) <= 0.3))
    w = Window.partitionBy("task_id").orderBy("tier", "provider")
    return tasks.join(fit, "task_type").withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def phone_frequency(df: DataFrame, row_id: str = "row_id", phones: str = "phones") -> DataFrame:
    """(row_id, phone_freq): the greatest number of rows that share one of the row's phones. Phones of one row aren't
    joined back at all, so only shared ones are shuffled twice."""
    rows = df.select(row_id, F.explode(F.array_distinct(phones)).alias("phone"))
    shared = rows.groupBy("phone").agg(F.count("*").alias("n")).where("n > 1")
    most = rows.join(shared, "phone").groupBy(row_id).agg(F.max("n").alias("phone_freq"))
    return df.select(row_id, phones).join(most, row_id, "left").select(row_id, F.coalesce("phone_freq", F.when(F.size(phones) > 0, F.lit(1)).otherwise(F.lit(0))).cast("long").alias("phone_freq"))


def running_phone_frequency(df: DataFrame, row_id: str = "row_id", phones: str = "phones") -> DataFrame:
    """(row_id, phone_freq): the same, counting only rows so far."""
    rows = df.select(row_id, F.explode_outer(F.array_distinct(phones)).alias("phone"))
    so_far = F.count("phone").over(Window.partitionBy("phone").orderBy(row_id).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("n", so_far).groupBy(row_id).agg(F.max("n").alias("phone_freq"))


def needs_llm_review(df: DataFrame, best: float = 0.4, points: int = 2) -> DataFrame:
    """Companies worth a paid review: no candidate or a best below ``best``, ``points`` of vat, phone, address, city filled,
    costs under control, and no review in the last day (``last_review`` before ``now`` by 24 hours)."""
    filled = sum((F.length(F.trim(F.coalesce(c, F.lit("")))) > 0).cast("int") for c in ("vat", "phone", "address", "city"))
    rested = F.col("last_review").isNull() | (F.col("last_review") <= F.col("now") - F.expr("INTERVAL 24 HOURS"))
    return df.where((F.coalesce("best_confidence", F.lit(0.0)) < best) & (filled >= points) & ~F.col("bleeding") & rested)
