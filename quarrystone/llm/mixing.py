"""Mixing sources to target weights by temperature."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrystone.llm.common import Boxed, blank_words, col_of, need, seeded_hash, stratum
from quarrystone.session import materialize, table

BLOCKS = 1024
SEED = 29
MAX_REPETITION = 2.0
STEPS = 60
#: A block table of more rows than this is joined by a shuffle.
BROADCAST_ROWS = 200_000


def bisect_repetition(largest: float, smallest: float, limit: float) -> float:
    """Smallest exponent in [0, 1] at which no source repeats more than ``limit`` times while the largest is read once."""
    lo, hi = 0.0, 1.0
    for _ in range(STEPS):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if math.pow(largest / smallest, 1 - mid) > limit else (lo, mid)
    return hi


def bisect_entropy(totals: DataFrame, target: float, levels: int = 6, passes: int = 7) -> float:
    """Largest exponent in [0, 1] whose weights have an entropy (nats) of ``target`` at least; 0 if none has.

    Entropy falls as the exponent grows. A pass weighs 2**levels - 1 inner points of the interval in one aggregation over
    the sources, that is ``levels`` halvings at once, so only a few numbers reach the driver however many sources there are.
    """
    lo, width = 0.0, 1.0
    n = 2**levels
    for _ in range(passes):
        points = [lo + width * i / n for i in range(1, n + 1)]
        grid = totals.where("n > 0").select("n", F.explode(F.array(*[F.lit(p) for p in points])).alias("a"))
        got = (
            grid.groupBy("a")
            .agg(F.sum(F.pow("n", "a")).alias("z"), F.sum(F.pow("n", "a") * F.log("n")).alias("zl"))
            .select("a", (F.log("z") - F.col("a") * F.col("zl") / F.col("z")).alias("h"))
            .where(F.col("h") >= target)
            .agg(F.max("a"))
            .first()[0]
        )
        lo, width = (lo if got is None else got), width / n
        if lo >= 1.0:
            return 1.0
    return lo


def source_totals(docs: DataFrame, text_col: str = "text", source_col: str = "source") -> DataFrame:
    return docs.groupBy(stratum(F.col(source_col)).alias("_s")).agg(F.sum(F.size(blank_words(F.col(text_col)))).cast("long").alias("n"))


def mixing_weights(totals: DataFrame, max_repetition: float | None, target_entropy: float | None, budget: int | None) -> DataFrame:
    """(``_s``, ``n``, ``weight``, ``micro_epochs``): n ** a / sum, and millionths of a pass over the source."""
    ends = totals.where("n > 0").agg(F.max("n"), F.min("n")).first()
    largest, smallest = ends[0] or 1, ends[1] or 1
    if target_entropy is not None:
        a = bisect_entropy(totals, target_entropy)
    else:
        a = bisect_repetition(largest, smallest, MAX_REPETITION if max_repetition is None else max_repetition)
    z = totals.where("n > 0").agg(F.sum(F.pow("n", F.lit(a)))).first()[0] or 1.0
    weight = F.when(F.col("n") > 0, F.pow("n", F.lit(a)) / F.lit(z)).otherwise(F.lit(0.0))
    if budget is None:
        passes = F.pow(F.lit(float(largest)) / F.col("n"), F.lit(1 - a))
    else:
        passes = F.col("weight") * F.lit(float(budget)) / F.col("n")
    out = totals.withColumn("weight", weight)
    return out.withColumn("micro_epochs", F.when(F.col("n") > 0, F.round(passes * 1e6).cast("long")).otherwise(F.lit(1_000_000).cast("long")))


def mix_sources(
    docs: DataFrame,
    max_repetition: float | None = None,
    target_entropy: float | None = None,
    budget: int | None = None,
    seed: int = SEED,
    blocks: int = BLOCKS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    keep: list[str] | None = None,
    epochs: bool = True,
) -> DataFrame:
    """Repeat rows so that sources meet temperature weights: share ** a, normalised.

    The exponent a is bisected: the smallest at which no source is read more than ``max_repetition`` times (2 by default),
    or the largest whose weights have ``target_entropy``. Without a ``budget`` (in words) the largest source is read
    exactly once and every other at least once, so no row is lost; with one, a source may be cut. Rows of a source fall
    into ``blocks`` by a seeded hash; every epoch takes the blocks in an order of its own, and the last takes blocks while
    at least half of the next one fits into what is left of the source's words. Returned: ``keep`` (all columns by default;
    those named like a new one, in any case, are replaced) and, with ``epochs``, ``epoch`` (from 0) and ``block_rank``, the
    place of the row's block in that epoch.

    The per-source state is the block table (sources x ``blocks`` rows), made by partial aggregation; rows get their copies
    by a join on (source, block), so a hot source is spread over ``blocks`` keys. The table is broadcast up to
    ``BROADCAST_ROWS`` rows, else shuffled. Null sources are a source of their own; rows without words weigh nothing and
    ride along with their block; sources without any words are read once; repeated rows share their fate; an empty table
    gives an empty result.
    """
    need(docs, id_col, text_col, source_col)
    new = ["epoch", "block_rank"] if epochs else []
    boxed = Boxed(docs, keep, new)
    block = (seeded_hash(seed, col_of(id_col)) % blocks).cast("int")
    cells = docs.select(stratum(col_of(source_col)).alias("_s"), block.alias("_b"), F.size(blank_words(col_of(text_col))).alias("_w"))
    cells = materialize(cells.groupBy("_s", "_b").agg(F.sum("_w").cast("long").alias("_w")))
    totals = cells.groupBy("_s").agg(F.sum("_w").alias("n"))
    totals = mixing_weights(totals, max_repetition, target_entropy, budget).select(
        "_s",
        F.expr("cast(micro_epochs div 1000000 as int)").alias("_full"),
        F.expr("cast((cast(micro_epochs % 1000000 as decimal(19,0)) * n) div 1000000 as bigint)").alias("_rest"),
    )
    plan = cells.join(totals, "_s").select("_s", "_b", "_w", "_rest", F.explode(F.sequence(F.lit(0), F.col("_full"))).alias("epoch"), "_full")
    shuffled = Window.partitionBy("_s", "epoch").orderBy(seeded_hash(seed, F.col("epoch"), F.col("_s"), F.col("_b")), "_b")  # blocks rows at most
    plan = plan.select(
        "_s",
        "_b",
        "epoch",
        F.row_number().over(shuffled).alias("block_rank"),
        ((F.col("epoch") < F.col("_full")) | (2 * F.sum("_w").over(shuffled.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_w") < 2 * F.col("_rest"))).alias("_in"),
    ).where("_in")
    plan = materialize(plan.groupBy("_s", "_b").agg(F.collect_list(F.struct("epoch", "block_rank")).alias("_copies")))
    if plan.count() <= BROADCAST_ROWS:
        plan = F.broadcast(plan)
    placed = docs.select(boxed.box, stratum(col_of(source_col)).alias("_s"), block.alias("_b")).join(plan, ["_s", "_b"])
    return placed.select("_doc", F.explode("_copies").alias("_copy")).select(*boxed.columns(), *[f"_copy.{c}" for c in new])


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"), keep=["doc_id", "source"])


def mixing_sql(docs: str, seed: int = SEED, blocks: int = BLOCKS, limit: float = MAX_REPETITION) -> str:
    """CTEs (one is recursive) that end in ``mx_copies`` (doc_id, epoch, block_rank)."""
    md5 = lambda x: f"('0x' || substr(md5({x}), 1, 15))::BIGINT"
    return f"""
    mx_rows AS (
      SELECT doc_id, coalesce('s:' || source, 'n') AS s, ({md5(f"'{seed}:' || coalesce(doc_id::VARCHAR, '~')")} % {blocks})::INT AS b,
        len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS w FROM {docs}),
    mx_cells AS (SELECT s, b, sum(w)::BIGINT AS w FROM mx_rows GROUP BY s, b),
    mx_totals AS (SELECT s, sum(w)::BIGINT AS n FROM mx_cells GROUP BY s),
    mx_ends AS (SELECT coalesce(max(n), 1)::DOUBLE AS hi, coalesce(min(n), 1)::DOUBLE AS lo FROM mx_totals WHERE n > 0),
    mx_bisect AS (
      SELECT 0 AS step, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
      UNION ALL
      SELECT step + 1, CASE WHEN pow(e.hi / e.lo, 1 - (b.lo + b.hi) / 2) > {limit} THEN (b.lo + b.hi) / 2 ELSE b.lo END,
        CASE WHEN pow(e.hi / e.lo, 1 - (b.lo + b.hi) / 2) > {limit} THEN b.hi ELSE (b.lo + b.hi) / 2 END FROM mx_bisect b, mx_ends e WHERE step < {STEPS}),
    mx_passes AS (
      SELECT s, n, CASE WHEN n > 0 THEN round(pow(e.hi / n, 1 - b.hi) * 1e6)::BIGINT ELSE 1000000 END AS m
      FROM mx_totals, mx_ends e, mx_bisect b WHERE b.step = {STEPS}),
    mx_plan AS (
      SELECT c.s, c.b, c.w, unnest(range(0, m // 1000000 + 1))::INT AS epoch, m // 1000000 AS full_, ((m % 1000000)::HUGEINT * n) // 1000000 AS rest
      FROM mx_cells c JOIN mx_passes USING (s)),
    mx_ordered AS (
      SELECT *, row_number() OVER o AS block_rank, sum(w) OVER (o ROWS UNBOUNDED PRECEDING) AS upto FROM mx_plan
      WINDOW o AS (PARTITION BY s, epoch ORDER BY {md5(f"'{seed}:' || epoch || ':' || s || ':' || b")}, b)),
    mx_copies AS (SELECT doc_id, epoch, block_rank::INTEGER AS block_rank FROM mx_rows JOIN mx_ordered USING (s, b)
      WHERE epoch < full_ OR 2 * upto - mx_ordered.w < 2 * rest)"""


OP10_SQL = f"WITH RECURSIVE {mixing_sql('documents')} SELECT doc_id, source, epoch, block_rank FROM mx_copies JOIN documents USING (doc_id)"
