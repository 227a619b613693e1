"""Sharding by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrystone.llm.common import Boxed, col_of, need, seeded_hash, stratum
from quarrystone.session import table

#: Hash cells of a source and bands of the global order.
FINE = 4096
SHARDS = 24
SEED = 17


def interleave_shards(
    docs: DataFrame,
    n_shards: int = SHARDS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    keep: list[str] | None = None,
    repeats: bool = False,
) -> DataFrame:
    """Deal all rows into ``n_shards`` shards whose counts differ by one at most and which each match the mixture.

    Rows of a source are ranked in a seeded shuffle, rank r of n becomes the fraction (2r - 1) / 2n, all rows are sorted
    by fraction (ties: source, then rank) and the order is cut into equal runs. Returned columns: ``keep`` (all of
    ``docs`` by default; those named like a new one, in any case, are replaced), ``size`` (UTF-8 bytes + 8; null text:
    none), ``text_crc32``, ``law`` ('rows'), ``shard``, ``slot`` (gapless from 0), ``grown_shard`` (null: the law 'key' does
    not hold), ``fraction``.

    With ``repeats``, rows that share an id are taken for passes over it, as mixing makes them: they are numbered, and a
    source's rows are shuffled pass by pass, so that a repeat comes only after the whole source has been read. Ids are then
    supposed to name rows: those of one id are numbered in one task (null ids are not numbered).

    No rank is counted in one task: a row's rank is the number of rows in lower hash cells of its source (``FINE`` cells
    per source and pass) plus its rank within the cell; its place is the number of rows in lower bands of the global order,
    which follows from the source counts alone, plus its rank within the band. A hot source is so spread over ``FINE`` cells.
    Null sources are a source of their own; null ids shuffle by their text's checksum; rows that repeat an id without
    ``repeats`` tie and take neighbouring slots in any order; an empty table gives an empty result.
    """
    need(docs, id_col, text_col, source_col)
    boxed = Boxed(docs, keep, ["size", "text_crc32", "law", "fraction", "shard", "slot", "grown_shard"])
    text = F.coalesce(col_of(text_col), F.lit(""))
    rows = docs.select(
        boxed.box,
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text).alias("text_crc32"),
        stratum(col_of(source_col)).alias("_s"),
        col_of(id_col).alias("_id"),
        F.lit(0).alias("_pass"),
    )
    if repeats:
        alone = F.when(F.col("_id").isNull(), F.monotonically_increasing_id())
        rows = rows.withColumn("_alone", alone).withColumn("_pass", F.row_number().over(Window.partitionBy("_id", "_alone").orderBy("text_crc32")) - 1)
    shuffled = F.when(F.col("_pass") > 0, seeded_hash(seed, F.col("_id"), F.col("_pass")))
    shuffled = shuffled.when(F.col("_id").isNull(), seeded_hash(seed, F.col("_id"), F.col("text_crc32"))).otherwise(seeded_hash(seed, F.col("_id")))
    rows = rows.withColumn("_h", shuffled).withColumn("_cell", F.col("_pass").cast("long") * FINE + F.shiftright("_h", 48))
    counts = rows.groupBy("_s", "_cell").agg(F.count("*").alias("_n"))
    by_source = Window.partitionBy("_s")  # cells of a source
    cells = counts.select(
        "_s",
        "_cell",
        (F.sum("_n").over(by_source.orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_below"),
        F.sum("_n").over(by_source).alias("_of"),
    )
    in_cell = Window.partitionBy("_s", "_cell").orderBy("_h", "_id", "text_crc32")
    ranked = rows.withColumn("_r", F.row_number().over(in_cell)).join(cells, ["_s", "_cell"])
    ranked = ranked.withColumn("_rank", F.col("_below") + F.col("_r"))
    ranked = ranked.withColumn("fraction", (2 * F.col("_rank") - 1) / (F.lit(2.0) * F.col("_of")))
    ranked = ranked.withColumn("_band", F.expr(f"((2 * _rank - 1) * {FINE // 2}) div _of"))
    # Of a source of n rows, floor(ceil(2bn / FINE) / 2) ranks lie below band b.
    sources = counts.groupBy("_s").agg(F.sum("_n").alias("_of"))
    bands = sources.select("_of", F.explode(F.expr(f"sequence(0L, {FINE - 1}L)")).alias("_band"))
    bands = bands.groupBy("_band").agg(
        F.expr(f"sum(((_band * _of + {FINE // 2 - 1}) div {FINE // 2}) div 2)").alias("_before"), F.sum("_of").alias("_all")
    )
    in_band = Window.partitionBy("_band").orderBy("fraction", "_s", "_rank")
    placed = ranked.withColumn("_p", F.row_number().over(in_band)).join(F.broadcast(bands), "_band")  # FINE rows
    placed = placed.withColumn("_at", F.col("_before") + F.col("_p") - 1)
    placed = placed.withColumn("shard", F.expr(f"cast((_at * {n_shards}) div _all as int)"))
    return placed.select(
        *boxed.columns(),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.expr(f"_at - (shard * _all + {n_shards - 1}) div {n_shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "fraction",
    )


def op7_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return interleave_shards(docs, keep=["doc_id", "source"])


def sharding_sql(docs: str, seed: int = SEED, n_shards: int = SHARDS, repeats: bool = False) -> str:
    """CTEs that end in ``sharded``, ranks and places counted plainly."""
    turn = "row_number() OVER (PARTITION BY doc_id ORDER BY text) - 1" if repeats else "0"
    return f"""
    sh_table AS (
      SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b::BIGINT, range(8)::BIGINT[]),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
    sh_rows AS (
      SELECT doc_id, source, body, s, k, ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, '~') || CASE WHEN k > 0 THEN ':' || k ELSE '' END), 1, 15))::BIGINT AS h
      FROM (SELECT doc_id, source, coalesce(text, '') AS body, coalesce('s:' || source, 'n') AS s, {turn} AS k FROM {docs})),
    sh_crc AS (
      SELECT doc_id, source, s, k, h, strlen(body) + 8 AS size,
        xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, 2 * strlen(body), 2),
          lambda i: ('0x' || substr(hex(encode(body)), i::INT, 2))::BIGINT)),
          lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32 FROM sh_rows, sh_table),
    sh_ranked AS (
      SELECT *, row_number() OVER (PARTITION BY s ORDER BY k, h, doc_id, text_crc32) AS r, count(*) OVER (PARTITION BY s) AS n FROM sh_crc),
    sh_placed AS (
      SELECT *, (2 * r - 1) / (2.0::DOUBLE * n) AS fraction,
        row_number() OVER (ORDER BY (2 * r - 1) / (2.0::DOUBLE * n), s, r) - 1 AS p, count(*) OVER () AS a FROM sh_ranked),
    sh_cut AS (SELECT *, ((p * {n_shards}) // a)::INTEGER AS shard FROM sh_placed),
    sharded AS (SELECT doc_id, source, size, text_crc32, 'rows' AS law, shard, p - (shard::BIGINT * a + {n_shards - 1}) // {n_shards} AS slot,
      NULL::INTEGER AS grown_shard, fraction FROM sh_cut)"""


OP7_SQL = f"WITH {sharding_sql('documents')} SELECT * FROM sharded"
