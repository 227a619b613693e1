"""Exact duplicates by a two-pass Bloom filter: only rows whose hash may repeat are shuffled."""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm.common import Boxed, col_of, need, spread_join
from quarrystone.session import materialize, table

#: Cells of the filter for each row, and cells that a row sets at most; a unique row finds all of its cells shared by chance
#: once in 200 then.
CELLS_PER_ROW = 16
PROBES = 3
#: Cells in a bitmap of Spark's bitmap functions: a row's cells lie in one bitmap, so that one lookup tests them all.
BLOCK = 8 * 4096
#: Most cells of a filter, which is broadcast: 128 MB. Beyond CELLS_PER_ROW times as few rows its cells fill up, so that more
#: rows are shuffled; the result stays.
MAX_CELLS = 1 << 30


def _cells(hashed: Column, probes: int) -> list[Column]:
    mixed = F.xxhash64(F.lit("cell"), hashed)
    return [F.shiftrightunsigned(mixed, 15 * i).bitwiseAND(BLOCK - 1).cast("int") for i in range(probes)]


def _block(hashed: Column, blocks: int) -> Column:
    return F.pmod(hashed, F.lit(blocks)).cast("int")


def _text_hash(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(col_of(text_col), F.lit("")))


class BloomFilter:
    """Which cells have been set by two rows or more, as bitmaps (_block, _bits).

    ``hashes``: one column of longs, a row each. ``blocks`` and ``probes`` follow from the number of rows.
    """

    def __init__(self, hashes: DataFrame, max_cells: int = MAX_CELLS):
        rows = hashes.count()
        cells = min(max(rows * CELLS_PER_ROW, BLOCK), max(max_cells, BLOCK))
        self.blocks = -(-cells // BLOCK)
        self.probes = min(max(round(self.blocks * BLOCK / max(rows, 1) * log(2)), 1), PROBES)
        h = F.col(hashes.columns[0])
        placed = hashes.select(_block(h, self.blocks).alias("_block"), F.explode(F.array_distinct(F.array(*_cells(h, self.probes)))).alias("cell"))
        again = placed.groupBy("_block", "cell").agg(F.count("*").alias("n")).where("n > 1")
        self.bitmaps = materialize(again.groupBy("_block").agg(F.bitmap_construct_agg("cell").alias("_bits")))

    def flagged(self, rows: DataFrame, hashed: str) -> DataFrame:
        """``rows`` with ``_maybe``: false only if no other row has this hash. At most ``blocks`` bitmaps are broadcast."""
        known = rows.withColumn("_block", _block(F.col(hashed), self.blocks)).join(F.broadcast(self.bitmaps), "_block", "left")
        byte = lambda c: F.conv(F.hex(F.expr("_bits").substr(F.shiftright(c, 3) + 1, F.lit(1))), 16, 10).cast("int")
        tests = [F.getbit(byte(c), c.bitwiseAND(7)) == 1 for c in _cells(F.col(hashed), self.probes)]
        hit = tests[0]
        for t in tests[1:]:
            hit = hit & t
        return known.withColumn("_maybe", F.coalesce(F.col("_bits").isNotNull() & hit, F.lit(False))).drop("_block", "_bits")


def _marked(docs: DataFrame, id_col: str, text_col: str, keep: list[str] | None, new: list[str], max_cells: int) -> tuple[DataFrame, Boxed]:
    """(_doc, keep_id, group_size, kept, text_sha256) of every row."""
    hashes = materialize(docs.select(_text_hash(text_col).alias("h")))
    seen = BloomFilter(hashes, max_cells)
    boxed = Boxed(docs, keep, new)
    text = F.coalesce(col_of(text_col), F.lit(""))
    rows = docs.select(boxed.box, col_of(id_col).alias("_id"), text.alias("_text"), _text_hash(text_col).alias("_h"))
    rows = seen.flagged(rows, "_h")
    sha = F.sha2("_text", 256).alias("text_sha256")

    alone = rows.where("not _maybe").select("_doc", F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), sha)
    # Only these are shuffled. They are written with a number each, which tells repeated rows of one id apart.
    maybe = materialize(rows.where("_maybe").select("_doc", "_id", sha, F.monotonically_increasing_id().alias("_row")))
    groups = maybe.groupBy("text_sha256").agg(F.max(F.struct("_id", "_row")).alias("best"), F.count("*").alias("group_size"))
    groups = materialize(groups.select("text_sha256", F.col("best._id").alias("keep_id"), F.col("best._row").alias("_best"), "group_size"))
    told = spread_join(maybe, groups, "text_sha256", "group_size")
    told = told.select("_doc", "keep_id", "group_size", (F.col("_row") == F.col("_best")).alias("kept"), "text_sha256")
    return told.unionByName(alone), boxed


def mark_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, max_cells: int = MAX_CELLS) -> DataFrame:
    """Every row with the row that stays for its text.

    Added to ``keep`` (all columns by default; those named like a new one, in any case, are replaced): ``keep_id``, the
    largest ``id_col`` among equal texts; ``group_size``, their number; ``kept``, true for the one row that stays;
    ``text_sha256`` (lower-case hex, UTF-8). Texts are equal if identical; nothing is changed before.

    First pass: each row sets up to ``PROBES`` cells of a blocked Bloom filter by its text's 64-bit hash; cells set by one row
    alone are dropped when the counts are merged. Second pass: a row with a cell that no other has set is unique and goes
    straight to the result. The others, possibly repeated, are grouped by SHA-256, so chance hits of the filter and of the
    hash do not matter. Copies of a text meet as partial aggregates; groups of over a thousandth of the grouped rows are
    joined back by broadcast (there are fewer than a thousand), the others by a shuffle.

    The broadcast filter takes 2 bytes a row and ``max_cells`` / 8 bytes at most; with more rows it is fuller and fewer go
    straight. The texts are read three times (hashes, the repeated, the rest) and never written or shuffled unless ``keep``
    holds them.

    Null counts as empty, and all empty texts are one group. Null ids lose against others; a group of null ids keeps one row.
    Of repeated rows (same id and text) one stays. An empty table gives an empty result.
    """
    need(docs, id_col, text_col)
    told, boxed = _marked(docs, id_col, text_col, keep, ["keep_id", "group_size", "kept", "text_sha256"], max_cells)
    return told.select(*boxed.columns(), "keep_id", "group_size", "kept", "text_sha256")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_cells: int = MAX_CELLS) -> DataFrame:
    """The rows of ``docs`` that ``mark_exact_duplicates`` keeps, with all their columns as they are."""
    need(docs, id_col, text_col)
    told, boxed = _marked(docs, id_col, text_col, None, [], max_cells)
    return told.where("kept").select(*boxed.columns())


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_exact_duplicates(table(spark, sf_dir, "documents"), keep=["doc_id"])


OP12_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""
