"""Exact duplicates against plain grouping."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quarrystone.llm import exactdup
from quarrystone.llm.common import spread_join

TYPES = "doc_id long, text string, lang string"


def table_rows():
    rows = [(i, f"text number {i}", "en") for i in range(400)]
    rows += [(1000 + i, "the hot one", "de") for i in range(200)]
    rows += [(2000 + i, f"text number {i * 7}", None) for i in range(40)]
    rows += [(3000, None, "en"), (3001, "", "en"), (3002, " ", "en"), (3003, "Text number 1", "en"), (None, "text number 3", "en"), (None, "only null", "en"), (None, "only null", "fr")]
    rows += [(4000, "twice", "en"), (4000, "twice", "en"), (4001, "lang " * 100_000, "en"), (4002, "lang " * 100_000 + "x", "en"), (4003, "lang " * 100_000, "en")]
    return rows


def expected(rows):
    groups = defaultdict(list)
    for i, text, _ in rows:
        groups[text or ""].append(i)
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted((str(i), str(best[t or ""]), len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _ in rows), len(groups)


@pytest.mark.parametrize("max_cells", [exactdup.MAX_CELLS, 1], ids=["all_cells", "full_filter"])
def test_marks(spark, max_cells):
    rows = table_rows()
    df = spark.createDataFrame(rows, TYPES).withColumns({"KEPT": F.lit("clash"), "_h": F.lit("mine"), "_row": F.lit("mine")}).repartition(5)
    got = exactdup.mark_exact_duplicates(df, max_cells=max_cells).collect()
    want, groups = expected(rows)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    assert all(r["_h"] == r["_row"] == "mine" for r in got)
    kept = [r for r in got if r.kept]
    assert len(kept) == groups == len({r.text_sha256 for r in kept}) and all(r.doc_id == r.keep_id for r in kept)


def test_drop_keeps_columns(spark):
    rows = table_rows()
    df = spark.createDataFrame(rows, TYPES).withColumn("kept", F.lit("mine"))
    got = exactdup.drop_exact_duplicates(df)
    assert got.columns == df.columns and got.count() == expected(rows)[1]
    assert {r.kept for r in got.collect()} == {"mine"} and exactdup.drop_exact_duplicates(df.limit(0)).count() == 0


def test_only_possible_repeats_are_flagged(spark):
    """No repeat is missed, and of 20000 unique hashes about one in 200 is taken for one."""
    rows = spark.range(20_000).select(F.xxhash64("id").alias("h")).unionByName(spark.range(500).select(F.xxhash64("id").alias("h")))
    got = exactdup.BloomFilter(rows).flagged(rows, "h")
    repeated = rows.groupBy("h").count().where("count > 1")
    assert got.join(repeated, "h").where("not _maybe").count() == 0
    assert 1000 <= got.where("_maybe").count() <= 1000 + 300
    small = exactdup.BloomFilter(rows, max_cells=1)
    assert small.blocks == 1 and small.flagged(rows, "h").join(repeated, "h").where("not _maybe").count() == 0


def test_no_python_and_no_shuffle_for_the_rest(spark):
    df = spark.createDataFrame(table_rows(), TYPES)
    plan = exactdup.mark_exact_duplicates(df, keep=["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_spread_join_reaches_every_row(spark):
    rows = spark.range(5000).select((F.col("id") % 700 * F.when(F.col("id") < 2500, 0).otherwise(1)).alias("k"))
    groups = rows.groupBy("k").agg(F.count("*").alias("n"))
    got = spread_join(rows, groups, "k", "n")
    assert got.count() == 5000 and got.agg(F.sum("n")).first()[0] == sum(r.n * r.n for r in groups.collect())


def test_query_takes_all_rows(spark):
    got = exactdup.op12_exact_dedup(spark, "/root/testdata/sf0.001").collect()
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == expected(rows)[0]
