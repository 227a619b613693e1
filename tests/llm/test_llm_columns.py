"""Columns of the caller that are named like anything inside, whole long texts, and nulls, through every operator with a default ``keep``."""

import random

import pytest
from pyspark.sql import functions as F

from quarrystone.llm import crosstok, decontam, exactdup, licenses, lmscore, mixing, neardup, quality, sharding, suffixdup, urls, warc

INSIDE = ["_doc", "_s", "_h", "_id", "_cell", "_r", "_rank", "_band", "_p", "_at", "_below", "_of", "_b", "_copy", "_copies", "_w", "_c", "_l", "_u", "_v", "_t", "_k", "_row", "_n", "_text", "_key", "_codes", "_rest", "_pass", "_alone", "b", "w", "i", "n", "p", "c0", "placed", "phrases", "there", "node", "h", "ord", "first", "range", "offset", "level", "start", "a.b"]
LONG = "zu " * 3 + " ".join(f"wort{i}" for i in range(60_000))
ROWS = [(1, "eins zwei drei vier fünf sechs " * 3, "de", "a"), (2, None, None, None), (2, None, None, None), (3, "", "de", "a"), (None, LONG, "de", "b"), (4, LONG + " ende", "de", "b"), (5, "Licensed under the Apache License, Version 2.0", "en", "a")]


@pytest.fixture(scope="module")
def table(spark):
    d = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    return d.select("*", *[F.lit(f"<{x}>").alias(x) for x in INSIDE])


def bench(spark):
    return spark.createDataFrame([(1, "eins zwei drei vier fünf sechs eins zwei"), (None, None), (2, "")], "item_id long, text string")


OPERATORS = {
    "quality": (lambda s, d: quality.quality_scores(d), "N_Words", 7),
    "quality_filter": (lambda s, d: quality.quality_filter(d), None, 2),
    "decontaminate": (lambda s, d: decontam.decontaminate(d, bench(s)), "Items", 7),
    "drop_contaminated": (lambda s, d: decontam.drop_contaminated(d, bench(s)), None, 6),
    "drop_near_duplicates": (lambda s, d: neardup.drop_near_duplicates(d), None, 6),
    "sharding": (lambda s, d: sharding.interleave_shards(d, n_shards=3), "Slot", 7),
    "sharding_repeats": (lambda s, d: sharding.interleave_shards(d, n_shards=3, repeats=True), "SHARD", 7),
    "mixing": (lambda s, d: mixing.mix_sources(d, max_repetition=1.0), "Epoch", 7),
    "mixing_plain": (lambda s, d: mixing.mix_sources(d, max_repetition=1.0, epochs=False), None, 7),
    "licenses": (lambda s, d: licenses.scan_licenses(d), "Score", 7),
    "scores": (lambda s, d: lmscore.score_documents(d), "Log_Prob", 7),
    "tokens": (lambda s, d: crosstok.align_tokenizers(d), "N_Links", 7),
    "exact": (lambda s, d: exactdup.mark_exact_duplicates(d), "Keep_Id", 7),
    "drop_exact": (lambda s, d: exactdup.drop_exact_duplicates(d), None, 5),
    "urls": (lambda s, d: urls.filter_urls(d, url_col="text"), "HOST", 7),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_columns_come_through(spark, table, name):
    run, clash, n = OPERATORS[name]
    d = table.withColumn(clash, F.lit("clash")) if clash else table
    out = run(spark, d)
    assert all(c in out.columns for c in table.columns)
    assert not clash or [c for c in out.columns if c.lower() == clash.lower()] != [clash]
    rows = out.collect()
    assert len(rows) == n
    assert all(r[x] == f"<{x}>" for r in rows for x in INSIDE)
    assert {(r.doc_id, r.text) for r in rows} <= {r[:2] for r in ROWS}


def test_operators_of_fixed_columns(spark, table, tmp_path):
    assert neardup.near_duplicates(table).count() == len(ROWS)
    got = {r.doc_id: r for r in suffixdup.cut_repeats(table).collect()}
    assert got[4].n_removed == 0 and got[None].n_removed == len(LONG.encode()) and got[2].n_bytes == 0
    pages = table.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html"), *[F.col(f"`{x}`") for x in INSIDE])
    folder = f"file://{tmp_path}/w"
    assert sum(m.records for m in warc.write_archives(pages, folder).collect()) == len(ROWS) and warc.read_archives(spark, folder).count() == len(ROWS)


def test_budget_and_entropy(spark):
    """A budget in words is met to within half a block per source; an entropy gives the exponent that has it."""
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(5, 15), "en", s) for i, s in enumerate(["x"] * 900 + ["y"] * 300 + ["z"] * 60)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    words = {r[0]: len(r[1].split()) for r in rows}
    got = mixing.mix_sources(d, target_entropy=1.05, budget=6000, blocks=64, keep=["doc_id", "source"]).collect()
    total = {s: sum(words[r.doc_id] for r in got if r.source == s) for s in "xyz"}
    import math

    share = [t / sum(total.values()) for t in total.values()]
    assert abs(sum(total.values()) - 6000) < 400 and abs(-sum(p * math.log(p) for p in share) - 1.05) < 0.03
    assert max(r.epoch for r in got if r.source == "z") >= 1 and {r.epoch for r in got if r.source == "x"} == {0}
