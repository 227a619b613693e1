"""Registered queries against their SQL on the smallest tables, and the entry module without the optional parts."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from quarrystone.plans import queries

DATA = "/root/testdata/sf0.001"
REPO = Path(__file__).resolve().parent.parent
TABLES = "region nation customer supplier part orders lineitem events documents pages".split()
CHOSEN = ["names", "contacts", "urls", "classify_blocks", "lead_scores", "consolidate_campaigns", "merge_by_trust", "dedup_cascade", "fuzzy_dedup", "phone_frequency", "decide", "waterfall", "registry_lookup", "health_snapshot", "block_profile", "search_frontier", "query_forms", "reason_codes", "provinces", "clean_inputs", "match_phones", "profile_and_balance", "union_candidates", "cooldown", "circuit_breaker", "running_totals", "sql_functions", "sql_guesses", "stream_running_totals", "stream_failure_runs", "stream_campaigns", "stream_cooldown", "stream_breaker", "stream_ledger", "registry_fuzzy", "sql_candidates", "upsert_table", "stream_late_counts", "stream_cooldown_late", "campaign_dir", "search_json", "figures", "content_checks", "extract_contacts", "by_province", "results_csv", "exported_leads", "serp_rows", "listing_rows", "labelled_fields", "best_listing", "distinct_rollup", "many_headers", "csv_round_trip", "province_flags", "match_category", "sector_suffixes"]


def as_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(round(float(r[i]), 6) if isinstance(r[i], float) else r[i] for i in order) for r in rows), key=str)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got = queries.QUERIES[name](spark, DATA)
    want = con.execute(queries.ORACLES[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    assert as_rows(got.columns, got.collect()) == as_rows(names, want.fetchall())


#: Columns that have one value by what the query is: rows of one kind, totals, a constant of the input.
SINGLE = {("already_enriched", "status"), ("by_province", "n"), ("exported_segments", "n"), ("health_snapshot", "providers_unhealthy"), ("unify_campaigns", "country"), *(("distinct_rollup", c) for c in ("events_within", "companies_within", "companies")), *(("listing_rows", c) for c in ("place", "city", "province"))}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_no_query_is_hollow():
    """Each query gives rows, and each of its columns takes several values on the given tables (tables of one row aside)."""
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.01/{t}.parquet'")
    flat = {}
    for name, sql in queries.ORACLES.items():
        found = con.execute(sql)
        columns, rows = [c[0] for c in found.description], found.fetchall()
        assert rows, name
        if len(rows) > 1:
            flat |= {(name, c): 1 for i, c in enumerate(columns) if len({str(r[i]) for r in rows}) == 1}
    assert set(flat) <= SINGLE, sorted(set(flat) - SINGLE)


@pytest.mark.parametrize("gone", [("llm",), ("llm", "corpus_pipeline.py")], ids=["llm", "llm and pipeline"])
def test_entry_without_optional_parts(tmp_path, gone):
    shutil.copytree(REPO, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "__pycache__", *gone))
    code = "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), 'consolidate_campaigns' in e.oracle_sql())"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(tmp_path / "r")})
    assert out.returncode == 0, out.stderr
    count, has_pipeline, has_core = out.stdout.split()
    assert int(count) > 60 and has_pipeline == "False" and has_core == "True"


@pytest.mark.parametrize("name", ["content_checks", "extract_contacts", "figures", "page_predicates"])
def test_query_equals_sql_on_long_texts(spark, tmp_path, name):
    """Texts of each kind of imprint, up to lengths whose products with its numbers take more than 32 bits."""
    texts = [None, "", *("Azienda è il 2021 " * k + "x" * i for k in (1, 1200, 16_000) for i in range(6))]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = queries.QUERIES[name](spark, str(tmp_path))
    want = con.execute(queries.ORACLES[name])
    names = [c[0] for c in want.description]
    assert as_rows(got.columns, got.collect()) == as_rows(names, want.fetchall())


@pytest.mark.parametrize(("name", "files"), [("stream_health_late", 1), ("stream_health_late", 8), ("stream_cooldown_late", 8)])
def test_streams_equal_sql_however_the_log_is_split(spark, tmp_path, name, files):
    """A log in order of time in files of growing size, read as one partition each, so the thirds of its span are written to unlike
    numbers of files; a call that comes late lies in the window across the first two thirds."""
    con = duckdb.connect()
    con.sql("CREATE TABLE events AS SELECT i AS event_id, TIMESTAMP '2024-01-01' + to_seconds(i * 97) AS ts, i % 5 AS user_id, CASE i % 3 WHEN 0 THEN 'error' ELSE 'view' END AS event_type, (i % 90)::DOUBLE AS value, '{}' AS props FROM range(1982) r(i)")
    (tmp_path / "events.parquet").mkdir()
    ends = [1982 * n * (n + 1) // (files * (files + 1)) for n in range(files + 1)]
    for n in range(files):
        con.sql(f"COPY (SELECT * FROM events WHERE event_id >= {ends[n]} AND event_id < {ends[n + 1]} ORDER BY event_id) TO '{tmp_path}/events.parquet/{n}.parquet' (FORMAT parquet)")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        assert spark.read.parquet(f"{tmp_path}/events.parquet").rdd.getNumPartitions() == files
        got = queries.QUERIES[name](spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = con.execute(queries.ORACLES[name])
    names = [c[0] for c in want.description]
    assert as_rows(got.columns, got.collect()) == as_rows(names, want.fetchall())
