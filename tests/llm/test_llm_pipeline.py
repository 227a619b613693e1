"""The pipeline and the registered queries against their SQL, on a small table."""

import random

import duckdb
import pytest

import corpus_pipeline
from quarrystone.llm import neardup, registry


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdeft") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(21)
    bench = [(i, prose(rng, rng.randint(12, 30))) for i in range(6)]
    rows = []
    for i in range(90):
        t = prose(rng, rng.randint(55, 90))
        if i % 10 == 1:
            t += " " + bench[i % 6][1]
        if i % 10 == 2 and rows:
            t = rows[i // 2][1]
        if i % 10 == 3:
            t += " ###$$$" * 40
        if i % 10 == 4:
            t += "\nReleased under the MIT license."
        rows.append((i, t, rng.choice(["en", "de"]), rng.choice(["a", "a", "a", "b", "c"]), len(t)))
    rows.append((200, "", "en", "a", 0))
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").coalesce(1).write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def as_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, folder, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    got = registry.QUERIES[name](spark, folder)
    want = con.execute(registry.ORACLES[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    assert as_rows(got.columns, got.collect()) == as_rows(names, want.fetchall())


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontaminate", "mix", "shard"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), folder).count() == 0


def test_stages_take_odd_rows(spark, folder):
    """Null ids, texts and sources, repeated rows, a very long text, and extra columns of any name."""
    rng = random.Random(22)
    text = prose(rng, 70)
    rows = [(i, prose(rng, 70), "en", "a", 1) for i in range(12)] + [(20, text, "en", "a", 1), (20, text, "en", "a", 1), (None, prose(rng, 80), None, None, None), (None, None, None, None, None), (21, " ".join(f"w{i}" for i in range(30_000)), "en", "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "'x' as epoch", "'y' as _doc", "'z' as KEPT")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == columns, name
        assert {(r.epoch, r._doc, r.KEPT) for r in docs.collect()} == {("x", "y", "z")}
    left = {r.doc_id for r in docs.collect()}
    assert left == {*range(12), 20, None, 21} and docs.where("text is null").count() == 0
    out = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert len(out) == docs.count() and len({(r.shard, r.slot) for r in out}) == len(out)


def test_near_duplicates_of_eighty_percent_go(spark, folder):
    """The stage takes 0.8; the registered query keeps what its contract says."""
    words = [f"w{i}" for i in range(104)]
    near = [*words[:93], "other", *words[94:]]
    near[40] = "changed"
    rows = [(1, " ".join(words), "en", "a", 1), (2, " ".join(near), "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    sets = [{tuple(w[i : i + 5]) for i in range(100)} for w in (words, near)]
    share = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
    assert 0.8 <= share < 0.85
    assert [r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, folder).collect()] == [1]
    assert neardup.near_duplicates(docs, percent=neardup.QUERY_PERCENT).where("kept").count() == 2
    assert (neardup.least_matches(80), neardup.least_matches(85), neardup.least_matches(100)) == (35, 40, 64)
