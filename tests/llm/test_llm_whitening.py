"""Whitening against plain numpy over lists."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrystone.llm import whitening

TYPES = "vec_id long, embedding array<float>, label int"


def expected(rows, k=4, scale=256, weights="one"):
    """(id, component) -> (n, deviation, |whitened|, explained), by definition."""
    valid = [(i, tuple(math.floor(scale * c) for c in v)) for i, v, *_ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    vectors = sorted({x for _, x in valid})
    w = [1 if weights == "one" else sum(x == y for _, y in valid) for x in vectors]
    n, d = sum(w), len(vectors[0])
    sums = [sum(a * x[j] for a, x in zip(w, vectors, strict=True)) for j in range(d)]
    mean = np.array([s / n for s in sums])
    cov = sum(a * np.outer(np.array(x) - mean, np.array(x) - mean) for a, x in zip(w, vectors, strict=True)) / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    return {(i, c + 1): (n, sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)), abs((np.array(x) - mean) @ v[:, c] / math.sqrt(e[c])), e[c] / e.sum()) for i, x in valid for c in range(k)}


def vectors(n, d=8, seed=1):
    rng = np.random.default_rng(seed)
    spread = np.linspace(0.1, 1.2, d)
    return [(i, [float(np.float32(c)) for c in rng.normal(0, spread)], i % 3) for i in range(n)]


def rows_of(n=300):
    rows = vectors(n)
    copy = rows[0][1]
    rows += [(1000 + i, copy, 0) for i in range(150)]  # a third of all rows
    rows += [(2000, [-0.0] * 8, 1), (2001, [0.0] * 8, 1), (2002, [0.0] * 8, 1), (2002, [0.0] * 8, 1)]
    return rows


BAD = [(3000, None, 1), (3001, [None] + [0.1] * 7, 1), (3002, [float("nan")] * 8, 1), (3003, [float("inf")] + [0.0] * 7, 1), (3004, [], 1), (3005, [0.5] * 3, 1), (3006, [1e30] + [0.0] * 7, 1)]


@pytest.mark.parametrize("weights", ["one", "count"])
def test_matches_numpy(spark, weights):
    rows = rows_of()
    df = spark.createDataFrame(rows + BAD, TYPES).withColumns({"N": F.lit("clash"), "x": F.lit("mine"), "_doc": F.lit("also")})
    got = whitening.whiten(df, weights=weights).collect()
    want = expected(rows, weights=weights)
    assert {(r.vec_id, r.component) for r in got} == set(want) and len(got) == 4 * len(rows)
    for r in got:
        n, deviation, z, share = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation) and r.x == "mine" and r["_doc"] == "also"
        assert abs(abs(r.whitened) - z) < 1e-9 * max(1, z) and abs(r.explained - share) < 1e-9 and 0 <= r.identity_error < 1e-9
    signs = {(r.component, r.vec_id): r.whitened for r in got}
    assert {r.vec_id for r in got if r.component == 1 and signs[1, r.vec_id] == signs[1, 0]} >= {0, *range(1000, 1150)}


def test_whitened_covariance_is_the_identity(spark):
    got = whitening.whiten(spark.createDataFrame(vectors(200), TYPES), keep=["vec_id"]).collect()
    z = np.array([[r.whitened for r in sorted(got, key=lambda r: (r.vec_id, r.component)) if r.vec_id == i] for i in range(200)])
    assert np.abs(np.cov(z.T, bias=True) - np.eye(4)).max() < 1e-9


def test_degenerate_tables(spark):
    frame = lambda rows: spark.createDataFrame(rows, TYPES)
    assert whitening.whiten(frame([])).count() == 0 and whitening.whiten(frame(BAD[:5])).count() == 0
    one = whitening.whiten(frame([(1, [0.5, 0.25], 0), (2, [0.5, 0.25], 0)])).collect()
    assert len(one) == 4 and all(r.whitened is None and r.explained == 0 and r.deviation == 0 and r.n == 1 and r.identity_error is None for r in one)
    line = whitening.whiten(frame([(i, [0.5 * i, 1.0 * i, 0.0], 0) for i in range(5)])).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in line) and len(line) == 15
    assert max(r.identity_error for r in line) < 1e-9
    huge = whitening.whiten(frame([(1, [1e16, 0.0], 0), (2, [0.0, 1.0], 0)])).collect()
    assert {r.deviation for r in huge} == {None}


def test_equal_frequent_lengths(spark):
    got = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [3.0, 1.0], 0), (3, [1.0, 2.0, 3.0], 0), (4, [0.0, 2.0, 1.0], 0)], TYPES)).collect()
    assert {r.vec_id for r in got} == {3, 4}


def test_query_takes_all_rows(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = whitening.op13_whitening(spark, sf).collect()
    want = expected(rows)
    assert {(r.vec_id, r.component): (r.n, r.deviation) for r in got} == {k: v[:2] for k, v in want.items()}
    assert all(abs(abs(r.whitened) - want[r.vec_id, r.component][2]) < 1e-6 for r in got)
