"""The bucket table and late rows of streams."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quarrystone.sources.tables import BucketTable
from quarrystone.streaming import jobs

T0 = dt.datetime(2024, 1, 1)


def rows(spark, pairs):
    return spark.createDataFrame(pairs, "id string, v string")


def held(table):
    return {r.id: r.v for r in table.read().collect()}


def test_merges_rewrite_what_they_touch(spark, tmp_path):
    table = BucketTable(spark, f"file://{tmp_path}/t", "id", 32)
    all_ = [(f"k{i}", "first") for i in range(2000)]
    table.merge(rows(spark, [*all_, (None, "x")]), 0)
    assert held(table) == dict(all_)
    table.merge(rows(spark, [("k1", "new"), ("k1", "newer"), ("added", "x")]), 1)
    assert held(table) == dict(all_) | {"k1": "newer", "added": "x"}
    size = lambda n: sum(p.stat().st_size for p in Path(tmp_path, "t/data").glob(f"_bucket=*/_version={n}/*.parquet"))
    assert 0 < size(1) < size(0) / 4  # two buckets of 32
    table.merge(rows(spark, [("k1", "old loses"), ("late", "y")]), 2, wins="old")
    assert held(table) == dict(all_) | {"k1": "newer", "added": "x", "late": "y"}
    table.merge(rows(spark, []), 3)
    assert held(table)["late"] == "y" and len(table.commits()) <= 3


def test_a_batch_again_and_one_that_broke_off(spark, tmp_path, monkeypatch):
    table = BucketTable(spark, f"file://{tmp_path}/t", "id", 8)
    table.merge(rows(spark, [(f"k{i}", "0") for i in range(50)]), 0)
    first = rows(spark, [("k3", "1"), ("n", "1")])
    table.merge(first, 1)
    want = held(table)
    table.merge(first, 1)
    assert held(table) == want and table.commits() == [0, 1]
    # Data is written but no commit: readers see the table before, and the batch can run again.
    broken = BucketTable(spark, table.path, "id", 8)
    monkeypatch.setattr(broken, "spark", type("Broken", (), {"read": property(lambda _: spark.read), "_jvm": spark._jvm, "_jsc": spark._jsc})())
    with pytest.raises(AttributeError):
        broken.merge(rows(spark, [("k3", "2"), ("m", "2")]), 2)
    assert held(table) == want
    table.merge(rows(spark, [("k3", "2"), ("m", "2")]), 2)
    assert held(table) == want | {"k3": "2", "m": "2"}


def test_new_columns(spark, tmp_path):
    table = BucketTable(spark, f"file://{tmp_path}/t", "id", 4)
    table.merge(rows(spark, [("a", "1"), ("b", "1")]), 0)
    table.merge(rows(spark, [("b", "2"), ("c", "2")]).withColumn("w", F.lit(7)), 1)
    assert {(r.id, r.v, r.w) for r in table.read().collect()} == {("a", "1", None), ("b", "2", 7), ("c", "2", 7)}


def test_late_rows_are_counted_and_change_nothing(spark, tmp_path):
    at = lambda m: T0 + dt.timedelta(minutes=m)
    batches = [[("a", 1, at(0)), ("a", 2, at(20)), ("b", 3, at(1))], [("a", 4, at(5)), ("a", 5, at(45)), ("b", 6, at(18.9)), ("b", 7, at(19.5))], [("c", 8, at(2)), ("c", 9, at(90)), ("a", 10, at(44.5)), (None, 11, at(3))]]
    schema = "k string, event_id long, ts timestamp"
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    read = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    counts = jobs.drain(jobs.late_counts_stream(read(), "k"), f"{tmp_path}/o1", f"{tmp_path}/c1")
    got = {r.k: (r.n, r.late) for r in counts.groupBy("k").agg(F.max("rows").alias("n"), F.max("late").alias("late")).collect()}
    # Behind 19 minutes in the second batch (4 and 6), behind 44 in the third (8 and 11).
    assert got == {"a": (5, 1), "b": (3, 1), "c": (2, 1), None: (1, 1)}
    cool = jobs.drain(jobs.cooldown_stream(read(), "k", 1200), f"{tmp_path}/o2", f"{tmp_path}/c2").collect()
    assert {r.event_id: r.approved for r in cool} == {1: True, 2: True, 3: True, 5: True, 7: False, 9: True, 10: False}
