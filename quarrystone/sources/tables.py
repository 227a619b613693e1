"""A table by key in hash buckets, of which a batch of changes rewrites those that it touches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.session import materialize, release


class BucketTable:
    """Rows by a unique key under ``path``: ``data/_bucket=b/_version=n`` holds all rows of a bucket after batch n, and
    ``commits/batch=n`` names each bucket's version. A batch counts once its commit is written, so one that broke off leaves no
    trace, and one that is run again writes the same versions again. Versions that neither of the last two commits names are
    deleted. Choose ``buckets`` so that one fits a task; a table keeps the number that it began with.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def commits(self) -> list[int]:
        """Numbers of the commits that are still there."""
        fs, at = self._fs(f"{self.path}/commits")
        return sorted(int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(at) if fs.exists(self._fs(f"{s.getPath()}/_SUCCESS")[1])) if fs.exists(at) else []

    def versions(self, batch: int) -> dict[int, int]:
        """Each bucket's version after ``batch``: as many numbers as there are buckets."""
        return {r._bucket: r._version for r in self.spark.read.schema("_bucket int, _version long").parquet(f"{self.path}/commits/batch={batch}").collect()}

    def _read(self, versions: dict[int, int]) -> DataFrame | None:
        paths = [f"{self.path}/data/_bucket={b}/_version={v}" for b, v in sorted(versions.items())]
        return self.spark.read.option("mergeSchema", "true").option("basePath", f"{self.path}/data").parquet(*paths).drop("_bucket", "_version") if paths else None

    def read(self) -> DataFrame:
        """The rows after the last commit."""
        rows = self._read(self.versions(self.commits()[-1]))
        if rows is None:
            raise ValueError(f"no row has been written to {self.path}")
        return rows

    def merge(self, rows: DataFrame, batch: int, wins: str = "new", order: list[str] | None = None) -> None:
        """Insert or replace by key (``wins="new"``), or insert only keys that are not there (``"old"``).

        ``batch`` numbers rise; a number again, with the same rows, gives the same table again. Of rows of one batch with one key the
        last by ``order`` (all columns by default) wins, or with ``"old"`` the first. Rows without a key are left out.
        """
        before = [n for n in self.commits() if n < batch]
        held = self.versions(before[-1]) if before else {}
        best = F.max_by if wins == "new" else F.min_by
        rows = rows.where(F.col(self.key).isNotNull()).groupBy(F.col(self.key).alias("_key")).agg(best(F.struct("*"), F.struct(*(order or rows.columns))).alias("_r")).select("_r.*")
        rows = materialize(rows.withColumn("_bucket", F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")))
        touched = [r._bucket for r in rows.select("_bucket").distinct().collect()]
        fresh, there = rows, self._read({b: v for b, v in held.items() if b in touched})
        if there is not None:
            there = there.withColumn("_bucket", F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"))
            kept, added = (there.join(rows.select(self.key), self.key, "left_anti"), rows) if wins == "new" else (there, rows.join(there.select(self.key), self.key, "left_anti"))
            fresh = kept.unionByName(added, allowMissingColumns=True)
        fresh = fresh.withColumn("_version", F.lit(batch).cast("long")).repartition(max(len(touched), 1), "_bucket")
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket", "_version").parquet(f"{self.path}/data")
        now = held | dict.fromkeys(touched, batch)
        self.spark.createDataFrame(sorted(now.items()), "_bucket int, _version long").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/batch={batch}")
        release(rows)
        self._forget(before)

    def _forget(self, before: list[int]) -> None:
        """Delete what only commits before the last two need."""
        for old, later in zip(before[:-1], before[1:], strict=False):
            named = self.versions(later)
            for b, v in self.versions(old).items():
                if named.get(b) != v:
                    fs, at = self._fs(f"{self.path}/data/_bucket={b}/_version={v}")
                    fs.delete(at, True)
            fs, at = self._fs(f"{self.path}/commits/batch={old}")
            fs.delete(at, True)
