"""Session-level helpers: shared folders, written intermediates, table access."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors share.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset and Spark runs on this machine alone (tests,
    notebooks) a temporary folder is taken, once per session; elsewhere a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.conf.get("quarrystone.shared.dir", None)
        if not named:
            master = spark.conf.get("spark.master", "")
            if not re.fullmatch(r"local(\[[^\]]*\])?", master):
                raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master!r} share")
            named = "file://" + tempfile.mkdtemp(prefix="spark-")
            spark.conf.set("quarrystone.shared.dir", named)
    return named.rstrip("/")


def materialize(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written.written_to = path
    return written


def release(*written: DataFrame) -> None:
    """Delete the files of ``materialize``d tables that nothing will read again: what was made of them is written itself."""
    for df in written:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_if_small(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """``df``, to be broadcast if a count shows ``rows`` rows at most, else joined as it is. For narrow, written tables."""
    return F.broadcast(df) if df.count() <= rows else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
