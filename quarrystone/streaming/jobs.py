"""The online computations as Structured Streaming jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from quarrystone.operators.resolve import company_id
from quarrystone.sources.files import file_name
from quarrystone.sources.tables import BucketTable


def watch_campaigns(spark: SparkSession, folder: str, schema: StructType | str, files: int = 100) -> DataFrame:
    """Each new CSV of a folder once; the city is what stands before '_' in its name, else 'unknown'."""
    rows = spark.readStream.schema(schema).option("header", True).option("maxFilesPerTrigger", files).csv(folder)
    city = F.nullif(F.regexp_extract("file", "^(.+?)_", 1), F.lit(""))
    return rows.withColumn("file", file_name()).withColumn("file_city", F.coalesce(city, F.lit("unknown")))


def read_ledger_stream(spark: SparkSession, folder: str, schema: str, files: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).json(folder)


def ledger_health_stream(ledger: DataFrame, window: str = "300 seconds", slide: str = "30 seconds", late: str = "1 minute") -> DataFrame:
    """Calls, error rate, mean and approximate 95th percentile duration, and cost over a sliding window. In append mode Spark leaves
    out a call whose window was over by the watermark of the batch before its own; until then it counts, late or not."""
    rows = ledger.withWatermark("ts", late).groupBy(F.window("ts", window, slide))
    out = rows.agg(
        F.count("*").alias("total_calls"), F.count_if(~F.col("success")).alias("errors"), F.sum("duration_ms").alias("duration_ms"), F.percentile_approx("duration_ms", 0.95, 1000).alias("p95_approx_ms"),
        F.sum("cost_eur").alias("cost_eur"), F.count_if("cache_hit").alias("cache_hits"), F.approx_count_distinct("company_id").alias("companies"),
    )
    return out.select(
        F.col("window.start").alias("window_start"), "total_calls", (F.col("errors") / F.col("total_calls")).alias("error_rate"), (F.col("duration_ms") / F.col("total_calls")).alias("avg_duration_ms"), "p95_approx_ms", "cost_eur",
        (F.col("cache_hits") / F.col("total_calls")).alias("cache_hit_rate"), (F.col("cost_eur") / F.col("companies")).alias("cost_per_company"),
    )


def block_counts_stream(blocks: DataFrame, hot: int = 5, tumbling: str | None = None, late: str = "1 minute") -> DataFrame:
    """Blocks per domain and type, so far or per tumbling window; hot from ``hot`` on."""
    rows = blocks.where("block_type <> 'NONE'")
    keys = ["domain", "block_type"]
    if tumbling:
        rows = rows.withWatermark("ts", late)
        out = rows.groupBy(F.window("ts", tumbling), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), *keys, "n")
    else:
        out = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    return out.withColumn("hot", F.col("n") >= hot)


def dedup_ttl(events: DataFrame, key: str, seconds: float, late: str = "1 minute") -> DataFrame:
    """Events that come first or ``seconds`` after the last one let through of their key, by event time."""
    return cooldown_stream(events, key, seconds, late).where("approved").drop("approved")


def cooldown_stream(events: DataFrame, key: str, seconds: float, late: str = "1 minute") -> DataFrame:
    """(key, event_id, ts, approved): approved if the key's last approved event lies ``seconds`` back. Events behind the watermark
    (``late`` behind the latest time of the batches before) are left out and change nothing; ``late_counts_stream`` counts
    them. State: one time per key, dropped when it can no longer matter."""
    kind = events.schema[key].dataType.simpleString()

    def fold(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get[0] if state.exists else None
        rows = pd.concat(list(batches)).sort_values(["ts", "event_id"])
        rows = rows[rows["ts"] >= pd.Timestamp(state.getCurrentWatermarkMs(), unit="ms")]  # Spark's own filter is a batch behind
        if rows.empty:
            return
        taken = []
        for ts in rows["ts"]:
            now = ts.timestamp()
            fresh = last is None or now - last >= seconds
            last = now if fresh else last
            taken.append(fresh)
        state.update((last,))
        state.setTimeoutTimestamp(max(int((last + seconds) * 1000), state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({key: [group[0]] * len(rows), "event_id": rows["event_id"].to_numpy(), "ts": rows["ts"].to_numpy(), "approved": taken})

    rows = events.withWatermark("ts", late).select(key, "event_id", "ts")
    return rows.groupBy(key).applyInPandasWithState(fold, f"{key} {kind}, event_id long, ts timestamp, approved boolean", "last double", "append", GroupStateTimeout.EventTimeTimeout)


def late_counts_stream(events: DataFrame, key: str, late: str = "1 minute") -> DataFrame:
    """(key, rows, late): after each batch, the keys it held with all their rows so far and how many came behind the watermark. Over
    the same batches these are the events that ``cooldown_stream`` and ``dedup_ttl`` leave out for their ``late``, and of those that
    a windowed aggregation in append mode is given, the ones that may come too late for their window. State: two numbers per
    key."""
    kind = events.schema[key].dataType.simpleString()

    def fold(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (n, behind), mark = state.get if state.exists else (0, 0), pd.Timestamp(state.getCurrentWatermarkMs(), unit="ms")
        for batch in batches:
            n, behind = n + len(batch), behind + int((batch["ts"] < mark).sum())
        state.update((n, behind))
        yield pd.DataFrame({key: [group[0]], "rows": [n], "late": [behind]})

    rows = events.withWatermark("ts", late).select(key, "ts")
    return rows.groupBy(key).applyInPandasWithState(fold, f"{key} {kind}, rows long, late long", "n long, late long", "append", GroupStateTimeout.NoTimeout)


def breaker_stream(health: DataFrame, cost: float = 0.04, errors: float = 0.25, hold_s: float = 600) -> DataFrame:
    """(run_id, window_start, open): the circuit breaker over health windows; state: the time of opening, per run."""

    def fold(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        since = state.get[0] if state.exists else None
        rows, out = pd.concat(list(batches)).sort_values("window_start"), []
        for ts, c, e in zip(rows["window_start"], rows["cost_per_company"], rows["error_rate"], strict=True):
            bad = c > cost or e > errors
            if since is None and bad:
                since = ts.timestamp()
            elif since is not None and not bad and ts.timestamp() - since >= hold_s:
                since = None
            out.append(since is not None)
        state.update((since,))
        yield pd.DataFrame({"run_id": [group[0]] * len(rows), "window_start": rows["window_start"].to_numpy(), "open": out})

    rows = health.select("run_id", "window_start", "cost_per_company", "error_rate")
    return rows.groupBy("run_id").applyInPandasWithState(fold, "run_id string, window_start timestamp, open boolean", "since double", "append", GroupStateTimeout.NoTimeout)


def campaign_stream(rows: DataFrame) -> DataFrame:
    """Rows of new campaigns with trimmed fields and their company id; rows without a name are dropped."""
    text = [f.name for f in rows.schema.fields if f.dataType.simpleString() == "string"]
    clean = rows.withColumns({c: F.nullif(F.trim(c), F.lit("")) for c in text}).where("company_name is not null")
    if "company_id" not in rows.columns:
        clean = clean.withColumn("company_id", F.lit(None).cast("string"))
    return clean.withColumn("company_id", company_id())


def upsert_stream(rows: DataFrame, path: str, checkpoint: str, key: str = "company_id", wins: str = "old", buckets: int = 64) -> None:
    """Merge each batch of a stream into the ``BucketTable`` at ``path``: keys that are there stay as first seen (``wins="old"``) or are
    replaced (``"new"``). The table itself is what has been seen, so the stream keeps no state; only touched buckets are rewritten,
    and a batch that is run again changes nothing."""
    table = BucketTable(rows.sparkSession, path, key, buckets)
    save: Callable = lambda batch, n: table.merge(batch, n, wins)
    rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(save).start().awaitTermination()


def upserted(spark: SparkSession, path: str, key: str = "company_id") -> DataFrame:
    """The rows of ``upsert_stream``."""
    return BucketTable(spark, path, key).read()


def running_totals_stream(log: DataFrame, key: str = "provider") -> DataFrame:
    return log.groupBy(key).agg(F.count("*").alias("processed"), F.count_if("success").alias("found"), F.avg(F.col("success").cast("int")).alias("yield"))


def failure_runs_stream(log: DataFrame, key: str = "provider") -> DataFrame:
    """(key, processed, consecutive_failures) after each batch: failures in a row at the log's end so far, in the order of ts and
    event_id. State: two numbers per key."""
    kind = log.schema[key].dataType.simpleString()

    def fold(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, failed = state.get if state.exists else (0, 0)
        rows = pd.concat(list(batches)).sort_values(["ts", "event_id"])
        good = rows["success"].to_numpy().nonzero()[0]
        failed = len(rows) - 1 - int(good[-1]) if len(good) else failed + len(rows)
        state.update((n + len(rows), failed))
        yield pd.DataFrame({key: [group[0]], "processed": [n + len(rows)], "consecutive_failures": [failed]})

    rows = log.select(key, "ts", "event_id", "success")
    return rows.groupBy(key).applyInPandasWithState(fold, f"{key} {kind}, processed long, consecutive_failures long", "n long, failed long", "append", GroupStateTimeout.NoTimeout)


def drain(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Run a stream over what has arrived, into Parquet (append) or its last state (complete), and read the result."""
    spark = stream.sparkSession
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        query = writer.format("parquet").option("path", path).start()
    else:
        save: Callable = lambda df, _: df.write.mode("overwrite").parquet(path)
        query = writer.foreachBatch(save).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
