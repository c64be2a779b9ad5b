"""Incremental processing (inventory O). The reference only loops over batches; these streams extend it.

Sources are file streams; every query has its checkpoint and output in the folder that all executors
share, and ``run`` works off what is there and stops, so the same code serves a live stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.session import scratch


def file_stream(spark: SparkSession, path: str, files_per_trigger: int = 4) -> DataFrame:
    """A stream of the Parquet files at ``path`` (a file, a folder or a glob)."""
    schema = spark.read.parquet(path).schema
    df = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(f"{path}*")
    # event time must be an instant; times without a zone are read in the session's
    return df.withColumns({c: F.col(c).cast("timestamp") for c, kind in df.dtypes if kind == "timestamp_ntz"})


def window_counts(events: DataFrame, time: str, key: str, value: str, size: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Tumbling windows of event time with a watermark: ``window_start, key, n, total``."""
    w = events.withWatermark(time, late).groupBy(F.window(time, size), key)
    return w.agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(F.col("window.start").alias("window_start"), key, "n", "total")


def session_counts(events: DataFrame, time: str, key: str, gap: str = "6 hours", late: str = "1 day") -> DataFrame:
    """Session windows by gap: ``key, session_start, n``."""
    s = events.withWatermark(time, late).groupBy(key, F.session_window(time, gap).alias("s"))
    return s.agg(F.count(F.lit(1)).alias("n")).select(key, F.col("s.start").alias("session_start"), "n")


def first_seen(events: DataFrame, key: str, time: str, late: str = "1 day") -> DataFrame:
    """Each key once; state is dropped behind the watermark."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def running_count(events: DataFrame, key: str, good: F.Column) -> DataFrame:
    """The number of good events of each key so far: ``key, n_correct``; for update mode."""
    return events.groupBy(F.col(key).cast("bigint").alias("key")).agg(F.count_if(F.coalesce(good, F.lit(False))).alias("n_correct"))


def run(stream: DataFrame, mode: str = "append", key: list[str] | None = None, order: str | None = None) -> DataFrame:
    """O2: work off what is there, resumably, into a table, and read it back.

    In ``complete`` mode the last result replaces the table; in ``update`` mode batches are appended
    with their number, and for each ``key`` the row of the last batch counts.
    """
    spark = stream.sparkSession
    base = scratch(spark)
    out = f"{base}/out"

    def write(df: DataFrame, batch: int) -> None:
        if mode == "complete":
            df.write.mode("overwrite").parquet(out)
        else:
            df.withColumn("_batch", F.lit(batch)).write.mode("overwrite").parquet(f"{out}/_b={batch}")

    q = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    done = spark.read.parquet(out)
    if mode == "complete":
        return done
    done = done.drop("_b")
    if mode == "update" and key:
        rest = [c for c in done.columns if c not in key]
        last = done.groupBy(*key).agg(F.max(F.struct("_batch", *[c for c in rest if c != "_batch"])).alias("m"))
        return last.select(*key, *[F.col(f"m.{c}").alias(c) for c in rest if c != "_batch"])
    return done.drop("_batch")
