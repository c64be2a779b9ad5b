"""A pipeline of named stages, each a table that is built unless it is there."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Stage = Callable[[SparkSession, Callable[[str], DataFrame]], DataFrame]


def done(spark: SparkSession, path: str) -> bool:
    """Was the table at ``path`` committed?"""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def run_stages(spark: SparkSession, base: str, stages: dict[str, Stage], force: bool = False, only: str | None = None) -> dict[str, str]:
    """Run stages in order; each gets a function that reads an earlier stage's table. What was done with each: built, kept or skipped.

    A stage whose table was committed is kept unless ``force``; an interrupted one left no
    ``_SUCCESS`` and is built anew. A stage that raises stops the run and commits nothing.
    """
    read = lambda name: spark.read.parquet(f"{base}/{name}")
    what = {}
    for name, build in stages.items():
        if only and name != only:
            what[name] = "skipped"
        elif not force and done(spark, f"{base}/{name}"):
            what[name] = "kept"
        else:
            build(spark, read).write.mode("overwrite").parquet(f"{base}/{name}")
            what[name] = "built"
    return what
