"""Session factory, table access and lineage cutting shared by all operators."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

LOCAL_MAP = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"


def get_session(cores: str = "*", partitions: int = 8, app: str = "quern") -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own."""
    return ship(
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config(LOCAL_MAP, "32m")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors this package, once per context, whatever their working folder and path."""
    sc = spark.sparkContext
    if getattr(sc, "_quern_shipped", None) is None:
        root = Path(__file__).resolve().parent
        zipped = Path(tempfile.mkdtemp(prefix="quern-code-")) / "quern.zip"
        with zipfile.ZipFile(zipped, "w", zipfile.ZIP_DEFLATED) as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        sc.addPyFile(str(zipped))
        sc._quern_shipped = str(zipped)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` under ``sf_dir``; columns and filters reach the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores, where a small table has fewer splits than there are cores.

    A table with as many splits as cores is left alone, so nothing large is ever shuffled by this.
    Select the needed columns first.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The given columns of a table, for work that costs CPU per row."""
    return spread(table(spark, sf_dir, name).select(*columns))


_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: the one the session names in ``spark.checkpoint.dir``.

    Only a session within one process (``local``: tests, a laptop) may leave it unset; a temporary one is set there.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="quern-shared-")
        sc.setCheckpointDir(named)
    return named


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder; what is written there goes with the :func:`scope` that it was taken in."""
    path = f"{shared_dir(spark)}/quern-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Computed once (an RDD checkpoint runs its last stage twice), columnar, and independent of the
    executors that made it: a lost one loses nothing. Removed at the end of the :func:`scope` that it is called
    in, by :func:`release` or at exit.
    """
    spark = df.sparkSession
    path = scratch(spark)
    before = spark.conf.get(LOCAL_MAP)
    # joins whose measured hash tables are small in every partition need no sort (AQE decides); set for this job alone
    spark.conf.set(LOCAL_MAP, "32m" if before in ("0", "0b") else before)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(LOCAL_MAP, before)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scope() -> Iterator[None]:
    """Owns the tables written within: ``with scope(): write(query(...))``. They are removed at its end; results must be used before."""
    before = len(_written)
    try:
        yield
    finally:
        release(before)


@atexit.register
def release(keep: int = 0) -> None:
    """Remove the tables that :func:`cut_lineage` wrote, but the first ``keep``; results that still read them can't be run again."""
    while len(_written) > keep:
        spark, path = _written.pop()
        try:
            jvm = spark.sparkContext._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # noqa: BLE001 - the session is gone, and its folder with it
            return
