"""Writers and manifests (inventory B). Every writer overwrites a directory as a whole."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """UTF-8 JSON lines, one folder per partition value if wanted."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).json(path)


def write_texts(df: DataFrame, path: str, text: F.Column) -> None:
    """B2: rendered texts as ``{"text": ...}`` lines."""
    write_jsonl(df.select(text.alias("text")), path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet; the old folder is replaced only when the job commits."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """B4, B7."""
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def append_once(new: DataFrame, path: str, key: str, order: list[str]) -> int:
    """Rows whose key the table at ``path`` lacks are appended, of equal keys the first by ``order``; how many.

    What is appended is computed once: the rows are written with the number of their run, and counted where they stand.
    """
    spark = new.sparkSession
    rest = [c for c in new.columns if c != key]
    first = new.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*order, F.struct(*rest).alias("_r"))).alias("_m")).select(key, "_m._r.*")
    run = 0
    try:
        old = spark.read.parquet(path)
        run = old.agg(F.max("_run")).first()[0] + 1
        first = first.join(old.select(key), key, "left_anti")
    except Exception as e:  # noqa: BLE001 - the table isn't there yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
    first.withColumn("_run", F.lit(run)).write.mode("append").parquet(path)
    return spark.read.parquet(path).where(F.col("_run") == run).count()


def manifest(df: DataFrame, before: DataFrame, split_col: str) -> DataFrame:
    """One row: rows before, kept, removed share and the size of each split as JSON."""
    splits = df.groupBy(F.col(split_col).cast("string").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    parts = splits.select("k", "n", F.lit(0).cast("bigint").alias("t")).unionAll(before.agg(F.lit(None).cast("string").alias("k"), F.lit(None).cast("bigint").alias("n"), F.count(F.lit(1)).alias("t")))
    # one row per split and one for all
    named = F.filter(F.sort_array(F.collect_list(F.struct("k", "n"))), lambda x: x["k"].isNotNull())
    one = parts.agg(F.sum("t").alias("total"), F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("kept"), F.to_json(F.map_from_entries(named)).alias("splits"))
    return one.select("total", "kept", F.when(F.col("total") > 0, F.round(100.0 * (F.col("total") - F.col("kept")) / F.col("total"), 2)).alias("removed_pct"), "splits")


def statistics(df: DataFrame, text_col: str, by: str) -> DataFrame:
    """Rows, characters, estimated tokens and lengths per value of ``by``."""
    n = F.length(text_col)
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), F.sum(n).alias("chars"), F.sum(F.floor(n / 3)).alias("tokens"), F.round(F.avg(n), 6).alias("mean_chars"), F.min(n).alias("shortest"), F.max(n).alias("longest")
    )


def translation_lists(df: DataFrame, word: str, meaning: str, k: int = 4) -> DataFrame:
    """Each word with its first ``k`` meanings, joined by `` | ``."""
    m = df.where(F.col(meaning).isNotNull()).groupBy(word).agg(F.sort_array(F.collect_set(meaning)).alias("m"))
    return m.select(word, F.array_join(F.slice("m", 1, k), " | ").alias("meanings"))


def card(name: str, licence: str, tags: list[str], rows: int) -> str:
    """A dataset card with front matter (its upload is out of scope)."""
    head = "\n".join(["---", f"pretty_name: {name}", f"license: {licence}", "tags:", *[f"- {t}" for t in tags], "---"])
    return f"{head}\n\n# {name}\n\n{rows} rows.\n"


def registry_json(datasets: dict[str, dict]) -> str:
    """A registry of datasets, with the fields that each must have checked."""
    for n, d in datasets.items():
        if missing := {"path", "licence", "tags"} - d.keys():
            raise ValueError(f"{n} lacks {sorted(missing)}")
    return json.dumps(datasets, ensure_ascii=False, sort_keys=True)


def formula_sheet(df: DataFrame, order: str, cols: list[str], prompts: dict[str, str]) -> DataFrame:
    """Rows numbered in ``order`` with one generated formula per prompt that refers to its own row.

    A sheet is small by nature; its numbering is one global window over the rows given.
    """
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy().orderBy(order)) + 1
    d = df.select(*cols, n.alias("_n"))
    return d.select(*cols, *[F.format_string(f'=AI("{p}", A%d)', "_n").alias(k) for k, p in prompts.items()])
