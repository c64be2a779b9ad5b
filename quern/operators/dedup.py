"""Exact and key-based de-duplication and fingerprints (inventory E).

Which copy survives is stated by an order, never left to arrival. Survivors come from an aggregate
with map-side combine (``min_by``-like on a struct) joined back by key, so that a key that fills a
third of the table never has to be sorted in one task; ``first_rows`` keeps the window form for
keys known to be small (Spark plans it with a group limit before the exchange).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import text as T


def fingerprint(*cols: str) -> Column:
    """md5 over the columns as JSON, keys sorted, NULLs left out."""
    return F.md5(F.to_json(F.struct(*[F.col(c) for c in sorted(cols)])))


def text_digest(c: Column) -> Column:
    """sha256 of the squeezed text."""
    return F.sha2(T.squeeze(c), 256)


def pair_key(*cols: Column) -> Column:
    """md5 of the lower-cased columns with a delimiter that keeps them apart; NULL counts as empty."""
    return F.md5(F.concat_ws("|||", *[F.lower(F.coalesce(c, F.lit(""))) for c in cols]))


def prefix_key(c: Column, n: int = 120) -> Column:
    """E6."""
    return F.when(F.length(c) > n, F.substring(c, 1, n)).otherwise(c)


def phrase_key(c: Column) -> Column:
    """Lower case, white space squeezed."""
    return F.lower(T.squeeze(c))


def keep_first(df: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """Of rows with equal keys the first by ``order`` (unique columns); NULL keys are one group."""
    own = df.withColumn("_key", F.coalesce(F.md5(key.cast("string")), F.lit("")))
    first = own.groupBy("_key").agg(F.min(F.struct(*order)).alias("_first"))
    kept = own.join(first, "_key").where(F.struct(*order) == F.col("_first"))
    return kept.drop("_key", "_first")


def first_rows(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """H1, H5: the first ``n`` rows of each key; row_number with a group limit before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def duplicate_groups(df: DataFrame, key: Column, id_col: str) -> DataFrame:
    """``digest, n, first_id, last_id`` of keys that occur more than once."""
    g = df.groupBy(F.md5(key).alias("digest")).agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias("first_id"), F.max(id_col).alias("last_id"))
    return g.where("n > 1")


def not_in(df: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't among the existing ones; a NULL key is kept."""
    return df.join(existing.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def merge_on_key(df: DataFrame, key: Column, order: list[Column], id_col: str, fill: list[str]) -> DataFrame:
    """One row per key: the first by ``order``, its blank columns filled from the next that has a value.

    One aggregate with map-side combine: per column the smallest (order, value) among rows with a value.
    """
    rank = [o.alias(f"o{i}") for i, o in enumerate(order)]
    picks = [F.min(F.when(~T.blank(F.col(c)), F.struct(*rank, F.col(c).alias("v")))).alias(c) for c in fill]
    out = df.where(key.isNotNull()).groupBy(key.alias("key")).agg(F.min(F.struct(*rank, F.col(id_col).alias("v"))).alias("_id"), F.count(F.lit(1)).alias("n"), *picks)
    return out.select("key", F.col("_id.v").alias(id_col), "n", *[F.col(f"{c}.v").alias(c) for c in fill])


def surrogate_id(c: Column) -> Column:
    """A stable 31-bit id of a text, from md5 (no per-process hash)."""
    return F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("bigint") % (2**31)
