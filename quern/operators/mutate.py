"""Storage changes as table rewrites: upsert, increment, change log, migration (inventory M)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, keys: list[str], fill_only: bool = False) -> DataFrame:
    """Rows of ``new`` replace those of ``old`` with the same key, or only fill their NULLs. Keys are unique in each."""
    o = old.select(*keys, F.struct(*[c for c in old.columns if c not in keys]).alias("_o"))
    n = new.select(*keys, F.struct(*[c for c in old.columns if c not in keys]).alias("_n"))
    j = o.join(n, keys, "full")
    pick = (lambda c: F.coalesce(F.col(f"_o.{c}"), F.col(f"_n.{c}"))) if fill_only else (lambda c: F.when(F.col("_n").isNotNull(), F.col(f"_n.{c}")).otherwise(F.col(f"_o.{c}")))
    return j.select(*keys, *[pick(c).alias(c) for c in old.columns if c not in keys])


def increment(old: DataFrame, new: DataFrame, key: str, count: str) -> DataFrame:
    """M5: counts added by key, new keys inserted."""
    return old.select(key, count).unionByName(new.select(key, count)).groupBy(key).agg(F.sum(count).alias(count))


def changes(old: DataFrame, new: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """M7: ``key, field, old_value, new_value`` for every value that differs, NULL included."""
    j = old.select(key, *[F.col(c).alias(f"o_{c}") for c in cols]).join(new.select(key, *[F.col(c).alias(f"n_{c}") for c in cols]), key)
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"o_{c}").cast("string").alias("old_value"), F.col(f"n_{c}").cast("string").alias("new_value")) for c in cols]))
    return j.select(key, each.alias("x")).select(key, "x.*").where(~F.col("old_value").eqNullSafe(F.col("new_value")))


def children(df: DataFrame, key: str, col: str) -> DataFrame:
    """M6: ``key, pos, item`` for each element of an array, positions from 1."""
    return df.select(key, F.posexplode(col).alias("p", "item")).select(key, (F.col("p") + 1).cast("bigint").alias("pos"), "item")


def add_missing(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """M8: columns that aren't there yet, as NULL."""
    return reduce(lambda a, c: a if c in a.columns else a.withColumn(c, F.lit(None).cast(columns[c])), columns, df)


def rebuild(rows: DataFrame, key: str, order: list[str], widths: dict[str, int], defaults: dict[str, str]) -> DataFrame:
    """A table rebuilt from records: blank keys dropped, first per key kept, values clipped to widths, defaults filled."""
    clean = rows.where(F.trim(F.coalesce(F.col(key), F.lit(""))) != "")
    rest = [c for c in rows.columns if c != key]
    best = clean.groupBy(key).agg(F.min(F.struct(*order, F.struct(*rest).alias("r"))).alias("m"))
    out = best.select(key, "m.r.*")
    for c, n in widths.items():
        out = out.withColumn(c, F.when(F.length(c) > n, F.substring(c, 1, n)).otherwise(F.col(c)))
    for c, v in defaults.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out
