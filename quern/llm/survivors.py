"""The best representative of each duplicate group, built field by field.

Criteria are completeness (which fields have a value, compared by inclusion), trust, and standing
(confidence, then recency, then the smaller id). A record is in dominance layer 1 if no record of its group is at least
as good in all three, in layer 2 if only ones of layer 1 are, and so on. The survivor is the first
of layer 1 by the lexicographic policy (trust, confidence, recency, smallest id); each field that
it lacks is filled from the first layer that has a value, there by the same policy.

Of the records with the same fields and the same trust only the one of highest standing can ever
be chosen, so groups are first reduced to these by an aggregate that combines on the map side:
a headword that fills a third of the table leaves a task as a handful of rows, and what a group
keeps is at most 2 ** fields x trust ranks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = 2**31 - 1


def normal_key(column: str) -> Column:
    """Case and white space ignored: trimmed, inner runs as one space, lower case."""
    return F.lower(F.trim(F.regexp_replace(F.col(column), r"[\s\p{Z}]+", " ")))


def present(column: str) -> Column:
    """The value is not missing: not NULL, blank or ``-``."""
    bare = F.regexp_replace(F.col(column).cast("string"), r"[\s\p{Z}]+", "")
    return F.coalesce(~bare.isin("", "-"), F.lit(False))


def layers(cells: Column) -> Column:
    """An array of ``trust, conf, time, id, has`` in policy order, each with its dominance ``layer`` and ``n_above``.

    Whatever dominates a record stands before it, so one pass from the front is enough. ``n_above`` is the
    number of the array's records that dominate it.
    """
    standing = lambda x: F.struct(x["conf"], x["time"], x["id"])
    better = lambda a, b: (a["has"].bitwiseAND(b["has"]) == b["has"]) & (a["trust"] <= b["trust"]) & (standing(a) <= standing(b))
    fields = ["trust", "conf", "time", "id", "has"]
    empty = F.array().cast("array<struct<trust:bigint,conf:double,time:bigint,id:bigint,has:int,layer:int,n_above:int>>")

    def add(done: Column, x: Column) -> Column:
        above = F.filter(done, lambda a: better(a, x))
        layer = F.coalesce(F.array_max(F.transform(above, lambda a: a["layer"])), F.lit(0)) + 1
        return F.array_append(done, F.struct(*[x[f].alias(f) for f in fields], layer.alias("layer"), F.size(above).alias("n_above")))

    return F.aggregate(cells, empty, add)


def skylines(
    df: DataFrame, trust: DataFrame, key: str, fields: list[str], id_col: str = "id", file_col: str = "source_file", conf_col: str = "confidence", time_col: str = "updated_at"
) -> DataFrame:
    """``group_id, group_key, n_records, best`` of each group of two or more: ``best`` has the records that any field may come from, with their layers.

    Groups are rows with an equal normalised ``key``; a missing key makes no group. ``trust``
    (``source_file, trust_rank``) is joined by the file name after the last ``/``. NULL trust, confidence
    (also NaN) or time goes last; ties go to the smallest id. Rows with a NULL id are left out. In ``best``
    confidence and time are negated, so that less is better throughout, and ``has`` has a bit for each field.
    """
    known = trust.where(F.col("source_file").isNotNull()).groupBy(F.col("source_file").alias("_file")).agg(F.min("trust_rank").alias("_trust"))
    time = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(time_col).cast("timestamp_ntz"))
    has = reduce(lambda a, b: a + b, [F.when(present(f), 1 << i).otherwise(0) for i, f in enumerate(fields)])
    rows = df.where(present(key) & F.col(id_col).isNotNull()).select(
        normal_key(key).alias("_key"),
        F.col(id_col).cast("bigint").alias("_id"),
        F.regexp_extract(F.col(file_col), r"([^/]*)$", 1).alias("_file"),
        F.coalesce(-F.nanvl(F.col(conf_col).cast("double"), F.lit(None)), F.lit(float("inf"))).alias("_conf"),
        F.coalesce(-time, F.lit(2**62)).alias("_time"),
        has.alias("_has"),
    )
    rows = rows.join(known, "_file", "left").withColumn("_trust", F.coalesce(F.col("_trust").cast("bigint"), F.lit(UNKNOWN)))
    cell = F.min(F.struct(F.col("_conf").alias("conf"), F.col("_time").alias("time"), F.col("_id").alias("id"))).alias("top")
    cells = rows.groupBy("_key", "_has", "_trust").agg(cell, F.count(F.lit(1)).alias("n"), F.min("_id").alias("first"))
    item = F.struct(F.col("_trust").alias("trust"), F.col("top.conf").alias("conf"), F.col("top.time").alias("time"), F.col("top.id").alias("id"), F.col("_has").alias("has"))
    groups = cells.groupBy("_key").agg(F.sum("n").alias("n_records"), F.min("first").alias("group_id"), F.sort_array(F.collect_list(item)).alias("cells"))
    return groups.where("n_records >= 2").select("group_id", F.col("_key").alias("group_key"), "n_records", layers(F.col("cells")).alias("best"))


def layer_rows(found: DataFrame, fields: list[str]) -> DataFrame:
    """``group_id, record_id, n_fields, layer, n_above`` of the records that :func:`skylines` keeps."""
    x = found.select("group_id", F.explode("best").alias("b"))
    n = sum((F.col("b.has").bitwiseAND(F.lit(1 << i)) > 0).cast("int") for i in range(len(fields)))
    return x.select("group_id", F.col("b.id").alias("record_id"), n.alias("n_fields"), F.col("b.layer").alias("layer"), F.col("b.n_above").alias("n_above"))


def chosen(found: DataFrame, fields: list[str]) -> DataFrame:
    """``group_id, group_key, n_records`` and for each field ``<f>_id``: the record that it comes from, NULL if none has a value.

    A field of the survivor itself, else of the first record by (layer, policy) that has one. As completeness
    is compared by inclusion, a record with the field that precedes all others with it is never dominated:
    the first layer with a value is layer 1, and what fills a field is what the policy prefers among all
    rows with a value.
    """
    order = F.array_sort(F.transform("best", lambda b: F.struct(b["layer"].alias("layer"), b["trust"].alias("trust"), b["conf"].alias("conf"), b["time"].alias("time"), b["id"].alias("id"), b["has"].alias("has"))))
    at = found.select("group_id", "group_key", "n_records", order.alias("o"))
    first = lambda i: F.get(F.filter("o", lambda b: b["has"].bitwiseAND(F.lit(1 << i)) > 0), F.lit(0))["id"]
    return at.select("group_id", "group_key", "n_records", *[first(i).alias(f"{f}_id") for i, f in enumerate(fields)])


def field_survivors(df: DataFrame, trust: DataFrame, key: str, fields: list[str], id_col: str = "id", **cols: str) -> DataFrame:
    """One row per group of two or more: ``group_id, group_key, n_records`` and, per field, ``<f>_id`` and ``<f>`` (NULL if none has it).

    Arguments as in :func:`skylines`. Values are fetched by id once the records are chosen; of rows that repeat an id the smallest value counts.
    """
    out = chosen(skylines(df, trust, key, fields, id_col, **cols), fields)
    want = out.select("group_id", F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(f"{f}_id").alias("_id")) for i, f in enumerate(fields)])).alias("x")).select("group_id", "x.f", "x._id").where("_id IS NOT NULL")
    values = df.select(F.col(id_col).cast("bigint").alias("_id"), *[F.when(present(f), F.col(f).cast("string")).alias(f"v{i}") for i, f in enumerate(fields)])
    got = want.join(values, "_id").groupBy("group_id").agg(*[F.min(F.when(F.col("f") == i, F.col(f"v{i}"))).alias(f"v{i}") for i in range(len(fields))])
    cols_ = [c for i, f in enumerate(fields) for c in (F.col(f"{f}_id"), F.col(f"v{i}").alias(f))]
    return out.join(got, "group_id", "left").select("group_id", "group_key", "n_records", *cols_)


def long_form(survivors: DataFrame, fields: list[str]) -> DataFrame:
    """``group_id, field_name, record_id``: one row for each field that has a surviving value."""
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f"{f}_id").alias("record_id")) for f in fields]))
    return survivors.select("group_id", each.alias("x")).select("group_id", "x.field_name", "x.record_id").where("record_id IS NOT NULL")
