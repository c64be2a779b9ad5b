"""Packed fields split into one row per value."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.operators.unpack import unpack
from quern.plans.registry import query
from quern.session import table

PACKED = [("entries", "sources", "name"), ("zolai_vocabulary", "compound_parts", "part"), ("zolai_vocabulary", "bible_books", "code")]


def _unpacked(spark, d, least) -> DataFrame:
    parts = [
        unpack(table(spark, d, t), kind, least, "id", c).select(F.lit(t).alias("table_name"), F.lit(c).alias("field_name"), "record_id", "value_pos", "value")
        for t, c, kind in PACKED
    ]
    return reduce(DataFrame.unionAll, parts)


@query()
def p2_found(spark, d):
    return _unpacked(spark, d, 2)


@query()
def p2_values(spark, d):
    return _unpacked(spark, d, 1)
