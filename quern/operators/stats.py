"""Counts, profiles, n-grams, collocations, top-k and coverage (inventories G, H, I).

Tokens are exploded after projection to the key and the token alone; counts combine on the map side,
so a book with a third of all verses costs no more in one task. Ranked lists are cut by a window
over counts, not over tokens.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators.joins import ngrams


def word_counts(ts: DataFrame, token: str = "word", keys: list[str] | None = None) -> DataFrame:
    """Occurrences by keys and token."""
    return ts.groupBy(*(keys or []), token).agg(F.count(F.lit(1)).alias("n"))


def doc_counts(df: DataFrame, id_col: str, ts: Column, keys: list[str] | None = None) -> DataFrame:
    """``word, n, n_docs`` (by ``keys``); distinct words of a row are paired with their in-row counts first."""
    e = df.select(*(keys or []), id_col, F.explode(ts).alias("word")).groupBy(*(keys or []), id_col, "word").agg(F.count(F.lit(1)).alias("c"))
    return e.groupBy(*(keys or []), "word").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("n_docs"))


def ngram_counts(df: DataFrame, ts: Column, n: int, keys: list[str] | None = None) -> DataFrame:
    """G6. The words are a column of their own first: inside the n-gram lambda they would be cut anew for each gram."""
    ws = df.select(*(keys or []), ts.alias("_ws"))
    return ws.select(*(keys or []), F.explode(ngrams(F.col("_ws"), n)).alias("gram")).groupBy(*(keys or []), "gram").agg(F.count(F.lit(1)).alias("n"))


def top_per_group(df: DataFrame, keys: list[str], k: int, order: list[Column]) -> DataFrame:
    """H2, H3: the first ``k`` rows of each group with their ``rank``; order must be total."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)


def specific_words(df: DataFrame, key: str, id_col: str, ts: Column, least: int = 5, elsewhere: int = 1) -> DataFrame:
    """Words in ``least`` or more rows of a group and in at most ``elsewhere`` rows of all others."""
    c = doc_counts(df, id_col, ts, [key])
    total = c.groupBy("word").agg(F.sum("n_docs").alias("all_docs"))
    return c.where(F.col("n_docs") >= least).join(total, "word").where(F.col("all_docs") - F.col("n_docs") <= elsewhere).select(key, "word", "n_docs")


def association(df: DataFrame, ts: Column, least: int = 3) -> DataFrame:
    """``first, second, n, ratio`` of adjacent words: f(xy) / (f(x) f(y))."""
    uni = df.select(F.explode(ts).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("f"))
    bi = ngram_counts(df, ts, 2).where(F.col("n") >= least).select(F.split("gram", " ").alias("p"), "n").select(F.col("p")[0].alias("first"), F.col("p")[1].alias("second"), "n")
    j = bi.join(uni.select(F.col("word").alias("first"), F.col("f").alias("fx")), "first").join(uni.select(F.col("word").alias("second"), F.col("f").alias("fy")), "second")
    return j.select("first", "second", "n", (F.col("n") / (F.col("fx") * F.col("fy"))).alias("ratio"))


def cooccurrence(df: DataFrame, key: str, ts: Column, most: int | None = None) -> DataFrame:
    """Pairs a < b of the distinct words of a row, by group, built within the row; with ``most``, only
    of the first so many (sorted, Q9)."""
    w = df.select(key, F.array_sort(F.array_distinct(ts)).alias("w"))
    w = w.withColumn("w", F.slice("w", 1, most)) if most is not None else w
    pair = F.expr("flatten(transform(w, (x, i) -> transform(slice(w, i + 2, size(w)), y -> struct(x AS a, y AS b))))")
    return w.select(key, F.explode(pair).alias("p")).groupBy(key, "p.a", "p.b").agg(F.count(F.lit(1)).alias("n"))


def collocations(df: DataFrame, ts: Column, window: int = 2) -> DataFrame:
    """Ordered pairs within ``window`` words on either side."""
    w = df.select(ts.alias("w"))
    near = F.expr(f"flatten(transform(w, (x, i) -> transform(filter(sequence(i - {window}, i + {window}), j -> j >= 0 AND j < size(w) AND j <> i), j -> struct(x AS word, w[j] AS near))))")
    return w.select(F.explode(near).alias("p")).groupBy("p.word", "p.near").agg(F.count(F.lit(1)).alias("n"))


def weighted_cooccurrence(df: DataFrame, own: Column, other: Column) -> DataFrame:
    """Translation weights by closeness of relative position: max(1, int(3 (1 - |distance|))), each word pair once a row."""
    p = df.select(own.alias("a"), other.alias("b"))
    x = p.select(F.posexplode("a").alias("i", "own"), F.size("a").alias("na"), "b").select("i", "own", "na", F.size("b").alias("nb"), F.posexplode("b").alias("j", "other"))
    dist = F.abs(F.col("i") / F.col("na") - F.col("j") / F.col("nb"))
    weight = F.greatest(F.lit(1), F.floor(3 * (1 - dist) + 1e-9).cast("int"))
    return x.groupBy("own", "other").agg(F.sum(weight).alias("weight"), F.count(F.lit(1)).alias("n"))


def profile(df: DataFrame, key: str, ts: Column) -> DataFrame:
    """Rows, tokens, distinct words and mean tokens of each group."""
    t = df.select(key, ts.alias("ts"))
    rows = t.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.size("ts")).alias("n_tokens"), F.round(F.avg(F.size("ts")), 6).alias("mean_tokens"))
    distinct = t.select(key, F.explode("ts").alias("w")).distinct().groupBy(key).agg(F.count(F.lit(1)).alias("n_words"))
    return rows.join(distinct, key, "left").withColumn("n_words", F.coalesce("n_words", F.lit(0).cast("bigint")))


def coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column how many rows have a value, in one pass: ``column_name, n, filled, pct``."""
    a = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(~T.blank(F.col(c).cast("string"))).alias(f"f{i}") for i, c in enumerate(columns)])
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("n"), F.col(f"f{i}").alias("filled")) for i, c in enumerate(columns)]))
    return a.select(each.alias("x")).select("x.*").withColumn("pct", F.when(F.col("n") > 0, F.round(100.0 * F.col("filled") / F.col("n"), 2)))


def histogram(df: DataFrame, col: str, edges: list[float]) -> DataFrame:
    """Half-open bins by their lower edge, the last bin open above."""
    at = reduce(lambda acc, e: F.when(F.col(col) >= e, F.lit(e)).otherwise(acc), sorted(edges), F.lit(None).cast("double"))
    return df.where(F.col(col).isNotNull()).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def majority(df: DataFrame, key: str, vote: str) -> DataFrame:
    """The most frequent vote of each key (ties to the smallest), its share and the votes cast."""
    c = df.where(F.col(vote).isNotNull()).groupBy(key, vote).agg(F.count(F.lit(1)).alias("n"))
    m = c.groupBy(key).agg(F.min(F.struct(-F.col("n"), F.col(vote).alias("v"))).alias("m"), F.sum("n").alias("votes"))
    return m.select(key, F.col("m.v").alias("winner"), F.round(-F.col("m.col1") / F.col("votes"), 6).alias("agreement"), "votes")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """G22."""
    return reduce(DataFrame.unionAll, [t.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n")) for n, t in sorted(tables.items())])


def samples_by(df: DataFrame, key: str, value: str, k: int = 5) -> DataFrame:
    """The first ``k`` values of each key, joined."""
    t = df.select(key, value).where(F.col(value).isNotNull()).distinct()
    t = t.withColumn("r", F.row_number().over(Window.partitionBy(key).orderBy(value))).where(F.col("r") <= k)
    return t.groupBy(key).agg(F.array_join(F.sort_array(F.collect_list(value)), ", ").alias("sample"))
