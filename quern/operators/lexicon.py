"""Lexicon building: examples, senses, evidence, deep validation (rows of inventories D, F, G, J, K, L)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import text as T


def best_examples(words: DataFrame, verses: DataFrame) -> DataFrame:
    """``word, id, example``: of the verses that hold a word the one of 5-12 words, then the length nearest 7, then the smallest id.

    ``verses``: id, text, ws (words). One aggregate with map-side combine per word.
    """
    v = verses.select("id", "text", F.size("ws").alias("n"), F.explode(F.array_distinct("ws")).alias("word"))
    j = v.join(words.select("word").distinct(), "word")
    rank = F.struct((~F.col("n").between(5, 12)).alias("far"), F.abs(F.col("n") - 7).alias("d"), "id", "text")
    return j.groupBy("word").agg(F.min(rank).alias("m")).select("word", F.col("m.id").alias("id"), F.col("m.text").alias("example"))


def references(tokens: DataFrame, k: int = 3) -> DataFrame:
    """``word, n, refs``: occurrences and the first ``k`` distinct ids of each word; ``tokens``: word, id."""
    per = tokens.groupBy("word", "id").agg(F.count(F.lit(1)).alias("c"))
    total = per.groupBy("word").agg(F.sum("c").alias("n"))
    first = per.withColumn("r", F.row_number().over(Window.partitionBy("word").orderBy("id"))).where(F.col("r") <= k)
    return total.join(first.groupBy("word").agg(F.sort_array(F.collect_list("id")).alias("refs")), "word")


def aligned_contradictions(dictionary: DataFrame, aligned: DataFrame) -> DataFrame:
    """``word, gloss, status``: ok if a gloss holds an aligned meaning or the other way round, mismatch if none does, unaligned without any.

    ``dictionary``: word, gloss; ``aligned``: word, meaning.
    """
    g = dictionary.where(~T.blank(F.col("gloss"))).select("word", "gloss").distinct()
    j = g.join(aligned.select("word", "meaning").distinct(), "word", "left")
    hit = F.contains("gloss", "meaning") | F.contains("meaning", "gloss")
    a = j.groupBy("word", "gloss").agg(F.count("meaning").alias("k"), F.max(F.coalesce(hit, F.lit(False))).alias("hit"))
    return a.select("word", "gloss", F.when(F.col("k") == 0, "unaligned").when(F.col("hit"), "ok").otherwise("mismatch").alias("status"))


def nth_words(alignments: DataFrame, verses: DataFrame, most: int = 5) -> DataFrame:
    """for each word the token of a third text at the aligned position, from the first verse of up to ``most`` that has one.

    ``alignments``: word, id, position (0-based); ``verses``: id, third (words).
    """
    top = alignments.where("position >= 0").withColumn("r", F.row_number().over(Window.partitionBy("word").orderBy("id"))).where(F.col("r") <= most)
    j = top.join(verses, "id").withColumn("v", F.get("third", F.col("position"))).where("v IS NOT NULL")
    return j.groupBy("word").agg(F.min(F.struct("id", "v")).alias("m")).select("word", F.col("m.v").alias("value"))


def contexts(df: DataFrame, ws: Column, heads: list[str], before: int = 3, after: int = 1) -> DataFrame:
    """``head, near, n``: words from ``before`` ahead to ``after`` behind each head word."""
    w = df.select(ws.alias("w"))
    at = F.filter(F.transform("w", lambda x, i: F.when(x.isin(heads), i)), lambda i: i.isNotNull())
    e = w.select("w", F.explode(at).alias("i"))
    lo = F.greatest(F.col("i") - before, F.lit(0))
    near = F.slice("w", lo + 1, F.col("i") + after - lo + 1)
    e = e.select(F.get("w", F.col("i")).alias("head"), F.explode(near).alias("near")).where("near <> head")
    return e.groupBy("head", "near").agg(F.count(F.lit(1)).alias("n"))


def senses(entries: DataFrame) -> DataFrame:
    """``word, n_senses, senses`` of words with more than one distinct non-blank gloss."""
    g = entries.where(~T.blank(F.col("gloss"))).groupBy("word").agg(F.sort_array(F.collect_set(F.lower(F.trim("gloss")))).alias("senses"))
    return g.select("word", F.size("senses").alias("n_senses"), "senses").where("n_senses > 1")


def word_pairs(rows: DataFrame, seed: str = "42") -> DataFrame:
    """One unordered pair of distinct words for each row with two or more, by digest; ``rows``: id, ws."""
    s = rows.select("id", F.array_sort(F.transform(F.array_distinct("ws"), lambda w: F.struct(F.md5(F.concat(F.lit(seed), F.col("id").cast("string"), w)).alias("d"), w.alias("w")))).alias("s")).where(F.size("s") >= 2)
    a, b = F.col("s")[0]["w"], F.col("s")[1]["w"]
    return s.select("id", F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))


def compounds(texts: DataFrame, parts: DataFrame) -> DataFrame:
    """``id, word, parts`` of words that a compound table (word unique, parts) knows; ``texts``: id, ws."""
    return texts.select("id", F.explode(F.array_distinct("ws")).alias("word")).join(parts, "word")


def glossary(entries: DataFrame, counts: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` most frequent words that have a gloss, with it (a top-k report)."""
    g = entries.where(~T.blank(F.col("gloss"))).groupBy("word").agg(F.min("gloss").alias("gloss"))
    return g.join(counts, "word").orderBy(F.desc("n"), "word").limit(k)


def ratings(df: DataFrame, item: str, score: str, least: float, high: float) -> DataFrame:
    """Per item the number of ratings within bounds, their mean, and those out of bounds."""
    ok = F.col(score).between(least, high)
    return df.groupBy(item).agg(F.count_if(ok).alias("n"), F.round(F.avg(F.when(ok, F.col(score))), 6).alias("mean"), F.count_if(~F.coalesce(ok, F.lit(False))).alias("rejected"))


def pattern_lookup(c: Column, table: list[tuple[str, str]]) -> Column:
    """The patterns whose key word stands in a text, in table order."""
    return F.array_compact(F.array(*[F.when(c.rlike(rf"(?i)(^|[^\p{{L}}]){k}($|[^\p{{L}}])"), v) for k, v in table]))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, parts)
