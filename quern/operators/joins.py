"""Lookups, fills, overwrites, mismatches and attestation (inventory F).

No join is hinted to broadcast a side that grows: Spark broadcasts by measured size, and AQE splits
skewed partitions. Containment of phrases is an equi-join on word n-grams, never a nested loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import text as T


def one_per_key(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Q14: the non-blank value with the smallest ``order`` of each key."""
    ok = df.where(F.col(key).isNotNull() & ~T.blank(F.col(value)))
    return ok.groupBy(key).agg(F.min(F.struct(order, value)).alias("m")).select(key, F.col(f"m.{value}").alias(value))


def fill_blank(target: DataFrame, source: DataFrame, on: tuple[str, str], column: str, order: str = "id") -> DataFrame:
    """Blanks of ``column`` filled from the source row with the smallest ``order`` of the same key."""
    left, right = on
    s = one_per_key(source.select(F.col(right).alias("_k"), F.col(column).alias("_v"), F.col(order).alias("_o")), "_k", "_v", "_o")
    j = target.join(s, target[left] == s["_k"], "left")
    return j.withColumn(column, F.when(T.blank(F.col(column)), F.coalesce("_v", column)).otherwise(F.col(column))).drop("_k", "_v")


def fillable(target: DataFrame, source: DataFrame, on: tuple[str, str], column: str) -> DataFrame:
    """rows of ``target`` whose blank column a source row could fill."""
    left, right = on
    s = source.where(~T.blank(F.col(column))).select(F.col(right).alias("_k")).where("_k IS NOT NULL").distinct()
    return target.where(T.blank(F.col(column))).join(s, F.col(left) == F.col("_k"), "left_semi")


def mismatches(a: DataFrame, b: DataFrame, key: str, column: str) -> DataFrame:
    """``key, a_id, b_id, a_value, b_value`` of rows with one key and two different non-blank values."""
    x = a.where(~T.blank(F.col(column))).select(key, F.col("id").alias("a_id"), F.col(column).alias("a_value"))
    y = b.where(~T.blank(F.col(column))).select(key, F.col("id").alias("b_id"), F.col(column).alias("b_value"))
    return x.join(y, key).where("a_value <> b_value")


def overwrite(target: DataFrame, source: DataFrame, key: str, column: str, order: str = "id") -> DataFrame:
    """the source's value wins where it has one."""
    s = one_per_key(source.select(key, F.col(column).alias("_v"), F.col(order).alias("_o")), key, "_v", "_o")
    return target.join(s, key, "left").withColumn(column, F.coalesce("_v", column)).drop("_v")


def align_words(verses: DataFrame, lexicon: DataFrame) -> DataFrame:
    """each verse word looked up: ``id, word, meaning, position, confidence``.

    ``verses``: id, own (words), other (words); ``lexicon``: word, meanings (array). Confidence is
    0.9 for one meaning and 0.7 for several if the first stands in the verse's other text, else 0.5
    at position -1. One row per (id, word).
    """
    w = verses.select("id", "other", F.explode(F.array_distinct("own")).alias("word"))
    j = w.join(lexicon, "word").withColumn("meaning", T.at("meanings", 1))
    at = F.array_position("other", F.col("meaning")).cast("int") - 1
    conf = F.when(at < 0, 0.5).when(F.size("meanings") == 1, 0.9).otherwise(0.7)
    return j.select("id", "word", "meaning", at.alias("position"), conf.alias("confidence"))


def nest(rows: DataFrame, key: str, order: str, fields: list[str]) -> DataFrame:
    """the rows of each key as a sorted array of structs."""
    return rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(order, *fields))).alias("items"))


def ngrams(ws: Column, n: int) -> Column:
    """All n-grams of an array of words, joined with spaces; empty for fewer words."""
    return F.when(F.size(ws) >= n, F.transform(F.sequence(F.lit(1), F.size(ws) - n + 1), lambda i: F.array_join(F.slice(ws, i, F.lit(n)), " "))).otherwise(F.array().cast("array<string>"))


def phrase_hits(texts: DataFrame, phrases: DataFrame) -> DataFrame:
    """``id, phrase, n`` for every phrase, however long, that stands in a text.

    ``texts``: id, ws (words); ``phrases``: phrase. Texts are read once: n-grams are cut for the lengths that phrases
    have, of which only the distinct numbers reach the driver.
    """
    sized = phrases.select("phrase").where("phrase <> ''").distinct()
    lengths = [r.k for r in sized.select(F.size(F.split("phrase", " ")).alias("k")).distinct().collect()]
    if not lengths:
        return texts.select("id", F.lit("").alias("phrase"), F.lit(0).cast("bigint").alias("n")).limit(0)
    grams = F.concat(*[ngrams(F.col("ws"), n) for n in sorted(lengths)])
    return texts.select("id", F.explode(grams).alias("phrase")).join(sized, "phrase").groupBy("id", "phrase").agg(F.count(F.lit(1)).alias("n"))


def positional(a: DataFrame, b: DataFrame, index: str) -> DataFrame:
    """rows paired by a stored ordinal."""
    return a.join(b, index, "full")


def best_both_ways(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """F16: (other -> best own, own -> best other) of ``own, other, confidence, frequency``; ties to the smaller word."""
    rank = lambda w: F.struct(-F.col("confidence"), -F.col("frequency"), F.col(w))
    fwd = pairs.groupBy("other").agg(F.min(rank("own")).alias("m")).select("other", F.col("m.own").alias("own"))
    back = pairs.groupBy("own").agg(F.min(rank("other")).alias("m")).select("own", F.col("m.other").alias("other"))
    return fwd, back


def translate_words(phrases: DataFrame, lexicon: DataFrame) -> DataFrame:
    """phrases (id, phrase) word by word; NULL unless every word resolves. ``lexicon``: word (unique), meaning."""
    w = phrases.select("id", F.posexplode(T.words(F.lower("phrase"))).alias("i", "word")).join(lexicon, "word", "left")
    g = w.groupBy("id").agg(F.bool_and(F.col("meaning").isNotNull()).alias("all"), F.sort_array(F.collect_list(F.struct("i", F.coalesce("meaning", F.lit("")).alias("m")))).alias("x"))
    return g.select("id", F.when(F.col("all"), F.array_join(F.transform("x", lambda s: s["m"]), " ")).alias("translation"))


def with_stem(words: DataFrame, known: DataFrame) -> DataFrame:
    """``word, how``: exact, stem or unknown, by a table of known words."""
    k = known.select(F.col("word").alias("_w")).where("_w IS NOT NULL").distinct()
    exact = words.join(k, F.col("word") == F.col("_w"), "left").withColumn("exact", F.col("_w").isNotNull()).drop("_w")
    stem = exact.where("NOT exact").select("word", F.explode(T.stems(F.col("word"))).alias("_s")).join(k, F.col("_s") == F.col("_w"), "left_semi").select("word").distinct().withColumn("stem", F.lit(True))
    j = exact.join(stem, "word", "left")
    return j.select("word", F.when(F.col("exact"), "exact").when(F.col("stem"), "stem").otherwise("unknown").alias("how"))


def families(words: DataFrame, prefix: int = 4, most: int = 6) -> DataFrame:
    """up to ``most`` other words with the same first letters.

    The first ``most`` + 1 words of each family are enough for every member, so no family is
    joined with itself.
    """
    w = words.select("word").distinct().withColumn("root", F.substring("word", 1, prefix)).where(F.length("root") == prefix)
    top = w.withColumn("r", F.row_number().over(Window.partitionBy("root").orderBy("word"))).where(F.col("r") <= most + 1)
    lists = top.groupBy("root").agg(F.sort_array(F.collect_list("word")).alias("all"))
    j = w.join(lists, "root")
    return j.select("word", F.slice(F.array_remove("all", F.col("word")), 1, most).alias("related"))


def variants(words: DataFrame, most: int = 4) -> DataFrame:
    """Up to ``most`` other words with the same first meaning; as :func:`families`."""
    w = words.select("word", "meaning").where(~T.blank(F.col("meaning"))).distinct()
    top = w.withColumn("r", F.row_number().over(Window.partitionBy("meaning").orderBy("word"))).where(F.col("r") <= most + 1)
    lists = top.groupBy("meaning").agg(F.sort_array(F.collect_list("word")).alias("all"))
    return w.join(lists, "meaning").select("word", "meaning", F.slice(F.array_remove("all", F.col("word")), 1, most).alias("peers"))


def correct_values(entries: DataFrame, rules: DataFrame, always: list[str], usage: DataFrame) -> DataFrame:
    """the change log ``id, word, old_value, new_value, uses, first_use`` of a correction table.

    ``entries``: id, word, value; ``rules``: word (unique), wrong (array of lower-case glosses), right; a value is corrected if any wrong
    gloss stands in it, or its word is in ``always``. ``usage``: word, id of the texts that hold a word; NULL values count as empty.
    """
    value = F.coalesce("value", F.lit(""))
    j = entries.join(rules, "word").where(F.exists("wrong", lambda w: F.contains(F.lower(value), w)) | F.col("word").isin(always))
    uses = usage.groupBy("word").agg(F.countDistinct("id").alias("uses"), F.min("id").alias("first_use"))
    j = j.join(uses, "word", "left").where(~F.col("value").eqNullSafe(F.col("right")))
    return j.select("id", "word", F.col("value").alias("old_value"), F.col("right").alias("new_value"), F.coalesce("uses", F.lit(0).cast("bigint")).alias("uses"), "first_use")


def reference_join(texts: DataFrame, reference: DataFrame, keys: list[str], fixes: dict[str, str], book: str, least: int, least_reference: int, denied: str) -> DataFrame:
    """``texts`` (keys, own) joined with the reference text of the same keys (keys, other) after book codes are fixed.

    Short texts on either side and own texts that match the ``denied`` pattern are left out.
    """
    table = F.create_map(*[F.lit(x) for kv in sorted(fixes.items()) for x in kv]) if fixes else None
    fixed = lambda df: df.withColumn(book, F.coalesce(T.at(table, F.col(book)), F.col(book))) if fixes else df
    j = fixed(texts).join(fixed(reference), keys)
    return j.where((F.length("own") >= least) & (F.length("other") >= least_reference) & ~F.col("own").rlike(denied))


def enrich_by_text(df: DataFrame, enriched: DataFrame, text: str, cols: list[str], order: list[str]) -> DataFrame:
    """``df`` with ``cols`` of the last row of ``enriched`` (by ``order``) that has exactly the same text; NULL without one. Joined by digest."""
    last = enriched.where(F.col(text).isNotNull()).groupBy(F.sha2(F.col(text), 256).alias("_d")).agg(F.max(F.struct(*order, *[c for c in cols if c not in order])).alias("_m"))
    own = df.withColumn("_d", F.sha2(F.col(text), 256))
    return own.join(last, "_d", "left").select(*df.columns, *[F.col(f"_m.{c}").alias(f"new_{c}") for c in cols])
