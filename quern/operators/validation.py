"""Sentence checks against what a reference text attests, and what follows from their scores (inventory J).

References are small sets of words, pairs and structures taken from the reference sentences; each check is
an equi-join of the distinct things to look up, so sentences themselves move only as ids and counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import rules
from quern.functions import text as T

EDGE = r"""^[.,;:!?"'()\[\]{}]+|[.,;:!?"'()\[\]{}]+$"""


def clause_words(c: Column) -> Column:
    """Words between white space, lower case, without outer punctuation, cut at hyphens."""
    bare = F.transform(T.words(F.lower(c)), lambda w: F.split(F.regexp_replace(w, EDGE, ""), "-"))
    return F.filter(F.flatten(bare), lambda w: w != "")


def clause_pattern(ws: Column) -> Column:
    """Word classes joined with ``-``: S, in, uh, tua, Q, the final itself, and one O for a run of others."""
    cls = lambda w: F.when(w.isin("ka", "na", "i", "ki", "a"), "S").when(w.isin(["in", "uh", "tua"] + rules.CLAUSE_FINALS), w).when(w.isin(rules.CLAUSE_SUBJECTS), "S").when(w.isin(rules.CLAUSE_QUESTIONS), "Q").otherwise("O")
    tags = F.transform(ws, cls)
    return F.array_join(F.filter(F.transform(tags, lambda t, i: F.when((t != "O") | (i == 0) | (F.get(tags, i - 1) != "O"), t)), lambda t: t.isNotNull()), "-")


def core_pattern(c: Column) -> Column:
    return F.array_join(F.filter(F.split(c, "-"), lambda x: x != "O"), "-")


def final_at(ws: Column) -> Column:
    """1-based place of the first clause final behind a word that may be a verb; 0 if there is none."""
    return F.array_position(F.transform(ws, lambda w, i: w.isin(rules.CLAUSE_FINALS) & (i > 0) & ~F.coalesce(F.get(ws, i - 1), F.lit("")).isin(rules.CLAUSE_FINALS + rules.CLAUSE_INNER)), True).cast("int")


def verb_uses(verses: DataFrame) -> DataFrame:
    """``verb, object`` of ``verses`` (ws): each word before a clause final with the words up to three ahead of the final and one behind it; the
    object is NULL once for each verb."""
    e = verses.select("ws", F.posexplode("ws").alias("i", "w")).where(F.col("w").isin(rules.CLAUSE_FINALS) & (F.col("i") > 0))
    e = e.select("ws", "i", F.get("ws", F.col("i") - 1).alias("verb")).where(~F.col("verb").isin(rules.CLAUSE_FINALS + rules.CLAUSE_INNER))
    lo = F.greatest(F.col("i") - 3, F.lit(0))
    near = F.filter(F.slice("ws", lo + 1, F.col("i") + 2 - lo), lambda x: ~x.isin(rules.CLAUSE_FINALS + rules.CLAUSE_INNER))
    return e.select("verb", F.explode(F.concat(near, F.array(F.lit(None).cast("string")))).alias("object")).where("object IS NULL OR object <> verb").distinct()


def unknown_words(words: DataFrame, known: DataFrame) -> DataFrame:
    """The ``word`` rows of which neither the form nor a stem before one of the known suffixes is in ``known`` (word)."""
    stems = [F.when(F.col("word").endswith(x) & (F.length("word") > len(x) + 2), F.expr(f"left(word, length(word) - {len(x)})")) for x in rules.STEM_SUFFIXES]
    w = words.select("word").where(~F.col("word").isin(rules.KNOWN_ANYWAY)).distinct()
    forms = w.select("word", F.explode(F.array_compact(F.array(F.col("word"), *stems))).alias("form"))
    hit = forms.join(known.select(F.col("word").alias("form")).where("form IS NOT NULL").distinct(), "form", "left_semi").select("word").distinct()
    return w.join(hit, "word", "left_anti")


def deep_checks(sentences: DataFrame, known: DataFrame, verses: DataFrame) -> DataFrame:
    """``id, unknown, pattern, verb_use, collocation, forbidden, word_order, score``: penalties of the six checks, and 100 less their sum, not below 0.

    ``sentences``: id, text, referenced (has a verse reference: its pattern counts as known); ``verses``: ws, the
    reference sentences; ``known``: word. 5 for each unknown word, 5 for an unknown pattern and core, 5 without and 15
    for an unattested verb, 10 if a content word before the final (the verb among them) was never near a verb that has attested
    neighbours, 20 for each forbidden form, 5 for a subject behind the verb outside quoted speech. NULL texts count as empty.
    """
    s = sentences.select("id", "referenced", F.coalesce("text", F.lit("")).alias("t")).withColumn("ws", clause_words(F.col("t")))
    s = s.withColumn("pattern", clause_pattern(F.col("ws"))).withColumn("f", final_at(F.col("ws"))).withColumn("verb", F.when(F.col("f") > 1, F.get("ws", F.col("f") - 2)))
    lost = unknown_words(s.select(F.explode("ws").alias("word")), known)
    unknown = s.select("id", F.explode("ws").alias("word")).join(lost, "word", "left_semi").groupBy("id").agg((F.count(F.lit(1)) * 5).alias("unknown"))
    patterns = verses.select(clause_pattern(F.col("ws")).alias("x")).distinct()
    uses = verb_uses(verses)
    verbs = uses.where("object IS NULL").select("verb", F.lit(True).alias("attested"))
    out = rules.CLAUSE_SUBJECTS + rules.CLAUSE_INNER + rules.CLAUSE_FINALS
    objects = s.where("verb IS NOT NULL").select("id", "verb", F.explode(F.array_distinct(F.filter(F.slice("ws", F.lit(1), F.col("f") - 1), lambda w: ~w.isin(out)))).alias("object"))
    near = uses.where("object IS NOT NULL")
    strange = objects.join(near.select("verb").distinct(), "verb", "left_semi").join(near, ["verb", "object"], "left_anti").select("id").distinct().withColumn("strange", F.lit(True))
    bare = F.transform(T.words(F.lower("t")), lambda w: F.regexp_replace(w, EDGE, ""))
    forbidden = F.size(F.filter(bare, lambda w: w.isin(sorted(rules.FORBIDDEN)))) * 20
    places = lambda cond: F.transform("ws", lambda w, i: F.when(cond(w), i))
    subject, last = F.array_min(places(lambda w: w.isin(rules.CLAUSE_SUBJECTS))), F.array_max(places(lambda w: w.isin(rules.CLAUSE_FINALS)))
    order = F.when((F.size("ws") >= 2) & ~F.col("t").rlike("[“”‘’\"']") & (last >= 1) & (subject >= last - 1), 5).otherwise(0)
    exact = patterns.select(F.col("x").alias("pattern"), F.lit(True).alias("seen"))
    core = patterns.select(F.col("x").alias("core"), F.lit(True).alias("core_seen"))
    j = s.withColumn("core", core_pattern(F.col("pattern"))).select("id", "referenced", "pattern", "core", "verb", forbidden.alias("forbidden"), order.alias("word_order"))
    j = j.join(exact, "pattern", "left").join(core, "core", "left").join(verbs, "verb", "left").join(unknown, "id", "left").join(strange, "id", "left")
    fine = F.coalesce(F.col("referenced") | F.col("seen") | F.col("core_seen"), F.lit(False))
    parts = {
        "unknown": F.coalesce("unknown", F.lit(0)), "pattern": F.when(fine, 0).otherwise(5), "verb_use": F.when(F.col("verb").isNull(), 5).when(F.col("attested"), 0).otherwise(15),
        "collocation": F.when(F.col("strange"), 10).otherwise(0), "forbidden": F.col("forbidden"), "word_order": F.col("word_order"),
    }
    j = j.select("id", *[c.cast("int").alias(k) for k, c in parts.items()])
    return j.withColumn("score", F.greatest(F.lit(0), F.lit(100) - sum((F.col(k) for k in parts), F.lit(0))))


def topic_words(verses: DataFrame, k: int = 30) -> DataFrame:
    """``book, word, n``: the ``k`` most frequent words of each book that are neither particle nor subject marker; ties to the smaller word."""
    from quern.operators.stats import top_per_group

    c = verses.select("book", F.explode("ws").alias("word")).where(~F.col("word").isin(sorted(set(rules.CLAUSE_PARTICLES + rules.CLAUSE_SUBJECTS)))).groupBy("book", "word").agg(F.count(F.lit(1)).alias("n"))
    return top_per_group(c, ["book"], k, [F.desc("n"), F.col("word")]).drop("rank")


def context_scores(sentences: DataFrame, known: DataFrame, verses: DataFrame, k: int = 30) -> DataFrame:
    """``id, word_score, phrase_score, structure_score, book_bonus, score`` of ``sentences`` (id, book, ws) against ``verses`` (book, ws).

    30 less 5 for each unknown word that is no function word, 30 x the share of adjacent pairs that the verses have, 20 for the
    structure (any is valid), 15 for a known book and 5 x the share of content words among its leading ``k``; 0 without words.
    """
    plain = sorted(set(rules.CLAUSE_PARTICLES + rules.CLAUSE_SUBJECTS + rules.CLAUSE_FINALS))
    s = sentences.select("id", "book", "ws").where(F.size("ws") > 0)
    content = s.select("id", "book", F.explode("ws").alias("word")).where(~F.col("word").isin(plain))
    lost = content.select("word").distinct().join(known.select("word").where("word IS NOT NULL").distinct(), "word", "left_anti").withColumn("lost", F.lit(1))
    topics = topic_words(verses, k).select("book", "word", F.lit(1).alias("topic"))
    words = content.join(lost, "word", "left").join(topics, ["book", "word"], "left").groupBy("id").agg(F.count("lost").alias("unknown"), F.count("topic").alias("topics"), F.count(F.lit(1)).alias("n_content"))
    pair = lambda df, *keys: df.select(*keys, F.col("ws")).select(*keys, F.explode(F.expr("transform(slice(ws, 1, size(ws) - 1), (w, i) -> concat(w, ' ', ws[i + 1]))")).alias("pair"))
    seen = pair(verses.where(F.size("ws") > 1)).distinct().withColumn("seen", F.lit(1))
    pairs = pair(s.where(F.size("ws") > 1), "id").join(seen, "pair", "left").groupBy("id").agg((F.count("seen") / F.count(F.lit(1))).alias("share"))
    books = verses.select("book").where("book IS NOT NULL").distinct().withColumn("has_book", F.lit(True))
    j = sentences.select("id", "book", F.size("ws").alias("n")).join(words, "id", "left").join(pairs, "id", "left").join(books, "book", "left")
    zero = F.lit(0)
    parts = {
        "word_score": 30 - F.least(F.coalesce("unknown", zero) * 5, F.lit(30)), "phrase_score": F.coalesce("share", F.lit(1.0)) * 30, "structure_score": F.lit(20),
        "book_bonus": F.when(F.col("has_book"), 15 + F.when(F.col("n_content") > 0, 5 * F.col("topics") / F.col("n_content")).otherwise(0)).otherwise(0),
    }
    j = j.select("id", *[F.when(F.col("n") > 0, c).otherwise(0).cast("double").alias(name) for name, c in parts.items()])
    return j.withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(100.0), sum((F.col(c) for c in parts), F.lit(0.0)))))


def override(scores: DataFrame, other: DataFrame) -> DataFrame:
    """``id, score, overridden``: the other score (id, score) where it is larger; rows without one keep theirs."""
    j = scores.select("id", "score").join(other.select("id", F.col("score").alias("_o")), "id", "left")
    return j.select("id", F.greatest("score", "_o").alias("score"), F.coalesce(F.col("_o") > F.col("score"), F.lit(False)).alias("overridden"))


def route(df: DataFrame, text: str, score: Callable[[Column], Column], correct: Callable[[Column], Column], least: float) -> DataFrame:
    """``df`` with ``route, before, after``: ``valid`` from ``least`` on; others are corrected and scored again: ``corrected`` if that is enough, else ``invalid``.

    ``after`` is the score that counts. The rejected are corrected in place: no second pass over the table.
    """
    first, again = score(F.col(text)), score(correct(F.col(text)))
    d = df.withColumn("before", first)
    d = d.withColumn("after", F.when(F.col("before") >= least, F.col("before")).otherwise(again))
    return d.withColumn("route", F.when(F.col("before") >= least, "valid").when(F.col("after") >= least, "corrected").otherwise("invalid"))


def failed_rules(own: Column, named: list[str] | None = None) -> Column:
    """The names of the translation rules that a text fails, sorted; a translation is correct if none fails."""
    names = sorted(named or rules.TRANSLATION_RULES)
    checks = []
    for n in names:
        pattern, wanted = rules.TRANSLATION_RULES[n]
        hit = own.rlike(f"(?s){pattern}")
        checks.append(F.when(~hit if wanted else hit, n))
    return F.array_compact(F.array(*checks))
