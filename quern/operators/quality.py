"""Quality features, scores and audits (inventory J)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import rules
from quern.functions import text as T

WEIGHTS = {"word_count": 0.15, "char_repetition": 0.05, "word_repetition": 0.05, "special_chars": 0.10, "stopwords": 0.10, "language_id": 0.25, "perplexity": 0.20, "flagged_words": 0.10}


def char_repetition(c: Column) -> Column:
    """Runs of three or more of one character per ten characters, at most 1; 0 under four characters."""
    return F.when(F.length(c) < 4, 0.0).otherwise(F.least(F.regexp_count(c, F.lit(r"(.)\1{2,}")) / F.greatest(F.length(c) / 10, F.lit(1.0)), F.lit(1.0)))


def special_chars(c: Column) -> Column:
    """Share of characters that are neither letter, digit nor white space."""
    return F.when(F.length(c) == 0, 0.0).otherwise(F.regexp_count(c, F.lit(r"[^\p{L}\p{N}\s]")) / F.length(c))


def language_id(c: Column) -> Column:
    """0.4 x Burmese share + 0.3 x pattern share + 0.3 for a mean word length of 3 to 8."""
    low = F.lower(c)
    hits = sum((low.contains(p).cast("int") for p in rules.LANGUAGE_PATTERNS), F.lit(0))
    ws = T.words(c)
    mean = F.aggregate(ws, F.lit(0), lambda a, w: a + F.length(w)) / F.greatest(F.size(ws), F.lit(1))
    score = F.regexp_count(c, F.lit(T.MYANMAR)) / F.length(c) * 0.4 + hits / len(rules.LANGUAGE_PATTERNS) * 0.3 + F.when((F.size(ws) > 0) & mean.between(3, 8), 0.3).otherwise(0.0)
    return F.when(F.length(c) == 0, 0.0).otherwise(F.least(score, F.lit(1.0)))


def entropy(low: Column) -> Column:
    """Character entropy of a lower-cased text in bits, 0 if empty.

    Each distinct character is counted by what its removal takes off the length: no row per
    character and no shuffle, and the work is linear in the text for the few characters it has.
    """
    chars = F.filter(F.array_distinct(F.split(low, "")), lambda c: c != "")
    counts = F.transform(chars, lambda c: (F.length(low) - F.length(F.replace(low, c, F.lit("")))).cast("double"))
    n = F.greatest(F.length(low), F.lit(1))
    return F.log2(n.cast("double")) - F.aggregate(counts, F.lit(0.0), lambda a, c: a + c * F.log2(c)) / n


def word_repetition(ws: Column) -> Column:
    """Share of distinct words that occur more than once; 0 under three words. Sorted neighbours, no nested scan."""
    s = F.array_sort(ws)
    runs = F.aggregate(
        s,
        F.struct(F.lit("").alias("prev"), F.lit(0).alias("run"), F.lit(0).alias("repeated"), F.lit(0).alias("distinct")),
        lambda a, w: F.struct(
            w.alias("prev"),
            F.when(a["prev"] == w, a["run"] + 1).otherwise(1).alias("run"),
            F.when((a["prev"] == w) & (a["run"] == 1), a["repeated"] + 1).otherwise(a["repeated"]).alias("repeated"),
            F.when(a["prev"] == w, a["distinct"]).otherwise(a["distinct"] + 1).alias("distinct"),
        ),
    )
    return F.when(F.size(ws) < 3, 0.0).otherwise(runs["repeated"] / F.greatest(runs["distinct"], F.lit(1)))


def features(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The eight features of each text; NULL counts as empty."""
    t = df.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    t = t.withColumn("_w", T.words(F.col("_t"))).withColumn("_l", T.words(F.lower("_t")))
    n = F.greatest(F.size("_l"), F.lit(1))
    low = t.select("*", F.lower("_t").alias("_low"))
    perplexity = F.when(F.length("_t") < 10, 1.0).otherwise(F.least(entropy(F.col("_low")) / 6.0, F.lit(1.0)))
    return low.select(
        id_col,
        F.size("_w").alias("word_count"),
        char_repetition(F.col("_t")).alias("char_repetition"),
        word_repetition(F.col("_w")).alias("word_repetition"),
        special_chars(F.col("_t")).alias("special_chars"),
        (T.member_count(F.col("_l"), rules.STOPWORDS) / n).alias("stopwords"),
        language_id(F.col("_t")).alias("language_id"),
        (T.member_count(F.col("_l"), rules.DENIED_FORMS) / n).alias("flagged_words"),
        perplexity.alias("perplexity"),
    )


def score() -> Column:
    """The weighted score of the eight feature columns."""
    norm = F.least(F.greatest((F.col("word_count") - 10) / 490.0, F.lit(0.0)), F.lit(1.0))
    good = {"word_count": norm, "stopwords": F.col("stopwords"), "language_id": F.col("language_id")}
    return reduce(lambda a, b: a + b, [F.lit(w) * good.get(k, 1 - F.col(k)) for k, w in WEIGHTS.items()])


def sentence_score(own: Column, other: Column) -> Column:
    """0 to 100 with penalties, and the names of what was found, as a struct."""
    strip = lambda ws: F.transform(ws, lambda w: F.regexp_replace(w, "^[.,;:!?\"'()\\[\\]{}]+|[.,;:!?\"'()\\[\\]{}]+$", ""))
    zo, en = strip(T.words(F.lower(own))), strip(T.words(F.lower(other)))
    forms = sorted(rules.FORBIDDEN)
    bad, bad_en = T.member_count(zo, forms), T.member_count(en, forms)
    has_verb = T.member_count(zo, rules.VERB_ENDINGS) > 0
    subject = F.size(F.filter(zo, lambda w: w.isin(rules.SUBJECT_MARKERS + ["in"]) | ((F.length(w) > 2) & ~w.isin(rules.VERB_ENDINGS)))) > 0
    raw = T.words(F.lower(own))
    at = F.array_position(F.transform(raw, lambda w: w.isin(rules.VERB_ENDINGS)), True)
    order = (F.size(raw) >= 3) & (at > 0) & (at < F.size(raw) - 1)
    n, m = F.size(raw), F.size(T.words(other))
    checks = [
        ("forbidden", bad > 0, F.least(F.lit(40), bad * 20)),
        ("forbidden_other", bad_en > 0, F.lit(10)),
        ("no_verb", ~has_verb, F.lit(15)),
        ("no_subject", ~subject, F.lit(15)),
        ("order", order, F.lit(5)),
        ("short", n < 2, F.lit(10)),
        ("long", n > 15, F.lit(5)),
        ("no_translation", m == 0, F.lit(10)),
        ("short_translation", m == 1, F.lit(5)),
    ]
    lost = sum((F.when(c, p).otherwise(0) for _, c, p in checks), F.lit(0))
    issues = F.array_compact(F.array(*[F.when(c, k) for k, c, _ in checks]))
    return F.struct(F.greatest(F.lit(0), 100 - lost).alias("score"), issues.alias("issues"))


def violations(own: Column, forms: dict[str, str]) -> Column:
    """Forbidden words with their correction and two words of context on either side; an array of structs."""
    table = F.create_map(*[F.lit(x) for kv in sorted(forms.items()) for x in kv])
    raw = F.col("_raw")
    found = F.filter(
        F.transform(
            raw,
            lambda w, i: F.struct(
                F.regexp_replace(w, "^[.,;:!?\"'()\\[\\]{}]+|[.,;:!?\"'()\\[\\]{}]+$", "").alias("form"),
                F.array_join(F.slice(raw, F.greatest(i - 1, F.lit(1)), F.least(i + 3, F.lit(5))), " ").alias("context"),
            ),
        ),
        lambda x: x["form"].isin(sorted(forms)),
    )
    return F.transform(found, lambda x: F.struct(x["form"].alias("form"), T.at(table, x["form"]).alias("correct"), x["context"].alias("context")))


def find_violations(df: DataFrame, id_col: str, text_col: str, forms: dict[str, str] | None = None) -> DataFrame:
    """J12 as rows: ``id, form, correct, context``."""
    t = df.select(id_col, T.words(F.lower(text_col)).alias("_raw"))
    return t.select(id_col, F.explode(violations(F.col("_raw"), forms or rules.FORBIDDEN)).alias("v")).select(id_col, "v.*")


def form_scan(df: DataFrame, text_col: str, forms: dict[str, str]) -> DataFrame:
    """Per rule the rows that hold its form as a substring, in one pass over the table."""
    names = sorted(forms)
    a = df.agg(*[F.count_if(F.col(text_col).contains(k)).alias(f"c{i}") for i, k in enumerate(names)])
    return a.select(F.explode(F.array(*[F.struct(F.lit(k).alias("form"), F.col(f"c{i}").alias("n")) for i, k in enumerate(names)])).alias("x")).select("x.*")


def expectations(checks: list[tuple[str, DataFrame, float]]) -> DataFrame:
    """``check_name, value, least, ok`` of (name, one-row table, least value)."""
    return reduce(DataFrame.unionAll, [t.select(F.lit(n).alias("check_name"), F.col(t.columns[0]).cast("double").alias("value"), F.lit(float(least)).alias("least")) for n, t, least in checks]).withColumn("ok", F.col("value") >= F.col("least"))


def gap_audit(counts: DataFrame, known: DataFrame) -> DataFrame:
    """Words (word, n) that ``known`` (word) lacks, with the severity of the gap."""
    k = known.where("word IS NOT NULL").select("word").distinct()
    return counts.join(k, "word", "left_anti").withColumn("severity", T.severity(F.col("n"), [(50, "HIGH"), (10, "MEDIUM")], "LOW"))


def cohesion(sents: Column, connectors: list[str]) -> Column:
    """``connectors, reuse, chain, score`` of an array of sentences, which isn't empty.

    Connector words for each sentence, the share of distinct words that occur again, and the mean overlap of neighbour
    sentences (shared words by the smaller set); the score caps half the first at 0.3, the second at 0.3, the third at 0.4.
    """
    ws = F.transform(sents, lambda s: F.regexp_extract_all(F.lower(s), F.lit("[a-z'’]+"), F.lit(0)))
    sets = F.transform(ws, lambda w: F.array_distinct(w))
    n, every = F.size(sents), F.sort_array(F.flatten(ws))
    conn = T.member_count(every, connectors) / n
    # in sorted order a word that occurs again has an equal neighbour, and its first copy none before it
    again = F.size(F.filter(every, lambda w, i: ((i == 0) | (F.get(every, i - 1) != w)) & (F.get(every, i + 1) == w)))
    reuse = F.when(F.size(every) > 0, again / F.size(F.array_distinct(every))).otherwise(0.0)
    overlap = lambda a, b: F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.least(F.size(a), F.size(b))).otherwise(0.0)
    pairs = F.transform(F.slice(sets, F.lit(1), F.greatest(n - 1, F.lit(0))), lambda a, i: overlap(a, F.get(sets, i + 1)))
    chain = F.when(n > 1, F.aggregate(pairs, F.lit(0.0), lambda x, y: x + y) / (n - 1)).otherwise(0.0)
    score = F.least(conn / 2, F.lit(0.3)) + F.least(reuse, F.lit(0.3)) + F.least(chain, F.lit(0.4))
    return F.struct(conn.alias("connectors"), reuse.alias("reuse"), chain.alias("chain"), score.alias("score"))


def nearest_profile(df: DataFrame, id_col: str, dims: list[str], profiles: dict[str, list[float]]) -> DataFrame:
    """``id, profile, likeness``: the profile with the highest mean of 1 - |difference| over the dimensions; ties to the smaller name."""
    like = lambda vs: sum((1 - F.abs(F.col(c) - v) for c, v in zip(dims, vs)), F.lit(0.0)) / len(dims)
    scored = F.array(*[F.struct((-F.round(like(vs), 9)).alias("s"), F.lit(name).alias("name"), like(vs).alias("likeness")) for name, vs in sorted(profiles.items())])
    best = F.array_min(scored)
    return df.select(id_col, best["name"].alias("profile"), F.round(best["likeness"], 6).alias("likeness"))
