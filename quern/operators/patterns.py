"""Pattern matching over text and tokens (inventory K)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import rules
from quern.functions import text as T

# fixed values: named sentence patterns
GRAMMAR = {
    "negation_kei": r"(^|\s)kei(\s|$)", "negation_lo": r"(^|\s)lo(\s|$)", "question": r"(^|\s)hiam(\s|$)", "future": r"(^|\s)ding(\s|$)",
    "agreement_ka": r"(^|\s)ka(\s|$)", "agreement_na": r"(^|\s)na(\s|$)", "statement": r"(^|\s)hi$", "quotation": r"(^|\s)ci(\s|$)",
}


def named_patterns(c: Column, patterns: dict[str, str] | None = None) -> Column:
    """The names of the patterns found in a text, sorted."""
    p = patterns or GRAMMAR
    return F.array_compact(F.array(*[F.when(c.rlike(rx), name) for name, rx in sorted(p.items())]))


def token_patterns(ws: Column) -> Column:
    """K2: patterns by position: SOV (an ``in`` before a final verb ending), negation, agreement, tense; sorted names."""
    last = T.at(ws, -1)
    at = F.array_position(ws, "in")
    checks = {
        "SOV": (at > 0) & (at < F.size(ws) - 1) & last.isin("hi", "hen", "ah"),
        **{f"agreement_{p}": F.array_contains(ws, p) for p in ("ka", "na", "a", "i")},
        **{f"negation_{p}": F.array_contains(ws, p) for p in ("kei", "lo")},
        "future": F.array_contains(ws, "ding"),
        "question": last == "hiam",
    }
    return F.when(F.size(ws) > 0, F.array_compact(F.array(*[F.when(c, k) for k, c in sorted(checks.items())]))).otherwise(F.array().cast("array<string>"))


def sentence_parts(c: Column) -> Column:
    """subject = up to three words ending at the first ``in``; verb = the word before the last verb final; object between."""
    ws = T.words(F.lower(F.regexp_replace(c, "[.,;:!?]", "")))
    s = F.array_position(ws, "in").cast("int")
    finals = F.transform(ws, lambda w: w.isin("hi", "hen", "ah"))
    last = (F.size(ws) + 1 - F.array_position(F.reverse(finals), True)).cast("int")
    has_s, has_v = s > 0, F.array_contains(finals, True) & (last > 1)
    subject = F.when(has_s, F.array_join(F.slice(ws, F.greatest(s - 2, F.lit(1)), F.least(s, F.lit(3))), " "))
    verb = F.when(has_v, F.get(ws, last - 2))
    obj = F.when(has_s & has_v & (last - 1 > s + 1), F.array_join(F.slice(ws, s + 1, last - 2 - s), " "))
    return F.struct(subject.alias("subject"), verb.alias("verb"), obj.alias("object"))


def checks(ws: Column) -> Column:
    """Verdicts on negation, question and verb."""
    last = T.at(ws, -1)
    neg = F.size(F.filter(ws, lambda w: w.isin(rules.NEGATIONS))) > 0
    return F.struct(
        F.when(neg, "negative").otherwise("positive").alias("polarity"),
        F.when(last == "hiam", "question").when(F.array_contains(ws, "hiam"), "misplaced").otherwise("none").alias("question"),
        F.when(last.isin(rules.VERB_ENDINGS), "final").when(F.size(F.filter(ws, lambda w: w.isin(rules.VERB_ENDINGS))) > 0, "inside").otherwise("missing").alias("verb"),
    )


def structure(ws: Column, known: dict[str, str] | None = None) -> Column:
    """Each word as its class (S, in, uh, Q, V, O), equal neighbours collapsed, joined with ``-``."""
    m = known or {**{w: "S" for w in rules.SUBJECT_MARKERS}, "in": "in", "uh": "uh", "hiam": "Q", **{w: "V" for w in ("hi", "ding", "hen")}}
    table = F.create_map(*[F.lit(x) for kv in sorted(m.items()) for x in kv])
    cls = F.transform(ws, lambda w: F.coalesce(T.at(table, w), F.lit("O")))
    folded = F.aggregate(cls, F.array().cast("array<string>"), lambda a, x: F.when(T.at(F.concat(F.array(F.lit("")), a), -1) == x, a).otherwise(F.concat(a, F.array(x))))
    return F.array_join(folded, "-")


def core_structure(c: Column) -> Column:
    """A structure without its O parts."""
    return F.array_join(F.filter(F.split(c, "-"), lambda x: x != "O"), "-")


def discourse(c: Column) -> Column:
    """Sentence count, population variance of sentence lengths, and whether they are parallel (variance under 10)."""
    s = T.sentences(c)
    n = F.size(s)
    lens = F.transform(s, lambda x: F.size(T.words(x)))
    total = F.aggregate(lens, F.lit(0), lambda a, x: a + x)
    squares = F.aggregate(lens, F.lit(0), lambda a, x: a + x * x)
    var = squares / n - (total / n) * (total / n)
    return F.struct(n.alias("n"), F.when(n > 0, F.round(var, 6)).alias("variance"), F.when(n > 0, var < 10).alias("parallel"))


def contrast(ws: Column, verbs: list[str]) -> Column:
    """Word-order class of a sentence: verb-final, verb-medial or verbless."""
    return F.when(T.at(ws, -1).isin(verbs), "SOV").when(F.size(F.filter(ws, lambda w: w.isin(verbs))) > 0, "SVO").otherwise("NONE")


def gloss(df: DataFrame, lexicon: DataFrame, id_col: str, text_col: str, longest: int = 5) -> DataFrame:
    """K9: ``id, gloss``: greedy longest match of phrases of up to ``longest`` words; unknown words as ``?``, texts without words as ``''``.

    ``lexicon``: phrase (unique, lower case, single spaces), gloss; of any size. n-grams are looked up by an equi-join, and the
    greedy walk goes over the hits of one text, which are at most its words. NULL texts give no row, and ids are unique.
    """
    t = df.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), T.words(F.lower(text_col)).alias("ws"))
    spans = F.expr(f"flatten(transform(sequence(1, {longest}), k -> transform(filter(sequence(0, size(ws)), i -> i + k <= size(ws)), i -> struct(i AS i, k AS k, array_join(slice(ws, i + 1, k), ' ') AS phrase))))")
    hits = t.select("id", F.explode(spans).alias("x")).select("id", "x.*").join(lexicon.select("phrase", "gloss"), "phrase")
    best = hits.groupBy("id", "i").agg(F.max(F.struct("k", "gloss")).alias("m"))
    found = best.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("i", "m"))).alias("at"))
    walk = F.expr(
        "aggregate(sequence(0, size(ws)), struct(0 AS free, cast(array() AS array<string>) AS out), (a, i) -> if(i < a.free OR i = size(ws), a, "
        "struct(i + coalesce(try_element_at(at, i).k, 1) AS free, array_append(a.out, coalesce(try_element_at(at, i).gloss, '?')) AS out)), a -> array_join(a.out, ' '))"
    )
    return t.join(found, "id", "left").select("id", walk.alias("gloss"))
