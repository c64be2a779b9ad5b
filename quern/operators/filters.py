"""Record filters with recorded reasons (inventory D)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import rules
from quern.functions import text as T

DENIED = rules.word_pattern(rules.DENIED_FORMS)
MOJIBAKE = "â€|Ã[\u0080-¿]|Â"
# fixed values: marks of other dialects, their connectors, and contexts in which they are only talked about
DIALECT_DENY = r"(?i)\b(pasian|topa|kumpipa|nunnak|zalenna)\b|(^|[^\w])tua\b|\b(falam|hakha|mizo|lushei)\s+(pau|dialect|chin|language|version|bible|text|script)\b"
DIALECT_CONNECTORS = r"(?i)\b(cule|cutikah)\b"
DIALECT_EXPLAIN = r"(?i)(never use|do not use|forbidden|incorrect|wrong|avoid|hakha|falam)"
DIALECT_QUOTE = r"(?i)zalenna.*cih|zalenna.*policy|zalenna.*thukhu"


def first_reason(cases: list[tuple[str, Column]], kept: str = "kept") -> Column:
    """The name of the first predicate that holds; order is meaning, so it is one chain."""
    out = None
    for name, cond in cases:
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out.otherwise(kept)


def with_reason(df: DataFrame, cases: list[tuple[str, Column]]) -> DataFrame:
    """``df`` with a ``reason`` column."""
    return df.withColumn("reason", first_reason(cases))


def reason_summary(df: DataFrame) -> DataFrame:
    """Rows and share of each reason; only one row per reason is windowed."""
    n = df.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("pct", F.round(F.lit(100.0) * F.col("n") / F.sum("n").over(Window.partitionBy()), 2))


def clean_with_reasons(df: DataFrame, id_col: str, text_col: str, dialect_col: str, least: int = 20) -> DataFrame:
    """Marker, encoding, dialect, short, duplicate (of a kept record with a smaller id) or kept.

    Later copies are found by one aggregate per digest, not by a window over each group of copies.
    """
    s = T.squeeze(F.coalesce(F.col(text_col), F.lit("")))
    df = df.withColumn("s", s)
    cases = [
        ("marker", F.col("s").startswith("###") | F.col("s").startswith("[INST]")),
        ("encoding", F.col("s").rlike(MOJIBAKE)),
        ("dialect", F.col("s").rlike(DENIED) | F.coalesce(F.col(dialect_col).isin(rules.BAD_DIALECTS), F.lit(False))),
        ("short", F.length("s") < least),
    ]
    df = with_reason(df, cases).withColumn("digest", F.md5("s"))
    firsts = df.where("reason = 'kept'").groupBy("digest").agg(F.min(id_col).alias("first_id"))
    df = df.join(firsts, "digest", "left")
    again = (F.col("reason") == "kept") & (F.col(id_col) > F.col("first_id"))
    return df.withColumn("reason", F.when(again, "duplicate").otherwise(F.col("reason"))).drop("s", "digest", "first_id")


def dialect_reasons(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, reason`` of texts that aren't blank: dialect, connector, duplicate (of a kept text with a smaller id) or kept."""
    t = df.select(id_col, F.trim(text_col).alias("t")).where("t <> ''")
    plain = ~F.col("t").rlike(DIALECT_EXPLAIN)
    t = with_reason(t, [("dialect", F.col("t").rlike(DIALECT_DENY) & plain & ~F.col("t").rlike(DIALECT_QUOTE)), ("connector", F.col("t").rlike(DIALECT_CONNECTORS) & plain)])
    t = t.select(id_col, "reason", F.md5("t").alias("d"))
    first = t.where("reason = 'kept'").groupBy("d").agg(F.min(id_col).alias("first"))
    j = t.join(first, "d", "left")
    return j.select(id_col, F.when((F.col("reason") == "kept") & (F.col(id_col) > F.col("first")), "duplicate").otherwise(F.col("reason")).alias("reason"))


def line_flags(text: Column, markers: list[str], denied: list[str]) -> list[Column]:
    """D7, D14, D15, D27 as named booleans: no other language's function word and a marker inside; a denied substring; noise; a line of the language."""
    t, low = F.coalesce(text, F.lit("")), F.lower(F.coalesce(text, F.lit("")))
    holds = lambda xs: F.exists(F.array(*[F.lit(x) for x in xs]), lambda x: F.contains(low, x))
    other = low.rlike(rf"(^|[^\p{{L}}])({'|'.join(rules.ENGLISH_WORDS + rules.GERMAN_WORDS)})($|[^\p{{L}}])")
    return [
        (~other & holds(markers)).alias("own_marker"),
        holds(denied).alias("denied"),
        ((F.length(F.trim(t)) < 3) | F.ltrim(low).rlike(r"^(###|\[inst\]|<s>|<!doctype)")).alias("noise"),
        (~t.rlike(r"^\s*(#|https?://|[0-9]+\s*$)") & (t.rlike(T.MYANMAR) | (T.member_count(T.tokens(text, "alpha"), rules.STOPWORDS) >= 2))).alias("own_line"),
    ]


def english_headword(low: Column) -> Column:
    """A lower-case word that is English by list, suffix (over four letters) or consonant cluster."""
    return low.isin(rules.ENGLISH_WORDS) | ((F.length(low) > 4) & low.rlike(f"({'|'.join(rules.ENGLISH_SUFFIXES)})$")) | low.rlike("(str|spl|scr|thr|shr|ght|tch|ck|qu|x)")


def flags(text: Column, dialect: Column) -> list[Column]:
    """D1-D3, D5, D6, D8, D12-D16, D24, D28 as named booleans, false on NULL where the text decides."""
    t = F.coalesce(text, F.lit(""))
    s = F.trim(t)
    n = F.size(T.words(text))
    return [
        t.rlike(DENIED).alias("forbidden"),
        (F.length(s) >= 8).alias("long_enough"),
        t.rlike(MOJIBAKE).alias("mojibake"),
        (s.startswith("###") | s.startswith("[INST]")).alias("marker"),
        F.coalesce(dialect.isin(rules.BAD_DIALECTS), F.lit(False)).alias("bad_dialect"),
        ((F.length(s) >= 20) & ~s.endswith("#") & ~(s.contains("###") & (F.length(s) < 50)) & ~s.rlike("https?://")).alias("valid_record"),
        (F.length(s) > 1000).alias("too_long"),
        s.rlike(r"^[0-9\s.,]+$").alias("numbers_only"),
        (F.floor(F.length(s) / 3) <= 512).alias("in_budget"),
        t.rlike(T.MYANMAR).alias("burmese"),
        n.between(3, 12).alias("verse_sized"),
        s.rlike("^[A-Z][a-z]+ [A-Z][a-z]+$").alias("bare_name"),
    ]


def pair_reason(own: Column, other: Column) -> Column:
    """Empty, same, short, untranslated (over 30 % function words of the other language) or kept."""
    a, b = F.trim(F.coalesce(own, F.lit(""))), F.trim(F.coalesce(other, F.lit("")))
    e = T.words(F.lower(b))
    return first_reason(
        [
            ("empty", a.isin("", "-") | b.isin("", "-")),
            ("same", F.lower(a) == F.lower(b)),
            ("short", (F.length(a) < 5) | (F.length(b) < 5)),
            ("untranslated", T.member_count(e, rules.STOPWORDS) > F.lit(0.3) * F.size(e)),
        ]
    )


def entry_reason(word: Column, gloss: Column) -> Column:
    """Blank, long, numeric, charset, untranslated, swapped or kept."""
    return first_reason(
        [
            ("blank", T.blank(word)),
            ("long", F.length(word) > 80),
            ("numeric", F.trim(word).rlike("^[0-9]+$")),
            ("charset", ~word.rlike(r"^[a-zA-Z\s-]+$")),
            ("untranslated", T.blank(gloss)),
            ("swapped", gloss.rlike(T.MYANMAR)),
        ]
    )


def purity(text: Column) -> Column:
    """Burmese, german, forbidden, english_heavy (over 40 %), confirmed (any marker), unclassified."""
    t = F.coalesce(text, F.lit(""))
    a = T.tokens(text, "alpha")
    return first_reason(
        [
            ("burmese", t.rlike(T.MYANMAR)),
            ("german", F.lower(t).rlike(rf"(^|[^\p{{L}}])({'|'.join(rules.GERMAN_WORDS)})($|[^\p{{L}}])")),
            ("forbidden", t.rlike(DENIED)),
            ("english_heavy", T.member_count(a, rules.ENGLISH_WORDS) > F.lit(0.4) * F.size(a)),
            ("confirmed", T.member_count(a, rules.STOPWORDS) > 0),
        ],
        "unclassified",
    )


def valid_refs(df: DataFrame, ref_col: str, ceilings: DataFrame) -> DataFrame:
    """``df`` with ``valid``: the reference parses and its verse is within ``ceilings`` (book, chapter, ceiling)."""
    p = df.withColumn("_p", T.verse_parts(F.col(ref_col)))
    c = ceilings.select(F.col("book").alias("_b"), F.col("chapter").alias("_c"), F.col("ceiling").alias("_n"))
    p = p.join(c, (F.col("_p.book") == F.col("_b")) & (F.col("_p.chapter") == F.col("_c")), "left")
    return p.withColumn("valid", F.coalesce(F.col("_p.verse").between(1, F.col("_n")), F.lit(False))).drop("_p", "_b", "_c", "_n")


def guard_refs(df: DataFrame, ref_col: str, ceilings: DataFrame) -> DataFrame:
    """``df`` unless it holds an impossible reference: then an error before anything is written."""
    bad = valid_refs(df, ref_col, ceilings).where("NOT valid").limit(1).count()
    if bad:
        raise ValueError("impossible references: nothing is written")
    return df
