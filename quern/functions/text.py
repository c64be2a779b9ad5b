"""Column -> Column text functions. All but Unicode normalisation and HTML entities stay in the JVM.

Every function maps NULL to NULL unless it says otherwise; no function cuts its input.
"""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quern.functions import rules

MYANMAR = "[က-႟]"


def blank(c: Column) -> Column:
    """NULL, empty or white space, or ``-``."""
    return F.coalesce(F.trim(F.regexp_replace(c, r"\s+", " ")).isin("", "-"), F.lit(True))


def at(c: Column, i: Column | int) -> Column:
    """The element at a 1-based index (from the end if negative) or map key; NULL beyond."""
    return F.try_element_at(c, i if isinstance(i, Column) else F.lit(i))


def nullif_blank(c: Column) -> Column:
    return F.when(~blank(c), c)


def _normal(form: str):
    @F.pandas_udf(StringType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else x if x.isascii() else unicodedata.normalize(form, x))

    return run


nfc, nfkc = _normal("NFC"), _normal("NFKC")


def strip(c: Column) -> Column:
    """White space of any kind off both ends (SQL's trim takes plain spaces only)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    """Runs of white space as one space, trimmed."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def clean_text(c: Column) -> Column:
    """Composed, without Markdown line prefixes and mojibake characters, squeezed."""
    c = F.regexp_replace(nfc(c), r"(?m)^#{1,6}\s+|^\s*[-*•]\s+", "")
    return squeeze(F.regexp_replace(c, "[â€™Ã\u0080-\u009f]", ""))


def clean_web(c: Column) -> Column:
    """URLs, e-mail addresses, phone numbers and emoji replaced or dropped, then as C1."""
    c = F.regexp_replace(c, r"https?://[^\s]+|www\.[^\s]+", "<URL>")
    c = F.regexp_replace(c, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "<EMAIL>")
    c = F.regexp_replace(c, r"\+?[0-9][0-9 ()-]{7,}[0-9]", "<PHONE>")
    return clean_text(F.regexp_replace(c, "[\U0001f300-\U0001faff☀-➿]", ""))


def mask_names(c: Column, gazetteer: dict[str, str]) -> Column:
    """Whole names of a gazetteer replaced by ``[LABEL]``; the longest that fits first.

    Names are taken literally, whatever characters they hold. One pass marks them all, one for each label replaces its own.
    """
    import re

    either = lambda names: "|".join(map(re.escape, sorted(names, key=lambda n: (-len(n), n))))
    named = {n: label for n, label in gazetteer.items() if n}
    if not named:
        return c
    c = F.regexp_replace(c, rf"(?<![\p{{L}}\p{{N}}])({either(named)})(?![\p{{L}}\p{{N}}])", "\x01$1\x01")
    for label in sorted(set(named.values())):
        c = F.regexp_replace(c, f"\x01({either(n for n, x in named.items() if x == label)})\x01", re.sub(r"([\\$])", r"\\\1", f"[{label}]"))
    return c


def nfkc_squeeze(c: Column) -> Column:
    """C4."""
    return squeeze(nfkc(c))


def deep_clean(c: Column) -> Column:
    """Composed, without tags and control characters, straight quotes, runs of 2+ spaces as one."""
    c = F.regexp_replace(nfc(c), "<[^>]+>", "")
    c = F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "")
    c = F.translate(c, "“”‘’", "\"\"''")
    return F.trim(F.regexp_replace(c, r"\s{2,}", " "))


def strip_markup(c: Column) -> Column:
    """Zero-width characters and tags out, squeezed."""
    return squeeze(F.regexp_replace(c, "[​-‍⁠﻿]|<[^>]+>", ""))


def clean_term(c: Column) -> Column:
    """A leading part-of-speech abbreviation, pipes and line breaks out."""
    return squeeze(F.regexp_replace(F.regexp_replace(c, r"(?i)^[a-z]{1,4}\.\s+", ""), r"[|\n]", " "))


@F.pandas_udf(StringType())
def unescape_html(s: pd.Series) -> pd.Series:
    """Character references resolved; unknown ones become an apostrophe."""
    import re

    return s.map(lambda x: None if x is None else re.sub(r"&[#\w]+;", "'", html.unescape(x)))


def strip_punctuation(c: Column) -> Column:
    """C10."""
    return F.regexp_replace(F.trim(c), "[.,;:!?\"'()\\[\\]{}“”‘’…]", "")


def headword(c: Column) -> Column:
    """Quotes and a bracketed tail out, first sentence, at most two words of 2+ characters; NULL if none."""
    c = F.regexp_replace(F.regexp_replace(c, "[\"“”]", ""), r"\s*\([^)]*\)", "")
    first = at(F.split(c, "[.;\\n]"), 1)
    ws = F.slice(F.filter(F.split(F.trim(first), r"\s+"), lambda w: F.length(w) > 1), 1, 2)
    return F.when(F.size(ws) > 0, F.array_join(ws, " "))


def first_json_key(c: Column, keys: list[str]) -> Column:
    """The first of several JSON keys that isn't blank."""
    return F.coalesce(*[nullif_blank(F.get_json_object(c, f"$.{k}")) for k in keys])


def unwrap_list(c: Column) -> Column:
    """A value given as a JSON list becomes its first element, lower case."""
    return F.lower(F.trim(F.when(c.startswith("["), F.get_json_object(c, "$[0]")).otherwise(c)))


def repair_list(c: Column) -> Column:
    """C14: a list given as text; items in Burmese script dropped; NULL if nothing is left."""
    items = F.when(c.startswith("["), F.from_json(c, "array<string>")).otherwise(F.array(c))
    items = F.filter(items, lambda t: t.isNotNull() & ~t.rlike(MYANMAR) & (F.trim(t) != ""))
    return F.when(F.size(items) > 0, items)


def clean_meanings(c: Column, sep: str = ";") -> Column:
    """Meanings of a packed string without bracketed tails, distinct, in order."""
    parts = F.transform(F.split(c, sep), lambda m: F.trim(F.regexp_replace(m, r"\s*\([^)]*\)\s*$", "")))
    return F.array_distinct(F.filter(parts, lambda m: m != ""))


def canonical_dialect(c: Column) -> Column:
    """C16."""
    return F.when((F.lower(c) == "tedim") | (c == "Tedim_Chin"), "Tedim").otherwise(c)


def words(c: Column) -> Column:
    """Words between white space; an empty array for blank text."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), r"\s+"), lambda w: w != "")


def tokens(c: Column, kind: str = "word") -> Column:
    """The tokenizers, lower case. ``latin``: [a-z']; ``latin2``: two or more; ``ext``: Latin with accents,
    apostrophes, and punctuation runs; ``alpha``: [a-z]; ``word``: letters, marks, digits; ``ascii``: as alpha
    with hyphens; ``space``: between white space, outer punctuation off."""
    low = F.lower(F.coalesce(c, F.lit("")))
    pattern = {"latin": r"[a-z']+", "latin2": r"[a-z']{2,}", "ext": r"[a-zà-ɏ']+|[,;:!.?-]+", "alpha": r"[a-z]+", "word": r"[\p{L}\p{M}\p{N}]+", "ascii": r"[a-z][a-z-]*"}
    if kind == "space":
        return F.filter(F.transform(words(low), lambda w: F.regexp_replace(w, "^[.,;:!?\"'()\\[\\]{}]+|[.,;:!?\"'()\\[\\]{}]+$", "")), lambda w: w != "")
    return F.regexp_extract_all(low, F.lit(pattern[kind]), F.lit(0))


def content_words(ts: Column, stop: list[str] | None = None) -> Column:
    """Neither particle nor stopword, longer than one character, not punctuation."""
    out = sorted(set(stop or rules.PARTICLES + rules.STOPWORDS))
    return F.filter(ts, lambda t: ~t.isin(out) & (F.length(t) > 1) & ~t.rlike("^[,;:!.?]"))


def member_count(ws: Column, listed: list[str]) -> Column:
    return F.size(F.filter(ws, lambda w: w.isin(listed)))


def sentences(c: Column, least: int = 0) -> Column:
    """Split at runs of sentence ends and line breaks, trimmed, longer than ``least`` characters."""
    return F.filter(F.transform(F.split(c, "[.!?။\\n]+"), lambda x: F.trim(x)), lambda s: F.length(s) > least)


def replace_forms(c: Column, forms: dict[str, str] | None = None) -> Column:
    """C17: words that equal a form, but for case and outer punctuation, replaced; punctuation and an initial capital kept."""
    forms = forms or rules.FORBIDDEN
    table = F.create_map(*[F.lit(x) for kv in sorted(forms.items()) for x in kv])

    def one(w: Column) -> Column:
        core = F.regexp_extract(w, r"^([^\p{L}\p{N}]*)(.*?)([^\p{L}\p{N}]*)$", 2)
        new = at(table, F.lower(core))
        cased = F.when(core.rlike(r"^\p{Lu}"), F.concat(F.upper(F.substring(new, 1, 1)), new.substr(F.lit(2), F.length(new)))).otherwise(new)
        fixed = F.concat(F.regexp_extract(w, r"^([^\p{L}\p{N}]*)", 1), cased, F.regexp_extract(w, r"([^\p{L}\p{N}]*)$", 1))
        return F.coalesce(fixed, w)

    return F.array_join(F.transform(words(c), one), " ")


def recase(c: Column, names: dict[str, str]) -> Column:
    """Words that equal a proper noun but for case and outer punctuation take its spelling; punctuation kept."""
    return replace_forms(c, {k.lower(): v for k, v in names.items()})


def drop_repeats(ws: Column) -> Column:
    """A word equal to the one before it goes."""
    return F.filter(ws, lambda w, i: (i == 0) | (w != F.get(ws, i - 1)))


def end_with_verb(ws: Column, ending: str = "hi") -> Column:
    """C20: a missing verb ending appended; an empty list stays empty."""
    has = at(ws, -1).isin(rules.VERB_ENDINGS)
    return F.when((F.size(ws) == 0) | has, ws).otherwise(F.concat(ws, F.array(F.lit(ending))))


def verb_last(ws: Column) -> Column:
    """The first verb ending moves to the end."""
    flags = F.transform(ws, lambda w: w.isin(rules.VERB_ENDINGS))
    at = F.array_position(flags, True).cast("int")
    return F.when((at > 0) & (at < F.size(ws)), F.concat(F.slice(ws, F.lit(1), at - 1), F.slice(ws, at + 1, F.size(ws)), F.slice(ws, at, F.lit(1)))).otherwise(ws)


def plural_rule(c: Column) -> Column:
    """``i ... uh`` is doubly plural: the trailing ``uh`` of a clause that begins with ``i`` goes."""
    return F.regexp_replace(c, r"(?i)^(i [^.,;!?]*?) uh( hi)?$", "$1$2")


def verse_parts(ref: Column) -> Column:
    """``BOOK c:v`` as a struct; NULL parts where it doesn't parse."""
    p = r"^([0-9A-Z]{3}) ([0-9]{1,3}):([0-9]{1,3})$"
    get = lambda i: F.nullif(F.regexp_extract(ref, p, i), F.lit(""))
    return F.struct(get(1).alias("book"), get(2).cast("int").alias("chapter"), get(3).cast("int").alias("verse"))


def dotted_ref(c: Column) -> Column:
    """``book.c.v`` as ``BOOK c:v``."""
    p = F.split(c, r"\.")
    return F.when(F.size(p) == 3, F.concat(F.upper(p[0]), F.lit(" "), p[1], F.lit(":"), p[2]))


def stems(w: Column, suffixes: list[str] | None = None, least: int = 3) -> Column:
    """Every form left by cutting one suffix off, at least ``least`` characters, sorted."""
    cut = [F.when(w.endswith(s) & (F.length(w) - len(s) >= least), F.expr("1") * 0 + F.length(w) - len(s)) for s in suffixes or rules.SUFFIXES]
    return F.array_sort(F.array_distinct(F.transform(F.array_compact(F.array(*cut)), lambda n: w.substr(F.lit(1), n))))


def morphology(w: Column) -> Column:
    """Longest prefix, then longest suffix, with at least two characters left."""
    pre = F.coalesce(*[F.when(w.startswith(p) & (F.length(w) > len(p) + 2), F.lit(p)) for p in sorted(rules.PREFIXES, key=lambda p: (-len(p), p))], F.lit(""))
    rest = w.substr(F.length(pre) + 1, F.length(w))
    suf = F.coalesce(*[F.when(rest.endswith(s) & (F.length(rest) > len(s) + 2), F.lit(s)) for s in sorted(rules.SUFFIXES, key=lambda s: (-len(s), s))], F.lit(""))
    return F.struct(pre.alias("prefix"), rest.substr(F.lit(1), F.length(rest) - F.length(suf)).alias("stem"), suf.alias("suffix"))


def syllable_count(w: Column) -> Column:
    """Vowel groups of each hyphenated part."""
    return F.regexp_count(F.lower(w), F.lit("[aeiou]+"))


def pos_by_form(w: Column, gloss: Column) -> Column:
    """By suffix, else by the gloss."""
    return (
        F.when(w.rlike(f"({'|'.join(rules.VERB_SUFFIXES)})$"), "v")
        .when(w.rlike(f"({'|'.join(rules.NOUN_SUFFIXES)})$"), "n")
        .when(gloss.rlike("(?i)^to "), "v")
        .when(gloss.rlike("(?i)^(a|an|the) "), "n")
    )


def pos_by_shape(c: Column) -> Column:
    """C35."""
    return F.when(F.length(c) < 20, "noun").when(c.endswith("ing"), "verb").when(c.endswith("ly"), "adverb").otherwise("phrase")


def by_substring(c: Column, table: list[tuple[str, str]], default: str) -> Column:
    """The label of the first listed substring that the lower-cased text holds."""
    out = None
    for key, label in table:
        hit = F.lower(c).contains(key)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(default)


def level_by_complexity(c: Column) -> Column:
    """By word count and mean word length."""
    n = F.size(words(c))
    mean = F.aggregate(words(c), F.lit(0), lambda a, w: a + F.length(w)) / F.greatest(n, F.lit(1))
    return F.when((n < 5) | (mean < 4), "A1").when(mean < 5, "A2").when(mean < 6, "B1").when(mean < 7, "B2").otherwise("C1")


def language_guess(c: Column) -> Column:
    """Function-word ratios; one language needs twice the other's, else MIXED; NULL-free."""
    ws = tokens(c, "alpha")
    zo, en = member_count(ws, rules.STOPWORDS), member_count(ws, rules.ENGLISH_WORDS)
    return F.when((zo == 0) & (en == 0), "UNKNOWN").when(zo >= en * 2, "ZO").when(en >= zo * 2, "EN").otherwise("MIXED")


def english_like(w: Column) -> Column:
    """C42."""
    return w.isin(rules.ENGLISH_WORDS) | (w.rlike(f"({'|'.join(rules.ENGLISH_SUFFIXES)})$") & (F.length(w) > 4))


def own_ratio(c: Column) -> Column:
    """One minus the share of English-looking words; NULL without words."""
    ws = tokens(c, "alpha")
    return F.when(F.size(ws) > 0, 1 - F.size(F.filter(ws, english_like)) / F.size(ws))


def token_estimate(c: Column) -> Column:
    """C44."""
    return F.floor(F.length(c) / 3)


def difference_class(a: Column, b: Column) -> Column:
    """Same first three letters; near length with two shared letters; else different."""
    shared = F.size(F.array_intersect(F.split(a, ""), F.split(b, "")))
    return F.when(F.substring(a, 1, 3) == F.substring(b, 1, 3), "morphological").when((F.abs(F.length(a) - F.length(b)) <= 2) & (shared >= 2), "cognate").otherwise("different")


def evidence_level(n: Column) -> Column:
    """C49."""
    return F.when(n > 1000, "HIGH").when(n > 100, "MEDIUM").when(n > 10, "LOW").otherwise("UNCERTAIN")


def severity(n: Column, steps: list[tuple[int, str]], least: str) -> Column:
    """The label of the first step that ``n`` is above."""
    out = None
    for limit, label in steps:
        out = F.when(n > limit, label) if out is None else out.when(n > limit, label)
    return out.otherwise(least)


def bump_version(c: Column) -> Column:
    """``vN`` or ``vN.m`` to the next whole version; anything else to ``v2.0``."""
    n = F.regexp_extract(c, r"^v([0-9]+)(\.[0-9]+)?$", 1)
    return F.coalesce(F.when(n != "", F.concat(F.lit("v"), (n.cast("int") + 1).cast("string"), F.lit(".0"))), F.lit("v2.0"))


def level_cascade(ref: Column, source: Column, text: Column, by_book: dict[str, str], by_source: dict[str, str], patterns: list[tuple[str, str]], skip: list[str]) -> Column:
    """SKIP for a listed dialect, else the level of the first book code in the reference, source key (both
    compared in upper case), text pattern, and at last the word count."""
    out = F.when(F.upper(ref).rlike("|".join(skip)), "SKIP") if skip else F.when(F.lit(False), "SKIP")
    for book, level in by_book.items():
        out = out.when(F.contains(F.upper(ref), F.lit(book)), level)
    for key, level in by_source.items():
        out = out.when(F.contains(F.upper(source), F.lit(key)), level)
    for rx, level in patterns:
        out = out.when(text.rlike(rx), level)
    n = F.size(words(text))
    return out.when(n > 20, "B1").when(n > 8, "A2").otherwise("A1")


def level_by_frequency(n: Column, book_no: Column) -> Column:
    """By frequency or the place of the first book."""
    return F.when((n > 5000) | (book_no <= 5), "A1").when(n > 1000, "A2").when(n > 100, "B1").when(n > 10, "B2").when(n > 1, "C1").otherwise("C2")


def marker_class(ws: Column, markers: dict[str, list[str]], default: str = "general") -> Column:
    """The class with most marker words; ties to the smaller name; the default without any."""
    scored = F.array(*[F.struct((-member_count(ws, ms)).alias("s"), F.lit(k).alias("name")) for k, ms in sorted(markers.items())])
    best = F.array_min(scored)
    return F.when(best["s"] < 0, best["name"]).otherwise(default)


def conversation_label(c: Column) -> Column:
    """Greeting, question, exclamation, request, self or statement, the first that fits."""
    t = F.lower(c)
    return (
        F.when(t.rlike(r"^(hello|damna|zingsang)( |$)"), "greeting").when(t.rlike(r"(\?|(^| )hiam[.?!]*)$"), "question").when(t.rlike("!$"), "exclamation")
        .when(t.rlike(r"(^| )(in|un)[.]*$"), "request").when(t.rlike(r"^(ka|kei) "), "self").otherwise("statement")
    )


def envelope(sources: list[Column], version: str, made_at: Column) -> Column:
    """Provenance as a struct; sources that are NULL are left out."""
    return F.struct(F.array_compact(F.array(*sources)).alias("sources"), F.lit(version).alias("version"), made_at.alias("made_at"))


def strip_controls(c: Column) -> Column:
    """Control characters out, but line breaks and tabs."""
    return F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")


def conditional_rewrite(c: Column, old: str, new: str, marker: str) -> Column:
    """``old`` replaced only in texts that hold the marker pattern."""
    return F.when(c.rlike(marker), F.replace(c, F.lit(old), F.lit(new))).otherwise(c)


def lyric_lines(c: Column, title: Column, k: int = 3) -> Column:
    """The first lines that are neither the title, a section header nor blank."""
    ls = F.transform(F.split(c, "\n"), lambda x: F.trim(x))
    return F.slice(F.filter(ls, lambda x: (x != "") & (F.lower(x) != F.lower(F.trim(title))) & ~x.rlike(r"(?i)^(verse|chorus|bridge)\b.*$")), 1, k)


def script_senses(c: Column, sep: str = ";") -> Column:
    """The senses of a packed gloss that hold Burmese script."""
    return F.filter(F.transform(F.split(c, sep), lambda x: F.trim(x)), lambda x: x.rlike(MYANMAR))


def json_answer(c: Column, keys: list[str]) -> Column:
    """P5: the first JSON object of an answer, without code fences, as a struct of strings; NULL fields if there is none."""
    body = F.regexp_extract(F.regexp_replace(c, r"```[a-z]*", ""), r"(?s)(\{.*?\})", 1)
    return F.struct(*[F.get_json_object(body, f"$.{k}").alias(k) for k in keys])


def bad_answer(c: Column, least: int = 8) -> Column:
    """Too short, a verse reference, a bare name, a short lower-case phrase, or crawl metadata."""
    t = F.trim(c)
    return (
        (F.length(t) < least) | t.rlike(r"^[0-9]+:[0-9]+") | t.rlike("^[A-Z][a-z]+ [A-Z][a-z]+$") | (t.rlike("^[a-z][a-z ]+$") & (F.length(t) < 30)) | t.rlike('"depth"\\s*:|"url"\\s*:|<[a-z]+>')
    )
