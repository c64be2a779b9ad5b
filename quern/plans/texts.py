"""Queries over the text functions (inventory C) and the record filters (inventory D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import rules
from quern.functions import text as T
from quern.operators import filters
from quern.plans.registry import query
from quern.session import table, texts

STOP = rules.sql_array(rules.STOPWORDS)
ENDINGS = rules.sql_list(rules.VERB_ENDINGS)
CONTENT_OUT = rules.sql_list(sorted(set(rules.PARTICLES + rules.STOPWORDS)))
_DENIED = "(?i)(^|[^\\p{L}\\p{M}\\p{N}_])(" + "|".join(rules.DENIED_FORMS) + ")($|[^\\p{L}\\p{M}\\p{N}_])"
_WS = "list_filter(string_split_regex(coalesce({c}, ''), '\\s+'), lambda w: w <> '')"


def ws(c: str) -> str:
    return _WS.replace("{c}", c)


@query(
    r"""SELECT doc_id,
  trim(regexp_replace(regexp_replace(regexp_replace(nfc_normalize(text), '(?m)^#{1,6}\s+|^\s*[-*•]\s+', '', 'g'), '[â€™Ã\x{80}-\x{9f}]', '', 'g'), '\s+', ' ', 'g')) AS cleaned,
  trim(regexp_replace(translate(regexp_replace(regexp_replace(nfc_normalize(text), '<[^>]+>', '', 'g'), '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g'), '“”‘’', '""' || chr(39) || chr(39)), '\s{2,}', ' ', 'g')) AS deep,
  trim(regexp_replace(regexp_replace(text, '[\x{200b}-\x{200d}\x{2060}\x{feff}]|<[^>]+>', '', 'g'), '\s+', ' ', 'g')) AS bare
FROM documents"""
)
def text_clean(spark, d):
    return texts(spark, d, "documents", "doc_id", "text").select("doc_id", T.clean_text(F.col("text")).alias("cleaned"), T.deep_clean(F.col("text")).alias("deep"), T.strip_markup(F.col("text")).alias("bare"))


@query(
    r"""SELECT id, trim(regexp_replace(regexp_replace(regexp_replace(nfc_normalize(regexp_replace(regexp_replace(regexp_replace(regexp_replace(content,
  'https?://[^\s]+|www\.[^\s]+', '<URL>', 'g'), '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}', '<EMAIL>', 'g'), '\+?[0-9][0-9 ()-]{7,}[0-9]', '<PHONE>', 'g'),
  '[\x{1f300}-\x{1faff}\x{2600}-\x{27bf}]', '', 'g')), '(?m)^#{1,6}\s+|^\s*[-*•]\s+', '', 'g'), '[â€™Ã\x{80}-\x{9f}]', '', 'g'), '\s+', ' ', 'g')) AS cleaned
FROM wiki_content"""
)
def text_clean_web(spark, d):
    return table(spark, d, "wiki_content").select("id", T.clean_web(F.col("content")).alias("cleaned"))


@query()
def text_nfkc(spark, d):
    return table(spark, d, "bible_verses_enhanced").select("id", T.nfkc_squeeze(F.col("zolai_text")).alias("normal"), T.unescape_html(F.col("english_text")).alias("english"))


@query(
    r"""SELECT id, trim(regexp_replace(regexp_replace(regexp_replace(concat_ws(' ', pos, english), '(?i)^[a-z]{1,4}\.\s+', '', 'g'), '[|\n]', ' ', 'g'), '\s+', ' ', 'g')) AS term,
  regexp_replace(trim(zolai), '[.,;:!?"' || chr(39) || '()\[\]{}“”‘’…]', '', 'g') AS bare,
  CASE WHEN len(hw) > 0 THEN array_to_string(hw, ' ') END AS headword,
  list_filter(ms, lambda m, i: list_position(ms, m) = i) AS meanings,
  CASE WHEN english IS NULL THEN NULL WHEN length(english) < 20 THEN 'noun' WHEN ends_with(english, 'ing') THEN 'verb' WHEN ends_with(english, 'ly') THEN 'adverb' ELSE 'phrase' END AS pos_shape,
  CASE WHEN regexp_matches(zolai, '(sak|thei|nak|lo)$') THEN 'v' WHEN regexp_matches(zolai, '(na|pi|te|pa|nu)$') THEN 'n' WHEN regexp_matches(english, '(?i)^to ') THEN 'v' WHEN regexp_matches(english, '(?i)^(a|an|the) ') THEN 'n' END AS pos_form,
  substr(english, 1, 12) AS short
FROM (SELECT *, list_filter(string_split_regex(trim(string_split_regex(regexp_replace(regexp_replace(english, '["“”]', '', 'g'), '\s*\([^)]*\)', '', 'g'), '[.;\n]')[1]), '\s+'), lambda w: length(w) > 1)[1:2] AS hw,
  list_filter(list_transform(string_split(english, ';'), lambda m: trim(regexp_replace(m, '\s*\([^)]*\)\s*$', ''))), lambda m: m <> '') AS ms FROM dictionary_enhanced)"""
)
def dictionary_terms(spark, d):
    """C8, C10, C11, C15, C34, C35 over all entries: repeated meanings once, in order; NULL where there is no english."""
    return _terms(table(spark, d, "dictionary_enhanced"))


def _terms(t):
    return t.select(
        "id",
        T.clean_term(F.concat_ws(" ", "pos", "english")).alias("term"),
        T.strip_punctuation(F.col("zolai")).alias("bare"),
        T.headword(F.col("english")).alias("headword"),
        T.clean_meanings(F.col("english")).alias("meanings"),
        F.when(F.col("english").isNotNull(), T.pos_by_shape(F.col("english"))).alias("pos_shape"),
        T.pos_by_form(F.col("zolai"), F.col("english")).alias("pos_form"),
        F.when(F.length("english") > 12, F.substring("english", 1, 12)).otherwise(F.col("english")).alias("short"),
    )


@query(
    r"""SELECT id, coalesce(nullif(trim(json_extract_string(raw_json, '$.word')), ''), nullif(trim(json_extract_string(raw_json, '$.headword')), '')) AS json_headword,
  lower(trim(json_extract_string(raw_json, '$.english'))) AS json_english,
  CASE WHEN regexp_matches(entry_version, '^v[0-9]+(\.[0-9]+)?$') THEN 'v' || (regexp_extract(entry_version, '^v([0-9]+)', 1)::INT + 1) || '.0' ELSE 'v2.0' END AS next_version
FROM entries"""
)
def entries_json(spark, d):
    return table(spark, d, "entries").select(
        "id",
        T.first_json_key(F.col("raw_json"), ["word", "headword"]).alias("json_headword"),
        T.unwrap_list(F.get_json_object("raw_json", "$.english")).alias("json_english"),
        T.bump_version(F.col("entry_version")).alias("next_version"),
    )


@query(
    rf"""SELECT doc_id, len(regexp_extract_all(t, '[a-z'']+')) AS latin, len(regexp_extract_all(t, '[a-z'']{{2,}}')) AS latin2,
  len(regexp_extract_all(t, '[a-zà-ɏ'']+|[,;:!.?-]+')) AS ext, len(regexp_extract_all(t, '[a-z]+')) AS alpha,
  len(regexp_extract_all(t, '[\p{{L}}\p{{M}}\p{{N}}]+')) AS word, len(regexp_extract_all(t, '[a-z][a-z-]*')) AS ascii,
  len(list_filter(list_transform({ws("t")}, lambda w: regexp_replace(w, '^[.,;:!?"''()\[\]{{}}]+|[.,;:!?"''()\[\]{{}}]+$', '', 'g')), lambda w: w <> '')) AS space,
  len(list_filter(regexp_extract_all(t, '[a-zà-ɏ'']+|[,;:!.?-]+'), lambda w: w NOT IN {CONTENT_OUT} AND length(w) > 1 AND NOT regexp_matches(w, '^[,;:!.?]'))) AS content,
  length(text) // 3 AS token_estimate
FROM (SELECT *, lower(coalesce(text, '')) AS t FROM documents)"""
)
def token_counts(spark, d):
    t = F.col("text")
    kinds = ["latin", "latin2", "ext", "alpha", "word", "ascii", "space"]
    cols = [F.size(T.tokens(t, k)).alias(k) for k in kinds]
    return texts(spark, d, "documents", "doc_id", "text").select("doc_id", *cols, F.size(T.content_words(T.tokens(t, "ext"))).alias("content"), T.token_estimate(t).alias("token_estimate"))


@query(
    r"""SELECT doc_id, i AS sentence_no, s[i] AS sentence, CASE WHEN regexp_matches(s[i], '(?i)(^| )(leh|hang|cih)( |$)') THEN len(regexp_extract_all(' ' || lower(s[i]) || ' ', ' (leh|hang|cih) ')) + 1 ELSE 1 END AS n_clauses
FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM (
  SELECT doc_id, list_filter(list_transform(string_split_regex(text, '[.!?။\n]+'), lambda x: trim(x)), lambda x: length(x) > 10) AS s FROM documents WHERE text IS NOT NULL))"""
)
def sentence_rows(spark, d):
    """Sentences with their ordinal, and how many clauses conjunctions make of each."""
    s = table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.posexplode(T.sentences(F.col("text"), 10)).alias("i", "sentence"))
    padded = F.concat(F.lit(" "), F.lower("sentence"), F.lit(" "))
    clauses = F.when(F.col("sentence").rlike("(?i)(^| )(leh|hang|cih)( |$)"), F.regexp_count(padded, F.lit(" (leh|hang|cih) ")) + 1).otherwise(1)
    return s.select("doc_id", (F.col("i") + 1).cast("bigint").alias("sentence_no"), "sentence", clauses.cast("bigint").alias("n_clauses"))


@query(
    r"""WITH v AS (SELECT id, lower(trim(zolai)) AS w FROM zolai_vocabulary WHERE zolai IS NOT NULL),
s AS (SELECT *, list_sort(list_distinct(list_transform(list_filter(['te','in','na','ah','pa','nu','un','uh'], lambda x: ends_with(w, x) AND length(w) - length(x) >= 3), lambda x: left(w, length(w) - length(x))))) AS stems,
 CASE WHEN w LIKE 'ka%' AND length(w) > 4 THEN 'ka' WHEN w LIKE 'ki%' AND length(w) > 4 THEN 'ki' WHEN w LIKE 'na%' AND length(w) > 4 THEN 'na' WHEN w LIKE 'a%' AND length(w) > 3 THEN 'a' WHEN w LIKE 'i%' AND length(w) > 3 THEN 'i' ELSE '' END AS prefix FROM v),
r AS (SELECT *, substr(w, length(prefix) + 1) AS rest FROM s),
x AS (SELECT *, coalesce(list_sort(list_filter(['te','in','na','ah','pa','nu','un','uh'], lambda y: ends_with(rest, y) AND length(rest) > 4))[1], '') AS suffix FROM r)
SELECT id, stems, prefix, left(rest, length(rest) - length(suffix)) AS stem, suffix, len(regexp_extract_all(w, '[aeiou]+')) AS syllables FROM x"""
)
def word_morphology(spark, d):
    v = table(spark, d, "zolai_vocabulary").where("zolai IS NOT NULL").select("id", F.lower(F.trim("zolai")).alias("w"))
    m = T.morphology(F.col("w"))
    return v.select("id", T.stems(F.col("w")).alias("stems"), m["prefix"].alias("prefix"), m["stem"].alias("stem"), m["suffix"].alias("suffix"), T.syllable_count(F.col("w")).alias("syllables"))


_LANG = rf"""len(list_filter(a, lambda w: list_contains({STOP}, w))) AS zo, len(list_filter(a, lambda w: w IN {rules.sql_list(rules.ENGLISH_WORDS)})) AS en"""


@query(
    rf"""WITH t AS (SELECT doc_id, source, text, {ws("text")} AS w, regexp_extract_all(lower(coalesce(text, '')), '[a-z]+') AS a FROM documents),
u AS (SELECT *, {_LANG}, len(w) AS n, CASE WHEN len(w) = 0 THEN 0 ELSE list_sum(list_transform(w, lambda x: length(x))) / greatest(len(w), 1) END AS mean FROM t)
SELECT doc_id,
  CASE WHEN contains(lower(source), 'news') THEN 'news' WHEN contains(lower(source), 'song') THEN 'song' WHEN contains(lower(source), 'school') THEN 'lesson' ELSE 'corpus' END AS source_type,
  CASE WHEN n < 5 OR mean < 4 THEN 'A1' WHEN mean < 5 THEN 'A2' WHEN mean < 6 THEN 'B1' WHEN mean < 7 THEN 'B2' ELSE 'C1' END AS level,
  CASE WHEN zo = 0 AND en = 0 THEN 'UNKNOWN' WHEN zo >= en * 2 THEN 'ZO' WHEN en >= zo * 2 THEN 'EN' ELSE 'MIXED' END AS guess,
  CASE WHEN len(a) > 0 THEN round(1 - len(list_filter(a, lambda x: x IN {rules.sql_list(rules.ENGLISH_WORDS)} OR (regexp_matches(x, '({"|".join(rules.ENGLISH_SUFFIXES)})$') AND length(x) > 4))) / len(a), 6) END AS own_ratio
FROM u"""
)
def document_labels(spark, d):
    """C36, C37, C41-C43."""
    t = F.col("text")
    kinds = [("news", "news"), ("song", "song"), ("school", "lesson")]
    return texts(spark, d, "documents", "doc_id", "source", "text").select(
        "doc_id",
        T.by_substring(F.coalesce("source", F.lit("")), kinds, "corpus").alias("source_type"),
        T.level_by_complexity(t).alias("level"),
        T.language_guess(t).alias("guess"),
        F.round(T.own_ratio(t), 6).alias("own_ratio"),
    )


@query(
    f"""WITH l AS (SELECT guess, lang, count(*) AS n FROM (
  SELECT lang, CASE WHEN zo = 0 AND en = 0 THEN 'UNKNOWN' WHEN zo >= en * 2 THEN 'ZO' WHEN en >= zo * 2 THEN 'EN' ELSE 'MIXED' END AS guess
  FROM (SELECT lang, {_LANG} FROM (SELECT lang, regexp_extract_all(lower(coalesce(text, '')), '[a-z]+') AS a FROM documents))) GROUP BY 1, 2)
SELECT * FROM l"""
)
def language_confusion(spark, d):
    """C41 against the stored label."""
    return table(spark, d, "documents").groupBy(T.language_guess(F.col("text")).alias("guess"), "lang").agg(F.count(F.lit(1)).alias("n"))


@query(
    rf"""WITH v AS (SELECT id, {ws("zolai_text")} AS w FROM bible_verses_enhanced WHERE zolai_text IS NOT NULL),
x AS (SELECT id, w, list_filter(range(1, len(w) + 1), lambda i: w[i] IN {ENDINGS})[1] AS k FROM v)
SELECT id, array_to_string([w[i] FOR i IN range(1, len(w) + 1) IF i = 1 OR w[i] <> w[i - 1]], ' ') AS no_repeats,
  array_to_string(CASE WHEN len(w) = 0 OR w[-1] IN {ENDINGS} THEN w ELSE list_append(w, 'hi') END, ' ') AS ended,
  array_to_string(CASE WHEN k IS NOT NULL AND k < len(w) THEN list_append(list_concat(w[1:k - 1], w[k + 1:]), w[k]) ELSE w END, ' ') AS verb_last
FROM x"""
)
def verse_rewrites(spark, d):
    """C19-C21."""
    v = texts(spark, d, "bible_verses_enhanced", "id", "zolai_text", "english_text").where("zolai_text IS NOT NULL").select("id", T.words(F.col("zolai_text")).alias("w"))
    w = F.col("w")
    return v.select("id", F.array_join(T.drop_repeats(w), " ").alias("no_repeats"), F.array_join(T.end_with_verb(w), " ").alias("ended"), F.array_join(T.verb_last(w), " ").alias("verb_last"))


def _case(forms: dict[str, str]) -> str:
    return " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in sorted(forms.items()))


FORMS = {"hi": "ahi", "lo": "kei", "the": "that"}


@query(
    rf"""WITH t AS (SELECT doc_id, {ws("text")} AS w FROM documents),
e AS (SELECT doc_id, i, w[i] AS x, regexp_extract(w[i], '^([^\p{{L}}\p{{N}}]*)(.*?)([^\p{{L}}\p{{N}}]*)$', 2) AS core FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM t)),
f AS (SELECT doc_id, i, x, core, CASE lower(core) {_case(FORMS)} END AS new FROM e),
g AS (SELECT doc_id, i, new, CASE WHEN new IS NULL THEN x ELSE regexp_extract(x, '^([^\p{{L}}\p{{N}}]*)', 1) || CASE WHEN regexp_matches(core, '^\p{{Lu}}') THEN upper(left(new, 1)) || substr(new, 2) ELSE new END || regexp_extract(x, '([^\p{{L}}\p{{N}}]*)$', 1) END AS y FROM f),
j AS (SELECT doc_id, string_agg(y, ' ' ORDER BY i) AS fixed, count(new) AS n_fixed FROM g GROUP BY 1)
SELECT d.doc_id, coalesce(fixed, '') AS fixed, coalesce(n_fixed, 0) AS n_fixed FROM documents d LEFT JOIN j USING (doc_id)"""
)
def form_replacement(spark, d):
    """C17, C18 with a rule table as parameter, and how many words it changed."""
    t = texts(spark, d, "documents", "doc_id", "text")
    cores = F.transform(T.words(F.col("text")), lambda w: F.lower(F.regexp_extract(w, r"^([^\p{L}\p{N}]*)(.*?)([^\p{L}\p{N}]*)$", 2)))
    return t.select("doc_id", T.replace_forms(F.col("text"), FORMS).alias("fixed"), T.member_count(cores, sorted(FORMS)).cast("bigint").alias("n_fixed"))


@query(
    """WITH c AS (SELECT book, chapter, max(verse) AS ceiling FROM bible_verses_enhanced WHERE source_version = 'ed001' GROUP BY 1, 2),
r AS (SELECT id, book || ' ' || chapter || ':' || verse AS ref FROM bible_verses_enhanced),
p AS (SELECT id, ref, regexp_extract(ref, '^([0-9A-Z]{3}) ', 1) AS b, regexp_extract(ref, ' ([0-9]+):', 1)::INT AS ch, regexp_extract(ref, ':([0-9]+)$', 1)::INT AS v FROM r)
SELECT p.id, ref, coalesce(v BETWEEN 1 AND ceiling, false) AS valid FROM p LEFT JOIN c ON c.book = b AND c.chapter = ch"""
)
def verse_validity(spark, d):
    """References against a chapter table; here the ceilings of one edition."""
    v = table(spark, d, "bible_verses_enhanced")
    ceilings = v.where("source_version = 'ed001'").groupBy("book", "chapter").agg(F.max("verse").alias("ceiling"))
    refs = v.select("id", F.format_string("%s %d:%d", "book", "chapter", "verse").alias("ref"))
    return filters.valid_refs(refs, "ref", ceilings).select("id", "ref", "valid")


@query(
    """SELECT id, CASE WHEN left(zolai, 3) = left(root_word, 3) THEN 'morphological'
  WHEN abs(length(zolai) - length(root_word)) <= 2 AND len(list_distinct(list_intersect(string_split(zolai, ''), string_split(root_word, '')))) >= 2 THEN 'cognate' ELSE 'different' END AS kind,
  CASE WHEN frequency_corpus > 1000 THEN 'HIGH' WHEN frequency_corpus > 100 THEN 'MEDIUM' WHEN frequency_corpus > 10 THEN 'LOW' ELSE 'UNCERTAIN' END AS evidence,
  CASE WHEN frequency_corpus > 50 THEN 'HIGH' WHEN frequency_corpus > 10 THEN 'MEDIUM' ELSE 'LOW' END AS severity, floor(confidence * 10) / 10 AS bucket
FROM zolai_vocabulary WHERE root_word IS NOT NULL"""
)
def word_classes(spark, d):
    """C47, C49-C51."""
    v = table(spark, d, "zolai_vocabulary").where("root_word IS NOT NULL")
    n = F.col("frequency_corpus")
    return v.select(
        "id", T.difference_class(F.col("zolai"), F.col("root_word")).alias("kind"), T.evidence_level(n).alias("evidence"),
        T.severity(n, [(50, "HIGH"), (10, "MEDIUM")], "LOW").alias("severity"), (F.floor(F.col("confidence") * 10) / 10).alias("bucket"),
    )


@query(
    rf"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(trim(text), '') AS s, dialect, {ws("text")} AS w FROM documents)
SELECT doc_id, regexp_matches(text, '{_DENIED}') AS forbidden, length(s) >= 8 AS long_enough, regexp_matches(text, 'â€|Ã[\x{{80}}-\x{{bf}}]|Â') AS mojibake,
  starts_with(s, '###') OR starts_with(s, '[INST]') AS marker, coalesce(dialect IN ('FCL', 'HCL06'), false) AS bad_dialect,
  length(s) >= 20 AND NOT ends_with(s, '#') AND NOT (contains(s, '###') AND length(s) < 50) AND NOT regexp_matches(s, 'https?://') AS valid_record,
  length(s) > 1000 AS too_long, regexp_matches(s, '^[0-9\s.,]+$') AS numbers_only, length(s) // 3 <= 512 AS in_budget, regexp_matches(text, '[က-႟]') AS burmese,
  len(w) BETWEEN 3 AND 12 AS verse_sized, regexp_matches(s, '^[A-Z][a-z]+ [A-Z][a-z]+$') AS bare_name
FROM t"""
)
def document_flags(spark, d):
    """D1-D16, D24, D28 as boolean columns of one pass."""
    return texts(spark, d, "documents", "doc_id", "text", "dialect").select("doc_id", *filters.flags(F.col("text"), F.col("dialect")))


_REASON = rf"""WITH t AS (SELECT doc_id, text, trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) AS s, dialect FROM documents),
r AS (SELECT doc_id, s, CASE WHEN starts_with(s, '###') OR starts_with(s, '[INST]') THEN 'marker' WHEN regexp_matches(s, 'â€|Ã[\x{{80}}-\x{{bf}}]|Â') THEN 'encoding'
  WHEN regexp_matches(s, '{_DENIED}') OR dialect IN ('FCL', 'HCL06') THEN 'dialect' WHEN length(s) < 20 THEN 'short' END AS reason FROM t),
k AS (SELECT doc_id, CASE WHEN reason IS NULL AND row_number() OVER (PARTITION BY reason IS NULL, s ORDER BY doc_id) > 1 THEN 'duplicate' ELSE coalesce(reason, 'kept') END AS reason FROM r)"""


@query(_REASON + "SELECT doc_id, reason FROM k")
def clean_reasons(spark, d):
    """The first reason that drops a record, in order, duplicates among the rest last."""
    return filters.clean_with_reasons(texts(spark, d, "documents", "doc_id", "text", "dialect"), "doc_id", "text", "dialect").select("doc_id", "reason")


@query(_REASON + "SELECT reason, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct FROM k GROUP BY 1")
def clean_summary(spark, d):
    """D4, G31."""
    return filters.reason_summary(filters.clean_with_reasons(texts(spark, d, "documents", "doc_id", "text", "dialect"), "doc_id", "text", "dialect"))


@query(
    rf"""WITH v AS (SELECT id, trim(coalesce(zolai_text, '')) AS zo, trim(coalesce(english_text, '')) AS en FROM bible_verses_enhanced),
w AS (SELECT *, {ws("lower(en)")} AS e FROM v)
SELECT id, CASE WHEN zo IN ('', '-') OR en IN ('', '-') THEN 'empty' WHEN lower(zo) = lower(en) THEN 'same' WHEN length(zo) < 5 OR length(en) < 5 THEN 'short'
  WHEN len(list_filter(e, lambda x: list_contains({STOP}, x))) > 0.3 * len(e) THEN 'untranslated' ELSE 'kept' END AS reason FROM w"""
)
def pair_reasons(spark, d):
    """Why a translation pair is dropped."""
    t = texts(spark, d, "bible_verses_enhanced", "id", "zolai_text", "english_text")
    return t.select("id", filters.pair_reason(F.col("zolai_text"), F.col("english_text")).alias("reason"))


@query(
    r"""SELECT id, CASE WHEN zolai IS NULL OR trim(zolai) IN ('', '-') THEN 'blank' WHEN length(zolai) > 80 THEN 'long' WHEN regexp_matches(trim(zolai), '^[0-9]+$') THEN 'numeric'
  WHEN NOT regexp_matches(zolai, '^[a-zA-Z\s-]+$') THEN 'charset' WHEN english IS NULL OR trim(english) IN ('', '-') THEN 'untranslated'
  WHEN regexp_matches(english, '[က-႟]') THEN 'swapped' ELSE 'kept' END AS reason, coalesce(regexp_matches(zolai, '^[a-z][a-z-]*$'), false) AS lower_word,
  coalesce(ends_with(zolai, '''') OR (starts_with(zolai, '''') AND length(zolai) <= 4), false) AS fragment
FROM dictionary_enhanced"""
)
def entry_reasons(spark, d):
    """Why a dictionary entry is dropped."""
    t = table(spark, d, "dictionary_enhanced")
    z = F.col("zolai")
    fragment = F.coalesce(z.endswith("'") | (z.startswith("'") & (F.length(z) <= 4)), F.lit(False))
    return t.select("id", filters.entry_reason(z, F.col("english")).alias("reason"), F.coalesce(z.rlike("^[a-z][a-z-]*$"), F.lit(False)).alias("lower_word"), fragment.alias("fragment"))


@query(
    rf"""SELECT doc_id, CASE WHEN regexp_matches(text, '[က-႟]') THEN 'burmese' WHEN regexp_matches(lower(text), '(^|[^\p{{L}}])({"|".join(rules.GERMAN_WORDS)})($|[^\p{{L}}])') THEN 'german'
  WHEN regexp_matches(text, '{_DENIED}') THEN 'forbidden' WHEN en > 0.4 * n THEN 'english_heavy' WHEN zo > 0 THEN 'confirmed' ELSE 'unclassified' END AS purity
FROM (SELECT doc_id, text, len(a) AS n, {_LANG} FROM (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(lower(coalesce(text, '')), '[a-z]+') AS a FROM documents))"""
)
def purity_classes(spark, d):
    """D7, D27, D30."""
    return texts(spark, d, "documents", "doc_id", "text").select("doc_id", filters.purity(F.col("text")).alias("purity"))
