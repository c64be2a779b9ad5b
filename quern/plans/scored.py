"""Queries over quality, audits and patterns (inventories J, K)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import rules
from quern.functions import text as T
from quern.operators import patterns, quality
from quern.plans.registry import query
from quern.session import table, texts

W = "list_filter(string_split_regex(coalesce({0}, ''), '\\s+'), lambda w: w <> '')"
A = "regexp_extract_all(lower(coalesce({0}, '')), '[a-z]+')"
STRIP = "regexp_replace(w, '^[.,;:!?\"''()\\[\\]{{}}]+|[.,;:!?\"''()\\[\\]{{}}]+$', '', 'g')".replace("{{", "{").replace("}}", "}")
_L = lambda ws: rules.sql_list(ws)
_RUNS = "|".join(f"{c}{c}{c}+" for c in "abcdefghijklmnopqrstuvwxyz") + "|" + "|".join(rf"\{c}\{c}\{c}+" for c in ".-!?=_*#")

_FEATURES = rf"""t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, {W.format('t')} AS w, {W.format('lower(t)')} AS l FROM t),
c AS (SELECT doc_id, count(*) AS n, ch FROM (SELECT doc_id, unnest(string_split(lower(t), '')) AS ch FROM t) WHERE ch <> '' GROUP BY doc_id, ch),
e AS (SELECT doc_id, log2(sum(n)) - sum(n * log2(n)) / sum(n) AS entropy FROM c GROUP BY 1),
r AS (SELECT doc_id, count(*) FILTER (k > 1) / count(*) AS rep FROM (SELECT doc_id, x, count(*) AS k FROM (SELECT doc_id, unnest(w) AS x FROM w) GROUP BY 1, 2) GROUP BY 1),
f AS (SELECT w.doc_id, len(w) AS word_count, CASE WHEN len(w) < 3 THEN 0 ELSE coalesce(rep, 0) END AS word_repetition,
  CASE WHEN length(t) = 0 THEN 0 ELSE len(regexp_extract_all(t, '[^\p{{L}}\p{{N}}\s]')) / length(t) END AS special_chars,
  len(list_filter(l, lambda x: x IN {_L(rules.STOPWORDS)})) / greatest(len(l), 1) AS stopwords,
  CASE WHEN length(t) = 0 THEN 0 ELSE least(1, len(regexp_extract_all(t, '[က-႟]')) / length(t) * 0.4 + ({" + ".join(f"contains(lower(t), '{p}')::INT" for p in rules.LANGUAGE_PATTERNS)}) / {len(rules.LANGUAGE_PATTERNS)} * 0.3
    + CASE WHEN len(w) > 0 AND list_sum(list_transform(w, lambda x: length(x))) / len(w) BETWEEN 3 AND 8 THEN 0.3 ELSE 0 END) END AS language_id,
  len(list_filter(l, lambda x: x IN {_L(rules.DENIED_FORMS)})) / greatest(len(l), 1) AS flagged_words,
  CASE WHEN length(t) < 10 THEN 1 ELSE least(1, coalesce(entropy, 0) / 6) END AS perplexity,
  CASE WHEN length(t) < 4 THEN 0 ELSE least(1, len(regexp_extract_all(t, '{_RUNS}')) / greatest(length(t) / 10, 1)) END AS char_repetition
  FROM w LEFT JOIN e USING (doc_id) LEFT JOIN r USING (doc_id))"""


def _features(spark, d):
    return quality.features(texts(spark, d, "documents", "doc_id", "text"), "doc_id", "text")


NAMES = ["char_repetition", "word_repetition", "special_chars", "stopwords", "language_id", "flagged_words", "perplexity"]


@query(f"WITH {_FEATURES} SELECT doc_id, word_count, {', '.join(f'round({c}, 6) AS {c}' for c in NAMES)} FROM f")
def quality_features(spark, d):
    return _features(spark, d).select("doc_id", "word_count", *[F.round(c, 6).alias(c) for c in NAMES])


_SCORE = "0.15 * least(1, greatest(0, (word_count - 10) / 490)) + 0.05 * (1 - char_repetition) + 0.05 * (1 - word_repetition) + 0.10 * (1 - special_chars) + 0.10 * stopwords + 0.25 * language_id + 0.20 * (1 - perplexity) + 0.10 * (1 - flagged_words)"


@query(f"WITH {_FEATURES} SELECT doc_id, round({_SCORE}, 5) AS score, {_SCORE} >= 0.5 AS kept FROM f")
def quality_scores(spark, d):
    """J8, J9."""
    s = _features(spark, d).select("doc_id", quality.score().alias("s"))
    return s.select("doc_id", F.round("s", 5).alias("score"), (F.col("s") >= 0.5).alias("kept"))


@query(f"WITH {_FEATURES}, s AS (SELECT {_SCORE} AS s FROM f) SELECT (CASE WHEN s >= 0.8 THEN 0.8 WHEN s >= 0.6 THEN 0.6 WHEN s >= 0.4 THEN 0.4 WHEN s >= 0.2 THEN 0.2 ELSE 0.0 END)::DOUBLE AS bin, count(*) AS n FROM s GROUP BY 1")
def quality_histogram(spark, d):
    """G27, H13."""
    from quern.operators import stats

    return stats.histogram(_features(spark, d).select(quality.score().alias("s")), "s", [0.0, 0.2, 0.4, 0.6, 0.8])


_SENT = rf"""v AS (SELECT id, list_transform({W.format("lower(zolai_text)")}, lambda w: {STRIP}) AS z, list_transform({W.format("lower(english_text)")}, lambda w: {STRIP}) AS e, {W.format("lower(zolai_text)")} AS raw, {W.format("english_text")} AS m FROM bible_verses_enhanced),
k AS (SELECT id, len(list_filter(z, lambda x: x IN {_L(sorted(rules.FORBIDDEN))})) AS bad, len(list_filter(e, lambda x: x IN {_L(sorted(rules.FORBIDDEN))})) AS bad_en,
 len(list_filter(z, lambda x: x IN {_L(rules.VERB_ENDINGS)})) = 0 AS no_verb, len(list_filter(z, lambda x: x IN {_L(rules.SUBJECT_MARKERS + ['in'])} OR (length(x) > 2 AND x NOT IN {_L(rules.VERB_ENDINGS)}))) = 0 AS no_subject,
 len(raw) >= 3 AND coalesce(list_filter(range(1, len(raw) + 1), lambda i: raw[i] IN {_L(rules.VERB_ENDINGS)})[1] < len(raw) - 1, false) AS ord, len(raw) AS n, len(m) AS m FROM v)"""


@query(
    f"""WITH {_SENT} SELECT id, greatest(0, 100 - least(40, bad * 20) - CASE WHEN bad_en > 0 THEN 10 ELSE 0 END - CASE WHEN no_verb THEN 15 ELSE 0 END - CASE WHEN no_subject THEN 15 ELSE 0 END - CASE WHEN ord THEN 5 ELSE 0 END
 - CASE WHEN n < 2 THEN 10 WHEN n > 15 THEN 5 ELSE 0 END - CASE WHEN m = 0 THEN 10 WHEN m = 1 THEN 5 ELSE 0 END) AS score,
 list_filter([CASE WHEN bad > 0 THEN 'forbidden' END, CASE WHEN bad_en > 0 THEN 'forbidden_other' END, CASE WHEN no_verb THEN 'no_verb' END, CASE WHEN no_subject THEN 'no_subject' END, CASE WHEN ord THEN 'order' END, CASE WHEN n < 2 THEN 'short' END, CASE WHEN n > 15 THEN 'long' END,
 CASE WHEN m = 0 THEN 'no_translation' END, CASE WHEN m = 1 THEN 'short_translation' END], lambda x: x IS NOT NULL) AS issues FROM k"""
)
def sentence_scores(spark, d):
    """J10, J11."""
    v = texts(spark, d, "bible_verses_enhanced", "id", "zolai_text", "english_text")
    return v.select("id", quality.sentence_score(F.coalesce("zolai_text", F.lit("")), F.coalesce("english_text", F.lit(""))).alias("s")).select("id", "s.*")


_CORRECT = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in sorted(rules.FORBIDDEN.items()))


@query(
    rf"""WITH v AS (SELECT doc_id, {W.format("lower(text)")} AS r FROM documents), i AS (SELECT doc_id, r, unnest(range(1, len(r) + 1)) AS i FROM v),
x AS (SELECT doc_id, r, i, list_transform([r[i]], lambda w: {STRIP})[1] AS form FROM i)
SELECT doc_id, form, CASE form {_CORRECT} END AS correct, array_to_string(r[greatest(i - 2, 1):i + 2], ' ') AS context FROM x WHERE form IN {_L(sorted(rules.FORBIDDEN))}"""
)
def rule_violations(spark, d):
    """J12."""
    return quality.find_violations(table(spark, d, "documents"), "doc_id", "text")


@query(" UNION ALL ".join(f"SELECT '{k}' AS form, count(*) AS n FROM bible_verses_enhanced WHERE contains(zolai_text, '{k}')" for k in sorted(rules.FORBIDDEN)))
def form_scan(spark, d):
    """J32."""
    return quality.form_scan(table(spark, d, "bible_verses_enhanced"), "zolai_text", rules.FORBIDDEN)


@query(
    f"""SELECT id, zolai, CASE WHEN lower(trim(zolai)) IN {_L(sorted(rules.FORBIDDEN))} THEN 'failed' ELSE 'passed' END AS status,
 CASE lower(trim(zolai)) {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in sorted(rules.FORBIDDEN.items()))} END AS correction FROM zolai_vocabulary"""
)
def compliance_status(spark, d):
    """A whole headword equal to a forbidden form."""
    m = F.create_map(*[F.lit(x) for kv in sorted(rules.FORBIDDEN.items()) for x in kv])
    w = F.lower(F.trim("zolai"))
    return table(spark, d, "zolai_vocabulary").select("id", "zolai", F.when(w.isin(sorted(rules.FORBIDDEN)), "failed").otherwise("passed").alias("status"), F.try_element_at(m, w).alias("correction"))


@query(
    f"""WITH c AS (SELECT word, count(*) AS n FROM (SELECT unnest({A.format('zolai_text')}) AS word FROM bible_verses_enhanced) GROUP BY 1)
SELECT word, n, CASE WHEN n > 50 THEN 'HIGH' WHEN n > 10 THEN 'MEDIUM' ELSE 'LOW' END AS severity FROM c WHERE word NOT IN (SELECT lower(trim(zolai)) FROM zolai_vocabulary WHERE zolai IS NOT NULL)"""
)
def vocabulary_gaps(spark, d):
    """J23, J25, J26, I5."""
    c = table(spark, d, "bible_verses_enhanced").select(F.explode(T.tokens(F.col("zolai_text"), "alpha")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return quality.gap_audit(c, table(spark, d, "zolai_vocabulary").select(F.lower(F.trim("zolai")).alias("word")))


@query(
    """SELECT check_name, value::DOUBLE AS value, least::DOUBLE AS least, value >= least AS ok FROM (
 SELECT 'verses' AS check_name, count(*) AS value, 1000 AS least FROM bible_verses_enhanced UNION ALL
 SELECT 'books', count(DISTINCT book), 66 FROM bible_verses_enhanced UNION ALL
 SELECT 'burmese_share', round(count(*) FILTER (trim(coalesce(myanmar_text, '')) NOT IN ('', '-')) / count(*), 6), 0.5 FROM bible_verses_enhanced)"""
)
def integration_checks(spark, d):
    """J29, J30, J35."""
    v = table(spark, d, "bible_verses_enhanced")
    share = v.agg(F.round(F.count_if(~T.blank(F.col("myanmar_text"))) / F.count(F.lit(1)), 6))
    return quality.expectations([("verses", v.agg(F.count(F.lit(1))), 1000), ("books", v.agg(F.countDistinct("book")), 66), ("burmese_share", share, 0.5)])


@query(
    """SELECT id, CASE WHEN length(zolai) = 1 THEN 'single_char' WHEN regexp_matches(zolai, '[0-9]') THEN 'has_number' WHEN frequency_bible > 0 THEN 'in_bible' WHEN coalesce(frequency_corpus, 0) < 5 THEN 'rare' ELSE 'common' END AS kind FROM zolai_vocabulary"""
)
def dictionary_audit(spark, d):
    """J27."""
    k = F.when(F.length("zolai") == 1, "single_char").when(F.col("zolai").rlike("[0-9]"), "has_number").when(F.col("frequency_bible") > 0, "in_bible").when(F.coalesce("frequency_corpus", F.lit(0)) < 5, "rare").otherwise("common")
    return table(spark, d, "zolai_vocabulary").select("id", k.alias("kind"))


@query(
    f"""WITH w AS (SELECT DISTINCT unnest({A.format('content')}) AS w FROM wiki_content), k AS (SELECT DISTINCT lower(trim(zolai)) AS w FROM zolai_vocabulary WHERE zolai IS NOT NULL)
SELECT (SELECT count(*) FROM w) AS wiki_words, (SELECT count(*) FROM w WHERE w IN (SELECT w FROM k)) AS in_vocabulary, (SELECT count(*) FROM k WHERE w IN (SELECT w FROM w)) AS vocabulary_used, (SELECT count(*) FROM k) AS vocabulary_words"""
)
def wiki_reconciliation(spark, d):
    """Coverage both ways from one full join."""
    w = table(spark, d, "wiki_content").select(F.explode(T.tokens(F.col("content"), "alpha")).alias("w")).distinct().withColumn("a", F.lit(1))
    k = table(spark, d, "zolai_vocabulary").where("zolai IS NOT NULL").select(F.lower(F.trim("zolai")).alias("w")).distinct().withColumn("b", F.lit(1))
    j = w.join(k, "w", "full")
    both = F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull())
    return j.agg(F.count("a").alias("wiki_words"), both.alias("in_vocabulary"), both.alias("vocabulary_used"), F.count("b").alias("vocabulary_words"))


_TP = rf"""WITH v AS (SELECT id, {A.format('zolai_text')} AS w FROM bible_verses_enhanced WHERE zolai_text IS NOT NULL)"""
_HAS = "list_contains(w, '{0}')"


@query(
    _TP
    + " SELECT id, list_filter([CASE WHEN coalesce(list_position(w, 'in'), 0) > 0 AND list_position(w, 'in') < len(w) - 1 AND w[-1] IN ('hi', 'hen', 'ah') THEN 'SOV' END,"
    + ", ".join(f"CASE WHEN {_HAS.format(p)} THEN 'agreement_{p}' END" for p in ("a", "i", "ka", "na"))
    + f", CASE WHEN {_HAS.format('ding')} THEN 'future' END, "
    + ", ".join(f"CASE WHEN {_HAS.format(p)} THEN 'negation_{p}' END" for p in ("kei", "lo"))
    + ", CASE WHEN w[-1] = 'hiam' THEN 'question' END], lambda x: x IS NOT NULL) AS found FROM v"
)
def token_grammar(spark, d):
    """K2."""
    v = table(spark, d, "bible_verses_enhanced").where("zolai_text IS NOT NULL").select("id", T.tokens(F.col("zolai_text"), "alpha").alias("w"))
    return v.select("id", patterns.token_patterns(F.col("w")).alias("found"))


@query(
    "WITH v AS (SELECT lower(zolai_text) AS t FROM bible_verses_enhanced), p AS ("
    + " UNION ALL ".join(f"SELECT '{n}' AS pattern, count(*) FILTER (regexp_matches(t, '{rx}')) AS n FROM v" for n, rx in sorted(patterns.GRAMMAR.items()))
    + ") SELECT pattern, n, CASE WHEN n >= 10 THEN 'HIGH' ELSE 'LOW' END AS confidence FROM p WHERE n > 0"
)
def grammar_counts(spark, d):
    """K1, K3, K6, G15."""
    v = table(spark, d, "bible_verses_enhanced").select(F.explode(patterns.named_patterns(F.lower("zolai_text"))).alias("pattern"))
    n = v.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("confidence", F.when(F.col("n") >= 10, "HIGH").otherwise("LOW"))


@query(
    _TP
    + rf""" SELECT id, CASE WHEN len(list_filter(w, lambda x: x IN {_L(rules.NEGATIONS)})) > 0 THEN 'negative' ELSE 'positive' END AS polarity,
 CASE WHEN w[-1] = 'hiam' THEN 'question' WHEN list_contains(w, 'hiam') THEN 'misplaced' ELSE 'none' END AS question,
 CASE WHEN w[-1] IN {_L(rules.VERB_ENDINGS)} THEN 'final' WHEN len(list_filter(w, lambda x: x IN {_L(rules.VERB_ENDINGS)})) > 0 THEN 'inside' ELSE 'missing' END AS verb FROM v"""
)
def grammar_checks(spark, d):
    """K5, J37."""
    v = table(spark, d, "bible_verses_enhanced").where("zolai_text IS NOT NULL").select("id", T.tokens(F.col("zolai_text"), "alpha").alias("w"))
    return v.select("id", patterns.checks(F.col("w")).alias("c")).select("id", "c.*")


_CLS = "CASE WHEN x IN ('ka', 'na', 'a', 'i', 'ki') THEN 'S' WHEN x = 'in' THEN 'in' WHEN x = 'uh' THEN 'uh' WHEN x = 'hiam' THEN 'Q' WHEN x IN ('hi', 'ding', 'hen') THEN 'V' ELSE 'O' END"


@query(
    _TP
    + f""", c AS (SELECT id, list_transform(w, lambda x: {_CLS}) AS c FROM v), k AS (SELECT id, [c[i] FOR i IN range(1, len(c) + 1) IF i = 1 OR c[i] <> c[i - 1]] AS k FROM c)
SELECT id, array_to_string(k, '-') AS structure, array_to_string(list_filter(k, lambda x: x <> 'O'), '-') AS core FROM k"""
)
def sentence_structures(spark, d):
    """J14, J15, H8."""
    v = table(spark, d, "bible_verses_enhanced").where("zolai_text IS NOT NULL").select("id", T.tokens(F.col("zolai_text"), "alpha").alias("w"))
    s = v.select("id", patterns.structure(F.col("w")).alias("structure"))
    return s.select("id", "structure", patterns.core_structure(F.col("structure")).alias("core"))


@query(
    rf"""WITH v AS (SELECT id, {W.format("lower(regexp_replace(zolai_text, '[.,;:!?]', '', 'g'))")} AS w FROM bible_verses_enhanced WHERE zolai_text IS NOT NULL),
p AS (SELECT id, w, coalesce(list_position(w, 'in'), 0) AS s, coalesce(list_max(list_filter(range(1, len(w) + 1), lambda i: w[i] IN ('hi', 'hen', 'ah'))), 0) AS k FROM v)
SELECT id, CASE WHEN s > 0 THEN array_to_string(w[greatest(s - 2, 1):s], ' ') END AS subject, CASE WHEN k > 1 THEN w[k - 1] END AS verb,
 CASE WHEN s > 0 AND k > 1 AND k - 1 > s + 1 THEN array_to_string(w[s + 1:k - 2], ' ') END AS object FROM p"""
)
def sentence_analysis(spark, d):
    """K16."""
    v = table(spark, d, "bible_verses_enhanced").where("zolai_text IS NOT NULL")
    return v.select("id", patterns.sentence_parts(F.col("zolai_text")).alias("p")).select("id", "p.*")


@query(
    rf"""WITH s AS (SELECT id, list_transform(list_filter(list_transform(string_split_regex(content, '[.!?။\n]+'), lambda x: trim(x)), lambda x: length(x) > 0), lambda y: len({W.format('y')})) AS l FROM articles WHERE content IS NOT NULL),
v AS (SELECT id, len(l) AS n, CASE WHEN len(l) > 0 THEN list_sum(list_transform(l, lambda x: x * x)) / len(l) - (list_sum(l) / len(l)) * (list_sum(l) / len(l)) END AS var FROM s)
SELECT id, n, round(var, 6) AS variance, var < 10 AS parallel FROM v"""
)
def discourse_stats(spark, d):
    """K15."""
    a = table(spark, d, "articles").where("content IS NOT NULL")
    return a.select("id", patterns.discourse(F.col("content")).alias("s")).select("id", "s.*")


@query(f"WITH s AS (SELECT doc_id, {W.format('lower(text)')} AS w FROM documents) SELECT CASE WHEN w[-1] IN ('hi.', 'hi', 'hiam?') THEN 'SOV' WHEN len(list_filter(w, lambda x: x IN ('hi.', 'hi', 'hiam?'))) > 0 THEN 'SVO' ELSE 'NONE' END AS word_order, count(*) AS n FROM s GROUP BY 1")
def word_order(spark, d):
    """K11."""
    w = table(spark, d, "documents").select(T.words(F.lower("text")).alias("w"))
    return w.groupBy(patterns.contrast(F.col("w"), ["hi.", "hi", "hiam?"]).alias("word_order")).agg(F.count(F.lit(1)).alias("n"))


_GLOSS = rf"""
x AS (SELECT lower(trim(regexp_replace(zolai, '\s+', ' ', 'g'))) AS phrase, min(trim(english)) AS gloss FROM zolai_vocabulary WHERE zolai IS NOT NULL AND trim(coalesce(english, '')) NOT IN ('', '-') GROUP BY 1),
s AS (SELECT id, {W.format('lower(title)')} AS w FROM zolai_songs WHERE title IS NOT NULL),
r AS (SELECT id, w, 1::BIGINT AS i, [] :: VARCHAR[] AS g FROM s
  UNION ALL SELECT r.id, w, r.i + coalesce(b.k, 1), list_append(g, coalesce(b.gloss, '?')) FROM r
  LEFT JOIN LATERAL (SELECT k, gloss FROM (SELECT unnest([5, 4, 3, 2, 1]) AS k) JOIN x ON phrase = array_to_string(r.w[r.i:r.i + k - 1], ' ') AND r.i + k - 1 <= len(r.w) ORDER BY k DESC LIMIT 1) b ON true
  WHERE r.i <= len(w))"""


@query(f"WITH RECURSIVE {_GLOSS} SELECT id, array_to_string(g, ' ') AS gloss FROM r WHERE i > len(w)")
def greedy_gloss(spark, d):
    """K9: song titles by the longest vocabulary phrases of up to five words."""
    v = table(spark, d, "zolai_vocabulary").where(F.col("zolai").isNotNull() & ~T.blank(F.col("english")))
    lexicon = v.groupBy(F.lower(T.squeeze(F.col("zolai"))).alias("phrase")).agg(F.min(F.trim("english")).alias("gloss"))
    return patterns.gloss(table(spark, d, "zolai_songs").where("title IS NOT NULL"), lexicon, "id", "title")


@query(
    f"""WITH s AS (SELECT DISTINCT trim(lower(x)) AS x FROM (SELECT unnest(string_split_regex(zolai_text, '[.!?။\\n]+')) AS x FROM bible_verses_enhanced)), k AS (SELECT x, len({W.format('x')}) AS n FROM s)
SELECT x AS sentence, CASE WHEN regexp_matches(x, '(^| )(bang|sangin)( |$)') THEN 'comparison' WHEN regexp_matches(x, '(^| )(lo|kei)( |$)') THEN 'warning' ELSE 'statement' END AS kind FROM k WHERE n BETWEEN 4 AND 15 AND regexp_matches(x, '(^| )(bang|sangin|lo|kei)( |$)')"""
)
def proverb_candidates(spark, d):
    """K13, C46."""
    s = table(spark, d, "bible_verses_enhanced").select(F.explode(F.split("zolai_text", "[.!?။\\n]+")).alias("x")).select(F.trim(F.lower("x")).alias("sentence")).distinct()
    s = s.where(F.size(T.words(F.col("sentence"))).between(4, 15) & F.col("sentence").rlike("(^| )(bang|sangin|lo|kei)( |$)"))
    kind = F.when(F.col("sentence").rlike("(^| )(bang|sangin)( |$)"), "comparison").when(F.col("sentence").rlike("(^| )(lo|kei)( |$)"), "warning").otherwise("statement")
    return s.select("sentence", kind.alias("kind"))
