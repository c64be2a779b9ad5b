"""Queries over lexicon building (rows of inventories C, D, F, G, J, K, L, P)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import rules
from quern.functions import text as T
from quern.operators import lexicon, patterns, stats
from quern.plans.joined import _ALIGN, _aligned
from quern.plans.registry import query
from quern.plans.scored import _CLS, _TP
from quern.session import table, texts

W = "list_filter(string_split_regex(lower(coalesce({0}, '')), '\\s+'), lambda w: w <> '')"
A = "regexp_extract_all(lower(coalesce({0}, '')), '[a-z]+')"


def _verses(spark, d, *cols):
    return texts(spark, d, "bible_verses_enhanced", "id", *cols)


BOOKS = {"GEN": "A2", "PSA": "C2", "MAT": "B1", "ROM": "C1"}


@query(
    rf"""SELECT id, CASE WHEN regexp_matches(book, 'HCL|FCL') THEN 'SKIP' {" ".join(f"WHEN contains(book, '{k}') THEN '{v}'" for k, v in BOOKS.items())} WHEN contains(upper(source_version), 'ED004') THEN 'B2'
 WHEN regexp_matches(zolai_text, '(?i)(^| )(hiam|ahih leh)( |$)') THEN 'B1' WHEN n > 20 THEN 'B1' WHEN n > 8 THEN 'A2' ELSE 'A1' END AS level FROM (SELECT *, len({W.format('zolai_text')}) AS n FROM bible_verses_enhanced)"""
)
def verse_levels(spark, d):
    """C38."""
    v = _verses(spark, d, "book", "source_version", "zolai_text")
    return v.select("id", T.level_cascade(F.col("book"), F.col("source_version"), F.col("zolai_text"), BOOKS, {"ED004": "B2"}, [("(?i)(^| )(hiam|ahih leh)( |$)", "B1")], ["HCL", "FCL"]).alias("level"))


@query("SELECT id, CASE WHEN frequency_corpus > 5000 OR source_priority <= 5 THEN 'A1' WHEN frequency_corpus > 1000 THEN 'A2' WHEN frequency_corpus > 100 THEN 'B1' WHEN frequency_corpus > 10 THEN 'B2' WHEN frequency_corpus > 1 THEN 'C1' ELSE 'C2' END AS level FROM zolai_vocabulary")
def word_levels(spark, d):
    """C39."""
    return table(spark, d, "zolai_vocabulary").select("id", T.level_by_frequency(F.col("frequency_corpus"), F.col("source_priority")).alias("level"))


MARKERS = {"narrative": ["was", "were", "had"], "instruction": ["must", "should", "open"], "question": ["hiam", "which"]}


@query(
    rf"""WITH t AS (SELECT doc_id, text, {A.format('text')} AS w FROM documents), c AS (SELECT *, """
    + ", ".join(f"len(list_filter(w, lambda x: list_contains({rules.sql_array(m)}, x))) AS {k}" for k, m in MARKERS.items())
    + r""" FROM t) SELECT doc_id, CASE WHEN greatest(narrative, instruction, question) = 0 THEN 'general' WHEN instruction >= narrative AND instruction >= question THEN 'instruction' WHEN narrative >= question THEN 'narrative' ELSE 'question' END AS text_type,
 CASE WHEN regexp_matches(lower(text), '^(hello|damna|zingsang)( |$)') THEN 'greeting' WHEN regexp_matches(lower(text), '(\?|(^| )hiam[.?!]*)$') THEN 'question' WHEN regexp_matches(lower(text), '!$') THEN 'exclamation'
 WHEN regexp_matches(lower(text), '(^| )(in|un)[.]*$') THEN 'request' WHEN regexp_matches(lower(text), '^(ka|kei) ') THEN 'self' ELSE 'statement' END AS label FROM c"""
)
def text_types(spark, d):
    """C40, C45, K17, K19."""
    t = texts(spark, d, "documents", "doc_id", "text")
    return t.select("doc_id", T.marker_class(T.tokens(F.col("text"), "alpha"), MARKERS).alias("text_type"), T.conversation_label(F.col("text")).alias("label"))


@query(
    r"""SELECT id, list_filter([source_category, source_file], lambda x: x IS NOT NULL) AS sources, 'v1' AS version, updated_at AS made_at,
 CASE WHEN regexp_matches(english, 'tone') THEN replace(english, 's', 'z') ELSE english END AS rewritten, list_filter(list_transform(string_split(myanmar, ';'), lambda x: trim(x)), lambda x: regexp_matches(x, '[က-႟]')) AS senses FROM zolai_vocabulary"""
)
def provenance(spark, d):
    """C52, C54, C58."""
    v = table(spark, d, "zolai_vocabulary")
    e = T.envelope([F.col("source_category"), F.col("source_file")], "v1", F.col("updated_at"))
    return v.select("id", e["sources"].alias("sources"), e["version"].alias("version"), e["made_at"].alias("made_at"), T.conditional_rewrite(T.strip_controls(F.col("english")), "s", "z", "tone").alias("rewritten"), T.script_senses(F.col("myanmar")).alias("senses"))


@query(r"""SELECT id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '' AND lower(x) <> lower(trim(title)) AND NOT regexp_matches(x, '(?i)^(verse|chorus|bridge)\b.*$'))[1:3] AS first_lines FROM zolai_songs WHERE text IS NOT NULL AND title IS NOT NULL""")
def song_lines(spark, d):
    """C57."""
    return table(spark, d, "zolai_songs").where("text IS NOT NULL AND title IS NOT NULL").select("id", T.lyric_lines(F.col("text"), F.col("title")).alias("first_lines"))


@query(
    rf"""WITH p AS (SELECT lower(trim(zolai)) AS word, min(english) AS parts FROM zolai_vocabulary WHERE english IS NOT NULL GROUP BY 1), t AS (SELECT id, unnest(list_distinct({A.format('zolai_text')})) AS word FROM bible_verses_enhanced)
SELECT id, word, parts FROM t JOIN p USING (word)"""
)
def verse_compounds(spark, d):
    """C55."""
    v = table(spark, d, "zolai_vocabulary").where("english IS NOT NULL").groupBy(F.lower(F.trim("zolai")).alias("word")).agg(F.min("english").alias("parts"))
    return lexicon.compounds(_verses(spark, d, "zolai_text").select("id", T.tokens(F.col("zolai_text"), "alpha").alias("ws")), v)


@query(
    r"""SELECT item_id, json_extract_string('{"a": "' || replace(answer, '"', '') || '"}', '$.a') AS parsed, length(trim(answer)) < 8 OR regexp_matches(trim(answer), '^[0-9]+:[0-9]+') OR regexp_matches(trim(answer), '^[A-Z][a-z]+ [A-Z][a-z]+$')
 OR (regexp_matches(trim(answer), '^[a-z][a-z ]+$') AND length(trim(answer)) < 30) OR regexp_matches(trim(answer), '"depth"\s*:|"url"\s*:|<[a-z]+>') AS bad FROM eval_items WHERE answer IS NOT NULL"""
)
def answer_parsing(spark, d):
    """JSON read out of fenced answers, and answers that are no use."""
    t = table(spark, d, "eval_items").where("answer IS NOT NULL")
    fenced = F.concat(F.lit('Sure:\n```json\n{"a": "'), F.replace("answer", F.lit('"'), F.lit("")), F.lit('"}\n```'))
    return t.select("item_id", T.json_answer(fenced, ["a"])["a"].alias("parsed"), T.bad_answer(F.col("answer")).alias("bad"))


@query(
    rf"""WITH v AS (SELECT id, zolai_text, {A.format('zolai_text')} AS ws FROM bible_verses_enhanced WHERE zolai_text IS NOT NULL), e AS (SELECT id, zolai_text, len(ws) AS n, unnest(list_distinct(ws)) AS word FROM v),
k AS (SELECT DISTINCT lower(trim(zolai)) AS word FROM zolai_vocabulary)
SELECT word, id, zolai_text AS example FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY NOT (n BETWEEN 5 AND 12), abs(n - 7), id) AS r FROM e JOIN k USING (word)) WHERE r = 1"""
)
def word_examples(spark, d):
    """D20, H4, H6."""
    v = _verses(spark, d, "zolai_text").where("zolai_text IS NOT NULL").select("id", F.col("zolai_text").alias("text"), T.tokens(F.col("zolai_text"), "alpha").alias("ws"))
    return lexicon.best_examples(table(spark, d, "zolai_vocabulary").select(F.lower(F.trim("zolai")).alias("word")), v)


@query(
    rf"""WITH e AS (SELECT id, unnest({A.format('zolai_text')}) AS word FROM bible_verses_enhanced)
SELECT word, count(*) AS n, list_sort(list_distinct(array_agg(id)))[1:3] AS refs FROM e WHERE word IN {rules.sql_list(rules.PARTICLES)} GROUP BY 1"""
)
def particle_references(spark, d):
    """G15, K7, K8."""
    e = _verses(spark, d, "zolai_text").select("id", F.explode(T.tokens(F.col("zolai_text"), "alpha")).alias("word")).where(F.col("word").isin(rules.PARTICLES))
    return lexicon.references(e)


@query(
    _ALIGN
    + """, g AS (SELECT DISTINCT lower(trim(zolai)) AS word, english AS gloss FROM zolai_vocabulary WHERE zolai IS NOT NULL AND trim(coalesce(english, '')) NOT IN ('', '-')), m AS (SELECT DISTINCT word, meaning FROM a WHERE position >= 0)
SELECT g.word, gloss, CASE WHEN count(meaning) = 0 THEN 'unaligned' WHEN bool_or(contains(gloss, meaning) OR contains(meaning, gloss)) THEN 'ok' ELSE 'mismatch' END AS status FROM g LEFT JOIN m ON g.word = m.word GROUP BY 1, 2"""
)
def dictionary_accuracy(spark, d):
    """F24, J21."""
    v = table(spark, d, "zolai_vocabulary").where("zolai IS NOT NULL").select(F.lower(F.trim("zolai")).alias("word"), F.col("english").alias("gloss"))
    return lexicon.aligned_contradictions(v, _aligned(spark, d).where("position >= 0"))


@query(
    _ALIGN
    + rf""", r AS (SELECT word, id, position, row_number() OVER (PARTITION BY word ORDER BY id) AS r FROM a WHERE position >= 0), t AS (SELECT id, {W.format('myanmar_text')} AS third FROM bible_verses_enhanced),
j AS (SELECT word, r.id, third[position + 1] AS v FROM r JOIN t USING (id) WHERE r <= 5 AND third[position + 1] IS NOT NULL)
SELECT word, (array_agg(v ORDER BY id))[1] AS value FROM j GROUP BY 1"""
)
def third_language_words(spark, d):
    """F21."""
    t = _verses(spark, d, "myanmar_text").select("id", T.words(F.lower("myanmar_text")).alias("third"))
    return lexicon.nth_words(_aligned(spark, d).select("word", "id", "position"), t)


@query(
    rf"""WITH v AS (SELECT {A.format('zolai_text')} AS w FROM bible_verses_enhanced), i AS (SELECT w, unnest(list_filter(range(1, len(w) + 1), lambda i: w[i] IN ('hi', 'ding'))) AS i FROM v),
n AS (SELECT w[i] AS head, unnest(w[greatest(i - 3, 1):i + 1]) AS near FROM i) SELECT head, near, count(*) AS n FROM n WHERE near <> head GROUP BY 1, 2"""
)
def verb_contexts(spark, d):
    """F26."""
    return lexicon.contexts(_verses(spark, d, "zolai_text"), T.tokens(F.col("zolai_text"), "alpha"), ["hi", "ding"])


@query("SELECT lower(trim(zolai)) AS word, count(DISTINCT lower(trim(english)))::INT AS n_senses, list_sort(list_distinct(array_agg(lower(trim(english))))) AS senses FROM dictionary_enhanced WHERE zolai IS NOT NULL AND trim(coalesce(english, '')) NOT IN ('', '-') GROUP BY 1 HAVING count(DISTINCT lower(trim(english))) > 1")
def multi_sense_words(spark, d):
    """G37, K18."""
    return lexicon.senses(table(spark, d, "dictionary_enhanced").where("zolai IS NOT NULL").select(F.lower(F.trim("zolai")).alias("word"), F.col("english").alias("gloss")))


@query(
    rf"""WITH e AS (SELECT id, unnest(list_distinct({A.format('zolai_text')})) AS w FROM bible_verses_enhanced), r AS (SELECT id, w, row_number() OVER (PARTITION BY id ORDER BY md5('42' || id || w), w) AS r FROM e)
SELECT id, min(w) AS a, max(w) AS b FROM r WHERE r <= 2 GROUP BY id HAVING count(*) = 2"""
)
def candidate_pairs(spark, d):
    """One pair of words a verse (not all pairs)."""
    return lexicon.word_pairs(_verses(spark, d, "zolai_text").select("id", T.tokens(F.col("zolai_text"), "alpha").alias("ws")))


@query(
    rf"""WITH c AS (SELECT w AS word, count(*) AS n FROM (SELECT unnest({A.format('zolai_text')}) AS w FROM bible_verses_enhanced) GROUP BY 1), g AS (SELECT lower(trim(zolai)) AS word, min(english) AS gloss FROM zolai_vocabulary WHERE trim(coalesce(english, '')) NOT IN ('', '-') GROUP BY 1)
SELECT word, gloss, n FROM g JOIN c USING (word) ORDER BY n DESC, word LIMIT 50"""
)
def glossary(spark, d):
    """L26."""
    c = stats.word_counts(_verses(spark, d, "zolai_text").select(F.explode(T.tokens(F.col("zolai_text"), "alpha")).alias("word")))
    return lexicon.glossary(table(spark, d, "zolai_vocabulary").select(F.lower(F.trim("zolai")).alias("word"), F.col("english").alias("gloss")), c)


@query("SELECT user_id, count(*) FILTER (value BETWEEN 0 AND 100) AS n, round(avg(CASE WHEN value BETWEEN 0 AND 100 THEN value END), 6) AS mean, count(*) FILTER (NOT coalesce(value BETWEEN 0 AND 100, false)) AS rejected FROM events GROUP BY 1")
def rating_summary(spark, d):
    """P9."""
    return lexicon.ratings(table(spark, d, "events"), "user_id", "value", 0, 100)


LOOKUP = [("not", "negation"), ("which", "relative"), ("will", "future"), ("were", "past")]


@query(r"SELECT id, list_filter([" + ", ".join(rf"CASE WHEN regexp_matches(english_text, '(?i)(^|[^\p{{L}}]){k}($|[^\p{{L}}])') THEN '{v}' END" for k, v in LOOKUP) + "], lambda x: x IS NOT NULL) AS found FROM bible_verses_enhanced WHERE english_text IS NOT NULL")
def pattern_lookup(spark, d):
    """K12."""
    v = _verses(spark, d, "english_text").where("english_text IS NOT NULL")
    return v.select("id", lexicon.pattern_lookup(F.col("english_text"), LOOKUP).alias("found"))
