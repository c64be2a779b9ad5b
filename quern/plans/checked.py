"""Queries over sentence validation and its scores (inventory J, D29)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import rules
from quern.functions import text as T
from quern.operators import quality, validation
from quern.plans.registry import query
from quern.plans.scored import _SENT, W
from quern.session import table, texts

_l = rules.sql_list
_quoted = lambda x: x.replace("'", "''")
EDGE = r"""'^[.,;:!?"''()\[\]{}]+|[.,;:!?"''()\[\]{}]+$'"""


def clause(c: str) -> str:
    """The words of a text, as clause_words cuts them."""
    return f"list_filter(flatten(list_transform(list_filter(string_split_regex(lower(coalesce({c}, '')), '\\s+'), lambda w: w <> ''), lambda w: string_split(regexp_replace(w, {EDGE}, '', 'g'), '-'))), lambda w: w <> '')"


def _tags(ws: str) -> str:
    cls = f"CASE WHEN w IN ('ka', 'na', 'i', 'ki', 'a') THEN 'S' WHEN w IN {_l(['in', 'uh', 'tua'] + rules.CLAUSE_FINALS)} THEN w WHEN w IN {_l(rules.CLAUSE_SUBJECTS)} THEN 'S' WHEN w IN {_l(rules.CLAUSE_QUESTIONS)} THEN 'Q' ELSE 'O' END"
    return f"list_transform({ws}, lambda w: {cls})"


_FOLD = "[t[i] FOR i IN range(1, len(t) + 1) IF i = 1 OR t[i] <> 'O' OR t[i - 1] <> 'O']"
_STEMS = "list_filter([word" + "".join(f", CASE WHEN ends_with(word, '{x}') AND length(word) > {len(x) + 2} THEN left(word, length(word) - {len(x)}) END" for x in rules.STEM_SUFFIXES) + "], lambda x: x IS NOT NULL)"
_VERB = _l(rules.CLAUSE_FINALS + rules.CLAUSE_INNER)
_KNOWN = f"k AS (SELECT DISTINCT lower(trim(zolai)) AS word FROM zolai_vocabulary WHERE zolai IS NOT NULL UNION SELECT unnest({clause('zolai_text')}) FROM bible_verses_enhanced)"
_DEEP = rf"""
l AS (SELECT id * 100000 + i AS id, ls[i] AS t FROM (SELECT id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT id, string_split(text, chr(10)) AS ls FROM zolai_songs WHERE text IS NOT NULL))),
s AS (SELECT id, t, {clause('t')} AS ws FROM l), {_KNOWN},
v AS (SELECT {clause('zolai_text')} AS ws FROM bible_verses_enhanced),
p AS (SELECT *, {_tags('ws')} AS t2 FROM s), vp AS (SELECT DISTINCT array_to_string({_FOLD}, '-') AS x FROM (SELECT {_tags('ws')} AS t FROM v)),
q AS (SELECT id, t, ws, {_FOLD.replace('t[', 't2[').replace('len(t)', 'len(t2)')} AS pat, coalesce(list_filter(range(2, len(ws) + 1), lambda i: ws[i] IN {_l(rules.CLAUSE_FINALS)} AND ws[i - 1] NOT IN {_VERB})[1], 0) AS f FROM p),
a AS (SELECT *, array_to_string(pat, '-') AS pattern, array_to_string(list_filter(pat, lambda x: x <> 'O'), '-') AS core, CASE WHEN f > 1 THEN ws[f - 1] END AS verb FROM q),
u0 AS (SELECT DISTINCT word FROM (SELECT unnest(ws) AS word FROM s) WHERE word NOT IN {_l(rules.KNOWN_ANYWAY)}),
u AS (SELECT word FROM u0 WHERE word NOT IN (SELECT word FROM (SELECT word, unnest({_STEMS}) AS form FROM u0) WHERE form IN (SELECT word FROM k))),
n AS (SELECT id, count(*) * 5 AS unknown FROM (SELECT id, unnest(ws) AS word FROM s) WHERE word IN (SELECT word FROM u) GROUP BY 1),
e AS (SELECT ws, i, ws[i - 1] AS verb FROM (SELECT ws, unnest(range(2, len(ws) + 1)) AS i FROM v) WHERE ws[i] IN {_l(rules.CLAUSE_FINALS)} AND ws[i - 1] NOT IN {_VERB}),
o AS (SELECT DISTINCT verb, o FROM (SELECT verb, unnest(ws[greatest(i - 3, 1):i + 1]) AS o FROM e) WHERE o NOT IN {_VERB} AND o <> verb),
b AS (SELECT DISTINCT verb FROM e),
c AS (SELECT DISTINCT id FROM (SELECT id, verb, unnest(list_filter(ws[1:f - 1], lambda w: w NOT IN {_l(rules.CLAUSE_SUBJECTS + rules.CLAUSE_INNER + rules.CLAUSE_FINALS)})) AS o FROM a WHERE verb IS NOT NULL) x SEMI JOIN (SELECT DISTINCT verb FROM o) y USING (verb) ANTI JOIN o USING (verb, o)),
d AS (SELECT a.id, coalesce(unknown, 0)::INT AS unknown, CASE WHEN pattern IN (SELECT x FROM vp) OR core IN (SELECT x FROM vp) THEN 0 ELSE 5 END AS pattern,
 CASE WHEN verb IS NULL THEN 5 WHEN verb IN (SELECT verb FROM b) THEN 0 ELSE 15 END AS verb_use, CASE WHEN a.id IN (SELECT id FROM c) THEN 10 ELSE 0 END AS collocation,
 (20 * len(list_filter(list_transform(string_split_regex(lower(t), '\s+'), lambda w: regexp_replace(w, {EDGE}, '', 'g')), lambda w: w IN {_l(sorted(rules.FORBIDDEN))})))::INT AS forbidden,
 CASE WHEN len(ws) >= 2 AND NOT regexp_matches(t, '[“”‘’"'']') AND list_max(list_filter(range(1, len(ws) + 1), lambda i: ws[i] IN {_l(rules.CLAUSE_FINALS)})) >= 2
   AND list_min(list_filter(range(1, len(ws) + 1), lambda i: ws[i] IN {_l(rules.CLAUSE_SUBJECTS)})) >= list_max(list_filter(range(1, len(ws) + 1), lambda i: ws[i] IN {_l(rules.CLAUSE_FINALS)})) - 1 THEN 5 ELSE 0 END AS word_order
 FROM a LEFT JOIN n USING (id)),
z AS (SELECT *, greatest(0, 100 - unknown - pattern - verb_use - collocation - forbidden - word_order) AS score FROM d)"""


def _verses(spark, d):
    return texts(spark, d, "bible_verses_enhanced", "id", "book", "zolai_text").select("id", "book", validation.clause_words(F.col("zolai_text")).alias("ws"))


def _known(spark, d, verses):
    return table(spark, d, "zolai_vocabulary").select(F.lower(F.trim("zolai")).alias("word")).unionAll(verses.select(F.explode("ws").alias("word")))


def _deep(spark, d):
    v = _verses(spark, d)
    lines = table(spark, d, "zolai_songs").where("text IS NOT NULL").select("id", F.posexplode(F.split("text", "\n")).alias("i", "text"))
    s = lines.select((F.col("id") * 100000 + F.col("i") + 1).alias("id"), "text", F.lit(False).alias("referenced"))
    return validation.deep_checks(s, _known(spark, d, v), v)


@query(f"WITH {_DEEP} SELECT * FROM z")
def deep_validation(spark, d):
    """Every song line against the vocabulary and what the verses attest; id is song x 100000 + line."""
    return _deep(spark, d)


_CONTEXT = rf"""
s AS (SELECT id, book, {clause('zolai_text')} AS ws FROM bible_verses_enhanced), k0 AS (SELECT DISTINCT lower(trim(zolai)) AS word FROM zolai_vocabulary WHERE zolai IS NOT NULL),
c AS (SELECT id, book, word FROM (SELECT id, book, unnest(ws) AS word FROM s) WHERE word NOT IN {_l(sorted(set(rules.CLAUSE_PARTICLES + rules.CLAUSE_SUBJECTS + rules.CLAUSE_FINALS)))}),
t AS (SELECT book, word FROM (SELECT book, word, row_number() OVER (PARTITION BY book ORDER BY count(*) DESC, word) AS r FROM (SELECT book, unnest(ws) AS word FROM s) WHERE word NOT IN {_l(sorted(set(rules.CLAUSE_PARTICLES + rules.CLAUSE_SUBJECTS)))} GROUP BY 1, 2) WHERE r <= 30),
w AS (SELECT id, count(*) FILTER (k0.word IS NULL) AS unknown, count(t.word) AS topics, count(*) AS n_content FROM c LEFT JOIN k0 USING (word) LEFT JOIN t ON t.book = c.book AND t.word = c.word GROUP BY 1),
x AS (SELECT id, len(ws) AS n, book, CASE WHEN len(ws) = 0 THEN 0 ELSE 30 - least(coalesce(unknown, 0) * 5, 30) END::DOUBLE AS word_score, CASE WHEN len(ws) = 0 THEN 0 ELSE 30 END::DOUBLE AS phrase_score, CASE WHEN len(ws) = 0 THEN 0 ELSE 20 END::DOUBLE AS structure_score,
 CASE WHEN len(ws) = 0 THEN 0 ELSE 15 + CASE WHEN n_content > 0 THEN 5 * topics / n_content ELSE 0 END END::DOUBLE AS book_bonus FROM s LEFT JOIN w USING (id)),
y AS (SELECT id, round(word_score, 4) AS word_score, phrase_score, structure_score, round(book_bonus, 4) AS book_bonus, round(greatest(0, least(100, word_score + phrase_score + structure_score + book_bonus)), 4) AS score FROM x)"""


def _context(spark, d):
    v = _verses(spark, d)
    return validation.context_scores(v, table(spark, d, "zolai_vocabulary").select(F.lower(F.trim("zolai")).alias("word")), v)


@query(f"WITH {_CONTEXT} SELECT * FROM y")
def context_scores(spark, d):
    """Every verse against all verses, which attest all its pairs."""
    return _context(spark, d).select("id", *[F.round(c, 4).alias(c) for c in ("word_score", "phrase_score", "structure_score", "book_bonus", "score")])


_SCORED = "greatest(0, 100 - least(40, bad * 20) - CASE WHEN bad_en > 0 THEN 10 ELSE 0 END - CASE WHEN no_verb THEN 15 ELSE 0 END - CASE WHEN no_subject THEN 15 ELSE 0 END - CASE WHEN ord THEN 5 ELSE 0 END - CASE WHEN n < 2 THEN 10 WHEN n > 15 THEN 5 ELSE 0 END - CASE WHEN m = 0 THEN 10 WHEN m = 1 THEN 5 ELSE 0 END)"


def _score(c):
    return quality.sentence_score(F.coalesce(c, F.lit("")), F.coalesce("english_text", F.lit("")))["score"]


@query(f"WITH {_SENT}, {_CONTEXT}, a AS (SELECT id, {_SCORED} AS a FROM k) SELECT id, greatest(a, score)::DOUBLE AS score, score > a AS overridden FROM a JOIN y USING (id)")
def score_override(spark, d):
    """The context score of a verse where it is larger than its sentence score."""
    v = texts(spark, d, "bible_verses_enhanced", "id", "zolai_text", "english_text").select("id", _score(F.col("zolai_text")).cast("double").alias("score"))
    return validation.override(v, _context(spark, d).select("id", F.round("score", 4).alias("score")))


_FIX = "CASE lower(core) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in sorted(rules.FORBIDDEN.items())) + " END"


@query(
    rf"""WITH {_SENT}, b AS (SELECT id, {_SCORED} AS before FROM k),
w0 AS (SELECT id, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT id, {W.format('zolai_text')} AS w FROM main.bible_verses_enhanced)),
f AS (SELECT id, i, w[i] AS x, regexp_extract(w[i], '^([^\p{{L}}\p{{N}}]*)(.*?)([^\p{{L}}\p{{N}}]*)$', 2) AS core FROM w0),
g AS (SELECT id, i, x, core, {_FIX} AS new FROM f),
h AS (SELECT id, string_agg(CASE WHEN new IS NULL THEN x ELSE regexp_extract(x, '^([^\p{{L}}\p{{N}}]*)', 1) || CASE WHEN regexp_matches(core, '^\p{{Lu}}') THEN upper(left(new, 1)) || substr(new, 2) ELSE new END || regexp_extract(x, '([^\p{{L}}\p{{N}}]*)$', 1) END, ' ' ORDER BY i) AS t FROM g GROUP BY 1),
corrected AS (SELECT v.id, coalesce(t, '') AS zolai_text, english_text FROM main.bible_verses_enhanced v LEFT JOIN h USING (id)),
{_SENT.replace('FROM bible_verses_enhanced', 'FROM corrected').replace('v AS (', 'v2 AS (', 1).replace('k AS (', 'k2 AS (').replace('FROM v)', 'FROM v2)')},
a AS (SELECT id, before, CASE WHEN before >= 80 THEN before ELSE {_SCORED} END AS after FROM k2 JOIN b USING (id))
SELECT id, before, after, CASE WHEN before >= 80 THEN 'valid' WHEN after >= 80 THEN 'corrected' ELSE 'invalid' END AS route FROM a"""
)
def routed_sentences(spark, d):
    """Verses under 80 have forbidden forms replaced and are scored again."""
    v = texts(spark, d, "bible_verses_enhanced", "id", "zolai_text", "english_text")
    return validation.route(v, "zolai_text", _score, T.replace_forms, 80).select("id", "before", "after", "route")


@query(
    "WITH v AS (SELECT id, zolai_text AS z FROM bible_verses_enhanced WHERE zolai_text IS NOT NULL), f AS (SELECT id, list_filter(["
    + ", ".join(f"CASE WHEN {'NOT ' if want else ''}regexp_matches(z, '(?s){_quoted(p)}') THEN '{n}' END" for n, (p, want) in sorted(rules.TRANSLATION_RULES.items()))
    + "], lambda x: x IS NOT NULL) AS failed FROM v) SELECT id, failed, CASE WHEN len(failed) = 0 THEN 'CORRECT' ELSE 'WRONG' END AS verdict FROM f"
)
def translation_rules(spark, d):
    """All fifteen rules."""
    v = texts(spark, d, "bible_verses_enhanced", "id", "zolai_text").where("zolai_text IS NOT NULL")
    v = v.select("id", validation.failed_rules(F.col("zolai_text")).alias("failed"))
    return v.withColumn("verdict", F.when(F.size("failed") == 0, "CORRECT").otherwise("WRONG"))


CONNECTORS = ["leh", "hang", "cih", "sung", "zat", "hih"]


@query(
    rf"""WITH s AS (SELECT id, list_filter(list_transform(string_split_regex(content, '[.!?။\n]+'), lambda x: trim(x)), lambda x: length(x) > 0) AS s FROM articles WHERE content IS NOT NULL),
e AS (SELECT id, i, regexp_extract_all(lower(s[i]), '[a-z''’]+') AS w FROM (SELECT id, s, unnest(range(1, len(s) + 1)) AS i FROM s)),
n AS (SELECT id, count(*) AS n FROM e GROUP BY 1), c AS (SELECT id, count(*) AS c FROM (SELECT id, unnest(w) AS x FROM e) WHERE x IN {_l(CONNECTORS)} GROUP BY 1),
f AS (SELECT id, count(*) FILTER (k > 1) / count(*) AS r FROM (SELECT id, x, count(*) AS k FROM (SELECT id, unnest(w) AS x FROM e) GROUP BY 1, 2) GROUP BY 1),
p AS (SELECT a.id, sum(CASE WHEN len(a.w) > 0 AND len(b.w) > 0 THEN len(list_intersect(a.w, b.w)) / least(len(list_distinct(a.w)), len(list_distinct(b.w))) ELSE 0 END) AS ch FROM e a JOIN e b ON a.id = b.id AND b.i = a.i + 1 GROUP BY 1)
SELECT id, round(coalesce(c, 0) / n, 6) AS connectors, round(coalesce(r, 0), 6) AS reuse, round(coalesce(ch / (n - 1), 0), 6) AS chain,
 round(least(coalesce(c, 0) / n / 2, 0.3) + least(coalesce(r, 0), 0.3) + least(coalesce(ch / (n - 1), 0), 0.4), 6) AS score FROM n LEFT JOIN c USING (id) LEFT JOIN f USING (id) LEFT JOIN p USING (id)"""
)
def cohesion_scores(spark, d):
    """Every article with a sentence."""
    a = texts(spark, d, "articles", "id", "content").where("content IS NOT NULL").select("id", T.sentences(F.col("content")).alias("s")).where(F.size("s") > 0)
    return a.select("id", quality.cohesion(F.col("s"), CONNECTORS).alias("c")).select("id", *[F.round(f"c.{x}", 6).alias(x) for x in ("connectors", "reuse", "chain", "score")])


DIMS = ["word_repetition", "special_chars", "stopwords", "language_id"]
PROFILES = {"hymn": [0.5, 0.1, 0.1, 0.3], "news": [0.1, 0.05, 0.05, 0.3], "lesson": [0.2, 0.05, 0.15, 0.5]}


def _nearest_sql():
    from quern.plans.scored import _FEATURES

    each = " UNION ALL ".join(f"SELECT doc_id, '{n}' AS profile, ({' + '.join(f'(1 - abs({c} - {x}))' for c, x in zip(DIMS, xs))}) / {len(DIMS)} AS likeness FROM f" for n, xs in sorted(PROFILES.items()))
    return f"WITH {_FEATURES}, p AS ({each}) SELECT doc_id, (array_agg(profile ORDER BY round(likeness, 9) DESC, profile))[1] AS profile, round(max(likeness), 6) AS likeness FROM p GROUP BY 1"


@query(_nearest_sql())
def style_profiles(spark, d):
    """The profile nearest to each document's fingerprint; the profiles are a parameter."""
    f = quality.features(texts(spark, d, "documents", "doc_id", "text"), "doc_id", "text")
    return quality.nearest_profile(f, "doc_id", DIMS, PROFILES)
