"""Queries over lookups, fills and attestation (inventory F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import rules
from quern.functions import text as T
from quern.operators import joins
from quern.plans.registry import query
from quern.session import table, texts

B = "trim(coalesce({0}, '')) IN ('', '-')"
OWN = "list_filter(string_split_regex(lower(coalesce({0}, '')), '\\s+'), lambda w: w <> '')"


def b(c: str) -> str:
    return B.format(c)


def _src(column: str, key: str = "zolai") -> str:
    return f"(SELECT {key} AS k, (array_agg({column} ORDER BY id))[1] AS v FROM zolai_vocabulary WHERE {key} IS NOT NULL AND NOT {b(column)} GROUP BY 1)"


@query(f"SELECT t.id, t.zolai, CASE WHEN {b('t.english')} THEN coalesce(s.v, t.english) ELSE t.english END AS english FROM zolai_vocabulary t LEFT JOIN {_src('english')} s ON t.zolai = s.k")
def fill_english(spark, d):
    v = table(spark, d, "zolai_vocabulary").select("id", "zolai", "english")
    return joins.fill_blank(v, table(spark, d, "zolai_vocabulary").select("id", "zolai", "english"), ("zolai", "zolai"), "english").select("id", "zolai", "english")


@query(f"SELECT t.id, CASE WHEN {b('t.myanmar')} THEN coalesce(s.v, t.myanmar) ELSE t.myanmar END AS myanmar FROM zolai_vocabulary t LEFT JOIN {_src('myanmar', 'english')} s ON t.english = s.k")
def fill_reverse(spark, d):
    """F8: filled over the other language's key."""
    v = table(spark, d, "zolai_vocabulary").select("id", "english", "myanmar")
    return joins.fill_blank(v, table(spark, d, "zolai_vocabulary").select("id", F.col("english").alias("en"), "myanmar"), ("english", "en"), "myanmar").select("id", "myanmar")


@query(
    f"""SELECT 'english' AS field, count(*) AS n FROM zolai_vocabulary v WHERE {b('v.english')} AND EXISTS (SELECT 1 FROM zolai_vocabulary e WHERE e.zolai = v.zolai AND NOT {b('e.english')})
UNION ALL SELECT 'myanmar', count(*) FROM zolai_vocabulary v WHERE {b('v.myanmar')} AND EXISTS (SELECT 1 FROM zolai_vocabulary e WHERE e.zolai = v.zolai AND NOT {b('e.myanmar')})"""
)
def fillable_counts(spark, d):
    v = e = table(spark, d, "zolai_vocabulary")
    n = lambda c: joins.fillable(v, e, ("zolai", "zolai"), c).agg(F.lit(c).alias("field"), F.count(F.lit(1)).alias("n"))
    return n("english").unionAll(n("myanmar"))


@query(
    rf"""SELECT count(*) AS n FROM (SELECT id, regexp_replace(trim(zolai), '[.,;:!?"''()\[\]{{}}“”‘’…]', '', 'g') AS k FROM zolai_vocabulary WHERE {b('english')}) v
WHERE EXISTS (SELECT 1 FROM zolai_vocabulary e WHERE lower(trim(e.zolai)) = lower(v.k) AND NOT {b('e.english')})"""
)
def fillable_after_cleaning(spark, d):
    """how many more blanks a cleaned headword could fill."""
    v = table(spark, d, "zolai_vocabulary").select("english", F.lower(T.strip_punctuation(F.col("zolai"))).alias("k"))
    e = table(spark, d, "zolai_vocabulary").select("english", F.lower(F.trim("zolai")).alias("k"))
    return joins.fillable(v, e, ("k", "k"), "english").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT a.zolai, a.id AS a_id, e.id AS b_id, a.pos AS a_value, e.pos AS b_value FROM zolai_vocabulary a JOIN zolai_vocabulary e ON a.zolai = e.zolai WHERE a.source_priority < 40 AND e.source_priority >= 40 AND NOT {b('a.pos')} AND NOT {b('e.pos')} AND a.pos <> e.pos")
def value_mismatches(spark, d):
    v = table(spark, d, "zolai_vocabulary")
    return joins.mismatches(v.where("source_priority < 40"), v.where("source_priority >= 40"), "zolai", "pos")


@query(f"SELECT t.id, coalesce(s.v, t.pos) AS pos FROM zolai_vocabulary t LEFT JOIN {_src('pos')} s ON t.zolai = s.k")
def overwrite_pos(spark, d):
    v = e = table(spark, d, "zolai_vocabulary").select("id", "zolai", "pos")
    return joins.overwrite(v, e, "zolai", "pos").select("id", "pos")


_ALIGN = rf"""WITH l AS (SELECT word, list_sort(list_distinct(array_agg(m))) AS ms FROM (SELECT lower(trim(zolai)) AS word, lower(trim(english)) AS m FROM zolai_vocabulary WHERE NOT {b('english')} AND zolai IS NOT NULL) GROUP BY 1),
v AS (SELECT id, {OWN.format('zolai_text')} AS own, regexp_extract_all(lower(coalesce(english_text, '')), '[a-z]+') AS other FROM bible_verses_enhanced WHERE zolai_text IS NOT NULL),
w AS (SELECT id, other, unnest(list_distinct(own)) AS word FROM v),
a AS (SELECT id, word, ms[1] AS meaning, coalesce(list_position(other, ms[1]), 0)::INT - 1 AS position, CASE WHEN coalesce(list_position(other, ms[1]), 0) = 0 THEN 0.5::DOUBLE WHEN len(ms) = 1 THEN 0.9::DOUBLE ELSE 0.7::DOUBLE END AS confidence FROM w JOIN l USING (word))"""


def _aligned(spark, d):
    e = table(spark, d, "zolai_vocabulary").where(~T.blank(F.col("english")) & F.col("zolai").isNotNull())
    lex = e.groupBy(F.lower(F.trim("zolai")).alias("word")).agg(F.sort_array(F.collect_set(F.lower(F.trim("english")))).alias("meanings"))
    v = table(spark, d, "bible_verses_enhanced").where("zolai_text IS NOT NULL")
    v = v.select("id", T.words(F.lower("zolai_text")).alias("own"), T.tokens(F.col("english_text"), "alpha").alias("other"))
    return joins.align_words(v, lex)


@query(_ALIGN + "SELECT id, word, meaning, position, confidence FROM a")
def word_alignment(spark, d):
    return _aligned(spark, d)


@query(_ALIGN + "SELECT id, list_sort(array_agg(word)) AS words, count(*) AS n, round(avg(confidence), 6) AS confidence FROM a GROUP BY 1")
def alignment_nest(spark, d):
    """F2, Q1: alignments nested by verse, with their mean confidence."""
    a = _aligned(spark, d)
    return joins.nest(a, "id", "word", ["confidence"]).select(
        "id", F.transform("items", lambda s: s["word"]).alias("words"), F.size("items").cast("bigint").alias("n"),
        F.round(F.aggregate("items", F.lit(0.0), lambda x, s: x + s["confidence"]) / F.size("items"), 6).alias("confidence"),
    )


_VW = rf"SELECT unnest({OWN.format('zolai_text')}) AS w FROM bible_verses_enhanced"


@query(f"WITH w AS ({_VW}), c AS (SELECT w AS word, count(*) AS n FROM w GROUP BY 1) SELECT word, n FROM c WHERE n > 50 AND length(word) > 2 AND word NOT IN (SELECT lower(zolai) FROM zolai_vocabulary WHERE zolai IS NOT NULL) ORDER BY n DESC, word LIMIT 2000")
def missing_words(spark, d):
    """The 2,000 most frequent verse words above 50 that the vocabulary lacks (the report is a top-k)."""
    w = table(spark, d, "bible_verses_enhanced").select(F.explode(T.words(F.lower("zolai_text"))).alias("word"))
    c = w.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 50) & (F.length("word") > 2))
    known = table(spark, d, "zolai_vocabulary").where("zolai IS NOT NULL").select(F.lower("zolai").alias("word"))
    return c.join(known, "word", "left_anti").orderBy(F.desc("n"), "word").limit(2000)


@query("SELECT a.zolai, count(e.id) AS n_meanings, bool_or(e.id IS NULL) AS unmatched FROM (SELECT DISTINCT lower(zolai) AS zolai FROM zolai_vocabulary WHERE zolai IS NOT NULL) a LEFT JOIN entries e ON a.zolai = e.headword GROUP BY 1")
def left_unmatched(spark, d):
    """F11."""
    a = table(spark, d, "zolai_vocabulary").where("zolai IS NOT NULL").select(F.lower("zolai").alias("zolai")).distinct()
    e = table(spark, d, "entries").select(F.col("headword").alias("zolai"), "id")
    return a.join(e, "zolai", "left").groupBy("zolai").agg(F.count("id").alias("n_meanings"), F.bool_or(F.col("id").isNull()).alias("unmatched"))


@query("SELECT coalesce(s.id, w.id) AS idx, s.title AS song_title, w.title AS page_title FROM zolai_songs s FULL JOIN wiki_content w ON s.id = w.id")
def positional_join(spark, d):
    s = table(spark, d, "zolai_songs").select(F.col("id").alias("idx"), F.col("title").alias("song_title"))
    return joins.positional(s, table(spark, d, "wiki_content").select(F.col("id").alias("idx"), F.col("title").alias("page_title")), "idx")


_PAIRS = f"(SELECT lower(trim(zolai)) AS own, lower(trim(english)) AS other, max(coalesce(confidence, 0)) AS c, count(*) AS f FROM zolai_vocabulary WHERE NOT {b('english')} AND NOT {b('zolai')} GROUP BY 1, 2)"


@query(f"SELECT own, (array_agg(other ORDER BY c DESC, f DESC, other))[1] AS other FROM {_PAIRS} GROUP BY 1")
def best_translation(spark, d):
    return joins.best_both_ways(_pairs(spark, d))[1]


@query(f"SELECT other, (array_agg(own ORDER BY c DESC, f DESC, own))[1] AS own FROM {_PAIRS} GROUP BY 1")
def best_source(spark, d):
    """The reverse index."""
    return joins.best_both_ways(_pairs(spark, d))[0]


def _pairs(spark, d):
    e = table(spark, d, "zolai_vocabulary").where(~T.blank(F.col("english")) & ~T.blank(F.col("zolai")))
    return e.groupBy(F.lower(F.trim("zolai")).alias("own"), F.lower(F.trim("english")).alias("other")).agg(F.max(F.coalesce("confidence", F.lit(0.0))).alias("confidence"), F.count(F.lit(1)).alias("frequency"))


@query(
    rf"""WITH l AS (SELECT own AS word, (array_agg(other ORDER BY c DESC, f DESC, other))[1] AS m FROM {_PAIRS} GROUP BY 1),
w AS (SELECT id, i, ws[i] AS word FROM (SELECT id, ws, unnest(range(1, len(ws) + 1)) AS i FROM (SELECT id, {OWN.format('title')} AS ws FROM zolai_songs)))
SELECT id, CASE WHEN bool_and(m IS NOT NULL) THEN string_agg(m, ' ' ORDER BY i) END AS translation FROM w LEFT JOIN l USING (word) GROUP BY 1"""
)
def phrase_translation(spark, d):
    """F20."""
    lex = joins.best_both_ways(_pairs(spark, d))[1].select(F.col("own").alias("word"), F.col("other").alias("meaning"))
    return joins.translate_words(table(spark, d, "zolai_songs").select("id", F.col("title").alias("phrase")), lex)


@query(
    rf"""WITH p AS (SELECT DISTINCT lower(trim(regexp_replace(zolai, '\s+', ' ', 'g'))) AS phrase FROM zolai_vocabulary WHERE zolai IS NOT NULL),
l AS (SELECT DISTINCT len(string_split(phrase, ' ')) AS k FROM p WHERE phrase <> ''), v AS (SELECT id, {OWN.format('zolai_text')} AS w FROM bible_verses_enhanced),
g AS (SELECT id, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (SELECT id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM v, l))
SELECT phrase, count(DISTINCT id) AS n_verses, count(*) AS n FROM g JOIN p USING (phrase) GROUP BY 1"""
)
def phrase_attestation(spark, d):
    """Occurrences of vocabulary phrases, of any length, in the verses."""
    v = texts(spark, d, "bible_verses_enhanced", "id", "zolai_text").select("id", T.words(F.lower("zolai_text")).alias("ws"))
    p = table(spark, d, "zolai_vocabulary").select(F.lower(T.squeeze(F.col("zolai"))).alias("phrase"))
    return joins.phrase_hits(v, p).groupBy("phrase").agg(F.count(F.lit(1)).alias("n_verses"), F.sum("n").alias("n"))


@query(
    rf"""WITH k AS (SELECT DISTINCT lower(trim(zolai)) AS w FROM zolai_vocabulary WHERE zolai IS NOT NULL), v AS (SELECT DISTINCT w AS word FROM ({_VW})),
s AS (SELECT word, unnest(list_transform(list_filter(['te','in','na','ah','pa','nu','un','uh'], lambda x: ends_with(word, x) AND length(word) - length(x) >= 3), lambda x: left(word, length(word) - length(x)))) AS st FROM v)
SELECT word, CASE WHEN word IN (SELECT w FROM k) THEN 'exact' WHEN word IN (SELECT word FROM s WHERE st IN (SELECT w FROM k)) THEN 'stem' ELSE 'unknown' END AS how FROM v"""
)
def stem_fallback(spark, d):
    """F25."""
    words = table(spark, d, "bible_verses_enhanced").select(F.explode(T.words(F.lower("zolai_text"))).alias("word")).distinct()
    return joins.with_stem(words, table(spark, d, "zolai_vocabulary").select(F.lower(F.trim("zolai")).alias("word")))


@query(
    rf"""WITH a AS (SELECT book, chapter, verse, source_version, list_distinct(regexp_extract_all(lower(zolai_text), '[a-z]+')) AS w FROM (SELECT *, row_number() OVER (PARTITION BY book, chapter, verse, source_version ORDER BY id) AS rn FROM bible_verses_enhanced WHERE zolai_text IS NOT NULL) WHERE rn = 1)
SELECT x.book, x.chapter, x.verse, x.source_version AS a_version, y.source_version AS b_version,
 list_sort(list_filter(x.w, lambda t: NOT list_contains(y.w, t)))[1:5] AS only_a, list_sort(list_filter(y.w, lambda t: NOT list_contains(x.w, t)))[1:5] AS only_b,
 round(len(list_filter(x.w, lambda t: list_contains(y.w, t))) / greatest(len(x.w), 1), 6) AS kept
FROM a x JOIN a y ON x.book = y.book AND x.chapter = y.chapter AND x.verse = y.verse AND x.source_version < y.source_version"""
)
def version_differences(spark, d):
    """Words of one version that another lacks, sorted (Q9), and the share kept."""
    from quern.operators.dedup import first_rows

    key = ["book", "chapter", "verse", "source_version"]
    v = first_rows(table(spark, d, "bible_verses_enhanced").where("zolai_text IS NOT NULL").select("id", *key, "zolai_text"), key, [F.col("id")])
    v = v.select(*key, F.array_distinct(T.tokens(F.col("zolai_text"), "alpha")).alias("w"))
    x, y = v.withColumnsRenamed({"source_version": "a_version", "w": "wa"}), v.withColumnsRenamed({"source_version": "b_version", "w": "wb"})
    j = x.join(y, ["book", "chapter", "verse"]).where("a_version < b_version")
    diff = lambda a, b: F.slice(F.array_sort(F.array_except(a, b)), 1, 5)
    kept = F.size(F.array_intersect("wa", "wb")) / F.greatest(F.size("wa"), F.lit(1))
    return j.select("book", "chapter", "verse", "a_version", "b_version", diff("wa", "wb").alias("only_a"), diff("wb", "wa").alias("only_b"), F.round(kept, 6).alias("kept"))


@query(
    """WITH w AS (SELECT DISTINCT zolai AS word, left(zolai, 4) AS root FROM zolai_vocabulary WHERE length(zolai) >= 4)
SELECT a.word, list_sort(array_agg(b.word) FILTER (b.word <> a.word))[1:6] AS related FROM w a JOIN w b USING (root) GROUP BY 1"""
)
def word_families(spark, d):
    """F28 (a word alone in its family has an empty list)."""
    f = joins.families(table(spark, d, "zolai_vocabulary").select(F.col("zolai").alias("word")))
    return f.select("word", F.when(F.size("related") > 0, F.col("related")).alias("related"))


@query(
    f"""WITH w AS (SELECT DISTINCT zolai AS word, english AS meaning FROM dictionary_enhanced WHERE NOT {b('english')})
SELECT a.word, meaning, list_sort(array_agg(b.word) FILTER (b.word <> a.word))[1:4] AS peers FROM w a JOIN w b USING (meaning) GROUP BY 1, 2"""
)
def meaning_variants(spark, d):
    """F29, G11."""
    f = joins.variants(table(spark, d, "dictionary_enhanced").select(F.col("zolai").alias("word"), F.col("english").alias("meaning")))
    return f.select("word", "meaning", F.when(F.size("peers") > 0, F.col("peers")).alias("peers"))


ALWAYS = ["in", "leh", "uh", "na", "kei", "tawh", "ci", "lo"]


@query(
    rf"""WITH w AS (SELECT lower(trim(zolai)) AS word, list_distinct(array_agg(lower(trim(english)))) AS wrong FROM dictionary_enhanced WHERE confidence < 0.4 AND NOT {b('english')} AND zolai IS NOT NULL GROUP BY 1),
r AS (SELECT headword AS word, wrong, english AS new_value FROM entries JOIN w ON word = headword WHERE NOT {b('entries.english')}),
e AS (SELECT id, lower(trim(zolai)) AS word, english AS value FROM dictionary_enhanced WHERE zolai IS NOT NULL),
u AS (SELECT word, count(DISTINCT id) AS uses, min(id) AS first_use FROM (SELECT id, unnest({OWN.format('zolai_text')}) AS word FROM bible_verses_enhanced) GROUP BY 1)
SELECT e.id, word, value AS old_value, new_value, coalesce(uses, 0) AS uses, first_use FROM e JOIN r USING (word) LEFT JOIN u USING (word)
WHERE (len(list_filter(wrong, lambda x: contains(lower(coalesce(value, '')), x))) > 0 OR word IN {rules.sql_list(ALWAYS)}) AND value IS DISTINCT FROM new_value"""
)
def gloss_corrections(spark, d):
    """the correction table has the gloss of ``entries`` for headwords whose doubtful dictionary glosses (confidence under 0.4) are wrong ones."""
    t = table(spark, d, "dictionary_enhanced").where("zolai IS NOT NULL").select("id", F.lower(F.trim("zolai")).alias("word"), F.col("english").alias("value"), "confidence")
    wrong = t.where((F.col("confidence") < 0.4) & ~T.blank(F.col("value"))).groupBy("word").agg(F.collect_set(F.lower(F.trim("value"))).alias("wrong"))
    right = table(spark, d, "entries").where(~T.blank(F.col("english"))).select(F.col("headword").alias("word"), F.col("english").alias("right"))
    usage = texts(spark, d, "bible_verses_enhanced", "id", "zolai_text").select("id", F.explode(T.words(F.lower("zolai_text"))).alias("word"))
    return joins.correct_values(t.select("id", "word", "value"), right.join(wrong, "word"), ALWAYS, usage)


@query(
    f"""WITH z AS (SELECT lower(trim(zolai)) AS w, (array_agg(english ORDER BY id) FILTER (NOT {b('english')}))[1] AS en, (array_agg(myanmar ORDER BY id) FILTER (NOT {b('myanmar')}))[1] AS my FROM dictionary_enhanced WHERE zolai IS NOT NULL GROUP BY 1)
SELECT w, en, my FROM z WHERE my IS NOT NULL"""
)
def trilingual(spark, d):
    """own -> Burmese joined with own -> English."""
    e = table(spark, d, "dictionary_enhanced").select("id", F.lower(F.trim("zolai")).alias("w"), F.col("english").alias("en"), F.col("myanmar").alias("my"))
    return joins.one_per_key(e, "w", "my", "id").join(joins.one_per_key(e, "w", "en", "id"), "w", "left").select("w", "en", "my")


@query(
    r"""WITH v AS (SELECT id, CASE WHEN book = 'NAM' THEN 'NAH' ELSE book END AS book, chapter, verse, source_version, zolai_text, english_text FROM bible_verses_enhanced),
r AS (SELECT book, chapter, verse, (array_agg(english_text ORDER BY id))[1] AS other FROM v WHERE source_version = 'ed001' AND english_text IS NOT NULL GROUP BY 1, 2, 3)
SELECT v.id, book, chapter, verse, zolai_text AS own, other FROM v JOIN r USING (book, chapter, verse)
WHERE source_version <> 'ed001' AND length(zolai_text) >= 10 AND length(other) >= 10 AND NOT regexp_matches(lower(zolai_text), '(^|\s)(pathian|fapa|bawipa)(\s|$)')"""
)
def reference_verses(spark, d):
    """the verses of the other versions with the English of the reference version."""
    from quern.operators.dedup import first_rows

    keys = ["book", "chapter", "verse"]
    v = texts(spark, d, "bible_verses_enhanced", "id", *keys, "source_version", "zolai_text", "english_text")
    ref = first_rows(v.where("source_version = 'ed001' AND english_text IS NOT NULL"), keys, [F.col("id")]).select(*keys, F.col("english_text").alias("other"))
    own = v.where("source_version <> 'ed001'").select("id", *keys, F.col("zolai_text").alias("own"))
    return joins.reference_join(own, ref, keys, {"NAM": "NAH"}, "book", 10, 10, r"(?i)(^|\s)(pathian|fapa|bawipa)(\s|$)").select("id", *keys, "own", "other")


@query(
    """WITH e AS (SELECT text, (array_agg(dialect ORDER BY collected_at DESC, doc_id DESC))[1] AS new_dialect, (array_agg(doc_type ORDER BY collected_at DESC, doc_id DESC))[1] AS new_doc_type FROM documents WHERE text IS NOT NULL AND dialect IS NOT NULL AND collected_at IS NOT NULL GROUP BY 1)
SELECT doc_id, new_dialect, new_doc_type FROM documents LEFT JOIN e USING (text)"""
)
def enrich_by_text(spark, d):
    """dialect and type of the last labelled document with exactly the same text."""
    t = table(spark, d, "documents").select("doc_id", "text", "dialect", "doc_type", "collected_at")
    last = t.where("dialect IS NOT NULL AND collected_at IS NOT NULL")
    return joins.enrich_by_text(t, last, "text", ["dialect", "doc_type"], ["collected_at", "doc_id"]).select("doc_id", "new_dialect", "new_doc_type")


@query(
    f"""WITH e AS (SELECT lower(headword) AS w, english FROM entries WHERE length(headword) >= 2 AND lower(headword) NOT IN (SELECT lower(zolai) FROM dictionary_enhanced WHERE zolai IS NOT NULL))
SELECT w, min(english) AS english FROM e GROUP BY 1"""
)
def missing_inserts(spark, d):
    """F32, M1: entries whose headword the dictionary lacks."""
    e = table(spark, d, "entries").where(F.length("headword") >= 2).select(F.lower("headword").alias("w"), "english")
    known = table(spark, d, "dictionary_enhanced").where("zolai IS NOT NULL").select(F.lower("zolai").alias("w"))
    return e.join(known, "w", "left_anti").groupBy("w").agg(F.min("english").alias("english"))
