"""Queries over lexicon building and its bookkeeping (rows of inventories B, D, E, F, G, H, J, M, N, O, P)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions import rules
from quern.functions import text as T
from quern.operators import dedup, filters, joins, knowledge, mutate, stats
from quern.plans.counts import A
from quern.plans.joined import _ALIGN, _aligned
from quern.plans.registry import query
from quern.plans.texts import CONTENT_OUT
from quern.session import table, texts

_l = rules.sql_list


def blank(c: str) -> str:
    return rf"trim(regexp_replace(coalesce({c}, ''), '\s+', ' ', 'g')) IN ('', '-')"


def words(c: str) -> str:
    return f"list_filter(string_split_regex(lower(coalesce({c}, '')), '\\s+'), lambda w: w <> '')"


@query(f"WITH f AS (SELECT zolai, myanmar, min(id) AS first FROM dictionary_enhanced WHERE NOT {blank('zolai')} AND NOT {blank('myanmar')} GROUP BY 1, 2) SELECT id FROM dictionary_enhanced d LEFT JOIN f USING (zolai, myanmar) WHERE first IS NULL OR first = id")
def duplicate_delete(spark, d):
    """E10."""
    return knowledge.drop_later(table(spark, d, "dictionary_enhanced").select("id", "zolai", "myanmar"), ["zolai", "myanmar"], "id").select("id")


_CLEAN = r"lower(trim(regexp_replace(zolai, '\s+', ' ', 'g')))"


@query(
    f"""WITH v AS (SELECT {_CLEAN} AS key, id, -length(coalesce(english, '')) AS a, zolai <> {_CLEAN} AS b, english, myanmar, pos FROM dictionary_enhanced WHERE zolai IS NOT NULL)
SELECT key, (array_agg(id ORDER BY a, b, id))[1] AS id, count(*) AS n, (array_agg(english ORDER BY a, b, id) FILTER (NOT {blank('english')}))[1] AS english,
 (array_agg(myanmar ORDER BY a, b, id) FILTER (NOT {blank('myanmar')}))[1] AS myanmar, (array_agg(pos ORDER BY a, b, id) FILTER (NOT {blank('pos')}))[1] AS pos FROM v GROUP BY 1"""
)
def collision_merge(spark, d):
    """Of headwords that are equal once cleaned the longest English, then the clean spelling, then the lowest id; blanks filled from the others."""
    t = table(spark, d, "dictionary_enhanced").where("zolai IS NOT NULL").select("id", "zolai", "english", "myanmar", "pos", dedup.phrase_key(F.col("zolai")).alias("w"))
    return dedup.merge_on_key(t, F.col("w"), [-F.length(F.coalesce("english", F.lit(""))), F.col("zolai") != F.col("w"), F.col("id")], "id", ["english", "myanmar", "pos"])


def _sources(spark, d, key: str) -> DataFrame:
    """The three lexicon tables as rows of key, priority, ord, source; the smaller priority first."""
    e = table(spark, d, "entries").select(F.col("headword").alias("zolai"), "english", F.lit(None).cast("string").alias("myanmar"), "pos", "id", F.lit(1).alias("priority"), F.lit("entries").alias("source"))
    x = table(spark, d, "dictionary_enhanced").select("zolai", "english", "myanmar", "pos", "id", F.lit(2).alias("priority"), F.lit("dictionary").alias("source"))
    v = table(spark, d, "zolai_vocabulary").select("zolai", "english", "myanmar", "pos", "id", F.lit(3).alias("priority"), F.lit("vocabulary").alias("source"))
    return e.unionAll(x).unionAll(v).withColumn("key", F.lower(F.trim(key))).withColumnRenamed("id", "ord")


_UNION = """r AS (SELECT headword AS zolai, english, NULL::VARCHAR AS myanmar, pos, id, 1 AS p, 'entries' AS source FROM entries UNION ALL SELECT zolai, english, myanmar, pos, id, 2, 'dictionary' FROM dictionary_enhanced
 UNION ALL SELECT zolai, english, myanmar, pos, id, 3, 'vocabulary' FROM zolai_vocabulary)"""


def _first(c: str) -> str:
    return f"(array_agg({c} ORDER BY p, id) FILTER (NOT {blank(c)}))[1] AS {c}"


@query(
    f"""WITH {_UNION} SELECT lower(trim(zolai)) AS key, (array_agg(source ORDER BY p, id))[1] AS first_source, list_sort(list_distinct(array_agg(source))) AS sources, {_first('english')}, {_first('myanmar')}, {_first('pos')}
FROM r WHERE NOT {blank('zolai')} AND NOT contains(trim(zolai), ' ') AND length(trim(zolai)) <= 35 AND NOT starts_with(trim(zolai), '-') GROUP BY 1"""
)
def headword_union(spark, d):
    """priority merge of three sources with the set of sources of each word."""
    return knowledge.source_union(_sources(spark, d, "zolai").where(knowledge.usable_key(F.col("zolai"))), ["english", "myanmar", "pos"])


@query(
    f"""WITH {_UNION}, u AS (SELECT trim(myanmar) AS key, zolai, english, id, p, source FROM r WHERE NOT {blank('myanmar')}
 UNION ALL SELECT trim(myanmar_text), zolai_text, english_text, id, 4, 'verses' FROM bible_verses_enhanced WHERE NOT {blank('myanmar_text')}
 UNION ALL SELECT trim(myanmar), NULL, english_clean, id, 5, 'cleaned' FROM dictionary_enhanced WHERE NOT {blank('myanmar')})
SELECT key, (array_agg(source ORDER BY p, id))[1] AS first_source, list_sort(list_distinct(array_agg(source))) AS sources, {_first('zolai')}, {_first('english')} FROM u GROUP BY 1"""
)
def burmese_union(spark, d):
    """five sources by Burmese text, the first wins, later ones fill blanks."""
    keep = lambda df: df.select(F.trim("myanmar").alias("key"), "priority", "ord", "source", "zolai", "english")
    three = keep(_sources(spark, d, "zolai").where(~T.blank(F.col("myanmar"))))
    v = table(spark, d, "bible_verses_enhanced").where(~T.blank(F.col("myanmar_text")))
    v = v.select(F.trim("myanmar_text").alias("key"), F.lit(4).alias("priority"), F.col("id").alias("ord"), F.lit("verses").alias("source"), F.col("zolai_text").alias("zolai"), F.col("english_text").alias("english"))
    c = table(spark, d, "dictionary_enhanced").where(~T.blank(F.col("myanmar")))
    c = c.select(F.trim("myanmar").alias("key"), F.lit(5).alias("priority"), F.col("id").alias("ord"), F.lit("cleaned").alias("source"), F.lit(None).cast("string").alias("zolai"), F.col("english_clean").alias("english"))
    return knowledge.source_union(three.unionAll(v).unionAll(c), ["zolai", "english"])


@query(
    f"""WITH r AS (SELECT lower(trim(zolai)) AS key, english, frequency_corpus, id, source_priority AS p, coalesce(source_category, '?') AS source FROM zolai_vocabulary WHERE zolai IS NOT NULL)
SELECT key, (array_agg(source ORDER BY p, id))[1] AS first_source, list_sort(list_distinct(array_agg(source))) AS sources, {_first('english')}, max(frequency_corpus) AS frequency_corpus FROM r GROUP BY 1"""
)
def vocabulary_frequencies(spark, d):
    """the largest frequency, the first translation by source order and the set of sources of each word."""
    t = table(spark, d, "zolai_vocabulary").where("zolai IS NOT NULL")
    t = t.select(F.lower(F.trim("zolai")).alias("key"), F.col("source_priority").alias("priority"), F.col("id").alias("ord"), F.coalesce("source_category", F.lit("?")).alias("source"), "english", "frequency_corpus")
    return knowledge.source_union(t, ["english"], ["frequency_corpus"])


#: function words with their glosses; the first source of a rebuild
GRAMMAR = [("hi", "is"), ("in", "by"), ("leh", "and"), ("lo", "not"), ("kei", "not"), ("ding", "will"), ("hiam", "?"), ("uh", "plural"), ("tawh", "with"), ("ah", "at")]
_G = " UNION ALL ".join(f"SELECT '{w}' AS key, '{g}' AS english, 'grammar' AS source, 1 AS p, {i} AS id" for i, (w, g) in enumerate(GRAMMAR))


@query(
    f"""WITH f AS (SELECT w AS key, count(*) AS n FROM (SELECT unnest({A.format('zolai_text')}) AS w FROM bible_verses_enhanced) GROUP BY 1),
r AS ({_G} UNION ALL SELECT headword, trim(english), 'entries', 2, id FROM entries WHERE NOT {blank('english')} UNION ALL SELECT lower(trim(zolai)), trim(english), 'dictionary', 3, id FROM dictionary_enhanced WHERE NOT {blank('english')} AND NOT {blank('zolai')}
 UNION ALL SELECT key, '[untranslated — freq:' || n || ']', 'corpus_only', 4, 0 FROM f WHERE n >= 10 AND length(key) > 1)
SELECT key, (array_agg(source ORDER BY p, id))[1] AS first_source, {_first('english')}, coalesce(max(n), 0) AS frequency FROM r LEFT JOIN f USING (key) GROUP BY 1"""
)
def dictionary_rebuild(spark, d):
    """grammar, then entries, then other translations, then frequent words without one."""
    f = texts(spark, d, "bible_verses_enhanced", "zolai_text").select(F.explode(T.tokens(F.col("zolai_text"), "alpha")).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("frequency"))
    row = lambda df, key, english, source, p, order: df.select(key.alias("key"), english.alias("english"), F.lit(source).alias("source"), F.lit(p).alias("priority"), order.cast("bigint").alias("ord"))
    g = spark.createDataFrame([(w, m, i) for i, (w, m) in enumerate(GRAMMAR)], "w string, m string, i int")
    e = table(spark, d, "entries").where(~T.blank(F.col("english")))
    x = table(spark, d, "dictionary_enhanced").where(~T.blank(F.col("english")) & ~T.blank(F.col("zolai")))
    often = f.where((F.col("frequency") >= 10) & (F.length("key") > 1))
    parts = [
        row(g, F.col("w"), F.col("m"), "grammar", 1, F.col("i")), row(e, F.col("headword"), F.trim("english"), "entries", 2, F.col("id")), row(x, F.lower(F.trim("zolai")), F.trim("english"), "dictionary", 3, F.col("id")),
        row(often, F.col("key"), F.format_string("[untranslated — freq:%d]", "frequency"), "corpus_only", 4, F.lit(0)),
    ]
    u = knowledge.source_union(reduce(DataFrame.unionAll, parts), ["english"])
    return u.join(f, "key", "left").select("key", "first_source", "english", F.coalesce("frequency", F.lit(0).cast("bigint")).alias("frequency"))


_EXT = rf"list_filter(regexp_extract_all(lower(coalesce(zolai_text, '')), '[a-zà-ɏ'']+|[,;:!.?-]+'), lambda t: t NOT IN {CONTENT_OUT} AND length(t) > 1 AND NOT regexp_matches(t, '^[,;:!.?]'))"


@query(
    rf"""WITH v AS (SELECT book, list_sort(list_distinct({_EXT})) AS w FROM bible_verses_enhanced),
c AS (SELECT w[i] AS a, unnest(w[i + 1:]) AS b FROM (SELECT w, unnest(range(1, len(w))) AS i FROM v)), p AS (SELECT a, b, count(*) AS n FROM c GROUP BY 1, 2),
m AS (SELECT a AS word, b AS related, n FROM p UNION ALL SELECT b, a, n FROM p), t AS (SELECT related AS word, sum(n) AS total FROM m GROUP BY 1),
k AS (SELECT word, count(DISTINCT book) AS books FROM (SELECT book, unnest(w) AS word FROM v) GROUP BY 1),
f AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY n DESC, related) AS r FROM m),
g AS (SELECT word, related, n FROM f WHERE r <= 30 AND n > 5 AND NOT contains(related, '''') AND related IN (SELECT word FROM k WHERE books >= 3) AND related IN (SELECT word FROM t WHERE total <= 0.3 * (SELECT max(total) FROM t)) AND word IN (SELECT word FROM k WHERE books >= 2))
SELECT word, row_number() OVER (PARTITION BY word ORDER BY n DESC, related)::INT AS rank, related, n FROM g QUALIFY rank <= 8"""
)
def related_words(spark, d):
    """G12."""
    v = texts(spark, d, "bible_verses_enhanced", "book", "zolai_text").select("book", T.content_words(T.tokens(F.col("zolai_text"), "ext")).alias("w"))
    pairs = stats.cooccurrence(v.withColumn("all", F.lit(1)), "all", F.col("w")).drop("all")
    books = v.select("book", F.explode("w").alias("word")).distinct().groupBy("word").agg(F.count("book").alias("books"))
    return knowledge.related_words(pairs, books)


@query(
    f"""WITH v AS (SELECT {A.format('zolai_text')} AS w FROM bible_verses_enhanced), p AS (SELECT w, list_filter(range(1, len(w) + 1), lambda i: w[i] IN ('kei', 'lo'))[1] AS i FROM v),
c AS (SELECT list_filter(w[greatest(i - 3, 1):i + 3], lambda x: x NOT IN ('kei', 'lo', 'hi', 'a', 'in', 'uh') AND length(x) > 2) AS c FROM p WHERE i IS NOT NULL),
o AS (SELECT c[1] AS word, unnest(c[2:]) AS opposite FROM c WHERE len(c) >= 2), n AS (SELECT word, opposite, count(*) AS n FROM o WHERE word <> opposite GROUP BY 1, 2)
SELECT word, row_number() OVER (PARTITION BY word ORDER BY n DESC, opposite)::INT AS rank, opposite, n FROM n QUALIFY rank <= 5 AND n >= 2"""
)
def negation_antonyms(spark, d):
    """G13."""
    return knowledge.negation_antonyms(texts(spark, d, "bible_verses_enhanced", "zolai_text"), T.tokens(F.col("zolai_text"), "alpha"), ["kei", "lo"], ["hi", "a", "in", "uh"])


@query(
    _ALIGN
    + f""", dd AS (SELECT lower(trim(zolai)) AS word, list_sort(list_distinct(array_agg(lower(trim(english))) FILTER (NOT {blank('english')}))) AS meanings, (array_agg(pos ORDER BY id) FILTER (NOT {blank('pos')}))[1] AS pos FROM zolai_vocabulary WHERE zolai IS NOT NULL GROUP BY 1),
f AS (SELECT word, count(*) AS frequency, round(avg(confidence), 2) AS confidence FROM a GROUP BY 1),
x AS (SELECT word, array_agg(id || ': ' || meaning ORDER BY id) AS examples FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY id) AS r FROM a) WHERE r <= 3 GROUP BY 1),
t AS (SELECT {words('zolai_text')} AS w FROM bible_verses_enhanced), n0 AS (SELECT w[i] AS word, w[j] AS near FROM (SELECT w, i, unnest(range(greatest(1, i - 2), least(len(w), i + 2) + 1)) AS j FROM (SELECT w, unnest(range(1, len(w) + 1)) AS i FROM t)) WHERE i <> j),
n1 AS (SELECT word, near, count(*) AS n FROM n0 WHERE length(near) > 1 GROUP BY 1, 2), c AS (SELECT word, array_agg(near || ':' || n ORDER BY r) AS collocations FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY n DESC, near) AS r FROM n1) WHERE r <= 5 GROUP BY 1)
SELECT word, coalesce(meanings[1], '') AS english, coalesce(pos, '') AS pos, coalesce(meanings, [])[1:5] AS meanings, coalesce(frequency, 0) AS frequency, coalesce(examples, []) AS examples, coalesce(collocations, []) AS collocations,
 coalesce(confidence, 0.5) AS confidence, CASE WHEN dd.word IS NULL THEN 'corpus_only' ELSE 'vocabulary' END AS source
FROM dd FULL JOIN f USING (word) LEFT JOIN x USING (word) LEFT JOIN c USING (word)"""
)
def alignment_vocabulary(spark, d):
    """G14."""
    v = table(spark, d, "zolai_vocabulary").where("zolai IS NOT NULL").withColumn("word", F.lower(F.trim("zolai")))
    v = v.groupBy("word").agg(
        F.array_sort(F.collect_set(F.when(~T.blank(F.col("english")), F.lower(F.trim("english"))))).alias("meanings"), F.min(F.when(~T.blank(F.col("pos")), F.struct("id", "pos"))).alias("p"), F.lit("vocabulary").alias("source")
    )
    t = texts(spark, d, "bible_verses_enhanced", "zolai_text").select(T.words(F.lower("zolai_text")).alias("ws"))
    return knowledge.alignment_vocabulary(v.select("word", "meanings", F.col("p.pos").alias("pos"), "source"), _aligned(spark, d), t)


@query(
    r"""WITH o AS (SELECT lower(trim(zolai)) AS word, sum(coalesce(frequency_corpus, 0)) AS n FROM zolai_vocabulary WHERE zolai IS NOT NULL GROUP BY 1),
w AS (SELECT regexp_replace(lower(unnest(string_split_regex(content, '\s+'))), '^[.,!?;:"''()-]+|[.,!?;:"''()-]+$', '', 'g') AS word FROM articles),
c AS (SELECT word, count(*) AS n FROM w WHERE length(word) > 2 GROUP BY 1)
SELECT word, sum(n)::BIGINT AS n FROM (SELECT * FROM o UNION ALL SELECT * FROM c) GROUP BY 1"""
)
def article_usage(spark, d):
    """Word counts of all articles added to the stored usage, new words inserted."""
    old = table(spark, d, "zolai_vocabulary").where("zolai IS NOT NULL").groupBy(F.lower(F.trim("zolai")).alias("word")).agg(F.sum(F.coalesce("frequency_corpus", F.lit(0))).cast("bigint").alias("n"))
    w = table(spark, d, "articles").select(F.explode(F.split("content", r"\s+")).alias("w")).select(F.regexp_replace(F.lower("w"), r"""^[.,!?;:"'()\-]+|[.,!?;:"'()\-]+$""", "").alias("word"))
    return mutate.increment(old, w.where(F.length("word") > 2).groupBy("word").agg(F.count(F.lit(1)).alias("n")), "word", "n")


@query(
    """WITH c AS (SELECT d.id, d.zolai, d.english_clean AS english, v.frequency_corpus AS frequency FROM dictionary_enhanced d JOIN zolai_vocabulary v ON v.zolai = d.zolai
 WHERE d.source_category = 'dict' AND d.zolai <> d.english_clean AND v.frequency_corpus > 100 ORDER BY v.frequency_corpus DESC, d.id, v.id LIMIT 30)
SELECT c.*, CASE WHEN e.english IS NULL THEN NULL WHEN e.english = c.english THEN 'correct' ELSE 'incorrect: ' || e.english END AS verdict, CASE WHEN e.english IS NULL THEN NULL ELSE e.english = c.english END AS correct FROM c LEFT JOIN entries e ON e.headword = c.zolai"""
)
def verdict_reconciliation(spark, d):
    """The most frequent dictionary words (a top-30 report) with the stored verdicts; here the entries stand in for the model's answers."""
    x = table(spark, d, "dictionary_enhanced").where("source_category = 'dict' AND zolai <> english_clean").select("id", "zolai", F.col("english_clean").alias("english"))
    v = table(spark, d, "zolai_vocabulary").where("frequency_corpus > 100").select("zolai", F.col("frequency_corpus").alias("frequency"), F.col("id").alias("v_id"))
    top = x.join(v, "zolai").orderBy(F.desc("frequency"), "id", "v_id").limit(30).drop("v_id")
    e = table(spark, d, "entries").select(F.col("headword").alias("zolai"), F.col("english").alias("said"))
    j = top.join(e, "zolai", "left").withColumn("verdict", F.when(F.col("said") == F.col("english"), "correct").otherwise(F.concat(F.lit("incorrect: "), "said")))
    return j.select("id", "zolai", "english", "frequency", "verdict", F.col("verdict").startswith("correct").alias("correct"))


def _fill_sql(name: str, key: str) -> str:
    return f"SELECT '{name}' AS table_name, t.id, s.v AS myanmar FROM {name} t JOIN s ON t.{key} = s.k WHERE {blank('t.myanmar')}"


@query(
    f"""WITH s AS (SELECT zolai AS k, (array_agg(myanmar ORDER BY id))[1] AS v FROM dictionary_enhanced WHERE zolai IS NOT NULL AND NOT {blank('myanmar')} GROUP BY 1),
titles AS (SELECT id, title, NULL::VARCHAR AS myanmar FROM zolai_songs), heads AS (SELECT id, headword, NULL::VARCHAR AS myanmar FROM entries)
{_fill_sql('zolai_vocabulary', 'zolai')} UNION ALL {_fill_sql('heads', 'headword')} UNION ALL {_fill_sql('titles', 'title')}"""
)
def correction_fills(spark, d):
    """Blank Burmese of three tables filled from the dictionary after correction; the filled rows."""
    source = table(spark, d, "dictionary_enhanced").select("id", F.col("zolai").alias("k"), "myanmar")
    none = F.lit(None).cast("string").alias("myanmar")
    targets = {
        "zolai_vocabulary": table(spark, d, "zolai_vocabulary").select("id", F.col("zolai").alias("key"), "myanmar"), "heads": table(spark, d, "entries").select("id", F.col("headword").alias("key"), none),
        "titles": table(spark, d, "zolai_songs").select("id", F.col("title").alias("key"), none),
    }
    fills = [joins.fill_blank(t.where(T.blank(F.col("myanmar"))), source, ("key", "k"), "myanmar").where(~T.blank(F.col("myanmar"))).select(F.lit(n).alias("table_name"), "id", "myanmar") for n, t in targets.items()]
    return reduce(DataFrame.unionAll, fills)


@query(
    f"""WITH f AS (SELECT w AS word, min(lang) AS reason FROM (SELECT lang, unnest({A.format('sample_text')}) AS w FROM language_samples WHERE lang IN ('mizo', 'falam')) GROUP BY 1),
c AS (SELECT DISTINCT unnest({A.format('zolai_text')}) AS w FROM bible_verses_enhanced), k AS (SELECT DISTINCT lower(trim(zolai)) AS w FROM dictionary_enhanced WHERE zolai IS NOT NULL)
SELECT word, reason, word IN (SELECT w FROM c) AS in_corpus, word IN (SELECT w FROM k) AS in_dictionary, CASE WHEN word IN (SELECT w FROM c) THEN 'cognate' WHEN word IN (SELECT w FROM k) THEN 'present' ELSE 'absent' END AS category FROM f"""
)
def foreign_headwords(spark, d):
    """The foreign-word list has the words of the samples of two neighbour languages."""
    s = table(spark, d, "language_samples").where("lang IN ('mizo', 'falam')").select("lang", F.explode(T.tokens(F.col("sample_text"), "alpha")).alias("word"))
    c = texts(spark, d, "bible_verses_enhanced", "zolai_text").select(F.explode(T.tokens(F.col("zolai_text"), "alpha")).alias("word"))
    return knowledge.foreign_headwords(s.groupBy("word").agg(F.min("lang").alias("reason")), table(spark, d, "dictionary_enhanced").select(F.lower(F.trim("zolai")).alias("word")), c)


_D17 = {k: v.replace("'", "''") for k, v in {"deny": filters.DIALECT_DENY, "join": filters.DIALECT_CONNECTORS, "explain": filters.DIALECT_EXPLAIN, "quote": filters.DIALECT_QUOTE}.items()}


@query(
    rf"""WITH t AS (SELECT doc_id, trim(text) AS t FROM documents WHERE trim(coalesce(text, '')) <> ''),
r AS (SELECT doc_id, t, CASE WHEN regexp_matches(t, '{_D17['deny']}') AND NOT regexp_matches(t, '{_D17['explain']}') AND NOT regexp_matches(t, '{_D17['quote']}') THEN 'dialect' WHEN regexp_matches(t, '{_D17['join']}') AND NOT regexp_matches(t, '{_D17['explain']}') THEN 'connector' ELSE 'kept' END AS reason FROM t)
SELECT doc_id, CASE WHEN reason = 'kept' AND row_number() OVER (PARTITION BY reason, t ORDER BY doc_id) > 1 THEN 'duplicate' ELSE reason END AS reason FROM r"""
)
def dialect_filter(spark, d):
    """D17."""
    return filters.dialect_reasons(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text")


@query(
    f"WITH o AS (SELECT unnest({rules.sql_array(rules.BOOK_ORDER)}) AS book, unnest(range(1, {len(rules.BOOK_ORDER) + 1})) AS book_no) SELECT id, coalesce(book_no, {len(rules.BOOK_ORDER) + 1})::INT AS book_no, row_number() OVER (PARTITION BY book ORDER BY chapter, verse, id) AS place FROM bible_verses_enhanced LEFT JOIN o USING (book)"
)
def canonical_order(spark, d):
    """Each verse's book number in the canonical order and its place within the book."""
    from pyspark.sql import Window

    no = F.array_position(F.array(*[F.lit(x) for x in rules.BOOK_ORDER]), F.col("book"))
    place = F.row_number().over(Window.partitionBy("book").orderBy("chapter", "verse", "id")).cast("bigint")
    return table(spark, d, "bible_verses_enhanced").select("id", F.when(no > 0, no).otherwise(len(rules.BOOK_ORDER) + 1).cast("int").alias("book_no"), place.alias("place"))


WANTED = [("GEN", 1, 1, 99), ("PSA", 3, 2, 6), ("JHN", 2, 1, 99), ("REV", 9, 5, 5)]


@query("SELECT book, chapter, verse, source_version, zolai_text, english_text, myanmar_text FROM bible_verses_enhanced WHERE " + " OR ".join(f"(book = '{b}' AND chapter = {c} AND verse BETWEEN {v} AND {w})" for b, c, v, w in WANTED))
def parallel_verses(spark, d):
    """The verses of wanted references side by side; the filter reaches the scan."""
    hit = reduce(lambda a, b: a | b, [(F.col("book") == b) & (F.col("chapter") == c) & F.col("verse").between(v, w) for b, c, v, w in WANTED])
    return table(spark, d, "bible_verses_enhanced").where(hit).select("book", "chapter", "verse", "source_version", "zolai_text", "english_text", "myanmar_text")


@query(
    r"""WITH w AS (SELECT DISTINCT lower(trim(zolai)) AS word FROM zolai_vocabulary WHERE regexp_matches(zolai, '^[A-Za-z-]+$')),
c AS (SELECT word, regexp_replace(regexp_replace(word, '((?:[ckptz]h|[^aeiou\-])?[aeiou]+)', '-\1', 'g'), '(^|-)-*([^aeiou\-]+)-([^aeiou\-]*[aeiou])', '\1\2\3', 'g') AS c FROM w)
SELECT word, list_filter(string_split(c, '-'), lambda x: x <> '') AS syllables, len(list_filter(string_split(c, '-'), lambda x: x <> ''))::INT AS n FROM c ORDER BY word"""
)
def syllable_export(spark, d):
    """Every vocabulary word of plain letters with its syllables, in order."""
    w = table(spark, d, "zolai_vocabulary").where(F.col("zolai").rlike("^[A-Za-z-]+$")).select(F.lower(F.trim("zolai")).alias("word")).distinct()
    return w.select("word", knowledge.syllables(F.col("word")).alias("syllables")).withColumn("n", F.size("syllables")).orderBy("word")


@query(
    f"""SELECT 'coverage' AS section, 'english' AS metric, count(*) FILTER (NOT {blank('english')})::DOUBLE AS value FROM zolai_vocabulary UNION ALL SELECT 'coverage', 'myanmar', count(*) FILTER (NOT {blank('myanmar')}) FROM zolai_vocabulary
 UNION ALL SELECT 'duplicates', 'verses', count(*) FROM (SELECT 1 FROM bible_verses_enhanced GROUP BY book, chapter, verse, source_version HAVING count(*) > 1)
 UNION ALL SELECT 'rows', 'bible_verses_enhanced', count(*) FROM bible_verses_enhanced UNION ALL SELECT 'rows', 'zolai_vocabulary', count(*) FROM zolai_vocabulary"""
)
def audit_report(spark, d):
    """The audit as rows; report_markdown renders them."""
    v, b = table(spark, d, "zolai_vocabulary"), table(spark, d, "bible_verses_enhanced")
    return knowledge.report(
        {
            "coverage": stats.coverage(v, ["english", "myanmar"]).select(F.col("column_name").alias("metric"), F.col("filled").alias("value")),
            "duplicates": b.groupBy("book", "chapter", "verse", "source_version").count().where("count > 1").agg(F.lit("verses").alias("metric"), F.count(F.lit(1)).alias("value")),
            "rows": stats.row_counts({"bible_verses_enhanced": b, "zolai_vocabulary": v}).select(F.col("table_name").alias("metric"), F.col("n").alias("value")),
        }
    )


@query("WITH r AS (SELECT DISTINCT lower(trim(zolai)) AS word FROM zolai_vocabulary WHERE zolai IS NOT NULL) SELECT word, english, headword IS NOT NULL AS cached FROM r LEFT JOIN entries ON headword = word")
def cached_answers(spark, d):
    """Vocabulary words answered from a stored table of glosses."""
    r = table(spark, d, "zolai_vocabulary").select(F.lower(F.trim("zolai")).alias("word"))
    return knowledge.from_cache(r, table(spark, d, "entries").select(F.col("headword").alias("word"), "english"), "word", "english")


@query(
    f"""SELECT 'dictionary' AS category, id, trim(zolai) || ': ' || trim(english) AS text FROM dictionary_enhanced WHERE NOT {blank('zolai')} AND NOT {blank('english')}
UNION ALL SELECT 'evaluation', item_id, 'Q: ' || question || chr(10) || 'A: ' || answer FROM eval_items WHERE question IS NOT NULL AND answer IS NOT NULL
UNION ALL SELECT 'monolingual', doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) FROM documents WHERE length(trim(regexp_replace(text, '\\s+', ' ', 'g'))) >= 20
UNION ALL SELECT 'parallel', id, zolai_text || chr(9) || english_text FROM bible_verses_enhanced WHERE NOT {blank('zolai_text')} AND NOT {blank('english_text')}"""
)
def category_records(spark, d):
    """Each category of sources by its own processor."""
    both = lambda a, b: ~T.blank(F.col(a)) & ~T.blank(F.col(b))
    return knowledge.by_category(
        {
            "monolingual": (table(spark, d, "documents"), lambda t: t.select(F.col("doc_id").alias("id"), T.squeeze(F.col("text")).alias("text")).where(F.length("text") >= 20)),
            "parallel": (table(spark, d, "bible_verses_enhanced"), lambda t: t.where(both("zolai_text", "english_text")).select("id", F.concat_ws("\t", "zolai_text", "english_text").alias("text"))),
            "dictionary": (table(spark, d, "dictionary_enhanced"), lambda t: t.where(both("zolai", "english")).select("id", F.concat_ws(": ", F.trim("zolai"), F.trim("english")).alias("text"))),
            "evaluation": (table(spark, d, "eval_items"), lambda t: t.where("question IS NOT NULL AND answer IS NOT NULL").select(F.col("item_id").alias("id"), F.concat(F.lit("Q: "), "question", F.lit("\nA: "), "answer").alias("text"))),
        }
    )


TASKS = [
    (knowledge.FillTask("dictionary_burmese", "myanmar", "zolai", "zolai RLIKE '^[a-z-]+$' AND trim(coalesce(english_clean, '')) <> ''", "Translate {zolai} ({english_clean}) to Burmese."), "dictionary_enhanced"),
    (knowledge.FillTask("vocabulary_english", "english", "zolai", "zolai IS NOT NULL", "Translate {zolai} to English; part of speech: {pos}."), "zolai_vocabulary"),
]


@query(
    f"""SELECT 'dictionary_burmese' AS task, zolai AS key, min('Translate ' || zolai || ' (' || english_clean || ') to Burmese.') AS prompt FROM dictionary_enhanced WHERE {blank('myanmar')} AND regexp_matches(zolai, '^[a-z-]+$') AND trim(coalesce(english_clean, '')) <> '' GROUP BY 2
UNION ALL SELECT 'vocabulary_english', zolai, min('Translate ' || zolai || ' to English; part of speech: ' || coalesce(pos, '') || '.') FROM zolai_vocabulary WHERE {blank('english')} AND zolai IS NOT NULL GROUP BY 2"""
)
def fill_tasks(spark, d):
    """What the declared tasks still have to fill, with their prompts (the model that answers is left out)."""
    return reduce(DataFrame.unionAll, [t.pending(table(spark, d, name)) for t, name in TASKS])


@query(
    f"""WITH a AS (SELECT headword, min(english) AS answer FROM entries GROUP BY 1)
SELECT id, zolai, CASE WHEN {blank('v.english')} AND zolai IS NOT NULL THEN coalesce(answer, v.english) ELSE v.english END AS english FROM zolai_vocabulary v LEFT JOIN a ON headword = zolai"""
)
def filled_tasks(spark, d):
    """Stored answers applied to a task's table."""
    a = table(spark, d, "entries").select(F.lit("vocabulary_english").alias("task"), F.col("headword").alias("key"), F.col("english").alias("answer"))
    return TASKS[1][0].apply(table(spark, d, "zolai_vocabulary").select("id", "zolai", "english"), a)


@query(
    """WITH s AS (SELECT source_path, content_hash FROM wiki_content WHERE created_at < TIMESTAMP '2024-02-01'), i AS (SELECT source_path, content_hash FROM wiki_content)
SELECT i.source_path, CASE WHEN s.content_hash = i.content_hash THEN 'skip' WHEN s.source_path IS NOT NULL THEN 'replace' ELSE 'new' END AS state FROM i LEFT JOIN s USING (source_path)"""
)
def unchanged_skip(spark, d):
    """Pages against the provenance stored up to a day."""
    t = table(spark, d, "wiki_content")
    return knowledge.provenance_state(t.select("source_path", "content_hash"), t.where("created_at < TIMESTAMP_NTZ'2024-02-01'").select("source_path", "content_hash"), "source_path", "content_hash")


@query(
    r"""WITH n AS (SELECT *, lower(trim(pos)) AS np, trim(english) AS ne FROM entries), x AS (SELECT *, np IS DISTINCT FROM pos AS a, ne IS DISTINCT FROM english AS b FROM n)
SELECT id, np AS pos, ne AS english, CASE WHEN a OR b THEN CASE WHEN regexp_matches(entry_version, '^v([0-9]+)(\.[0-9]+)?$') THEN 'v' || (regexp_extract(entry_version, '^v([0-9]+)', 1)::INT + 1) || '.0' ELSE 'v2.0' END ELSE entry_version END AS entry_version,
 CASE WHEN a OR b THEN concat_ws('; ', CASE WHEN b THEN 'english: ' || english || ' -> ' || ne END, CASE WHEN a THEN 'pos: ' || pos || ' -> ' || np END) END AS update_remarks FROM x"""
)
def versioned_entries(spark, d):
    """Entries whose part of speech or English is put in order get a new version and remarks."""
    t = table(spark, d, "entries").select("id", "pos", "english", "entry_version")
    return knowledge.new_versions(t, {"english": F.trim("english"), "pos": F.lower(F.trim("pos"))}, "entry_version", "update_remarks")
