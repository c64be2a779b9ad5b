"""Queries over word, book and chapter profiles, line filters and lookups (rows of inventories C, D, G, J, K, L, N, O, P)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quern.functions import rules
from quern.functions import text as T
from quern.operators import filters, lexicon, patterns, stats, training
from quern.plans.counts import VERSE_W, A
from quern.plans.joined import _ALIGN, _aligned
from quern.plans.registry import query
from quern.session import table, texts

_l = rules.sql_list
PLAIN = sorted(set(rules.PARTICLES + rules.STOPWORDS))


def _verses(spark, d, *more):
    return texts(spark, d, "bible_verses_enhanced", "id", "book", "zolai_text", *more)


def _z():
    return T.tokens(F.col("zolai_text"), "alpha")


@query(
    f"""WITH c AS (SELECT book, word, count(*) AS n, count(DISTINCT id) AS v FROM ({VERSE_W}) GROUP BY 1, 2), t AS (SELECT word, sum(v) AS a FROM c GROUP BY 1)
SELECT book, 'top' AS kind, word, n FROM c QUALIFY row_number() OVER (PARTITION BY book ORDER BY n DESC, word) <= 20 UNION ALL SELECT book, 'specific', word, v FROM c JOIN t USING (word) WHERE v >= 5 AND a - v <= 1"""
)
def book_words(spark, d):
    """The twenty leading words of each book and the words specific to it; book_profile has its counts."""
    v = _verses(spark, d)
    c = stats.word_counts(v.select("book", F.explode(_z()).alias("word")), "word", ["book"])
    top = stats.top_per_group(c, ["book"], 20, [F.desc("n"), F.col("word")]).select("book", F.lit("top").alias("kind"), "word", "n")
    own = stats.specific_words(v, "book", "id", _z())
    return top.unionAll(own.select("book", F.lit("specific").alias("kind"), "word", F.col("n_docs").alias("n")))


@query(
    f"""WITH v AS (SELECT book, chapter, id, {A.format('zolai_text')} AS w FROM bible_verses_enhanced), e AS (SELECT book, chapter, unnest(w) AS word FROM v), c AS (SELECT book, chapter, word, count(*) AS n FROM e WHERE length(word) > 1 AND word NOT IN {_l(PLAIN)} GROUP BY 1, 2, 3),
t AS (SELECT book, chapter, array_agg(word ORDER BY n DESC, word) AS top FROM (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY book, chapter ORDER BY n DESC, word) <= 10) GROUP BY 1, 2)
SELECT v.book, v.chapter, count(*) AS verses, round(avg(len(w)), 6) AS mean_tokens, coalesce(any_value(u.k), 0) AS content_words, array_to_string(coalesce(any_value(top), []), ' ') AS top, array_to_string(coalesce(any_value(top), [])[1:5], ' ') AS theme
FROM v LEFT JOIN t ON t.book = v.book AND t.chapter = v.chapter LEFT JOIN (SELECT book, chapter, count(*) AS k FROM c GROUP BY 1, 2) u ON u.book = v.book AND u.chapter = v.chapter GROUP BY 1, 2"""
)
def chapter_profiles(spark, d):
    """Verses, mean tokens, distinct content words, ten leading ones, and the first five as theme."""
    v = _verses(spark, d, "chapter").select("book", "chapter", _z().alias("w"))
    c = stats.word_counts(v.select("book", "chapter", F.explode(T.content_words(F.col("w"))).alias("word")), "word", ["book", "chapter"])
    top = stats.top_per_group(c, ["book", "chapter"], 10, [F.desc("n"), F.col("word")]).groupBy("book", "chapter").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "word"))), lambda x: x["word"]).alias("t"))
    k = c.groupBy("book", "chapter").agg(F.count(F.lit(1)).alias("k"))
    j = v.groupBy("book", "chapter").agg(F.count(F.lit(1)).alias("verses"), F.round(F.avg(F.size("w")), 6).alias("mean_tokens")).join(k, ["book", "chapter"], "left").join(top, ["book", "chapter"], "left")
    words = F.coalesce("t", F.array().cast("array<string>"))
    return j.select("book", "chapter", "verses", "mean_tokens", F.coalesce("k", F.lit(0).cast("bigint")).alias("content_words"), F.array_join(words, " ").alias("top"), F.array_join(F.slice(words, 1, 5), " ").alias("theme"))


@query(
    f"""WITH v AS (SELECT id, {A.format('zolai_text')} AS w FROM bible_verses_enhanced), i AS (SELECT id, w, unnest(range(1, len(w))) AS i FROM v),
g AS (SELECT id, w[i] || ' ' || w[i + 1] AS gram, CASE WHEN i > 1 THEN w[i - 1] END AS l, w[i + 2] AS r FROM i)
SELECT gram, count(*) AS n, count(DISTINCT l) AS lefts, count(DISTINCT r) AS rights, array_to_string(list_sort(list_distinct(array_agg(id)))[1:10], ' ') AS places FROM g GROUP BY 1 HAVING count(*) >= 3"""
)
def bigram_contexts(spark, d):
    """Bigrams seen three times, with the first ten places and how many words stand on either side."""
    v = _verses(spark, d).select("id", _z().alias("w"))
    e = v.select("id", F.explode(F.expr("transform(slice(w, 1, greatest(size(w) - 1, 0)), (x, i) -> struct(concat(x, ' ', w[i + 1]) AS gram, if(i > 0, get(w, i - 1), null) AS l, get(w, i + 2) AS r))")).alias("g")).select("id", "g.*")
    n = e.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("l").alias("lefts"), F.countDistinct("r").alias("rights")).where("n >= 3")
    first = e.select("gram", "id").distinct().withColumn("k", F.row_number().over(Window.partitionBy("gram").orderBy("id"))).where("k <= 10")
    places = first.groupBy("gram").agg(F.array_join(F.sort_array(F.collect_list("id")).cast("array<string>"), " ").alias("places"))
    return n.join(places, "gram")


@query(
    f"""WITH v AS (SELECT {A.format('zolai_text')} AS w FROM bible_verses_enhanced), u AS (SELECT word, count(*) AS f FROM (SELECT unnest(w) AS word FROM v) GROUP BY 1),
b AS (SELECT w[i] AS x, w[i + 1] AS y, NULL AS z, count(*) AS n FROM (SELECT w, unnest(range(1, len(w))) AS i FROM v) GROUP BY 1, 2), t AS (SELECT w[i] AS x, w[i + 1] AS y, w[i + 2] AS z, count(*) AS n FROM (SELECT w, unnest(range(1, len(w) - 1)) AS i FROM v) GROUP BY 1, 2, 3),
r AS (SELECT x || ' ' || y AS gram, 2 AS size, n, n / (a.f * c.f) AS ratio FROM b JOIN u a ON a.word = x JOIN u c ON c.word = y UNION ALL SELECT x || ' ' || y || ' ' || z, 3, n, n / (a.f * c.f * e.f) FROM t JOIN u a ON a.word = x JOIN u c ON c.word = y JOIN u e ON e.word = z)
SELECT gram, size, n, round(ratio, 9) AS ratio FROM r WHERE n >= 2 AND ratio > CASE size WHEN 2 THEN 1e-3 ELSE 1e-4 END"""
)
def idiom_candidates(spark, d):
    """Bigrams above 1e-3 and trigrams above 1e-4, seen at least twice."""
    v = _verses(spark, d).select(_z().alias("w"))
    u = v.select(F.explode("w").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("f"))

    def ratio(size, limit):
        g = stats.ngram_counts(v, F.col("w"), size).where("n >= 2").withColumn("p", F.split("gram", " "))
        for i in range(size):
            g = g.withColumn("word", F.col("p")[i]).join(u.withColumnRenamed("f", f"f{i}"), "word").drop("word")
        product = F.lit(1.0)
        for i in range(size):
            product = product * F.col(f"f{i}")
        return g.select("gram", F.lit(size).alias("size"), "n", (F.col("n") / product).alias("ratio")).where(F.col("ratio") > limit)

    return ratio(2, 1e-3).unionAll(ratio(3, 1e-4)).withColumn("ratio", F.round("ratio", 9))


@query(
    f"""WITH v AS (SELECT book, {A.format('zolai_text')} AS w FROM bible_verses_enhanced WHERE zolai_text IS NOT NULL)
SELECT book, round(avg(CASE WHEN coalesce(list_position(w, 'in'), 0) > 0 AND list_position(w, 'in') < len(w) - 1 AND w[-1] IN ('hi', 'hen', 'ah') THEN 1.0 ELSE 0 END), 6) AS sov, round(avg(CASE WHEN list_contains(w, 'ding') THEN 1.0 ELSE 0 END), 6) AS future,
 round(avg(CASE WHEN NOT list_contains(w, 'ding') AND list_contains(w, 'ta') THEN 1.0 ELSE 0 END), 6) AS past, round(avg(CASE WHEN NOT list_contains(w, 'ding') AND NOT list_contains(w, 'ta') THEN 1.0 ELSE 0 END), 6) AS present FROM v GROUP BY 1"""
)
def book_tenses(spark, d):
    """Rate of verb-final sentences and tenses of each book; book_patterns has negation, question and length."""
    w = _verses(spark, d).where("zolai_text IS NOT NULL").select("book", _z().alias("w"))
    rate = lambda c: F.round(F.avg(F.when(c, 1.0).otherwise(0.0)), 6)
    future, past = F.array_contains("w", "ding"), F.array_contains("w", "ta")
    return w.groupBy("book").agg(rate(F.array_contains(patterns.token_patterns(F.col("w")), "SOV")).alias("sov"), rate(future).alias("future"), rate(~future & past).alias("past"), rate(~future & ~past).alias("present"))


_TOP_SQL = " UNION ALL ".join(f"SELECT id, book, '{t}' AS topic, len(list_filter(list_distinct(w), lambda x: list_contains({rules.sql_array(k)}, x))) / {len(k)} AS ratio FROM v" for t, k in sorted(rules.TOPICS.items()))


@query(
    f"""WITH v AS (SELECT id, book, {A.format('english_text')} AS w FROM bible_verses_enhanced), s AS ({_TOP_SQL}),
b AS (SELECT id, book, topic FROM s WHERE ratio > 0 QUALIFY row_number() OVER (PARTITION BY id ORDER BY ratio DESC, topic) = 1),
c AS (SELECT topic, word, count(*) AS n FROM (SELECT topic, unnest(w) AS word FROM b JOIN v USING (id)) WHERE length(word) > 3 GROUP BY 1, 2),
t AS (SELECT topic, string_agg(word, ' ' ORDER BY n DESC, word) AS words FROM (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY topic ORDER BY n DESC, word) <= 15) GROUP BY 1),
x AS (SELECT topic, string_agg(id::VARCHAR, ' ' ORDER BY id) AS examples FROM (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY topic ORDER BY id) <= 5) GROUP BY 1)
SELECT topic, count(*) AS verses, count(DISTINCT book) AS books, any_value(words) AS words, any_value(examples) AS examples FROM b JOIN t USING (topic) JOIN x USING (topic) GROUP BY 1"""
)
def topic_clusters(spark, d):
    """The verses of each topic: how many, of how many books, their fifteen leading words and five examples. Topics are a parameter."""
    v = _verses(spark, d, "english_text").select("id", "book", T.tokens(F.col("english_text"), "alpha").alias("w"))
    w = F.array_distinct("w")
    scores = F.array(*[F.struct((-F.size(F.array_intersect(w, F.array(*[F.lit(x) for x in k]))) / len(k)).alias("r"), F.lit(t).alias("topic")) for t, k in sorted(rules.TOPICS.items())])
    b = v.withColumn("s", F.array_min(scores)).where("s.r < 0").select("id", "book", "w", F.col("s.topic").alias("topic"))
    words = b.select("topic", F.explode("w").alias("word")).where(F.length("word") > 3).groupBy("topic", "word").agg(F.count(F.lit(1)).alias("n"))
    top = stats.top_per_group(words, ["topic"], 15, [F.desc("n"), F.col("word")]).groupBy("topic").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "word"))), lambda x: x["word"]), " ").alias("words"))
    first = stats.top_per_group(b.select("topic", "id"), ["topic"], 5, [F.col("id")]).groupBy("topic").agg(F.array_join(F.sort_array(F.collect_list("id")).cast("array<string>"), " ").alias("examples"))
    return b.groupBy("topic").agg(F.count(F.lit(1)).alias("verses"), F.countDistinct("book").alias("books")).join(top, "topic").join(first, "topic")


@query(
    _ALIGN
    + """, b AS (SELECT word, book, meaning, count(*) AS n FROM a JOIN bible_verses_enhanced v ON v.id = a.id WHERE position >= 0 GROUP BY 1, 2, 3),
t AS (SELECT word, book, meaning, n FROM b QUALIFY row_number() OVER (PARTITION BY word, book ORDER BY n DESC, meaning) = 1)
SELECT word, count(*) AS books, sum(n)::BIGINT AS n, count(DISTINCT meaning) AS meanings, count(DISTINCT meaning) > 1 AS shifts FROM t GROUP BY 1"""
)
def meaning_shifts(spark, d):
    """Words whose leading translation differs between books."""
    a = _aligned(spark, d).where("position >= 0").join(table(spark, d, "bible_verses_enhanced").select("id", "book"), "id")
    c = a.groupBy("word", "book", "meaning").agg(F.count(F.lit(1)).alias("n"))
    t = c.groupBy("word", "book").agg(F.min(F.struct((-F.col("n")).alias("k"), "meaning")).alias("m"))
    return t.groupBy("word").agg(F.count(F.lit(1)).alias("books"), F.sum(-F.col("m.k")).alias("n"), F.countDistinct("m.meaning").alias("meanings")).withColumn("shifts", F.col("meanings") > 1)


@query(
    """WITH h AS (SELECT string_split(lower(trim(zolai)), '-') AS p FROM dictionary_enhanced WHERE zolai LIKE '%-%'), c AS (SELECT p[2] AS suffix, p[1] AS prefix, count(*) AS n FROM h WHERE len(p) = 2 GROUP BY 1, 2)
SELECT suffix, sum(n)::BIGINT AS n, count(*) AS prefixes, array_to_string((array_agg(prefix ORDER BY n DESC, prefix))[1:20], ' ') AS top FROM c GROUP BY 1 HAVING sum(n) >= 2"""
)
def hyphen_rules(spark, d):
    """Suffixes behind a hyphen with the number of words and prefixes, and the twenty leading prefixes."""
    p = F.split(F.lower(F.trim("zolai")), "-")
    h = table(spark, d, "dictionary_enhanced").where("zolai LIKE '%-%'").select(p.alias("p")).where(F.size("p") == 2)
    c = h.groupBy(F.col("p")[1].alias("suffix"), F.col("p")[0].alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
    top = stats.top_per_group(c, ["suffix"], 20, [F.desc("n"), F.col("prefix")]).groupBy("suffix").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "prefix"))), lambda x: x["prefix"]), " ").alias("top"))
    return c.groupBy("suffix").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("prefixes")).where("n >= 2").join(top, "suffix")


@query(
    rf"""WITH v AS (SELECT {A.format('zolai_text')} AS w FROM bible_verses_enhanced),
p AS (SELECT lower(trim(regexp_replace(zolai, '\s+', ' ', 'g'))) AS phrase, count(*) AS n FROM zolai_vocabulary WHERE contains(trim(regexp_replace(zolai, '\s+', ' ', 'g')), ' ') GROUP BY 1
 UNION ALL SELECT g, count(*) FROM (SELECT w[i] || ' ' || w[i + 1] AS g FROM (SELECT w, unnest(range(1, len(w))) AS i FROM v)) WHERE length(g) > 3 GROUP BY 1
 UNION ALL SELECT g, count(*) FROM (SELECT w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT w, unnest(range(1, len(w) - 1)) AS i FROM v)) WHERE length(g) > 5 GROUP BY 1),
t AS (SELECT lower(trim(regexp_replace(zolai, '\s+', ' ', 'g'))) AS phrase, min(trim(english)) AS translation FROM zolai_vocabulary WHERE trim(coalesce(english, '')) NOT IN ('', '-') GROUP BY 1),
s AS (SELECT phrase, sum(n)::BIGINT AS n FROM p GROUP BY 1 ORDER BY n DESC, phrase LIMIT 5000)
SELECT phrase, n, translation FROM s LEFT JOIN t USING (phrase)"""
)
def phrase_counts(spark, d):
    """Multiword headwords, bigrams and trigrams; the 5,000 leading ones (the report is a top-k) with their translation."""
    v = _verses(spark, d).select(_z().alias("w"))
    key = F.lower(T.squeeze(F.col("zolai")))
    voc = table(spark, d, "zolai_vocabulary").select(key.alias("gram"), "english")
    heads = voc.where(F.contains("gram", F.lit(" "))).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    grams = [stats.ngram_counts(v, F.col("w"), k).where(F.length("gram") > least) for k, least in ((2, 3), (3, 5))]
    all_ = heads.unionAll(grams[0]).unionAll(grams[1]).groupBy("gram").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "gram").limit(5000)
    t = voc.where(~T.blank(F.col("english"))).groupBy("gram").agg(F.min(F.trim("english")).alias("translation"))
    return all_.join(t, "gram", "left").select(F.col("gram").alias("phrase"), "n", "translation")


MARKERS, DENY = ["hi", "uh", "ding", "leh"], ["lorem ipsum", "placeholder", "hammer"]


@query(
    rf"""WITH t AS (SELECT doc_id, coalesce(text, '') AS t, lower(coalesce(text, '')) AS l, {A.format('text')} AS w FROM documents)
SELECT doc_id, NOT regexp_matches(l, '(^|[^\p{{L}}])({'|'.join(rules.ENGLISH_WORDS + rules.GERMAN_WORDS)})($|[^\p{{L}}])') AND ({' OR '.join(f"contains(l, '{m}')" for m in MARKERS)}) AS own_marker,
 {' OR '.join(f"contains(l, '{x}')" for x in DENY)} AS denied, length(trim(t)) < 3 OR regexp_matches(ltrim(l), '^(###|\[inst\]|<s>|<!doctype)') AS noise,
 NOT regexp_matches(t, '^\s*(#|https?://|[0-9]+\s*$)') AND (regexp_matches(t, '[က-႟]') OR len(list_filter(w, lambda x: x IN {_l(rules.STOPWORDS)})) >= 2) AS own_line FROM t"""
)
def line_filters(spark, d):
    """D7, D14, D15, D27."""
    t = texts(spark, d, "documents", "doc_id", "text")
    return t.select("doc_id", *filters.line_flags(F.col("text"), MARKERS, DENY))


@query(
    rf"""SELECT id, lower(trim(zolai)) IN {_l(rules.ENGLISH_WORDS)} OR (length(trim(zolai)) > 4 AND regexp_matches(lower(trim(zolai)), '({'|'.join(rules.ENGLISH_SUFFIXES)})$')) OR regexp_matches(lower(trim(zolai)), '(str|spl|scr|thr|shr|ght|tch|ck|qu|x)') AS english FROM zolai_vocabulary WHERE zolai IS NOT NULL"""
)
def english_headwords(spark, d):
    """Headwords that are English by word, suffix or consonant cluster."""
    return table(spark, d, "zolai_vocabulary").where("zolai IS NOT NULL").select("id", filters.english_headword(F.lower(F.trim("zolai"))).alias("english"))


@query(
    """SELECT id, CASE WHEN book = 'PRO' THEN 'wisdom' WHEN book = 'ECC' THEN 'reflection' WHEN book = 'PSA' THEN 'praise' WHEN regexp_matches(lower(zolai_text), '(^| )(bang|sangin)( |$)') THEN 'comparison' WHEN regexp_matches(lower(zolai_text), '(^| )(lo|kei)( |$)') THEN 'warning' ELSE 'statement' END AS kind
FROM bible_verses_enhanced WHERE zolai_text IS NOT NULL"""
)
def proverb_types(spark, d):
    """By book, then by pattern."""
    t = F.lower("zolai_text")
    kind = F.when(F.col("book") == "PRO", "wisdom").when(F.col("book") == "ECC", "reflection").when(F.col("book") == "PSA", "praise")
    kind = kind.when(t.rlike("(^| )(bang|sangin)( |$)"), "comparison").when(t.rlike("(^| )(lo|kei)( |$)"), "warning").otherwise("statement")
    return _verses(spark, d).where("zolai_text IS NOT NULL").select("id", kind.alias("kind"))


@query(
    f"""WITH c AS (SELECT word, count(*) AS n FROM ({VERSE_W}) GROUP BY 1), k AS (SELECT *, word IN (SELECT lower(trim(zolai)) FROM zolai_vocabulary WHERE zolai IS NOT NULL) AS known FROM c)
SELECT count(*) AS words, count(*) FILTER (known) AS known, round(100.0 * count(*) FILTER (known) / count(*), 4) AS pct, round(100.0 * sum(n) FILTER (known) / sum(n), 4) AS token_pct,
 (SELECT string_agg(word, ' ' ORDER BY n DESC, word) FROM (SELECT word, n FROM k WHERE NOT known ORDER BY n DESC, word LIMIT 100)) AS gaps FROM k"""
)
def rebuild_audit(spark, d):
    """How much of the text the vocabulary covers, and the hundred leading gaps."""
    c = _verses(spark, d).select(F.explode(_z()).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    known = table(spark, d, "zolai_vocabulary").where("zolai IS NOT NULL").select(F.lower(F.trim("zolai")).alias("word")).distinct().withColumn("known", F.lit(True))
    j = c.join(known, "word", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    gaps = j.where("NOT known").orderBy(F.desc("n"), "word").limit(100).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("o"), "word"))), lambda x: x["word"]), " ").alias("gaps"))
    hit = F.count_if(F.col("known"))
    one = j.agg(F.count(F.lit(1)).alias("words"), hit.alias("known"), F.round(100.0 * hit / F.count(F.lit(1)), 4).alias("pct"), F.round(100.0 * F.sum(F.when(F.col("known"), F.col("n"))) / F.sum("n"), 4).alias("token_pct"))
    return one.withColumn("k", F.lit(1)).join(gaps.withColumn("k", F.lit(1)), "k").drop("k")  # one row each


@query("SELECT zolai_text IS NOT NULL AS own, english_text IS NOT NULL AS english, myanmar_text IS NOT NULL AS burmese, source_version, count(*) AS n FROM bible_verses_enhanced GROUP BY ALL")
def version_coverage(spark, d):
    """Which texts the verses of each version have."""
    v = table(spark, d, "bible_verses_enhanced")
    return v.groupBy(F.col("zolai_text").isNotNull().alias("own"), F.col("english_text").isNotNull().alias("english"), F.col("myanmar_text").isNotNull().alias("burmese"), "source_version").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT id, pattern FROM (" + " UNION ALL ".join(f"SELECT id, '{n}' AS pattern FROM bible_verses_enhanced WHERE regexp_matches(lower(zolai_text), '{rx}')" for n, rx in sorted(patterns.GRAMMAR.items())) + ")")
def pattern_search(spark, d):
    """The verses of each named pattern."""
    v = _verses(spark, d)
    return v.select("id", F.explode(patterns.named_patterns(F.lower("zolai_text"))).alias("pattern"))


@query("SELECT id, CASE WHEN id <= (SELECT floor(0.8 * max(id)) FROM zolai_songs) THEN 'train' WHEN id <= (SELECT floor(0.9 * max(id)) FROM zolai_songs) THEN 'val' ELSE 'test' END AS split FROM zolai_songs")
def ordered_split(spark, d):
    """Shares in stored order, not shuffled; ids stand for the order."""
    s = table(spark, d, "zolai_songs").select("id")
    return training.ordered_split(s, "id", [("train", 0.8), ("val", 0.1), ("test", 0.1)])


@query(
    r"""WITH g AS (SELECT lower(trim(zolai)) AS word, unnest(string_split_regex(english, '\s*[;,/]\s*|\s+(?:and|or)\s+')) AS sense FROM dictionary_enhanced WHERE zolai IS NOT NULL AND trim(coalesce(english, '')) NOT IN ('', '-'))
SELECT word, count(DISTINCT trim(sense)) AS n_senses, string_agg(DISTINCT trim(sense), ' | ' ORDER BY trim(sense)) AS senses FROM g WHERE trim(sense) <> '' GROUP BY 1 HAVING count(DISTINCT trim(sense)) > 1"""
)
def split_senses(spark, d):
    """The senses that separators part within and across the glosses of a word."""
    g = table(spark, d, "dictionary_enhanced").where(F.col("zolai").isNotNull() & ~T.blank(F.col("english"))).select(F.lower(F.trim("zolai")).alias("word"), F.explode(F.split("english", r"\s*[;,/]\s*|\s+(?:and|or)\s+")).alias("sense"))
    g = g.select("word", F.trim("sense").alias("sense")).where("sense <> ''").distinct()
    return g.groupBy("word").agg(F.count(F.lit(1)).alias("n_senses"), F.array_join(F.array_sort(F.collect_set("sense")), " | ").alias("senses")).where("n_senses > 1")


@query(
    """WITH s AS (SELECT count(*) AS n, sum(word_count)::BIGINT AS words, round(avg(word_count), 6) AS mean_words, min(scraped_at) AS first_at, max(scraped_at) AS last_at FROM articles),
t AS (SELECT string_agg(tag || ':' || n, ' ' ORDER BY n DESC, tag) AS tags FROM (SELECT tag, count(*) AS n FROM (SELECT unnest(tags) AS tag FROM articles) GROUP BY 1 ORDER BY n DESC, tag LIMIT 30)) SELECT * FROM s, t"""
)
def crawl_index(spark, d):
    """The final index of a crawl without its contents: totals, date range, thirty leading tags."""
    a = table(spark, d, "articles")
    s = a.agg(F.count(F.lit(1)).alias("n"), F.sum("word_count").alias("words"), F.round(F.avg("word_count"), 6).alias("mean_words"), F.min("scraped_at").alias("first_at"), F.max("scraped_at").alias("last_at"))
    top = a.select(F.explode("tags").alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "tag").limit(30)
    tags = top.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("o"), "tag"))), lambda x: F.concat_ws(":", x["tag"], -x["o"])), " ").alias("tags"))
    return s.withColumn("k", F.lit(1)).join(tags.withColumn("k", F.lit(1)), "k").drop("k")  # one row each


@query(
    f"""WITH t AS (SELECT 'zolai_vocabulary' AS table_name, count(*) AS total, count(*) FILTER (trim(coalesce(english, '')) NOT IN ('', '-')) AS done FROM zolai_vocabulary UNION ALL SELECT 'dictionary_enhanced', count(*), count(*) FILTER (trim(coalesce(myanmar, '')) NOT IN ('', '-')) FROM dictionary_enhanced
 UNION ALL SELECT 'bible_verses_enhanced', count(*), count(*) FILTER (trim(coalesce(grammar_analysis, '')) NOT IN ('', '-')) FROM bible_verses_enhanced) SELECT table_name, done, total - done AS missing, round(100.0 * done / total, 2) AS pct FROM t"""
)
def progress(spark, d):
    """O3: done and missing of each table's target column."""
    wanted = {"zolai_vocabulary": "english", "dictionary_enhanced": "myanmar", "bible_verses_enhanced": "grammar_analysis"}
    parts = [stats.coverage(table(spark, d, n), [c]).select(F.lit(n).alias("table_name"), F.col("filled").alias("done"), (F.col("n") - F.col("filled")).alias("missing"), "pct") for n, c in sorted(wanted.items())]
    return lexicon.union_all(parts)
