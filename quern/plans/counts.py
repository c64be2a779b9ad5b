"""Queries over counts, profiles, windows and sets (inventories G, H, I)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quern.functions import rules
from quern.functions import text as T
from quern.operators import stats
from quern.plans.registry import query
from quern.plans.texts import CONTENT_OUT
from quern.session import table, texts

A = "regexp_extract_all(lower(coalesce({0}, '')), '[a-z]+')"
VERSE_W = f"SELECT id, book, chapter, unnest({A.format('zolai_text')}) AS word FROM bible_verses_enhanced"
DOC_W = f"SELECT doc_id, lang, source, unnest({A.format('text')}) AS word FROM documents"


def _verses(spark, d):
    return texts(spark, d, "bible_verses_enhanced", "id", "book", "chapter", "verse", "zolai_text", "english_text")



def _z():
    return T.tokens(F.col("zolai_text"), "alpha")


@query(f"SELECT word, count(*) AS n, count(DISTINCT doc_id) AS n_docs, word IN {rules.sql_list(rules.STOPWORDS)} AS is_stop FROM ({DOC_W}) GROUP BY 1")
def doc_word_freq(spark, d):
    """G1."""
    c = stats.doc_counts(texts(spark, d, "documents", "doc_id", "text"), "doc_id", T.tokens(F.col("text"), "alpha"))
    return c.select("word", "n", "n_docs", F.col("word").isin(rules.STOPWORDS).alias("is_stop"))


@query(f"SELECT book, word, count(*) AS n FROM ({VERSE_W}) GROUP BY GROUPING SETS ((book, word), (word))")
def word_freq_levels(spark, d):
    """Per book and overall, in one pass."""
    w = _verses(spark, d).select("book", F.explode(_z()).alias("word"))
    return w.groupingSets([("book", "word"), ("word",)], "book", "word").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH v AS (SELECT book, {A.format('zolai_text')} AS w FROM bible_verses_enhanced)
SELECT book, count(*) AS n_rows, sum(len(w))::BIGINT AS n_tokens, round(avg(len(w)), 6) AS mean_tokens, len(list_distinct(flatten(array_agg(w))))::BIGINT AS n_words FROM v GROUP BY 1"""
)
def book_profile(spark, d):
    """G3."""
    return stats.profile(_verses(spark, d), "book", _z())


@query(
    f"""WITH c AS (SELECT book, chapter, word, count(*) AS n FROM ({VERSE_W}) WHERE length(word) > 1 AND word NOT IN {rules.sql_list(sorted(set(rules.PARTICLES + rules.STOPWORDS)))} GROUP BY 1, 2, 3)
SELECT book, chapter, word, n, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY book, chapter ORDER BY n DESC, word) AS rank FROM c) WHERE rank <= 5"""
)
def chapter_themes(spark, d):
    """The five leading content words of each chapter."""
    w = _verses(spark, d).select("book", "chapter", F.explode(T.content_words(_z())).alias("word"))
    return stats.top_per_group(stats.word_counts(w, "word", ["book", "chapter"]), ["book", "chapter"], 5, [F.desc("n"), F.col("word")])


@query(
    f"""WITH c AS (SELECT lang, word, count(DISTINCT doc_id) AS n_docs FROM ({DOC_W}) WHERE lang IS NOT NULL GROUP BY 1, 2), t AS (SELECT word, sum(n_docs) AS a FROM c GROUP BY 1)
SELECT lang, word, n_docs FROM c JOIN t USING (word) WHERE n_docs >= 5 AND a - n_docs <= 1"""
)
def lang_specific_words(spark, d):
    """G5."""
    return stats.specific_words(texts(spark, d, "documents", "doc_id", "lang", "text").where("lang IS NOT NULL"), "lang", "doc_id", T.tokens(F.col("text"), "alpha"))


@query(
    f"""WITH g AS (SELECT w[i] || ' ' || w[i + 1] AS gram FROM (SELECT w, unnest(range(1, len(w))) AS i FROM (SELECT {A.format('text')} AS w FROM documents)))
SELECT gram, count(*) AS n FROM g GROUP BY 1 HAVING count(*) >= 3"""
)
def doc_bigrams(spark, d):
    """G6, D25."""
    return stats.ngram_counts(texts(spark, d, "documents", "doc_id", "text"), T.tokens(F.col("text"), "alpha"), 2).where("n >= 3")


@query(
    f"""WITH g AS (SELECT book, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram FROM (SELECT book, w, unnest(range(1, len(w) - 1)) AS i FROM (SELECT book, {A.format('zolai_text')} AS w FROM bible_verses_enhanced))),
c AS (SELECT book, gram, count(*) AS n FROM g GROUP BY 1, 2)
SELECT book, gram, n, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY book ORDER BY n DESC, gram) AS rank FROM c) WHERE rank <= 10"""
)
def book_trigrams(spark, d):
    """G6, H3, G35."""
    return stats.top_per_group(stats.ngram_counts(_verses(spark, d), _z(), 3, ["book"]), ["book"], 10, [F.desc("n"), F.col("gram")])


@query(
    f"""WITH v AS (SELECT {A.format('zolai_text')} AS w FROM bible_verses_enhanced), u AS (SELECT word, count(*) AS f FROM (SELECT unnest(w) AS word FROM v) GROUP BY 1),
b AS (SELECT w[i] AS first, w[i + 1] AS second, count(*) AS n FROM (SELECT w, unnest(range(1, len(w))) AS i FROM v) GROUP BY 1, 2 HAVING count(*) >= 3)
SELECT first, second, n, round(n / (x.f * y.f), 9) AS ratio FROM b JOIN u x ON x.word = first JOIN u y ON y.word = second"""
)
def bigram_association(spark, d):
    """G7."""
    return stats.association(_verses(spark, d), _z()).withColumn("ratio", F.round("ratio", 9))


@query(
    rf"""WITH v AS (SELECT book, list_sort(list_distinct(list_filter(regexp_extract_all(lower(coalesce(zolai_text, '')), '[a-zà-ɏ'']+|[,;:!.?-]+'), lambda t: t NOT IN {CONTENT_OUT} AND length(t) > 1 AND NOT regexp_matches(t, '^[,;:!.?]')))) AS w FROM bible_verses_enhanced),
p AS (SELECT book, w[i] AS a, unnest(w[i + 1:]) AS b FROM (SELECT book, w, unnest(range(1, len(w))) AS i FROM v))
SELECT book, a, b, count(*) AS n FROM p GROUP BY 1, 2, 3 HAVING count(*) >= 2"""
)
def verse_cooccurrence(spark, d):
    """All pairs of a verse's content words that occur at least twice, by book."""
    return stats.cooccurrence(_verses(spark, d), "book", T.content_words(T.tokens(F.col("zolai_text"), "ext"))).where("n >= 2")


@query(
    rf"""WITH v AS (SELECT book, list_sort(list_distinct(list_filter(regexp_extract_all(lower(coalesce(zolai_text, '')), '[a-zà-ɏ'']+|[,;:!.?-]+'), lambda t: t NOT IN {CONTENT_OUT} AND length(t) > 1 AND NOT regexp_matches(t, '^[,;:!.?]')))) AS w FROM bible_verses_enhanced),
p AS (SELECT book, w[i] AS a, unnest(w[i + 1:]) AS b FROM (SELECT book, w, unnest(range(1, len(w))) AS i FROM v))
SELECT book, a, b, count(*) AS n FROM p GROUP BY 1, 2, 3"""
)
def content_cooccurrence(spark, d):
    """All pairs of a verse's content words, by book."""
    return stats.cooccurrence(_verses(spark, d), "book", T.content_words(T.tokens(F.col("zolai_text"), "ext")))


@query(
    f"""WITH v AS (SELECT {A.format('zolai_text')} AS w FROM bible_verses_enhanced), i AS (SELECT w, unnest(range(1, len(w) + 1)) AS i FROM v),
p AS (SELECT w[i] AS word, w[j] AS near FROM (SELECT w, i, unnest(range(greatest(1, i - 2), least(len(w), i + 2) + 1)) AS j FROM i) WHERE i <> j),
c AS (SELECT word, near, count(*) AS n FROM p GROUP BY 1, 2)
SELECT word, near, n, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY n DESC, near) AS rank FROM c WHERE n >= 2) WHERE rank <= 5"""
)
def collocates(spark, d):
    """The five leading neighbours within two words."""
    return stats.top_per_group(stats.collocations(_verses(spark, d), _z()).where("n >= 2"), ["word"], 5, [F.desc("n"), F.col("near")])


@query(
    f"""WITH v AS (SELECT {A.format('zolai_text')} AS a, {A.format('english_text')} AS b FROM bible_verses_enhanced),
x AS (SELECT a, b, unnest(range(1, len(a) + 1)) AS i FROM v), y AS (SELECT a, b, i, unnest(range(1, len(b) + 1)) AS j FROM x),
w AS (SELECT a[i] AS own, b[j] AS other, greatest(1, floor(3 * (1 - abs((i - 1) / len(a) - (j - 1) / len(b))) + 1e-9)::INT) AS g FROM y),
c AS (SELECT own, other, sum(g)::BIGINT AS weight, count(*) AS n FROM w GROUP BY 1, 2 HAVING count(*) >= 3)
SELECT own, other, weight, n, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY own ORDER BY weight DESC, other) AS rank FROM c) WHERE rank <= 3"""
)
def translation_weights(spark, d):
    """The three heaviest translations of each word."""
    w = stats.weighted_cooccurrence(_verses(spark, d), _z(), T.tokens(F.col("english_text"), "alpha")).where("n >= 3")
    return stats.top_per_group(w, ["own"], 3, [F.desc("weight"), F.col("other")])


@query(
    f"""WITH v AS (SELECT book, ' ' || array_to_string({A.format('zolai_text')}, ' ') || ' ' AS t, len({A.format('zolai_text')}) AS n FROM bible_verses_enhanced WHERE zolai_text IS NOT NULL)
SELECT book, count(*) AS verses, round(avg(CASE WHEN t LIKE '% kei %' OR t LIKE '% lo %' THEN 1.0 ELSE 0 END), 6) AS negation, round(avg(CASE WHEN t LIKE '% hiam %' THEN 1.0 ELSE 0 END), 6) AS question,
 round(avg(CASE WHEN t LIKE '% ding %' THEN 1.0 ELSE 0 END), 6) AS future, round(avg(n), 6) AS mean_words FROM v GROUP BY 1"""
)
def book_patterns(spark, d):
    """Rates of sentence patterns per book."""
    w = _verses(spark, d).where("zolai_text IS NOT NULL").select("book", _z().alias("w"))
    rate = lambda *ms: F.round(F.avg(F.when(F.arrays_overlap("w", F.array(*[F.lit(m) for m in ms])), 1.0).otherwise(0.0)), 6)
    return w.groupBy("book").agg(F.count(F.lit(1)).alias("verses"), rate("kei", "lo").alias("negation"), rate("hiam").alias("question"), rate("ding").alias("future"), F.round(F.avg(F.size("w")), 6).alias("mean_words"))


_TOPIC_SQL = " UNION ALL ".join(f"SELECT doc_id, '{t}' AS topic, len(list_filter(list_distinct(w), lambda x: list_contains({rules.sql_array(k)}, x))) / {len(k)} AS ratio FROM d" for t, k in sorted(rules.TOPICS.items()))


@query(f"WITH d AS (SELECT doc_id, {A.format('text')} AS w FROM documents), s AS ({_TOPIC_SQL}) SELECT doc_id, (array_agg(topic ORDER BY ratio DESC, topic))[1] AS topic, round(max(ratio), 6) AS ratio FROM s WHERE ratio > 0 GROUP BY 1")
def topic_scores(spark, d):
    """The topic with the highest share of its keywords."""
    w = F.array_distinct(T.tokens(F.col("text"), "alpha"))
    scores = F.array(*[F.struct((F.size(F.array_intersect(w, F.array(*[F.lit(x) for x in k]))) / len(k)).alias("ratio"), F.lit(t).alias("topic")) for t, k in sorted(rules.TOPICS.items())])
    s = texts(spark, d, "documents", "doc_id", "text").select("doc_id", F.explode(scores).alias("s")).where("s.ratio > 0")
    m = s.groupBy("doc_id").agg(F.min(F.struct(-F.col("s.ratio"), F.col("s.topic").alias("topic"))).alias("m"))
    return m.select("doc_id", F.col("m.topic").alias("topic"), F.round(-F.col("m.col1"), 6).alias("ratio"))


@query(
    f"""WITH c AS (SELECT book, word, count(*) AS n FROM ({VERSE_W}) GROUP BY 1, 2), t AS (SELECT word, sum(n) AS n, count(*) AS books FROM c GROUP BY 1)
SELECT word, t.n::BIGINT AS n, books, (array_agg(book ORDER BY c.n DESC, book))[1:3] AS top_books FROM c JOIN t USING (word) WHERE t.n >= 10 GROUP BY 1, 2, 3"""
)
def word_profiles(spark, d):
    """Totals, spread and leading books of each word."""
    w = _verses(spark, d).select("book", F.explode(_z()).alias("word"))
    c = stats.word_counts(w, "word", ["book"])
    t = c.groupBy("word").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("books")).where("total >= 10")
    top = stats.top_per_group(c.join(t, "word"), ["word"], 3, [F.desc("n"), F.col("book")])
    return top.groupBy("word", "total", "books").agg(F.sort_array(F.collect_list(F.struct("rank", "book"))).alias("b")).select("word", F.col("total").alias("n"), "books", F.transform("b", lambda x: x["book"]).alias("top_books"))


COVER = ["english", "myanmar", "pos", "tone_category", "compound_parts", "root_word", "bible_books"]


@query(
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n, count(*) FILTER (trim(coalesce({c}, '')) NOT IN ('', '-')) AS filled, round(100.0 * count(*) FILTER (trim(coalesce({c}, '')) NOT IN ('', '-')) / count(*), 2) AS pct FROM zolai_vocabulary"
        for c in COVER
    )
    + ")"
)
def coverage_report(spark, d):
    """G21, J29, O3."""
    return stats.coverage(table(spark, d, "zolai_vocabulary"), COVER)


TABLES = ["articles", "bible_verses_enhanced", "dictionary_enhanced", "documents", "entries", "wiki_content", "zolai_songs", "zolai_vocabulary"]


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in TABLES))
def table_counts(spark, d):
    """G22."""
    return stats.row_counts({t: table(spark, d, t) for t in TABLES})


@query("SELECT book, chapter, verse, source_version, count(*) AS n FROM bible_verses_enhanced GROUP BY ALL HAVING count(*) > 1")
def duplicate_verses(spark, d):
    """G23, J29."""
    return table(spark, d, "bible_verses_enhanced").groupBy("book", "chapter", "verse", "source_version").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("SELECT zvs_compliance_status AS status, entry_version, count(*) AS n FROM entries GROUP BY 1, 2")
def status_distribution(spark, d):
    """G24."""
    return table(spark, d, "entries").groupBy(F.col("zvs_compliance_status").alias("status"), "entry_version").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT source_category, count(*) AS n, count(DISTINCT lower(zolai)) AS words, round(avg(confidence), 6) AS confidence, min(length(zolai)) AS shortest, max(length(zolai)) AS longest FROM zolai_vocabulary GROUP BY 1")
def category_stats(spark, d):
    """G25, G26."""
    v = table(spark, d, "zolai_vocabulary")
    return v.groupBy("source_category").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct(F.lower("zolai")).alias("words"), F.round(F.avg("confidence"), 6).alias("confidence"),
        F.min(F.length("zolai")).alias("shortest"), F.max(F.length("zolai")).alias("longest"),
    )


@query("SELECT (CASE WHEN confidence >= 0.8 THEN 0.8 WHEN confidence >= 0.6 THEN 0.6 WHEN confidence >= 0.4 THEN 0.4 WHEN confidence >= 0.2 THEN 0.2 WHEN confidence >= 0 THEN 0.0 END)::DOUBLE AS bin, count(*) AS n FROM dictionary_enhanced WHERE confidence IS NOT NULL GROUP BY 1")
def confidence_histogram(spark, d):
    """G27, G28, C51."""
    return stats.histogram(table(spark, d, "dictionary_enhanced"), "confidence", [0.0, 0.2, 0.4, 0.6, 0.8])


@query(
    """WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1, 2)
SELECT user_id, (array_agg(event_type ORDER BY n DESC, event_type))[1] AS winner, round(max(n) / sum(n), 6) AS agreement, sum(n)::BIGINT AS votes FROM c GROUP BY 1"""
)
def majority_vote(spark, d):
    """G29, P4."""
    return stats.majority(table(spark, d, "events"), "user_id", "event_type")


@query(
    f"""WITH m AS (SELECT DISTINCT unnest({A.format('content')}) AS w FROM articles), b AS (SELECT DISTINCT word AS w FROM ({VERSE_W}))
SELECT count(*) AS article_words, count(*) FILTER (w IN (SELECT w FROM b)) AS in_verses, count(*) FILTER (w NOT IN (SELECT w FROM b)) AS only_articles FROM m"""
)
def modern_words(spark, d):
    """G30, J24."""
    m = table(spark, d, "articles").select(F.explode(T.tokens(F.col("content"), "alpha")).alias("w")).distinct()
    b = _verses(spark, d).select(F.explode(_z()).alias("w")).distinct().withColumn("hit", F.lit(1))
    return m.join(b, "w", "left").agg(F.count(F.lit(1)).alias("article_words"), F.count("hit").alias("in_verses"), F.count_if(F.col("hit").isNull()).alias("only_articles"))


@query("SELECT len(regexp_extract_all(lower(zolai), '[aeiou]+')) AS syllables, array_to_string(list_sort(array_agg(DISTINCT zolai))[1:5], ', ') AS sample FROM zolai_vocabulary GROUP BY 1")
def syllable_samples(spark, d):
    """G32, H1."""
    v = table(spark, d, "zolai_vocabulary").select(T.syllable_count(F.col("zolai")).alias("syllables"), "zolai")
    return stats.samples_by(v, "syllables", "zolai", 5)


@query("SELECT lang, source, count(*) AS n, sum(length(text))::BIGINT AS chars FROM documents GROUP BY ROLLUP (lang, source)")
def lang_source_rollup(spark, d):
    """G34."""
    return table(spark, d, "documents").rollup("lang", "source").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def orders_cube(spark, d):
    return table(spark, d, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT tag, count(*) AS n FROM (SELECT unnest(tags) AS tag FROM articles) GROUP BY 1 ORDER BY n DESC, tag LIMIT 30")
def top_tags(spark, d):
    """A top-k report."""
    return table(spark, d, "articles").select(F.explode("tags").alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "tag").limit(30)


@query(f"SELECT id, i AS pos, w[i] AS word, CASE WHEN i > 1 THEN w[i - 1] END AS prev, CASE WHEN i < len(w) THEN w[i + 1] END AS next FROM (SELECT id, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT id, {A.format('title')} AS w FROM zolai_songs))")
def neighbour_words(spark, d):
    """H7: previous and next word within a title, without a shuffle."""
    w = table(spark, d, "zolai_songs").select("id", T.tokens(F.col("title"), "alpha").alias("w"))
    e = w.select("id", "w", F.posexplode("w").alias("i", "word"))
    return e.select("id", (F.col("i") + 1).cast("bigint").alias("pos"), "word", F.when(F.col("i") > 0, F.get("w", F.col("i") - 1)).alias("prev"), F.get("w", F.col("i") + 1).alias("next"))


@query(
    """WITH w AS (SELECT *, max(CASE WHEN event_type = 'signup' THEN event_id END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS last_signup FROM events)
SELECT event_id, user_id, last_signup FROM (SELECT event_id, user_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_signup FROM events)"""
)
def fill_forward(spark, d):
    """H9: the last marker seen, carried forward within each user."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    e = table(spark, d, "events")
    return e.select("event_id", "user_id", F.last(F.when(F.col("event_type") == "signup", F.col("event_id")), ignorenulls=True).over(w).alias("last_signup"))


@query(
    """WITH c AS (SELECT user_id, count(*) FILTER (value >= 50) AS n_correct, max(ts) AS last_ts FROM events GROUP BY 1)
SELECT user_id, n_correct, [1, 3, 7, 14, 30][least(n_correct, 4) + 1] AS interval_days, last_ts + to_days([1, 3, 7, 14, 30][least(n_correct, 4) + 1]::INT) AS due FROM c"""
)
def review_schedule(spark, d):
    """The next due time from the count of correct reviews."""
    c = table(spark, d, "events").groupBy("user_id").agg(F.count_if(F.col("value") >= 50).alias("n_correct"), F.max("ts").alias("last_ts"))
    days = T.at(F.array(*[F.lit(x) for x in (1, 3, 7, 14, 30)]), F.least("n_correct", F.lit(4)).cast("int") + 1)
    return c.select("user_id", "n_correct", days.alias("interval_days"), (F.col("last_ts") + F.make_dt_interval(days)).alias("due"))


@query("WITH r AS (SELECT zolai, frequency_bible, row_number() OVER (ORDER BY frequency_bible DESC NULLS LAST, id) AS r FROM zolai_vocabulary) SELECT zolai, r AS rank, CASE WHEN r <= 100 THEN 1 WHEN r <= 200 THEN 2 WHEN r <= 500 THEN 3 ELSE 4 END AS level FROM r WHERE r <= 1000")
def lesson_levels(spark, d):
    """Nested top-N levels of a top-1000 report (its limit comes before the window)."""
    v = table(spark, d, "zolai_vocabulary").select("id", "zolai", "frequency_bible").orderBy(F.col("frequency_bible").desc_nulls_last(), "id").limit(1000)
    r = v.withColumn("rank", F.row_number().over(Window.partitionBy().orderBy(F.col("frequency_bible").desc_nulls_last(), "id")))
    level = F.when(F.col("rank") <= 100, 1).when(F.col("rank") <= 200, 2).when(F.col("rank") <= 500, 3).otherwise(4)
    return r.select("zolai", F.col("rank").cast("bigint").alias("rank"), level.alias("level"))


@query(
    """SELECT 'union' AS op, count(*) AS n FROM (SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'intersect', count(*) FROM (SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'except', count(*) FROM (SELECT n_nationkey FROM nation EXCEPT SELECT s_nationkey FROM supplier)"""
)
def set_operations(spark, d):
    """I1-I4."""
    c, s = table(spark, d, "customer").select(F.col("c_nationkey").alias("k")), table(spark, d, "supplier").select(F.col("s_nationkey").alias("k"))
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"))
    count = lambda op, t: t.agg(F.lit(op).alias("op"), F.count(F.lit(1)).alias("n"))
    return count("union", c.union(s).distinct()).unionAll(count("intersect", c.intersect(s))).unionAll(count("except", n.exceptAll(s).distinct().join(s, "k", "left_anti")))


@query(
    """SELECT n_name, count(DISTINCT c_custkey) AS customers, count(o_orderkey) AS orders, round(coalesce(sum(o_totalprice), 0), 2) AS total
FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1"""
)
def nation_rollup(spark, d):
    """F, G: outer joins and an aggregate over the star schema; orders are pre-aggregated by customer before the join."""
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("orders"), F.sum("o_totalprice").alias("t"))
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey")).join(o, "c_custkey", "left")
    c = c.groupBy("n_nationkey").agg(F.count(F.lit(1)).alias("customers"), F.sum("orders").alias("orders"), F.sum("t").alias("t"))
    z = F.lit(0).cast("bigint")
    return table(spark, d, "nation").join(c, "n_nationkey", "left").select("n_name", F.coalesce("customers", z).alias("customers"), F.coalesce("orders", z).alias("orders"), F.round(F.coalesce("t", F.lit(0.0)), 2).alias("total"))


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def customers_anti(spark, d):
    return table(spark, d, "customer").join(table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey", "c_mktsegment")


@query(
    """WITH s AS (SELECT l_partkey, l_suppkey, sum(l_extendedprice::DECIMAL(12,2) * (1 - l_discount::DECIMAL(4,2)))::DOUBLE AS revenue FROM lineitem WHERE l_shipdate >= DATE '1995-01-01' GROUP BY 1, 2)
SELECT l_partkey, l_suppkey, revenue FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY revenue DESC, l_suppkey) AS rn FROM s) WHERE rn = 1"""
)
def top_supplier(spark, d):
    l = table(spark, d, "lineitem").where("l_shipdate >= DATE'1995-01-01'")
    s = l.groupBy("l_partkey", "l_suppkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))).cast("double").alias("revenue"))
    m = s.groupBy("l_partkey").agg(F.min(F.struct(-F.col("revenue"), F.col("l_suppkey").alias("l_suppkey"))).alias("m"))
    return m.select("l_partkey", F.col("m.l_suppkey").alias("l_suppkey"), (-F.col("m.col1")).alias("revenue"))


@query("SELECT event_type, count(*) AS n, round(avg(json_extract_string(props, '$.k')::DOUBLE), 6) AS mean_k, round(quantile_cont(value, 0.5), 6) AS median FROM events GROUP BY 1")
def event_stats(spark, d):
    """P5: values read out of JSON text, exact median."""
    e = table(spark, d, "events")
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.get_json_object("props", "$.k").cast("double")), 6).alias("mean_k"), F.round(F.expr("percentile(value, 0.5)"), 6).alias("median"))


@query(
    """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 6 HOURS THEN 0 ELSE 1 END AS fresh, event_id FROM events),
s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM g)
SELECT user_id, session::BIGINT AS session, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM s GROUP BY 1, 2"""
)
def event_sessions(spark, d):
    """Extension of H10: sessions by gap."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, d, "events").select("user_id", "event_id", "ts")
    fresh = F.when(F.col("ts") - F.lag("ts").over(w) <= F.expr("INTERVAL 6 HOURS"), 0).otherwise(1)
    s = e.withColumn("fresh", fresh).withColumn("session", F.sum("fresh").over(w))
    return s.groupBy("user_id", "session").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
