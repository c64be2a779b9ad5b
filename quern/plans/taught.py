"""Queries over training examples, splits, search (inventories L, N)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators import filters, joins, quality, search, training
from quern.plans.registry import query
from quern.plans.scored import _FEATURES, _SCORE
from quern.plans.texts import _REASON
from quern.session import cut_lineage, table, texts

OK = "trim(coalesce(zolai_text, '')) NOT IN ('', '-') AND trim(coalesce(english_text, '')) NOT IN ('', '-')"
W = "list_filter(string_split_regex(coalesce({0}, ''), '\\s+'), lambda w: w <> '')"


def _h(x: str) -> str:
    return f"('0x' || left(md5('42' || {x}), 8))::UBIGINT::BIGINT"


@query(
    f"""SELECT id, '<|im_start|>system\n{training.SYSTEM}<|im_end|>\n<|im_start|>user\n' || english_text || '<|im_end|>\n<|im_start|>assistant\n' || zolai_text || '<|im_end|>' AS chat,
 ['user: ' || english_text, 'assistant: ' || zolai_text] AS messages, 'Source: ' || zolai_text || '\nEnglish: ' || english_text AS rendered,
 ['Translate.', 'Put into English.', 'What does it say?'][{_h('id')} % 3 + 1] AS prompt FROM bible_verses_enhanced WHERE {OK}"""
)
def chat_examples(spark, d):
    """L1-L4, B2."""
    v = table(spark, d, "bible_verses_enhanced").where(OK)
    z, e = F.col("zolai_text"), F.col("english_text")
    return v.select(
        "id", training.chatml(e, z).alias("chat"), F.transform(training.messages(e, z), lambda m: F.concat_ws(": ", m["role"], m["content"])).alias("messages"), training.render(F.lit("parallel"), z, e).alias("rendered"),
        training.choose("42", F.col("id"), ["Translate.", "Put into English.", "What does it say?"]).alias("prompt"),
    )


@query(f"SELECT id, 'own-other' AS direction, zolai_text AS source_text, english_text AS target_text FROM bible_verses_enhanced WHERE {OK} UNION ALL SELECT id, 'other-own', english_text, zolai_text FROM bible_verses_enhanced WHERE {OK}")
def translation_pairs(spark, d):
    """L5, L12."""
    return training.both_ways(table(spark, d, "bible_verses_enhanced"), "id", "zolai_text", "english_text")


@query("WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42' || doc_id), doc_id) AS r, count(*) OVER () AS n FROM documents) SELECT doc_id, CASE WHEN r <= floor(n * 0.1) THEN 'test' WHEN r <= floor(n * 0.1) + floor(n * 0.1) THEN 'val' ELSE 'train' END AS split FROM r")
def train_split(spark, d):
    """L14."""
    return training.split(table(spark, d, "documents").select("doc_id"), "doc_id")


@query("WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('7' || doc_id), doc_id) AS r, count(*) OVER () AS n FROM documents), s AS (SELECT CASE WHEN r <= greatest(50, floor(n * 0.01)) THEN 'test' WHEN r <= greatest(50, floor(n * 0.01)) + greatest(100, floor(n * 0.02)) THEN 'val' ELSE 'train' END AS split FROM r) SELECT split, count(*) AS n FROM s GROUP BY 1")
def split_manifest(spark, d):
    """L15, B5, B6."""
    return training.split(table(spark, d, "documents").select("doc_id"), "doc_id", 0.01, 0.02, 50, 100, "7").groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id FROM documents ORDER BY md5('42' || doc_id), doc_id LIMIT 100")
def random_sample(spark, d):
    """L20."""
    return training.sample(table(spark, d, "documents").select("doc_id"), "doc_id", 100)


@query(f"SELECT id, frequency_bible FROM zolai_vocabulary WHERE frequency_bible > 0 ORDER BY ln(({_h('id')} + 1) / 4294967297.0) / frequency_bible DESC, id LIMIT 100")
def weighted_sample(spark, d):
    """L19."""
    return training.weighted_sample(table(spark, d, "zolai_vocabulary").select("id", "frequency_bible"), "id", "frequency_bible", 100)


@query("(SELECT doc_id, doc_type FROM documents WHERE doc_type = 'news' ORDER BY md5('42' || doc_id), doc_id LIMIT 20) UNION ALL (SELECT doc_id, doc_type FROM documents WHERE doc_type = 'song' ORDER BY md5('42' || doc_id), doc_id LIMIT 10)")
def stratified_sample(spark, d):
    """L9, L27."""
    return training.stratified(table(spark, d, "documents").select("doc_id", "doc_type"), "doc_type", "doc_id", {"news": 20, "song": 10})


@query(
    """WITH q AS (SELECT id, zolai AS word, english AS answer FROM zolai_vocabulary WHERE trim(regexp_replace(coalesce(english, ''), '\\s+', ' ', 'g')) NOT IN ('', '-') AND trim(regexp_replace(coalesce(zolai, ''), '\\s+', ' ', 'g')) NOT IN ('', '-')),
a AS (SELECT answer, row_number() OVER (ORDER BY md5('42' || answer), answer) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT answer FROM q)),
o AS (SELECT a.answer, array_agg(b.answer) AS others FROM a JOIN (SELECT unnest([1, 2, 3]) AS s) ON s < n JOIN a b ON b.i = (a.i + s) % a.n GROUP BY 1)
SELECT id, word, q.answer, list_sort(list_append(coalesce(others, []), q.answer)) AS options FROM q LEFT JOIN o ON o.answer = q.answer"""
)
def quiz_questions(spark, d):
    """L8, G38."""
    return training.quiz(table(spark, d, "zolai_vocabulary"), "id", "zolai", "english")


@query(
    f"""WITH s AS (SELECT id, {W.format('zolai_text')} AS w FROM bible_verses_enhanced), k AS (SELECT *, ({_h('id')} % (len(w) - 2))::INT + 1 AS i FROM s WHERE len(w) >= 4)
SELECT id, array_to_string(list_concat(list_append(w[1:i], '___'), w[i + 2:]), ' ') AS question, w[i + 1] AS answer FROM k"""
)
def cloze_exercises(spark, d):
    """L7, L10."""
    return training.fill_blank(table(spark, d, "bible_verses_enhanced"), "id", "zolai_text")


@query(
    f"""WITH s AS (SELECT id, {W.format('zolai_text')} AS w FROM bible_verses_enhanced), e AS (SELECT id, w, unnest(range(1, len(w) + 1)) AS i FROM s WHERE len(w) >= 4)
SELECT id, string_agg(w[i], ' ' ORDER BY md5(w[i] || (i - 1)), w[i]) AS question, array_to_string(any_value(w), ' ') AS answer FROM e GROUP BY 1"""
)
def reorder_exercises(spark, d):
    """L10."""
    return training.reorder(table(spark, d, "bible_verses_enhanced"), "id", "zolai_text")


@query(
    f"""WITH s AS (SELECT id, array_to_string({W.format("lower(regexp_replace(zolai_text, '[.,;:!?]', '', 'g'))")}, ' ') AS s FROM bible_verses_enhanced), t AS (SELECT id, regexp_replace(s, ' hi$', '') AS b FROM s WHERE regexp_matches(s, '[^ ] hi$'))
SELECT id, 'future' AS kind, b || ' ding hi' AS variant FROM t UNION ALL SELECT id, 'negation', b || ' lo hi' FROM t UNION ALL SELECT id, 'question', b || ' hiam' FROM t"""
)
def sentence_variations(spark, d):
    """L11."""
    return training.variations(table(spark, d, "bible_verses_enhanced"), "id", "zolai_text")


@query(
    f"""SELECT item_id, list_filter([CASE WHEN trim(coalesce(answer, '')) IN ('', '-') THEN 'missing:answer' END, CASE WHEN trim(coalesce(question, '')) IN ('', '-') THEN 'missing:question' END,
 CASE WHEN contains(concat_ws(' ', question, answer), 'hammer') THEN 'denied:hammer' END], lambda x: x IS NOT NULL) AS issues FROM eval_items"""
)
def example_validation(spark, d):
    """L13."""
    t = table(spark, d, "eval_items")
    return t.select("item_id", training.validate_examples(t, ["question", "answer"], ["hammer"]).alias("issues"))


@query(
    rf"""WITH k AS (SELECT lower(trim(regexp_replace(zolai, '\s+', ' ', 'g'))) AS word, english FROM zolai_vocabulary WHERE trim(regexp_replace(coalesce(zolai, ''), '\s+', ' ', 'g')) NOT IN ('', '-')),
t AS (SELECT DISTINCT word, len(string_split(word, ' ')) AS len FROM k), v AS (SELECT id, {W.format('lower(zolai_text)')} AS w FROM bible_verses_enhanced),
g AS (SELECT id, l, w, unnest(range(1, len(w) - l + 2)) AS i FROM v, (SELECT DISTINCT len AS l FROM t)), h AS (SELECT DISTINCT word, id AS o, l FROM (SELECT id, l, array_to_string(w[i:i + l - 1], ' ') AS word FROM g) JOIN t USING (word)),
m AS (SELECT DISTINCT word, english AS o FROM k WHERE trim(regexp_replace(coalesce(english, ''), '\s+', ' ', 'g')) NOT IN ('', '-'))
SELECT word, CASE WHEN l = 1 THEN 'verse' ELSE 'phrase-verse' END AS kind, o::VARCHAR AS target FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY o) AS r FROM h) WHERE r <= 10
UNION ALL SELECT word, 'meaning', o FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY o) AS r FROM m) WHERE r <= 3"""
)
def evidence_graph(spark, d):
    """Vocabulary words and phrases of any length -> the verses that hold them, and words -> meanings."""
    v = table(spark, d, "zolai_vocabulary").where(~T.blank(F.col("zolai"))).select(F.lower(T.squeeze(F.col("zolai"))).alias("word"), "english")
    verses = texts(spark, d, "bible_verses_enhanced", "id", "zolai_text").select("id", T.words(F.lower("zolai_text")).alias("ws"))
    hits = joins.phrase_hits(verses, v.select(F.col("word").alias("phrase"))).select("phrase", "id")
    one = F.instr("phrase", " ") == 0
    meanings = v.where(~T.blank(F.col("english"))).select("word", F.col("english").alias("meaning"))
    return training.evidence_edges(hits.where(one).withColumnRenamed("phrase", "word"), meanings, 10, hits.where(~one))


@query("WITH u AS (SELECT 'articles' AS source_table, id, content AS text FROM articles UNION ALL SELECT 'wiki_content', id, content FROM wiki_content) SELECT source_table, id, length(text) AS chars FROM u WHERE length(trim(text)) >= 20")
def tagged_union(spark, d):
    """A5, L17, I1."""
    a = table(spark, d, "articles").select(F.lit("articles").alias("source_table"), "id", F.col("content").alias("text"))
    u = a.unionByName(table(spark, d, "wiki_content").select(F.lit("wiki_content").alias("source_table"), "id", F.col("content").alias("text")))
    return u.where(F.length(F.trim("text")) >= 20).select("source_table", "id", F.length("text").alias("chars"))


@query("SELECT book, count(*) AS verses, count(DISTINCT chapter) AS chapters, count(DISTINCT source_version) AS versions, count(*) FILTER (contains(lower(zolai_text), 'hiam')) AS questions FROM bible_verses_enhanced GROUP BY 1")
def book_summaries(spark, d):
    """G33, L25."""
    v = table(spark, d, "bible_verses_enhanced")
    return v.groupBy("book").agg(F.count(F.lit(1)).alias("verses"), F.countDistinct("chapter").alias("chapters"), F.countDistinct("source_version").alias("versions"), F.count_if(F.contains(F.lower("zolai_text"), F.lit("hiam"))).alias("questions"))


@query(
    f"""WITH {_FEATURES}, s AS (SELECT doc_id, round({_SCORE}, 5) AS score FROM f), {_REASON.removeprefix('WITH ').replace('t AS (SELECT doc_id, text', 't2 AS (SELECT doc_id, text').replace('FROM t)', 'FROM t2)').replace('r AS (SELECT doc_id, s, CASE', 'r2 AS (SELECT doc_id, s, CASE').replace('FROM r)', 'FROM r2)')},
b AS (SELECT doc_id, source, lang, score FROM documents JOIN s USING (doc_id) JOIN k USING (doc_id) WHERE reason = 'kept' AND score >= 0.4),
n AS (SELECT *, row_number() OVER (ORDER BY md5('42' || doc_id), doc_id) AS rk, count(*) OVER () AS n FROM b)
SELECT doc_id, source, lang, score, CASE WHEN rk <= floor(n * 0.1) THEN 'test' WHEN rk <= 2 * floor(n * 0.1) THEN 'val' ELSE 'train' END AS split FROM n"""
)
def corpus_build(spark, d):
    """Flagship: clean with reasons, de-duplicate, score, keep, split."""
    docs = texts(spark, d, "documents", "doc_id", "source", "lang", "dialect", "text")
    kept = filters.clean_with_reasons(docs, "doc_id", "text", "dialect").where("reason = 'kept'").select("doc_id", "source", "lang")
    # stored before it is filtered: a filter pushed below the score would compute every feature twice
    scores = cut_lineage(quality.features(docs.select("doc_id", "text"), "doc_id", "text").select("doc_id", F.round(quality.score(), 5).alias("score")))
    scored = cut_lineage(kept.join(scores, "doc_id").where("score >= 0.4"))
    return training.split(scored, "doc_id").select("doc_id", "source", "lang", "score", "split")


@query("WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{M}\\p{N}]+')) AS w FROM documents) SELECT doc_id AS id, count(*)::BIGINT AS score FROM t WHERE w IN ('maize', 'school') GROUP BY 1 HAVING count(DISTINCT w) = 2")
def index_search(spark, d):
    """N2."""
    return search.match_all(search.postings(table(spark, d, "documents"), "doc_id", "text"), ["school", "maize"])


@query(
    r"""WITH e AS (SELECT id, lower(trim(zolai)) AS word, lower(trim(english)) AS meaning FROM zolai_vocabulary), q AS (SELECT DISTINCT lower(trim(english_item)) AS k, english_item AS q FROM (SELECT question AS english_item FROM eval_items UNION ALL SELECT 'hammer' UNION ALL SELECT 'write' UNION ALL SELECT 'dipiat')),
h AS (SELECT q, id, 1 AS tier FROM e JOIN q ON word = k UNION ALL SELECT q, id, 2 FROM e JOIN q ON meaning = k
 UNION ALL SELECT q, id, 3 FROM (SELECT id, unnest(list_transform(list_filter(['te','in','na','ah','pa','nu','un','uh'], lambda x: ends_with(word, x) AND length(word) - length(x) >= 3), lambda x: left(word, length(word) - length(x)))) AS st FROM e) JOIN q ON st = k
 UNION ALL SELECT q, id, 4 FROM (SELECT id, unnest(list_distinct(regexp_extract_all(meaning, '[\p{L}\p{M}\p{N}]+'))) AS m FROM e) JOIN q ON m = k),
b AS (SELECT q, id, min(tier) AS tier FROM h GROUP BY 1, 2)
SELECT q, id, tier FROM b QUALIFY tier = min(tier) OVER (PARTITION BY q)"""
)
def tiered_search(spark, d):
    """N1."""
    e = table(spark, d, "zolai_vocabulary").select("id", F.col("zolai").alias("word"), F.col("english").alias("meaning"))
    q = table(spark, d, "eval_items").select(F.col("question").alias("q")).unionAll(spark.createDataFrame([("hammer",), ("write",), ("dipiat",)], "q string"))
    return search.tiered(e, q)


@query("SELECT id, list_filter([CASE WHEN contains(lower(zolai_text), 'hammer') THEN 'zolai_text' END, CASE WHEN contains(lower(english_text), 'hammer') THEN 'english_text' END], lambda x: x IS NOT NULL) AS match_in FROM bible_verses_enhanced WHERE contains(lower(zolai_text), 'hammer') OR contains(lower(english_text), 'hammer')")
def substring_search(spark, d):
    """D22, N3-N5."""
    return search.substring(table(spark, d, "bible_verses_enhanced").select("id", "zolai_text", "english_text"), ["zolai_text", "english_text"], "hammer").select("id", "match_in")


@query("SELECT doc_id AS id, contains(t, 'goat')::INT + contains(t, 'maize')::INT + contains(t, 'price')::INT AS score FROM (SELECT doc_id, lower(coalesce(text, '')) AS t FROM documents) WHERE contains(t, 'goat') OR contains(t, 'maize') OR contains(t, 'price') ORDER BY score DESC, id LIMIT 5")
def retrieval(spark, d):
    """N7, L24."""
    return search.retrieve(table(spark, d, "documents"), "doc_id", "text", ["goat", "maize", "price"])


@query("SELECT item_id, trim(lower(coalesce(answer, ''))) <> '' AND trim(lower(coalesce(question, ''))) <> '' AND (contains(lower(trim(question)), lower(trim(answer))) OR contains(lower(trim(answer)), lower(trim(question)))) AS matched FROM eval_items WHERE question IS NOT NULL AND answer IS NOT NULL")
def answer_matching(spark, d):
    """N9, P14."""
    t = table(spark, d, "eval_items").where("question IS NOT NULL AND answer IS NOT NULL")
    return t.select("item_id", search.answer_matches(F.col("question"), F.col("answer")).alias("matched"))


@query(
    """WITH v AS (SELECT vec_id, embedding::DOUBLE[64] AS v FROM embeddings), s AS (SELECT q.vec_id AS query_id, x.vec_id AS id, array_cosine_similarity(q.v, x.v) AS similarity FROM v q JOIN v x ON q.vec_id % 100 = 0 AND q.vec_id <> x.vec_id)
SELECT query_id, id, round(similarity, 6) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(similarity, 9) DESC, id) AS r FROM s) WHERE r <= 3"""
)
def nearest_vectors(spark, d):
    return search.nearest(table(spark, d, "embeddings"), "vec_id", "embedding").withColumn("similarity", F.round("similarity", 6))


@query(
    """SELECT event_type AS model, round(avg((value >= 50)::INT), 6) AS accuracy, count(*) AS n, count(*) FILTER (value IS NULL) AS errors, rank() OVER (ORDER BY round(avg((value >= 50)::INT), 6) DESC)::INT AS rank FROM events GROUP BY 1"""
)
def model_benchmark(spark, d):
    """Accuracy, errors and rank of a table of answers; the window is over one row per model."""
    from pyspark.sql import Window

    e = table(spark, d, "events").groupBy(F.col("event_type").alias("model"))
    a = e.agg(F.round(F.avg((F.col("value") >= 50).cast("int")), 6).alias("accuracy"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("value").isNull()).alias("errors"))
    return a.withColumn("rank", F.rank().over(Window.partitionBy().orderBy(F.desc("accuracy"))))
