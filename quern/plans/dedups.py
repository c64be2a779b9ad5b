"""Queries over de-duplication (inventory E) and storage changes (inventory M)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators import dedup, mutate
from quern.plans.registry import query
from quern.session import table

SQZ = r"trim(regexp_replace({}, '\s+', ' ', 'g'))"


@query("SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")
def doc_exact_dedup(spark, d):
    return dedup.keep_first(table(spark, d, "documents").select("doc_id", "source", "text"), F.col("text"), ["doc_id"]).select("doc_id", "source")


@query(f"SELECT doc_id FROM (SELECT *, row_number() OVER (PARTITION BY lower({SQZ.format('text')}) ORDER BY doc_id) AS rn FROM documents WHERE text IS NOT NULL) WHERE rn = 1")
def doc_normalised_dedup(spark, d):
    t = table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", "text")
    return dedup.keep_first(t, dedup.phrase_key(F.col("text")), ["doc_id"]).select("doc_id")


@query("SELECT doc_id, left(text, 120) AS head FROM (SELECT *, row_number() OVER (PARTITION BY left(text, 120) ORDER BY doc_id) AS rn FROM documents WHERE text IS NOT NULL) WHERE rn = 1")
def doc_prefix_dedup(spark, d):
    t = table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", dedup.prefix_key(F.col("text")).alias("head"))
    return dedup.keep_first(t, F.col("head"), ["doc_id"])


@query("SELECT md5(text) AS digest, count(*) AS n, min(doc_id) AS first_id, max(doc_id) AS last_id FROM documents WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1")
def doc_duplicate_groups(spark, d):
    return dedup.duplicate_groups(table(spark, d, "documents").where("text IS NOT NULL"), F.col("text"), "doc_id")


@query(f"SELECT id, md5(lower(coalesce(zolai_text, '')) || '|||' || lower(coalesce(english_text, ''))) AS pair_key, sha256({SQZ.format('zolai_text')}) AS digest, ('0x' || left(md5(zolai_text), 8))::UBIGINT::BIGINT % 2147483648 AS surrogate FROM bible_verses_enhanced WHERE zolai_text IS NOT NULL")
def verse_keys(spark, d):
    """E4, E5, E7, E16."""
    t = table(spark, d, "bible_verses_enhanced").where("zolai_text IS NOT NULL")
    z = F.col("zolai_text")
    return t.select("id", dedup.pair_key(z, F.col("english_text")).alias("pair_key"), dedup.text_digest(z).alias("digest"), dedup.surrogate_id(z).alias("surrogate"))


@query("SELECT id, md5('{\"chapter\":' || chapter || ',\"verse\":' || verse || '}') AS fp FROM bible_verses_enhanced")
def record_fingerprints(spark, d):
    return table(spark, d, "bible_verses_enhanced").select("id", dedup.fingerprint("chapter", "verse").alias("fp"))


@query("SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY book, chapter, verse, source_version ORDER BY created_at DESC, id DESC) AS rn FROM bible_verses_enhanced) WHERE rn = 1")
def verse_latest(spark, d):
    """H1, M2: the last written row per key."""
    t = table(spark, d, "bible_verses_enhanced").select("id", "book", "chapter", "verse", "source_version", "created_at")
    return dedup.first_rows(t, ["book", "chapter", "verse", "source_version"], [F.desc("created_at"), F.desc("id")]).select("id")


@query("SELECT doc_id FROM documents WHERE text IS NOT NULL AND md5(text) NOT IN (SELECT md5(text) FROM documents WHERE source = 'hill_news_crawl' AND text IS NOT NULL)")
def cross_stage_anti(spark, d):
    """Documents whose text isn't in an existing output."""
    t = table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", "source", F.md5("text").alias("digest"))
    return dedup.not_in(t, t.where("source = 'hill_news_crawl'"), "digest").select("doc_id")


@query(
    """WITH v AS (SELECT lower(trim(zolai)) AS key, id, source_priority, nullif(trim(english), '') AS english, nullif(trim(myanmar), '') AS myanmar, nullif(trim(pos), '') AS pos FROM zolai_vocabulary),
n AS (SELECT key, id, source_priority, CASE WHEN english <> '-' THEN english END AS english, CASE WHEN myanmar <> '-' THEN myanmar END AS myanmar, CASE WHEN pos <> '-' THEN pos END AS pos FROM v)
SELECT key, (array_agg(id ORDER BY source_priority, id))[1] AS id, count(*) AS n, (array_agg(english ORDER BY source_priority, id) FILTER (english IS NOT NULL))[1] AS english,
 (array_agg(myanmar ORDER BY source_priority, id) FILTER (myanmar IS NOT NULL))[1] AS myanmar, (array_agg(pos ORDER BY source_priority, id) FILTER (pos IS NOT NULL))[1] AS pos
FROM n GROUP BY key"""
)
def vocabulary_merge(spark, d):
    """priority merge with back-filling."""
    t = table(spark, d, "zolai_vocabulary")
    t = t.select(F.lower(F.trim("zolai")).alias("w"), "id", "source_priority", *[F.trim(c).alias(c) for c in ("english", "myanmar", "pos")])
    return dedup.merge_on_key(t, F.col("w"), [F.col("source_priority"), F.col("id")], "id", ["english", "myanmar", "pos"])


_TWO = """WITH o AS (SELECT headword AS word, pos, english FROM entries), n AS (SELECT lower(trim(zolai)) AS word, (array_agg(pos ORDER BY id))[1] AS pos, (array_agg(english ORDER BY id))[1] AS english FROM zolai_vocabulary WHERE zolai IS NOT NULL GROUP BY 1)
SELECT coalesce(o.word, n.word) AS word, {} FROM o FULL JOIN n ON o.word = n.word"""


def _two(spark, d):
    """The entries, and the first vocabulary row of each word."""
    v = table(spark, d, "zolai_vocabulary").where("zolai IS NOT NULL").groupBy(F.lower(F.trim("zolai")).alias("word")).agg(F.min(F.struct("id", "pos", "english")).alias("m"))
    return table(spark, d, "entries").select(F.col("headword").alias("word"), "pos", "english"), v.select("word", "m.pos", "m.english")


@query(_TWO.format("coalesce(o.pos, n.pos) AS pos, coalesce(o.english, n.english) AS english"))
def upsert_fill(spark, d):
    """Vocabulary rows added to the entries, or only filling what is NULL there."""
    return mutate.upsert(*_two(spark, d), ["word"], fill_only=True)


@query(_TWO.format("CASE WHEN n.word IS NOT NULL THEN n.pos ELSE o.pos END AS pos, CASE WHEN n.word IS NOT NULL THEN n.english ELSE o.english END AS english"))
def upsert_replace(spark, d):
    """M2: last write wins."""
    return mutate.upsert(*_two(spark, d), ["word"])


@query("SELECT zolai AS word, (SELECT 0) + sum(f)::BIGINT AS total FROM (SELECT zolai, frequency_bible AS f FROM zolai_vocabulary UNION ALL SELECT zolai, frequency_songs FROM zolai_vocabulary) GROUP BY 1")
def frequency_increment(spark, d):
    """Counts of two sources added by word."""
    v = table(spark, d, "zolai_vocabulary")
    a = v.select(F.col("zolai").alias("word"), F.col("frequency_bible").cast("bigint").alias("n"))
    b = v.select(F.col("zolai").alias("word"), F.col("frequency_songs").cast("bigint").alias("n"))
    return mutate.increment(a, b, "word", "n").select("word", F.col("n").alias("total"))


@query(
    """SELECT id, field, old_value, new_value FROM (
 SELECT id, 'pos' AS field, pos AS old_value, lower(trim(pos)) AS new_value FROM dictionary_enhanced
 UNION ALL SELECT id, 'zolai', zolai, lower(trim(zolai)) FROM dictionary_enhanced) WHERE old_value IS DISTINCT FROM new_value"""
)
def change_log(spark, d):
    """M7: what a cleaning step changed, one row per changed field."""
    old = table(spark, d, "dictionary_enhanced").select("id", "pos", "zolai")
    return mutate.changes(old, old.select("id", F.lower(F.trim("pos")).alias("pos"), F.lower(F.trim("zolai")).alias("zolai")), "id", ["pos", "zolai"])


@query("SELECT id, i AS tag_no, tags[i] AS tag FROM (SELECT id, tags, unnest(range(1, len(tags) + 1)) AS i FROM articles)")
def child_rows(spark, d):
    """M6: nested values as a child table with parent key and ordinal."""
    return mutate.children(table(spark, d, "articles"), "id", "tags").select("id", F.col("pos").alias("tag_no"), F.col("item").alias("tag"))


@query("SELECT regexp_extract(source_file, '([^/]*)$', 1) AS name, count(DISTINCT source_file) AS n_folders FROM dictionary_enhanced WHERE source_file IS NOT NULL GROUP BY 1 HAVING count(DISTINCT source_file) > 1")
def duplicate_file_names(spark, d):
    """One base name in more than one folder."""
    t = table(spark, d, "dictionary_enhanced").where("source_file IS NOT NULL").select("source_file").distinct()
    return t.groupBy(F.regexp_extract("source_file", r"([^/]*)$", 1).alias("name")).agg(F.count(F.lit(1)).alias("n_folders")).where("n_folders > 1")


@query("SELECT id, zolai, english, NULL::VARCHAR AS example FROM dictionary_enhanced WHERE nullif(trim(coalesce(english, '')), '') IS NOT NULL")
def schema_migration(spark, d):
    """M8, M4: a column added where missing, rows without a value soft-deleted."""
    t = mutate.add_missing(table(spark, d, "dictionary_enhanced").select("id", "zolai", "english"), {"example": "string"})
    return t.where(F.trim(F.coalesce("english", F.lit(""))) != "")
